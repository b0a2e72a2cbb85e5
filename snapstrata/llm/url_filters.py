"""URL filters: rules are indexed by their rarest literal token, so a URL meets few of them.

A rule is a regular expression over `host + path` with the literal tokens every match must hold as a
whole. Tokens of all URLs are counted; each rule is filed under the one that the fewest URLs have. A
URL's tokens fetch the rules filed under them, and only those run their expression.

Everything is DataFrame code. URLs are judged once each, then joined to their pages, so that a URL on a
third of all pages costs one judgement; candidates are combined per URL before they are shuffled.

Edge cases: null URLs and URLs without `://` have an empty host and path, which no rule fits; repeated
rows each get their verdict; of rules of equal length the smaller text wins; empty tables give no rows;
columns of the pages other than `page_id` and `url` are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"


@dataclass(frozen=True)
class Rule:
    text: str  # what is reported
    action: str
    expression: str
    tokens: list[str]  # whole tokens of every match
    listed: bool  # listed rules come before patterns

    @classmethod
    def prefix(cls, host: str, path: str, action: str) -> Rule:
        """Host and its subdomains, with paths that start so. The last token of a path may go on in the URL."""
        tokens = re.findall("[0-9A-Za-z]+", host + (path if re.search("[^0-9A-Za-z]$", path) else re.sub("[0-9A-Za-z]+$", "", path)))
        return cls(host + path, action, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", tokens, True)

    @classmethod
    def host_words(cls, *words: str, action: str = "block") -> Rule:
        """Hosts with these words side by side between dots or hyphens."""
        return cls("-".join(words), action, rf"^(?:[^/]*[.-])?{'-'.join(map(re.escape, words))}(?:[.-]|/|$)", list(words), False)


#: Rules of the contract.
LISTED = (
    Rule.prefix("org", "/", "allow"),
    Rule.prefix("example.org", "/es/", "block"),
    Rule.prefix("example.org", "/en/1", "block"),
    Rule.prefix("com", "/fr/", "allow"),
    Rule.prefix("com", "/de/", "block"),
)
#: Kinds of hosts whose pages are no use as training text.
PATTERNS = tuple(
    Rule.host_words(*x.split())
    for x in ("casino", "poker", "free bets", "cheap pills", "pharmacy", "adult", "porn", "xxx", "spam", "ads", "payday loans", "warez")
)


def parts(url) -> tuple:
    """Host (A-Z in lower case) and path of a URL column."""
    url = F.coalesce(url, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), upper, lower), F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1)


def judged(pages: DataFrame, rules: Sequence[Rule] = LISTED + PATTERNS, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule (of the listed ones), verdict, pattern (of the others)."""
    spark = pages.sparkSession
    pages = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"))
    host, path = parts(F.col("url"))
    urls = pages.select("url").distinct().select("url", F.concat(host, path).alias("key"))
    tokens = urls.select("url", "key", F.explode(F.array_distinct(F.regexp_extract_all("key", F.lit(TOKEN), F.lit(0)))).alias("token"))

    listed = spark.range(1).select(F.inline(F.array(*(F.struct(*(F.lit(v).alias(k) for k, v in vars(r).items())) for r in rules))))
    by_token = listed.withColumn("token", F.explode("tokens")).drop("tokens")
    counts = tokens.join(by_token.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    filed = (
        by_token.join(counts, "token", "left")
        .groupBy("text", "action", "expression", "listed")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "token")).getField("token").alias("token"))
    )
    best = (
        tokens.join(filed, "token")
        .where(F.expr("key rlike expression"))
        .groupBy("url")
        .agg(F.min(F.struct((~F.col("listed")).alias("pattern"), -F.length("text"), "text", "action")).alias("best"))
        .select("url", F.col("best.text").alias("text"), F.col("best.action").alias("action"), (~F.col("best.pattern")).alias("listed"))
    )
    return pages.join(best, "url", "left").select(
        "page_id", host.alias("host"), path.alias("path"),
        F.when(F.col("listed"), F.col("text")).alias("rule"),
        F.coalesce("action", F.lit(default)).alias("verdict"),
        F.when(~F.col("listed"), F.col("text")).alias("pattern"),
    )
