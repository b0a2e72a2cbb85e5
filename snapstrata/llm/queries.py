"""One query for each operator over its whole table, with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstrata.llm import (
    bpe_lexicon, fingerprints, language_id, license_scan, merkle_manifest, near_dedup, packing, quality_outliers,
    quality_ranking, quotation_links, substring_dedup, token_alignment, url_filters,
)
from snapstrata.llm.common import documents, vocabulary


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Spans come as one text: label, errors, first word and the word after the last."""
    return license_scan.scan(documents(spark, folder)).withColumn("spans", F.array_join("spans", ";"))


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprinted(documents(spark, folder))


def op3_quotation_links(spark: SparkSession, folder: str) -> DataFrame:
    """The table's conversations hold no quotes, so their turns are first written as mail with quoted answers."""
    mail = quotation_links.as_mail(spark.read.parquet(f"{folder}/conversations.parquet"))
    return quotation_links.linked(mail)


def op4_bpe_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_lexicon.encoded(documents(spark, folder), vocabulary("byte_bpe_50k.json"))


def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.classes(documents(spark, folder)).drop("row")


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_outliers.judged(documents(spark, folder))


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return quality_ranking.scored(docs, quality_ranking.fitted(docs, spark.read.parquet(f"{folder}/labels.parquet")))


def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.judged(spark.read.parquet(f"{folder}/pages.parquet"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(documents(spark, folder), vocabulary("word_bpe_49k.json"))


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.deduplicated(documents(spark, folder))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle_manifest.manifest(documents(spark, folder))


def op12_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return language_id.predicted(docs, language_id.fitted(docs))


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.aligned(documents(spark, folder), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_fingerprints": op2_fingerprints,
    "op3_quotation_links": op3_quotation_links,
    "op4_bpe_lexicon": op4_bpe_lexicon,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_url_filters": op8_url_filters,
    "op9_packing": op9_packing,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_language_id": op12_language_id,
    "op13_token_alignment": op13_token_alignment,
}


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + str(x).replace("'", "''") + "'" for x in r) + ")" for r in rows)


SQL: dict[str, str] = {
    # Every turn is known to quote the lines of the turn it answers, and one line of what that one answers.
    "op3_quotation_links": r"""
WITH RECURSIVE said AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text,
         CASE WHEN turn % 5 = 4 THEN turn - 2 ELSE turn - 1 END AS answers
  FROM conversations),
turns AS (SELECT conv_id, turn, min(text) AS text, min(answers) AS answers FROM said GROUP BY ALL),
own AS (
  SELECT conv_id, turn, lower(trim(regexp_replace(line, '\s+', ' ', 'g'))) AS line
  FROM (SELECT DISTINCT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM said)),
first AS (SELECT conv_id, line, min(turn) AS first FROM own WHERE line <> '' GROUP BY ALL),
near AS (
  SELECT t.conv_id, t.turn, 1 AS level, unnest(string_split(a.text, chr(10))) AS line
  FROM turns t JOIN turns a ON a.conv_id = t.conv_id AND a.turn = t.answers),
far AS (
  SELECT t.conv_id, t.turn, 2 AS level, string_split(b.text, chr(10))[1] AS line
  FROM turns t JOIN turns a ON a.conv_id = t.conv_id AND a.turn = t.answers
  JOIN turns b ON b.conv_id = a.conv_id AND b.turn = a.answers),
quotes AS (
  SELECT conv_id, turn, line, min(level) AS level
  FROM (SELECT conv_id, turn, level, lower(trim(regexp_replace(line, '\s+', ' ', 'g'))) AS line
        FROM (SELECT * FROM near UNION ALL SELECT * FROM far))
  WHERE line <> '' GROUP BY ALL),
linked AS (
  SELECT q.*, CASE WHEN f.first < q.turn THEN f.first END AS first
  FROM quotes q LEFT JOIN first f USING (conv_id, line)),
parents AS (
  SELECT conv_id, turn, count(*) AS n_quotes, count(first) AS n_linked,
         arg_min(first, level * 1000000000 - first) FILTER (WHERE first IS NOT NULL) AS parent_turn
  FROM linked GROUP BY ALL),
tree AS (
  SELECT t.conv_id, t.turn, t.turn AS root_turn, 0 AS depth FROM turns t LEFT JOIN parents p USING (conv_id, turn)
  WHERE p.parent_turn IS NULL
  UNION ALL
  SELECT p.conv_id, p.turn, tree.root_turn, tree.depth + 1 FROM parents p JOIN tree ON tree.conv_id = p.conv_id AND tree.turn = p.parent_turn)
SELECT s.conv_id, s.turn, s.role, regexp_replace(s.text, '^\s+|\s+$', '', 'g') AS own_text,
       coalesce(n_quotes, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked, parent_turn, root_turn, depth
FROM said s LEFT JOIN parents USING (conv_id, turn) LEFT JOIN tree USING (conv_id, turn)""",
    "op8_url_filters": f"""
WITH rules(text, action, expression, listed) AS (VALUES {_values((r.text, r.action, r.expression, r.listed) for r in url_filters.LISTED + url_filters.PATTERNS)}),
pages_ AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS row
  FROM pages),
fits AS (
  SELECT row, text, action, listed,
         row_number() OVER (PARTITION BY row ORDER BY listed DESC, length(text) DESC, text) AS place
  FROM pages_ JOIN rules ON regexp_matches(host || path, expression))
SELECT page_id, host, path, CASE WHEN listed = 'True' THEN text END AS rule, coalesce(action, 'allow') AS verdict,
       CASE WHEN listed = 'False' THEN text END AS pattern
FROM pages_ LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (row)""",
    # Every window as a hash; a word goes if the last repeated window that starts at or before it reaches it.
    "op10_substring_dedup": r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT row, doc_id, place, sha256(array_to_string(words[place:place + 49], ' ')) AS hash
  FROM (SELECT *, unnest(range(1, len(words) - 48)) AS place FROM docs)),
firsts AS (SELECT hash, min(doc_id) AS first_doc FROM windows GROUP BY hash),
repeated AS (SELECT row, place FROM windows JOIN firsts USING (hash) WHERE first_doc < doc_id),
placed AS (SELECT row, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM docs),
judged AS (
  SELECT p.row, p.place, p.word, coalesce(p.place - max(r.place) OVER (PARTITION BY p.row ORDER BY p.place) < 50, false) AS gone
  FROM placed p LEFT JOIN repeated r ON r.row = p.row AND r.place = p.place),
kept AS (
  SELECT row, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (NOT gone) AS text FROM judged GROUP BY row)
SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row)""",
    # Leaves up to the roots by levels; then each document's proof and its fold, by levels again.
    "op11_merkle_manifest": r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, source, text,
         coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') AS head,
         replace(text, chr(10), '') AS less,
         list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(range(1, length(doc_id::varchar) + 1),
           lambda i: [ascii((doc_id::varchar)[i])::bigint] || [(-1)::bigint, -1, -1, -1, -1, -1, -1, -1]))),
           lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc // 2, 3988292384 * (crc % 2)) END) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN sha256(head || coalesce(strlen(less) || ':' || less, '-')) END AS changed
  FROM fields),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY source) AS size
  FROM leaves),
nodes AS (
  SELECT 0 AS level, source, size, place, leaf AS node FROM placed
  UNION ALL
  SELECT level + 1, source, (size + 2) // 3, place // 3, sha256(string_agg(node, '' ORDER BY place))
  FROM nodes WHERE size > 1 GROUP BY level, source, size, place // 3),
subroots AS (
  SELECT source, node AS subroot, row_number() OVER (ORDER BY source IS NOT NULL, source) - 1 AS place, count(*) OVER () AS size
  FROM nodes WHERE size = 1),
tops AS (
  SELECT 0 AS level, size, place, subroot AS node FROM subroots
  UNION ALL
  SELECT level + 1, (size + 2) // 3, place // 3, sha256(string_agg(node, '' ORDER BY place))
  FROM tops WHERE size > 1 GROUP BY level, size, place // 3),
runs AS (
  SELECT level, source, place // 3 AS run, list(node ORDER BY place) AS run_nodes FROM nodes WHERE size > 1 GROUP BY ALL),
top_runs AS (SELECT level, place // 3 AS run, list(node ORDER BY place) AS run_nodes FROM tops WHERE size > 1 GROUP BY ALL),
inner_ AS (
  SELECT p.doc_id, p.source, p.leaf, 0 AS level, p.place, '' AS proof, coalesce(p.changed, p.leaf) AS folded, r.run_nodes
  FROM placed p LEFT JOIN runs r ON r.level = 0 AND r.source IS NOT DISTINCT FROM p.source AND r.run = p.place // 3
  UNION ALL
  SELECT i.doc_id, i.source, i.leaf, i.level + 1, i.place // 3,
         i.proof || array_to_string(i.run_nodes[:i.place % 3] || i.run_nodes[i.place % 3 + 2:], ''),
         sha256(array_to_string(i.run_nodes[:i.place % 3] || [i.folded] || i.run_nodes[i.place % 3 + 2:], '')), r.run_nodes
  FROM inner_ i LEFT JOIN runs r ON r.level = i.level + 1 AND r.source IS NOT DISTINCT FROM i.source AND r.run = i.place // 9
  WHERE i.run_nodes IS NOT NULL),
outer_ AS (
  SELECT i.doc_id, i.leaf, s.subroot, 0 AS level, s.place, i.proof, i.folded, r.run_nodes
  FROM inner_ i JOIN subroots s ON s.source IS NOT DISTINCT FROM i.source LEFT JOIN top_runs r ON r.level = 0 AND r.run = s.place // 3
  WHERE i.run_nodes IS NULL
  UNION ALL
  SELECT i.doc_id, i.leaf, i.subroot, i.level + 1, i.place // 3,
         i.proof || array_to_string(i.run_nodes[:i.place % 3] || i.run_nodes[i.place % 3 + 2:], ''),
         sha256(array_to_string(i.run_nodes[:i.place % 3] || [i.folded] || i.run_nodes[i.place % 3 + 2:], '')), r.run_nodes
  FROM outer_ i LEFT JOIN top_runs r ON r.level = i.level + 1 AND r.run = i.place // 9
  WHERE i.run_nodes IS NOT NULL)
SELECT doc_id, leaf, subroot, (SELECT node FROM tops WHERE size = 1) AS root, sha256(proof) AS proof_sha256,
       folded AS folded_root, folded = (SELECT node FROM tops WHERE size = 1) AS verified
FROM outer_ WHERE run_nodes IS NULL""",
}
