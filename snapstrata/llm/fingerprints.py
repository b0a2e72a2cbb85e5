"""Document fingerprints: threshold-scaled sketches.

Of a text's five-word shingles, every one whose 64-bit hash lies below a fixed fraction of the hash range is
kept, whatever the text's length. So sketches of any two texts keep the same shingles: the sketch of a union
is the union of the sketches, and the share of one sketch in another estimates how much of one text is
contained in the other, also between very unequal texts. The smallest hash of a text is always kept, so that
short texts have a sketch; it obeys the same rule of union.

All of it is DataFrame code in the row; `with_next` deals documents out by ranges of their id, with one shuffle.

Edge cases: null texts are empty; a text without words has an empty sketch, whose likeness to an empty one is
1 and to others 0; a text of fewer than five words has one shingle; repeated rows and ids are ordered by text;
null ids come last; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SIZE = 5
#: One hash in so many is kept.
SCALE = 8


def _let(value: Column, body) -> Column:
    """`body(value)` with the value worked out once a row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def sketch(text: Column, size: int = SIZE, scale: int = SCALE) -> Column:
    """Sorted distinct hashes below 1 / scale of the range, with the smallest of all."""
    limit = -(1 << 63) + (1 << 64) // scale

    def hashes(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - size, F.lit(0)))
        return F.when(F.size(w) > 0, F.transform(starts, lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(size)))))

    def kept(h: Column) -> Column:
        low = lambda least: F.array_sort(F.array_distinct(F.filter(h, lambda x: (x < limit) | (x == least))))
        return _let(F.array_min(h), low)

    return F.coalesce(_let(words(text), lambda w: _let(hashes(w), kept)), F.array().cast("array<bigint>"))


def containment(a: Column, b: Column) -> Column:
    """Share of the smaller sketch that the other has: 1 when the smaller text lies in the larger one."""
    least = F.least(F.size(a), F.size(b))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
        .when(least == 0, F.lit(0.0))
        .otherwise(F.size(F.array_intersect(a, b)) / least)
    )


def merged(a: Column, b: Column) -> Column:
    """Sketch of two texts together, but for a smallest hash above the limit, which is kept as well."""
    return F.array_sort(F.array_union(a, b))


def printed(hashes: Column) -> Column:
    return F.concat_ws(",", F.transform(hashes, F.hex))


def with_next(docs: DataFrame, prepared: Callable[[DataFrame], DataFrame] = lambda df: df, parts: int = 200) -> DataFrame:
    """Each row of (doc_id, text), `prepared`, with struct `next`: the row that follows by descending id; after the last, the first.

    Ids are dealt into `parts` ranges of about equal numbers of rows. Each range gets a copy of the row before it, so
    that no task sees more than its range.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc()]
    parts = max(parts, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / parts for i in range(1, parts)]
    ids = docs.select("doc_id")
    bounds = sorted(set(ids.agg(F.percentile_approx("doc_id", shares, 10_000).alias("b")).first()["b"] or []))
    place = F.lit(0) if not bounds else F.when(F.col("doc_id").isNull(), 0).otherwise(
        F.aggregate(F.array(*map(F.lit, bounds)), F.lit(0), lambda n, b: n + (F.col("doc_id") > b).cast("int"))
    )
    placed = docs.withColumn("part", place)
    # The largest id of each range, a few hundred at most: its row also opens the next range. That of the last range opens the first.
    ends = sorted((r["part"], r["last"]) for r in ids.withColumn("part", place).groupBy("part").agg(F.max("doc_id").alias("last")).collect())
    opens = [(last, after) for (_, last), (after, _) in zip(ends, ends[1:] + ends[:1])]
    copies = placed.join(
        F.broadcast(docs.sparkSession.range(1).select(F.inline(F.array(*(F.struct(F.lit(a).cast("long").alias("end"), F.lit(b).alias("to")) for a, b in opens or [(None, None)]))))),
        F.col("doc_id").eqNullSafe(F.col("end")),
    ).withColumn("part", F.col("to")).drop("end", "to")
    copies = copies.groupBy("part").agg(F.max_by(F.struct(*docs.columns), F.struct("doc_id", "text")).alias("row")).select("part", "row.*")
    both = prepared(placed.withColumn("copy", F.lit(False)).unionByName(copies.withColumn("copy", F.lit(True))))
    row = [x for x in both.columns if x not in ("copy", "part")]
    w = Window.partitionBy("part").orderBy(F.col("copy").desc(), *order)
    return both.withColumn("next", F.lag(F.struct(*row)).over(w)).where(~F.col("copy")).drop("copy", "part")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last third replaced by the start of the next document.
    """
    c = F.col
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    linked = with_next(base, lambda df: df.withColumn("sketch", sketch(c("text"))))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(c("text"), F.lit(1), n - third), F.substring(c("next.text"), F.lit(1), third))
    rows = linked.select("doc_id", n.cast("long").alias("n_chars"), "sketch", c("next.sketch").alias("next_sketch"), edited.alias("edited"))
    rows = rows.withColumn("edited_sketch", sketch(c("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        printed(c("sketch")).alias("fingerprint"), printed(c("edited_sketch")).alias("edited_fingerprint"),
        containment(c("sketch"), c("edited_sketch")).alias("near_edited"), containment(c("sketch"), c("next_sketch")).alias("near_next"),
    )
