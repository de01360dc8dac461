"""Document fingerprints: threshold-scaled sketches of five-word shingles, in DataFrame functions only.

A sketch keeps every shingle hash under a 64th of the hash space, and never fewer than FLOOR hashes (or all): its own
threshold `tau`, under which it is complete, is never lower than the fixed one. Two sketches are compared under the
lower of their thresholds, where both are complete; so containment between a short and a very long document is
estimated from the same hashes, and the union of sketches is again a sketch. Texts of up to FLOOR shingles compare
exactly; on longer ones the error is about sqrt(j * (1 - j) / FLOOR), four hundredths at most on average. Hashes are 48
bits wide, which leaves chance matches between sketches of a billion hashes rare; as a string each takes eight letters.

Defined results: a null text is empty; an empty table gives no rows; a text of fewer than five words has its whole
sequence as one shingle; a text without words has an empty sketch, which is like another empty one (1.0) and unlike all
others (0.0). A very long text keeps a 64th of its shingles. Rows go by ascending doc_id, nulls first, and those of one
id by the xxhash64 of their text; repeated rows follow each other. Columns other than doc_id and text are not passed on
by with_next(), whatever their names; with_sketch() keeps all but one that has the name of the sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickvault.llm.common import table, width, words

SHINGLE = 5
#: Hashes are 48 bits wide; one in so many is kept, and so many at least.
SPACE = 1 << 48
FRACTION, FLOOR = 64, 128
TOP = SPACE - 1


def with_sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds `out`: struct<tau, hashes>, the hashes ascending and complete up to tau.

    Columns pass through as they are, under names that the steps do not use: packed into a struct and taken out again
    they would hide from Spark how the rows are partitioned, and what follows would shuffle them once more."""
    kept = [F.col(f"`{c}`") for c in df.columns if c != out]
    own = "_"
    while any(c.lower().startswith(own) for c in df.columns):
        own += "_"
    w, h, l, k, full = (own + c for c in ("w", "h", "l", "k", "full"))  # noqa: E741
    df = df.select(*kept, words(F.col(f"`{text}`")).alias(w))
    starts = F.sequence(F.lit(1), F.size(w) - (SHINGLE - 1))
    each = F.transform(starts, lambda i: F.shiftrightunsigned(F.xxhash64(F.slice(w, i, SHINGLE)), 16))
    whole = F.when(F.size(w) > 0, F.array(F.shiftrightunsigned(F.xxhash64(w), 16))).otherwise(F.array().cast("array<bigint>"))
    df = df.select(*kept, F.when(F.size(w) >= SHINGLE, each).otherwise(whole).alias(h))
    low = F.lit(SPACE // FRACTION)
    df = df.select(*kept, h, F.array_distinct(F.filter(h, lambda x: x < low)).alias(l))
    few = F.slice(F.sort_array(F.array_distinct(h)), 1, FLOOR)
    df = df.select(*kept, F.when(F.size(l) >= FLOOR, F.sort_array(l)).otherwise(few).alias(k), (F.size(l) >= FLOOR).alias(full))
    tau = F.when(F.col(full), low - 1).when(F.size(k) < FLOOR, F.lit(TOP)).otherwise(F.element_at(k, -1))
    return df.select(*kept, F.struct(F.greatest(tau, low - 1).alias("tau"), F.col(k).alias("hashes")).alias(out))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two sketches."""
    tau = F.least(a["tau"], b["tau"])
    x, y = F.filter(a["hashes"], lambda h: h <= tau), F.filter(b["hashes"], lambda h: h <= tau)
    both = F.size(F.array_intersect(x, y))
    either = F.size(x) + F.size(y) - both
    empty = (F.size(a["hashes"]) == 0) & (F.size(b["hashes"]) == 0)
    return F.when(empty, F.lit(1.0)).when(either == 0, F.lit(0.0)).otherwise(both / F.when(either > 0, either))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has too."""
    tau = F.least(a["tau"], b["tau"])
    x, y = F.filter(a["hashes"], lambda h: h <= tau), F.filter(b["hashes"], lambda h: h <= tau)
    return F.when(F.size(x) > 0, F.size(F.array_intersect(x, y)) / F.size(x)).otherwise(F.lit(0.0))


def merged(a: Column, b: Column) -> Column:
    """The sketch of the union of two documents' shingles."""
    tau = F.least(a["tau"], b["tau"])
    return F.struct(tau.alias("tau"), F.sort_array(F.filter(F.array_union(a["hashes"], b["hashes"]), lambda h: h <= tau)).alias("hashes"))


def as_string(sketch: Column) -> Column:
    """tau and the hashes, eight letters of base 64 each."""
    letters = lambda h: F.base64(F.unhex(F.lpad(F.hex(h), 12, "0")))
    return F.concat(letters(sketch["tau"]), F.lit(":"), F.array_join(F.transform(sketch["hashes"], letters), ""))


def _bounds(docs: DataFrame) -> list[tuple[int | None, int]]:
    """The lowest (doc_id, digest) of each of a fixed number of ranges with about as many rows; the number does not follow the data."""
    n = 4 * width(docs.sparkSession)
    keys = docs.select("doc_id", F.xxhash64("text").alias("digest")).repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "digest")
    lows = keys.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("doc_id", "digest")).alias("low")).select("low.*").collect()
    return sorted({tuple(r) for r in lows}, key=lambda x: (x[0] is not None, x))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text: the text of the next document by doc_id, and after the last that of the first.

    Texts are shuffled once. Ranges of (doc_id, digest) are the groups, so many rows of one id are spread too; the first
    row of each is also a guest at the end of the range before it, so no row needs another group."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bounds = _bounds(docs)
    n = max(1, len(bounds))
    lows = F.array(*[F.struct(F.lit(i).cast("bigint").alias("doc_id"), F.lit(d).cast("bigint").alias("digest")) for i, d in bounds]) if bounds else F.array().cast("array<struct<doc_id:bigint,digest:bigint>>")
    docs = docs.withColumn("key", F.struct("doc_id", F.xxhash64("text").alias("digest"))).withColumn("lows", lows)
    docs = docs.withColumn("range", F.greatest(F.lit(0), F.size(F.filter("lows", lambda low: low <= F.col("key"))) - 1))
    first = F.col("key").eqNullSafe(F.get("lows", F.col("range")))
    here = F.struct(F.col("range").alias("k"), F.lit(0).alias("guest"))
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(n)).alias("k"), F.lit(1).alias("guest"))
    rows = docs.withColumn("at", F.explode(F.when(first, F.array(here, before)).otherwise(F.array(here))))
    return rows.select("doc_id", "text", "key", F.col("at.k").alias("range"), F.col("at.guest").alias("guest")).repartition(n, "range")


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_sketch(with_next(table(spark, sf_dir, "documents")), "text", "_f")
    w = Window.partitionBy("range").orderBy("guest", "key")
    rows = rows.select("*", F.lead("text").over(w).alias("_next"), F.lead("_f").over(w).alias("_nf")).where("guest = 0")
    n = F.char_length("text").cast("int")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("_next", F.lit(1), cut))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("_e"), "_f", "_nf")
    rows = with_sketch(rows.withColumn("edited_sha256", F.sha2("_e", 256)), "_e", "_ef")
    return rows.select("doc_id", "n_chars", "edited_sha256", as_string(F.col("_f")).alias("fingerprint"), as_string(F.col("_ef")).alias("edited_fingerprint"), likeness(F.col("_f"), F.col("_ef")).alias("near_edited"), likeness(F.col("_f"), F.col("_nf")).alias("near_next"))
