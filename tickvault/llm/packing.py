"""Packing documents into sequences, shortest pack first over the histogram of lengths.

Documents are cut at multiples of the sequence length, so a full piece is a sequence of its own and each document adds
one shorter piece at most. The histogram of piece lengths, which has as many bins as the sequence length whatever the
corpus, is packed on the driver: longest lengths first, each into the patterns with the most room, whose counts are
updated. The patterns become slots (length, ranks from-to -> sequence, offset), and pieces meet their slots by their
rank among pieces of the same length. No ids are shuffled, only one small row a piece.

Defined results: a null text is empty and packs its end id alone; repeated rows are documents of their own; columns
other than doc_id and text are not passed on.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickvault.llm.common import stored, table, width
from tickvault.llm.tokens import WIDE, encoder, mapped, texts

SEQUENCE = 2048
END_ID = 1

PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def pieces(docs: DataFrame, path: str | None = None, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """The pieces of each document: where they start, their length and the checksum of their ids."""
    end = end_id.to_bytes(WIDE, "little")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc, start, length, crc, total = [], [], [], [], []
        for doc_id, ids in zip(batch.column(0).to_pylist(), encoder(path).encode(texts(batch.column(1)))):
            ids += end
            n = len(ids) // WIDE
            for at in range(0, n, size):
                part = ids[at * WIDE : (at + size) * WIDE]
                doc.append(doc_id)
                start.append(at)
                length.append(len(part) // WIDE)
                crc.append(zlib.crc32(part))
                total.append(n)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (doc, start, length, crc, total)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(mapped(run), PIECE)


def patterns(histogram: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, tuple[int, ...]]]:
    """(how many packs, lengths in a pack): the longest lengths first, each to the packs with the most room."""
    room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    most = 0
    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        while n:
            while most > 0 and not room[most]:
                most -= 1
            if most < length:
                room[size - length].append((n, (length,)))
                most = max(most, size - length)
                break
            packs, lengths = room[most].pop()
            used = min(n, packs)
            if packs > used:
                room[most].append((packs - used, lengths))
            room[most - length].append((used, (*lengths, length)))
            n -= used
    return [p for free in sorted(room) for p in room[free]]


def slots(found: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, rank after the last, first sequence, offset)."""
    taken: dict[int, int] = defaultdict(int)
    out, first = [], 0
    for packs, lengths in found:
        offset = 0
        for length in lengths:
            out.append((length, taken[length], taken[length] + packs, first, offset))
            taken[length] += packs
            offset += length
        first += packs
    return out


def ranked(rows: DataFrame, key: str, order: list[str], out: str = "rank") -> DataFrame:
    """Adds the rank, from 0, among rows of the same key: within a shard by order, and before it the counts of lower shards. A key that holds a large share of the rows is spread over all shards."""
    n = 4 * width(rows.sparkSession)
    rows = rows.withColumn("_shard", F.pmod(F.xxhash64(*order), F.lit(n)).cast("int"))
    counts = rows.groupBy(key, "_shard").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(key).orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(F.col(key).alias("_key"), F.col("_shard").alias("_s"), before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy(key, "_shard").orderBy(*order)) - 1
    rows = rows.withColumn("_in", inside)
    return rows.join(counts, (rows[key] == counts["_key"]) & (rows["_shard"] == counts["_s"])).withColumn(out, F.col("_before") + F.col("_in")).drop("_shard", "_in", "_key", "_s", "_before")


def packed(rows: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Adds sequence_id and offset to pieces."""
    spark = rows.sparkSession
    rows = stored(rows, "pieces")
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `size` rows
    places = spark.createDataFrame(slots(patterns(histogram, size)), "s_length bigint, low bigint, high bigint, first bigint, offset bigint")
    order = [c for c in rows.columns if c != "length"]
    rows = ranked(rows, "length", order)
    met = rows.join(F.broadcast(places), (F.col("length") == F.col("s_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    return met.withColumn("sequence_id", F.col("first") + F.col("rank") - F.col("low")).drop("s_length", "low", "high", "first", "rank")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packed(pieces(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
