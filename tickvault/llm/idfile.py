"""Token ids in files of fixed-width bits.

A block holds the ids of some consecutive documents, each id in as many bits as the vocabulary needs:
`magic, version, bits, n_docs, n_ids, offsets of documents (n_docs + 1), bits of ids, least bit first`, integers in
little-endian order. Blocks are written as one binary column beside their index columns, in files that Spark commits
and any store can hold; the range of doc_ids of a block lets a reader skip it, and the offsets let it unpack a single
document. Documents go by ascending doc_id, over files too.

Defined results: a null text is empty and has its end id alone; repeated ids go by text; null ids come first; columns
other than doc_id and text are not written.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.llm.common import shared_dir, table, width
from tickvault.llm.tokens import WIDE, encoder, slices, texts

END_ID = 2
MAGIC = b"TVID"
HEADER = struct.Struct("<4sHHIQ")
#: A block is closed when it has as many ids.
BLOCK_IDS = 1 << 16
BLOCKS = "part int, block int, start bigint, n_ids bigint, low_doc bigint, high_doc bigint, doc_ids array<bigint>, payload binary"


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids, bits: int) -> bytes:
    """Each id in so many bits, least bit first."""
    import numpy as np

    if bits == 16:
        return ids.astype("<u2").tobytes()
    each = (ids.astype("<u4")[:, None] >> np.arange(bits, dtype="<u4")) & 1
    return np.packbits(each.astype("u1").ravel(), bitorder="little").tobytes()


def unpack(data, first: int, count: int, bits: int):
    """Ids from `first` on, without touching the bits before them."""
    import numpy as np

    if bits == 16:
        return np.frombuffer(data, "<u2", count, 2 * first).astype("<u4")
    low, high = first * bits // 8, -(-(first + count) * bits // 8)
    flat = np.unpackbits(np.frombuffer(data, "u1", high - low, low), bitorder="little")
    flat = flat[first * bits - 8 * low :][: count * bits].reshape(count, bits)
    return (flat.astype("<u4") << np.arange(bits, dtype="<u4")).sum(axis=1, dtype="<u4")


def block(documents: list, bits: int) -> bytes:
    import numpy as np

    sizes = np.array([len(d) for d in documents], "<u8")
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("<u8")
    ids = np.concatenate(documents)
    return HEADER.pack(MAGIC, 1, bits, len(documents), len(ids)) + offsets.tobytes() + pack(ids, bits)


def opened(payload: bytes):
    """(bits, offsets, bytes of the ids) of a block."""
    import numpy as np

    magic, version, bits, n_docs, _ = HEADER.unpack_from(payload)
    if magic != MAGIC or version != 1:
        raise ValueError("not a block of ids")
    at = HEADER.size + 8 * (n_docs + 1)
    return bits, np.frombuffer(payload, "<u8", n_docs + 1, HEADER.size), memoryview(payload)[at:]


def document(payload: bytes, k: int):
    """The ids of the k-th document of a block."""
    bits, offsets, data = opened(payload)
    return unpack(data, int(offsets[k]), int(offsets[k + 1] - offsets[k]), bits)


def write(docs: DataFrame, to: str, path: str | None = None, end_id: int = END_ID) -> None:
    """Texts are shuffled once, by ranges of doc_id; each task encodes its range in order and writes its blocks."""
    end = end_id.to_bytes(WIDE, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        bits = bits_for(encoder(path).tokenizer.get_vocab_size())
        names, held, n_held, start, number = [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            row = {"part": part, "block": number, "start": start, "n_ids": n_held, "low_doc": min((d for d in names if d is not None), default=None), "high_doc": max((d for d in names if d is not None), default=None), "doc_ids": names, "payload": block(held, bits)}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()), ("low_doc", pa.int64()), ("high_doc", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("payload", pa.binary())])
        for batch in slices(batches):
            for doc_id, raw in zip(batch.column(0).to_pylist(), encoder(path).encode(texts(batch.column(1)))):
                names.append(doc_id)
                held.append(np.frombuffer(raw + end, "<u4"))
                n_held += len(held[-1])
                if n_held >= BLOCK_IDS:
                    yield close()
                    names, held, start, n_held, number = [], [], start + n_held, 0, number + 1
        if names:
            yield close()

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    order = (F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    rows = rows.repartitionByRange(width(docs.sparkSession), F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(order[0], F.xxhash64("text"), order[1])
    rows.mapInArrow(run, BLOCKS).write.parquet(to)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids before the document), n_tokens, ids_crc32, ids, from files of blocks."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    totals = sorted((r["part"], r["n"]) for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())  # a row a file
    bases, at = [], 0
    for part, n in totals:
        bases.append((part, at))
        at += n
    based = spark.createDataFrame(bases, "part int, base bigint")
    blocks = blocks.join(F.broadcast(based), "part").select((F.col("base") + F.col("start")).alias("start"), "doc_ids", "payload")
    return blocks.mapInArrow(_unpacked, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, names, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
            bits, offsets, data = opened(payload)
            ids = unpack(data, 0, int(offsets[-1]), bits).tobytes()
            cuts = offsets.tolist()
            raw = [ids[WIDE * a : WIDE * b] for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array([first + c for c in cuts[:-1]], pa.int64()), pa.array([b - a for a, b in zip(cuts, cuts[1:])], pa.int64()), pa.array(map(zlib.crc32, raw), pa.int64()), pa.array(raw, pa.binary())], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])


def lookup(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of one document (of each row with that id), from the blocks whose range can hold it."""
    near = spark.read.schema(BLOCKS).parquet(path).where((F.col("low_doc") <= doc_id) & (F.col("high_doc") >= doc_id))
    found = near.where(F.array_contains("doc_ids", F.lit(doc_id).cast("long"))).orderBy("part", "block").select("doc_ids", "payload")
    return [document(r["payload"], k).tolist() for r in found.toLocalIterator() for k, d in enumerate(r["doc_ids"]) if d == doc_id]


def op9_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    to = f"{shared_dir(spark)}/ids-{uuid.uuid4().hex}"
    write(table(spark, sf_dir, "documents"), to)
    return read(spark, to).select("doc_id", "start", "n_tokens", "ids_crc32")
