"""Substring dedup by repeated-phrase automata.

A window of WINDOW consecutive words is removed where the same words start earlier (a smaller doc_id, or the same
document before). Every window is known by its anchor: the run of ANCHOR words with the least hash in it, so equal
windows have equal anchors. Consecutive windows with one anchor form a span, of up to 2 * WINDOW - ANCHOR words.

1. Documents are dealt to shards of about SHARD_BYTES. Each shard tells its distinct spans, with their first place and
   their number there.
2. Spans that occur twice or more are recurring passages; that their words are the same is confirmed by two hashes of
   64 bits over all of them that have nothing in common but the hashes of single words. Where spans differ but share an
   anchor, their single windows are compared too: those that occur twice or more are recurring passages as well.
3. Each shard compiles the passages that its documents hold, two letters a word, into an Aho-Corasick automaton, and streams
   its documents through it. Every occurrence that starts after the passage's first place is cut out.

A span whose words stand at an earlier place too has all its windows there; a window that repeats has an equal span,
or shares an anchor with a different one. So the occurrences cover the windows in question, and no others. No row is
made for each pair of occurrences, and a passage sends one row a shard at most. Spans of an anchor that is common in
one of the shards travel by their own hash, and all their windows are compared.

Defined results: a null text has no words, an empty table gives no rows; rows with one doc_id are documents that follow
each other by text, and equal rows of them are cut like any other copies; null ids come before all others. A very long
text is one row of its shard. Other columns are
passed on in the struct `row` if asked for, whatever their names.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tickvault.llm.common import DIGESTS, measured, shards, table, width
from tickvault.llm.graph import hot_keys

WINDOW, ANCHOR = 20, 8
ROW = 1 << 32
LEAST = -(1 << 63)
#: Odd multipliers of the two running hashes.
BASE, OTHER_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
#: Text bytes of a shard.
SHARD_BYTES = 16 << 20

SPANS = "anchor bigint, span bigint, again bigint, shard int, doc bigint, at bigint, n_windows int, n int"
WINDOWS = "phrase bigint, again bigint, shard int, doc bigint, at bigint, n int"


class Shard:
    """Documents of a shard in their order, as words and as running hashes over all words in turn."""

    def __init__(self, docs: pa.Table):
        ids, texts = docs.column("doc_id").to_pylist(), docs.column("text").to_pylist()
        self.order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, texts[i] or ""))
        self.words = [(texts[i] or "").encode().split() for i in self.order]
        self.doc = [LEAST if ids[i] is None else ids[i] for i in self.order]
        self.nth = [0] * len(ids)
        for k in range(1, len(ids)):
            if self.doc[k] == self.doc[k - 1]:
                self.nth[k] = self.nth[k - 1] + 1
        self.index = {(d, n): k for k, (d, n) in enumerate(zip(self.doc, self.nth))}

    def hashed(self) -> None:
        import numpy as np

        self.sizes = np.array([len(w) for w in self.words], "i8")
        self.begin = np.concatenate([[0], np.cumsum(self.sizes)])
        values = np.empty(int(self.begin[-1]), "u8")
        for k, words in enumerate(self.words):
            values[self.begin[k] : self.begin[k + 1]] = DIGESTS.of(words)
        self.running = {}
        for base in (BASE, OTHER_BASE):
            power, inverse = (np.full(len(values) + 1, x, "u8") for x in (base, pow(base, -1, 1 << 64)))
            power[0] = inverse[0] = 1
            np.multiply.accumulate(power, out=power)
            np.multiply.accumulate(inverse, out=inverse)
            if base == OTHER_BASE:
                values = values ^ (values >> np.uint64(29)) * np.uint64(0x94D049BB133111EB)
            self.running[base] = np.concatenate([np.zeros(1, "u8"), np.cumsum(values * power[:-1], dtype="u8")]), inverse

    def digest(self, start, end, base: int = BASE):
        """Hashes of the words from start to before end."""
        import numpy as np

        total, inverse = self.running[base]
        h = (total[end] - total[start]) * inverse[start]
        h ^= (end - start).astype("u8") * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        h *= np.uint64(base)
        return h ^ (h >> np.uint64(32))

    def places(self, at):
        """(doc, place) of words by their number in the shard."""
        import numpy as np

        k = np.searchsorted(self.begin, at, "right") - 1
        return np.array(self.doc, "i8")[k], np.array(self.nth, "i8")[k] * ROW + at - self.begin[k]


def _spans(key: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
    import numpy as np

    schema = pa.schema([("anchor", pa.int64()), ("span", pa.int64()), ("again", pa.int64()), ("shard", pa.int32()), ("doc", pa.int64()), ("at", pa.int64()), ("n_windows", pa.int32()), ("n", pa.int32())])
    shard = Shard(docs)
    shard.hashed()
    n = int(shard.begin[-1])
    whole = np.flatnonzero(shard.sizes >= WINDOW)
    if not len(whole):
        return schema.empty_table()
    runs = np.arange(n - ANCHOR + 1)
    least = shard.digest(runs, runs + ANCHOR)
    view = np.lib.stride_tricks.sliding_window_view(least, WINDOW - ANCHOR + 1)
    anchor = np.arange(len(view)) + np.concatenate([view[i : i + 100_000].argmin(axis=1) for i in range(0, len(view), 100_000)])
    inside = np.zeros(len(view), bool)
    for k in whole:
        inside[shard.begin[k] : shard.begin[k + 1] - WINDOW + 1] = True
    new = np.ones(len(view), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    windows = np.flatnonzero(inside)
    starts = np.flatnonzero(new[windows])
    first, last = windows[starts], windows[np.append(starts[1:], len(windows)) - 1]
    span = shard.digest(first, last + WINDOW)
    _, at, count = np.unique(span, return_index=True, return_counts=True)
    doc, place = shard.places(first[at])
    again = shard.digest(first[at], (last + WINDOW)[at], OTHER_BASE)
    cols = [least[anchor[first[at]]].view("i8"), span[at].view("i8"), again.view("i8"), np.full(len(at), key[0].as_py(), "i4"), doc, place, (last - first + 1)[at].astype("i4"), count.astype("i4")]
    return pa.Table.from_arrays([pa.array(c) for c in cols], schema=schema)


def _windows(key: tuple[pa.Scalar, ...], docs: pa.Table, asked: pa.Table) -> pa.Table:
    """Single windows of the spans asked for."""
    import numpy as np

    schema = pa.schema([("phrase", pa.int64()), ("again", pa.int64()), ("shard", pa.int32()), ("doc", pa.int64()), ("at", pa.int64()), ("n", pa.int32())])
    if not asked.num_rows:
        return schema.empty_table()
    shard = Shard(docs)
    shard.hashed()
    starts = []
    for doc, at, n in zip(*(asked.column(c).to_pylist() for c in ("doc", "at", "n_windows"))):
        begin = int(shard.begin[shard.index[doc, at // ROW]]) + at % ROW
        starts.append(np.arange(begin, begin + n))
    start = np.unique(np.concatenate(starts))
    phrase = shard.digest(start, start + WINDOW)
    _, at, count = np.unique(phrase, return_index=True, return_counts=True)
    doc, place = shard.places(start[at])
    again = shard.digest(start[at], start[at] + WINDOW, OTHER_BASE)
    cols = [phrase[at].view("i8"), again.view("i8"), np.full(len(at), key[0].as_py(), "i4"), doc, place, count.astype("i4")]
    return pa.Table.from_arrays([pa.array(c) for c in cols], schema=schema)


UNKNOWN = "\0\0"


def _spelling(words: set[bytes]) -> dict[bytes, str]:
    """Two letters for each word, the second from another alphabet, so that phrases match at the border of words only. A node of the automaton looks through its edges one by one, so alphabets are as small as two letters allow."""
    base = math.isqrt(len(words)) + 1
    letters = [chr(1 + i + 0x800 * (i >= 0xD7FF)) for i in range(2 * base)]
    return {w: letters[i // base] + letters[base + i % base] for i, w in enumerate(words)}


def _cut(carry: bool):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, passages: pa.Table) -> pa.Table:
        import ahocorasick

        shard = Shard(docs)
        removed = [None] * len(shard.words)
        if passages.num_rows:
            told = list(zip(*(passages.column(c).to_pylist() for c in ("doc", "at", "n_words", "first_doc", "first_at"))))
            places = [(shard.index[doc, at // ROW], at % ROW, n, (first_doc, first_at)) for doc, at, n, first_doc, first_at in told]
            spell = _spelling({w for k in {p[0] for p in places} for w in shard.words[k]})
            spelt = {k: [spell[w] for w in shard.words[k]] for k in {p[0] for p in places}}
            automaton = ahocorasick.Automaton()
            for k, start, n, first in places:
                phrase = "".join(spelt[k][start : start + n])
                known = automaton.get(phrase, None)
                if known is None or first < known[1]:
                    automaton.add_word(phrase, (n, first))
            automaton.make_automaton()
            for k, words in enumerate(shard.words):
                if len(words) < WINDOW:
                    continue
                doc, row, gone = shard.doc[k], shard.nth[k] * ROW, None
                for end, (n, first) in automaton.iter("".join(spelt[k] if k in spelt else [spell.get(w, UNKNOWN) for w in words])):
                    end = end // 2 + 1
                    if (doc, row + end - n) > first:
                        gone = gone or bytearray(len(words))
                        gone[end - n : end] = b"\1" * n
                removed[k] = gone
        kept = [b" ".join(words if gone is None else [w for w, g in zip(words, gone) if not g]).decode() for words, gone in zip(shard.words, removed)]
        back = docs.take(pa.array(shard.order, pa.int64()))
        cols = {"row": back.column("row"), "text": back.column("text")} if carry else {}
        cols |= {"doc_id": back.column("doc_id"), "n_words": pa.array(map(len, shard.words), pa.int64()), "n_removed": pa.array([sum(g) if g else 0 for g in removed], pa.int64()), "kept": pa.array(kept, pa.string())}
        return pa.table(cols)

    return run


def deduplicated(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, and kept: the words that stay, joined by one space; with `carry` also `text` as it came, and `row`, the struct of all other columns."""
    spark, ids = docs.sparkSession, F.col("doc_id").cast("bigint")
    n_shards = shards(spark, measured(docs)[0], SHARD_BYTES)
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")] if carry else []
    rows = docs.select(F.pmod(F.xxhash64(ids), F.lit(n_shards)).cast("int").alias("shard"), ids.alias("doc_id"), F.col("text"), *row)
    parts = rows.groupBy("shard")

    # anchors that are common in the documents of one shard travel by their spans; it does not matter which they are
    some = rows.where("shard = 0").groupBy("shard").applyInArrow(_spans, SPANS)
    hot = hot_keys(some, "anchor", n_shards)
    common = F.col("anchor").isin(hot) if hot else F.lit(False)
    spans = parts.applyInArrow(_spans, SPANS).withColumn("common", common).withColumn("deal", F.when(common, F.xxhash64("anchor", "span")).otherwise(F.col("anchor")))
    spans = spans.repartition(width(spark), "deal")
    same_anchor, same_span = Window.partitionBy("deal"), Window.partitionBy("deal", "span", "again")
    spans = spans.select("*", F.sum("n").over(same_span).alias("n_same"), *_first(same_span.orderBy("doc", "at")))
    differ = F.col("common") | (F.min("span").over(same_anchor) != F.max("span").over(same_anchor)) | (F.min("again").over(same_anchor) != F.max("again").over(same_anchor))
    spans = spans.select("*", F.sum("n").over(same_anchor).alias("n_anchor"), differ.alias("differ")).where("common or n_anchor > 1")
    passages = spans.where("n_same > 1").where(LATER).select("shard", "doc", "at", (F.col("n_windows") + WINDOW - 1).alias("n_words"), "first_doc", "first_at")
    asked = spans.where("differ and doc = first_doc and at = first_at").select("shard", "doc", "at", "n_windows")

    same_phrase = Window.partitionBy("phrase", "again")
    phrases = parts.cogroup(asked.groupBy("shard")).applyInArrow(_windows, WINDOWS)
    phrases = phrases.select("*", F.sum("n").over(same_phrase).alias("n_same"), *_first(same_phrase.orderBy("doc", "at"))).where("n_same > 1").where(LATER)
    passages = passages.unionByName(phrases.select("shard", "doc", "at", F.lit(WINDOW).alias("n_words"), "first_doc", "first_at"))

    made = [StructField("doc_id", LongType()), StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType())]
    schema = StructType([rows.schema["row"], rows.schema["text"], *made] if carry else made)
    return parts.cogroup(passages.groupBy("shard")).applyInArrow(_cut(carry), schema)


#: A shard that has a passage at its first place only has nothing to cut for it.
LATER = "not (n = 1 and doc = first_doc and at = first_at)"


def _first(w):
    return F.first("doc").over(w).alias("first_doc"), F.first("at").over(w).alias("first_at")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = deduplicated(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
