"""LM scoring with a log-frequency Bloom filter.

Every bigram of the training documents goes into a Bloom filter, once for each level of its quantised count; a count is
read back by probing level after level until one is missing. The filter is cut into slices by the first word of a
bigram, each sized by its entries, whatever the corpus. A slice is built, asked and dropped by one task: no process ever
holds the whole filter, and nothing that grows with the corpus is broadcast. Each shard of documents sends its distinct
words and bigrams to their slices, and the slices send levels, counts and what each word's bigrams add up to back.

    P(w | p) = max(q(p, w) - D, 0) / c(p) + (1 - S(p) / c(p)) * P1(w),   S(p) = sum over w of max(q(p, w) - D, 0)
    P1(w)    = (c(w) + 1) / (N + V + 1)

q is the quantised count, D the discount; where c(p) is 0 it is P1 alone. The probabilities that follow a word add up to
one, but for bigrams that the filter makes up. Single words are counted exactly, in the same exchange.

Words that start more than their share of the bigrams have them dealt to all slices by both words; which words
these are comes from a sample of at most SAMPLE documents. It only says where a bigram is counted, so scores do not
depend on the cluster: sample and slices follow the data alone, and shards do not matter.

Defined results: a null text is empty and has its end token only; an empty table gives no rows; rows with null ids are
training documents; repeated rows count each; a very long text is one row of its shard; columns other than doc_id, text
and held_out are not passed on, whatever their names.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.llm.common import DIGESTS, measured, shards, stored, table

BITS_AN_ENTRY, PROBES = 16, 4
#: The discount, and the parts of one that discounted counts are whole in.
DISCOUNT, QUARTERS = 0.75, 4
#: Text bytes of a shard; bigram entries for one slice are about as many as for one shard.
SHARD_BYTES = 16 << 20
#: A word is heavy if it starts more bigrams of the sample than four slices have on average; there are HEAVY such words at most. Rows of the sample.
HEAVY, SAMPLE = 1 << 16, 4096
#: Bytes of the hash of a bigram's second word; its first has eight.
SECOND = 6
END = 0x5EED0F7E47E4D000
MIX, STEP = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def tokens(texts: list[str | None]):
    """(hashes of the tokens of all texts in turn, each text's end included; number of tokens of each)."""
    import numpy as np

    out, sizes, end = [], [], np.array([END], "u8")
    for text in texts:
        words = (text or "").encode().lower().split()
        out.append(DIGESTS.of(words))
        out.append(end)
        sizes.append(len(words) + 1)
    return (np.concatenate(out) if out else np.empty(0, "u8")), np.array(sizes, "i8")


def mixed(first, second):
    """A hash of each pair of words."""
    import numpy as np

    h = (first * np.uint64(MIX)) ^ (second + (first >> np.uint64(31)))
    h ^= h >> np.uint64(30)
    h *= np.uint64(STEP)
    return h ^ (h >> np.uint64(31))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def level(counts):
    """Quantised counts: two levels for each doubling."""
    import numpy as np

    return np.where(counts > 0, 1 + np.floor(2 * np.log2(np.maximum(counts, 1)) + 1e-9), 0).astype("i8")


def count_of(levels):
    """The least whole count of a level; 0 of none."""
    import numpy as np

    return np.where(levels > 0, np.ceil(2.0 ** ((levels - 1) / 2) - 1e-9), 0.0)


def _at(keys, which, probe, bits):
    import numpy as np

    x = keys * np.uint64(MIX) + np.uint64((which * 0x9E37 + probe) * STEP & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(33)
    x *= np.uint64(MIX)
    x ^= x >> np.uint64(29)
    return x & (bits - np.uint64(1))


class Filter:
    """Quantised counts of 64-bit keys: a key is in it once for each of its levels. Its size follows its entries."""

    def __init__(self, data: bytes):
        import numpy as np

        self.data = np.frombuffer(data, "u1")
        self.bits = np.uint64(8 * len(self.data))

    @classmethod
    def of(cls, keys, counts) -> Filter:
        import numpy as np

        levels = level(counts)
        want = max(64, int(levels.sum()) * BITS_AN_ENTRY)
        data = np.zeros(1 << (want - 1).bit_length(), bool)
        for which in range(1, int(levels.max(initial=0)) + 1):
            here = keys[levels >= which]
            for probe in range(PROBES):
                data[_at(here, which, probe, np.uint64(len(data)))] = True
        return cls(np.packbits(data, bitorder="little").tobytes())

    def levels(self, keys):
        """Levels of keys, from 1; 0 where the first is missing."""
        import numpy as np

        found, alive, which = np.zeros(len(keys), "i8"), np.arange(len(keys)), 0
        while len(alive):
            which += 1
            for probe in range(PROBES):
                at = _at(keys[alive], which, probe, self.bits)
                alive = alive[(self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype("u1")) & 1 == 1]
            found[alive] = which
            if which >= 128:
                break
        return found


def discounted(levels):
    import numpy as np

    return np.maximum(count_of(levels) - DISCOUNT, 0)


def _short(hashes) -> bytes:
    import numpy as np

    return np.ascontiguousarray(hashes.astype("<u8")).view("u1").reshape(-1, 8)[:, :SECOND].tobytes()


def _long(data: bytes):
    import numpy as np

    out = np.zeros((len(data) // SECOND, 8), "u1")
    out[:, :SECOND] = np.frombuffer(data, "u1").reshape(-1, SECOND)
    return out.view("<u8").ravel()


def _packed(counts, kind: str) -> tuple[bytes, bytes]:
    """Counts in a byte each, and those that do not fit beside."""
    import numpy as np

    return np.minimum(counts, 255).astype("u1").tobytes(), counts[counts >= 255].astype(kind).tobytes()


def _unpacked(few: bytes, many: bytes, kind: str):
    import numpy as np

    c = np.frombuffer(few, "u1").astype("i8")
    c[c == 255] = np.frombuffer(many, kind)
    return c


class Layout:
    """The distinct words and bigrams of a shard, in the order of their slices: the same when asking and when scoring."""

    def __init__(self, texts: list[str | None], shift: int, heavy: list[int]):
        import numpy as np

        self.values, self.sizes = tokens(texts)
        self.words, self.at = np.unique(self.values, return_inverse=True)
        inside = np.ones(len(self.values), bool)
        if len(inside):
            inside[np.concatenate([[0], np.cumsum(self.sizes)[:-1]])] = False
        self.inside = np.flatnonzero(inside)
        pairs, self.pair_at = np.unique(self.at[self.inside - 1] * len(self.words) + self.at[self.inside], return_inverse=True)
        self.first, self.second = np.divmod(pairs, max(1, len(self.words)))
        self.word_slice = (self.words >> np.uint64(shift)).astype("i8") if shift < 64 else np.zeros(len(self.words), "i8")
        self.pair_slice = self.word_slice[self.first]
        self.heavy = np.isin(self.words, np.array(heavy, "u8"))[self.first] if heavy else np.zeros(len(pairs), bool)
        if self.heavy.any():  # their bigrams come after the others of a slice
            h = mixed(self.words[self.first[self.heavy]], self.words[self.second[self.heavy]])
            self.pair_slice[self.heavy] = (h >> np.uint64(shift)).astype("i8") if shift < 64 else 0
            order = np.lexsort((self.heavy, self.pair_slice))
            back = np.empty_like(order)
            back[order] = np.arange(len(order))
            self.first, self.second, self.pair_slice, self.heavy, self.pair_at = self.first[order], self.second[order], self.pair_slice[order], self.heavy[order], back[self.pair_at]

    def counted(self, train):
        """How often training tokens have each word, and each bigram."""
        import numpy as np

        by_pair = self.pair_at[train[self.inside]]
        return np.bincount(self.at[train], minlength=len(self.words)), np.bincount(by_pair, minlength=len(self.first))


ASKED = "slice int, shard int, words binary, few_w binary, many_w binary, runs_few binary, runs_many binary, firsts binary, seconds binary, few binary, many binary, n bigint"
ANSWERED = "slice int, shard int, levels binary, few_w binary, many_w binary, few_s binary, many_s binary, heavy array<struct<word: bigint, sum: double>>, words bigint, n bigint"


def _arrow(rows: list[tuple], ddl: str) -> pa.Table:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<struct<word: bigint, sum: double>>": pa.list_(pa.struct([("word", pa.int64()), ("sum", pa.float64())]))}
    fields = [f.split(" ", 1) for f in ddl.replace(", sum:", "\0").split(", ")]
    fields = [(n, kinds[t.replace("\0", ", sum:")]) for n, t in fields]
    return pa.Table.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(fields)], schema=pa.schema(fields))


def _asked(log_slices: int, heavy: list[int]):
    """A row for each slice that a shard of documents needs: its words and their counts, and the bigrams by their first words, with how often training documents of the shard have each."""

    def run(key: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
        import numpy as np

        own = Layout(docs.column("text").to_pylist(), 64 - log_slices, heavy)
        train = np.repeat(~np.array(docs.column("held_out").to_pylist(), bool), own.sizes)
        count_w, count = own.counted(train)
        runs = np.bincount(own.first[~own.heavy], minlength=len(own.words))
        slices = np.union1d(own.word_slice, own.pair_slice)
        cut_w = np.searchsorted(own.word_slice, [slices, slices + 1])
        cut = np.searchsorted(own.pair_slice, [slices, slices + 1])
        rows = []
        for k, a_w, b_w, a, b in zip(slices.tolist(), *cut_w.tolist(), *cut.tolist()):
            w, p = slice(a_w, b_w), slice(a, b)
            rows.append((k, key[0].as_py(), own.words[w].tobytes(), *_packed(count_w[w], "<u4"), *_packed(runs[w], "<u4"), own.words[own.first[p][own.heavy[p]]].tobytes(), _short(own.words[own.second[p]]), *_packed(count[p], "<u4"), 0 if rows else int(train.sum())))
        return _arrow(rows, ASKED)

    return run


def _answered(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """For each shard that asks a slice, in the order in which it asked: levels of its bigrams by the slice's filter, counts of its words, and the sums of their discounted bigrams. The sums of heavy words are partial."""
    import numpy as np

    get = {n: rows.column(n).to_pylist() for n in rows.column_names}
    empty = [np.empty(0, "u8")]
    words = [np.frombuffer(b, "<u8") for b in get["words"]]
    count_w = np.concatenate([_unpacked(f, m, "<u4") for f, m in zip(get["few_w"], get["many_w"])])
    distinct_w, at_w = np.unique(np.concatenate(words), return_inverse=True)
    total_w = np.bincount(at_w, count_w, len(distinct_w)).astype("i8")
    firsts = [np.concatenate([np.repeat(w, _unpacked(f, m, "<u4")), np.frombuffer(h, "<u8")]) for w, f, m, h in zip(words, get["runs_few"], get["runs_many"], get["firsts"])]
    is_heavy = [np.arange(len(f)) >= len(f) - len(h) // 8 for f, h in zip(firsts, get["firsts"])]
    sizes = [len(f) for f in firsts]
    first, heavy = np.concatenate(empty + firsts), np.concatenate([np.empty(0, bool), *is_heavy])
    pair = mixed(first, np.concatenate(empty + [_long(b) for b in get["seconds"]]))
    keys, some, at = np.unique(pair, return_index=True, return_inverse=True)
    total = np.bincount(at, np.concatenate([_unpacked(f, m, "<u4") for f, m in zip(get["few"], get["many"])]), len(keys)).astype("i8")
    trained = total > 0
    model = Filter.of(keys[trained], total[trained])
    levels = model.levels(keys)
    worth = discounted(levels) * trained
    of = first[some]
    sums = np.zeros(len(distinct_w))
    if len(distinct_w):
        light = ~heavy[some]
        sums = np.bincount(np.searchsorted(distinct_w, of[light]), worth[light], len(distinct_w))
    own, where = np.unique(of[heavy[some]], return_inverse=True)
    partial = [{"word": w, "sum": s} for w, s in zip(own.view("i8").tolist(), np.bincount(where, worth[heavy[some]], len(own)).tolist())]
    cut, cut_w = np.cumsum(sizes)[:-1], np.cumsum([len(w) for w in words])[:-1]
    back = zip(get["shard"], np.split(levels.astype("u1")[at], cut), np.split(total_w[at_w], cut_w), np.split(np.rint(sums[at_w] * QUARTERS).astype("i8"), cut_w), get["n"])
    out = [(key[0].as_py(), shard, ls.tobytes(), *_packed(c, "<u8"), *_packed(s, "<u8"), [] if i else partial, 0 if i else int((total_w > 0).sum()), n) for i, (shard, ls, c, s, n) in enumerate(back)]
    return _arrow(out, ANSWERED)


def _scored(n_train: int, n_distinct: int, log_slices: int, heavy: dict[int, float]):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        import numpy as np

        own = Layout(docs.column("text").to_pylist(), 64 - log_slices, list(heavy))
        get = {n: answers.sort_by("slice").column(n).to_pylist() for n in ("levels", "few_w", "many_w", "few_s", "many_s")}
        worth = discounted(np.concatenate([np.empty(0, "u1"), *[np.frombuffer(b, "u1") for b in get["levels"]]]).astype("i8"))
        count = np.concatenate([np.empty(0, "i8"), *[_unpacked(f, m, "<u8") for f, m in zip(get["few_w"], get["many_w"])]])
        sums = np.concatenate([np.empty(0), *[_unpacked(f, m, "<u8") / QUARTERS for f, m in zip(get["few_s"], get["many_s"])]])
        for word, total in heavy.items():
            sums[own.words == np.uint64(word)] = total
        c = count[own.at]
        p = single = (c + 1) / (n_train + n_distinct + 1)
        if len(own.inside):
            before = own.at[own.inside - 1]
            seen = np.maximum(count[before], 1)
            left = np.where(count[before] > 0, 1 - sums[before] / seen, 1.0)
            told = np.where(count[before] > 0, np.minimum(worth[own.pair_at], seen) / seen, 0.0)
            p = single.copy()
            p[own.inside] = told + np.maximum(left, DISCOUNT / (seen + 1)) * single[own.inside]
        first = np.concatenate([[0], np.cumsum(own.sizes)[:-1]]) if len(own.sizes) else np.empty(0, "i8")
        add = lambda x: np.add.reduceat(x, first) if len(first) else np.empty(0)
        n = pa.array(np.full(len(own.sizes), n_train, "i8"))
        return pa.table({"doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": pa.array(own.sizes), "n_known": pa.array(add((c > 0).astype("i8")).astype("i8")), "train_tokens": n, "base_score": pa.array(add(np.log10(single)).astype("f8")), "score": pa.array(add(np.log10(p)).astype("f8"))})

    return run


SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _starts(batches):
    """(word, n): how many bigrams each word of a batch starts."""
    import numpy as np

    for batch in batches:
        values, sizes = tokens(batch.column(0).to_pylist())
        starts = np.ones(len(values), bool)
        starts[np.cumsum(sizes) - 1] = False
        words, n = np.unique(values[starts], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(words.view("i8")), pa.array(n.astype("i8"))], ["word", "n"])


def heavy_words(docs: DataFrame, rows: int, slices: int) -> list[int]:
    """Words that start more bigrams of a sample of about SAMPLE documents than four slices have on average, the most frequent HEAVY at most."""
    one_in = -(-max(rows, 1) // SAMPLE)
    some = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(one_in)) == 0).select("text").mapInArrow(_starts, "word bigint, n bigint")
    counts = stored(some.groupBy("word").agg(F.sum("n").alias("n")), "starts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return sorted(r["word"] & 0xFFFFFFFFFFFFFFFF for r in counts.where(F.col("n") * slices > 4 * total).orderBy(F.col("n").desc(), "word").limit(HEAVY).collect())


def scored(docs: DataFrame) -> DataFrame:
    """Scores (doc_id, text, held_out) rows by a model of those that are not held out."""
    total, rows = measured(docs)
    n_shards = shards(docs.sparkSession, total, SHARD_BYTES, 1)
    log_slices = max(8, (total // (2 * SHARD_BYTES)).bit_length())
    heavy = heavy_words(docs, rows, 1 << log_slices)
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_shards)).cast("int").alias("shard")
    parts = docs.select(shard, "doc_id", "text", "held_out").groupBy("shard")
    answers = stored(parts.applyInArrow(_asked(log_slices, heavy), ASKED).groupBy("slice").applyInArrow(_answered, ANSWERED), "answers")
    n_train, n_distinct = answers.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    sums = dict.fromkeys(heavy, 0.0)
    if heavy:
        sums |= {r["word"] & 0xFFFFFFFFFFFFFFFF: r["sum"] for r in answers.select(F.inline("heavy")).groupBy("word").agg(F.sum("sum").alias("sum")).collect()}  # HEAVY rows at most
    answers = answers.select("shard", "slice", "levels", "few_w", "many_w", "few_s", "many_s")
    return parts.cogroup(answers.groupBy("shard")).applyInArrow(_scored(n_train, n_distinct, log_slices, sums), SCORED)


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return scored(docs.withColumn("held_out", held_out(F.col("doc_id"))))
