"""N-gram Jaccard join: a size-aware heavy-light join over sets of four-word shingles.

Texts are lower-cased in A-Z and cut into words; a set holds the distinct shingles, hashed to 64 bits. Sets link when
100 * intersection >= THRESHOLD * union. Equal sets are one set from the start (a `key`), however many documents have
them, so copies meet by hashing.

Light sets (small ones) enumerate subsets of the fixed sizes that a link with each possible partner size needs; sets
that share one are linked without further proof, through the smallest set that has the subset, which keeps all
connections in as many rows as there are subsets. Heavy sets (large ones) put their rarest shingles on inverted lists:
in any common order two linked sets share one of their first size - needed + 1 shingles, and the order here is by the
number of sets that have the shingle, so what many documents share comes last. The boundary is where the cost of
subsets passes that of lists, by the histogram of sizes.

The order is made twice: first from the shingles in three tenths of the hash space, which leaves the few sets that are
not mostly their own; then from all shingles of those. What lists connect is a cluster, and links lie inside clusters.

1. A cluster that fits into a block is scanned at once: all intersections of a block come from products of its incidence
   matrix, and only a spanning forest of the links leaves it. Larger clusters are dealt to blocks, each with the same
   few pivots, which joins a group of near copies without ever making its pairs.
2. In those, the lists are scanned that still hold sets of two components; each list is a block of its own. In a list
   that is too long, what is outside its largest component meets the whole list, block against block; where that would
   copy the list too often, it is cut finer first: by size, as linked sets have similar ones, then by a second and a
   third shingle, as linked sets share k of their first size - needed + k shingles. A cluster whose lists have more rows
   than its blocks would is scanned like one long list.

So sets meet only over what they share, and no link between components is missed. Shingles, lists, clusters and keys
that hold much of the rows are told apart by counts (of a sample where that is cheaper) and are not brought to one task.

Defined results: a text with one to three words has its whole sequence as its only shingle; a null, empty or blank text
has an empty set and no link; rows with one doc_id and different texts each count, with the id as their component's
candidate. Rows without an id link like others, but name no component: where no linked row has an id it is null. A very
long text is one set. An empty table gives no rows. Other columns are not passed on, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickvault.llm.common import DIGESTS, stored, table, width
from tickvault.llm.graph import components, hot_keys, matched, parted, salted
from tickvault.llm.tokens import slices

SHINGLE, THRESHOLD = 4, 85
#: Shingles with a hash below this are counted; three tenths of the space of signed 64-bit hashes.
COUNTED = -(1 << 63) + (1 << 64) * 3 // 10
#: Sets, and shingles, of a block; sets of a cluster that all its blocks hold.
BLOCK_SETS, BLOCK_SHINGLES, PIVOTS = 1024, 1 << 21, 24
#: Stands for the number of sets that have a hot shingle.
LAST = 1 << 40
#: How often a list is cut finer (by size, then by further shingles) that would be copied more often than COPIES times.
FINER, COPIES = 3, 16
#: One in so many sets tells which shingles and subsets are hot.
SAMPLED = 16
#: Parts of the hash of an id.
SIEVE = 1 << 20
#: Shingles that are multiplied at once.
COLUMNS = 4096
#: Cost of a shingle on an inverted list, and of proving a pair of sets, in subsets; sizes that may be light.
LIST_COST, PROOF_COST, LARGEST_LIGHT = 2.0, 8.0, 40


def needed(n: int, m: int) -> int:
    """The least intersection with which sets of these sizes link."""
    return -(-THRESHOLD * (n + m) // (100 + THRESHOLD))


def partners(n: int) -> range:
    """Sizes of sets that a set of size n can link with."""
    return range(-(-THRESHOLD * n // 100), 100 * n // THRESHOLD + 1)


def subset_sizes(n: int) -> list[int]:
    return sorted({needed(n, m) for m in partners(n) if needed(n, m) <= min(n, m)})


def prefix(n: int) -> int:
    return n - -(-THRESHOLD * n // 100) + 1


def boundary(histogram: dict[int, int]) -> int:
    """The largest light size, by cost; sizes over 0.85 of it are on lists too, for their larger partners."""

    def cost(x: int) -> float:
        light = sum(c * sum(comb(n, s) for s in subset_sizes(n)) for n, c in histogram.items() if n <= x)
        return light + sum(c * (LIST_COST * prefix(n) + PROOF_COST) for n, c in histogram.items() if 100 * n > THRESHOLD * x)

    return min(range(LARGEST_LIGHT + 1), key=cost)


def shingle_sets(texts: list[str | None]) -> list:
    """Sorted distinct shingle hashes of each text, as signed integers."""
    import numpy as np
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    out = []
    for text in texts:
        words = (text or "").encode().lower().split()
        if not words:
            out.append(np.empty(0, "i8"))
            continue
        if len(words) < SHINGLE:
            out.append(np.array([digest(b" ".join(words), len(words))], "u8").view("i8"))
            continue
        v = DIGESTS.of(words)
        h = np.zeros(len(v) - SHINGLE + 1, "u8")
        for k in range(SHINGLE):
            h = (h ^ v[k : k + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        out.append(np.unique(h.view("i8")))
    return out


def key_of(found) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(found.tobytes(), len(found)) - (1 << 63)


FOUND = "doc_id bigint, digest bigint, n_shingles bigint, key bigint, n_counted int, small array<bigint>, listed binary"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's set in short: its size and key; all shingles of a small set; the counted shingles, and as many
    others as a prefix may need, once for each key that the task meets."""
    import numpy as np

    done: set[int] = set()
    for batch in slices(batches, 500):
        sets = shingle_sets(batch.column(2).to_pylist())
        keys, counted, small, listed = [], [], [], []
        for s in sets:
            key = key_of(s) if len(s) else None
            new = key is not None and key not in done
            m = int(np.searchsorted(s, COUNTED))
            keys.append(key)
            counted.append(m)
            small.append(s if new and len(s) <= LARGEST_LIGHT else None)
            listed.append(s[: max(m, prefix(len(s)))].tobytes() if new else None)
            done.add(key)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(map(len, sets), pa.int64()), pa.array(keys, pa.int64()), pa.array(counted, pa.int32()), pa.array(small, pa.list_(pa.int64())), pa.array(listed, pa.binary())], ["doc_id", "digest", "n_shingles", "key", "n_counted", "small", "listed"])


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, shingle): a row for each shingle of (key, listed)."""
    import numpy as np

    for batch in slices(batches, 500):
        sets = [np.frombuffer(b, "i8") for b in batch.column(1).to_pylist()]
        keys = np.repeat(batch.column(0).to_numpy(), [len(s) for s in sets])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(np.concatenate(sets), pa.int64())], ["key", "shingle"])


def _subsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(subset, size, key, n): of light sets, the subsets of the sizes that links need."""
    from itertools import combinations

    import numpy as np
    import xxhash

    for batch in slices(batches, 500):
        out: list[tuple[int, int, int, int]] = []
        for key, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for size in subset_sizes(len(s)):
                out += [(xxhash.xxh3_64_intdigest(np.array(c, "i8").tobytes(), size) - (1 << 63), size, key, len(s)) for c in combinations(s, size)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int32()))], ["subset", "size", "key", "n"])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 500):
        sets = [s for s in shingle_sets(batch.column(0).to_pylist()) if len(s)]
        yield pa.RecordBatch.from_arrays([pa.array(map(key_of, sets), pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["key", "shingles"])


def intersections(left: list, right: list):
    """The sizes of the intersections of each set on the left with each on the right."""
    import numpy as np

    sets = [*left, *right]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[at] > 1
    owner, (distinct, at) = owner[shared], np.unique(at[shared], return_inverse=True)
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    total = np.zeros((len(left), len(right)), "f4")
    for low in range(0, len(distinct), COLUMNS):
        a, b = np.searchsorted(at, [low, low + COLUMNS])
        m = np.zeros((len(sets), min(COLUMNS, len(distinct) - low)), "f4")
        m[owner[a:b], at[a:b] - low] = 1
        total += m[: len(left)] @ m[len(left) :].T
    return total


def linked(left: list, right: list):
    import numpy as np

    same = intersections(left, right).astype("i8")
    n, m = np.array([len(s) for s in left], "i8"), np.array([len(s) for s in right], "i8")
    return 100 * same >= THRESHOLD * (n[:, None] + m[None, :] - same)


def forest(near, keys: list[int]) -> list[tuple[int, int]]:
    """(set, another of its component) for the sets of a block that have links: a tree for each component."""
    import numpy as np

    label = np.arange(len(keys))
    while True:
        new = np.minimum(label, np.where(near, label[None, :], len(keys)).min(axis=1))
        new = new[new]
        if (new == label).all():
            return [(keys[i], keys[j]) for i, j in enumerate(label.tolist()) if keys[i] != keys[j]]
        label = new


def searched(keys: tuple[list[int], list[int]], sets: tuple[list, list]) -> list[tuple[int, int]]:
    """The forest of a unit: of its only side, or of the links between its two sides."""
    import numpy as np

    if not sets[1]:
        return forest(linked(sets[0], sets[0]), keys[0])
    between = linked(*sets)
    near = np.zeros((len(keys[0]) + len(keys[1]),) * 2, bool)
    near[: len(keys[0]), len(keys[0]) :] = between
    near[len(keys[0]) :, : len(keys[0])] = between.T
    return forest(near, keys[0] + keys[1])


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): links that connect what is linked in each unit; the rows (unit, side, key, shingles) of a unit come together."""

    def made(edges: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*edges)], ["a", "b"])

    unit, out, keys, sets = None, [], ([], []), ([], [])
    for batch in batches:
        begin, flat = batch.column(3).offsets.to_numpy(), batch.column(3).values.to_numpy(zero_copy_only=False)
        for i, (u, side, key) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)))):
            if u != unit:
                out += searched(keys, sets) if sets[0] else []
                unit, keys, sets = u, ([], []), ([], [])
                if len(out) > 10_000:
                    yield made(out)
                    out = []
            keys[side].append(key)
            sets[side].append(flat[begin[i] : begin[i + 1]].copy())
    out += searched(keys, sets) if sets[0] else []
    if out:
        yield made(out)


def _scan(units: DataFrame) -> DataFrame:
    return units.select("unit", "side", "key", "shingles").repartition(width(units.sparkSession), "unit").sortWithinPartitions("unit").mapInArrow(_scanned, "a bigint, b bigint")


def _spread(n: Column) -> Column:
    return F.sequence(F.lit(0), n - 1)


def _room(n: Column) -> Column:
    """How many of a set's first shingles must be on lists."""
    return (n - F.ceil(F.lit(THRESHOLD) * n / 100) + 1).cast("int")


def _sampled(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SAMPLED)) == 0


def shared(rows: DataFrame, hot: list[int]) -> DataFrame:
    """Rows (shingle, key, ...) of shingles that two sets have or more, with their number `sets`; a (shingle, key) comes once.

    Hot shingles need no number: they come after all others, in any order that is the same for all sets."""
    by_shingle = lambda r: r.withColumn("sets", F.count("*").over(Window.partitionBy("shingle"))).where("sets > 1")
    deal = lambda r, *by: r.repartition(width(rows.sparkSession), *by).dropDuplicates(["shingle", "key"])
    if not hot:
        return by_shingle(deal(rows, "shingle"))
    others, many = parted(rows, "shingle", hot)
    return by_shingle(deal(others, "shingle")).unionByName(deal(many, "shingle", "key").withColumn("sets", F.lit(LAST).cast("bigint")))


def places(sets: DataFrame) -> DataFrame:
    """(key, n, room, places): the shingles of each set (key, shingles) that another has too, the rarest first, and how many of them linked sets must share one of."""
    rows = lambda some: some.select("key", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    found = shared(rows(sets), hot_keys(rows(sets.where(_sampled("key"))), "shingle", SAMPLED))
    # two flat arrays (filled by the same rows) take half the shuffle that an array of structs takes
    by_key = found.groupBy("key").agg(F.first("n").alias("n"), F.collect_list("sets").alias("sets"), F.collect_list("shingle").alias("shingle"))
    by_key = by_key.withColumn("places", F.sort_array(F.arrays_zip("sets", "shingle")))
    by_key = by_key.select("key", "n", (_room(F.col("n")) - (F.col("n") - F.size("places"))).alias("room"), F.transform("places", lambda p: p["shingle"]).alias("places"))
    return by_key.where("room > 0")


def light_links(found: DataFrame, light: int) -> DataFrame:
    small = found.where(F.col("small").isNotNull() & (F.col("n_shingles") <= light)).select("key", "small").dropDuplicates(["key"])
    made = lambda some: some.mapInArrow(_subsets, "subset bigint, size int, key bigint, n int")
    subsets, hot = made(small), hot_keys(made(small.where(_sampled("key"))), "subset", SAMPLED)
    least = subsets.groupBy("subset").agg(F.min(F.struct("n", "key")).alias("to"))  # a subset's hash tells its size
    need = F.ceil(F.lit(THRESHOLD) * (F.col("n") + F.col("to.n")) / (100 + THRESHOLD))
    return matched(subsets, "subset", least, hot, "inner").where((F.col("key") != F.col("to.key")) & (need <= F.col("size"))).select(F.col("key").alias("a"), F.col("to.key").alias("b")).distinct()


def candidates(docs: DataFrame, found: DataFrame, light: int) -> DataFrame:
    """(key, shingles): the sets that are not mostly their own, by the counted shingles."""
    listed = lambda some: some.select("key", "listed").mapInArrow(_listed, "key bigint, shingle bigint")
    heavy = found.where(F.col("listed").isNotNull() & (100 * F.col("n_shingles") > THRESHOLD * light))
    known = shared(listed(heavy), hot_keys(listed(heavy.where(_sampled("key"))), "shingle", SAMPLED))
    by_key = known.groupBy("key").agg(F.sum((F.col("shingle") < COUNTED).cast("int")).alias("shared"))
    sizes = found.where("key is not null").groupBy("key").agg(F.first("n_shingles").alias("n_shingles"), F.first("n_counted").alias("n_counted"), F.min(F.struct("doc_id", "digest")).alias("first"))
    by_key = stored(by_key.join(sizes, "key").where(_room(F.col("n_shingles")) > F.col("n_counted") - F.col("shared")).select("key", "first.*"), "keys")
    # a set's text is that of its first document, by id and digest; the text tells its key again
    first = by_key.select("doc_id", "digest").distinct()
    # most texts are left out before the shuffle, by a part of a hash: SIEVE rows are broadcast at most
    sieve = F.pmod(F.xxhash64("doc_id", "digest"), F.lit(SIEVE)).alias("part")
    some = docs.withColumn("part", sieve).join(F.broadcast(first.select(sieve).distinct()), "part", "left_semi")
    text = some.join(first, some["doc_id"].eqNullSafe(first["doc_id"]) & (some["digest"] == first["digest"]), "left_semi").select("text")
    return text.mapInArrow(_whole, "key bigint, shingles array<bigint>").dropDuplicates(["key"]).join(by_key.select("key"), "key", "left_semi")


def _finer(lists: DataFrame, by_key: DataFrame, step: int) -> DataFrame:
    """Lists (list, used, key, n) cut by size in step 0, then by one more shingle; a set is on more lists than before, and sets that link on one at least."""
    if step == 0:  # sizes of linked sets lie in the same band or in neighbouring ones
        band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / THRESHOLD))).cast("int")
        return lists.withColumn("band", F.explode(F.array(band, band + 1))).withColumn("list", F.col("list").bitwiseXOR(F.xxhash64(F.lit("band"), "band"))).drop("band")
    more = lists.join(by_key.select("key", F.slice("places", F.lit(1), F.col("room") + step).alias("places")), "key")
    more = more.withColumn("next", F.explode(F.array_except("places", "used")))
    more = more.withColumn("list", F.col("list").bitwiseXOR(F.xxhash64("next"))).withColumn("used", F.array_append("used", F.col("next")))
    return more.select(*lists.columns).dropDuplicates(["list", "key"])


def _told(lists: DataFrame, of: str) -> DataFrame:
    """(of, c, m, sig, main, o): sets and shingles of each list, a signature of its sets, its largest component, and the sets outside that."""
    mark = F.shiftrightunsigned(F.xxhash64("key"), 24)
    counts = lists.groupBy(of, "component").agg(F.count("*").alias("c"), F.sum("n").alias("m"), F.sum(mark).alias("sig"))
    told = counts.groupBy(of).agg(F.sum("c").alias("c"), F.sum("m").alias("m"), F.sum("sig").alias("sig"), F.max(F.struct("c", "component")).alias("main"))
    return told.select(of, "c", "m", "sig", F.col("main.component").alias("main"), (F.col("c") - F.col("main.c")).alias("o"))


def _blocks(n: Column) -> Column:
    return F.ceil(n / BLOCK_SETS).cast("int")


def _mixed(lists: DataFrame) -> DataFrame:
    """Lists that hold sets of two components, once where lists are the same, with `c`, `o`, `main`, and the `way` to scan each: as a block, block against block, or finer."""
    told = _told(lists, "list").where("o > 0")
    told = told.groupBy("c", "m", "sig").agg(F.min(F.struct("list", "main", "o")).alias("l")).select("l.*", "c", "m")
    fits = (F.col("c") <= BLOCK_SETS) & (F.col("m") <= BLOCK_SHINGLES)
    way = F.when(fits, "block").when(_blocks(F.col("o")) <= COPIES, "between").otherwise("finer")
    return salted(lists, "list", told.select("list", "main", "o", "c", way.alias("way")), "key")


def _between(lists: DataFrame) -> DataFrame:
    """Units (unit, side, key) of lists too long for a block: what is outside a list's largest component against the whole list, block by block."""
    rows = lists.select("list", "key", "component", "main", _blocks(F.col("o")).alias("o_blocks"), _blocks(F.col("c")).alias("n_blocks"))
    block = lambda seed, n: F.pmod(F.xxhash64("key", F.lit(seed)), F.col(n)).cast("int")
    outside = rows.where("component <> main").select("list", "key", block(2, "o_blocks").alias("o_block"), F.explode(_spread(F.col("n_blocks"))).alias("block"), F.lit(0).alias("side"))
    inside = rows.select("list", "key", F.explode(_spread(F.col("o_blocks"))).alias("o_block"), block(3, "n_blocks").alias("block"), F.lit(1).alias("side"))
    return outside.unionByName(inside).select(F.xxhash64("list", "block", "o_block").alias("unit"), "side", "key")


def heavy_links(sets: DataFrame) -> DataFrame:
    """(a, b): links between sets (key, shingles) that connect what links connect."""
    by_key = stored(places(sets), "places")
    lists = stored(by_key.select("key", "n", F.explode(F.slice("places", F.lit(1), F.col("room"))).alias("shingle")), "lists")
    least = lists.groupBy("shingle").agg(F.min("key").alias("b"))
    clusters = components(matched(lists, "shingle", least, hot_keys(lists, "shingle"), "inner").select(F.col("key").alias("a"), "b").distinct())
    rows = clusters.withColumnRenamed("id", "key").withColumnRenamed("component", "cluster").join(by_key.select("key", "n"), "key")
    sizes = rows.groupBy("cluster").agg(F.count("*").alias("c"), F.sum("n").alias("m"))
    sizes = sizes.withColumn("n_blocks", F.greatest(F.ceil(F.col("c") / BLOCK_SETS), F.ceil(F.col("m") / BLOCK_SHINGLES)).cast("int"))
    rows = stored(salted(rows, "cluster", sizes, "key"), "clusters")
    block = F.pmod(F.xxhash64("key"), F.col("n_blocks")).cast("int")
    pivot = (F.col("n_blocks") > 1) & (F.pmod(F.xxhash64("key", F.lit(1)), F.col("c")) < PIVOTS)
    units = rows.withColumn("block", F.explode(F.when(pivot, _spread(F.col("n_blocks"))).otherwise(F.array(block)))).join(sets, "key")
    proved = stored(_scan(units.withColumn("unit", F.xxhash64("cluster", "block")).withColumn("side", F.lit(0))), "links")
    large = rows.where("n_blocks > 1").select("key", "cluster", "n")
    if large.isEmpty():
        return proved
    large = stored(large.join(components(proved).withColumnRenamed("id", "key"), "key", "left").withColumn("component", F.coalesce("component", "key")), "large")
    rest = lists.drop("n").join(large, "key").select(F.xxhash64("shingle").alias("list"), F.array("shingle").alias("used"), "key", "n", "component", "cluster")
    rest = stored(_mixed(stored(rest, "lists")), "mixed")
    # a cluster is scanned block against block where that takes fewer rows than its lists
    cost = rest.groupBy("cluster").agg(F.count("*").alias("on_lists"))
    told = _told(large, "cluster").join(cost, "cluster").withColumn("in_blocks", F.col("c") * _blocks(F.col("o")) + F.col("o") * _blocks(F.col("c")) <= F.col("on_lists"))
    told = stored(told.select("cluster", "main", "c", "o", "in_blocks"), "told")
    units = _between(salted(large, "cluster", told.where("in_blocks").drop("in_blocks"), "key").withColumnRenamed("cluster", "list"))
    rest = salted(rest, "cluster", told.where("not in_blocks").select("cluster"), "key").drop("cluster")
    for step in range(FINER + 1):
        units = units.unionByName(rest.where("way = 'block'").select(F.col("list").alias("unit"), F.lit(0).alias("side"), "key"))
        between, rest = rest.where("way = 'between'"), rest.where("way = 'finer'")
        if step == FINER:
            between, rest = between.unionByName(rest), None
        units = units.unionByName(_between(between))
        if rest is None or rest.isEmpty():
            break
        rest = stored(_finer(rest.select("list", "used", "key", "n", "component"), by_key, step), "lists")
        rest = stored(_mixed(rest), "mixed")
    return proved.unionByName(stored(_scan(units.join(sets, "key")), "links"))


def clustered(docs: DataFrame) -> DataFrame:
    """doc_id, digest (of the text), n_shingles, key, component_id and stays: of each component's rows those with the least id, and of these the least digest, stay; so do all rows without a shingle."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("digest"), "text")
    found = stored(docs.mapInArrow(_sets, FOUND), "sets")
    sizes = found.where(F.col("small").isNotNull()).groupBy("n_shingles").agg(F.count("*").alias("c"))
    light = boundary({r["n_shingles"]: r["c"] for r in sizes.collect()})  # a row a size up to LARGEST_LIGHT
    sets = stored(candidates(docs, found, light), "candidates")
    labels = components(light_links(found, light).unionByName(heavy_links(sets)))
    keys = found.select("doc_id", "digest", "n_shingles", "key")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest"))
    named = keys.where("key is not null").groupBy("key").agg(least.alias("least")).join(labels.withColumnRenamed("id", "key"), "key", "left")
    named = stored(named.select("key", "least", F.coalesce("component", "key").alias("component")), "named")
    of = named.groupBy("component").agg(F.min("least").alias("first"))
    by_key = salted(named, "component", of, "key").select("key", "first")
    rows = matched(keys, "key", by_key, hot_keys(keys, "key"))
    stays = F.col("key").isNull() | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("digest") == F.col("first.digest")))
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.coalesce("first.doc_id", "doc_id"))
    return rows.select("doc_id", "digest", "n_shingles", "key", component.alias("component_id"), stays.alias("stays"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
