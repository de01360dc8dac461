"""Operators on small tables, with the faults that they must find."""

from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tickvault.operators import align, deletes, filters, lww, ordered, report, shard, sink, verify
from tickvault.streaming import lww as stream

POINT = "source_id string, kind string, shard_id int, generation int, sequence int, pos bigint, inst_id string, field string, time_ns bigint, payload string"


def points(spark, rows):
    return spark.createDataFrame(rows, POINT)


FRAGMENTS = [
    ("a", "tsm", 1, 1, 1, 0, "X", "f", 1, "old"), ("b", "tsm", 1, 2, 1, 0, "X", "f", 1, "higher generation"),
    ("a", "tsm", 1, 1, 1, 1, "X", "f", 2, "tsm"), ("w", "wal", 1, 0, 0, 0, "X", "f", 2, "log wins"),
    ("a", "tsm", 1, 9, 9, 2, "X", "f", 3, "lower shard"), ("c", "tsm", 2, 1, 1, 0, "X", "f", 3, "higher shard"),
    ("a", "tsm", 1, 1, 1, 3, "X", "f", 4, "first"), ("a", "tsm", 1, 1, 1, 4, "X", "f", 4, "last in source"),
    ("a", "tsm", 1, 1, 1, 5, "X", "f", 5, "seq 1"), ("d", "tsm", 1, 1, 2, 0, "X", "f", 5, "seq 2"),
]
WINNERS = {1: "higher generation", 2: "log wins", 3: "higher shard", 4: "last in source", 5: "seq 2"}


@pytest.mark.parametrize("form", ["max_by", "row_number"])
def test_last_write_wins_in_any_order(spark, form):
    for seed in range(5):
        rows = FRAGMENTS[:]
        random.Random(seed).shuffle(rows)
        assert {r.time_ns: r.payload for r in lww.latest_points(points(spark, rows), form).collect()} == WINNERS


def test_many_sources(spark):
    rows = [(f"src-{i:03d}", "tsm", i, 1, 1, 0, "X", "action", 1000 + i, f"value-{i:03d}") for i in range(41)]
    got = lww.latest_points(points(spark, rows)).orderBy("time_ns").collect()
    assert [r.payload for r in got] == [f"value-{i:03d}" for i in range(41)]


def test_wide_rows(spark):
    rows = points(spark, FRAGMENTS + [("a", "tsm", 1, 1, 1, 9, "X", "g", 2, "other"), ("a", "tsm", 1, 1, 1, 9, "Y", "g", 7, "alone")])
    got = {(r.inst_id, r.time_ns): (r.f, r.g) for r in align.wide(rows, ["inst_id", "time_ns"], "field", {"f": F.col("payload"), "g": F.col("payload")}, lww.source_order()).collect()}
    assert got == {("X", t): (v, "other" if t == 2 else None) for t, v in WINNERS.items()} | {("Y", 7): (None, "alone")}


def test_tombstones_of_their_own_source(spark):
    rows = spark.createDataFrame([("a", "s", "f", t) for t in range(5)] + [("b", "s", "f", 2)], "source_id string, series string, field string, time_ns bigint")
    tombs = spark.createDataFrame([("a", "s", "f", 1, 3)], "source_id string, series string, field string, min_time bigint, max_time bigint")
    assert {(r.source_id, r.time_ns) for r in deletes.without_tombstones(rows, tombs).collect()} == {("a", 0), ("a", 4), ("b", 2)}


def test_deletes_of_a_log(spark):
    writes = spark.createDataFrame([("k", 1, 10, 1), ("k", 2, 20, 1), ("k", 1, 11, 5), ("j", 1, 1, 1)], "key string, time_ns bigint, v bigint, seq bigint")
    dels = spark.createDataFrame([("k", 3, 1, 1), ("j", 0, None, None)], "key string, seq bigint, min_time bigint, max_time bigint")
    assert {(r.key, r.v) for r in deletes.without_later_deletes(writes, dels, ["key"]).collect()} == {("k", 20), ("k", 11), ("j", 1)}


def test_numbers_and_comparisons(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(5)
    assert ordered.numbered(df, ["x"]).where("x <> row_no").count() == 0
    parts = ordered.parts(df, ["x"], 300).groupBy("part_no").count().orderBy("part_no").collect()
    assert [r["count"] for r in parts] == [300, 300, 300, 100]
    assert ordered.compare_by_position(df, df, ["x"], ["x"]).first()[2] is None
    assert tuple(ordered.compare_by_position(df, df.where("x <> 500"), ["x"], ["x"]).first()) == (1000, 999, 500)
    assert ordered.random_ranks(10, 3, 1) == ordered.random_ranks(10, 3, 1) and {0, 5, 9} <= set(ordered.random_ranks(10, 3, 1)) and ordered.random_ranks(0, 3, 1) == []


def test_faults_of_a_merge(spark):
    sources = points(spark, FRAGMENTS)
    merged = lww.latest_points(sources)
    assert verify.merge_faults(sources, merged).count() == 0
    assert {r.state for r in verify.merge_faults(sources, merged.where("time_ns <> 1")).collect()} == {"old_only"}
    assert {r.state for r in verify.merge_faults(sources, merged.withColumn("payload", F.when(F.col("time_ns") == 2, "x").otherwise(F.col("payload")))).collect()} == {"differ"}
    stream_rows = spark.createDataFrame([("X", "f", 1, 0), ("X", "f", 3, 1), ("X", "f", 3, 2)], "inst_id string, field string, time_ns bigint, pos bigint")
    assert [r.pos for r in verify.order_faults(stream_rows).collect()] == [2]
    counts = spark.createDataFrame([("s", "X", "f", 3)], "source_id string, inst_id string, field string, n bigint")
    assert verify.state_faults(counts, counts).count() == 0 and verify.state_faults(counts, counts.withColumn("n", F.lit(4))).count() == 1


def test_faults_of_a_build(spark):
    side = '[["1.25","2.5","0","7"]]'
    rows = spark.createDataFrame([("X", 1, "snapshot", side, "[]", 5, "17"), ("X", 2, "update", "bad", None, None, None)], "inst_id string, time_ns bigint, action string, asks string, bids string, checksum bigint, ts string")
    built = verify.book_rows(rows.join(align.book_scales(rows), "inst_id"))
    assert (built.first().px_scale, built.first().sz_scale) == (4, 3)
    assert verify.build_faults(rows, built).count() == 0
    assert verify.build_faults(rows, built.withColumn("checksum", F.lit(1).cast("bigint"))).count() == 2
    with pytest.raises(Exception, match="bad ts"):
        verify.book_rows(rows.withColumn("ts", F.lit("x")).join(align.book_scales(rows), "inst_id")).collect()
    empty = rows.where("inst_id = 'none'")
    assert align.book_scales(empty).count() == 0


def test_runs_and_gaps(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None), (6, "a")], "i int, v string").withColumn("k", F.lit(0))
    assert [r.run_id for r in ordered.runs(df, ["k"], "v", ["i"]).orderBy("i").collect()] == [0, 0, 1, 2, 2, 3]
    assert [(r.i, r.expected) for r in ordered.gaps(df.where("i <> 3").withColumn("i", F.col("i") - 1), ["k"], "i").collect()] == [(3, 2), (4, 3), (5, 4)]


def test_shard_tags(spark):
    def keys(*tags):
        return spark.createDataFrame([(f"s{i}", t) for i, t in enumerate(tags)], "series_key string, tags map<string,string>")

    assert shard.detect_tag(keys({"instId": "a", "z": "1"}, {"instId": "b", "z": "1"})) == "instId"
    assert shard.detect_tag(keys({"b": "1", "a": "1"}, {"b": "2", "a": "2"})) == "a"
    assert shard.detect_tag(keys({"p": "1", "q": "1"}, {"p": "2", "q": "2"}, {"p": "2", "q": "1"})) == "q"
    assert shard.detect_tag(keys({"only": "1"}, {"only": "1"})) == "only"
    with pytest.raises(ValueError):
        shard.detect_tag(keys({"p": "1", "q": "1"}, {"p": "1", "q": "1"}))
    with pytest.raises(ValueError):
        shard.detect_tag(keys({"p": "1"}), "q")
    assert shard.detect_contract_tag(keys({"instId": "x"})) == "instId"
    assert shard.tag_tasks(keys({"p": "1"}, {"p": "2"}), "p").count() == 2
    with pytest.raises(Exception, match="shard without a series"):
        shard.tag_tasks(keys({"p": "1"}, {"p": "1"}), "p").collect()
    assert [tuple(r) for r in shard.contract_tasks(keys({"i": "BTC-1APR23-1-C"}, {"i": "BTC-7APR23-1-C"}), "i").collect()] == [("BTC-APR23", "^BTC-[0-9]{1,2}APR23-")]


def test_filters(spark):
    df = spark.createDataFrame([("a", {"x": "1"}, 5), ("b", {"x": "22"}, 6), ("c", {}, 7)], "id string, tags map<string,string>, t bigint")
    assert [r.id for r in df.where(filters.between(F.col("t"), 5, 6)).collect()] == ["a"]
    assert [r.id for r in df.where(filters.tags_equal(F.col("tags"), {"x": "22"})).collect()] == ["b"]
    assert [r.id for r in filters.tag_matches(df, "tags", "x", "2").collect()] == ["b"]
    for bad in (lambda: filters.tag_matches(df, "tags", "x", "9"), lambda: filters.chosen(df, "id", ["a", "q"]), lambda: filters.exact_series(df, "id", "q")):
        with pytest.raises(filters.Missing):
            bad()
    with pytest.raises(ValueError):
        filters.allowed("option_price")
    assert filters.allowed("option_price", True) == "option_price"
    assert filters.existing(df, ["t", "nope", "id"], 1).columns == ["t", "id"]
    assert filters.canonical(df, {"id": "string", "new": "bigint"}).first().new is None


def test_datasets_and_reports(spark, tmp_path):
    rows = spark.range(25).select(F.col("id").alias("time_ns"), F.when(F.col("id") < 10, "A").otherwise("B").alias("instId"))
    path = f"{tmp_path}/ticks/all.parquet"
    sink.write(rows.coalesce(1), path, ["time_ns"], rows_per_file=10)
    told = sink.describe(spark, path, "ticks", tags=["instId"])
    assert told["rows"] == 25 and told["parts"] >= 3 and json.loads((tmp_path / "ticks/all.parquet/_summary.json").read_text())["completed"]
    index = json.loads((tmp_path / "ticks/all.parquet/_part_index.json").read_text())
    assert sum(p["rows"] for p in index) == 25 and max(p["rows"] for p in index) <= 10
    sized = report.sizes(spark, str(tmp_path))
    first = sized.first()
    assert (first.dataset, first.measurement, first.status, first.rows) == ("ticks/all.parquet", "ticks", "completed", 25)
    assert report.readable(report.by_measurement(sized)).first().datasets == 1 and report.ordered_by(sized, "ratio").count() == 1
    assert [tuple(r)[2:4] for r in report.catalog(spark, str(tmp_path)).collect()] == [("ticks", "completed")]
    series = spark.createDataFrame([("ticks,instId=A", "A"), ("ticks,instId=B", "B")], "series_key string, instId string")
    state = sink.rebuild_checkpoint(spark, path, series, ["instId"])
    assert state["rows"] == 25 and state["series_sequence"] == ["ticks,instId=A", "ticks,instId=B"]
    assert report.sizes(spark, str(tmp_path)).first().status == "active"
    with pytest.raises(ValueError, match="no known series"):
        sink.rebuild_checkpoint(spark, path, series.where("instId = 'A'"), ["instId"])
    with pytest.raises(ValueError):
        sink.codec("lzma")
    (tmp_path / "orphan.parquet").mkdir()
    rows.write.parquet(f"{tmp_path}/orphan.parquet/x.parquet")
    with pytest.raises(ValueError):
        sink.no_orphans(spark, f"{tmp_path}/orphan.parquet")
    nested = spark.createDataFrame([({"a": "done", "b": "failed"},), ({"a": "done"},)], "tasks map<string,string>")
    assert {tuple(r) for r in report.nested_status_counts(nested, "tasks").collect()} == {("done", 2), ("failed", 1)}


def test_stream_equals_batch(spark, tmp_path):
    rows = points(spark, FRAGMENTS)
    source = tmp_path / "in"
    shuffled = FRAGMENTS[:]
    random.Random(3).shuffle(shuffled)
    for i, r in enumerate(shuffled):
        points(spark, [r]).coalesce(1).write.mode("append").parquet(str(source))
    keys, order = ["inst_id", "field", "time_ns"], ["shard_id", "kind", "generation", "sequence", "pos"]
    for _ in range(2):
        incoming = spark.readStream.schema(POINT).option("maxFilesPerTrigger", 3).parquet(str(source))
        stream.start(incoming, f"{tmp_path}/out", keys, order, f"{tmp_path}/checkpoint").awaitTermination()
    now = lambda: {r.time_ns: r.payload for r in stream.current(spark, f"{tmp_path}/out", keys, order).collect()}
    assert now() == {r.time_ns: r.payload for r in lww.latest(rows, keys, order).collect()}
    before = now()
    stream.compact(spark, f"{tmp_path}/out", keys, order)
    assert now() == before
    marks = spark.createDataFrame([("X", "f", 3)], "inst_id string, field string, mark bigint")
    assert {r.time_ns for r in stream.incremental(rows, marks, ["inst_id", "field"]).collect()} == {4, 5}


def test_compaction_loses_nothing(spark, tmp_path):
    """The last batch runs again after a compaction, a compaction stops before it deletes, and a delta comes in between."""
    from tickvault.operators.lww import latest

    keys, order, to = ["k"], ["n"], f"{tmp_path}/out"

    def batch(number, rows):
        latest(spark.createDataFrame(rows, "k string, n bigint"), keys, order).write.mode("overwrite").parquet(f"{to}/{stream.DELTA}={number:012d}")

    now = lambda: {r.k: r.n for r in stream.current(spark, to, keys, order).collect()}
    batch(0, [("a", 1), ("b", 1)])
    batch(1, [("c", 2)])
    stream.compact(spark, to, keys, order)
    assert now() == {"a": 1, "b": 1, "c": 2}
    batch(1, [("c", 2)])
    assert now() == {"a": 1, "b": 1, "c": 2}
    batch(2, [("a", 5)])
    gone, stream.store.delete = stream.store.delete, lambda *a: None
    try:
        stream.compact(spark, to, keys, order)
    finally:
        stream.store.delete = gone
    batch(3, [("d", 6)])
    assert now() == {"a": 5, "b": 1, "c": 2, "d": 6}
    stream.compact(spark, to, keys, order)
    stream.compact(spark, to, keys, order)
    assert now() == {"a": 5, "b": 1, "c": 2, "d": 6}


def test_replacing_a_folder_can_stop_anywhere(spark, tmp_path):
    from tickvault.sources import store

    to = f"{tmp_path}/d"
    spark.range(3).write.parquet(to)
    spark.range(5).write.parquet(to + "._staged")
    os.rename(to, to + store.ASIDE)  # stopped after the first rename
    assert store.recovered(spark, to) and spark.read.parquet(to).count() == 3
    store.replace_dir(spark, to + "._staged", to)
    assert spark.read.parquet(to).count() == 5 and not os.path.exists(to + store.ASIDE)
    spark.range(2).write.parquet(to + store.ASIDE)  # stopped before the old one was deleted
    assert store.recovered(spark, to) and spark.read.parquet(to).count() == 5 and not os.path.exists(to + store.ASIDE)
    store.write_text(spark, f"{to}/t", "one")
    store.write_text(spark, f"{to}/t", "two")
    assert store.read_text(spark, f"{to}/t") == "two"


def test_log_sequences_of_large_entries():
    """More values of one key in one entry than any fixed share of a sequence would hold; later rows come later."""
    from tickvault.sources import wal

    n = (1 << 20) + 5
    data = wal.write_entry([(b"m,instId=A#!~#f", wal.INTEGER, [(7, k) for k in range(n)])]) + wal.write_entry([(b"m,instId=A#!~#f", wal.INTEGER, [(7, -1)])]) + wal.delete_entry([b"x"])
    seqs = [x for b in wal.logged(1, 3, data) for x in b.column("seq").to_pylist()]
    assert len(seqs) == n + 2 and all(a < b for a, b in zip(seqs, seqs[1:]))
    assert max(seqs) < min(x for b in wal.logged(1, 4, data) for x in b.column("seq").to_pylist())


def test_manifest_of_tasks(spark, tmp_path):
    tasks = spark.createDataFrame([("b", "Y", None), ("a", "X", "completed")], "task_id string, shard_value string, status string")
    told = sink.write_tasks(spark, f"{tmp_path}/ticks", "ticks", "instId", tasks)
    assert [(t["task_id"], t["shard_tag"], t["status"], t["exit_code"]) for t in told["tasks"]] == [("a", "instId", "completed", None), ("b", "instId", "pending", None)]
    assert set(told["tasks"][0]) == set(sink.TASK)
    assert [(r.kind, r.measurement, r.status) for r in report.catalog(spark, str(tmp_path)).collect()] == [("parallel", "ticks", "active")]
    assert sink.write_tasks(spark, f"{tmp_path}/ticks", "ticks", "instId", tasks.where("task_id = 'a'"))["status"] == "completed"


def test_sizes_of_parts_over_runs():
    assert sink.retuned(None, 5) == [5]
    assert sink.retuned({"rows_per_file_history": [5]}, 5) == [5]
    assert sink.retuned({"rows_per_file_history": [5, 7]}, 5) == [5, 7, 5]


def test_text_in_a_checksum_is_an_error(spark):
    from tickvault.plans import export

    point = "inst_id string, field string, time_ns bigint, v_string binary, v_long bigint, shard_id int, kind string, generation int, sequence int, source_id string, pos bigint"
    row = lambda field, text, number: ("X", field, 1, text, number, 1, "tsm", 1, 1, "s", 0)
    good = [row("action", b"update", None), row("checksum", None, 7)]
    assert export.book_text(spark.createDataFrame(good, point)).first().checksum == 7
    with pytest.raises(Exception, match="an integer is expected"):
        export.book_text(spark.createDataFrame([row("checksum", b"7", None)], point)).collect()


def test_ids_previews_and_flags(spark):
    from tickvault.functions import series

    text = r"m,instId=B\,\ x m,instId=A,k=1 mm,instId=A other,instId=C"
    rows = spark.createDataFrame([(text, "abcdefghij"), (None, None)], "t string, p string").select(series.ids_in(F.col("t"), "m").alias("ids"), series.preview(F.col("p"), 9).alias("p")).collect()
    assert (rows[0].ids, rows[0].p, rows[1].ids, rows[1].p) == (["A", "B\\"], "abcdef...", None, None)
    flags = report.all_complete(spark.createDataFrame([("a", "complete"), ("a", None), ("b", "complete")], "k string, status string"), "k").collect()
    assert {tuple(r) for r in flags} == {("a", False, True), ("b", True, True)}
