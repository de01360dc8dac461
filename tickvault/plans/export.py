"""Whole exports as one plan each."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.operators import align, filters, lww, sink, verify
from tickvault.sources import http, store, text, tsm, wal


def source_points(spark: SparkSession, tsm_root: str, wal_root: str | None = None, fields: Sequence[str] = align.BOOK_FIELDS, start: int | None = None, end: int | None = None, inst_ids: Sequence[str] | None = None) -> DataFrame:
    """Points of storage files and of the logs of their shards; logs of other shards, and instruments that only logs have, are left out."""
    stored = tsm.points(spark, tsm_root, fields=fields, start=start, end=end)
    rows = stored
    if wal_root is not None:
        have = stored.select("shard_id").distinct()
        known = stored.select("inst_id").distinct()
        logs = filters.among(filters.among(wal.points(spark, wal_root, fields, start, end), "shard_id", have), "inst_id", known)
        rows = stored.unionByName(logs.select(stored.columns))
    return rows if inst_ids is None else filters.chosen(rows, "inst_id", inst_ids)


def book_text(points: DataFrame) -> DataFrame:
    """(inst_id, time_ns, action, asks, bids, checksum, ts): rewrites resolved and fields aligned, in one shuffle. A checksum that is no integer is an error."""
    typed = F.when((F.col("field") == "checksum") & F.col("v_long").isNull(), F.raise_error(F.lit("field checksum: an integer is expected")).cast("bigint")).otherwise(F.col("v_long"))
    points = points.withColumn("v_long", typed)
    as_text = F.coalesce(F.col("v_string").cast("string"), F.col("v_long").cast("string"))
    values = {f: F.col("v_long") if f == "checksum" else as_text for f in align.BOOK_FIELDS}
    return align.wide(points, ["inst_id", "time_ns"], "field", values, lww.source_order())


def book(points: DataFrame) -> DataFrame:
    """The final rows of an order book, packed at the scales of their instrument; the scales are a row an instrument."""
    rows = book_text(points)
    return verify.book_rows(rows.join(align.book_scales(rows), "inst_id"))


def signature(points: DataFrame) -> str:
    """Of what a build depends on: the counts and times of each source, instrument and field."""
    rows = sink.manifest(points).orderBy("source_id", "inst_id", "field")
    h = hashlib.sha256()
    for line in rows.toJSON().toLocalIterator():
        h.update(line.encode() + b"\n")
    return h.hexdigest()


def export_book(spark: SparkSession, tsm_root: str, out: str, wal_root: str | None = None, rows_per_file: int = 1_000_000, compression: str = "zstd", stop_after: str | None = None, **prune) -> dict:
    """Storage files and logs to a packed dataset with a folder for each instrument. A build whose input is unchanged is left as it is."""
    if stop_after not in (None, "scan", "merge", "build"):
        raise ValueError(f"no phase {stop_after}")
    if stop_after == "scan":
        return {"series": tsm.index(spark, tsm_root).count()}
    points = source_points(spark, tsm_root, wal_root, **prune)
    now = {"signature": signature(points), "rows_per_file": rows_per_file, "compression": sink.codec(compression)}
    before = store.read_json(spark, f"{out}/{sink.SUMMARY}")
    if before and all(before.get(k) == v for k, v in now.items()):
        return before
    if stop_after == "merge":
        return now
    return sink.write(book(points), out, ["time_ns"], rows_per_file, compression, by=["inst_id"], told={"measurement": "order book", "extra": now})


def export_measurement(spark: SparkSession, url: str, database: str, measurement: str, out: str, start: int | None = None, end: int | None = None, limit: int | None = None, tags: Mapping[str, str] | None = None, rows_per_file: int = 1_000_000, compression: str = "zstd", allow_excluded: bool = False, tag_regex: tuple[str, str] | None = None, series_key: str | None = None, resume: bool = False) -> dict:
    """A measurement over HTTP to a dataset: a partition a series, in the order of series and time.

    Series are chosen by equal tags, by a tag with a match for a pattern (tag, pattern), or by their key. With `resume`,
    a dataset of the same export is kept, and only what is later than the last time of each of its series is asked for. Answers are
    stored before they are ordered, so each series is fetched once."""
    filters.allowed(measurement, allow_excluded)
    fields, tag_names = http.field_types(url, database, measurement), http.tag_keys(url, database, measurement)
    identity = {"measurement": measurement, "database": database, "start": start, "end": end, "limit": limit, "tags": dict(tags or {}), "tag_regex": list(tag_regex) if tag_regex else None, "series_key": series_key, "fields": fields}
    sink.no_orphans(spark, out)
    before = store.read_json(spark, f"{out}/{sink.SUMMARY}")
    if before:
        sink.same_export(before.get("identity", {}), json.loads(json.dumps(identity)))
    keys = http.series_keys(url, database, measurement)
    if not keys:
        return {"measurement": measurement, "rows": 0, "completed": True}
    series = spark.createDataFrame([(k,) for k in keys], "series_key string")
    from tickvault.functions.series import parse_series_key

    parsed = series.select("series_key", parse_series_key(F.col("series_key"))["tags"].alias("tags")).where(filters.tags_equal(F.col("tags"), tags or {}))
    if tag_regex is not None:
        parsed = filters.tag_matches(parsed, "tags", *tag_regex)
    if series_key is not None:
        parsed = filters.exact_series(parsed, "series_key", series_key)
    have, marks = (spark.read.parquet(out) if resume and before else None), {}
    if have is not None:  # a row a series
        marks = {tuple(r[t] for t in tag_names): r["mark"] for r in have.groupBy(*tag_names).agg(F.max("time").alias("mark")).collect()}
    chosen = [r["tags"] for r in parsed.orderBy("series_key").collect()]
    queries = [http.select_query(measurement, own, start, end, marks.get(tuple(own.get(t) for t in tag_names)), limit) for own in chosen]
    fetched = out.rstrip("/") + "._chunks"
    http.chunks(spark, url, database, queries).write.mode("overwrite").parquet(fetched)
    rows = text.chunk_rows(spark.read.parquet(fetched), fields, tag_names)
    if have is not None:
        rows = have.select(rows.columns).unionByName(rows)
    order = [*sorted(tag_names), "time"]
    if limit is not None:
        rows = rows.orderBy(*order).limit(limit)
    summary = sink.write(rows, out, order, rows_per_file, compression, told={"measurement": measurement, "time": "time", "tags": tag_names, "extra": {"identity": identity, "rows_per_file": rows_per_file, "rows_per_file_history": sink.retuned(before, rows_per_file)}})
    store.delete(spark, fetched)
    return summary
