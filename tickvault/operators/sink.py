"""Datasets as folders of Parquet parts with JSON sidecars."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.functions.timeutil import ns_text
from tickvault.sources import store

CODECS = ("zstd", "snappy", "none")
SUMMARY, PARTS, DESCRIPTION, MANIFEST, CHECKPOINT = "_summary.json", "_part_index.json", "_description.md", "_manifest.json", "_checkpoint.json"


def codec(name: str) -> str:
    if name not in CODECS:
        raise ValueError(f"no codec {name}; there are: {', '.join(CODECS)}")
    return name


def write(df: DataFrame, path: str, order: Sequence[str | Column], rows_per_file: int = 1_000_000, compression: str = "zstd", by: Sequence[str] = (), level: int = 9, told: dict | None = None) -> dict | None:
    """Parts of at most rows_per_file rows, in order within each part; staged first, then put in place of what was there.
    With `told`, arguments of describe(), the sidecars are staged too, so no dataset is ever there without them.

    With `by` there is a folder for each value, written from ranges of (by, order): a large one is spread over tasks."""
    spark = df.sparkSession
    staged = path.rstrip("/") + "._staged"
    keys = [*[F.col(c) for c in by], *[F.col(c) if isinstance(c, str) else c for c in order]]
    rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    writer = rows.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).option("compression", codec(compression)).option("parquet.compression.codec.zstd.level", level).option("parquet.writer.version", "PARQUET_2_0")
    (writer.partitionBy(*by) if by else writer).parquet(staged)
    summary = None if told is None else describe(spark, staged, **told)
    store.replace_dir(spark, staged, path)
    return summary


def part_index(spark: SparkSession, path: str, time: str = "time_ns", tags: Sequence[str] = ()) -> DataFrame:
    """A row a part: its rows, bytes, first and last time, and the sorted distinct values of each tag."""
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_size"))
    sets = [F.sort_array(F.collect_set(F.col(t))).alias(t) for t in tags]
    found = rows.groupBy("_path").agg(F.count("*").alias("rows"), F.max("_size").alias("bytes"), F.min(time).alias("min_time"), F.max(time).alias("max_time"), *sets)
    return found.select(F.regexp_extract("_path", r"([^/]+)$", 1).alias("part"), "rows", "bytes", "min_time", "max_time", *tags)


def manifest(points: DataFrame, source: str = "source_id") -> DataFrame:
    """(source, inst_id, field, n, min_time, max_time) of points."""
    return points.groupBy(source, "inst_id", "field").agg(F.count("*").alias("n"), F.min("time_ns").alias("min_time"), F.max("time_ns").alias("max_time"))


def describe(spark: SparkSession, path: str, measurement: str, time: str = "time_ns", tags: Sequence[str] = (), extra: dict | None = None) -> dict:
    """Writes the part index, the summary and the description of a dataset, from one pass over it."""
    index = part_index(spark, path, time, tags).orderBy("part")
    total = index.agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.count("*").alias("parts"), F.min("min_time").alias("min_time"), F.max("max_time").alias("max_time")).select("*", ns_text(F.col("min_time")).alias("start"), ns_text(F.col("max_time")).alias("end")).first()
    schema = spark.read.parquet(path).schema
    summary = {"measurement": measurement, "completed": True, "rows": total["rows"] or 0, "bytes": total["bytes"] or 0, "parts": total["parts"], "min_time_ns": total["min_time"], "max_time_ns": total["max_time"], "start": total["start"], "end": total["end"], "columns": {f.name: f.dataType.simpleString() for f in schema}} | (extra or {})
    store.write_text(spark, f"{path}/{PARTS}", "[\n" + ",\n".join(index.toJSON().toLocalIterator()) + "\n]\n")
    store.write_json(spark, f"{path}/{SUMMARY}", summary)
    lines = [f"# {measurement}", "", f"{summary['rows']} rows in {summary['parts']} parts, {summary['start']} to {summary['end']}.", "", "| column | type |", "| --- | --- |", *[f"| {c} | {t} |" for c, t in summary["columns"].items()], ""]
    store.write_text(spark, f"{path}/{DESCRIPTION}", "\n".join(lines))
    return summary


def rebuild_checkpoint(spark: SparkSession, path: str, series: DataFrame, tags: Sequence[str], time: str = "time_ns") -> dict:
    """Progress of a dataset from its parts: totals, and the run of series that its parts begin with.

    series: series_key and the tags of each. A part whose first row has tags of no series is an error."""
    rows = spark.read.parquet(path).select(*tags, time, F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias("part"), F.col("_metadata.row_index").alias("_i"))
    first = rows.groupBy("part").agg(F.min_by(F.struct(*tags), "_i").alias("t"), F.count("*").alias("rows"), F.min(time).alias("min_time"), F.max(time).alias("max_time"))
    known = series.select("series_key", F.struct(*tags).alias("t"))
    if not known.groupBy("t").count().where("count > 1").isEmpty():
        raise ValueError("two series have the same tags")
    joined = first.join(known, first["t"].eqNullSafe(known["t"]), "left").orderBy("part").select("part", "rows", "min_time", "max_time", "series_key").collect()  # a row a part
    if lost := [r["part"] for r in joined if r["series_key"] is None]:
        raise ValueError(f"parts of no known series: {', '.join(lost)}")
    sequence: list[str] = []
    for r in joined:
        if not sequence or sequence[-1] != r["series_key"]:
            sequence.append(r["series_key"])
    state = {"parts": len(joined), "rows": sum(r["rows"] for r in joined), "min_time": min((r["min_time"] for r in joined), default=None), "max_time": max((r["max_time"] for r in joined), default=None), "series_sequence": sequence, "completed": False}
    store.write_json(spark, f"{path}/{CHECKPOINT}", state)
    return state


#: Columns of a task in a manifest; those that a task does not have are null. Fixed values.
TASK = ("task_id", "shard_tag", "shard_value", "series_key", "series_tag_key", "series_tag_regex", "start", "end", "window_label", "status", "exit_code", "dataset_path", "log_path")


def write_tasks(spark: SparkSession, path: str, measurement: str, shard_tag: str, tasks: DataFrame) -> dict:
    """Writes the manifest of an export that is split into tasks, in the order of their ids; a task without a status is
    pending, and the export is completed when all of its tasks are. Tasks come to the driver, a row each."""
    own = {c: F.col(c) if c in tasks.columns else F.lit(None).cast("string") for c in TASK}
    own["shard_tag"], own["status"] = F.coalesce(own["shard_tag"], F.lit(shard_tag)), F.coalesce(own["status"], F.lit("pending"))
    rows = tasks.select(*[e.alias(c) for c, e in own.items()]).orderBy("task_id")
    told = [json.loads(r[0]) for r in rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator()]
    manifest = {"measurement": measurement, "shard_tag": shard_tag, "generated_at": datetime.now(UTC).isoformat(), "status": "completed" if all(t["status"] == "completed" for t in told) else "active", "tasks": told}
    store.write_json(spark, f"{path}/{MANIFEST}", manifest)
    return manifest


def retuned(before: dict | None, rows_per_file: int) -> list[int]:
    """The sizes of parts that the runs into a dataset asked for, without repeats in a row; the last is the present one."""
    history = list((before or {}).get("rows_per_file_history", []))
    return history if history[-1:] == [rows_per_file] else [*history, rows_per_file]


#: What must not change between the runs of an export into one dataset.
IDENTITY = ("measurement", "database", "start", "end", "limit", "tags", "tag_regex", "series_key", "fields")


def same_export(before: dict, now: dict) -> None:
    """An error if a dataset was made by another export."""
    if differ := [k for k in IDENTITY if before.get(k) != now.get(k)]:
        raise ValueError(f"the dataset is of another export: {', '.join(differ)} differ")


def no_orphans(spark: SparkSession, path: str) -> None:
    """An error if a folder has parts but nothing that tells where they come from."""
    if store.recovered(spark, path) and not any(store.exists(spark, f"{path}/{n}") for n in (SUMMARY, CHECKPOINT, "summary.json")):
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path).select("path")
        if not files.isEmpty():
            raise ValueError(f"{path} has parts without a summary or a checkpoint")
