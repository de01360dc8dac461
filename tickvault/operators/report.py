"""Reports on folders of datasets: sizes from footers, roll-ups, statuses and a catalog."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.functions.decimalx import human_bytes, human_ratio, ratio
from tickvault.sources import store

#: Names of folders that say nothing about what is in them. Fixed values.
GENERIC_ROOTS = ("exported", "exported_parallel", "parquet", "data")
FOOTERS = "path string, rows bigint, row_groups int, compressed bigint, uncompressed bigint, meta map<string, string>"


def listing(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """(path, length) of files below root; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(root).select("path", "length")


def footers(files: DataFrame) -> DataFrame:
    """Rows, row groups, bytes of columns and metadata from the footer of each file in `path`; only footers are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            out = []
            for path in batch.column(0).to_pylist():
                where, name = fs.FileSystem.from_uri(path)
                with where.open_input_file(name) as f:
                    meta = pq.ParquetFile(f).metadata
                groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
                columns = [g.column(c) for g in groups for c in range(g.num_columns)]
                own = {k.decode("utf-8", "replace"): v.decode("utf-8", "replace") for k, v in (meta.metadata or {}).items()}
                out.append((path, meta.num_rows, len(groups), sum(c.total_compressed_size for c in columns), sum(c.total_uncompressed_size for c in columns), list(own.items())))
            if out:
                types = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.map_(pa.string(), pa.string()))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], ["path", "rows", "row_groups", "compressed", "uncompressed", "meta"])

    return files.select("path").mapInArrow(run, FOOTERS)


def sidecars(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(dataset, text) of the JSON files of a name below root."""
    found = [(path.rpartition("/")[0], store.read_text(spark, path)) for path in store.find(spark, root, re.escape(name))]
    return spark.createDataFrame(found, "dataset string, text string")


def status(checkpoint: Column, summary: Column) -> Column:
    """Of a dataset by its sidecars' texts: a checkpoint decides, else a summary means that it is complete."""
    done = F.coalesce(F.get_json_object(checkpoint, "$.completed") == "true", F.lit(False))
    return F.when(checkpoint.isNotNull(), F.when(done, "completed").otherwise("active")).when(summary.isNotNull(), "completed").otherwise("unknown")


def measurement(relative: Column, root_name: str, told: Column) -> Column:
    """The measurement of a dataset by its path below root: what it tells itself counts, except deeper than one level below
    a folder that is no dataset, whose name counts."""
    parts = F.split(relative, "/")
    first = F.element_at(parts, 1)
    stem = F.regexp_replace(first, r"\.parquet$", "")
    root = F.lit(root_name if root_name and root_name not in GENERIC_ROOTS else None)
    return F.when(F.size(parts) == 1, F.coalesce(told, root, stem)).when(first.endswith(".parquet"), F.coalesce(told, stem)).otherwise(first)


def sizes(spark: SparkSession, root: str) -> DataFrame:
    """(dataset, measurement, status, parts, rows, row_groups, actual, compressed, uncompressed, actual_ratio, codec_ratio) of datasets `*.parquet/` below root."""
    files = listing(spark, root, "*.parquet").where(F.col("path").rlike(r"\.parquet/[^/]+\.parquet$|\.parquet/[^/]*=[^/]*/.*\.parquet$"))
    files = files.withColumn("dataset", F.regexp_extract("path", r"^(.*?\.parquet)/", 1))
    found = files.join(footers(files), "path")
    plain = lambda c: F.regexp_replace(c, r"^file:/*", "/")  # noqa: E731  (readers differ in how they spell local paths)
    per = found.withColumn("dataset", plain("dataset")).groupBy("dataset").agg(F.count("*").alias("parts"), F.sum("rows").alias("rows"), F.sum("row_groups").alias("row_groups"), F.sum("length").alias("actual"), F.sum("compressed").alias("compressed"), F.sum("uncompressed").alias("uncompressed"), F.min_by(F.try_element_at("meta", F.lit("measurement")), "path").alias("own"))
    for name, c in (("_checkpoint.json", "checkpoint"), ("_summary.json", "summary"), ("summary.json", "summary2")):
        per = per.join(sidecars(spark, root, name).select(plain("dataset").alias("dataset"), F.col("text").alias(c)), "dataset", "left")
    summary = F.coalesce("summary", "summary2")
    base = F.regexp_replace(F.lit(root.rstrip("/")), r"^file:/*", "/")
    relative = F.regexp_replace(F.regexp_replace("dataset", r"^file:/*", "/"), F.concat(F.lit("^"), F.regexp_replace(base, r"([.\\+*?\[^\]$(){}=!<>|:\-])", r"\\$1"), F.lit("/?")), "")
    told = F.coalesce("own", F.nullif(F.get_json_object(summary, "$.measurement"), F.lit("")))
    return per.select(
        relative.alias("dataset"), measurement(relative, root.rstrip("/").rpartition("/")[2], told).alias("measurement"), status(F.col("checkpoint"), summary).alias("status"), "parts", "rows", "row_groups", "actual", "compressed", "uncompressed",
        ratio(F.col("uncompressed"), F.col("actual")).alias("actual_ratio"), ratio(F.col("uncompressed"), F.col("compressed")).alias("codec_ratio"),
    )


def by_measurement(datasets: DataFrame) -> DataFrame:
    total = {c: F.sum(c) for c in ("parts", "rows", "actual", "compressed", "uncompressed")}
    rows = datasets.groupBy("measurement").agg(F.count("*").alias("datasets"), F.count_if(F.col("status") == "completed").alias("completed"), F.count_if(F.col("status") == "active").alias("active"), *[e.alias(c) for c, e in total.items()])
    return rows.withColumn("actual_ratio", ratio(F.col("uncompressed"), F.col("actual"))).withColumn("codec_ratio", ratio(F.col("uncompressed"), F.col("compressed")))


#: Orders of a report: the largest first, a missing ratio last, ties by name.
SORTS = {"actual": "actual", "uncompressed": "uncompressed", "rows": "rows", "ratio": "actual_ratio", "codec-ratio": "codec_ratio"}


def ordered_by(datasets: DataFrame, sort: str = "actual") -> DataFrame:
    if sort == "name":
        return datasets.orderBy("measurement", "dataset")
    return datasets.orderBy(F.coalesce(F.col(SORTS[sort]), F.lit(0)).desc(), "dataset")


def readable(rows: DataFrame) -> DataFrame:
    """Sizes and ratios as text for a console."""
    made = {c: human_bytes(F.col(c)) for c in ("actual", "compressed", "uncompressed") if c in rows.columns}
    made |= {c: human_ratio(F.col(c)) for c in ("actual_ratio", "codec_ratio") if c in rows.columns}
    return rows.withColumns(made)


def status_counts(statuses: DataFrame, column: str = "status") -> DataFrame:
    return statuses.groupBy(column).agg(F.count("*").alias("n"))


def all_complete(statuses: DataFrame, by: str, column: str = "status", complete: str = "complete") -> DataFrame:
    """(by, scan_complete, any_complete): whether all, and any, of a group's statuses are complete; a null status is not."""
    done = F.coalesce(F.col(column) == complete, F.lit(False))
    return statuses.groupBy(by).agg(F.every(done).alias("scan_complete"), F.some(done).alias("any_complete"))


def nested_status_counts(statuses: DataFrame, column: str) -> DataFrame:
    """Counts of the values of a map column, such as the statuses of the tasks of a manifest."""
    return statuses.select(F.explode(F.map_values(column)).alias("status")).groupBy("status").agg(F.count("*").alias("n"))


def catalog(spark: SparkSession, root: str) -> DataFrame:
    """(kind, dataset, measurement, status, rows, bytes): what the summaries and manifests below root tell."""
    out = None
    for name, kind in (("_summary.json", "exported"), ("summary.json", "exported"), ("_manifest.json", "parallel")):
        get = lambda k: F.get_json_object("text", f"$.{k}")
        rows = sidecars(spark, root, name).select(F.lit(kind).alias("kind"), "dataset", get("measurement").alias("measurement"), F.coalesce(get("status"), F.when(get("completed") == "false", "active").otherwise("completed")).alias("status"), get("rows").try_cast("bigint").alias("rows"), get("bytes").try_cast("bigint").alias("bytes"))
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else spark.createDataFrame([], "kind string, dataset string, measurement string, status string, rows bigint, bytes bigint")
