"""Query results over HTTP as a data source: one partition a series, read in chunks as they come.

    spark.dataSource.register(ChunkedHttp)
    spark.read.format("tickvault_http").option("url", ...).option("queries", json_list).load()
"""

from __future__ import annotations

import json
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition



def ident(text: str) -> str:
    return '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"'


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def select_query(measurement: str, tags: dict[str, str], start: int | None = None, end: int | None = None, after: int | None = None, limit: int | None = None) -> str:
    """All rows of one series in time order; bounds are nanoseconds."""
    terms = [f"{ident(k)}={literal(v)}" for k, v in sorted(tags.items())]
    terms += [f"time {op} {t}" for op, t in ((">=", start), ("<", end), (">", after)) if t is not None]
    return f"SELECT * FROM {ident(measurement)}" + (f" WHERE {' AND '.join(terms)}" if terms else "") + " ORDER BY time ASC" + (f" LIMIT {limit}" if limit is not None else "")


def ask(url: str, database: str, query: str, chunk_size: int | None = None, timeout: float = 60) -> Iterator[str]:
    """Lines of JSON that answer a query."""
    form = {"db": database, "q": query, "epoch": "ns"} | ({"chunked": "true", "chunk_size": str(chunk_size)} if chunk_size else {})
    with urllib.request.urlopen(f"{url.rstrip('/')}/query?{urllib.parse.urlencode(form)}", timeout=timeout) as answer:
        for line in answer:
            if line.strip():
                yield line.decode()


def metadata(url: str, database: str, query: str) -> list[dict]:
    """The series of a metadata query; an error in the answer is raised."""
    payload = json.loads("".join(ask(url, database, query)))
    found = []
    for result in payload.get("results", []):
        if message := result.get("error") or payload.get("error"):
            raise RuntimeError(message)
        found += result.get("series", [])
    return found


def field_types(url: str, database: str, measurement: str) -> dict[str, str]:
    return {row[0]: row[1] for s in metadata(url, database, f"SHOW FIELD KEYS FROM {ident(measurement)}") for row in s["values"]}


def tag_keys(url: str, database: str, measurement: str) -> list[str]:
    return sorted(row[0] for s in metadata(url, database, f"SHOW TAG KEYS FROM {ident(measurement)}") for row in s["values"])


def series_keys(url: str, database: str, measurement: str) -> list[str]:
    return sorted(row[0] for s in metadata(url, database, f"SHOW SERIES FROM {ident(measurement)}") for row in s["values"])


def has_series(url: str, database: str, measurement: str) -> bool:
    return bool(metadata(url, database, f"SHOW SERIES FROM {ident(measurement)} LIMIT 1"))


class Query(InputPartition):
    def __init__(self, text: str):
        self.text = text


class ChunkReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        return [Query(q) for q in json.loads(self.options["queries"])]

    def read(self, partition: Query):
        for line in ask(self.options["url"], self.options.get("database", ""), partition.text, int(self.options.get("chunk_size", 10_000))):
            yield (partition.text, line)


class ChunkedHttp(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tickvault_http"

    def schema(self) -> str:
        return "query string, value string"

    def reader(self, schema) -> DataSourceReader:
        return ChunkReader(self.options)


def chunks(spark: SparkSession, url: str, database: str, queries: list[str], chunk_size: int = 10_000) -> DataFrame:
    """(query, value): chunks of answers, for `text.chunk_rows`."""
    spark.dataSource.register(ChunkedHttp)
    return spark.read.format("tickvault_http").options(url=url, database=database, queries=json.dumps(queries), chunk_size=str(chunk_size)).load()
