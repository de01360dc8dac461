"""Driver queries: each applies an operator of the engine to the driver's tables; SQL gives the same rows in DuckDB."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.functions import book, decimalx, series, timeutil
from tickvault.operators import align, deletes, filters, lww, ordered, report, shard, sink, verify
from tickvault.sources import codecs, tsm, wal
from tickvault.sources import text as text_sources
from tickvault.streaming import lww as stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ns(c: str) -> Column:
    return timeutil.to_ns(F.col(c))


HOUR = 3_600_000_000_000
DAY = 24 * HOUR
START, NANO_DAY = 1_704_067_200_000_000_000, 86_400_000_000_000  # 2024-01-01T00:00:00Z
TYPES = ("click", "purchase", "search", "signup", "view")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").withColumn("time_ns", ns("ts"))


def hourly(df: DataFrame) -> DataFrame:
    return df.withColumn("hour_ns", F.col("time_ns") - F.pmod(F.col("time_ns"), F.lit(HOUR)))


SQL_HOURLY = f"(SELECT *, epoch_us(ts) * 1000 AS time_ns, epoch_us(ts) * 1000 - (epoch_us(ts) * 1000) % {HOUR} AS hour_ns FROM events)"


@query(
    f"""SELECT user_id, event_type, hour_ns, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, hour_ns
        ORDER BY time_ns DESC, event_id DESC) AS n FROM {SQL_HOURLY}) WHERE n = 1"""
)
def lww_latest(spark, sf_dir):
    rows = hourly(events(spark, sf_dir)).select("user_id", "event_type", "hour_ns", "event_id", "value", "time_ns")
    return lww.latest(rows, ["user_id", "event_type", "hour_ns"], ["time_ns", "event_id"]).drop("time_ns")


@query(SQL["lww_latest"])
def lww_latest_row_number(spark, sf_dir):
    rows = hourly(events(spark, sf_dir)).select("user_id", "event_type", "hour_ns", "event_id", "value", "time_ns")
    return lww.latest(rows, ["user_id", "event_type", "hour_ns"], ["time_ns", "event_id"], "row_number").drop("time_ns")


@query(
    """SELECT inst_id, field, time_ns, price FROM (SELECT *, row_number() OVER (PARTITION BY inst_id, field, time_ns
        ORDER BY shard_id DESC, kind DESC, CASE WHEN kind = 1 THEN 0 ELSE generation END DESC, sequence DESC, source_id DESC, pos DESC) AS n FROM (
        SELECT l_orderkey AS inst_id, l_returnflag AS field, CAST(l_linenumber AS BIGINT) AS time_ns, CAST(l_extendedprice * 100 AS BIGINT) AS price,
        l_suppkey % 4 AS shard_id, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS kind, CAST(l_quantity AS BIGINT) AS generation,
        l_partkey AS sequence, l_suppkey AS source_id, CAST(l_extendedprice * 100 AS BIGINT) AS pos FROM lineitem)) WHERE n = 1"""
)
def lww_source_rank(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem")
    price = (F.col("l_extendedprice") * 100).cast("decimal(20,0)").cast("bigint")
    points = rows.select(
        F.col("l_orderkey").alias("inst_id"), F.col("l_returnflag").alias("field"), F.col("l_linenumber").cast("bigint").alias("time_ns"), price.alias("price"), (F.col("l_suppkey") % 4).alias("shard_id"),
        F.when(F.col("l_linestatus") == "F", "wal").otherwise("tsm").alias("kind"), F.col("l_quantity").cast("bigint").alias("generation"), F.col("l_partkey").alias("sequence"), F.col("l_suppkey").alias("source_id"), price.alias("pos"),
    )
    return lww.latest_points(points).select("inst_id", "field", "time_ns", "price")


@query(
    f"""WITH e AS (SELECT user_id, event_type, hour_ns, max(value) AS value FROM {SQL_HOURLY} GROUP BY ALL)
        SELECT user_id, hour_ns, c.value AS click, v.value AS view FROM (SELECT * FROM e WHERE event_type = 'click') c
        FULL JOIN (SELECT * FROM e WHERE event_type = 'view') v USING (user_id, hour_ns)"""
)
def align_full_outer(spark, sf_dir):
    e = hourly(events(spark, sf_dir)).groupBy("user_id", "event_type", "hour_ns").agg(F.max("value").alias("value"))
    one = lambda t: e.where(F.col("event_type") == t).select("user_id", "hour_ns", F.col("value").alias(t))
    return align.full_outer(one("click"), one("view"), ["user_id", "hour_ns"])


_WIDE = ", ".join(f"max(CASE WHEN event_type = '{t}' THEN value END) AS {t}_value" for t in TYPES)


@query(
    f"""SELECT user_id, hour_ns, {_WIDE} FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, hour_ns ORDER BY time_ns DESC, event_id DESC) AS n
        FROM {SQL_HOURLY} WHERE event_type IN {TYPES}) WHERE n = 1 GROUP BY user_id, hour_ns"""
)
def align_lww_wide(spark, sf_dir):
    """Resolves rewrites and aligns all fields in one shuffle."""
    order = F.struct("time_ns", "event_id")
    rows = align.wide(hourly(events(spark, sf_dir)), ["user_id", "hour_ns"], "event_type", {t: F.col("value") for t in TYPES}, order)
    return rows.select("user_id", "hour_ns", *[F.col(t).alias(f"{t}_value") for t in TYPES])


_TOMBS = "VALUES " + ", ".join(f"({u}, '{t}', {START + a * DAY}, {START + b * DAY})" for u, t, a, b in [(1, "click", 0, 9), (2, "view", 3, 3), (3, "search", 5, 25), (4, "click", 0, 30), (5, "purchase", 10, 20)])


@query(
    f"""SELECT event_id, user_id, event_type, time_ns FROM {SQL_HOURLY} e WHERE NOT EXISTS (SELECT 1 FROM ({_TOMBS}) t(u, f, lo, hi)
        WHERE t.u = e.user_id AND t.f = e.event_type AND e.time_ns BETWEEN t.lo AND t.hi)"""
)
def tombstone_range(spark, sf_dir):
    tombs = spark.sql(f"SELECT CAST(col1 AS BIGINT) user_id, col2 event_type, col3 min_time, col4 max_time FROM {_TOMBS}")
    return deletes.without_tombstones(events(spark, sf_dir), tombs, ["user_id", "event_type"]).select("event_id", "user_id", "event_type", "time_ns")


@query(
    f"""SELECT event_id, user_id, time_ns FROM {SQL_HOURLY} w WHERE event_type <> 'signup' AND NOT EXISTS (SELECT 1 FROM {SQL_HOURLY} d
        WHERE d.event_type = 'signup' AND d.user_id = w.user_id AND d.event_id > w.event_id AND w.time_ns BETWEEN d.time_ns - {2 * DAY} AND d.time_ns)"""
)
def wal_delete_seq(spark, sf_dir):
    e = events(spark, sf_dir)
    dels = e.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("seq"), (F.col("time_ns") - 2 * DAY).alias("min_time"), F.col("time_ns").alias("max_time"))
    writes = e.where("event_type <> 'signup'").select("event_id", "user_id", "time_ns", F.col("event_id").alias("seq"))
    return deletes.without_later_deletes(writes, dels, ["user_id"]).select("event_id", "user_id", "time_ns")


@query("SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-06'")
def time_range_half_open(spark, sf_dir):
    day = lambda d: F.lit(d).cast("timestamp_ntz")
    return read(spark, sf_dir, "events").where(filters.between(F.col("ts"), day("2024-01-05"), day("2024-01-06"))).select("event_id", "value")


@query(
    """SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m') AS label, count(*) AS n, CAST(sum(CAST(o_totalprice * 100 AS BIGINT)) AS BIGINT) AS cents
       FROM orders GROUP BY 1"""
)
def month_windows(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumn("at", F.col("o_orderdate").cast("timestamp"))
    cents = (F.col("o_totalprice") * 100).cast("decimal(20,0)").cast("bigint")
    start = timeutil.month_start(F.col("at"))
    return o.groupBy(timeutil.window_label(start, timeutil.next_month(start)).alias("label")).agg(F.count("*").alias("n"), F.sum(cents).alias("cents"))


@query(
    """WITH b AS (SELECT o_orderstatus AS shard, date_trunc('day', min(o_orderdate)) + INTERVAL 12 HOUR AS s, date_trunc('day', max(o_orderdate)) AS e FROM orders GROUP BY 1),
       w AS (SELECT shard, greatest(m, s) AS a, least(m + INTERVAL 1 MONTH, e) AS z, m FROM b, unnest(generate_series(date_trunc('month', s), date_trunc('month', e - INTERVAL 1 MICROSECOND), INTERVAL 1 MONTH)) AS u(m))
       SELECT shard, epoch_us(a) * 1000 AS start_ns, epoch_us(z) * 1000 AS end_ns, CASE WHEN a = m AND z = m + INTERVAL 1 MONTH THEN strftime(a, '%Y-%m')
       ELSE strftime(a, '%Y%m%dT%H%M%SZ') || '__' || strftime(z, '%Y%m%dT%H%M%SZ') END AS label FROM w"""
)
def month_labels_clipped(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumn("at", F.col("o_orderdate").cast("timestamp"))
    b = o.groupBy(F.col("o_orderstatus").alias("shard")).agg((F.date_trunc("day", F.min("at")) + F.expr("interval 12 hours")).alias("s"), F.date_trunc("day", F.max("at")).alias("e"))
    return shard.expand(b, F.col("s"), F.col("e")).select("shard", timeutil.to_ns(F.col("w_start")).alias("start_ns"), timeutil.to_ns(F.col("w_end")).alias("end_ns"), "label")


@query(
    f"""SELECT part_no, count(*) AS n, min(time_ns) AS min_ns, max(time_ns) AS max_ns, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types, count(DISTINCT user_id) AS users
        FROM (SELECT *, (row_number() OVER (ORDER BY user_id, time_ns, event_id) - 1) // 1000 AS part_no FROM {SQL_HOURLY}) GROUP BY part_no"""
)
def part_index(spark, sf_dir):
    rows = ordered.parts(events(spark, sf_dir), ["user_id", "time_ns", "event_id"], 1000)
    return rows.groupBy("part_no").agg(F.count("*").alias("n"), F.min("time_ns").alias("min_ns"), F.max("time_ns").alias("max_ns"), F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("types"), F.countDistinct("user_id").alias("users"))


@query(
    """SELECT l_orderkey, max(CAST(length(rtrim(split_part(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', 2), '0')) AS INTEGER)) AS scale FROM lineitem GROUP BY 1"""
)
def decimal_scale(spark, sf_dir):
    text = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    return read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max(decimalx.decimal_scale(text)).alias("scale"))


_ODD = "CASE o_orderkey % 6 WHEN 0 THEN '1e3' WHEN 1 THEN ' 1 ' WHEN 2 THEN '.' WHEN 3 THEN '-' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS {s}) WHEN 4 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS {s}) || '5' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS {s}) END"


@query(
    f"""WITH t AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS p, {_ODD.format(s="VARCHAR")} AS txt FROM orders)
        SELECT o_orderkey, txt, o_orderkey % 6 IN (3, 5) AS fits, CASE o_orderkey % 6 WHEN 3 THEN CAST(-p * 100 AS BIGINT) WHEN 5 THEN CAST(p * 100 AS BIGINT) ELSE 0 END AS scaled FROM t"""
)
def scaled_int(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumn("txt", F.expr(_ODD.format(s="STRING")))
    scaled = decimalx.scaled_int(F.col("txt"), 2)
    return o.select("o_orderkey", "txt", scaled.isNotNull().alias("fits"), F.coalesce(scaled, F.lit(0)).alias("scaled"))


def sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of an order as levels of a book side: price, quantity, liquidations, orders."""
    text = lambda c: F.col(c).cast("decimal(18,2)").cast("string")
    level = F.struct(F.col("l_linenumber").alias("k"), text("l_extendedprice").alias("px"), text("l_quantity").alias("sz"), F.col("l_partkey").cast("string").alias("liq"), F.col("l_suppkey").cast("string").alias("orders"))
    rows = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(level)).alias("v"))
    cells = lambda v: F.concat(F.lit('["'), F.concat_ws('","', v["px"], v["sz"], v["liq"], v["orders"]), F.lit('"]'))
    return rows.select("l_orderkey", F.concat(F.lit("["), F.array_join(F.transform("v", cells), ","), F.lit("]")).alias("payload"))


_LEVELS = """(SELECT l_orderkey, l_linenumber AS k, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS px, CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS sz,
    CAST(l_partkey AS VARCHAR) AS liq, CAST(l_suppkey AS VARCHAR) AS orders FROM lineitem)"""
_SIDES = f"""(SELECT l_orderkey, '[' || string_agg('["' || px || '","' || sz || '","' || liq || '","' || orders || '"]', ',' ORDER BY k, px, sz, liq, orders) || ']' AS payload FROM {_LEVELS} GROUP BY 1)"""


@query(f"SELECT * FROM {_SIDES}")
def book_json(spark, sf_dir):
    return sides(spark, sf_dir)


@query(
    """SELECT l_orderkey, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS px, CAST(CAST(l_quantity AS DECIMAL(18,2)) * 100 AS BIGINT) AS sz, l_partkey AS liq, l_suppkey AS orders FROM lineitem"""
)
def book_levels(spark, sf_dir):
    return sides(spark, sf_dir).select("l_orderkey", F.inline(book.levels(F.col("payload"), 2, 2)))


def _le(x: str) -> str:
    return "".join(f"substr(printf('%016X', {x}), {k}, 2)" + (" || " if k > 1 else "") for k in range(15, 0, -2))


@query(
    f"""SELECT l_orderkey, '01' || left({_le("count(*)")}, 8) || string_agg({_le("px")} || {_le("sz")} || {_le("liq")} || {_le("orders")}, '' ORDER BY k, pt, st, lt, ot) AS packed_hex FROM (
        SELECT l_orderkey, k, px AS pt, sz AS st, liq AS lt, orders AS ot, CAST(CAST(px AS DECIMAL(18,2)) * 100 AS BIGINT) AS px, CAST(CAST(sz AS DECIMAL(18,2)) * 100 AS BIGINT) AS sz,
        CAST(liq AS BIGINT) AS liq, CAST(orders AS BIGINT) AS orders FROM {_LEVELS}) GROUP BY 1"""
)
def book_pack_hex(spark, sf_dir):
    return sides(spark, sf_dir).select("l_orderkey", F.hex(book.pack(F.col("payload"), 2, 2)).alias("packed_hex"))


@query(
    f"""SELECT l_orderkey, '[' || string_agg('["' || rtrim(rtrim(px, '0'), '.') || '","' || rtrim(rtrim(sz, '0'), '.') || '","' || liq || '","' || orders || '"]', ',' ORDER BY k, px, sz, liq, orders) || ']' AS side FROM {_LEVELS} GROUP BY 1"""
)
def book_roundtrip(spark, sf_dir):
    packed = book.pack(F.col("payload"), 2, 2)
    return sides(spark, sf_dir).select("l_orderkey", book.reconstruct(F.lit(None).cast("string"), packed, 2, 2).alias("side"))


@query(
    f"""SELECT l_orderkey, CASE WHEN l_orderkey % 7 IN (0, 1) THEN payload || 'x' WHEN l_orderkey % 7 = 2 THEN '' ELSE payload END AS payload,
        l_orderkey % 7 >= 3 AS is_packed, CASE WHEN l_orderkey % 7 IN (0, 1) THEN payload || 'x' END AS raw FROM {_SIDES}"""
)
def raw_fallback(spark, sf_dir):
    k = F.col("l_orderkey") % 7
    rows = sides(spark, sf_dir).withColumn("payload", F.when(k.isin(0, 1), F.concat("payload", F.lit("x"))).when(k == 2, F.lit("")).otherwise(F.col("payload")))
    rows = rows.withColumn("e", book.encode_side(F.col("payload"), 2, 2))
    return rows.select("l_orderkey", "payload", F.col("e.packed").isNotNull().alias("is_packed"), F.col("e.raw").alias("raw"))


@query("""SELECT 'event_type' AS tag, count(DISTINCT event_type) AS n FROM events UNION ALL SELECT 'user', count(DISTINCT user_id) FROM events""")
def shard_tag_cardinality(spark, sf_dir):
    tags = F.create_map(F.lit("user"), F.col("user_id").cast("string"), F.lit("event_type"), F.col("event_type"))
    return shard.tag_cardinality(read(spark, sf_dir, "events").select(tags.alias("tags")))


_MON = "strftime(o_orderdate, '%d') || upper(strftime(o_orderdate, '%b')) || strftime(o_orderdate, '%y')"


@query(
    f"""SELECT o_orderkey, 'C' || o_custkey % 10 || '-' || upper(strftime(o_orderdate, '%b')) || strftime(o_orderdate, '%y') AS bucket,
        '^C' || o_custkey % 10 || '-[0-9]{{1,2}}' || upper(strftime(o_orderdate, '%b')) || strftime(o_orderdate, '%y') || '-' AS regex FROM orders"""
)
def contract_bucket(spark, sf_dir):
    contract = F.concat(F.lit("C"), (F.col("o_custkey") % 10).cast("string"), F.lit("-"), F.date_format("o_orderdate", "ddMMMyy"), F.lit("-100-P"))
    return read(spark, sf_dir, "orders").select("o_orderkey", series.contract_month(contract).alias("c")).select("o_orderkey", "c.bucket", "c.regex")


@query("""SELECT event_id, 'm' AS measurement, CAST(user_id AS VARCHAR) AS user, event_type AS type FROM events""")
def series_key_parse(spark, sf_dir):
    key = F.concat(F.lit("m,user="), F.col("user_id").cast("string"), F.lit(",type="), F.col("event_type"))
    rows = read(spark, sf_dir, "events").select("event_id", series.parse_series_key(key).alias("k"))
    return rows.select("event_id", "k.measurement", F.col("k.tags")["user"].alias("user"), F.col("k.tags")["type"].alias("type"))


@query(f"SELECT user_id, event_type, time_ns, event_id FROM {SQL_HOURLY} ORDER BY user_id, event_type, time_ns, event_id LIMIT 500")
def limit_across_series(spark, sf_dir):
    order = ["user_id", "event_type", "time_ns", "event_id"]
    return filters.existing(events(spark, sf_dir).orderBy(*order), order, 500)


@query("SELECT event_id, value FROM events ORDER BY event_id LIMIT 20")
def head_rows(spark, sf_dir):
    return filters.existing(read(spark, sf_dir, "events").orderBy("event_id"), ["event_id", "value", "absent"], 20)


@query(
    """SELECT l_suppkey, count(*) AS n, CAST(sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT)) AS BIGINT) AS cents, count(*) FILTER (l_linestatus = 'F') AS completed,
       count(*) FILTER (l_linestatus = 'O') AS active, CASE WHEN count(*) FILTER (l_linestatus = 'O') > 0 THEN count(*) FILTER (l_linestatus = 'F') / count(*) FILTER (l_linestatus = 'O') END AS ratio FROM lineitem GROUP BY 1"""
)
def measurement_rollup(spark, sf_dir):
    """The lines of a supplier as the datasets of a measurement."""
    status = F.when(F.col("l_linestatus") == "F", "completed").when(F.col("l_linestatus") == "O", "active").alias("status")
    cents = (F.col("l_extendedprice").cast("decimal(18,2)") * 100).cast("bigint").alias("actual")
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("measurement"), status, cents, *[F.lit(1).cast("bigint").alias(c) for c in ("parts", "rows", "compressed", "uncompressed")])
    rows = report.by_measurement(rows).withColumn("ratio", decimalx.ratio(F.col("completed"), F.col("active")))
    return rows.select(F.col("measurement").alias("l_suppkey"), F.col("datasets").alias("n"), F.col("actual").alias("cents"), "completed", "active", "ratio")


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def status_histogram(spark, sf_dir):
    return report.status_counts(read(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status")))


@query(f"SELECT user_id, event_type, count(*) AS n, min(time_ns) AS min_ns, max(time_ns) AS max_ns FROM {SQL_HOURLY} GROUP BY 1, 2")
def field_counts(spark, sf_dir):
    points = events(spark, sf_dir).select(F.lit("events").alias("source_id"), F.col("user_id").alias("inst_id"), F.col("event_type").alias("field"), "time_ns")
    return sink.manifest(points).select(F.col("inst_id").alias("user_id"), F.col("field").alias("event_type"), "n", F.col("min_time").alias("min_ns"), F.col("max_time").alias("max_ns"))


@query(
    """SELECT coalesce(o.k, l.k) AS key, CASE WHEN l.k IS NULL THEN 'old_only' WHEN o.k IS NULL THEN 'new_only' WHEN o.n IS DISTINCT FROM l.n THEN 'differ' ELSE 'same' END AS state, coalesce(o.n, -1) AS old_n, coalesce(l.n, -1) AS new_n
       FROM (SELECT o_orderkey AS k, count(*) AS n FROM orders GROUP BY 1) o FULL JOIN (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1) l ON o.k = l.k"""
)
def manifest_diff(spark, sf_dir):
    old = read(spark, sf_dir, "orders").groupBy(F.col("o_orderkey").alias("key")).agg(F.count("*").alias("n"))
    new = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.count("*").alias("n"))
    return verify.manifest_diff(old, new, ["key"], ["n"]).fillna(-1, ["old_n", "new_n"])


@query(
    """WITH a AS (SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS rn, event_id FROM events), b AS (SELECT row_number() OVER (ORDER BY value, event_id) - 1 AS rn, event_id FROM events WHERE event_id % 11 <> 0)
       SELECT count(a.rn) AS n_left, count(b.rn) AS n_right, min(CASE WHEN a.event_id IS DISTINCT FROM b.event_id THEN coalesce(a.rn, b.rn) END) AS first_mismatch FROM a FULL JOIN b USING (rn)"""
)
def zip_compare(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    left = ordered.numbered(e, ["ts", "event_id"]).select("event_id", F.col("row_no").alias("at"))
    right = ordered.numbered(e.where("event_id % 11 <> 0"), ["value", "event_id"]).select("event_id", F.col("row_no").alias("at"))
    a, b = left.select("at", F.struct("event_id").alias("x")), right.select("at", F.struct("event_id").alias("y"))
    return verify.first_difference(a, b)


@query("""SELECT event_id, user_id FROM (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) WHERE p >= value""")
def strict_increase(spark, sf_dir):
    return ordered.not_increasing(read(spark, sf_dir, "events"), ["user_id"], "value", ["ts", "event_id"]).select("event_id", "user_id")


@query(
    """SELECT event_id, user_id, CAST(sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run_id FROM (
       SELECT *, CASE WHEN row_number() OVER w > 1 AND lag(event_type) OVER w IS DISTINCT FROM event_type THEN 1 ELSE 0 END AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""
)
def series_runs(spark, sf_dir):
    return ordered.runs(read(spark, sf_dir, "events"), ["user_id"], "event_type", ["ts", "event_id"]).select("event_id", "user_id", "run_id")


@query(
    """SELECT user_id, event_id, sample_rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS sample_rank, count(*) OVER (PARTITION BY user_id) AS n FROM events)
       WHERE sample_rank IN (0, n // 2, n - 1)"""
)
def sample_ranks(spark, sf_dir):
    return ordered.sample_ranks(read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "sample_rank")


@query(
    """SELECT l_orderkey, l_linenumber, expected FROM (SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS INTEGER) AS expected FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) WHERE expected <> l_linenumber"""
)
def contiguous_prefix(spark, sf_dir):
    return ordered.gaps(read(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber", 1)


@query(
    """SELECT 'both' AS part, count(*) AS n FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders) UNION ALL
       SELECT 'customer_only', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders) UNION ALL
       SELECT 'all', count(*) FROM (SELECT c_custkey FROM customer UNION ALL SELECT o_custkey FROM orders)"""
)
def source_setops(spark, sf_dir):
    c, o = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    count = lambda df, part: df.agg(F.count("*").alias("n")).select(F.lit(part).alias("part"), "n")
    return count(c.intersect(o), "both").union(count(c.distinct().join(o, "k", "left_anti"), "customer_only")).union(count(c.unionByName(o), "all"))


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))")
def instid_semi(spark, sf_dir):
    wanted = read(spark, sf_dir, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey")
    return filters.among(read(spark, sf_dir, "orders"), "o_custkey", wanted).select("o_orderkey")


@query(
    """SELECT d, event_id, c.c_name AS name FROM (SELECT *, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) AS n, strftime(ts, '%Y-%m-%d') AS d FROM events) e
       JOIN customer c ON c.c_custkey = e.user_id WHERE n = 1"""
)
def first_row_lookup(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("d", F.date_format("ts", "yyyy-MM-dd"))
    first = ordered.first_rows(e, ["d"], ["ts", "event_id"], 1)
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))
    return first.join(c, "user_id").select("d", "event_id", "name")


@query(
    """WITH s AS (SELECT DISTINCT c_mktsegment AS shard FROM customer) SELECT shard, strftime(m, '%Y-%m') AS label, epoch_us(m) * 1000 AS start_ns, epoch_us(m + INTERVAL 1 MONTH) * 1000 AS end_ns
       FROM s, unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '1996-12-01', INTERVAL 1 MONTH)) AS u(m)"""
)
def task_crossjoin(spark, sf_dir):
    s = read(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("shard")).distinct()
    at = lambda t: F.lit(t).cast("timestamp")
    return shard.expand(s, at("1995-01-01 00:00:00"), at("1997-01-01 00:00:00")).select("shard", "label", timeutil.to_ns(F.col("w_start")).alias("start_ns"), timeutil.to_ns(F.col("w_end")).alias("end_ns"))


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 END AS code, CASE event_type WHEN 'click' THEN 'snapshot' WHEN 'view' THEN 'update' END AS name FROM events WHERE event_type IN ('click', 'view')""")
def enum_codes(spark, sf_dir):
    e = read(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view"))
    code = book.action_code(F.when(F.col("event_type") == "click", "snapshot").otherwise("update"))
    return e.select("event_id", code.alias("code")).withColumn("name", book.action_name(F.col("code")))


@query(
    """SELECT event_id, t AS time_ns, strftime(make_timestamp(t // 1000), '%Y-%m-%dT%H:%M:%S') || CASE WHEN t % 1000000000 = 0 THEN '' ELSE '.' || lpad(CAST(t % 1000000000 AS VARCHAR), 9, '0') END || 'Z' AS text
       FROM (SELECT event_id, epoch_us(ts) * 1000 + event_id % 1000 AS t FROM events)"""
)
def rfc3339_ns(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", timeutil.ns_text(F.col("time_ns") + F.col("event_id") % 1000).alias("text"))
    return rows.select("event_id", timeutil.rfc3339_ns(F.col("text")).alias("time_ns"), "text")


@query("""SELECT e.event_id FROM events e LEFT JOIN (SELECT user_id, max(event_id) AS h FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1) m ON m.user_id = e.user_id WHERE m.h IS NULL OR e.event_id > m.h""")
def resume_hwm(spark, sf_dir):
    """What an export that had come to a time still needs; users without a mark are new as a whole."""
    e = read(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    marks = e.where(F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-16 00:00:00"))).groupBy("user_id").agg(F.max("event_id").alias("mark"))
    return stream.incremental(e, marks, ["user_id"], "event_id").select("event_id")


@query("""SELECT p_partkey, p_type FROM part WHERE p_brand NOT IN ('Brand#11', 'Brand#22', 'Brand#33')""")
def retain_policy(spark, sf_dir):
    return filters.retained(read(spark, sf_dir, "part"), "p_brand", ["Brand#11", "Brand#22", "Brand#33"]).select("p_partkey", "p_type")


@query(
    """SELECT l_suppkey AS k, CAST(sum(CAST(CAST(l_quantity AS DECIMAL(18,2)) * 1048576 AS BIGINT)) AS BIGINT) AS size FROM lineitem GROUP BY 1 ORDER BY size DESC, k LIMIT 20"""
)
def largest_datasets(spark, sf_dir):
    size = F.sum((F.col("l_quantity").cast("decimal(18,2)") * 1048576).cast("bigint"))
    datasets = read(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("dataset")).agg(size.alias("actual"))
    return report.ordered_by(datasets, "actual").limit(20).select(F.col("dataset").alias("k"), F.col("actual").alias("size"))


@query(
    """SELECT p_partkey, replace(replace(trim(p_brand || '/' || p_type), '/', '_'), '*', '_') AS safe, '"' || p_brand || '"' AS ident, '''' || p_type || '''' AS lit FROM part"""
)
def names_and_quotes(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", series.sanitize_name(F.concat_ws("/", "p_brand", "p_type")).alias("safe"), series.quote_ident(F.col("p_brand")).alias("ident"), series.quote_string(F.col("p_type")).alias("lit"))


@query(
    """SELECT event_id, user_id, epoch_us(ts) * 1000 AS time_ns, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""
)
def line_protocol(spark, sf_dir):
    """Renders events as line protocol, with noise before some lines, and reads them back."""
    noise = F.when(F.col("event_id") % 3 == 0, "noise ").otherwise("")
    k = F.get_json_object("props", "$.k")
    line = F.concat(noise, F.lit("ev,user="), F.col("user_id").cast("string"), F.lit(" k="), k, F.lit("i,id="), F.col("event_id").cast("string"), F.lit("i "), F.col("time_ns").cast("string"))
    rows = events(spark, sf_dir).select(series.lp_line(line, "ev").alias("p"))
    field = lambda n: F.col("p.fields")[n]["l"]
    return rows.select(field("id").alias("event_id"), F.col("p.tags")["user"].cast("bigint").alias("user_id"), "p.time_ns", field("k").alias("k"))



@query(f"SELECT user_id, event_type AS field, time_ns, event_id FROM {SQL_HOURLY} WHERE time_ns >= {START + 3 * DAY} AND time_ns < {START + 17 * DAY} AND event_type IN ('click', 'view') AND NOT (user_id = 5 AND event_type = 'click' AND time_ns BETWEEN {START + 5 * DAY} AND {START + 8 * DAY})")
def storage_roundtrip(spark, sf_dir):
    """Each user's events become a storage file, which is read back with fields and times pruned and a tombstone applied."""

    def encode(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        series: dict[bytes, list] = {}
        for field in sorted(set(rows.column("event_type").to_pylist())):
            own = rows.filter(pa.compute.equal(rows.column("event_type"), field)).sort_by([("time_ns", "ascending"), ("event_id", "ascending")])
            times, ids = own.column("time_ns").to_pylist(), own.column("event_id").to_pylist()
            series[f"ev,instId={key[0].as_py()}#!~#{field}".encode()] = [(codecs.INTEGER, times[k : k + 10], ids[k : k + 10]) for k in range(0, len(times), 10)]
        return pa.table({"source_id": [f"u{key[0].as_py()}"], "shard_id": pa.array([1], pa.int32()), "generation": pa.array([1], pa.int32()), "sequence": pa.array([1], pa.int32()), "content": pa.array([tsm.write_tsm(series)], pa.binary())})

    files = events(spark, sf_dir).select("user_id", "event_type", "time_ns", "event_id").groupBy("user_id").applyInArrow(encode, "source_id string, shard_id int, generation int, sequence int, content binary")
    rows = tsm.decoded(files, fields=["click", "view"], start=START + 3 * DAY, end=START + 17 * DAY)
    tombs = spark.createDataFrame([("u5", "ev,instId=5", "click", START + 5 * DAY, START + 8 * DAY)], "source_id string, series string, field string, min_time bigint, max_time bigint")
    return deletes.without_tombstones(rows, tombs).select(F.col("inst_id").cast("bigint").alias("user_id"), "field", "time_ns", F.col("v_long").alias("event_id"))


@query(
    f"""SELECT user_id, hour_ns AS time_ns, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, hour_ns ORDER BY event_id DESC) AS n FROM {SQL_HOURLY} e WHERE event_type <> 'signup'
        AND NOT EXISTS (SELECT 1 FROM {SQL_HOURLY} d WHERE d.event_type = 'signup' AND d.user_id = e.user_id AND d.event_id > e.event_id AND e.hour_ns BETWEEN d.hour_ns - {DAY} AND d.hour_ns)) WHERE n = 1"""
)
def wal_replay(spark, sf_dir):
    """Each user's events become a log: a write each, but a signup deletes the day before it."""

    def encode(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        name, out = f"ev,instId={key[0].as_py()}#!~#id".encode(), bytearray()
        for r in rows.sort_by("event_id").to_pylist():
            out += wal.delete_range_entry([name], r["hour_ns"] - DAY, r["hour_ns"]) if r["event_type"] == "signup" else wal.write_entry([(name, wal.INTEGER, [(r["hour_ns"], r["event_id"])])])
        return pa.table({"shard_id": pa.array([key[0].as_py()], pa.int32()), "segment": pa.array([1], pa.int64()), "content": pa.array([bytes(out)], pa.binary())})

    logs = hourly(events(spark, sf_dir)).select("user_id", "event_type", "hour_ns", "event_id").groupBy("user_id").applyInArrow(encode, "shard_id int, segment bigint, content binary")
    return wal.replayed(wal.decoded(logs)).select(F.col("inst_id").cast("bigint").alias("user_id"), "time_ns", F.col("v_long").alias("event_id"))


@query(f"SELECT time_ns AS time, CAST(user_id AS VARCHAR) AS instrument, value AS price, event_id AS id FROM {SQL_HOURLY}")
def chunked_rows(spark, sf_dir):
    """Events as chunked query results, ten rows a chunk, read back by column name."""
    cell = F.array(F.col("time_ns").cast("string"), F.col("user_id").cast("string"), F.col("value").cast("string"), F.col("event_id").cast("string"))
    chunks = events(spark, sf_dir).groupBy(F.floor(F.col("event_id") / 10)).agg(F.collect_list(cell).alias("values"))
    one = F.struct(F.lit("ev").alias("name"), F.array(*[F.lit(c) for c in ("time", "instrument", "price", "id")]).alias("columns"), F.col("values"))
    text = chunks.select(F.to_json(F.struct(F.array(F.struct(F.array(one).alias("series"))).alias("results"))).alias("value"))
    return text_sources.chunk_rows(text, {"price": "float", "id": "integer"}, ["instrument"])


@query("SELECT count(*) AS n, true AS small_parts, true AS all_indexed FROM events")
def dataset_publish(spark, sf_dir):
    """Publishes events as a dataset of small parts and reads its index and summary."""
    to = f"{spark.conf.get('spark.checkpoint.dir', None) or tempfile.mkdtemp()}/{uuid.uuid4().hex}/events.parquet"
    told = sink.write(events(spark, sf_dir).select("time_ns", "user_id", "event_type", "value"), to, ["time_ns", "user_id"], rows_per_file=1500, told={"measurement": "events", "tags": ["event_type"]})
    index = sink.part_index(spark, to)
    return index.agg(F.sum("rows").alias("n"), (F.max("rows") <= 1500).alias("small_parts"), (F.sum("rows") == told["rows"]).alias("all_indexed"))


@query("SELECT CAST(l_orderkey AS BIGINT) AS inst_id, l_linenumber AS time_ns FROM lineitem WHERE l_orderkey % 97 = 0 GROUP BY 1, 2")
def merge_verify(spark, sf_dir):
    """A merged table with changed values is compared with what its sources give."""
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("inst_id"), F.lit("f").alias("field"), F.col("l_linenumber").cast("bigint").alias("time_ns"), F.col("l_partkey").alias("payload"), F.lit(1).alias("shard_id"), F.lit("tsm").alias("kind"), F.lit(1).alias("generation"), F.col("l_suppkey").alias("sequence"), F.col("l_extendedprice").cast("string").alias("source_id"), F.col("l_partkey").alias("pos"))
    merged = lww.latest_points(rows).withColumn("payload", F.when(F.col("inst_id") % 97 == 0, -1).otherwise(F.col("payload")))
    return verify.merge_faults(rows, merged).select("inst_id", F.col("time_ns").cast("int").alias("time_ns"))


@query("SELECT l_orderkey AS inst_id, CASE WHEN l_orderkey % 101 = 0 THEN 'differ' END AS state FROM lineitem WHERE l_orderkey % 101 = 0 GROUP BY 1")
def build_verify(spark, sf_dir):
    """A built order book with changed checksums is compared with what its texts give."""
    rows = sides(spark, sf_dir).select(F.col("l_orderkey").alias("inst_id"), F.lit(1).cast("bigint").alias("time_ns"), F.lit("update").alias("action"), F.col("payload").alias("asks"), F.lit("[]").alias("bids"), F.col("l_orderkey").alias("checksum"), F.lit("1700000000000").alias("ts"))
    built = verify.book_rows(rows.withColumn("px_scale", F.lit(4)).withColumn("sz_scale", F.lit(4)))
    return verify.build_faults(rows, built.withColumn("checksum", F.when(F.col("inst_id") % 101 == 0, -1).otherwise(F.col("checksum")))).select("inst_id", "state")


@query(f"SELECT user_id, event_type, max(event_id) AS event_id FROM {SQL_HOURLY} GROUP BY 1, 2")
def stream_lww(spark, sf_dir):
    """The events table as a stream that ends with what is there."""
    schema = read(spark, sf_dir, "events").schema
    base = f"{spark.conf.get('spark.checkpoint.dir', None) or tempfile.mkdtemp()}/{uuid.uuid4().hex}"
    incoming = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).select("user_id", "event_type", "event_id")
    keys, order = ["user_id", "event_type"], ["event_id"]
    stream.start(incoming, f"{base}/out", keys, order, f"{base}/checkpoint").awaitTermination()
    return stream.current(spark, f"{base}/out", keys, order).select("user_id", "event_type", "event_id")


@query("SELECT p_brand AS measurement, count(*) AS datasets, count(*) FILTER (p_size % 3 = 0) AS completed, CAST(sum(p_partkey) AS BIGINT) AS actual FROM part GROUP BY 1")
def report_rollup(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    own = p.select(F.col("p_brand").alias("measurement"), F.col("p_name").alias("dataset"), F.when(F.col("p_size") % 3 == 0, "completed").otherwise("active").alias("status"), *[F.col("p_partkey").alias(c) for c in ("parts", "rows", "actual", "compressed", "uncompressed")])
    return report.by_measurement(own).select("measurement", "datasets", "completed", "actual")


@query("SELECT 'C' || o_custkey % 10 || '-' || upper(strftime(o_orderdate, '%b')) || strftime(o_orderdate, '%y') AS shard FROM orders GROUP BY 1")
def contract_tasks(spark, sf_dir):
    contract = F.concat(F.lit("C"), (F.col("o_custkey") % 10).cast("string"), F.lit("-"), F.date_format("o_orderdate", "ddMMMyy"), F.lit("-100-P"))
    return shard.contract_tasks(read(spark, sf_dir, "orders").select(F.create_map(F.lit("instId"), contract).alias("tags")), "instId").select("shard")


@query(f"SELECT 'ev' || user_id % 3 AS source_id, CAST(user_id AS VARCHAR) AS inst_id, event_type AS field, count(*) AS n, min(time_ns) AS min_time, max(time_ns) AS max_time FROM {SQL_HOURLY} GROUP BY 1, 2, 3")
def source_manifest(spark, sf_dir):
    e = events(spark, sf_dir)
    return sink.manifest(e.select(F.concat(F.lit("ev"), (F.col("user_id") % 3).cast("string")).alias("source_id"), F.col("user_id").cast("string").alias("inst_id"), F.col("event_type").alias("field"), "time_ns"))


@query("SELECT o_orderkey, array_to_string(list_sort(list_distinct([CAST(o_custkey AS VARCHAR), CAST(o_orderkey % 7 AS VARCHAR)])), ',') AS ids FROM orders")
def ids_in_dump(spark, sf_dir):
    """Instruments of the keys in a dump of an index; keys of other measurements do not count."""
    key = lambda c: F.concat(F.lit("ev,instId="), c.cast("string"))
    dump = F.concat_ws(" ", key(F.col("o_custkey")), F.lit("other,instId=no"), F.concat(key(F.col("o_orderkey") % 7), F.lit(",k=1")), key(F.col("o_custkey")))
    return read(spark, sf_dir, "orders").select("o_orderkey", F.array_join(series.ids_in(dump, "ev"), ",").alias("ids"))


@query("SELECT o_custkey, bool_and(o_orderstatus = 'F') AS scan_complete, bool_or(o_orderstatus = 'F') AS any_complete FROM orders GROUP BY 1")
def scan_flags(spark, sf_dir):
    return report.all_complete(read(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus", "F")


@query("SELECT p_partkey, CASE WHEN length(p_type) <= 12 THEN p_type ELSE substr(p_type, 1, 9) || '...' END AS preview FROM part")
def previews(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", series.preview(F.col("p_type"), 12).alias("preview"))


@query(
    """SELECT *, row_number() OVER (ORDER BY shard_id, kind = 'wal', generation, sequence, source_id) - 1 AS rank FROM (SELECT DISTINCT l_suppkey % 4 AS shard_id, CASE WHEN l_linestatus = 'F' THEN 'wal' ELSE 'tsm' END AS kind,
       CASE WHEN l_linestatus = 'F' THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS generation, l_partkey AS sequence, l_suppkey AS source_id FROM lineitem)"""
)
def source_read_order(spark, sf_dir):
    log = F.col("l_linestatus") == "F"
    rows = read(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 4).alias("shard_id"), F.when(log, "wal").otherwise("tsm").alias("kind"), F.when(log, F.lit(0).cast("bigint")).otherwise(F.col("l_quantity").cast("bigint")).alias("generation"), F.col("l_partkey").alias("sequence"), F.col("l_suppkey").alias("source_id"),
    )
    return lww.read_order(rows.distinct())
