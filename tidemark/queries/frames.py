"""The synthetic tables in the shapes the operators take, and the same shapes as DuckDB's common table expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.bars import daily_bars, minute_bars

SPINE_START, SPINE_END = "2024-01-01", "2024-01-30"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with its instants as UTC timestamps."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({c: F.col(c).cast("timestamp") for c, k in df.dtypes if k == "timestamp_ntz"})


def hours(n: Column) -> Column:
    return F.make_interval(hours=n.cast("int"))


def facts(spark: SparkSession, sf_dir: str, global_type: str | None = None) -> DataFrame:
    """Events as facts of their user: known some hours late, by id; one type may belong to everyone."""
    e = table(spark, sf_dir, "events")
    entity = F.col("user_id").cast("string")
    if global_type:
        entity = F.when(F.col("event_type") == global_type, "GLOBAL").otherwise(entity)
    return e.select(
        entity.alias("entity"), F.col("event_type").alias("feature"), F.date_trunc("hour", "ts").alias("event_time"),
        (F.col("ts") + hours(F.col("event_id") % 7)).alias("knowable_at"), F.lit("events").alias("source_table"), F.col("event_id").cast("string").alias("source_ref"), "value",
    )


FACTS = """facts AS (SELECT CAST(user_id AS VARCHAR) AS entity, event_type AS feature, date_trunc('hour', ts) AS event_time,
  ts + to_hours(CAST(event_id % 7 AS INTEGER)) AS knowable_at, 'events' AS source_table, CAST(event_id AS VARCHAR) AS source_ref, value FROM events)"""


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user at 06:00 of every day."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(SPINE_START).cast("date"), F.lit(SPINE_END).cast("date"))).alias("d"))
    users = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("entity")).distinct()
    return users.crossJoin(F.broadcast(days)).select("entity", (F.col("d").cast("timestamp") + F.make_interval(hours=F.lit(6))).alias("as_of"))


SPINE = """spine AS (SELECT entity, d + INTERVAL 6 HOUR AS as_of FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS entity FROM events),
  (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) AS d))"""

#: The winner's order, as the operator's struct has it.
WINNER = "event_time DESC, knowable_at DESC, source_table DESC, source_ref DESC, value DESC"


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trades of their type: known a few seconds late."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("symbol"), F.col("event_id").alias("trade_id"), F.col("value").cast("decimal(28,10)").alias("price"),
        (F.col("event_id") % 5).cast("decimal(28,10)").alias("quantity"), F.col("ts").alias("event_time"), (F.col("ts") + F.make_interval(secs=(F.col("event_id") % 7).cast("int"))).alias("knowable_at"),
    )


def minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minute_bars(trades(spark, sf_dir))


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_bars(minutes(spark, sf_dir))


TRADES = """trades AS (SELECT event_type AS symbol, event_id AS trade_id, CAST(value AS DECIMAL(28,10)) AS price, CAST(event_id % 5 AS DECIMAL(28,10)) AS quantity,
  ts AS event_time, ts + to_seconds(CAST(event_id % 7 AS INTEGER)) AS knowable_at FROM events)"""

MINUTES = f"""{TRADES},
minutes AS (SELECT symbol, date_trunc('minute', event_time) AS bar_time,
  arg_min(price, (event_time, trade_id)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (event_time, trade_id)) AS close,
  sum(quantity) AS volume, count(*) AS trades,
  CASE WHEN sum(CAST(quantity AS DOUBLE)) > 0 THEN sum(CAST(price AS DOUBLE) * CAST(quantity AS DOUBLE)) / sum(CAST(quantity AS DOUBLE)) END AS vwap,
  greatest(date_trunc('minute', event_time) + INTERVAL 1 MINUTE, max(knowable_at)) AS knowable_at FROM trades GROUP BY 1, 2)"""

DAYS = f"""{MINUTES},
days AS (SELECT symbol, CAST(bar_time AS DATE) AS session_date, arg_min(open, bar_time) AS open, max(high) AS high, min(low) AS low, arg_max(close, bar_time) AS close,
  sum(volume) AS volume, CAST(sum(trades) AS BIGINT) AS trades, count(*) AS minutes,
  CASE WHEN sum(CASE WHEN vwap IS NOT NULL THEN CAST(volume AS DOUBLE) END) > 0 THEN sum(vwap * CAST(volume AS DOUBLE)) / sum(CASE WHEN vwap IS NOT NULL THEN CAST(volume AS DOUBLE) END) END AS vwap,
  greatest(CAST(CAST(bar_time AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY, max(knowable_at)) AS knowable_at FROM minutes GROUP BY 1, 2)"""

#: Windows and features over daily bars.
PRICE = f"""{DAYS},
r AS (SELECT *, ln(CAST(close AS DOUBLE) / lag(CAST(close AS DOUBLE)) OVER (PARTITION BY symbol ORDER BY session_date)) AS ret FROM days),
w AS (SELECT *, count(ret) OVER v AS n, stddev_samp(ret) OVER v AS sd, avg(CAST(volume AS DOUBLE)) OVER v AS mean,
  max(knowable_at) OVER (PARTITION BY symbol ORDER BY session_date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS known FROM r
  WINDOW v AS (PARTITION BY symbol ORDER BY session_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
price AS (SELECT symbol AS entity, 'close' AS feature, session_date, known, CAST(close AS DOUBLE) AS value FROM w
  UNION ALL SELECT symbol, 'volatility_20d', session_date, known, sd FROM w WHERE n = 20 AND sd IS NOT NULL
  UNION ALL SELECT symbol, 'volume_mean_20d', session_date, known, mean FROM w WHERE n = 20 AND mean IS NOT NULL)"""


def micros(*columns: str) -> list[Column]:
    """Instants as microseconds, by name with _us."""
    return [F.unix_micros(c).alias(f"{c}_us") for c in columns]


def load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load log made of orders: one file per order, loaded once or again; rows and rejections follow from its number."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.concat(F.lit("file_"), F.floor(k / 2).cast("string")).alias("path"), F.concat(F.lit("t"), (k % 4).cast("string")).alias("table"), F.concat(F.lit("S"), (F.col("o_custkey") % 9).cast("string")).alias("symbol"),
        F.to_date("o_orderdate").alias("period"), (k % 97 + 3).alias("rows"), (k % 5).alias("rejected"), k.alias("run"), (F.col("o_orderdate") + F.make_interval(secs=(k % 86400).cast("int"))).alias("loaded_at"),
    )


LOAD_LOG = """log AS (SELECT 'file_' || CAST(o_orderkey // 2 AS VARCHAR) AS path, 't' || CAST(o_orderkey % 4 AS VARCHAR) AS "table", 'S' || CAST(o_custkey % 9 AS VARCHAR) AS symbol,
  CAST(o_orderdate AS DATE) AS period, o_orderkey % 97 + 3 AS rows, o_orderkey % 5 AS rejected, o_orderkey AS run, o_orderdate + to_seconds(o_orderkey % 86400) AS loaded_at FROM orders)"""


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that became known one minute after another."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "text", (F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60)).alias("knowable_at"))


def asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: benchmark passages, asked at instants that fall into the corpus."""
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("query_id"), "text", F.timestamp_seconds(F.lit(1704067200) + (F.col("item_id") * 37 + 50) * 60).alias("as_of"))


CORPUS = """corpus AS (SELECT doc_id, text, TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS knowable_at FROM documents),
asked AS (SELECT item_id AS query_id, text, TIMESTAMP '2024-01-01' + to_minutes(item_id * 37 + 50) AS as_of FROM benchmark)"""
