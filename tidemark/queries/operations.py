"""Freshness, drift, costs, alerts."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import functions as F

from tidemark.operators import ops
from tidemark.queries import frames as fr

NOW = datetime(2024, 2, 2, tzinfo=UTC)


def freshness(spark, d):
    f = fr.facts(spark, d)
    tables = {t: f.where(F.col("feature") == t) for t in ("click", "view", "error")} | {"old": f.where("event_time < timestamp'2024-01-10'"), "empty": f.where("false")}
    found = ops.newest(tables, {"click": datetime(2024, 1, 25, tzinfo=UTC), "old": datetime(2024, 1, 25, tzinfo=UTC)})
    tolerance = spark.createDataFrame([(t, 3.0) for t in tables], "table string, tolerance_days double")
    return ops.staleness(found, tolerance, NOW).select("table", *fr.micros("newest"), F.round("age_days", 6).alias("age_days"), "stale")


def _profiles(spark, d):
    e = fr.table(spark, d, "events")
    shifted = e.withColumn("value", F.when(F.col("ts") >= "2024-01-29", F.col("value") * 3).otherwise(F.col("value"))).withColumn("kind", F.when((F.col("ts") >= "2024-01-29") & (F.col("event_id") % 2 == 0), "new").otherwise(F.col("event_type")))
    return ops.profile(shifted, "ts", "week", ["value", "user_id"], ["kind"]).unionByName(ops.profile(e, "ts", "week", [], []).where("false"))


def table_profiles(spark, d):
    return _profiles(spark, d).select(*fr.micros("window_start"), "column_name", "rows", "distinct", F.round("median", 6).alias("median"), F.array_join("items", ",").alias("items"))


def drift(spark, d):
    found = ops.drift(_profiles(spark, d), ["value"], ["user_id"], ["kind"])
    return found.select("column_name", *fr.micros("window_start", "baseline_start"), F.round("factor", 6).alias("factor"), "allowed", F.array_join("appeared", ",").alias("appeared"), F.array_join("disappeared", ",").alias("disappeared"), "drifted")


def _prices(spark, d):
    """Prices of a part's brand valid for some years, with gaps and an open end."""
    p = fr.table(spark, d, "part").groupBy("p_brand").agg(F.min("p_retailprice").alias("low")).select(F.col("p_brand").alias("sku"), "low")
    spans = spark.createDataFrame([(datetime(1996, 1, 1, tzinfo=UTC), datetime(1998, 6, 1, tzinfo=UTC), 1.0), (datetime(1998, 6, 1, tzinfo=UTC), datetime(2000, 1, 1, tzinfo=UTC), 1.5), (datetime(2000, 7, 1, tzinfo=UTC), None, 2.0)], "price_start timestamp, price_end timestamp, factor double")
    return p.crossJoin(F.broadcast(spans)).select("sku", "price_start", "price_end", (F.col("low") * F.col("factor")).alias("price"))


def range_price_validity(spark, d):
    usage = fr.table(spark, d, "lineitem").join(fr.table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_brand").alias("sku"), F.col("l_shipdate").alias("at"), F.col("l_quantity").alias("quantity"))
    out = ops.cost_rollup(ops.priced(usage, _prices(spark, d), ["sku"]), ["sku", F.year("at").alias("year")])
    return out.select("sku", "year", "quantity", F.round("cost", 2).alias("cost"), "unpriced")


def query_stats(spark, d):
    e = fr.table(spark, d, "events")
    history = e.select(F.col("ts").alias("start_time"), (F.col("user_id") % 6).alias("job_id"), F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("client"), (F.col("event_id") % 5000).alias("duration_ms"), (F.col("event_id") % 11).alias("read_files"), (F.col("event_id") % 7).alias("pruned_files"), F.lit(10).alias("read_bytes"), F.col("user_id").alias("read_rows"))
    changes = e.where("user_id % 6 < 3").select((F.col("user_id") % 6).alias("job_id"), F.concat(F.lit("job "), F.col("event_type")).alias("name"), F.col("ts").alias("change_time"))
    out = ops.query_stats(history, ops.latest_name(changes, "job_id"))
    return out.select("day", "workload", "queries", F.round("duration_s", 3).alias("duration_s"), "read_files", "pruned_files", F.col("read_bytes").cast("bigint").alias("read_bytes"), "read_rows")


def maintenance(spark, d):
    o = fr.load_log(spark, d).select(F.col("table").alias("schema_name"), F.col("symbol").alias("table_name"), F.when(F.col("run") % 2 == 0, "OPTIMIZE").otherwise("VACUUM").alias("operation"), F.col("loaded_at").alias("end_time"), F.when(F.col("run") % 17 == 0, "FAILED").otherwise("SUCCESSFUL").alias("status"))
    return ops.maintenance(o).select("schema_name", "table_name", "operation", *fr.micros("last_run"), "runs", "failed")


def concat_alert(spark, d):
    return ops.alert(freshness(spark, d), F.col("stale"), F.col("table"))


def heartbeat(spark, d):
    """Two single values side by side."""
    e = fr.table(spark, d, "events")
    return e.agg(F.max(F.unix_micros("ts")).alias("newest_us")).crossJoin(e.where("event_type = 'error'").agg(F.count("*").alias("errors")))


QUERIES = {f.__name__: f for f in (freshness, table_profiles, drift, range_price_validity, query_stats, maintenance, concat_alert, heartbeat)}

_FRESH = f"""{fr.FACTS}, n AS (SELECT 'click' AS t, max(knowable_at) AS newest FROM facts WHERE feature = 'click' UNION ALL SELECT 'view', max(knowable_at) FROM facts WHERE feature = 'view'
  UNION ALL SELECT 'error', max(knowable_at) FROM facts WHERE feature = 'error' UNION ALL SELECT 'old', max(knowable_at) FROM facts WHERE event_time < TIMESTAMP '2024-01-10' UNION ALL SELECT 'empty', NULL),
j AS (SELECT t AS "table", epoch_us(newest) AS newest_us, (epoch_us(TIMESTAMP '2024-02-02') - epoch_us(newest)) / 86400000000.0::DOUBLE AS age FROM n)"""

ORACLE = {
    "freshness": f"""WITH {_FRESH} SELECT "table", newest_us, round(age, 6) AS age_days, age IS NULL OR age > 3 AS stale FROM j""",
    "concat_alert": f"""WITH {_FRESH} SELECT count(*) FILTER (WHERE age IS NULL OR age > 3) AS bad, coalesce(string_agg("table", '; ' ORDER BY "table") FILTER (WHERE age IS NULL OR age > 3), '') AS message FROM j""",
    "table_profiles": """WITH e AS (SELECT date_trunc('week', ts) AS w, user_id, CASE WHEN ts >= TIMESTAMP '2024-01-29' THEN value * 3 ELSE value END AS value, CASE WHEN ts >= TIMESTAMP '2024-01-29' AND event_id % 2 = 0 THEN 'new' ELSE event_type END AS kind FROM events)
SELECT epoch_us(w) AS window_start_us, ':table' AS column_name, count(*) AS rows, CAST(NULL AS BIGINT) AS "distinct", CAST(NULL AS DOUBLE) AS median, CAST(NULL AS VARCHAR) AS items FROM e GROUP BY w
UNION ALL SELECT epoch_us(w), 'value', count(value), count(DISTINCT value), round(median(value), 6), NULL FROM e GROUP BY w UNION ALL SELECT epoch_us(w), 'user_id', count(user_id), count(DISTINCT user_id), round(median(user_id), 6), NULL FROM e GROUP BY w
UNION ALL SELECT epoch_us(w), 'kind', count(*), count(DISTINCT kind), NULL, string_agg(DISTINCT kind, ',' ORDER BY kind) FROM e GROUP BY w""",
    "drift": """WITH e AS (SELECT date_trunc('week', ts) AS w, user_id, CASE WHEN ts >= TIMESTAMP '2024-01-29' THEN value * 3 ELSE value END AS value, CASE WHEN ts >= TIMESTAMP '2024-01-29' AND event_id % 2 = 0 THEN 'new' ELSE event_type END AS kind FROM events),
c AS (SELECT w, count(*) AS n, median(value) AS v, median(user_id) AS u, list_sort(list_distinct(list(kind))) AS k FROM e GROUP BY w),
f AS (SELECT * FROM c WHERE n >= 0.1 * (SELECT median(n) FROM c)), p AS (SELECT *, lag(w) OVER (ORDER BY w) AS bw, lag(v) OVER (ORDER BY w) AS bv, lag(u) OVER (ORDER BY w) AS bu, lag(k) OVER (ORDER BY w) AS bk FROM f QUALIFY row_number() OVER (ORDER BY w DESC) = 1)
SELECT 'value' AS column_name, epoch_us(w) AS window_start_us, epoch_us(bw) AS baseline_start_us, round(greatest(v, bv) / least(v, bv), 6) AS factor, 2.0::DOUBLE AS allowed, '' AS appeared, '' AS disappeared, greatest(v, bv) / least(v, bv) > 2 AS drifted FROM p
UNION ALL SELECT 'user_id', epoch_us(w), epoch_us(bw), round(greatest(u, bu) / least(u, bu), 6), 10.0, '', '', greatest(u, bu) / least(u, bu) > 10 FROM p
UNION ALL SELECT 'kind', epoch_us(w), epoch_us(bw), NULL, NULL, array_to_string([x FOR x IN k IF NOT list_contains(bk, x)], ','), array_to_string([x FOR x IN bk IF NOT list_contains(k, x)], ','), k <> bk FROM p""",
    "range_price_validity": """WITH s AS (SELECT p_brand AS sku, min(p_retailprice) AS low FROM part GROUP BY 1),
x AS (SELECT sku, a, b, low * f AS price FROM s, (VALUES (TIMESTAMP '1996-01-01', TIMESTAMP '1998-06-01', 1.0::DOUBLE), (TIMESTAMP '1998-06-01', TIMESTAMP '2000-01-01', 1.5::DOUBLE), (TIMESTAMP '2000-07-01', NULL, 2.0::DOUBLE)) v(a, b, f)),
u AS (SELECT p_brand AS sku, l_shipdate AS t, l_quantity AS q FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT u.sku, CAST(year(t) AS INTEGER) AS year, sum(q) AS quantity, round(sum(q * price), 2) AS cost, count(*) - count(price) AS unpriced FROM u LEFT JOIN x ON u.sku = x.sku AND t >= a AND (b IS NULL OR t < b) GROUP BY ALL""",
    "query_stats": """WITH n AS (SELECT user_id % 6 AS job_id, arg_max('job ' || event_type, (ts, 'job ' || event_type)) AS name FROM events WHERE user_id % 6 < 3 GROUP BY 1)
SELECT CAST(ts AS DATE) AS day, coalesce(n.name, CASE WHEN event_id % 3 = 0 THEN event_type END, 'other') AS workload, count(*) AS queries, round(CAST(sum(event_id % 5000) AS DOUBLE) / 1000, 3) AS duration_s, CAST(sum(event_id % 11) AS BIGINT) AS read_files,
  CAST(sum(event_id % 7) AS BIGINT) AS pruned_files, CAST(sum(10) AS BIGINT) AS read_bytes, CAST(sum(user_id) AS BIGINT) AS read_rows FROM events e LEFT JOIN n ON n.job_id = e.user_id % 6 GROUP BY 1, 2""",
    "maintenance": f"""WITH {fr.LOAD_LOG} SELECT "table" AS schema_name, symbol AS table_name, CASE WHEN run % 2 = 0 THEN 'OPTIMIZE' ELSE 'VACUUM' END AS operation, epoch_us(max(loaded_at)) AS last_run_us, count(*) AS runs, count(*) FILTER (WHERE run % 17 = 0) AS failed FROM log GROUP BY 1, 2, 3""",
    "heartbeat": "SELECT max(epoch_us(ts)) AS newest_us, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events",
}
