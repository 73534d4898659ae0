"""Bars and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import bars, features
from tidemark.queries import frames as fr

_PRICES = ["open", "high", "low", "close", "volume"]


def _out(df, *keys):
    return df.select(*keys, *[F.col(c).cast("double").alias(c) for c in _PRICES], "trades", F.round("vwap", 8).alias("vwap"), *fr.micros("knowable_at"))


def bars_1m(spark, d):
    return _out(fr.minutes(spark, d).withColumn("bar_us", F.unix_micros("bar_time")), "symbol", "bar_us")


def bars_1d_from_minutes(spark, d):
    return _out(fr.days(spark, d), "symbol", "session_date", "minutes")


def bars_with_consolidated(spark, d):
    """Daily bars built here and, of another venue, candles that come ready."""
    o = fr.table(spark, d, "orders")
    p = F.col("o_totalprice").cast("decimal(28,10)")
    candles = o.select(F.col("o_orderpriority").alias("symbol"), F.col("o_orderdate").alias("event_time"), p.alias("open"), p.alias("high"), p.alias("low"), p.alias("close"), F.lit(1).cast("decimal(28,10)").alias("volume"), F.col("o_orderdate").alias("knowable_at"))
    ready = bars.candles_as_bars(candles)
    return bars.with_consolidated(fr.days(spark, d), bars.daily_bars(ready)).groupBy("symbol").agg(F.count("*").alias("days"), F.max(F.col("high").cast("double")).alias("high"), F.sum(F.col("volume").cast("double")).alias("volume"))


def _venues(spark, d):
    m = fr.minutes(spark, d).select("symbol", F.date_trunc("hour", "bar_time").alias("h"), "bar_time", "close")
    # two event types as two venues of one instrument, on a grid they can meet on
    side = lambda s: m.where(F.col("symbol") == s).groupBy(F.lit("X").alias("symbol"), F.col("h").alias("bar_time")).agg(F.max_by("close", "bar_time").alias("close"))
    return bars.compare_venues(side("click"), side("view"))


def bars_grid_compare(spark, d):
    return _venues(spark, d).where("status <> 'missing_both'").select(F.unix_micros("minute").alias("minute_us"), "status", F.col("left_close").cast("double").alias("left_close"), F.col("right_close").cast("double").alias("right_close"), F.round("diff_bps", 6).alias("diff_bps"))


def bars_daily_status_counts(spark, d):
    return bars.daily_status(_venues(spark, d)).select("session_date", *bars.STATUSES, F.round("worst_bps", 6).alias("worst_bps"))


def price_features(spark, d):
    f = features.price_features(fr.days(spark, d))
    return f.select("entity", "feature", F.to_date("event_time").alias("session_date"), *fr.micros("knowable_at"), F.round("value", 9).alias("value"))


def _vintages(spark, d):
    """Order value by month and priority as a series, two vintages: orders known by then."""
    o = fr.table(spark, d, "orders")
    m = o.select(F.col("o_orderpriority").alias("series_id"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("observation_date"), "o_totalprice", "o_orderkey")
    v = m.withColumn("vintage_date", F.explode(F.array(F.lit("2002-01-01").cast("date"), F.lit("2002-02-01").cast("date")))).where((F.col("vintage_date") > "2002-01-01") | (F.col("o_orderkey") % 3 != 0))
    return v.groupBy("series_id", "observation_date", "vintage_date").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("value")).withColumn("knowable_at", F.date_add("vintage_date", 1).cast("timestamp"))


def yoy_same_vintage(spark, d):
    y = features.year_over_year(_vintages(spark, d))
    return y.select("series_id", "vintage_date", "observation_date", F.round("yoy", 9).alias("yoy"), *fr.micros("knowable_at"))


def _concepts(spark, d):
    o = fr.table(spark, d, "orders")
    f = o.select(F.col("o_custkey").alias("entity"), F.col("o_orderpriority").alias("concept"), F.when(F.col("o_orderkey") % 3 == 0, "annual").otherwise("quarter").alias("duration"), F.year("o_orderdate").alias("period"), "o_orderkey", "o_totalprice")
    mapping = spark.createDataFrame([("1-URGENT", "value", 1, ["annual", "quarter"]), ("2-HIGH", "value", 2, ["quarter"]), ("3-MEDIUM", "value", 3, ["annual"])], "concept string, metric string, priority int, durations array<string>")
    return features.map_concepts(f, mapping, ["concept"])


def concept_priority_pick(spark, d):
    key = ["entity", "metric", "duration", "period"]
    return features.pick_concept(_concepts(spark, d), key, [F.col("priority"), F.col("o_orderkey")]).select(*key, "concept", "o_orderkey", "o_totalprice")


def broadcast_mapping(spark, d):
    return _concepts(spark, d).groupBy("concept", "duration").agg(F.count("*").alias("rows"))


def long_features_unpivot(spark, d):
    p = fr.table(spark, d, "part")
    return features.melt(p, ["p_partkey"], {"size": F.when(F.col("p_size") > 5, F.col("p_size")), "price": F.col("p_retailprice")})


def log_return_lag(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("symbol").orderBy("session_date")
    c = F.col("close").cast("double")
    return fr.days(spark, d).select("symbol", "session_date", F.round(F.ln(c / F.lag(c).over(w)), 9).alias("ret"))


QUERIES = {
    "bars_1m": bars_1m, "bars_1d_from_minutes": bars_1d_from_minutes, "bars_with_consolidated": bars_with_consolidated, "bars_grid_compare": bars_grid_compare,
    "bars_daily_status_counts": bars_daily_status_counts, "price_features": price_features, "yoy_same_vintage": yoy_same_vintage, "concept_priority_pick": concept_priority_pick,
    "broadcast_mapping": broadcast_mapping, "long_features_unpivot": long_features_unpivot, "log_return_lag": log_return_lag,
}

_OHLC = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _PRICES)
_VENUES = f"""{fr.MINUTES},
side AS (SELECT symbol, date_trunc('hour', bar_time) AS minute, arg_max(close, bar_time) AS close FROM minutes WHERE symbol IN ('click', 'view') GROUP BY 1, 2),
dd AS (SELECT DISTINCT CAST(minute AS DATE) AS session_date FROM side),
g AS (SELECT session_date, unnest(generate_series(CAST(session_date AS TIMESTAMP), CAST(session_date AS TIMESTAMP) + INTERVAL 1439 MINUTE, INTERVAL 1 MINUTE)) AS minute FROM dd),
j AS (SELECT g.*, CAST(l.close AS DOUBLE) AS left_close, CAST(r.close AS DOUBLE) AS right_close FROM g LEFT JOIN side l ON l.minute = g.minute AND l.symbol = 'click' LEFT JOIN side r ON r.minute = g.minute AND r.symbol = 'view'),
cmp AS (SELECT *, CASE WHEN right_close <> 0 THEN abs(left_close - right_close) / abs(right_close) * 10000 END AS diff_bps FROM j),
st AS (SELECT *, CASE WHEN left_close IS NULL AND right_close IS NULL THEN 'missing_both' WHEN left_close IS NULL THEN 'missing_left' WHEN right_close IS NULL THEN 'missing_right'
  WHEN diff_bps > 100 THEN 'price_divergence' ELSE 'agree' END AS status FROM cmp)"""
_MAP = """f AS (SELECT o_custkey AS entity, o_orderpriority AS concept, CASE WHEN o_orderkey % 3 = 0 THEN 'annual' ELSE 'quarter' END AS duration, CAST(year(o_orderdate) AS INTEGER) AS period, o_orderkey, o_totalprice FROM orders),
m AS (SELECT f.*, 'value' AS metric, p FROM f JOIN (VALUES ('1-URGENT', 1, 'annual'), ('1-URGENT', 1, 'quarter'), ('2-HIGH', 2, 'quarter'), ('3-MEDIUM', 3, 'annual')) v(c, p, u) ON v.c = f.concept AND v.u = f.duration)"""

ORACLE = {
    "bars_1m": f"WITH {fr.MINUTES} SELECT symbol, epoch_us(bar_time) AS bar_us, {_OHLC}, trades, round(vwap, 8) AS vwap, epoch_us(knowable_at) AS knowable_at_us FROM minutes",
    "bars_1d_from_minutes": f"WITH {fr.DAYS} SELECT symbol, session_date, minutes, {_OHLC}, trades, round(vwap, 8) AS vwap, epoch_us(knowable_at) AS knowable_at_us FROM days",
    "bars_with_consolidated": f"""WITH {fr.DAYS},
c AS (SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS session_date, max(CAST(o_totalprice AS DOUBLE)) AS high, CAST(count(*) AS DOUBLE) AS volume FROM orders GROUP BY 1, 2),
u AS (SELECT symbol, CAST(high AS DOUBLE) AS high, CAST(volume AS DOUBLE) AS volume FROM days UNION ALL SELECT symbol, high, volume FROM c)
SELECT symbol, count(*) AS days, max(high) AS high, sum(volume) AS volume FROM u GROUP BY symbol""",
    "bars_grid_compare": f"WITH {_VENUES} SELECT epoch_us(minute) AS minute_us, status, left_close, right_close, round(diff_bps, 6) AS diff_bps FROM st WHERE status <> 'missing_both'",
    "bars_daily_status_counts": f"""WITH {_VENUES} SELECT session_date, {', '.join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in bars.STATUSES)}, round(max(diff_bps), 6) AS worst_bps FROM st GROUP BY session_date""",
    "price_features": f"WITH {fr.PRICE} SELECT entity, feature, session_date, epoch_us(known) AS knowable_at_us, round(value, 9) AS value FROM price",
    "yoy_same_vintage": """WITH v AS (SELECT o_orderpriority AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS d, x.v, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders, (VALUES (DATE '2002-01-01'), (DATE '2002-02-01')) x(v) WHERE x.v > DATE '2002-01-01' OR o_orderkey % 3 <> 0 GROUP BY ALL)
SELECT a.series_id, a.v AS vintage_date, a.d AS observation_date, round(a.value / nullif(b.value, 0) - 1, 9) AS yoy, epoch_us(CAST(a.v + 1 AS TIMESTAMP)) AS knowable_at_us
FROM v a JOIN v b ON a.series_id = b.series_id AND a.v = b.v AND CAST(a.d - INTERVAL 12 MONTH AS DATE) = b.d""",
    "concept_priority_pick": f"WITH {_MAP} SELECT entity, metric, duration, period, concept, o_orderkey, o_totalprice FROM m QUALIFY row_number() OVER (PARTITION BY entity, duration, period ORDER BY p, o_orderkey) = 1",
    "broadcast_mapping": f"WITH {_MAP} SELECT concept, duration, count(*) AS rows FROM m GROUP BY ALL",
    "long_features_unpivot": "SELECT p_partkey, 'size' AS feature, CAST(p_size AS DOUBLE) AS value FROM part WHERE p_size > 5 UNION ALL SELECT p_partkey, 'price', p_retailprice FROM part WHERE p_retailprice IS NOT NULL",
    "log_return_lag": f"WITH {fr.PRICE} SELECT symbol, session_date, round(ret, 9) AS ret FROM r",
}
