"""Served views and the portfolio."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import functions as F

from tidemark.operators import views
from tidemark.queries import frames as fr

AS_OF = datetime(2024, 1, 20, 6, tzinfo=UTC)


def _register(spark, d):
    log = fr.load_log(spark, d)
    log.withColumn("rules", F.create_map(F.concat(F.lit("rule"), (F.col("run") % 3).cast("string")), F.col("rejected"), F.lit("key_present"), F.col("run") % 2)).createOrReplaceTempView("load_log")
    fr.facts(spark, d).createOrReplaceTempView("facts")
    fr.days(spark, d).createOrReplaceTempView("days")
    e = fr.table(spark, d, "events")
    e.select((F.col("user_id") % 7).alias("run_id"), F.date_trunc("hour", "ts").alias("checked_at"), F.col("event_type").alias("check"), F.when(F.col("event_id") % 3 == 0, "failed").otherwise("passed").alias("outcome"), (F.col("user_id") % 7 == 6).alias("drill")).createOrReplaceTempView("results")
    e.select(F.col("event_id").alias("run_id"), F.col("ts").alias("at"), F.create_map(F.lit("sharpe"), F.col("value"), F.lit("days"), (F.col("event_id") % 300).cast("double")).alias("metrics")).createOrReplaceTempView("backtests")
    e.select(F.col("event_type").alias("client"), (F.col("event_id") % 7).alias("pruned_files"), (F.col("event_id") % 3).alias("read_files"), F.concat(F.lit("w"), (F.col("user_id") % 4).cast("string")).alias("workload"), (F.col("event_id") % 100).alias("seconds")).createOrReplaceTempView("history")
    e.select(F.col("event_type").alias("left_venue"), F.concat(F.lit("v"), (F.col("user_id") % 3).cast("string")).alias("right_venue"), F.to_date("ts").alias("day"), (F.col("event_id") % 5).alias("agreed"), (F.col("event_id") % 3).alias("differing"), F.date_trunc("hour", "ts").alias("compared_at"), F.col("event_id").alias("run_id")).createOrReplaceTempView("comparisons")
    e.select(F.concat(F.lit("s"), (F.col("user_id") % 9).cast("string")).alias("source"), F.col("event_type").alias("table"), F.col("user_id").cast("string").alias("entity")).distinct().createOrReplaceTempView("registry")
    e.select(F.concat(F.lit("k"), F.col("user_id").cast("string")).alias("key"), F.col("value").alias("result"), F.col("ts").alias("at")).createOrReplaceTempView("stored")


def _view(name, finish=lambda df: df, **parameters):
    def query(spark, d):
        _register(spark, d)
        return finish(views.run(spark, name, **parameters))

    return query


def _us(*names):
    return lambda df: df.select(*[c for c in df.columns if c not in names], *fr.micros(*names))


def _holdings(spark):
    return spark.createDataFrame([("click", 3.0), ("view", 2.0), ("click", 1.0)], "symbol string, quantity double")


def _sparse(spark, d):
    return fr.days(spark, d).where("symbol in ('click', 'view') and dayofmonth(session_date) % 3 <> 0 and not (symbol = 'view' and session_date < '2024-01-04') and not (symbol = 'view' and dayofmonth(session_date) % 5 = 0)")


def carry_forward_value(spark, d):
    return views.carried_forward(_sparse(spark, d), _holdings(spark)).select("session_date", F.round("value", 6).alias("value"))


def indexed_to_100(spark, d):
    return views.indexed(_sparse(spark, d)).select("symbol", "session_date", F.round("index", 6).alias("index"))


def lookback_changes(spark, d):
    out = views.changes(_sparse(spark, d))
    return out.select("symbol", "session_date", *[F.round(c, 9).alias(c) for c in out.columns if c not in ("symbol", "session_date")])


def portfolio_weights(spark, d):
    last = fr.days(spark, d).groupBy("symbol").agg((F.max_by("close", "session_date").cast("double")).alias("value"))
    return views.weights(last).select("symbol", F.round("weight", 9).alias("weight"))


def answer_dates(spark, d):
    o = fr.table(spark, d, "orders")
    answer = F.concat(F.lit("filed on "), F.to_date("o_orderdate").cast("string"), F.lit(", see 1999-12-31 and 2001-13-45."))
    out = o.select("o_orderkey", views.later_dates(answer, F.when(F.col("o_orderkey") % 2 == 0, "what of 1999-12-31?").otherwise("what?"), F.lit("1998-06-01").cast("timestamp")).alias("late"))
    return out.select("o_orderkey", F.array_join("late", " ").alias("late"))


QUERIES = {
    "view_coverage": _view("coverage", _us("last_loaded")),
    "view_trailing_days": _view("trailing_days", days=30),
    "view_rejected_share": _view("rejected_share", lambda df: df.withColumn("rate", F.round("rate", 9))),
    "view_latest_gate": _view("latest_gate"),
    "view_newest_backtests": _view("newest_backtests", _us("at"), most=500),
    "view_pruned_share": _view("pruned_share", lambda df: df.withColumn("share", F.round("share", 9)), client="%i%"),
    "view_day_range": _view("day_range"),
    "view_known_days": _view("known_days", as_of=AS_OF, back=10, ahead=5),
    "view_known_plus_upcoming": _view("known_plus_upcoming", _us("knowable_at"), as_of=AS_OF, known=40, upcoming=10),
    "view_filtered_maxima": _view("filtered_maxima", feature="click", as_of=AS_OF),
    "view_top_differences": _view("top_differences", lambda df: df.withColumn("difference", F.round("difference", 6)), left="click", right="view", most=10),
    "view_snapshot": _view("snapshot", _us("event_time", "knowable_at"), entity="3", shared="5", as_of=AS_OF),
    "view_latest_checks": _view("latest_checks"),
    "view_latest_comparisons": _view("latest_comparisons"),
    "view_registry": _view("registry"),
    "view_reusable": _view("reusable", _us("at"), keys=["k3", "k5"]),
    "view_cost_by_workload": _view("cost_by_workload"),
    "view_rejects_by_rule": _view("rejects_by_rule"),
    "view_stale_tables": _view("stale_tables", _us("last_loaded"), days=3, as_of=datetime(1998, 8, 7, tzinfo=UTC)),
    "view_rows_per_day": _view("rows_per_day"),
    "view_waived_failures": _view("waived_failures"),
    "view_top_sharpe": _view("top_sharpe", _us("at"), most=20),
    "view_first_reports": _view("first_reports", _us("event_time", "first_known"), as_of=AS_OF),
} | {f.__name__: f for f in (carry_forward_value, indexed_to_100, lookback_changes, portfolio_weights, answer_dates)}

_SPARSE = f"""{fr.DAYS}, sp AS (SELECT symbol, session_date, CAST(close AS DOUBLE) AS close FROM days WHERE symbol IN ('click', 'view') AND day(session_date) % 3 <> 0 AND NOT (symbol = 'view' AND session_date < DATE '2024-01-04') AND NOT (symbol = 'view' AND day(session_date) % 5 = 0))"""
_T = "TIMESTAMP '2024-01-20 06:00:00'"

ORACLE = {
    "view_coverage": f"""WITH {fr.LOAD_LOG}, l AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY path ORDER BY loaded_at DESC, run DESC) = 1)
SELECT "table", symbol, min(period) AS first_period, max(period) AS last_period, count(DISTINCT period) AS periods, CAST(sum(rows) AS BIGINT) AS rows, epoch_us(max(loaded_at)) AS last_loaded_us FROM l GROUP BY ALL""",
    "view_trailing_days": f"""WITH {fr.LOAD_LOG}, l AS (SELECT *, max(period) OVER (PARTITION BY "table") AS newest FROM log)
SELECT "table", period, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(rejected) AS BIGINT) AS rejected FROM l WHERE period > newest - 30 GROUP BY ALL""",
    "view_rejected_share": f"""WITH {fr.LOAD_LOG} SELECT "table", CAST(sum(rejected) AS BIGINT) AS rejected, CAST(sum(rows) AS BIGINT) AS judged, round(sum(rejected) / sum(rows), 9) AS rate FROM log GROUP BY 1""",
    "view_latest_gate": """WITH r AS (SELECT user_id % 7 AS run_id, date_trunc('hour', ts) AS t, event_type AS "check", CASE WHEN event_id % 3 = 0 THEN 'failed' ELSE 'passed' END AS outcome FROM events)
SELECT "check", outcome, count(*) AS n FROM r WHERE run_id = (SELECT arg_max(run_id, (t, run_id)) FROM r WHERE run_id <> 6) GROUP BY ALL""",
    "view_newest_backtests": "SELECT event_id AS run_id, epoch_us(ts) AS at_us, value AS sharpe, CAST(event_id % 300 AS DOUBLE) AS days FROM events ORDER BY ts DESC, event_id LIMIT 500",
    "view_pruned_share": """SELECT event_type AS client, CAST(sum(event_id % 7) AS BIGINT) AS pruned, CAST(sum(event_id % 3) AS BIGINT) AS read, round(sum(event_id % 7) / (sum(event_id % 7) + sum(event_id % 3)), 9) AS share
FROM events WHERE event_type LIKE '%i%' GROUP BY 1""",
    "view_day_range": f"WITH {fr.DAYS} SELECT symbol, min(session_date) AS first_day, max(session_date) AS last_day, count(*) AS days FROM days GROUP BY 1",
    "view_known_days": f"WITH {fr.DAYS} SELECT symbol, session_date, CAST(close AS DOUBLE) AS close, knowable_at <= {_T} AS known FROM days WHERE session_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-25'",
    "view_known_plus_upcoming": f"""WITH {fr.FACTS} (SELECT entity, source_ref, epoch_us(knowable_at) AS knowable_at_us, true AS known FROM facts WHERE knowable_at <= {_T} ORDER BY knowable_at DESC, source_ref DESC LIMIT 40)
UNION ALL (SELECT entity, source_ref, epoch_us(knowable_at), false FROM facts WHERE knowable_at > {_T} ORDER BY knowable_at, source_ref LIMIT 10)""",
    "view_filtered_maxima": f"WITH {fr.FACTS} SELECT entity, max(value) FILTER (WHERE feature = 'click') AS of_feature, max(value) FILTER (WHERE feature <> 'click') AS of_others, count(*) AS facts FROM facts WHERE knowable_at <= {_T} GROUP BY entity",
    "view_top_differences": f"""WITH {fr.DAYS} SELECT a.session_date, round(CAST(a.close - b.close AS DOUBLE), 6) AS difference FROM days a JOIN days b ON a.session_date = b.session_date AND a.symbol = 'click' AND b.symbol = 'view' ORDER BY abs(a.close - b.close) DESC, a.session_date LIMIT 10""",
    "view_snapshot": f"""WITH {fr.FACTS} SELECT entity, feature, arg_max(value, (event_time, knowable_at)) AS value, epoch_us(max(event_time)) AS event_time_us, epoch_us(arg_max(knowable_at, (event_time, knowable_at))) AS knowable_at_us
FROM facts WHERE entity IN ('3', '5') AND knowable_at <= {_T} GROUP BY ALL""",
    "view_latest_checks": """SELECT user_id % 7 AS run_id, event_type AS "check", CASE WHEN event_id % 3 = 0 THEN 'failed' ELSE 'passed' END AS outcome, user_id % 7 = 6 AS drill FROM events WHERE date_trunc('hour', ts) = (SELECT max(date_trunc('hour', ts)) FROM events)""",
    "view_latest_comparisons": """SELECT event_type AS left_venue, 'v' || CAST(user_id % 3 AS VARCHAR) AS right_venue, CAST(ts AS DATE) AS day, event_id % 5 AS agreed, event_id % 3 AS differing FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, user_id % 3, CAST(ts AS DATE) ORDER BY date_trunc('hour', ts) DESC, event_id DESC) = 1""",
    "view_registry": """SELECT DISTINCT 's' || CAST(user_id % 9 AS VARCHAR) AS source, event_type AS "table", CAST(user_id AS VARCHAR) AS entity FROM events""",
    "view_reusable": "SELECT 'k' || CAST(user_id AS VARCHAR) AS key, value AS result, epoch_us(ts) AS at_us FROM events WHERE user_id IN (3, 5)",
    "view_cost_by_workload": "SELECT 'w' || CAST(user_id % 4 AS VARCHAR) AS workload, CAST(sum(event_id % 100) AS BIGINT) AS seconds, count(*) AS queries FROM events GROUP BY 1",
    "view_rejects_by_rule": f"""WITH {fr.LOAD_LOG}, r AS (SELECT 'rule' || CAST(run % 3 AS VARCHAR) AS rule, rejected AS n FROM log UNION ALL SELECT 'key_present', run % 2 FROM log) SELECT rule, CAST(sum(n) AS BIGINT) AS rejected FROM r GROUP BY 1 HAVING sum(n) > 0""",
    "view_stale_tables": f"""WITH {fr.LOAD_LOG} SELECT "table", epoch_us(max(loaded_at)) AS last_loaded_us FROM log GROUP BY 1 HAVING max(loaded_at) < TIMESTAMP '1998-08-07' - INTERVAL 3 DAY""",
    "view_rows_per_day": f"""WITH {fr.LOAD_LOG} SELECT CAST(loaded_at AS DATE) AS day, CAST(sum(rows) AS BIGINT) AS rows FROM log GROUP BY 1""",
    "view_waived_failures": """SELECT user_id % 7 AS run_id, event_type AS "check", count(*) AS n FROM events WHERE event_id % 3 = 0 AND user_id % 7 = 6 GROUP BY ALL""",
    "view_top_sharpe": "SELECT event_id AS run_id, epoch_us(ts) AS at_us, value AS sharpe FROM events ORDER BY value DESC, event_id LIMIT 20",
    "view_first_reports": f"""WITH {fr.FACTS} SELECT entity, feature, epoch_us(event_time) AS event_time_us, arg_min(value, (knowable_at, value)) AS value, epoch_us(min(knowable_at)) AS first_known_us FROM facts WHERE knowable_at <= {_T} GROUP BY entity, feature, event_time""",
    "carry_forward_value": f"""WITH {_SPARSE}, d AS (SELECT DISTINCT session_date FROM sp), h AS (SELECT * FROM (VALUES ('click', 4.0::DOUBLE), ('view', 2.0::DOUBLE)) v(symbol, q)),
f AS (SELECT d.session_date, h.symbol, h.q, last_value(sp.close IGNORE NULLS) OVER (PARTITION BY h.symbol ORDER BY d.session_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p FROM d CROSS JOIN h LEFT JOIN sp ON sp.symbol = h.symbol AND sp.session_date = d.session_date)
SELECT session_date, round(sum(p * q), 6) AS value FROM f GROUP BY 1 HAVING count(*) FILTER (WHERE p IS NULL) = 0""",
    "indexed_to_100": f"""WITH {_SPARSE}, s AS (SELECT max(f) AS start FROM (SELECT min(session_date) AS f FROM sp GROUP BY symbol))
SELECT symbol, session_date, round(close / first_value(close) OVER (PARTITION BY symbol ORDER BY session_date) * 100, 6) AS "index" FROM sp, s WHERE session_date >= start""",
    "lookback_changes": f"""WITH {_SPARSE}, x AS (SELECT *, close / lag(close, 1) OVER w - 1 AS a, close / lag(close, 5) OVER w - 1 AS b, close / lag(close, 20) OVER w - 1 AS c,
  close / (SELECT arg_max(y.close, y.session_date) FROM sp y WHERE y.symbol = sp.symbol AND y.session_date <= sp.session_date - 7) - 1 AS e FROM sp WINDOW w AS (PARTITION BY symbol ORDER BY session_date))
SELECT symbol, session_date, round(a, 9) AS sessions_1, round(b, 9) AS sessions_5, round(c, 9) AS sessions_20, round(e, 9) AS days_7 FROM x QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY session_date DESC) = 1""",
    "portfolio_weights": f"WITH {fr.DAYS}, l AS (SELECT symbol, CAST(arg_max(close, session_date) AS DOUBLE) AS v FROM days GROUP BY 1) SELECT symbol, round(v / (SELECT sum(v) FROM l), 9) AS weight FROM l",
    "answer_dates": """SELECT o_orderkey, array_to_string([x FOR x IN CASE WHEN o_orderdate = DATE '1999-12-31' THEN ['1999-12-31'] ELSE [CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '1999-12-31'] END IF x > '1998-06-01' AND NOT (o_orderkey % 2 = 0 AND x = '1999-12-31')], ' ') AS late FROM orders""",
}
