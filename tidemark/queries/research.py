"""Backtests, fingerprints, replay, and what decisions rested on."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import digests, stats
from tidemark.operators import counterfactual as cf
from tidemark.operators import features, lineage, research
from tidemark.plans.asof import as_of
from tidemark.queries import frames as fr

ASSETS = 5
PARAMS = [research.Params(3, 0.2, False, False), research.Params(5, 0.1, True, False), research.Params(3, 0.1, False, True)]
_NAMES = {"close": "close", "vol": "volatility_20d", "income": "volume_mean_20d"}


def _read(spark, d):
    f = features.price_features(fr.days(spark, d))
    entities = fr.trades(spark, d).select(F.col("symbol").alias("entity"))
    return as_of(f, research.decision_grid(spark, entities, fr.SPINE_START, "2024-02-01"))


def _daily(spark, d):
    seen = research.observed(_read(spark, d), _NAMES)
    return research.daily(research.positions(seen, research.params_frame(spark, PARAMS), ASSETS))


def backtest_daily(spark, d):
    return _daily(spark, d).select("params", *fr.micros("as_of"), *[F.round(c, 9).alias(c) for c in ("pnl", "cost", "net", "gross", "turnover")])


def backtest_metrics(spark, d):
    m = research.metrics(_daily(spark, d))
    return m.select("params", "days", *[F.round(c, 6).alias(c) for c in m.columns if c not in ("params", "days")])


def param_grid(spark, d):
    del d
    return research.params_frame(spark, research.grid()).select("params", "lookback", "target_vol", "brake", "need_profit")


def input_fingerprint(spark, d):
    return research.fingerprint(_read(spark, d).where("feature = 'close'").withColumn("value", F.round("value", 6)), ["entity", "as_of", "feature", "value", "event_time"]).select("rows", "digest")


def replay_differences(spark, d):
    days = backtest_daily(spark, d)
    changed = days.withColumn("net", F.when(F.col("as_of_us") % 9 == 0, F.col("net") + 1).otherwise(F.col("net")))
    same = research.replay_differences(days, days, ["params", "as_of_us"]).agg(F.count("*").alias("differences")).select(F.lit("same").alias("run"), "differences")
    return same.unionByName(research.replay_differences(days, changed, ["params", "as_of_us"]).agg(F.count("*").alias("differences")).select(F.lit("changed").alias("run"), "differences"))


# -- searches over worlds: the daily bars are the items

AT = datetime(2024, 2, 1, 6, tzinfo=UTC)
LEVELS, CHAINS = (0.0, 0.25, 0.5, 0.75, 1.0), 10


def _items(spark, d):
    return fr.days(spark, d).select(
        lineage.item_id("bar", F.col("symbol"), F.col("session_date")).alias("item_id"), F.lit("bar").alias("kind"), F.col("symbol").alias("entity"), "knowable_at", "session_date", F.col("close").cast("double").alias("close")
    )


def momentum(rows):
    """Weight 1 for what rose over the last five bars of a world, else 0."""
    place = F.row_number().over(Window.partitionBy("world", "entity").orderBy(F.col("session_date").desc()))
    last = rows.withColumn("n", place).where("n <= 5").groupBy("world", "entity").agg(F.max_by("close", "session_date").alias("b"), F.min_by("close", "session_date").alias("a"), F.count("*").alias("n"))
    return last.select("world", F.col("entity").alias("part"), ((F.col("n") > 1) & (F.col("b") > F.col("a"))).cast("double").alias("value"))


def highest(rows):
    return rows.groupBy("world", F.col("entity").alias("part")).agg(F.max("close").alias("value"))


def attribution_leave_one_out(spark, d):
    items = _items(spark, d).cache()
    told = cf.leave_one_out(items, items, momentum, "entity")
    return told.select(F.col("world").alias("item_id"), "part", "before", "after", "outcome", "size")


def sufficiency_minimal_set(spark, d):
    return cf.minimal_set(_items(spark, d).cache(), highest)


def horizon_curve(spark, d):
    found = cf.horizon(_items(spark, d).cache(), AT, 40, momentum, (30, 21, 14, 7, 3, 1, 0))
    return found.select("part", "holds_to", "breaks_at", F.concat_ws(",", F.col("recovers").cast("array<string>")).alias("recovers"))


def share_curve(spark, d):
    items = _items(spark, d).cache()
    known = items.where(F.col("knowable_at") <= F.lit("2024-01-20 06:00:00").cast("timestamp"))
    later = items.where(F.col("knowable_at") <= F.lit("2024-01-27 06:00:00").cast("timestamp"))
    last = lambda df, n: df.groupBy(F.col("entity").alias("part")).agg(F.max_by("close", "session_date").alias(n))
    returns = last(known, "a").join(last(later, "b"), "part").select("part", (F.col("b") / F.col("a") - 1).alias("ret"))
    steps = cf.share_steps(cf.decision_quality(momentum(cf.shares(known, CHAINS, LEVELS)), returns), CHAINS, LEVELS)
    return spark.createDataFrame([(a, b, round(c, 9), round(f, 9), round(r, 9)) for a, b, c, f, r in steps], "low double, high double, change double, falls double, rises double")


def source_value(spark, d):
    items = _items(spark, d).cache()
    return cf.source_value(items, cf.sources_of(items, F.col("kind"), F.col("entity")), momentum).withColumnRenamed("world", "source")


def decomposition(spark, d):
    """Scores of three conditions by unit (a user's mean value per event type as the score), paired differences by era and intervals."""
    e = fr.table(spark, d, "events").where("event_type in ('click', 'view', 'signup')")
    condition = F.when(F.col("event_type") == "click", "blind").when(F.col("event_type") == "view", "recall").otherwise("tooled")
    era = cf.era(F.timestamp_seconds(F.lit(1704067200) + F.col("user_id") * 3600), F.lit("2024-01-04").cast("timestamp"))
    scores = e.groupBy(era.alias("era"), F.col("user_id").cast("string").alias("unit"), condition.alias("condition")).agg(F.avg("value").alias("score"))
    told = cf.bootstrap(cf.paired(scores, ["era"]), ["comparison", "era"], rounds=200)
    return told.select("comparison", "era", "units", *[F.round(c, 9).alias(c) for c in ("mean", "low", "high")])


def exact_tests(spark, d):
    """Fisher's test per event type: its share of late events against that of all others."""
    rows = fr.table(spark, d, "events").groupBy("event_type").agg(F.count_if(F.col("event_id") % 7 > 3).alias("late"), F.count("*").alias("n")).orderBy("event_type").collect()
    late, n = sum(r["late"] for r in rows), sum(r["n"] for r in rows)
    p = [stats.fisher_exact(r["late"], r["n"], late - r["late"], n - r["n"]) for r in rows]
    return spark.createDataFrame([(r["event_type"], round(a, 6), round(b, 6)) for r, a, b in zip(rows, p, stats.holm(p), strict=True)], "event_type string, p double, adjusted double")


def price_lineage_size(spark, d):
    return lineage.price_edges(fr.days(spark, d)).groupBy("row_id").agg(F.count("*").alias("items"))


QUERIES = {f.__name__: f for f in (
    backtest_daily, backtest_metrics, param_grid, input_fingerprint, replay_differences, attribution_leave_one_out, sufficiency_minimal_set, horizon_curve, share_curve, source_value, decomposition, exact_tests, price_lineage_size,
)}

_BACKTEST = f"""{fr.PRICE},
at_days AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 06:00:00', TIMESTAMP '2024-02-01 06:00:00', INTERVAL 1 DAY)) AS as_of),
seen AS (SELECT p.entity, as_of, feature, session_date, value, row_number() OVER (PARTITION BY p.entity, as_of, feature ORDER BY session_date DESC) AS n FROM at_days JOIN price p ON p.known <= as_of),
o AS (SELECT entity, as_of, max(value) FILTER (WHERE feature = 'close') AS close, max(session_date) FILTER (WHERE feature = 'close') AS close_day,
  max(value) FILTER (WHERE feature = 'volatility_20d') AS vol, max(value) FILTER (WHERE feature = 'volume_mean_20d') AS income FROM seen WHERE n = 1 GROUP BY ALL),
pr AS (SELECT * FROM (VALUES ('lb3-vol0.2-nobrake-any', 3, 0.2::DOUBLE, false), ('lb5-vol0.1-brake-any', 5, 0.1::DOUBLE, false), ('lb3-vol0.1-nobrake-profit', 3, 0.1::DOUBLE, true)) v(params, lb, tv, np)),
b AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY session_date) AS k, CAST(close AS DOUBLE) AS c FROM days),
h AS (SELECT o.*, pr.*, lag(o.close) OVER (PARTITION BY params, entity ORDER BY as_of) AS prior, (SELECT y.c FROM b x JOIN b y ON y.symbol = x.symbol AND y.k = x.k - pr.lb WHERE x.symbol = o.entity AND x.session_date = o.close_day) AS past FROM o, pr),
wt AS (SELECT *, CASE WHEN past IS NOT NULL AND close / past - 1 > 0 AND vol > 0 AND (NOT np OR coalesce(income > 0, false)) THEN least(tv / (vol * sqrt(365)), 2.0) / 5 ELSE 0 END AS weight FROM h),
g AS (SELECT *, coalesce(lag(weight) OVER (PARTITION BY params, entity ORDER BY as_of), 0) AS before, coalesce(close / prior - 1, 0) AS ret FROM wt),
daily AS (SELECT params, as_of, sum(before * ret) AS pnl, sum(abs(weight - before)) AS turnover, sum(abs(weight)) AS gross, sum(abs(weight - before)) * 5.0 / 10000 AS cost, sum(before * ret) - sum(abs(weight - before)) * 5.0 / 10000 AS net FROM g GROUP BY ALL)"""

ORACLE = {
    "backtest_daily": f"WITH {_BACKTEST} SELECT params, epoch_us(as_of) AS as_of_us, round(pnl, 9) AS pnl, round(cost, 9) AS cost, round(net, 9) AS net, round(gross, 9) AS gross, round(turnover, 9) AS turnover FROM daily",
    "backtest_metrics": f"""WITH {_BACKTEST},
e AS (SELECT *, exp(sum(ln(1 + net)) OVER (PARTITION BY params ORDER BY as_of)) AS equity FROM daily),
f AS (SELECT *, 1 - equity / greatest(max(equity) OVER (PARTITION BY params ORDER BY as_of), 1.0) AS fall FROM e),
m AS (SELECT params, count(*) AS days, arg_max(equity, as_of) AS equity, avg(net) AS mean, stddev_samp(net) AS sd, max(fall) AS dd, avg(gross) AS gross, sum(turnover) AS turnover FROM f GROUP BY params)
SELECT params, days, round(equity - 1, 6) AS total_return, round(CASE WHEN equity > 0 THEN pow(equity, 365.0 / days) - 1 ELSE 0 END, 6) AS annual_return, round(sd * sqrt(365), 6) AS annual_volatility,
  round(CASE WHEN sd > 0 THEN mean / sd * sqrt(365) ELSE 0 END, 6) AS sharpe, round(greatest(dd, 0), 6) AS max_drawdown, round(gross, 6) AS average_gross, round(turnover, 6) AS turnover FROM m""",
    "replay_differences": """SELECT 'same' AS run, CAST(0 AS BIGINT) AS differences UNION ALL
SELECT 'changed', count(*) FROM range(3), (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 06:00:00', TIMESTAMP '2024-02-01 06:00:00', INTERVAL 1 DAY)) AS t) WHERE epoch_us(t) % 9 = 0 AND t >= TIMESTAMP '2024-01-02 06:00:00'""",
    "input_fingerprint": f"""WITH {_BACKTEST}, l AS (SELECT entity || '|' || CAST(epoch_us(as_of) AS VARCHAR) || '|close|' || CAST(CAST(round(value, 6) AS DECIMAL(38,9)) AS VARCHAR) || '|' || CAST(epoch_us(CAST(session_date AS TIMESTAMP)) AS VARCHAR) AS line FROM seen WHERE n = 1 AND feature = 'close')
SELECT count(*) AS rows, {digests.SQL} AS digest FROM l""",
    "param_grid": """SELECT 'lb' || l || '-vol' || CASE WHEN v = 0.1 THEN '0.1' ELSE '0.2' END || CASE WHEN b THEN '-brake' ELSE '-nobrake' END || CASE WHEN p THEN '-profit' ELSE '-any' END AS params, l AS lookback, v::DOUBLE AS target_vol, b AS brake, p AS need_profit
FROM (VALUES (20), (60), (120)) a(l), (VALUES (0.1), (0.2)) c(v), (VALUES (false), (true)) d(b), (VALUES (false), (true)) e(p)""",
    "price_lineage_size": f"""WITH {fr.DAYS} SELECT symbol || '/' || CAST(session_date AS VARCHAR) AS row_id, CAST(least(21, row_number() OVER (PARTITION BY symbol ORDER BY session_date)) AS BIGINT) AS items FROM days""",
}

_BARS = f"""{fr.DAYS},
bars AS (SELECT 'bar:' || symbol || '/' || CAST(session_date AS VARCHAR) AS item_id, symbol, session_date, knowable_at, CAST(close AS DOUBLE) AS c FROM days),
base AS (SELECT symbol, CASE WHEN count(*) > 1 AND arg_max(c, session_date) > arg_min(c, session_date) THEN 1.0::DOUBLE ELSE 0 END AS v
  FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY session_date DESC) AS n FROM bars) WHERE n <= 5 GROUP BY 1)"""


def _momentum(rows: str, world: str) -> str:
    return f"""SELECT {world}, symbol, CASE WHEN count(*) > 1 AND arg_max(c, session_date) > arg_min(c, session_date) THEN 1.0::DOUBLE ELSE 0 END AS v
  FROM (SELECT *, row_number() OVER (PARTITION BY {world}, symbol ORDER BY session_date DESC) AS n FROM {rows}) WHERE n <= 5 GROUP BY {world}, symbol"""


def _holm(p: str, key: str, rows: str) -> str:
    """Adjusted p-values of a table, ties in the order of its key."""
    return f"""SELECT {key}, least(1.0, max(s) OVER (ORDER BY i)) AS a FROM (SELECT {key}, {p} * (count(*) OVER () - row_number() OVER (ORDER BY {p}, {key}) + 1) AS s, row_number() OVER (ORDER BY {p}, {key}) AS i FROM {rows})"""


ORACLE |= {
    "attribution_leave_one_out": f"""WITH {_BARS}, gone AS (SELECT x.item_id, y.symbol, y.session_date, y.c FROM bars x JOIN bars y ON x.symbol = y.symbol AND x.item_id <> y.item_id),
m AS ({_momentum("gone", "item_id")})
SELECT b.item_id, b.symbol AS part, base.v AS before, coalesce(m.v, 0) AS after, CASE WHEN base.v = coalesce(m.v, 0) THEN 'same' ELSE 'changed' END AS outcome, abs(coalesce(m.v, 0) - base.v) AS size
FROM bars b JOIN base USING (symbol) LEFT JOIN m ON m.item_id = b.item_id""",
    "sufficiency_minimal_set": f"""WITH {_BARS} SELECT arg_min(item_id, (knowable_at, item_id)) AS item_id FROM bars b JOIN (SELECT symbol, max(c) AS c FROM bars GROUP BY 1) m USING (symbol, c) GROUP BY symbol""",
    "horizon_curve": f"""WITH {_BARS}, d AS (SELECT CAST(unnest(range(41)) AS INTEGER) AS days), r AS (SELECT unnest([0, 1, 3, 7, 14, 21, 30, 40]) AS days),
k AS (SELECT days, symbol, session_date, c FROM bars, d WHERE epoch_us(knowable_at) > epoch_us(TIMESTAMP '2024-02-01 06:00:00') - days * 86400000000),
m AS ({_momentum("k", "days")}),
h AS (SELECT base.symbol AS part, days, coalesce(m.v, 0) = base.v AS held FROM base JOIN d ON true LEFT JOIN m USING (symbol, days)),
e AS (SELECT * FROM h UNION ALL SELECT '*', days, bool_and(held) FROM h GROUP BY days),
x AS (SELECT part, max(days) FILTER (WHERE NOT held) AS broken FROM e SEMI JOIN r USING (days) GROUP BY 1),
s AS (SELECT part, broken, min(days) FILTER (WHERE days > coalesce(broken, -1)) AS above FROM e SEMI JOIN r USING (days) JOIN x USING (part) GROUP BY ALL),
t AS (SELECT part, max(days) FILTER (WHERE NOT held AND days >= broken AND (above IS NULL OR days < above)) AS breaks_at, min(above) AS above FROM e JOIN s USING (part) GROUP BY 1)
SELECT part, CASE WHEN breaks_at IS NULL THEN above WHEN above IS NOT NULL THEN breaks_at + 1 END AS holds_to, breaks_at,
  coalesce((SELECT string_agg(e.days, ',' ORDER BY e.days DESC) FROM e SEMI JOIN r USING (days) WHERE e.part = t.part AND e.held AND e.days < t.breaks_at), '') AS recovers FROM t""",
    "share_curve": f"""WITH {_BARS}, known AS (SELECT * FROM bars WHERE knowable_at <= TIMESTAMP '2024-01-20 06:00:00'),
ret AS (SELECT symbol, b / a - 1 AS r FROM (SELECT symbol, arg_max(c, session_date) AS a FROM known GROUP BY 1) JOIN (SELECT symbol, arg_max(c, session_date) AS b FROM bars WHERE knowable_at <= TIMESTAMP '2024-01-27 06:00:00' GROUP BY 1) USING (symbol)),
p AS (SELECT *, row_number() OVER (PARTITION BY chain ORDER BY sha256(':' || CAST(chain AS VARCHAR) || ':' || item_id), item_id) AS pos, count(*) OVER (PARTITION BY chain) AS size FROM known, (SELECT unnest(range({CHAINS})) AS chain)),
l AS (SELECT unnest([0.0, 0.25, 0.5, 0.75, 1.0]::DOUBLE[]) AS level),
k AS (SELECT chain * 100 + CAST(level * 4 AS INTEGER) AS w, p.* EXCLUDE (pos, size) FROM p, l WHERE pos <= round(level * size)),
m AS ({_momentum("k", "w")}),
q AS (SELECT w, sum(v * (r - (SELECT avg(r) FROM ret))) AS q FROM m JOIN ret USING (symbol) GROUP BY 1),
t AS (SELECT chain, level, coalesce(q.q, 0) AS q FROM (SELECT unnest(range({CHAINS})) AS chain) JOIN l ON true LEFT JOIN q ON w = chain * 100 + CAST(level * 4 AS INTEGER)),
d AS (SELECT a.level AS low, b.level AS high, list(b.q - a.q ORDER BY a.chain) AS d FROM t a JOIN t b ON a.chain = b.chain AND a.level < b.level GROUP BY ALL),
g AS (SELECT low, high, d, list_sum([abs(d[i + 1]) * ((f >> i) & 1) FOR i IN range(len(d))]) AS gain, list_sum([greatest(x, 0) FOR x IN d]) AS seen, 1e-9 * list_sum([abs(x) FOR x IN d]) AS near FROM d, (SELECT unnest(range(1 << {CHAINS})) AS f)),
s AS (SELECT low * 10 + high AS pair, low, high, any_value(list_avg(d)) AS change, avg(CASE WHEN gain <= seen + near THEN 1.0::DOUBLE ELSE 0 END) AS f, avg(CASE WHEN gain >= seen - near THEN 1.0::DOUBLE ELSE 0 END) AS r FROM g GROUP BY low, high),
hf AS ({_holm("f", "pair", "s")}), hr AS ({_holm("r", "pair", "s")})
SELECT low, high, round(change, 9) AS change, round(hf.a, 9) AS falls, round(hr.a, 9) AS rises FROM s JOIN hf USING (pair) JOIN hr USING (pair)""",
    "source_value": f"""WITH {_BARS}, n AS (SELECT symbol, count(*) AS items, any_value(base.v) AS v FROM bars JOIN base USING (symbol) GROUP BY 1),
s AS (SELECT 'series:' || symbol AS source, items, CAST(v AS BIGINT) AS parts_changed FROM n UNION ALL SELECT 'feed:bar', CAST(sum(items) AS BIGINT), CAST(sum(v) AS BIGINT) FROM n)
SELECT *, CASE WHEN parts_changed > 0 THEN 'changes' ELSE 'changes nothing' END AS verdict FROM s""",
    "decomposition": """WITH s AS (SELECT CASE WHEN user_id * 3600 <= 3 * 86400 THEN 'before' ELSE 'after' END AS era, CAST(user_id AS VARCHAR) AS unit,
  avg(value) FILTER (WHERE event_type = 'click') AS blind, avg(value) FILTER (WHERE event_type = 'view') AS recall, avg(value) FILTER (WHERE event_type = 'signup') AS tooled FROM events GROUP BY 1, 2),
d AS (SELECT * FROM (SELECT era, unit, unnest(['recall-blind', 'tooled-recall', 'tooled-blind']) AS comparison, unnest([recall - blind, tooled - recall, tooled - blind]) AS x FROM s) WHERE x IS NOT NULL),
p AS (SELECT *, count(*) OVER (PARTITION BY comparison, era) AS n, row_number() OVER (PARTITION BY comparison, era ORDER BY unit) - 1 AS pos FROM d),
z AS (SELECT comparison, era, any_value(n) AS n, avg(x) AS mean FROM p GROUP BY ALL),
r AS (SELECT comparison, era, round, CAST('0x' || substr(sha256('0:' || CAST(round AS VARCHAR) || ':' || CAST(draw AS VARCHAR)), 1, 8) AS BIGINT) % n AS pos FROM (SELECT z.*, k.round, unnest(range(1, n + 1)) AS draw FROM z, (SELECT unnest(range(1, 201)) AS round) k)),
m AS (SELECT comparison, era, round, avg(x) AS m FROM r JOIN p USING (comparison, era, pos) GROUP BY ALL)
SELECT comparison, era, any_value(z.n) AS units, round(any_value(mean), 9) AS mean, round(quantile_cont(m, 0.025), 9) AS low, round(quantile_cont(m, 0.975), 9) AS high FROM m JOIN z USING (comparison, era) GROUP BY ALL""",
    "exact_tests": f"""WITH e AS (SELECT event_type, count(*) FILTER (WHERE event_id % 7 > 3) AS late, count(*) AS n FROM events GROUP BY 1),
t AS (SELECT *, CAST(sum(late) OVER () AS BIGINT) AS h, CAST(sum(n) OVER () AS BIGINT) AS a FROM e),
k AS (SELECT event_type, late, k, lgamma(h + 1) - lgamma(k + 1) - lgamma(h - k + 1) + lgamma(a - h + 1) - lgamma(n - k + 1) - lgamma(a - h - n + k + 1) - lgamma(a + 1) + lgamma(n + 1) + lgamma(a - n + 1) AS x
  FROM (SELECT *, unnest(range(greatest(0, h + n - a), least(h, n) + 1)) AS k FROM t)),
p AS (SELECT event_type, sum(exp(x)) AS p FROM k JOIN (SELECT event_type, x AS seen FROM k WHERE k = late) USING (event_type) WHERE x <= seen + 1e-7 GROUP BY 1),
q AS (SELECT event_type, least(1.0, p) AS p FROM p), h AS ({_holm("p", "event_type", "q")})
SELECT event_type, round(p, 6) AS p, round(a, 6) AS adjusted FROM q JOIN h USING (event_type)""",
}
