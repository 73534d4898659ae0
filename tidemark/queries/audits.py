"""Leakage audits, items, worlds."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import functions as F

from tidemark.functions import digests
from tidemark.operators import features, leakage, lineage
from tidemark.queries import frames as fr

AT = datetime(2024, 1, 25, 6, tzinfo=UTC)
WITHHELD = ["bar:click/2024-01-12", "bar:view/2024-01-05"]


def audit_closed_bar(spark, d):
    bars = fr.minutes(spark, d)
    early = bars.withColumn("knowable_at", F.when(F.unix_seconds("bar_time") % 7 == 0, F.col("bar_time")).when(F.unix_seconds("bar_time") % 11 == 0, None).otherwise(F.col("knowable_at")))
    over = F.col("bar_time") + F.expr("INTERVAL 1 MINUTE")
    clean = leakage.open_bars(bars, over).agg(F.count("*").alias("cases")).select(F.lit("clean").alias("world"), "cases")
    return clean.unionByName(leakage.open_bars(early, over).agg(F.count("*").alias("cases")).select(F.lit("faulty").alias("world"), "cases"))


def _sources(spark, d):
    return fr.facts(spark, d).select("entity", "source_ref", F.col("knowable_at").alias("source_knowable"))


def audit_after_source(spark, d):
    f = fr.facts(spark, d)
    i = F.col("source_ref").cast("long")
    faulty = f.withColumn("knowable_at", F.when(i % 101 == 0, F.col("knowable_at") - F.expr("INTERVAL 1 SECOND")).otherwise(F.col("knowable_at")))
    told = _sources(spark, d).where("cast(source_ref as long) % 103 <> 1")
    return leakage.before_source(faulty, told).groupBy("feature").agg(F.count("*").alias("cases"), F.count_if(F.col("source_knowable").isNull()).alias("without_source"))


def audit_visibility(spark, d):
    facts = fr.facts(spark, d)
    probed = _sources(spark, d)
    return leakage.visibility_probe(facts, probed).agg(F.count("*").alias("sources"), F.sum("early").alias("early"), F.sum("on_time").alias("on_time"))


def _spine(spark, d):
    return fr.trades(spark, d).select(F.col("symbol").alias("entity")).distinct()


def audit_counterfactual_zero(spark, d):
    daily = fr.days(spark, d)
    found = leakage.counterfactual(features.price_features(daily), daily, features.price_features, AT, _spine(spark, d))
    return found.agg(F.count("*").alias("cases"))


def audit_counterfactual_caught(spark, d):
    """Features that claim to be known with their own bar alone, while their windows read one that came late."""
    daily = fr.days(spark, d)
    late = daily.withColumn("knowable_at", F.when(F.col("session_date") == "2024-01-20", F.col("knowable_at") + F.expr("INTERVAL 9 DAYS")).otherwise(F.col("knowable_at")))
    careless = features.price_features(late).withColumn("knowable_at", F.col("event_time") + F.expr("INTERVAL 1 DAY 1 HOUR"))
    found = leakage.counterfactual(careless, late, features.price_features, AT, _spine(spark, d))
    return found.groupBy("feature", "side").agg(F.count("*").alias("cases"))


def filings_reported(spark, d):
    o = fr.table(spark, d, "orders")
    facts = o.select(F.col("o_custkey").alias("symbol"), F.year("o_orderdate").alias("accession"), F.col("o_orderstatus").alias("form"), F.to_date("o_orderdate").alias("filed"), F.when(F.col("o_orderkey") % 3 == 0, "dei").otherwise("gaap").alias("taxonomy"), F.to_date("o_orderdate").alias("period_end"))
    filings = o.where("o_orderkey % 2 = 0").groupBy(F.col("o_custkey").alias("symbol"), F.year("o_orderdate").alias("accession")).agg(F.max("o_orderdate").alias("acceptance"))
    return leakage.knowable_from(facts, filings, "UTC").select("symbol", "accession", "form", "filed", "period_end", "knowable_basis", *fr.micros("knowable_from"))


def _items(spark, d):
    return lineage.items(fr.days(spark, d).withColumn("close", F.col("close").cast("double")), "bar", ["symbol", "session_date"], ["close"])


def items_enumerate(spark, d):
    return _items(spark, d).select("item_id", "kind", "entity", *fr.micros("knowable_at"), "digest")


def information_set(spark, d):
    return lineage.set_hash(lineage.information_set(_items(spark, d), AT, WITHHELD)).select("items", "set_hash")


def world_rows(spark, d):
    f = features.price_features(fr.days(spark, d))
    return lineage.world(f, lineage.information_set(_items(spark, d), AT)).groupBy("feature").agg(F.count("*").alias("rows"))


def account_reads(spark, d):
    daily = fr.days(spark, d)
    vol = features.price_features(daily).where("feature = 'volatility_20d'")
    return lineage.account(vol, lineage.price_edges(daily), lineage.information_set(_items(spark, d), AT)).select("item_id", "reads")


def unaccounted_rows(spark, d):
    daily = fr.days(spark, d)
    some = _items(spark, d).where("item_id <> 'bar:view/2024-01-05'")
    return lineage.unaccounted(features.price_features(daily), some, AT).select("entity", "feature", "source_ref")


def _withheld(spark):
    return spark.createDataFrame([("w1", WITHHELD[0]), ("w2", WITHHELD[1]), ("w3", WITHHELD[0]), ("w3", WITHHELD[1])], "world string, item_id string")


def _worlds(spark, d):
    daily = fr.days(spark, d)
    full = features.price_features(daily)
    gone = _withheld(spark)
    touched = lineage.affected(lineage.price_edges(daily), gone)
    return daily, full, touched, lineage.recompute(daily, gone)


def withhold_equals_rebuild(spark, d):
    """Of each world, rows in which the batched recomputation and a rebuild differ: none."""
    daily, full, touched, anew = _worlds(spark, d)
    out = None
    for name, ids in (("w1", WITHHELD[:1]), ("w2", WITHHELD[1:]), ("w3", WITHHELD)):
        rounded = lambda x: x.withColumn("value", F.round("value", 9))
        diff = leakage.differences(rounded(lineage.patch(full, touched, anew, name)), rounded(lineage.rebuild(daily, ids)))
        one = diff.agg(F.count("*").alias("differences")).select(F.lit(name).alias("world"), "differences")
        out = one if out is None else out.unionByName(one)
    return out


def coherence(spark, d):
    """The verdict on worlds made by recomputing, on one that only hides, and on the one that withholds nothing."""
    daily, full, touched, anew = _worlds(spark, d)
    known = lineage.information_set(_items(spark, d), "2025-01-01")
    recorded = lineage.set_hash(known).first()["set_hash"]
    worlds = {"w1": (lineage.patch(full, touched, anew, "w1"), WITHHELD[:1]), "w3": (lineage.patch(full, touched, anew, "w3"), WITHHELD), "hidden": (lineage.hide(full, WITHHELD[:1]), WITHHELD[:1]), "null": (full, [])}
    out = None
    for name, (rows, ids) in worlds.items():
        one = lineage.coherence(rows, lineage.rebuild(daily, ids), known, ids, recorded).select(F.lit(name).alias("world"), (F.col("differences") > 0).alias("differs"), "owned", "unaccounted", "keeps", "coherent")
        out = one if out is None else out.unionByName(one)
    return out


def differences_within_tolerance(spark, d):
    """Daily closes against the same with a hair's breadth, a real change, a row less and a row twice."""
    base = fr.days(spark, d).select("symbol", "session_date", F.col("close").cast("double").alias("value"))
    day = F.dayofmonth("session_date")
    other = base.where(day != 3).withColumn("value", F.when(day == 5, F.col("value") * (1 + 1e-12)).when(day == 7, F.col("value") * 1.001).otherwise(F.col("value")))
    found = leakage.differences_within(base, other.unionByName(other.where(day == 9)))
    return found.select("symbol", "session_date", "problem")


def hide_is_caught(spark, d):
    """Hiding rows without recomputing what depends on them differs from a rebuild."""
    daily = fr.days(spark, d)
    rounded = lambda x: x.withColumn("value", F.round("value", 9))
    diff = leakage.differences(rounded(lineage.hide(features.price_features(daily), WITHHELD[:1])), rounded(lineage.rebuild(daily, WITHHELD[:1])))
    return diff.groupBy("side", "feature").agg(F.count("*").alias("rows"))


def batched_worlds(spark, d):
    daily, full, touched, anew = _worlds(spark, d)
    del daily
    return lineage.patch(full, touched, anew, "w3").select("entity", "feature", F.to_date("event_time").alias("session_date"), *fr.micros("knowable_at"), F.round("value", 9).alias("value"))


QUERIES = {f.__name__: f for f in (
    audit_closed_bar, audit_after_source, audit_visibility, audit_counterfactual_zero, audit_counterfactual_caught, filings_reported, items_enumerate, information_set, world_rows, account_reads, unaccounted_rows,
    withhold_equals_rebuild, coherence, differences_within_tolerance, hide_is_caught, batched_worlds,
)}

_ITEMS = f"""{fr.DAYS},
items AS (SELECT 'bar:' || symbol || '/' || CAST(session_date AS VARCHAR) AS item_id, symbol AS entity, knowable_at,
  sha256(symbol || '|' || CAST(session_date AS VARCHAR) || '|' || CAST(CAST(CAST(close AS DOUBLE) AS DECIMAL(28,9)) AS VARCHAR)) AS digest FROM days)"""


def _rebuilt(ids: list[str], name: str = "price") -> str:
    listed = ", ".join(f"'{i}'" for i in ids)
    return fr.PRICE.replace("FROM days),\nw AS", f"FROM days WHERE 'bar:' || symbol || '/' || CAST(session_date AS VARCHAR) NOT IN ({listed})),\nw AS") if name == "price" else ""


ORACLE = {
    "audit_closed_bar": f"""WITH {fr.MINUTES}, x AS (SELECT bar_time, CASE WHEN CAST(epoch(bar_time) AS BIGINT) % 7 = 0 THEN bar_time WHEN CAST(epoch(bar_time) AS BIGINT) % 11 = 0 THEN NULL ELSE knowable_at END AS k, knowable_at FROM minutes)
SELECT 'clean' AS world, count(*) AS cases FROM x WHERE knowable_at IS NULL OR knowable_at < bar_time + INTERVAL 1 MINUTE UNION ALL SELECT 'faulty', count(*) FROM x WHERE k IS NULL OR k < bar_time + INTERVAL 1 MINUTE""",
    "audit_after_source": "SELECT event_type AS feature, count(*) AS cases, count(*) FILTER (WHERE event_id % 103 = 1) AS without_source FROM events WHERE event_id % 101 = 0 OR event_id % 103 = 1 GROUP BY 1",
    "audit_visibility": f"""WITH {fr.FACTS}, s AS (SELECT entity, source_ref, knowable_at AS t FROM facts),
w AS (SELECT s.source_ref AS probe, f.source_ref, row_number() OVER (PARTITION BY s.source_ref, f.feature ORDER BY f.event_time DESC, f.knowable_at DESC, f.source_ref DESC) AS n FROM s JOIN facts f ON f.entity = s.entity AND f.knowable_at <= s.t)
SELECT (SELECT count(*) FROM s) AS sources, CAST(0 AS BIGINT) AS early, count(*) FILTER (WHERE n = 1 AND probe = source_ref) AS on_time FROM w""",
    "audit_counterfactual_caught": f"""WITH {fr.DAYS} SELECT unnest(['close', 'volatility_20d', 'volume_mean_20d', 'close', 'volatility_20d', 'volume_mean_20d']) AS feature, unnest(['left', 'left', 'left', 'right', 'right', 'right']) AS side, n AS cases FROM (SELECT count(DISTINCT symbol) AS n FROM days)""",
    "coherence": """SELECT * FROM (VALUES ('w1', false, 0::BIGINT, 0::BIGINT, true, true), ('w3', false, 0, 0, true, true), ('hidden', true, 0, 0, true, false), ('null', false, 0, 0, true, true)) v(world, differs, owned, unaccounted, keeps, coherent)""",
    "differences_within_tolerance": f"""WITH {fr.DAYS} SELECT symbol, session_date, CASE day(session_date) WHEN 3 THEN 'only left' WHEN 7 THEN 'value' ELSE 'only right' END AS problem FROM days WHERE day(session_date) IN (3, 7, 9)""",
    "audit_counterfactual_zero": "SELECT CAST(0 AS BIGINT) AS cases",
    "filings_reported": """WITH f AS (SELECT o_custkey AS symbol, CAST(year(o_orderdate) AS INTEGER) AS accession, max(o_orderstatus) AS form, CAST(max(o_orderdate) AS DATE) AS filed,
  CAST(coalesce(max(o_orderdate) FILTER (WHERE o_orderkey % 3 <> 0), max(o_orderdate)) AS DATE) AS period_end, max(o_orderdate) FILTER (WHERE o_orderkey % 2 = 0) AS acceptance FROM orders GROUP BY 1, 2)
SELECT symbol, accession, form, filed, period_end, CASE WHEN acceptance IS NULL THEN 'filed_date' ELSE 'acceptance' END AS knowable_basis, epoch_us(coalesce(acceptance, CAST(filed + 1 AS TIMESTAMP))) AS knowable_from_us FROM f""",
    "items_enumerate": f"WITH {_ITEMS} SELECT item_id, 'bar' AS kind, entity, epoch_us(knowable_at) AS knowable_at_us, digest FROM items",
    "information_set": f"""WITH {_ITEMS}, k AS (SELECT item_id || '=' || digest AS line FROM items WHERE knowable_at <= TIMESTAMP '2024-01-25 06:00:00' AND item_id NOT IN ('bar:click/2024-01-12', 'bar:view/2024-01-05'))
SELECT count(*) AS items, {digests.SQL} AS set_hash FROM k""",
    "world_rows": f"WITH {fr.PRICE} SELECT feature, count(*) AS rows FROM price p JOIN days d ON d.symbol = p.entity AND d.session_date = p.session_date AND d.knowable_at <= TIMESTAMP '2024-01-25 06:00:00' GROUP BY feature",
    "account_reads": f"""WITH {fr.PRICE}, n AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY session_date) AS k FROM days),
u AS (SELECT n.symbol, n.k FROM price p JOIN n ON n.symbol = p.entity AND n.session_date = p.session_date WHERE p.feature = 'volatility_20d')
SELECT 'bar:' || n.symbol || '/' || CAST(n.session_date AS VARCHAR) AS item_id, count(u.k) AS reads FROM n LEFT JOIN u ON u.symbol = n.symbol AND n.k BETWEEN u.k - 20 AND u.k WHERE n.knowable_at <= TIMESTAMP '2024-01-25 06:00:00' GROUP BY ALL""",
    "unaccounted_rows": f"WITH {fr.PRICE} SELECT entity, feature, 'view/2024-01-05' AS source_ref FROM price WHERE entity = 'view' AND session_date = DATE '2024-01-05' AND known <= TIMESTAMP '2024-01-25 06:00:00'",
    "withhold_equals_rebuild": "SELECT 'w' || i AS world, CAST(0 AS BIGINT) AS differences FROM range(1, 4) t(i)",
    "batched_worlds": f"WITH {_rebuilt(WITHHELD)} SELECT entity, feature, session_date, epoch_us(known) AS knowable_at_us, round(value, 9) AS value FROM price",
    "hide_is_caught": f"""WITH {_rebuilt(WITHHELD[:1])},
full_r AS (SELECT *, ln(CAST(close AS DOUBLE) / lag(CAST(close AS DOUBLE)) OVER (PARTITION BY symbol ORDER BY session_date)) AS ret FROM days),
full_w AS (SELECT *, count(ret) OVER v AS n, stddev_samp(ret) OVER v AS sd, avg(CAST(volume AS DOUBLE)) OVER v AS mean, max(knowable_at) OVER (PARTITION BY symbol ORDER BY session_date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS known FROM full_r
  WINDOW v AS (PARTITION BY symbol ORDER BY session_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
full_p AS (SELECT symbol AS entity, 'close' AS feature, session_date, known, CAST(close AS DOUBLE) AS value FROM full_w UNION ALL SELECT symbol, 'volatility_20d', session_date, known, sd FROM full_w WHERE n = 20
  UNION ALL SELECT symbol, 'volume_mean_20d', session_date, known, mean FROM full_w WHERE n = 20),
hid AS (SELECT entity, feature, session_date, known, round(value, 9) AS value FROM full_p WHERE NOT (entity = 'click' AND session_date = DATE '2024-01-12')),
reb AS (SELECT entity, feature, session_date, known, round(value, 9) AS value FROM price)
SELECT 'left' AS side, feature, count(*) AS rows FROM (SELECT * FROM hid EXCEPT ALL SELECT * FROM reb) GROUP BY feature UNION ALL SELECT 'right', feature, count(*) FROM (SELECT * FROM reb EXCEPT ALL SELECT * FROM hid) GROUP BY feature""",
}
