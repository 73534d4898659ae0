"""Point-in-time reads."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import functions as F

from tidemark.plans import asof
from tidemark.queries import frames as fr

US = "entity, epoch_us(as_of) AS as_of_us, feature, epoch_us(event_time) AS event_time_us, epoch_us(knowable_at) AS knowable_at_us, source_ref, value"


def _out(df):
    return df.select("entity", *fr.micros("as_of"), "feature", *fr.micros("event_time", "knowable_at"), "source_ref", "value")


def _read(plan):
    return lambda spark, d: _out(asof.as_of(fr.facts(spark, d), fr.spine(spark, d), plan=plan))


def asof_global_entity(spark, d):
    return _out(asof.as_of(fr.facts(spark, d, "error"), fr.spine(spark, d), "GLOBAL"))


def asof_restatement(spark, d):
    read = asof.as_of(fr.facts(spark, d), fr.spine(spark, d))
    first = asof.first_reported(fr.facts(spark, d), ["entity", "feature", "event_time"]).select("entity", "feature", "event_time", F.col("source_ref").alias("first_ref"))
    joined = read.join(first, ["entity", "feature", "event_time"])
    return joined.groupBy("feature").agg(F.count("*").alias("probes"), F.count_if(F.col("source_ref") != F.col("first_ref")).alias("restated"))


def first_reported(spark, d):
    out = asof.first_reported(fr.facts(spark, d).select("entity", "feature", "event_time", "knowable_at", "source_ref", "value"), ["entity", "feature", "event_time"])
    return out.select("entity", "feature", *fr.micros("event_time", "knowable_at"), "source_ref", "value")


def latest_per_key(spark, d):
    log = fr.load_log(spark, d)
    return asof.latest_per_key(log, ["path"], ["loaded_at", "run"]).select("path", "run", "rows", *fr.micros("loaded_at"))


def visibility_intervals(spark, d):
    return asof.visibility(fr.facts(spark, d)).select("entity", "feature", "source_ref", "value", *fr.micros("valid_from", "valid_to"))


def asof_boundary_probe(spark, d):
    facts = fr.facts(spark, d)
    at = facts.groupBy("entity").agg(F.max("knowable_at").alias("t"))
    spine = at.select("entity", F.col("t").alias("as_of")).unionByName(at.select("entity", (F.col("t") - F.expr("INTERVAL 1 MICROSECOND")).alias("as_of")))
    return _out(asof.as_of(facts, spine))


EARLIER, LATER = datetime(2024, 1, 10, 6, tzinfo=UTC), datetime(2024, 1, 20, 6, tzinfo=UTC)


def asof_changes_between(spark, d):
    return asof.changes_between(fr.facts(spark, d), EARLIER, LATER)


def features_at_instant(spark, d):
    return _out(asof.features_at(fr.facts(spark, d), LATER, features=["click", "view"]))


QUERIES = {
    "asof_features": _read("auto"), "asof_features_interval": _read("interval"), "asof_features_merge": _read("merge"), "asof_global_entity": asof_global_entity,
    "asof_restatement": asof_restatement, "first_reported": first_reported, "latest_per_key": latest_per_key, "visibility_intervals": visibility_intervals,
    "asof_boundary_probe": asof_boundary_probe, "asof_changes_between": asof_changes_between, "features_at_instant": features_at_instant,
}

_READ = f"""WITH {fr.FACTS}, {fr.SPINE},
x AS (SELECT s.as_of, f.*, row_number() OVER (PARTITION BY s.entity, s.as_of, f.feature ORDER BY {fr.WINNER}) AS n FROM spine s JOIN facts f ON f.entity = s.entity AND f.knowable_at <= s.as_of)
SELECT {US} FROM x WHERE n = 1"""


def _at(name, when):
    return f"""{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, feature ORDER BY {fr.WINNER}) AS n FROM facts WHERE knowable_at <= TIMESTAMP '{when}') WHERE n = 1)"""


ORACLE = {
    "asof_features": _READ,
    "asof_features_interval": _READ,
    "asof_features_merge": _READ,
    "asof_global_entity": f"""WITH {fr.FACTS}, {fr.SPINE},
x AS (SELECT s.entity AS probed, s.as_of, f.*, row_number() OVER (PARTITION BY s.entity, s.as_of, f.feature ORDER BY {fr.WINNER}) AS n
  FROM spine s JOIN facts f ON (f.entity = s.entity OR f.feature = 'error') AND f.knowable_at <= s.as_of)
SELECT {US.replace('entity,', 'probed AS entity,', 1)} FROM x WHERE n = 1""",
    "asof_restatement": f"""WITH {fr.FACTS}, {fr.SPINE},
x AS (SELECT s.as_of, f.*, row_number() OVER (PARTITION BY s.entity, s.as_of, f.feature ORDER BY {fr.WINNER}) AS n FROM spine s JOIN facts f ON f.entity = s.entity AND f.knowable_at <= s.as_of),
y AS (SELECT entity, feature, event_time, arg_min(source_ref, (knowable_at, source_table, source_ref, value)) AS first_ref FROM facts GROUP BY ALL)
SELECT feature, count(*) AS probes, count(*) FILTER (WHERE source_ref <> first_ref) AS restated FROM x JOIN y USING (entity, feature, event_time) WHERE n = 1 GROUP BY feature""",
    "first_reported": f"""WITH {fr.FACTS}, x AS (SELECT *, row_number() OVER (PARTITION BY entity, feature, event_time ORDER BY knowable_at, source_ref, value) AS n FROM facts)
SELECT entity, feature, epoch_us(event_time) AS event_time_us, epoch_us(knowable_at) AS knowable_at_us, source_ref, value FROM x WHERE n = 1""",
    "latest_per_key": f"""WITH {fr.LOAD_LOG} SELECT path, run, rows, epoch_us(loaded_at) AS loaded_at_us FROM log QUALIFY row_number() OVER (PARTITION BY path ORDER BY loaded_at DESC, run DESC) = 1""",
    "visibility_intervals": f"""WITH {fr.FACTS},
k AS (SELECT DISTINCT entity, feature, knowable_at AS t FROM facts),
w AS (SELECT k.entity, k.feature, k.t, f.source_ref, f.value, row_number() OVER (PARTITION BY k.entity, k.feature, k.t ORDER BY {fr.WINNER}) AS n
  FROM k JOIN facts f ON f.entity = k.entity AND f.feature = k.feature AND f.knowable_at <= k.t),
c AS (SELECT *, lag(source_ref) OVER (PARTITION BY entity, feature ORDER BY t) AS before FROM w WHERE n = 1),
v AS (SELECT * FROM c WHERE before IS DISTINCT FROM source_ref)
SELECT entity, feature, source_ref, value, epoch_us(t) AS valid_from_us, epoch_us(lead(t) OVER (PARTITION BY entity, feature ORDER BY t)) AS valid_to_us FROM v""",
    "asof_boundary_probe": f"""WITH {fr.FACTS}, m AS (SELECT entity, max(knowable_at) AS t FROM facts GROUP BY entity),
spine AS (SELECT entity, t AS as_of FROM m UNION ALL SELECT entity, t - INTERVAL 1 MICROSECOND FROM m),
x AS (SELECT s.as_of, f.*, row_number() OVER (PARTITION BY s.entity, s.as_of, f.feature ORDER BY {fr.WINNER}) AS n FROM spine s JOIN facts f ON f.entity = s.entity AND f.knowable_at <= s.as_of)
SELECT {US} FROM x WHERE n = 1""",
    "asof_changes_between": f"""WITH {fr.FACTS}, {_at('a', '2024-01-10 06:00:00')}, {_at('b', '2024-01-20 06:00:00')}
SELECT b.entity, b.feature, a.value AS value_before, b.value AS value_after FROM b LEFT JOIN a USING (entity, feature) WHERE a.source_ref IS DISTINCT FROM b.source_ref""",
    "features_at_instant": f"""WITH {fr.FACTS}, {_at('b', '2024-01-20 06:00:00')} SELECT {US.replace('epoch_us(as_of)', "epoch_us(TIMESTAMP '2024-01-20 06:00:00')")} FROM b WHERE feature IN ('click', 'view')""",
}
