from __future__ import annotations

import random
from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.plans import asof

T0 = datetime(2024, 1, 1, tzinfo=UTC)
SCHEMA = "entity string, feature string, event_time timestamp, knowable_at timestamp, source_table string, source_ref string, value double"


def h(n, us=0):
    return T0 + timedelta(hours=n, microseconds=us)


def facts(spark, rows):
    return spark.createDataFrame([(e, f, h(t), None if k is None else h(k), "t", r, v) for e, f, t, k, r, v in rows], SCHEMA)


def spine(spark, rows):
    return spark.createDataFrame(rows, "entity string, as_of timestamp")


def values(df):
    return sorted((r["entity"], r["as_of"].replace(tzinfo=UTC), r["feature"], r["source_ref"], r["value"]) for r in df.collect())


@pytest.mark.parametrize("plan", ["merge", "interval"])
def test_invisible_a_microsecond_before(spark, plan):
    f = facts(spark, [("a", "x", 0, 5, "r", 1.0)])
    assert values(asof.as_of(f, spine(spark, [("a", h(5, -1))]), plan=plan)) == []
    assert [v[4] for v in values(asof.as_of(f, spine(spark, [("a", h(5))]), plan=plan))] == [1.0]


@pytest.mark.parametrize("plan", ["merge", "interval"])
def test_restatement_replaces_but_never_beats_a_later_event(spark, plan):
    f = facts(spark, [("a", "x", 0, 1, "old", 1.0), ("a", "x", 0, 3, "restated", 2.0), ("a", "x", 1, 2, "later", 9.0), ("a", "x", 0, 8, "late", 3.0)])
    got = {v[1]: v[3] for v in values(asof.as_of(f, spine(spark, [("a", h(n)) for n in (1, 2, 9)]), plan=plan))}
    assert got == {h(1): "old", h(2): "later", h(9): "later"}


@pytest.mark.parametrize("plan", ["merge", "interval"])
def test_null_value_wins_and_null_knowable_never_shows(spark, plan):
    f = facts(spark, [("a", "x", 0, 1, "r", 1.0), ("a", "x", 1, 2, "n", None), ("a", "x", 5, None, "ghost", 7.0)])
    assert values(asof.as_of(f, spine(spark, [("a", h(9))]), plan=plan)) == [("a", h(9), "x", "n", None)]


@pytest.mark.parametrize("plan", ["merge", "interval"])
def test_global_entity_reaches_each_entity_once(spark, plan):
    f = facts(spark, [("G", "cpi", 0, 1, "g", 3.0), ("a", "x", 0, 1, "r", 1.0)])
    got = values(asof.as_of(f, spine(spark, [("a", h(2)), ("b", h(2)), ("G", h(2))]), "G", plan))
    assert [(v[0], v[2]) for v in got] == [("G", "cpi"), ("a", "cpi"), ("a", "x"), ("b", "cpi")]


def test_spine_is_checked(spark):
    f = facts(spark, [("a", "x", 0, 1, "r", 1.0)])
    assert values(asof.as_of(f, spine(spark, [("a", None), (None, h(1))]))) == []
    with pytest.raises(asof.SpineError):
        asof.as_of(f, spark.createDataFrame([("a", date(2024, 1, 1))], "entity string, as_of date"))
    with pytest.raises(asof.SpineError):
        asof.as_of(f, spine(spark, [("a", h(1))]).withColumn("as_of", F.col("as_of").cast("timestamp_ntz")))
    with pytest.raises(asof.SpineError):
        asof.features_at(f, datetime(2024, 1, 1))


def sweep(rows, probes):
    out = []
    for e, t in sorted(set(probes)):
        best = {}
        for entity, feature, event, known, ref, value in rows:
            if entity == e and known is not None and h(known) <= t:
                key = (event, known, "t", ref, float("-inf") if value is None else value)
                if feature not in best or key > best[feature][0]:
                    best[feature] = key, ref, value
        out += [(e, t, f, ref, v) for f, (_, ref, v) in best.items()]
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_plans_agree_with_a_sweep(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("abc"), rng.choice("xy"), rng.randrange(12), rng.choice([None, *range(20)]), f"r{i:03d}", rng.choice([None, 1.0, 2.0])) for i in range(150)]
    probes = [(rng.choice("abcd"), h(rng.randrange(22))) for _ in range(25)]
    f, s = facts(spark, rows), spine(spark, probes)
    want = sweep(rows, probes)
    key = lambda r: tuple(str(x) for x in r)
    for plan in ("merge", "interval", "auto"):
        got = [(r["entity"], r["as_of"].replace(tzinfo=UTC), r["feature"], r["source_ref"], r["value"]) for r in asof.as_of(f, s, plan=plan).collect()]
        assert sorted(got, key=key) == sorted(want, key=key)


def test_merge_plan_shuffles_facts_once(spark, sf):
    from tidemark.queries import frames as fr

    plan = asof.as_of(fr.facts(spark, sf), fr.spine(spark, sf), plan="merge")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") >= 1 and "CartesianProduct" not in plan


def test_interval_plan_broadcasts_the_spine(spark, sf):
    from tidemark.queries import frames as fr

    plan = asof.as_of(fr.facts(spark, sf), fr.spine(spark, sf), plan="interval")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_features_at_equals_the_read(spark, sf):
    from tidemark.queries import frames as fr

    f, at = fr.facts(spark, sf), datetime(2024, 1, 15, 6, tzinfo=UTC)
    s = f.select("entity").distinct().withColumn("as_of", F.lit(at))
    a, b = asof.features_at(f, at), asof.as_of(f, s)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
