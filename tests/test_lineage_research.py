from __future__ import annotations

import random
from datetime import UTC, date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import stats
from tidemark.operators import counterfactual as cf
from tidemark.operators import features, harness, leakage, lineage, research, views

T0 = datetime(2024, 1, 2, tzinfo=UTC)


def daily(spark, n=40):
    rows = [("S", date(2024, 1, 1) + timedelta(days=i), Decimal(100 + (7 * i) % 5), Decimal(10 + i), T0 + timedelta(days=i)) for i in range(n)]
    return spark.createDataFrame(rows, "symbol string, session_date date, close decimal(28,10), volume decimal(38,10), knowable_at timestamp")


def rounded(df):
    return df.withColumn("value", F.round("value", 9))


def same(a, b):
    return leakage.differences(rounded(a), rounded(b)).count() == 0


def test_recomputing_equals_rebuilding_and_hiding_does_not(spark):
    d = daily(spark)
    full = features.price_features(d)
    gone = "bar:S/2024-01-20"
    withheld = spark.createDataFrame([("w", gone)], "world string, item_id string")
    touched = lineage.affected(lineage.price_edges(d), withheld)
    assert touched.count() == 21
    patched = lineage.patch(full, touched, lineage.recompute(d, withheld), "w")
    assert same(patched, lineage.rebuild(d, [gone]))
    assert not same(lineage.hide(full, [gone]), lineage.rebuild(d, [gone]))
    assert same(lineage.rebuild(d, []), full)


def test_many_withheld_bars_in_one_world(spark):
    d = daily(spark, 70)
    gone = [f"bar:S/{date(2024, 1, 1) + timedelta(days=i)}" for i in (5, 25, 26, 27, 50)]
    withheld = spark.createDataFrame([("w", g) for g in gone], "world string, item_id string")
    touched = lineage.affected(lineage.price_edges(d), withheld)
    assert same(lineage.patch(features.price_features(d), touched, lineage.recompute(d, withheld), "w"), lineage.rebuild(d, gone))


def test_information_sets(spark):
    items = lineage.items(daily(spark), "bar", ["symbol", "session_date"], ["close"])
    at = T0 + timedelta(days=9)
    assert items.count() == 40 and lineage.ambiguous(items).count() == 0
    assert lineage.information_set(items, at).count() == 10
    assert lineage.information_set(items, at, ["bar:S/2024-01-03"]).count() == 9
    with pytest.raises(lineage.UnknownItem):
        lineage.information_set(items, at, ["bar:S/2024-02-01"])
    a, b = (lineage.set_hash(lineage.information_set(items, at, o)).first() for o in ([], ["bar:S/2024-01-03"]))
    assert a["items"] == 10 and a["set_hash"] != b["set_hash"]
    assert lineage.unaccounted(features.price_features(daily(spark)), items, at).count() == 0


def test_counterfactual_audit(spark):
    d = daily(spark)
    spine = spark.createDataFrame([("S",)], "entity string")
    at = T0 + timedelta(days=30)
    assert leakage.counterfactual(features.price_features(d), d, features.price_features, at, spine).count() == 0
    early = features.price_features(d).withColumn("knowable_at", F.col("knowable_at") - F.expr("INTERVAL 3 DAYS"))
    assert leakage.counterfactual(early, d, features.price_features, at, spine).count() > 0


def test_audit_instants():
    found = leakage.audit_instants([T0 + timedelta(days=i) for i in range(10)], 2, 3)
    assert found == [T0 + timedelta(days=i) - timedelta(microseconds=1) for i in (0, 4, 7, 8, 9)]


def test_backtest_earns_the_following_return(spark):
    rows = [("A", T0 + timedelta(days=i), float(c), T0 + timedelta(days=i - 1), 0.01, None, None) for i, c in enumerate((100, 101, 103, 103))]
    seen = spark.createDataFrame(rows, "entity string, as_of timestamp, close double, close_time timestamp, vol double, income double, inflation double")
    params = research.params_frame(spark, [research.Params(1, 0.2, False, False, 5.0)])
    days = research.daily(research.positions(seen, params, 1)).orderBy("as_of").collect()
    size = min(0.2 / (0.01 * 365**0.5), 2.0)
    assert [d["gross"] for d in days] == pytest.approx([0, size, size, 0])
    assert [d["pnl"] for d in days] == pytest.approx([0, 0, size * (103 / 101 - 1), 0])
    assert [d["cost"] for d in days] == pytest.approx([0, size * 5e-4, 0, size * 5e-4])


def test_metrics(spark):
    net = [0.1, -0.2, 0.05]
    rows = [("p", T0 + timedelta(days=i), x, 0.0, x, 1.0, 0.5) for i, x in enumerate(net)]
    m = research.metrics(spark.createDataFrame(rows, "params string, as_of timestamp, pnl double, cost double, net double, gross double, turnover double")).first()
    equity = 1.1 * 0.8 * 1.05
    assert m["total_return"] == pytest.approx(equity - 1) and m["max_drawdown"] == pytest.approx(0.2)
    assert m["annual_return"] == pytest.approx(equity ** (365 / 3) - 1) and m["turnover"] == pytest.approx(1.5)


def test_params_are_checked_and_named():
    assert len(research.grid()) == 24 and len({p.name for p in research.grid()}) == 24
    for bad in ((0, 0.1, True, True), (1, 0.0, True, True), (1, 1.5, True, True)):
        with pytest.raises(ValueError):
            research.Params(*bad)


def test_fingerprint_ignores_order_and_partitions(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), (F.col("id") / 7).alias("v"))
    a, b = (research.fingerprint(x, ["k", "v"]).first() for x in (df, df.orderBy(F.rand(1)).repartition(7)))
    assert a == b and a["rows"] == 1000
    assert research.fingerprint(df.where("k <> '5'"), ["k", "v"]).first()["digest"] != a["digest"]


# -- statistics


def test_fisher_exact():
    assert stats.fisher_exact(3, 3, 0, 3) == pytest.approx(0.1)
    assert stats.fisher_exact(8, 10, 1, 6) == pytest.approx(0.034965, abs=1e-6)
    assert stats.fisher_exact(0, 0, 1, 6) == 1.0


def test_fisher_against_all_tables():
    from math import comb

    for a, n, c, m in [(3, 9, 5, 7), (0, 4, 4, 4), (2, 2, 0, 30), (7, 20, 9, 11)]:
        ways = {k: comb(a + c, k) * comb(n + m - a - c, n - k) for k in range(max(0, a + c - m), min(a + c, n) + 1)}
        assert stats.fisher_exact(a, n, c, m) == pytest.approx(sum(w for w in ways.values() if w <= ways[a]) / comb(n + m, n))
    assert 0 < stats.fisher_exact(30_000, 60_000, 9_800, 20_000) < 0.05


def test_sign_flip_exact_and_drawn():
    assert stats.sign_flip([1.0, 1.0, 1.0]) == (1.0, 0.125)
    assert stats.sign_flip([1.0, -1.0]) == (0.75, 0.75)
    low, high = stats.sign_flip([1.0] * 14, 3)
    assert low == 1.0 and high < 0.01
    assert stats.sign_flip([]) == (1.0, 1.0)


def test_holm_and_regions():
    assert stats.holm([0.01, 0.04, 0.03]) == pytest.approx([0.03, 0.06, 0.06])
    assert stats.merged_regions([(0.5, 0.7), (0, 0.2), (0.2, 0.3)]) == [(0, 0.3), (0.5, 0.7)]
    assert stats.merged_regions([]) == [] and stats.holm([]) == []


# -- searches


def items(spark, n=20):
    rows = [(f"bar:{'AB'[i % 2]}/{i:02d}" if i % 5 else f"filing:{i:02d}", "bar" if i % 5 else "filing", "AB"[i % 2], T0 + timedelta(days=i), i) for i in range(n)]
    return spark.createDataFrame(rows, "item_id string, kind string, entity string, knowable_at timestamp, i int")


def needs(*sets):
    """A decider of one part: 1 if a world contains all of any of the sets."""

    def decide(rows):
        there = rows.groupBy("world").agg(F.collect_set("i").alias("s"))
        ok = F.lit(False)
        for x in sets:
            ok |= F.size(F.array_intersect("s", F.lit(sorted(x)))) == len(x)
        return there.select("world", F.lit("p").alias("part"), ok.cast("double").alias("value"))

    return decide


@pytest.mark.parametrize("seed", range(3))
def test_minimal_sets_hold_and_are_minimal(spark, seed):
    rng = random.Random(seed)
    sets = [frozenset(rng.sample(range(20), 3)) for _ in range(2)]
    every = items(spark)
    kept = {r["item_id"] for r in cf.minimal_set(every, needs(*sets), width=4).collect()}
    found = {r["i"] for r in every.where(F.col("item_id").isin(kept)).collect()}
    holds = lambda ids: any(n <= ids for n in sets)
    assert holds(found) and not any(holds(found - {x}) for x in found)


def test_nothing_is_needed_for_what_holds_anyway(spark):
    assert cf.minimal_set(items(spark), needs({99})).count() == 0


def test_horizon_finds_the_breaking_day(spark):
    every = items(spark, 40)  # item i became known 40 - i days before the instant
    at = T0 + timedelta(days=40, seconds=-1)
    h = {r["part"]: r for r in cf.horizon(every, at, 60, needs({23}), (30, 10, 1)).collect()}
    assert (h["p"]["holds_to"], h["p"]["breaks_at"], h["p"]["recovers"]) == (17, 16, []) and h["*"]["breaks_at"] == 16
    h = cf.horizon(every, at, 60, needs({99}), (30, 0)).where("part = 'p'").first()
    assert (h["holds_to"], h["breaks_at"]) == (0, None)

    def even(rows):  # holds while a world has an even number of items
        return rows.groupBy("world").agg(F.lit("p").alias("part"), (F.count("*") % 2).cast("double").alias("value"))

    h = cf.horizon(every, at, 60, even, (30, 12, 9, 8)).where("part = 'p'").first()
    assert h["breaks_at"] == 11 and h["recovers"] == [8]


def test_attribution_screens_worlds_with_equal_inputs(spark):
    every = items(spark, 6)
    asked = []

    def decide(rows):
        asked.append(rows.select("world").distinct().count())
        return needs({1})(rows)

    def inputs(rows):
        return rows.groupBy("world").agg(F.max((F.col("i") == 1).cast("int")).cast("string").alias("digest"))

    for screen in (None, inputs):
        effects = cf.leave_one_out(every, every, decide, inputs=screen).collect()
        assert len(effects) == 6 and [r["world"] for r in effects if r["outcome"] != cf.SAME] == ["bar:B/01"]
    assert asked == [1, 6, 1, 1]
    own = cf.leave_one_out(every, every, lambda rows: rows.groupBy("world", F.col("entity").alias("part")).agg(F.count("*").cast("double").alias("value")), "entity")
    assert {(r["before"], r["after"]) for r in own.collect()} == {(3.0, 2.0)} and cf.caused(own).count() == 6


def test_bars_are_spread_out(spark):
    chosen = cf.spread_out(items(spark, 40), "bar", 3).collect()
    assert sum(r["kind"] == "filing" for r in chosen) == 8 and sum(r["kind"] == "bar" for r in chosen) == 6
    assert [r["kind"] for r in cf.spread_out(items(spark, 40), "bar", 1).collect()].count("bar") == 2


def samples(spark, rows):
    return spark.createDataFrame([(w, i, p, v) for w, p, values in rows for i, v in enumerate(values)], "world string, sample int, part string, value string")


def test_sampled_effects(spark):
    base = samples(spark, [("*", "x", ["up"] * 10)]).drop("world")
    told = samples(spark, [("gone", "x", ["down"] * 9 + [None]), ("quiet", "x", ["up"] * 9 + ["down"]), ("bad", "x", [None] * 9 + ["up"]), ("torn", "x", ["a", "b", "c", "d", "e"] * 2)])
    found = {r["world"]: r for r in cf.sampled_effects(base, told, 0.6).collect()}
    assert found["gone"]["outcome"] == cf.FLIPPED and found["gone"]["p"] < cf.ALPHA and found["gone"]["size"] == 1.0
    assert found["quiet"]["outcome"] == cf.SAME and found["quiet"]["p"] > cf.ALPHA
    assert found["bad"]["outcome"] == cf.INVALID and found["torn"]["outcome"] == cf.UNSETTLED
    tie = cf.settle(samples(spark, [("*", "x", ["b", "a"])]).drop("world"), 0.5).first()
    assert (tie["value"], tie["votes"], tie["asked"]) == ("a", 1, 2)


def test_rounds_stop_when_nothing_can_settle(spark):
    asked = []

    def ask(rows):
        asked.append(rows.count())
        return rows.select("world", "sample", F.lit("x").alias("part"), F.when(F.col("world") == "same", "up").otherwise("down").alias("value"))

    was = spark.createDataFrame([("x", "up")], "part string, value string")
    told = harness.rounds(spark.createDataFrame([("same",), ("gone",)], "world string"), ask, was, 10, 0.6, 2)
    assert asked == [4, 4, 4, 2, 2] and told.groupBy("world").count().orderBy("world").collect()[0]["count"] == 6


def test_shares_and_curves(spark):
    own = {r["world"]: set(r["ids"]) for r in cf.shares(items(spark, 10), 2, (0.0, 0.3, 0.7, 1.0), "s").groupBy("world").agg(F.collect_set("item_id").alias("ids")).collect()}
    assert len(own) == 6 and all(own[f"{c}/0.3"] < own[f"{c}/0.7"] < own[f"{c}/1.0"] and len(own[f"{c}/0.3"]) == 3 for c in range(2))

    def steps(table):
        rows = [(f"{c}/{f}", q) for c, row in enumerate(table) for f, q in row.items()]
        return cf.share_steps(spark.createDataFrame(rows, "world string, quality double"), len(table), tuple(table[0]))

    up = steps([{0.0: 0.0, 0.5: 1.0 + k / 100, 1.0: 1.0 + k / 100} for k in range(8)])
    assert cf.saturation(up, (0.0, 0.5, 1.0)) == 0.5 and cf.falling_regions(up) == []
    down = steps([{0.0: 1.0 + k / 100, 1.0: 0.0} for k in range(8)])
    assert cf.falling_regions(down) == [(0.0, 1.0)]


def test_sources_and_verdicts(spark):
    every = items(spark, 10)
    found = cf.source_value(every, cf.sources_of(every, F.col("kind"), F.concat_ws("/", "kind", "entity")), needs({1, 3})).collect()
    assert {r["world"]: (r["items"], r["verdict"]) for r in found} == {
        "feed:bar": (8, cf.CHANGES), "feed:filing": (2, cf.NOTHING), "series:bar/A": (4, cf.NOTHING), "series:bar/B": (4, cf.CHANGES), "series:filing/A": (1, cf.NOTHING), "series:filing/B": (1, cf.NOTHING),
    }


def test_paired_differences_by_era(spark):
    rows = [(e, str(u), c, float(u + k * (e == "after"))) for e in ("before", "after") for u in range(30) for k, c in enumerate(("blind", "recall", "tooled"))]
    told = cf.bootstrap(cf.paired(spark.createDataFrame(rows, "era string, unit string, condition string, score double"), ["era"]), ["comparison", "era"], 50).collect()
    assert {(r["comparison"], r["era"]): (r["units"], r["mean"], r["low"], r["high"]) for r in told} == {
        (c, e): (30, k * (e == "after"), k * (e == "after"), k * (e == "after")) for c, k in (("recall-blind", 1.0), ("tooled-recall", 1.0), ("tooled-blind", 2.0)) for e in ("before", "after")
    }
    far = spark.createDataFrame([("p", str(u), float(u)) for u in range(20)], "comparison string, unit string, difference double")
    r = cf.bootstrap(far, ["comparison"], 200).first()
    assert r["low"] < r["mean"] < r["high"] and 5 < r["low"] and r["high"] < 14
    e = spark.range(1).select(cf.recall_error(F.lit(10.0), F.lit(10.0)).alias("a"), cf.recall_error(F.lit(None), F.lit(1.0)).alias("b"), cf.recall_error(F.lit(-1.0), F.lit(1.0)).alias("c")).first()
    assert (e["a"], e["b"], e["c"]) == (0.0, None, None)


def test_agents_are_bounded_and_told_of_errors():
    told = []

    def model(messages):
        told.append(messages[-1]["text"])
        return {"tool": "f", "arguments": {"x": 1}} if len(messages) < 3 else {"answer": "done"}

    out = harness.run_agent(model, {"f": lambda x: 1 / 0}, "q")
    assert out["answer"] == "done" and told[-1].startswith("error:")
    assert harness.run_agent(lambda m: {"tool": "f"}, {"f": lambda: "x"}, "q", 3)["answer"] is None
    assert harness.strict_answer('{"A": "up"}', {"A": ["up", "down"]}) == {"A": "up"}
    assert harness.strict_answer('{"A": "sideways"}', {"A": ["up"]}) is None and harness.strict_answer("x", {}) is None


def test_tools_know_nothing_later(spark):
    d = daily(spark, 30)
    rows = d.unionByName(d.withColumn("symbol", F.lit("T")))
    rows.createOrReplaceTempView("days")
    facts = spark.createDataFrame([("S", "eps", T0, T0, 1.0), ("S", "eps", T0 + timedelta(days=3), T0 + timedelta(days=20), 2.0), ("GLOBAL", "cpi", T0, T0, 3.0)], "entity string, feature string, event_time timestamp, knowable_at timestamp, value double")
    facts.createOrReplaceTempView("facts")
    at = T0 + timedelta(days=10)
    tools = harness.Tools(spark, at, spark.createDataFrame([("S", 2.0), ("T", 2.0)], "symbol string, quantity double")).all
    assert len(tools) == 5 and '"value":1.0' in tools["symbol_digest"]("S") and '"value":3.0' in tools["macro"]()
    assert len(tools["price_history"]("S", 5).splitlines()) in (5, 6) and "2024-01-20" not in tools["price_history"]("S", 1000)
    assert '"weight":0.5' in tools["my_portfolio"]() and tools["compare_symbols"](["S", "T"])
    for bad in (lambda: tools["compare_symbols"](["S"]), lambda: tools["price_history"]("S", 0)):
        with pytest.raises(views.BadRequest):
            bad()
