from __future__ import annotations

from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import gate, leakage, ops, rules
from tidemark.queries import quality


def spec(**changes):
    base = {"table": "t", "columns": {"id": ("bigint", "raw_id"), "at": ("timestamp", "raw_at"), "v": ("decimal(10,2)", "raw_v")}, "event_time": "at", "knowable_at": "at + INTERVAL 1 MINUTE", "key": ("id",)}
    return rules.Spec(**(base | changes))


RULES = (*rules.standard_rules(("id",)), rules.Rule("positive", "v > 0"))


def raw(spark, rows):
    return spark.createDataFrame(rows, "raw_id string, raw_at string, raw_v string, _corrupt_record string, _source_file string")


ROWS = [
    ("1", "2024-01-01 00:00:00", "5", None, "f"), ("1", "2024-01-01 00:00:01", "6", None, "f"), ("1", "2024-01-01 00:00:02", "-6", None, "f"), ("x", "2024-01-01", "5", None, "f"),
    ("2", "1024-01-01", "5", None, "f"), ("3", "2024-01-01", "?", None, "g"), (None, None, None, "{", "g"), ("4", "2024-01-01", "1", None, "g"),
]


def judged(spark, s):
    return rules.evaluate(rules.prepare(raw(spark, ROWS), s), s, order=[F.col("raw_at")])


def test_first_failing_rule(spark):
    got = {r["rule"]: r["rows"] for r in rules.failures(judged(spark, spec(rules=RULES))).collect()}
    assert got == {None: 2, "duplicate_key": 1, "positive": 2, "key_present": 1, "timestamp_plausible": 1, "record_parses": 1}


def test_a_failed_row_takes_no_good_rows_place(spark):
    rows = [("1", "2024-01-01 00:00:00", "-5", None, "f"), ("1", "2024-01-01 00:00:09", "5", None, "f")]
    s = spec(rules=RULES)
    out = rules.evaluate(rules.prepare(raw(spark, rows), s), s, order=[F.col("raw_at")])
    assert sorted(str(r["rule"]) for r in out.collect()) == ["None", "positive"]


def test_null_condition_fails_and_null_keys_are_equal(spark):
    s = spec(rules=(rules.Rule("said", "v > 0"), rules.Rule(rules.DUPLICATE, None)))
    rows = [("x", "2024-01-01", None, None, "f"), ("x", "2024-01-01", "1", None, "f"), ("y", "2024-01-01", "1", None, "f")]
    got = sorted(str(r["rule"]) for r in rules.evaluate(rules.prepare(raw(spark, rows), s), s).collect())
    assert got == ["None", "duplicate_key", "said"]


def test_halts_stop_and_are_sampled(spark):
    s = spec(rules=RULES, knowable_at="CASE WHEN id = 4 THEN at - INTERVAL 1 SECOND ELSE at END")
    j = judged(spark, s)
    assert [(r["rule"], r["rows"], len(r["sample"])) for r in rules.halt_violations(j, s).collect()] == [("knowable_at_not_before_event", 1, 1)]
    with pytest.raises(rules.Halted):
        rules.check_halts(j, s)
    rules.check_halts(judged(spark, spec(rules=RULES)), spec(rules=RULES))


@pytest.mark.parametrize("fault, rule", [("missing", "knowable_at_present"), ("early", "knowable_at_not_before_event")])
def test_drill_hits_one_row_per_file(spark, fault, rule):
    s = spec(rules=RULES)
    hit = rules.drill(rules.prepare(raw(spark, ROWS), s), s, ["_source_file"], [F.col("raw_at")], fault)
    got = rules.evaluate(hit, s, order=[F.col("raw_at")]).where(F.col("rule") == rule).groupBy("_source_file").count().collect()
    assert sorted((r[0], r[1]) for r in got) == [("f", 1), ("g", 1)]


def test_unregistered_sources(spark):
    df = raw(spark, ROWS).withColumn("_source", F.lit("s")).withColumn("_dataset", F.col("_source_file"))
    flagged = rules.with_registry(df, spark.createDataFrame([("s", "f"), ("s", "f")], "_source string, _dataset string"), ["_source", "_dataset"])
    assert {(r["_source_file"], r["_registered"]) for r in flagged.collect()} == {("f", True), ("g", False)} and flagged.count() == len(ROWS)


def test_quarantine_and_log(spark):
    s = spec(rules=RULES)
    j = judged(spark, s)
    q = rules.quarantined(j, s, ["raw_id", "raw_v"], ["_source_file"])
    assert q.count() == 6 and q.where("rule = 'positive' and record like '%-6%'").count() == 1
    log = {r["_source_file"]: (r["rows_read"], r["rows_accepted"], r["rejected_by_rule"]) for r in rules.load_log(j, ["_source_file"]).collect()}
    assert log["g"] == (3, 1, {"positive": 1, "record_parses": 1})


@pytest.mark.parametrize("change", [{"table": "a b"}, {"key": ("nope",)}, {"rules": (rules.Rule("r", "true"), rules.Rule("r", "true"))}, {"derived": {"id": ("int", "1")}}, {"rules": (rules.Rule("r", "true", "warn"),)}])
def test_specs_are_checked(change):
    with pytest.raises(ValueError):
        spec(**change)


def test_gaps(spark):
    ids = spark.createDataFrame([("s", i) for i in (100, 101, 103, 107)], "k string, i long")
    assert sorted((r["gap_start"], r["gap_end"], r["missing"]) for r in rules.sequence_gaps(ids, ["k"], "i").collect()) == [(102, 102, 1), (104, 106, 3)]
    secs = spark.createDataFrame([("s", i) for i in (0, 60, 180)], "k string, i long")
    got = rules.sequence_gaps(secs, ["k"], "i", 60, F.lit(0), F.lit(86340))
    assert sorted((r["gap_start"], r["gap_end"], r["missing"]) for r in got.collect()) == [(120, 120, 1), (240, 86340, 1436)]
    assert rules.sequence_gaps(secs.where("false"), ["k"], "i", 60, F.lit(0), F.lit(86340)).count() == 0


def test_gate(spark):
    day = date(2024, 1, 1)
    m = spark.createDataFrame([("c", "a", day, 100, 3), ("c", "a", day, 100, 4), ("c", "b", day, 100, 9), ("c", "w", day, 100, 50), ("d", "a", day, 10, 1)], "check string, subject string, day date, measured long, failed long")
    t = spark.createDataFrame([("c", "*", 0.01, 2.0), ("c", "b", 0.1, 0.0)], "check string, subject string, rate double, tolerance double")
    w = spark.createDataFrame([("c", "w", day), ("c", "b", day)], "check string, subject string, day date")
    got = sorted((r["check"], r["subject"], r["failed"], r["outcome"]) for r in gate.judge(m, t, w).collect())
    assert got == [("c", "a", 3, "passed"), ("c", "a", 4, "failed"), ("c", "b", 9, "passed"), ("c", "w", 50, "waived"), ("d", "a", 1, "failed")]


def test_quality_query_catches_every_rule(spark, sf):
    rows = {r["rule"] for r in quality.rules_first_failure_counts(spark, sf).collect()}
    assert {"accepted", "record_parses", "key_present", "price_and_quantity_positive", "duplicate_key"} <= rows


def test_dependency_groups():
    assert ops.groups_by_dependency({"a": ["b"], "c": [], "d": ["b"], "e": ["c"]}) == [["a", "b", "d"], ["c", "e"]]


def test_drift_judges_full_windows_only(spark):
    from datetime import datetime

    def prof(week, rows, median, items, distinct=None):
        at = datetime(2024, 1, 1 + 7 * week)
        return [(at, ":table", rows, None, None, None), (at, "v", rows, 5, median, None), (at, "k", rows, distinct or len(items), None, items)]

    schema = "window_start timestamp, column_name string, rows long, distinct long, median double, items array<string>"
    rows = prof(0, 100, 1.0, ["a"]) + prof(1, 100, 3.0, ["a", "b"]) + prof(2, 5, 99.0, ["z"])
    got = {r["column_name"]: r for r in ops.drift(spark.createDataFrame(rows, schema), ["v"], [], ["k"]).collect()}
    assert got["v"]["factor"] == 3.0 and got["v"]["drifted"] and got["k"]["appeared"] == ["b"] and got["k"]["disappeared"] == []
    cut = prof(0, 100, 0.0, ["a"]) + prof(1, 100, 0.0, ["a"], distinct=7)
    got = {r["column_name"]: r for r in ops.drift(spark.createDataFrame(cut, schema), ["v"], [], ["k"]).collect()}
    assert got["v"]["factor"] == 1.0 and "k" not in got


def test_rules_of_the_domain(spark):
    hour = datetime(2024, 3, 5, 12, tzinfo=UTC)
    rows = [(1.0, 2.0, 1.0, 2.0, "1.5", date(2024, 1, 1), date(2024, 2, 1), 20_000, hour, date(2024, 3, 5)), (1.0, 2.0, 1.5, 2.0, ".", None, date(2024, 2, 1), 9_999, hour.replace(hour=8), date(2024, 3, 5)),
            (0.0, 2.0, 0.0, 1.0, None, date(2024, 3, 1), date(2024, 2, 1), None, hour, date(2024, 3, 4)), (1.0, 1.0, 1.0, 1.0, "1e3", None, None, 10_000, hour, date(2024, 3, 30))]
    df = spark.createDataFrame(rows, "open double, close double, low double, high double, value string, period_start date, period_end date, html_chars int, acceptance_time timestamp, filing_date date")
    told = {r["rule"]: r["rows"] for r in rules.broken(df, [rules.positive("open"), rules.BAR_CONSISTENT, rules.reported(), rules.numeric(), rules.PERIOD_ORDERED, rules.document_has_text(), rules.accepted_in_hours()]).collect()}
    assert told == {"price_and_quantity_positive": 1, "ohlc_consistent": 2, "value_reported": 1, "value_numeric": 2, "period_ordered": 1, "document_has_text": 2, "timestamp_plausible": 3}


def test_differences_within_a_tolerance(spark):
    rows = lambda *x: spark.createDataFrame(list(x), "k string, value double")
    a = rows(("a", 1.0), ("a", 2.0), ("b", None), ("c", 5.0), (None, 1.0))
    assert leakage.differences_within(a, rows(("a", 2.0 + 1e-12), ("a", 1.0), ("b", None), ("c", 5.0), (None, 1.0))).count() == 0
    got = leakage.differences_within(a, rows(("a", 1.0), ("b", 0.0), ("c", 5.1), (None, 1.0), ("d", 1.0))).collect()
    assert sorted((r["k"], r["problem"]) for r in got) == [("a", "only left"), ("b", "value"), ("c", "value"), ("d", "only right")]


def test_fixed_thresholds(spark):
    day = date(2024, 1, 1)
    measured = spark.createDataFrame(
        [("rejection_rate", "t.bad", day, 1000, 12), ("rejection_rate", "u.bad", day, 1000, 13), ("rejection_rate", "edgar_filings.duplicate_key", day, 10, 10), ("venue_divergence", "x", day, 1440, 4), ("venue_divergence", "y", day, 1440, 5), ("venue_missing", "x", day, 1440, 15), ("other", "x", day, 9, 1)],
        "check string, subject string, day date, measured long, failed long",
    )
    told = {(r["check"], r["subject"]): r["passed"] for r in gate.judge(measured, gate.thresholds(spark)).collect()}
    assert [k for k, ok in told.items() if not ok] and {k for k, ok in told.items() if ok} == {("rejection_rate", "t.bad"), ("rejection_rate", "edgar_filings.duplicate_key"), ("venue_divergence", "x")}
    assert gate.judge(measured, gate.thresholds(spark, [("venue_missing", "*", 0.5, 0.0)])).where("check = 'venue_missing'").first()["passed"]
