from __future__ import annotations

import math
from datetime import UTC, date, datetime, timedelta
from decimal import Decimal

import pytest

from tidemark.operators import bars, features

T0 = datetime(2024, 1, 2, tzinfo=UTC)
TRADES = "symbol string, trade_id long, price decimal(28,10), quantity decimal(28,10), event_time timestamp, knowable_at timestamp"


def trades(spark):
    rows = [(2, 101, 2, 50), (1, 100, 1, 10), (3, 99, 1, 60), (4, 102, 1, 60)]
    return spark.createDataFrame([("S", i, Decimal(p), Decimal(q), T0 + timedelta(seconds=s), T0 + timedelta(seconds=s)) for i, p, q, s in rows], TRADES)


def test_minute_bars(spark):
    a, b = bars.minute_bars(trades(spark)).orderBy("bar_time").collect()
    assert [int(a[c]) for c in ("open", "high", "low", "close", "volume", "trades")] == [100, 101, 100, 101, 3, 2]
    assert a["vwap"] == pytest.approx(302 / 3)
    assert a["knowable_at"].replace(tzinfo=UTC) == T0 + timedelta(minutes=1)
    assert (int(b["open"]), int(b["close"])) == (99, 102)  # one instant: by id
    assert b["knowable_at"].replace(tzinfo=UTC) == T0 + timedelta(minutes=2)


def test_daily_bars_weigh_only_minutes_with_a_mean(spark):
    d = bars.daily_bars(bars.minute_bars(trades(spark))).first()
    assert [int(d[c]) for c in ("open", "high", "low", "close", "volume", "trades", "minutes")] == [100, 102, 99, 102, 5, 4, 2]
    assert d["vwap"] == pytest.approx(503 / 5)
    m = bars.minute_bars(trades(spark))
    from pyspark.sql import functions as F

    none = m.withColumn("vwap", F.when(F.col("trades") == 2, F.col("vwap")))
    assert bars.daily_bars(none.where("open = 100").unionByName(none.where("open = 99").withColumn("vwap", F.lit(None).cast("double")))).first()["vwap"] == pytest.approx(302 / 3)


def test_two_venues(spark):
    def side(rows):
        return spark.createDataFrame([("S", T0 + timedelta(minutes=m), float(c)) for m, c in rows], "symbol string, bar_time timestamp, close double")

    compared = bars.compare_venues(side([(0, 100), (1, 100), (2, 5), (720, 7)]), side([(0, 100), (1, 102), (3, 5), (720, 7)]))
    assert compared.count() == 1440
    got = {r["minute"].hour * 60 + r["minute"].minute: r["status"] for r in compared.where("status <> 'missing_both'").collect()}
    assert got == {0: "agree", 1: "price_divergence", 2: "missing_right", 3: "missing_left", 720: "agree"}
    day = bars.daily_status(compared).first()
    assert [day[s] for s in bars.STATUSES] == [2, 1, 1, 1, 1435]


def daily(spark, n, late=None):
    rows = [("S", date(2024, 1, 1) + timedelta(days=i), Decimal(100 + i % 3), Decimal(10 + i), T0 + timedelta(days=i + (9 if i == late else 0))) for i in range(n)]
    return spark.createDataFrame(rows, "symbol string, session_date date, close decimal(28,10), volume decimal(38,10), knowable_at timestamp")


def test_window_features_need_window_returns(spark):
    f = features.price_features(daily(spark, 22))
    vol = f.where("feature = 'volatility_20d'").orderBy("event_time").collect()
    assert [r["source_ref"] for r in vol] == ["S/2024-01-21", "S/2024-01-22"]
    closes = [100 + i % 3 for i in range(21)]
    rets = [math.log(b / a) for a, b in zip(closes, closes[1:], strict=False)]
    mean = sum(rets) / 20
    assert vol[0]["value"] == pytest.approx(math.sqrt(sum((r - mean) ** 2 for r in rets) / 19))
    assert f.where("feature = 'close'").count() == 22


def test_features_are_knowable_with_all_their_bars(spark):
    f = features.price_features(daily(spark, 40, late=5)).where("feature = 'volatility_20d'").orderBy("event_time").collect()
    late = T0 + timedelta(days=14)
    for r in f:
        i = (r["event_time"].date() - date(2024, 1, 1)).days
        assert r["knowable_at"].replace(tzinfo=UTC) == (max(late, T0 + timedelta(days=i)) if i - 20 <= 5 else T0 + timedelta(days=i))


def test_year_over_year(spark):
    rows = [("c", date(2023, 1, 1), date(2024, 2, 1), 100.0), ("c", date(2024, 1, 1), date(2024, 2, 1), 103.0), ("c", date(2024, 1, 1), date(2024, 3, 1), 104.0), ("z", date(2023, 1, 1), date(2024, 2, 1), 0.0), ("z", date(2024, 1, 1), date(2024, 2, 1), 5.0)]
    df = spark.createDataFrame([(*r, T0) for r in rows], "series_id string, observation_date date, vintage_date date, value double, knowable_at timestamp")
    got = {(r["series_id"], str(r["vintage_date"])): r["yoy"] for r in features.year_over_year(df).collect()}
    assert got[("c", "2024-02-01")] == pytest.approx(0.03)
    assert got[("z", "2024-02-01")] is None
    assert len(got) == 2


def test_pick_concept_takes_the_first_by_priority(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("a", 2, 5.0), ("a", 1, 7.0), ("a", 1, 6.0), ("b", 3, 1.0)], "k string, priority int, v double")
    assert sorted((r["k"], r["v"]) for r in features.pick_concept(df, ["k"], [F.col("priority")]).collect()) == [("a", 6.0), ("b", 1.0)]
