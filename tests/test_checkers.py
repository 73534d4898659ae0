"""Second computations, in plain Python and by other ways than the operators', of rankings' metrics and of worlds without some bars."""

from __future__ import annotations

import math
import random
import statistics
from datetime import UTC, date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import features, lineage, retrieval

T0 = datetime(2024, 1, 2, tzinfo=UTC)


@pytest.mark.parametrize("seed", range(2))
def test_ranking_metrics_again(spark, seed):
    rng = random.Random(seed)
    ranks = {q: rng.sample(range(40), 15) for q in range(12)}
    relevant = {q: set(rng.sample(range(40), rng.randrange(0, 4))) for q in ranks}
    known = {d: T0 + timedelta(hours=d) for d in range(40)}
    asked = {q: T0 + timedelta(hours=rng.randrange(40)) for q in ranks}
    got = retrieval.ranking_metrics(
        spark.createDataFrame([(q, i + 1, d) for q, r in ranks.items() for i, d in enumerate(r)], "query_id long, rank int, doc_id long"),
        spark.createDataFrame([(q, d) for q, r in relevant.items() for d in r], "query_id long, doc_id long"),
        spark.createDataFrame(list(asked.items()), "query_id long, as_of timestamp"), known=spark.createDataFrame(list(known.items()), "doc_id long, knowable_at timestamp"),
    ).first()
    first = [next((i for i, d in enumerate(r, 1) if d in relevant[q]), math.inf) for q, r in ranks.items()]
    for cut in (1, 5, 10):
        assert got[f"hit_{cut}"] == pytest.approx(sum(f <= cut for f in first) / len(first))
    assert got["mrr"] == pytest.approx(sum(1 / f for f in first if f <= 10) / len(first)) and got["queries"] == 12
    assert got["future"] == sum(known[d] > asked[q] for q, r in ranks.items() for d in r)


def plain_features(bars):
    """{(feature, day): (value, known)} of one symbol's bars (day, close, volume, known)."""
    out = {}
    for i, (day, close, _, _) in enumerate(bars):
        window = bars[max(0, i - 20) : i + 1]
        latest = max(b[3] for b in window)  # all features of a day become known together
        out["close", day] = (float(close), latest)
        if i >= 20:
            returns = [math.log(float(b[1]) / float(a[1])) for a, b in zip(window, window[1:], strict=False)]
            out["volatility_20d", day] = (statistics.stdev(returns), latest)
            out["volume_mean_20d", day] = (statistics.fmean(float(b[2]) for b in window[1:]), latest)
    return out


@pytest.mark.parametrize("gone", [(9,), (3, 4, 30), (0, 21, 39), ()])
def test_worlds_again(spark, gone):
    rng = random.Random(1)
    bars = [(date(2024, 1, 1) + timedelta(days=i), Decimal(100 + rng.randrange(30)), Decimal(10 + rng.randrange(9)), T0 + timedelta(days=i, hours=rng.randrange(60))) for i in range(45)]
    daily = spark.createDataFrame([("S", *b) for b in bars], "symbol string, session_date date, close decimal(28,10), volume decimal(38,10), knowable_at timestamp")
    ids = [f"bar:S/{bars[i][0]}" for i in gone]
    withheld = spark.createDataFrame([("w", i) for i in ids], "world string, item_id string")
    full = features.price_features(daily)
    world = lineage.patch(full, lineage.affected(lineage.price_edges(daily), withheld), lineage.recompute(daily, withheld), "w")
    got = {(r["feature"], r["source_ref"]): (r["value"], r["us"]) for r in world.select("feature", "source_ref", "value", F.unix_micros("knowable_at").alias("us")).collect()}
    want = plain_features([b for i, b in enumerate(bars) if i not in gone])
    assert {(f, day.removeprefix("S/")) for f, day in got} == {(f, str(day)) for f, day in want}
    for (feature, day), (value, known) in want.items():
        assert got[feature, f"S/{day}"] == (pytest.approx(value), int(known.timestamp()) * 10**6)
    known = lineage.items(daily, "bar", ["symbol", "session_date"], ["close"])
    recorded = lineage.set_hash(known).first()["set_hash"]
    verdict = lineage.coherence(world, lineage.rebuild(daily, ids), known, ids, recorded).first()
    assert verdict["coherent"] and not (ids and lineage.coherence(lineage.hide(full, ids), lineage.rebuild(daily, ids), known, ids, recorded).first()["coherent"])
    assert ids or not lineage.coherence(world, full, known, [], "another").first()["coherent"]
