from __future__ import annotations

from datetime import UTC, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import adapter
from tidemark.operators import answering

AT = datetime(2024, 1, 2, 6, tzinfo=UTC)


def setup(spark):
    q = spark.createDataFrame([(1, "How much?", AT), (2, "And this?", AT), (3, "Nothing?", AT)], "query_id long, text string, as_of timestamp")
    r = spark.createDataFrame([(1, 1, 10), (1, 2, 11), (2, 1, 11), (1, 9, 12)], "query_id long, rank int, doc_id long")
    p = spark.createDataFrame([(10, "c10", "it was 2,500"), (11, "c11", "no figure"), (12, "c12", "far")], "doc_id long, context string, text string")
    return answering.prompts(q, r, p)


def test_prompts_number_their_excerpts(spark):
    got = {r["query_id"]: r for r in setup(spark).collect()}
    assert got[1]["excerpts"] == [10, 11] and "[1] c10\nit was 2,500\n\n[2] c11" in got[1]["prompt"] and got[1]["prompt"].startswith("Known on 2024-01-02 06:00 (UTC)")
    assert got[3]["excerpts"] == [] and "(none)" in got[3]["prompt"]


def test_answers_are_scored(spark):
    asked = setup(spark)

    def model(texts):
        return ["It was 2,500 [1][9]." if "2,500" in t else "Nothing here answers this." for t in texts]

    truth = spark.createDataFrame([(1, ["2,500"], [10]), (2, ["7"], [99]), (3, ["12,500"], [99])], "query_id long, answers array<string>, relevant array<long>")
    j = answering.judged(answering.ask(asked, model), asked, truth)
    assert {r["query_id"]: tuple(r)[1:] for r in j.collect()} == {1: (True, True, True, False), 2: (False, False, False, True), 3: (False, False, False, True)}
    s = answering.scores(j).first()
    assert (s["questions"], s["correct"], s["abstained_when_unanswerable"], s["abstained_when_answerable"]) == (3, 1.0, 1.0, 0.0)
    assert s["accuracy"] == pytest.approx(1 / 3)


def test_training_groups(spark):
    c = spark.createDataFrame([(1, i, i < 2) for i in range(20)] + [(2, 1, True)] + [(3, 1, False)], "query_id long, doc_id long, relevant boolean")
    rows = answering.training_groups(c, 8).collect()
    assert {r["query_id"] for r in rows} == {1} and len(rows) == 8 and sum(r["relevant"] for r in rows) == 1
    share = spark.range(2000).agg(F.avg(answering.withheld_variant(F.col("id")).cast("double"))).first()[0]
    assert 0.07 < share < 0.13


def test_adapter_learns_and_respects_masks():
    rng = np.random.default_rng(0)
    docs = rng.normal(size=(80, 16))
    docs /= np.linalg.norm(docs, axis=1, keepdims=True)
    turn, _ = np.linalg.qr(rng.normal(size=(16, 16)))
    target = rng.integers(0, 80, 300)
    q = docs[target] @ (0.6 * np.eye(16) + 0.6 * turn) + rng.normal(0, 0.05, (300, 16))
    relevant = np.zeros((300, 80), bool)
    relevant[np.arange(300), target] = True
    ask = lambda s: adapter.Questions(q[s], relevant[s])
    options = adapter.Options(rate=0.01, rank=12, temperature=0.2)
    best, scores = adapter.fit(docs, ask(slice(0, 200)), ask(slice(200, 250)), options)
    held = ask(slice(250, 300))
    assert adapter.reciprocal_rank(docs, held, best) > adapter.reciprocal_rank(docs, held) and max(scores) > scores[0]
    again, _ = adapter.fit(docs, ask(slice(0, 200)), ask(slice(200, 250)), options)
    assert np.array_equal(best.a, again.a)
    hidden = adapter.Questions(q[:5], relevant[:5], ~relevant[:5])
    assert adapter.reciprocal_rank(docs, hidden) == 0.0
    with pytest.raises(ValueError):
        adapter.fit(docs, hidden, held)
