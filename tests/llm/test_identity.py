"""Rows are the same rows in every pass; joins, groups and buckets of any size; clashing columns; defined cases of the stages."""

from __future__ import annotations

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_text_operators import ROWS, plain_near
from tidemark.llm import common, exactdedup, mixing, probminhash, quality

SPLITS = "spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes"


@pytest.fixture()
def unsteady(spark, monkeypatch):
    """Changes how files are split after every table that is written, as a lost or new executor might."""
    state = {"n": 0}

    def turn():
        state["n"] += 1
        spark.conf.set(SPLITS[0], str((2, 9, 5)[state["n"] % 3]))
        spark.conf.set(SPLITS[1], "1000")

    def durable(df, name="t"):
        out = common.durable(df, name)
        turn()
        return out

    class Numbered(common.Numbered):
        def __init__(self, df):
            super().__init__(df)
            turn()

    for module in (exactdedup, probminhash, quality, mixing):
        for name, made in (("durable", durable), ("Numbered", Numbered)):
            if hasattr(module, name):
                monkeypatch.setattr(module, name, made)
    turn()
    yield state
    for key in SPLITS:
        spark.conf.unset(key)


def test_splits_may_change_between_reads(spark, unsteady):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    assert docs.rdd.getNumPartitions() > 4
    told = exactdedup.dedup(docs).collect()
    assert len(told) == 1000 and sum(r["kept"] for r in told) == len({r["text_sha256"] for r in told}) == docs.select(F.countDistinct(common.without_blanks(F.col("text")))).first()[0]
    clean = exactdedup.without_copies(docs)
    assert clean.select(F.count("*"), F.countDistinct(common.without_blanks(F.col("text")))).first()[:] == (len({r["text_sha256"] for r in told}),) * 2
    near = probminhash.near_duplicates(docs).collect()
    groups = collections.Counter(r["group_id"] for r in near)
    assert len(near) == 1000 and sum(r["kept"] for r in near) == len(groups) and all(groups[r["group_id"]] == r["group_size"] for r in near)
    one = probminhash.one_of_each(docs)
    assert one.count() == len(groups) and {r["doc_id"] for r in one.select("doc_id").collect()} <= set(groups)
    sized = mixing.sizes_of(docs)
    copies = {r["doc_id"]: r["copies"] for r in mixing.with_copies(sized, mixing.plan(sized)).collect()}
    assert collections.Counter(r["doc_id"] for r in mixing.mix(docs).select("doc_id").collect()) == collections.Counter({i: n for i, n in copies.items() if n})
    good = quality.select(docs, spark.read.parquet(f"{d}/labels.parquet"))
    assert good.count() == good.select("doc_id").distinct().count() > 500
    assert unsteady["n"] > 20


def test_columns_keep_their_values(docs):
    """Columns named like the operators' own."""
    there = collections.Counter(docs.collect())
    odd = docs.withColumn("copies", F.lit(-5)).withColumn("hot", F.lit("h")).withColumn("chosen", F.lit(7)).withColumn("sha", F.lit("s")).withColumn("chars", F.lit(1)).withColumn("bits", F.lit("b"))
    for clean in (exactdedup.without_copies, probminhash.one_of_each):
        assert not collections.Counter(clean(docs).collect()) - there
    for clean in (exactdedup.without_copies, probminhash.one_of_each, mixing.mix):
        out = clean(odd)
        assert out.columns == odd.columns and set(out.select("copies", "hot", "chosen", "sha", "chars", "bits").distinct().collect()) == {(-5, "h", 7, "s", 1, "b")}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_groups_of_any_size_are_joined(spark, how):
    rows = spark.range(1000).select(F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 37).alias("k"), "id", F.lit("x").alias("hot"))
    groups = rows.where("k <> 5").groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") * 2)
    got = common.join_groups(rows, groups, ["k"], "n", 1000, how, share=20)
    want = rows.join(groups, "k", how).select(got.columns)
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_many_sources(spark, docs, monkeypatch):
    """More sources than are broadcast."""
    few = sorted(map(str, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 1)
    assert sorted(map(str, mixing.mix(docs).collect())) == few


def test_bitmaps_choose_rows(spark):
    held = common.Numbered(spark.range(1000, numPartitions=7).withColumnRenamed("id", "row"))
    assert (held.row, held.part) == ("row_", "part")
    third = held.table.where("row % 3 = 0").select(F.col(held.row).alias("row"))
    assert held.chosen(common.bitmaps(third)).count() == 334
    left = held.without(third)
    assert left.columns == ["row"] and sorted(r["row"] for r in left.collect()) == [i for i in range(1000) if i % 3]
    assert held.without(third.limit(0)).count() == 1000
    plan = left._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    joined = plan[plan.index("ShuffledHashJoin") :].splitlines()[1]
    assert "FileScan" in joined and "Bucketed: true" in joined  # the table isn't shuffled, only numbers and bitmaps are


def test_scratch_tables_go(spark):
    before = set(common._WRITTEN)
    with common.tidy(spark) as keep:
        common.durable(spark.range(5))
        common.Numbered(spark.range(5))
        out = keep(spark.range(7))
    assert len(set(common._WRITTEN) - before) == 1 and out.count() == 7
    common.forget(out)
    assert set(common._WRITTEN) == before


def test_batches_are_bounded_by_bytes():
    import pyarrow as pa

    texts = ["x" * 10, None, "y" * (3 << 20), "z" * (2 << 20), "w" * (9 << 20), "", "v"] + ["u"] * 500
    parts = [b.column(0).to_pylist() for b in common.slices([pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])], 0)]
    assert sum(parts, []) == texts and all(len(p) <= common.BATCH_ROWS and (len(p) == 1 or sum(len(t or "") for t in p) <= common.BATCH_BYTES) for p in parts)


# -- crowded buckets of near-dedup


def with_header(rng, n, header, own):
    top = " ".join(f"h{x}" for x in rng.integers(0, 10**6, header))
    return [f"{top} " + " ".join(f"w{x}" for x in rng.integers(0, 10**6, own)) for _ in range(n)]


def test_crowded_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(probminhash, "CROWD", 3)
    monkeypatch.setattr(probminhash, "BLOCK", 4)
    rng = np.random.default_rng(3)
    texts = with_header(rng, 60, 70, 30)
    for k in range(0, 60, 4):  # near copies that repeat another passage, and some edits
        words = texts[k].split()
        texts.append(" ".join(words * 30 + words[:20]) if k % 8 else " ".join([*words[:95], "z"]))
    want = plain_near(texts)
    out = probminhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert len(set(want)) < len(texts) and [r["group_id"] for r in out.orderBy("doc_id").collect()] == want


def test_texts_that_share_a_header_are_not_met_in_pairs(spark, monkeypatch):
    rows = collections.Counter()

    def durable(df, name="t"):
        out = common.durable(df, name)
        rows[name] += out.count()
        return out

    monkeypatch.setattr(probminhash, "durable", durable)
    monkeypatch.setattr(probminhash, "CROWD", 64)
    monkeypatch.setattr(probminhash, "BLOCK", 16)
    n = 4000
    texts = with_header(np.random.default_rng(4), n, 50, 50)
    out = probminhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert out.where("kept").count() == n and rows["crowd"] > n / 10
    assert rows["apart"] < 30 * n and rows["pairs"] < n  # all pairs would be 2000 n


def test_rare_shingles_are_shared_by_all_similar_texts(spark):
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 200, 60)]
    texts = []
    for _ in range(60):
        words = list(base)
        for _ in range(int(rng.integers(0, 5))):
            words[rng.integers(0, 60)] = f"x{rng.integers(0, 99)}"
        texts.append(" ".join(words * int(rng.integers(1, 3)) + words[: int(rng.integers(0, 30))]))
    h, t, s = probminhash.shingles(texts)
    features = spark.createDataFrame([(i, bytearray(h[s[i] : s[i + 1]].tobytes()), bytearray(t[s[i] : s[i + 1]].astype("<u4").tobytes())) for i in range(60)], "node long, hashes binary, times binary")
    own = collections.defaultdict(set)
    for r in probminhash.rarest(features.select("node"), features, 0.8).collect():
        own[r["node"]].add(r["band"])
    linked = 0
    for i in range(60):
        for j in range(i):
            a, b = slice(s[i], s[i + 1]), slice(s[j], s[j + 1])
            if max(probminhash.similarity(h[a], t[a], h[b], t[b])) >= 0.8:
                linked += 1
                assert own[i] & own[j]
    assert linked > 50


# -- the classifier's fit


def ordinal(rng, n=200):
    words = [np.unique(rng.choice(40, 6)) for _ in range(n)]
    dense = rng.normal(0, 0.5, (n, 3))
    score = np.array([(w < 15).sum() - (w > 30).sum() for w in words]) + dense[:, 0]
    return words, dense, np.digitize(score, [0, 2])


def test_slopes_are_those_of_the_likelihood():
    rng = np.random.default_rng(0)
    words, dense, grades = ordinal(rng)
    names, *occurrences = quality.CumulativeLink.spread(words, 1)
    weights, thresholds, each = rng.normal(0, 0.3, len(names) + 3), np.array([-0.3, 0.9]), rng.uniform(0.5, 1, len(grades))

    def likelihood():
        upper, lower = quality.CumulativeLink.margins(weights, thresholds, occurrences, dense, grades)
        return (each * np.log(upper - lower)).sum()

    told = quality.CumulativeLink.slopes(weights, thresholds, occurrences, dense, grades, each)
    for k in range(len(told)):
        at, i = (weights, k) if k < len(weights) else (thresholds, k - len(weights))
        at[i] += 1e-6
        high = likelihood()
        at[i] -= 2e-6
        low = likelihood()
        at[i] += 1e-6
        assert told[k] == pytest.approx((high - low) / 2e-6, abs=1e-5)


def test_the_fit_is_as_good_as_a_plain_one():
    """Against plain gradient ascent on the same penalised likelihood, from the definition of the model, with small steps."""
    rng = np.random.default_rng(1)
    words, dense, grades = ordinal(rng, 300)
    extra = quality.SIZE - quality.WORDS
    wide = np.concatenate([dense, np.zeros((300, extra - 3))], axis=1)
    model = quality.CumulativeLink.fit(words, wide, grades, 2, steps=600, sparse=0.3)
    x = np.zeros((300, 43))
    for row, w in zip(x, words, strict=True):
        row[w] = 1
    x[:, 40:] = dense
    times = np.bincount(grades, minlength=3)
    each = (300 / times / 3)[grades] ** 0.5
    each /= each.sum()

    def value(w, t):
        edges = np.concatenate([[-60], t, [60]])
        p = [1 / (1 + np.exp(edges[grades + k] - x @ w)) for k in (0, 1)]
        return (each * np.log(np.maximum(p[0] - p[1], 1e-12))).sum() - 0.3 / 300 * np.abs(w).sum()

    w, t = np.zeros(43), np.array([-0.5, 0.5])
    for _ in range(3000):
        edges = np.concatenate([[-60], t, [60]])
        up, low = (1 / (1 + np.exp(edges[grades + k] - x @ w)) for k in (0, 1))
        a, b = each * up * (1 - up) / (up - low), each * low * (1 - low) / (up - low)
        w = w + 0.5 * x.T @ (a - b)
        w = np.sign(w) * np.maximum(0, np.abs(w) - 0.5 * 0.3 / 300)
        t = t + 0.5 * np.array([b[grades == j].sum() - a[grades == j + 1].sum() for j in range(2)])
    own = np.concatenate([model.weights[:40], model.weights[quality.WORDS : quality.WORDS + 3]])
    assert value(own, model.thresholds) > value(w, t) - 0.01


def test_the_fit_is_bounded_in_bytes(spark, docs):
    ratings = spark.createDataFrame([(i, i % 3) for i in range(13)], "doc_id long, grade int")
    assert quality.fit(docs, ratings, 2, sample_bytes=1) is None
    small = quality.fit(docs, ratings, 2, sample_bytes=5000)
    assert small is not None and quality.rate(docs, small, 2, ("doc_id",)).count() == len(ROWS)


# -- the stages


def test_stages_on_odd_documents(spark, docs, none):
    d = "/root/testdata/sf0.001"
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == docs.columns and out.count() <= 2 * len(ROWS)
        empty = stage(spark, none, d)
        assert empty.columns == docs.columns and empty.count() == 0
    packed = corpus_pipeline.STAGES[-1][1]
    assert packed(spark, none, d).count() == 0 and packed(spark, docs, d).select("row").distinct().count() == len(ROWS)
