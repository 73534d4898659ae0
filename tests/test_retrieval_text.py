from __future__ import annotations

import math
from datetime import UTC, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import html
from tidemark.operators import retrieval, text

T0 = datetime(2024, 1, 2, tzinfo=UTC)


def h(n):
    return T0 + timedelta(hours=n)


def corpus(spark, rows):
    return spark.createDataFrame([(i, t, h(k)) for i, t, k in rows], "doc_id long, text string, knowable_at timestamp")


def queries(spark, rows):
    return spark.createDataFrame([(i, t, h(k)) for i, t, k in rows], "query_id long, text string, as_of timestamp")


def test_bm25_formula_and_zero_scores(spark):
    docs = corpus(spark, [(1, "apple apple pear", 0), (2, "pear plum", 0), (3, "fig", 0)])
    got = {r["doc_id"]: (r["rank"], r["score"]) for r in retrieval.bm25(docs, queries(spark, [(9, "Apple apple!", 1)]), 3).collect()}
    idf = math.log(1 + (3 - 1 + 0.5) / 1.5)
    assert got[1] == (1, pytest.approx(idf * 2 * 2.2 / (2 + 1.2 * (0.25 + 0.75 * 3 / 2)), abs=1e-8))
    assert got[2] == (2, 0.0) and got[3] == (3, 0.0)


def test_bm25_ignores_what_is_not_known_yet(spark):
    rows = [(1, "apple pear", 0), (2, "apple", 1), (3, "apple apple", 9)]
    q = queries(spark, [(1, "apple", 5)])
    a = retrieval.bm25(corpus(spark, rows), q, 5).collect()
    b = retrieval.bm25(corpus(spark, rows[:2]), q, 5).collect()
    assert sorted(a) == sorted(b) and len(a) == 2


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, h(k), s) for i, v, k, s in rows], "id string, vector array<float>, knowable_at timestamp, symbol string")


def test_neighbours_mask_before_ranking(spark):
    docs = vectors(spark, [("a", [1.0, 0.0], 0, "S"), ("b", [1.0, 0.1], 9, "S"), ("c", [0.0, 1.0], 0, "T"), ("d", [2.0, 0.0], 0, "S"), ("z", [0.0, 0.0], 0, "S")])
    q = spark.createDataFrame([("q", [1.0, 0.0], h(1), "S")], "query_id string, vector array<float>, as_of timestamp, symbol string")
    assert [r["id"] for r in retrieval.nearest(docs, q, 2).orderBy("rank").collect()] == ["a", "d"]  # a tie goes by id
    assert {r["id"] for r in retrieval.nearest(docs, q, 9, by_symbol=True).collect()} == {"a", "d"}
    assert retrieval.nearest(docs, q, 9, masked=False).count() == 4
    assert retrieval.nearest(docs.where("false"), q, 9).count() == 0 and retrieval.nearest(docs, q.where("false"), 9).count() == 0


def test_index_recall(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(10, 16))
    rows = [(int(i), [float(x) for x in centres[i % 10] + rng.normal(0, 0.15, 16)], T0) for i in range(600)]
    docs = spark.createDataFrame(rows, "id long, vector array<float>, knowable_at timestamp")
    q = docs.where("id < 40").select(F.col("id").alias("query_id"), "vector")
    exact = retrieval.nearest(docs, q, 10, masked=False)
    index, middle = retrieval.indexed(docs, 12)
    found = retrieval.approximate(index, middle, q, 10, 3, masked=False)
    assert retrieval.recall_at(exact, found, 10).agg(F.avg("recall")).first()[0] >= 0.9
    assert found.agg(F.max("candidates")).first()[0] < 300
    asked = q.withColumn("as_of", F.lit(T0) - F.expr("INTERVAL 1 SECOND"))
    assert retrieval.approximate(index, middle, asked, 10, 3).count() == 0
    assert retrieval.approximate(index, middle, q.where("false"), 10, 3, masked=False).count() == 0


def test_embedders_are_checked(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, None), (3, "b")], "doc_id long, text string")
    got = {r["doc_id"]: r["vector"] for r in retrieval.embed(docs, dim=16).collect()}
    assert got[2] is None and sum(x * x for x in got[1]) == pytest.approx(1) and got[3] != got[1]
    for bad in (lambda texts, _: np.zeros((len(texts), 3)), lambda texts, dim: np.full((len(texts), dim), np.nan)):
        with pytest.raises(Exception, match="embedder"):
            retrieval.embed(docs, bad, 16).collect()


def test_fusion_and_metrics(spark):
    r = lambda rows: spark.createDataFrame([(1, i + 1, d) for i, d in enumerate(rows)], "query_id long, rank int, doc_id long")
    assert [x["doc_id"] for x in retrieval.fuse([r([1, 2, 3]), r([2, 4])], 3).orderBy("rank").collect()] == [2, 1, 4]
    assert [x["doc_id"] for x in retrieval.fuse([r([1, 2]), r([2, 1])], 2).orderBy("rank").collect()] == [1, 2]
    qs = spark.createDataFrame([(1,), (2,)], "query_id long")
    m = retrieval.ranking_metrics(r([5, 6, 7]), spark.createDataFrame([(1, 6)], "query_id long, doc_id long"), qs).first()
    assert (m["queries"], m["hit_1"], m["hit_5"], m["mrr"]) == (2, 0.0, 0.5, 0.25)


def test_answers(spark):
    rows = [("1234.5", "USD/shares", ["1234.50"]), ("2500000", "USD", ["2,500"]), ("3000000", "USD", ["3", "3,000"]), ("1500", "USD", []), ("1500", "shares", ["1,500"]), ("-5000000", "shares", ["5,000,000", "5", "5,000"])]
    df = spark.createDataFrame([(v, u) for v, u, _ in rows], "v string, u string").withColumn("a", retrieval.answers(F.col("v").cast("decimal(38,6)"), F.col("u")))
    assert [r["a"] for r in df.collect()] == [a for _, _, a in rows]


def test_labels_match_whole_numbers(spark):
    facts = spark.createDataFrame([("k", 1, "2500000"), ("k", 2, "7"), ("none", 3, "2500000"), ("k", 4, "9000")], "key string, fact_id long, v string").select("key", "fact_id", F.col("v").cast("decimal(38,6)").alias("value"), F.when(F.col("fact_id") == 4, "shares").otherwise("USD").alias("unit"))
    passages = spark.createDataFrame([("k", "c1", "it was 2,500 in all."), ("k", "c2", "it was 12,500"), ("k", "c3", "2,500.5 or 2,500,000"), ("k", "c4", "(2,500)")], "key string, chunk_id string, text string")
    got = {r["fact_id"]: (r["relevant"], r["dropped"]) for r in retrieval.labelled(facts, passages, ["key"]).collect()}
    assert got == {1: (["c1", "c4"], None), 2: ([], "no_answer_string"), 3: ([], "no_document"), 4: ([], "value_not_in_text")}


PAGE = """<html><head><title>x</title></head><body><ix:header>hidden</ix:header><div>First <b>line</b>&nbsp;here</div><p>Second<br/>third​</p>
<script>no()</script><table><tr><td>Sales</td><td>$</td><td>1,200</td><td>)</td></tr><tr><th>a</th><td><p>b</p><p>c</p></td><td>5</td><td>%</td></tr><tr><td> </td></tr></table>tail</body></html>"""


def test_html_lines():
    assert html.html_lines(PAGE) == ["First line here", "Second", "third", "Sales | 1,200)", "a | b c | 5%", "tail"]
    assert html.html_lines(None) == [] and html.html_lines("plain") == ["plain"]


def test_headings_and_splitting():
    assert html.is_heading("Item 1A. Risk Factors") and html.is_heading("PART II") and not html.is_heading("Item 1A. | 5") and not html.is_heading("Items are many")
    assert html.split_line("aaaa bbbb cccc", 10) == ["aaaa bbbb", "cccc"]
    assert html.split_line("aaaaaa. bbbb cccc", 10) == ["aaaaaa.", "bbbb cccc"]
    assert html.split_line("a" * 25, 10) == ["a" * 10, "a" * 10, "a" * 5]


def test_chunks_overlap_by_whole_lines():
    lines = ["Item 1. One", *["x" * 30] * 5, "Item 2. Two", "y" * 30]
    found = html.chunk(lines, 80, 40)
    assert all(len(t) <= 80 for _, _, t in found) and [i for i, _, _ in found] == list(range(len(found)))
    assert found[0][2].split("\n")[-1] == found[1][2].split("\n")[0]
    assert found[0][1] == "Item 1. One" and found[-1][2].endswith("y" * 30)
    with pytest.raises(ValueError):
        html.chunk(lines, 10, 10)
    assert html.chunk([], 10, 2) == []


def test_chunks_in_spark_equal_the_function(spark, sf):
    docs = spark.read.parquet(f"{sf}/pages.parquet")
    got = sorted((r["page_id"], r["chunk_index"], r["text"]) for r in text.to_chunks(docs, "page_id", "html", html=True, size=500, overlap=80).collect())
    want = sorted((r["page_id"], i, t) for r in docs.collect() for i, _, t in html.chunk(html.html_lines(r["html"]), 500, 80))
    assert got == want
