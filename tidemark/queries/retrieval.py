"""Neighbours, BM25, fusion, metrics, text."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import answering, retrieval, text
from tidemark.queries import frames as fr


#: Lists of the index, and how many of them a query probes: these vectors have no clusters, so a recall of 0.9 takes half the lists.
LISTS, PROBES = 64, 36


def _vectors(spark, d):
    v = fr.table(spark, d, "embeddings")
    return v.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.timestamp_seconds(F.lit(1704067200) + F.col("vec_id") * 60).alias("knowable_at"), F.col("label").cast("string").alias("symbol"))


def _probes(spark, d):
    v = _vectors(spark, d).where("id % 100 = 0")
    return v.select(F.col("id").alias("query_id"), "vector", (F.col("knowable_at") + F.expr("INTERVAL 30 MINUTES")).alias("as_of"), "symbol")


def _rounded(df):
    return df.select("query_id", "rank", "id", F.round("distance", 6).alias("distance"))


def knn_exact_l2(spark, d):
    return _rounded(retrieval.nearest(_vectors(spark, d), _probes(spark, d), 10, masked=False))


def knn_pit_filtered(spark, d):
    return _rounded(retrieval.nearest(_vectors(spark, d), _probes(spark, d), 5, by_symbol=True))


def knn_index_recall(spark, d):
    """Recall of an index of lists against all rows, and the share of the corpus that it ranks."""
    rows = _vectors(spark, d)
    index, middle = retrieval.indexed(rows, LISTS)
    found = retrieval.approximate(index, middle, _probes(spark, d), 10, PROBES, masked=False)
    recall = retrieval.recall_at(retrieval.nearest(rows, _probes(spark, d), 10, masked=False), found, 10).agg(F.count("*").alias("queries"), F.round(F.avg("recall"), 6).alias("recall"))
    touched = found.groupBy("query_id").agg(F.first("candidates").alias("c")).agg(F.avg("c").alias("c"))
    return recall.join(touched, F.lit(True)).join(rows.agg(F.count("*").alias("n")), F.lit(True)).select("queries", "recall", F.round(F.col("c") / F.col("n"), 6).alias("touched"))


def knn_index_filtered(spark, d):
    """Answers of the index among what was known, of the query's symbol; all lists are probed, so they are the exact ones."""
    index, middle = retrieval.indexed(_vectors(spark, d), LISTS)
    return _rounded(retrieval.approximate(index, middle, _probes(spark, d), 5, LISTS, by_symbol=True))


def embed_documents(spark, d):
    """The local embedder's vectors, a row for each place."""
    v = retrieval.embed(fr.corpus(spark, d))
    return v.select("doc_id", F.posexplode("vector").alias("place", "value")).where("value <> 0").select("doc_id", "place", F.round("value", 9).alias("value"))


def bm25_topk(spark, d):
    return retrieval.bm25(fr.corpus(spark, d), fr.asked(spark, d), 10, masked=False).select("query_id", "rank", "doc_id", F.round("score", 6).alias("score"))


def bm25_visible_only(spark, d):
    return retrieval.bm25(fr.corpus(spark, d), fr.asked(spark, d), 10).select("query_id", "rank", "doc_id", F.round("score", 6).alias("score"))


def _ranking(spark, d):
    return retrieval.bm25(fr.corpus(spark, d), fr.asked(spark, d), 20, masked=False)


def rrf_fusion(spark, d):
    """What was known at the query's instant, ranked by words and by the embedder's vectors, fused."""
    docs, asked = fr.corpus(spark, d), fr.asked(spark, d)
    vectors = retrieval.embed(docs).join(docs.select("doc_id", "knowable_at"), "doc_id").withColumnRenamed("doc_id", "id")
    probes = retrieval.embed(asked, key="query_id").join(asked.select("query_id", "as_of"), "query_id")
    near = retrieval.nearest(vectors, probes, 20).select("query_id", "rank", F.col("id").alias("doc_id"))
    return retrieval.fuse([retrieval.bm25(docs, asked, 20), near], 10).select("query_id", "rank", "doc_id", F.round("score", 9).alias("score"))


def _relevant(spark, d):
    """Documents that contain the query's text."""
    q = fr.asked(spark, d).withColumnRenamed("text", "said")
    return fr.corpus(spark, d).join(F.broadcast(q), F.col("text").contains(F.col("said"))).select("query_id", "doc_id")


def ranking_metrics(spark, d):
    a = _ranking(spark, d)
    m = retrieval.ranking_metrics(a, _relevant(spark, d), fr.asked(spark, d), known=fr.corpus(spark, d))
    return m.select("queries", *[F.round(c, 6).alias(c) for c in ("hit_1", "hit_5", "hit_10", "mrr")], "future")


def rerank_by_length(spark, d):
    a = _ranking(spark, d)
    scores = a.join(fr.corpus(spark, d), "doc_id").select("query_id", "doc_id", F.floor(-F.length("text") / 500).cast("double").alias("score"))
    return retrieval.rerank(a, scores)


def html_to_lines(spark, d):
    return text.to_lines(fr.table(spark, d, "pages"), "page_id", "html")


def chunk_documents(spark, d):
    return text.to_chunks(fr.table(spark, d, "documents"), "doc_id", "text", size=2000, overlap=300, partitions=8).select("doc_id", "chunk_id", "chunk_index", "section", F.length("text").alias("chars"))


def chunk_pages(spark, d):
    return text.to_chunks(fr.table(spark, d, "pages"), "page_id", "html", html=True, size=600, overlap=100).select("page_id", "chunk_id", "chunk_index", "section", F.length("text").alias("chars"))


def chunk_ids(spark, d):
    return fr.table(spark, d, "documents").select("doc_id", text.chunk_id(F.col("doc_id"), F.lit(0), F.col("text")).alias("chunk_id"))


def lexicon_terms(spark, d):
    p = retrieval.postings(fr.table(spark, d, "documents"))
    return p.groupBy("term").agg(F.count("*").alias("docs"), F.sum("tf").alias("tf")).where("docs > 5")


def question_labels(spark, d):
    o = fr.table(spark, d, "orders")
    v = (F.col("o_totalprice").cast("decimal(18,0)") * F.when(F.col("o_orderkey") % 2 == 0, 1000).otherwise(1)).cast("decimal(38,6)")
    facts = o.select(F.col("o_custkey").alias("symbol"), F.col("o_orderkey").alias("fact_id"), v.alias("value"), F.when(F.col("o_orderkey") % 3 == 0, "shares").otherwise("USD").alias("unit"))
    told = fr.table(spark, d, "orders").where("o_orderkey % 4 <> 1")
    passages = told.select(F.col("o_custkey").alias("symbol"), F.col("o_orderkey").alias("chunk_id"), F.concat(F.lit("a total of "), F.format_number(F.col("o_totalprice").cast("decimal(18,0)"), 0), F.lit(", as filed.")).alias("text"))
    out = retrieval.labelled(facts, passages, ["symbol"])
    return out.select("fact_id", F.size("relevant").alias("relevant"), "dropped")


def question_splits(spark, d):
    o = fr.table(spark, d, "orders")
    at = retrieval.split_by_time(F.col("o_orderdate"), "1999-01-01", "2000-06-01")
    return o.groupBy(at.alias("split"), retrieval.choose(["What was {}?", "How much was {}?", "State {}."], F.col("o_orderkey").cast("string")).alias("phrase")).agg(F.count("*").alias("questions"))


def answer_scores(spark, d):
    """A stand-in model that quotes its first excerpt, against the texts of the relevant documents."""
    docs = fr.corpus(spark, d).select("doc_id", F.lit("doc").alias("context"), "text")
    asked = answering.prompts(fr.asked(spark, d), _ranking(spark, d), docs, 3)

    def quote(prompts: list[str]) -> list[str]:
        said = [p.split("[1] doc\n", 1)[1].split("\n\n[2] doc\n", 1)[0].split("\n\nQuestion: ", 1)[0] if "[1] doc\n" in p else None for p in prompts]
        return [answering.ABSTAINS if x is None else f"{x} [1]" for x in said]

    said = docs.select("doc_id", F.regexp_extract("text", r"^\S+", 0).alias("opening"))
    relevant = _relevant(spark, d).join(said, "doc_id").groupBy("query_id").agg(F.collect_set("doc_id").alias("relevant"), F.collect_set("opening").alias("answers"))
    truth = fr.asked(spark, d).select("query_id").join(relevant, "query_id", "left")
    truth = truth.select("query_id", F.coalesce("relevant", F.array().cast("array<bigint>")).alias("relevant"), F.filter(F.coalesce("answers", F.array().cast("array<string>")), lambda x: ~x.rlike(r"[^A-Za-z ]") & (x != "")).alias("answers"))
    scores = answering.scores(answering.judged(answering.ask(asked, quote), asked, truth))
    return scores.select("questions", *[F.round(c, 9).alias(c) for c in scores.columns if c != "questions"])


QUERIES = {f.__name__: f for f in (
    answer_scores, embed_documents, knn_exact_l2, knn_pit_filtered, knn_index_filtered, knn_index_recall, bm25_topk, bm25_visible_only, rrf_fusion, ranking_metrics, rerank_by_length, html_to_lines, chunk_documents, chunk_pages, chunk_ids, lexicon_terms, question_labels, question_splits,
)}

_UNIT = """v AS (SELECT vec_id AS id, [CAST(x AS DOUBLE) / sqrt(list_sum([CAST(y AS DOUBLE) * CAST(y AS DOUBLE) FOR y IN embedding])) FOR x IN embedding] AS e, label, vec_id * 60 AS known FROM embeddings)"""
_DIST = "round(list_sum([(a.e[i] - b.e[i]) * (a.e[i] - b.e[i]) FOR i IN range(1, len(a.e) + 1)]), 9)"


def _bm25(masked: bool, k: int, name: str) -> str:
    seen = "c.knowable_at <= q.as_of" if masked else "true"
    return f"""{name}_tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL),
{name}_st AS (SELECT q.query_id, count(*) AS n, avg(len) AS mean FROM asked q JOIN lens c ON {seen} GROUP BY 1),
{name}_h AS (SELECT q.query_id, t.doc_id, t.term, t.tf, c.len FROM qt q JOIN {name}_tf t USING (term) JOIN lens c ON c.doc_id = t.doc_id WHERE {seen}),
{name}_df AS (SELECT query_id, term, count(*) AS df FROM {name}_h GROUP BY ALL),
{name}_sc AS (SELECT h.query_id, h.doc_id, sum(ln(1 + (s.n - d.df + 0.5) / (d.df + 0.5)) * h.tf * 2.2 / (h.tf + 1.2 * (0.25 + 0.75 * h.len / s.mean))) AS score
  FROM {name}_h h JOIN {name}_df d USING (query_id, term) JOIN {name}_st s USING (query_id) GROUP BY ALL),
{name}_all AS (SELECT q.query_id, c.doc_id, round(coalesce(s.score, 0), 9) AS score FROM asked q JOIN lens c ON {seen} LEFT JOIN {name}_sc s ON s.query_id = q.query_id AND s.doc_id = c.doc_id),
{name} AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM {name}_all) WHERE rank <= {k})"""


_TOK = f"""{fr.CORPUS}, tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM corpus),
lens AS (SELECT doc_id, knowable_at, len(regexp_extract_all(lower(text), '[a-z0-9]+')) AS len FROM corpus),
qt AS (SELECT DISTINCT query_id, as_of, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM asked)"""

#: Vectors of the local embedder: kind (d or q), id, place, x.
_EMBED = """et AS (SELECT 'd' AS kind, doc_id AS id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS t FROM documents UNION ALL SELECT 'q', item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) FROM benchmark),
es AS (SELECT kind, id, CAST(CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % 64 AS INTEGER) AS place, sum(CASE WHEN CAST('0x' || substr(md5(t), 9, 1) AS INTEGER) % 2 = 1 THEN 1 ELSE -1 END) AS x FROM et GROUP BY ALL),
ev AS (SELECT kind, id, place, x / sqrt(sum(x * x) OVER (PARTITION BY kind, id)) AS x FROM es WHERE x <> 0)"""

ORACLE = {
    "knn_exact_l2": f"""WITH {_UNIT}, x AS (SELECT a.id AS query_id, b.id, {_DIST} AS distance FROM v a JOIN v b ON a.id % 100 = 0),
y AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS INTEGER) AS rank FROM x) SELECT query_id, rank, id, round(distance, 6) AS distance FROM y WHERE rank <= 10""",
    "knn_pit_filtered": f"""WITH {_UNIT}, x AS (SELECT a.id AS query_id, b.id, {_DIST} AS distance FROM v a JOIN v b ON a.id % 100 = 0 AND b.known <= a.known + 1800 AND a.label = b.label),
y AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS INTEGER) AS rank FROM x) SELECT query_id, rank, id, round(distance, 6) AS distance FROM y WHERE rank <= 5""",
    "bm25_topk": f"WITH {_TOK}, {_bm25(False, 10, 'a')} SELECT query_id, rank, doc_id, round(score, 6) AS score FROM a",
    "bm25_visible_only": f"WITH {_TOK}, {_bm25(True, 10, 'a')} SELECT query_id, rank, doc_id, round(score, 6) AS score FROM a",
    "knn_index_filtered": f"""WITH {_UNIT}, x AS (SELECT a.id AS query_id, b.id, {_DIST} AS distance FROM v a JOIN v b ON a.id % 100 = 0 AND b.known <= a.known + 1800 AND a.label = b.label),
y AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS INTEGER) AS rank FROM x) SELECT query_id, rank, id, round(distance, 6) AS distance FROM y WHERE rank <= 5""",
    "embed_documents": f"""WITH {_EMBED} SELECT id AS doc_id, place, round(x, 9) AS value FROM ev WHERE kind = 'd'""",
    "rrf_fusion": f"""WITH {_TOK}, {_bm25(True, 20, 'a')}, {_EMBED},
ed AS (SELECT kind, id, list(x ORDER BY place) AS e FROM (SELECT k.kind, k.id, p.place, coalesce(ev.x, 0) AS x FROM (SELECT DISTINCT kind, id FROM ev) k JOIN (SELECT unnest(range(64)) AS place) p ON true LEFT JOIN ev USING (kind, id, place)) GROUP BY kind, id),
nd AS (SELECT q.query_id, c.doc_id, round(list_sum([(x.e[i] - y.e[i]) * (x.e[i] - y.e[i]) FOR i IN range(1, 65)]), 9) AS distance
  FROM asked q JOIN ed x ON x.kind = 'q' AND x.id = q.query_id JOIN corpus c ON c.knowable_at <= q.as_of JOIN ed y ON y.kind = 'd' AND y.id = c.doc_id),
b AS (SELECT query_id, doc_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) AS INTEGER) AS rank FROM nd QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) <= 20),
u AS (SELECT query_id, doc_id, rank, 0 AS source FROM a UNION ALL SELECT query_id, doc_id, rank, 1 FROM b),
s AS (SELECT query_id, doc_id, round(sum(1.0::DOUBLE / (60 + rank)), 12) AS score, min((rank, source)) AS f FROM u GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, f, doc_id) AS INTEGER) AS rank FROM s) SELECT query_id, rank, doc_id, round(score, 9) AS score FROM r WHERE rank <= 10""",
    "ranking_metrics": f"""WITH {_TOK}, {_bm25(False, 20, 'a')}, rel AS (SELECT DISTINCT q.query_id, c.doc_id FROM asked q JOIN corpus c ON contains(c.text, q.text)),
b AS (SELECT q.query_id, min(a.rank) AS best FROM asked q LEFT JOIN (SELECT a.* FROM a JOIN rel USING (query_id, doc_id)) a USING (query_id) GROUP BY 1)
SELECT count(*) AS queries, round(avg(CASE WHEN best <= 1 THEN 1.0 ELSE 0 END), 6) AS hit_1, round(avg(CASE WHEN best <= 5 THEN 1.0 ELSE 0 END), 6) AS hit_5, round(avg(CASE WHEN best <= 10 THEN 1.0 ELSE 0 END), 6) AS hit_10,
  round(avg(CASE WHEN best <= 10 THEN 1.0::DOUBLE / best ELSE 0 END), 6) AS mrr, (SELECT count(*) FROM a JOIN asked q USING (query_id) JOIN corpus c USING (doc_id) WHERE c.knowable_at > q.as_of) AS future FROM b""",
    "rerank_by_length": f"""WITH {_TOK}, {_bm25(False, 20, 'a')}, s AS (SELECT a.query_id, a.doc_id, a.rank AS was, floor(-length(c.text) / 500) AS score FROM a JOIN corpus c USING (doc_id))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, was) AS INTEGER) AS rank, doc_id, score FROM s""",
    "chunk_ids": "SELECT doc_id, substr(sha256(CAST(doc_id AS VARCHAR) || chr(31) || '0' || chr(31) || text), 1, 32) AS chunk_id FROM documents",
    "lexicon_terms": "WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM documents) SELECT term, count(DISTINCT doc_id) AS docs, count(*) AS tf FROM t GROUP BY term HAVING count(DISTINCT doc_id) > 5",
    "question_labels": """WITH f AS (SELECT o_custkey, o_orderkey, CAST(o_totalprice AS DECIMAL(18,0)) * CASE WHEN o_orderkey % 2 = 0 THEN 1000 ELSE 1 END AS v, o_orderkey % 3 = 0 AS shares FROM orders),
a AS (SELECT *, CASE WHEN shares THEN [format('{:,}', CAST(v AS BIGINT))] ELSE [] END || CASE WHEN v >= 1000000 AND v % 1000000 = 0 THEN [format('{:,}', CAST(v // 1000000 AS BIGINT))] ELSE [] END || CASE WHEN v >= 1000000 AND v % 1000 = 0 THEN [format('{:,}', CAST(v // 1000 AS BIGINT))] ELSE [] END AS forms FROM f),
p AS (SELECT o_custkey, format('{:,}', CAST(CAST(o_totalprice AS DECIMAL(18,0)) AS BIGINT)) AS said FROM orders WHERE o_orderkey % 4 <> 1),
m AS (SELECT a.o_orderkey, count(p.said) AS passages, max(len(a.forms)) AS n, count(*) FILTER (WHERE list_contains(a.forms, p.said)) AS hits FROM a LEFT JOIN p USING (o_custkey) GROUP BY 1)
SELECT o_orderkey AS fact_id, CAST(hits AS INTEGER) AS relevant, CASE WHEN passages = 0 THEN 'no_document' WHEN n = 0 THEN 'no_answer_string' WHEN hits = 0 THEN 'value_not_in_text' END AS dropped FROM m""",
    "question_splits": """SELECT CASE WHEN o_orderdate < DATE '1999-01-01' THEN 'train' WHEN o_orderdate < DATE '2000-06-01' THEN 'validation' ELSE 'test' END AS split,
  ['What was {}?', 'How much was {}?', 'State {}.'][CAST(CAST('0x' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 3 AS BIGINT) + 1] AS phrase, count(*) AS questions FROM orders GROUP BY ALL""",
}
