"""Retrieval that respects time: exact neighbours, BM25, rank fusion, metrics; what is not known yet is masked before ranking."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.sizes import small

#: Bytes of query vectors that one pass over the corpus carries to every task.
QUERY_BYTES = 32 << 20
#: Rows that the lists of an index are fitted on, at most.
FITTED = 20_000


def unit(vector: Column) -> Column:
    """A vector of length 1; null for a zero vector."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return F.when(norm > 0, F.transform(vector, lambda x: x.cast("double") / norm))


def _blocks(queries: DataFrame, columns: list[Column]) -> Iterator[list]:
    """Rows of the queries, so many at a time that their vectors stay under ``QUERY_BYTES``."""
    there = queries.agg(F.coalesce(F.sum(F.size("vector")), F.lit(0)).alias("cells")).first()
    n = max(1, -(-8 * there["cells"] // QUERY_BYTES))
    for k in range(n):
        yield queries.where(F.pmod(F.xxhash64("query_id"), F.lit(n)) == k).select(*columns).orderBy("query_id").collect()


def nearest(corpus: DataFrame, queries: DataFrame, k: int = 10, masked: bool = True, by_symbol: bool = False) -> DataFrame:
    """query_id, rank, id, distance (squared), score 1 / (1 + distance): each query's k nearest; equal distances go by id.

    ``corpus``: id, vector, knowable_at, symbol; ``queries``: query_id, vector, as_of, symbol (the last two where used).
    Batches of the corpus meet a block of queries, of bounded bytes, in one matrix product; each task keeps k per query, and only
    these are shuffled.  Distances are compared to nine places.
    """
    extra = (["as_of"] if masked else []) + (["symbol"] if by_symbol else [])
    given = queries.where(unit(F.col("vector")).isNotNull())
    out = None
    for asked in _blocks(given, ["query_id", unit(F.col("vector")).alias("vector"), *extra]):
        one = _nearest(corpus, asked, k, masked, by_symbol, dict(queries.dtypes)["query_id"])
        out = one if out is None else out.unionByName(one)
    return out


def _nearest(corpus: DataFrame, asked: list, k: int, masked: bool, by_symbol: bool, kind: str) -> DataFrame:
    names = [r["query_id"] for r in asked]
    matrix = np.array([r["vector"] for r in asked], float) if asked else np.zeros((0, 1))
    as_of = np.array([int(round(r["as_of"].timestamp() * 1e6)) if masked else 0 for r in asked], np.int64)
    symbols = np.array([r["symbol"] if by_symbol else "" for r in asked], object)
    id_kind = dict(corpus.dtypes)["id"]
    shared = corpus.sparkSession.sparkContext.broadcast((names, matrix, as_of, symbols))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix, as_of, symbols = shared.value
        top, top_ids = np.full((len(names), 0), np.inf), None
        for batch in batches:
            if not batch.num_rows or not names:
                continue
            ids = np.array(batch.column(0).to_pylist())
            docs = np.array(batch.column(1).flatten().to_numpy(zero_copy_only=False), float).reshape(len(ids), -1)
            d = np.round(np.maximum((matrix**2).sum(1)[:, None] + (docs**2).sum(1)[None] - 2 * matrix @ docs.T, 0), 9)
            if masked:
                d = np.where(batch.column(2).to_numpy()[None] <= as_of[:, None], d, np.inf)
            if by_symbol:
                d = np.where(np.array(batch.column(batch.num_columns - 1).to_pylist(), object)[None] == symbols[:, None], d, np.inf)
            order = np.argsort(ids, kind="stable")
            pick = order[np.argsort(d[:, order], axis=1, kind="stable")[:, :k]]
            top = np.concatenate([top, np.take_along_axis(d, pick, 1)], 1)
            top_ids = ids[pick] if top_ids is None else np.concatenate([top_ids, ids[pick]], 1)
            order = np.lexsort((top_ids, top), axis=-1)[:, :k]
            top, top_ids = np.take_along_axis(top, order, 1), np.take_along_axis(top_ids, order, 1)
        if top_ids is not None:
            q, c = np.nonzero(np.isfinite(top))
            yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in q]), pa.array(top_ids[q, c].tolist()), pa.array(top[q, c])], names=["query_id", "id", "distance"])

    columns = ["id", unit(F.col("vector")).alias("vector"), *([F.unix_micros("knowable_at").alias("known")] if masked else []), *(["symbol"] if by_symbol else [])]
    found = corpus.select(*columns).where("vector is not null").mapInArrow(run, f"query_id {kind}, id {id_kind}, distance double")
    return _ranked(found, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).withColumn("score", 1 / (1 + F.col("distance"))).select("query_id", "rank", "id", "distance", "score")


# -- an index of lists around centres


def centres(vectors: DataFrame, lists: int, sample: int = FITTED, rounds: int = 10, seed: int = 1) -> np.ndarray:
    """Centres of ``lists`` lists, fitted on at most ``sample`` vectors (id, vector; those with the smallest hashes of their ids)."""
    rows = vectors.where("vector is not null").orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").collect()
    x = np.array([r["vector"] for r in rows], float)
    if not len(x):
        return np.zeros((1, 1))
    found = x[np.random.default_rng(seed).choice(len(x), min(lists, len(x)), replace=False)]
    for _ in range(rounds):
        own = np.argmax(x @ found.T, axis=1)
        sums = np.stack([x[own == j].sum(0) if (own == j).any() else found[j] for j in range(len(found))])
        found = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return found


def in_lists(vectors: DataFrame, middle: np.ndarray, lists: int, key: str = "id") -> DataFrame:
    """``key``, list: the ``lists`` nearest lists of each vector, by batches."""
    shared, kind = vectors.sparkSession.sparkContext.broadcast(middle), dict(vectors.dtypes)[key]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch.column(1).flatten().to_numpy(zero_copy_only=False), float).reshape(batch.num_rows, -1)
                near = np.argsort(-(x @ shared.value.T), axis=1, kind="stable")[:, :lists]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), near.shape[1]))), pa.array(near.ravel())], names=[key, "list"])

    return vectors.select(key, "vector").where("vector is not null").mapInArrow(run, f"{key} {kind}, list long")


class FromTheFuture(AssertionError):
    """An answer that was not known at the instant asked about."""


def indexed(corpus: DataFrame, lists: int, **fit: int) -> tuple[DataFrame, np.ndarray]:
    """The index: every row of ``corpus`` (id, vector and other columns) with its unit vector and the one list it lies in, and the centres."""
    unit_rows = corpus.withColumn("vector", unit(F.col("vector"))).where("vector is not null")
    middle = centres(unit_rows, lists, **fit)
    return unit_rows.join(in_lists(unit_rows, middle, 1), "id"), middle


def approximate(index: DataFrame, middle: np.ndarray, queries: DataFrame, k: int = 10, probes: int = 4, masked: bool = True, by_symbol: bool = False) -> DataFrame:
    """As ``nearest``, over the rows of the ``probes`` lists nearest to each query, ranked exactly; with candidates, how many were ranked.

    Filters work before distances are computed.  That no answer is from the future is checked where the answers are: a row that
    is raises ``FromTheFuture``.
    """
    extra = (["as_of"] if masked else []) + (["symbol"] if by_symbol else [])
    asked = queries.select("query_id", unit(F.col("vector")).alias("asked"), *extra).where("asked is not null")
    probed = in_lists(asked.withColumnRenamed("asked", "vector"), middle, probes, "query_id").join(asked, "query_id")
    rows = index.join(small(probed), ["list", "symbol"] if by_symbol else ["list"])
    if masked:
        rows = rows.where(F.col("knowable_at") <= F.col("as_of"))
    d = F.round(F.aggregate(F.zip_with("vector", "asked", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x), 9)
    own = Window.partitionBy("query_id")
    late = (F.col("knowable_at") > F.col("as_of")) if masked else F.lit(False)
    near = rows.select("query_id", "id", d.alias("distance"), late.alias("late"))
    counted = near.groupBy("query_id").agg(F.count("*").alias("candidates"))
    best = near.withColumn("rank", F.row_number().over(own.orderBy("distance", "id"))).where(F.col("rank") <= k)
    sure = F.when(~F.col("late"), F.col("id")).otherwise(F.raise_error("an answer is from the future").cast(dict(index.dtypes)["id"]))
    return best.join(counted, "query_id").select("query_id", "rank", sure.alias("id"), "distance", (1 / (1 + F.col("distance"))).alias("score"), "candidates")


# -- vectors of texts


def hashed_words(texts: list[str], dim: int) -> np.ndarray:
    """A deterministic local embedder: each word adds one, up or down, at a place that its digest names."""
    import hashlib
    import re

    out = np.zeros((len(texts), dim))
    for row, text in zip(out, texts, strict=True):
        for word in re.findall("[a-z0-9]+", text.lower()):
            digest = hashlib.md5(word.encode()).hexdigest()
            row[int(digest[:8], 16) % dim] += 1 if int(digest[8], 16) % 2 else -1
    return out


def embed(rows: DataFrame, embedder=hashed_words, dim: int = 64, batch: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, vector: unit vectors of texts by any function of (list of texts, dim), ``batch`` texts at a time; a null text is an empty one.

    A vector of another length than ``dim``, or one that isn't finite, is an error; a zero vector stays null.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for at in range(0, part.num_rows, batch):
                own = part.slice(at, batch)
                found = np.asarray(embedder([t or "" for t in own.column(1).to_pylist()], dim), float)
                if found.shape != (own.num_rows, dim) or not np.isfinite(found).all():
                    raise ValueError(f"the embedder gave {found.shape}, not {(own.num_rows, dim)} finite numbers")
                norm = np.linalg.norm(found, axis=1)
                vectors = [(v / n).tolist() if n else None for v, n in zip(found, norm, strict=True)]
                yield pa.RecordBatch.from_arrays([own.column(0), pa.array(vectors, pa.list_(pa.float64()))], names=[key, "vector"])

    return rows.select(key, F.col(text).cast("string")).mapInArrow(run, f"{key} {dict(rows.dtypes)[key]}, vector array<double>")


# -- words


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))


def postings(docs: DataFrame, terms: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, length, keep, term, tf of documents (doc_id, text); ``length`` is the number of tokens.

    With ``terms`` (term), a counted broadcast where they are few, all other tokens go where they are read: only hits are shuffled.
    """
    split = docs.select("doc_id", *keep, tokens(F.col("text")).alias("t"))
    every = split.select("doc_id", *keep, F.size("t").alias("length"), F.explode("t").alias("term"))
    if terms is not None:
        every = every.join(small(terms.select("term").distinct()), "term")
    return every.groupBy("doc_id", *keep, "length", "term").agg(F.count("*").alias("tf"))


def bm25(docs: DataFrame, queries: DataFrame, k: int = 10, k1: float = 1.2, b: float = 0.75, masked: bool = True) -> DataFrame:
    """query_id, rank, doc_id, score: the k best of the documents known at the query's instant.

    ``docs``: doc_id, text, knowable_at; ``queries``: query_id, text, as_of.  Document frequencies, number and mean length count
    only visible documents.  Documents without a query term score 0 and fill the list in order of their ids.  Documents meet the
    instants asked about once, each in the span between two of them that it became known in: numbers, lengths and the k smallest
    ids are taken per span, and spans, as many as instants, are summed up for each instant.
    """
    asked = queries.select("query_id", "text", *(["as_of"] if masked else [F.lit("9999-12-31").cast("timestamp").alias("as_of")]))
    instants = sorted(r["us"] for r in asked.select(F.unix_micros("as_of").alias("us")).distinct().collect())
    known = F.col("knowable_at") if masked else F.lit("1970-01-01").cast("timestamp")
    # the first instant that sees a document; those that none sees take no part
    first = F.get(F.filter(F.lit(instants or [0]), lambda t: t >= F.unix_micros(known)), F.lit(0))
    spans = docs.select("doc_id", first.alias("span"), F.regexp_count(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z0-9]+")).alias("length")).where("span is not null")
    sums = spans.groupBy("span").agg(F.count("*").alias("n"), F.sum("length").alias("total"))
    least = spans.select("span", "doc_id").withColumn("n", F.row_number().over(Window.partitionBy("span").orderBy("doc_id"))).where(F.col("n") <= k).drop("n")
    when = small(asked.select(F.unix_micros("as_of").alias("at")).distinct())
    stats = sums.join(when, F.col("span") <= F.col("at")).groupBy("at").agg(F.sum("n").alias("visible"), (F.sum("total") / F.sum("n")).alias("mean"))
    fill = least.join(when, F.col("span") <= F.col("at")).withColumn("n", F.row_number().over(Window.partitionBy("at").orderBy("doc_id"))).where(F.col("n") <= k).select("at", "doc_id")

    terms = asked.select("query_id", F.unix_micros("as_of").alias("at"), F.explode(F.array_distinct(tokens(F.col("text")))).alias("term"))
    found = postings(docs.withColumn("span", first).where("span is not null"), terms, ("span",))
    hits = found.join(small(terms), "term").where(F.col("span") <= F.col("at"))
    df = hits.groupBy("query_id", "term").agg(F.count("*").alias("df"))
    scored = hits.join(small(df), ["query_id", "term"]).join(small(stats), "at")
    mean = F.when(F.col("mean") > 0, F.col("mean")).otherwise(1.0)
    idf = F.ln(1 + (F.col("visible") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / mean))
    best = scored.groupBy("query_id", "doc_id").agg(F.sum(part).alias("score"))
    none = asked.select("query_id", F.unix_micros("as_of").alias("at")).join(small(fill), "at").select("query_id", "doc_id", F.lit(0.0).alias("score"))
    every = best.unionByName(none).groupBy("query_id", "doc_id").agg(F.round(F.sum("score"), 9).alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "doc_id"))
    return every.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


def fuse(rankings: list[DataFrame], k: int = 10, constant: int = 60) -> DataFrame:
    """Reciprocal rank fusion of rankings (query_id, rank, doc_id); ties go to the better place, then to the earlier ranking, then the smaller id."""
    every = None
    for i, r in enumerate(rankings):
        one = r.select("query_id", "doc_id", "rank", F.lit(i).alias("source"))
        every = one if every is None else every.unionByName(one)
    summed = every.groupBy("query_id", "doc_id").agg(F.round(F.sum(F.lit(1.0) / (constant + F.col("rank"))), 12).alias("score"), F.min(F.struct("rank", "source")).alias("first"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "first", "doc_id"))
    return summed.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


def rerank(ranking: DataFrame, scores: DataFrame) -> DataFrame:
    """A ranking in the order of other scores (query_id, doc_id, score); equal ones keep their order."""
    joined = ranking.select("query_id", "doc_id", F.col("rank").alias("was")).join(scores, ["query_id", "doc_id"])
    return joined.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "was"))).select("query_id", "rank", "doc_id", "score")


def ranking_metrics(ranking: DataFrame, relevant: DataFrame, queries: DataFrame, cuts: tuple[int, ...] = (1, 5, 10), known: DataFrame | None = None) -> DataFrame:
    """One row: queries, hit@cut, MRR at the last cut, and, with ``known`` (doc_id, knowable_at), how many answers were from the future."""
    marked = ranking.join(relevant.select("query_id", "doc_id").distinct().withColumn("hit", F.lit(True)), ["query_id", "doc_id"], "left")
    best = marked.groupBy("query_id").agg(F.min(F.when(F.col("hit"), F.col("rank"))).alias("best"))
    every = queries.select("query_id").distinct().join(best, "query_id", "left")
    hits = [F.avg(F.coalesce((F.col("best") <= c).cast("double"), F.lit(0.0))).alias(f"hit_{c}") for c in cuts]
    out = every.agg(F.count("*").alias("queries"), *hits, F.avg(F.when(F.col("best") <= cuts[-1], 1 / F.col("best")).otherwise(0.0)).alias("mrr"))
    if known is None:
        return out
    late = ranking.join(queries.select("query_id", "as_of"), "query_id").join(known.select("doc_id", "knowable_at"), "doc_id").agg(F.count_if(F.col("knowable_at") > F.col("as_of")).alias("future"))
    return out.crossJoin(late)


def recall_at(exact: DataFrame, other: DataFrame, k: int) -> DataFrame:
    """query_id, recall: the share of the exact k answers that the other ranking has among its k."""
    top = lambda df, n: df.where(F.col("rank") <= k).groupBy("query_id").agg(F.collect_set("id").alias(n))
    return top(exact, "a").join(top(other, "b"), "query_id", "left").select("query_id", (F.size(F.array_intersect("a", F.coalesce("b", F.array().cast(f"array<{dict(exact.dtypes)['id']}>")))) / F.size("a")).alias("recall"))


# -- questions from facts


def answers(value: Column, unit_of: Column) -> Column:
    """How a text may print a number: per-share amounts to two places; shares in full; whole millions or thousands from a million on."""
    size = F.abs(value.cast("decimal(38,6)"))
    grouped = lambda c: F.format_number(c, 0)
    scaled = [F.when((size >= 10**6) & (size % scale == 0), grouped((size / scale).cast("decimal(38,0)"))) for scale in (10**6, 10**3)]
    whole = F.array_distinct(F.array_compact(F.array(F.when(unit_of == "shares", grouped(size.cast("decimal(38,0)"))), *scaled)))
    return F.when(unit_of == "USD/shares", F.array(F.format_string("%.2f", size.cast("double")))).otherwise(whole)


def answer_pattern(found: Column) -> Column:
    """A pattern for any of the answers as a whole number."""
    quoted = F.transform(found, lambda a: F.regexp_replace(a, r"([.,])", r"\\$1"))
    return F.concat(F.lit(r"(?<![\d.,])(?:"), F.array_join(quoted, "|"), F.lit(r")(?![\d]|[.,]\d)"))


def labelled(facts: DataFrame, passages: DataFrame, on: list[str]) -> DataFrame:
    """Facts (on, fact_id, value, unit) with the passages (on, chunk_id, text) that print their value, and why others are dropped.

    fact_id, relevant (sorted chunk ids), dropped: no_document, no_answer_string, value_not_in_text, or null.
    """
    asked = facts.select(*on, "fact_id", answers(F.col("value"), F.col("unit")).alias("answers"))
    met = asked.join(passages.select(*on, "chunk_id", "text"), on, "left")
    hit = (F.size("answers") > 0) & F.col("chunk_id").isNotNull() & F.regexp_like(F.coalesce("text", F.lit("")), answer_pattern(F.col("answers")))
    told = met.groupBy("fact_id").agg(F.count("chunk_id").alias("passages"), F.first(F.size("answers")).alias("forms"), F.sort_array(F.collect_list(F.when(hit, F.col("chunk_id")))).alias("relevant"))
    why = F.when(F.col("passages") == 0, "no_document").when(F.col("forms") == 0, "no_answer_string").when(F.size("relevant") == 0, "value_not_in_text")
    return told.select("fact_id", "relevant", why.alias("dropped"))


def split_by_time(at: Column, train_until: str, test_from: str) -> Column:
    return F.when(at < F.lit(train_until).cast("timestamp"), "train").when(at < F.lit(test_from).cast("timestamp"), "validation").otherwise("test")


def choose(options: list[str], key: Column) -> Column:
    """One of the options, always the same for a key."""
    return F.element_at(F.array(*[F.lit(o) for o in options]), (F.pmod(F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long"), F.lit(len(options))) + 1).cast("int"))
