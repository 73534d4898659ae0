"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text.

Ratings are ordered grades 0 < 1 < ... < J.  One weight vector over hashed features is shared by all grades, ordered
thresholds part them: P(grade <= j) = logistic(threshold[j] - weights . features).  The expected grade and the tail
probability P(grade >= j) then select documents.

Features of a whole text: its distinct words (lower case, without punctuation around them), hashed; the shares of its
tokens' shapes (capitals, small letters, digits, and each mark), hashed; the share of its most frequent token and of tokens
that repeat the one before.  The model is fitted on at most ``sample`` rated rows, those with the smallest hash of their id:
that bound and one on the bytes of their features are parameters; scoring covers every row and whole texts.

Defined cases: a null or blank text has no features and takes the grade of the thresholds; rated rows without a text row, or
with a null rating, are ignored; of ratings that repeat an id the lowest counts, of rated texts one; without any rated row every document has
probability 1 of the highest grade; rows that repeat an id each give a row; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tidemark.llm.common import durable, slices, worker_cache

WORDS = 1 << 17
SHAPES = 1 << 8
_EXTRA = 3
SIZE = WORDS + SHAPES + _EXTRA
#: How much a share of 1 weighs against the presence of one word.
_SHARE = 8.0

#: Documents whose words a step of the fit spreads out at a time.
_CHUNK = 1000

_edge = re.compile(r"^[^\w]+|[^\w]+$")


def shape(token: str) -> str:
    """Runs of capitals, other letters and digits as one character each, marks as they are, once; of the whole token."""
    out = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in token)
    return re.sub(r"(.)\1+", r"\1", out)


class Hashed(dict):
    """Token to (word feature or -1, shape feature) packed in one integer."""

    def __missing__(self, token: str) -> int:
        word = _edge.sub("", token).lower()
        place = zlib.crc32(word.encode()) % WORDS if word else WORDS
        out = place << 8 | zlib.crc32(shape(token).encode()) % SHAPES
        if len(self) > 300_000:
            self.clear()
        self[token] = out
        return out


def features(text: str | None, hashed: Hashed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word features; shares of shapes; the extra ones."""
    tokens = text.split() if text else []
    if not tokens:
        return np.zeros(0, np.int64), np.zeros(SHAPES), np.zeros(_EXTRA)
    times = Counter(tokens)
    codes = np.fromiter(map(hashed.__getitem__, times), np.int64, len(times))
    count = np.fromiter(times.values(), np.int64, len(times))
    words = np.unique(codes >> 8)
    shares = np.bincount(codes & (SHAPES - 1), count, SHAPES) / len(tokens)
    twice = sum(map(eq, tokens, tokens[1:])) / len(tokens)
    return words[words < WORDS], shares * _SHARE, np.array([count.max() / len(tokens), twice, len(times) / len(tokens)]) * _SHARE


class CumulativeLink:
    """Weights shared by all grades, ascending thresholds; fitted by Adam under an L1 penalty on the words."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1..J, one row per score."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None] - scores[:, None], -60, 60)))

    @staticmethod
    def spread(words: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[slice, slice]]]:
        """Word features of at least ``least`` documents: their names, (owner, place) of each occurrence, and chunks (occurrences, documents)."""
        n, sizes = len(words), np.array([len(w) for w in words], np.int64)
        flat = np.concatenate([*words, np.zeros(0, np.int32)]).astype(np.int32)
        owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
        often = np.bincount(flat, minlength=WORDS) >= least
        owner, flat = owner[often[flat]], flat[often[flat]]
        names = np.flatnonzero(np.bincount(flat, minlength=WORDS))
        place = np.zeros(WORDS, np.int32)
        place[names] = np.arange(len(names))
        starts = np.searchsorted(owner, np.arange(0, n + _CHUNK, _CHUNK))
        chunks = [(slice(a, b), slice(i * _CHUNK, min(n, (i + 1) * _CHUNK))) for i, (a, b) in enumerate(zip(starts, starts[1:], strict=False))]
        return names, owner, place[flat], chunks

    @staticmethod
    def margins(weights: np.ndarray, thresholds: np.ndarray, occurrences: tuple, dense: np.ndarray, grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(grade >= own) and P(grade >= own + 1) of each document."""
        owner, flat, chunks = occurrences
        scores = dense @ weights[len(weights) - dense.shape[1] :]
        for cells, rows in chunks:
            scores[rows] += np.bincount(owner[cells] - rows.start, weights[flat[cells]], rows.stop - rows.start)
        edges = np.concatenate([[-60.0], thresholds, [60.0]])
        upper, lower = (1 / (1 + np.exp(np.clip(edges[grades + k] - scores, -60, 60))) for k in (0, 1))
        return upper, lower

    @staticmethod
    def slopes(weights: np.ndarray, thresholds: np.ndarray, occurrences: tuple, dense: np.ndarray, grades: np.ndarray, each: np.ndarray) -> np.ndarray:
        """Slopes of sum(each * log P(own grade)) in the weights, then in the thresholds."""
        owner, flat, chunks = occurrences
        words, top = len(weights) - dense.shape[1], len(thresholds)
        upper, lower = CumulativeLink.margins(weights, thresholds, occurrences, dense, grades)
        likely = np.maximum(upper - lower, 1e-12)
        up, low = upper * (1 - upper) / likely, lower * (1 - lower) / likely
        pull = each * (up - low)
        slope = np.zeros(len(weights) + top)
        for cells, _ in chunks:
            slope[:words] += np.bincount(flat[cells], pull[owner[cells]], words)
        slope[words : len(weights)] = pull @ dense
        for j in range(top):
            slope[len(weights) + j] = (each * low)[grades == j].sum() - (each * up)[grades == j + 1].sum()
        return slope

    @staticmethod
    def fit(words: list[np.ndarray], dense: np.ndarray, grades: np.ndarray, top: int, steps: int = 200, rate: float = 0.1, sparse: float = 3.0, shapes: float = 1.0) -> CumulativeLink:
        """``sparse``: the pull of so many documents must agree before a word counts at all (an L1 penalty)."""
        n = len(grades)
        names, owner, flat, chunks = CumulativeLink.spread(words, sparse)
        size = len(names) + dense.shape[1]
        weights, thresholds = np.zeros(size), np.linspace(-2, -1, top)
        balance = np.bincount(grades, minlength=top + 1)
        each = (n / np.maximum(1, balance) / max(1, (balance > 0).sum()))[grades] ** 0.5
        each /= each.sum()
        penalty = np.full(size, sparse / n)
        penalty[len(names) :] *= shapes
        held = [np.zeros(size + top) for _ in range(2)]
        for step in range(1, steps + 1):
            slope = CumulativeLink.slopes(weights, thresholds, (owner, flat, chunks), dense, grades, each)
            own = slope[:size]
            slope[:size] = np.where(weights != 0, own - penalty * np.sign(weights), np.sign(own) * np.maximum(0, np.abs(own) - penalty))
            held[0] = 0.9 * held[0] + 0.1 * slope
            held[1] = 0.99 * held[1] + 0.01 * slope**2
            move = rate * (1 - 0.95 * step / steps) * (held[0] / (1 - 0.9**step)) / (np.sqrt(held[1] / (1 - 0.99**step)) + 1e-4)
            after = weights + move[:size]
            weights = np.where((weights != 0) & (np.sign(after) != np.sign(weights)), 0.0, after)
            thresholds = np.maximum.accumulate(thresholds + move[size:] + np.arange(top) * 1e-6)
        full = np.zeros(WORDS + dense.shape[1])
        full[names] = weights[: len(names)]
        full[WORDS:] = weights[len(names) :]
        return CumulativeLink(full, thresholds)


def _featured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashed = worker_cache("token features", Hashed)
    for batch in slices(batches, 2):
        words, dense = [], []
        for text in batch.column(2).to_pylist():
            w, s, e = features(text, hashed)
            words.append(w.astype("<i4").tobytes())
            dense.append(np.concatenate([s, e]).astype("<f4").tobytes())
        names = ["doc_id", "grade", "words", "dense", "sum", "size"]
        told = [pa.array(words, pa.binary()), pa.array(dense, pa.binary()), pa.array(list(map(zlib.crc32, words)), pa.int64()), pa.array([len(w) + len(d) for w, d in zip(words, dense, strict=True)], pa.int64())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *told], names=names)


def fit(docs: DataFrame, ratings: DataFrame, top: int, sample: int = 20_000, sample_bytes: int = 128 << 20) -> CumulativeLink | None:
    """A model of ``ratings`` (doc_id, grade 0..top); None if no document is rated.

    It is fitted on at most ``sample`` of them, and on no more than have ``sample_bytes`` of features: with long
    texts the sample ends sooner, always in the order of the ids' hashes.  Of rows that repeat an id one counts.
    """
    rated = ratings.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").cast("long").alias("grade"))
    rated = durable(rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "rated")
    texts = docs.select("doc_id", "text").join(F.broadcast(rated), "doc_id")  # at most ``sample`` narrow rows
    told = texts.select(F.col("doc_id").cast("long"), "grade", "text").mapInArrow(_featured, "doc_id long, grade long, words binary, dense binary, sum long, size long")
    first = F.min(F.struct("sum", "grade", "words", "dense", "size")).alias("first")
    told = durable(told.groupBy("doc_id").agg(first).select("doc_id", "first.*", F.xxhash64("doc_id").alias("place")), "features")
    running = F.sum("size").over(Window.partitionBy(F.lit(0)).orderBy("place", "doc_id"))  # of at most ``sample`` rows
    fitting = told.select("doc_id", "place", "size").withColumn("until", running).where(F.col("until") <= sample_bytes).select("doc_id")
    told = told.join(F.broadcast(fitting), "doc_id", "left_semi").drop("place", "size").toArrow()
    if not told.num_rows:
        return None
    # batches come back in any order; the fit has one of its own
    told = told.sort_by([("doc_id", "ascending")]).combine_chunks()
    grades = told.column("grade").to_numpy().astype(np.int64)
    dense = np.frombuffer(b"".join(told.column("dense").to_pylist()), "<f4").reshape(len(grades), -1)
    words = [np.frombuffer(x, "<i4") for x in told.column("words").to_pylist()]
    del told
    model = CumulativeLink.fit(words, dense, grades, top)
    del words, dense
    pa.default_memory_pool().release_unused()
    return model


def _tails(texts: pa.Array, weights: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade >= j), j = 1..top, of each text."""
    hashed, scores = worker_cache("token features", Hashed), []
    for text in texts.to_pylist():
        w, s, e = features(text, hashed)
        scores.append(weights[w].sum() + weights[WORDS : WORDS + SHAPES] @ s + weights[WORDS + SHAPES :] @ e)
    return CumulativeLink(weights, thresholds).at_least(np.array(scores, float))


def rate(docs: DataFrame, model: CumulativeLink | None, top: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` of every row of ``docs`` (text), expected_grade, and tail: P(grade >= j) for j = 1..top."""
    if model is None:
        return docs.select(*keep, F.lit(float(top)).alias("expected_grade"), F.array(*[F.lit(1.0)] * top).alias("tail"))
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, len(keep)):
            tail = _tails(batch.column(len(keep)), *shared.value)
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(tail.sum(1)), pa.array(list(tail), pa.list_(pa.float64()))], names=[*batch.schema.names[:-1], "expected_grade", "tail"])

    given = docs.select(*keep, F.col("text").cast("string").alias("__text"))
    schema = StructType([*given.drop("__text").schema, StructField("expected_grade", DoubleType()), StructField("tail", ArrayType(DoubleType()))])
    return given.mapInArrow(run, schema)


def grades_of(labels: DataFrame) -> DataFrame:
    """doc_id, grade of rated documents: 0 poor, 1 well written but toxic, 2 well written and clean."""
    grade: Column = F.when(F.col("quality") == 0, 0).when((F.col("quality") == 1) & (F.col("toxic") == 1), 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select("doc_id", grade.alias("grade"))


#: A document stays if it is more likely of the highest grade than not.
KEEP_TAIL = 0.5


def select(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that the classifier, fitted on ``labels`` (doc_id, quality, toxic), keeps, with all their columns.

    One pass rates a text and lets its row go or stay: no row is looked up again.
    """
    model = fit(docs, grades_of(labels), 2, sample)
    if model is None:
        return docs
    shared, text = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds)), docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            kept = _tails(batch.column(text), *shared.value)[:, 1] >= KEEP_TAIL
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
