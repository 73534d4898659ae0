"""LM scoring: a log-bilinear neural model, trained in numpy by noise-contrastive estimation on every token of the training corpus.

Tokens are runs of characters other than 0x20 and 0x09 to 0x0D, A-Z in lower case, and one end per text.  The model predicts
units: each of the ``units`` most frequent words has one of its own, with its own vectors as target and as context; all other
words share the units of their classes, fixed in advance (short words by hash, others by hash of their last three bytes, the
end by itself).  The context is the token before, by its unit, and the last token with a character beyond ASCII among the
``MEMORY`` before, by its mark (without one, the token before the last, by its).  The score of a unit is the product of its
feature vector with the sum of the two context vectors, each through the matrix of its position, plus a bias.

    log10 p(word | context) = log10 P(unit | context) + log10((c + 0.1) / (sum of (c + 0.1) over the unit's words + 0.1))

where c is the word's count, the last 0.1 stands for all words not seen in training, and a unit of one word has no second
part.  The base score is the smoothed unigram's.

One pass over the training texts counts words; counts are aggregated by shuffle and grow with the corpus.  A second pass
trains: every task starts from the same parameters, see ``train``, and goes once through its own tokens, in batches of which each meets
``NOISE`` units drawn by their share, by gradient steps on the noise-contrastive objective.  The tasks' parameters are averaged,
row by row, weighted by how often a row was met, in a tree of fan-in ``FAN``: no token is sampled away, and what a task, a node
of the tree or the driver holds has a fixed size.  Batched matrix products over all contexts then give the normalising sums, so
scores are exact log-probabilities.  A third pass scores.

The most frequent words (at most ``top`` of at most ``LONGEST`` bytes each, fixed bounds) go to all tasks; counts of all others
are joined to the documents' rare words by shuffle.

Defined cases: a null text counts as empty and has its end only; the hash of a null id is that of the empty text; rows that
repeat an id are rows of their own; without any training row all counts are 0; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import durable, slices

#: Classes: 0 is the end of a text, then short words by hash, then longer ones by the hash of their ending.
SHORT, ENDINGS = 95, 96
#: Marks: 0 is the end, then words in ASCII by their last byte, then others.
PLAIN, MARKED = 5, 6
COARSE = 1 + PLAIN + MARKED
#: How many tokens back a marked word still counts.
MEMORY = 16
CLASSES = 1 + SHORT + ENDINGS
#: Words with vectors of their own, and words whose counts every task holds, at most.
UNITS, TOP = 4096, 400_000
#: Words of more bytes are always counted by shuffle.
LONGEST = 64
DIM, BATCH, NOISE = 24, 2048, 96
#: Texts that the common beginning is made from, about.
WARM = 1000
#: Tasks whose parameters one node of the tree averages.
FAN = 16
_FLUSH = 400_000
_SMOOTH = 0.1


def word_class(word: bytes) -> int:
    if not word:
        return 0
    return 1 + zlib.crc32(word) % SHORT if len(word) <= 4 else 1 + SHORT + zlib.crc32(word[-3:]) % ENDINGS


def _class_of(word: Column) -> Column:
    """``word_class`` of a column of words."""
    short = F.crc32(word) % SHORT + 1
    return F.when(F.length(word) == 0, 0).when(F.length(word) <= 4, short).otherwise(F.crc32(F.substring(word, -3, 3)) % ENDINGS + 1 + SHORT)


def word_mark(word: bytes) -> int:
    if not word:
        return 0
    if word.isascii():
        return 1 + word[-1] % PLAIN
    at = next(i for i, b in enumerate(word) if b >= 0x80)
    return 1 + PLAIN + word[min(at + 1, len(word) - 1)] % MARKED


class Lexicon(dict):
    """Word to a running number, with the number's unit and mark; forgets all but the first ``keep`` words when full.

    The first ``units`` of ``words`` have units of their own, which follow those of the classes.
    """

    def __init__(self, words: Iterable[bytes] = (), units: int = 0, most: int = 600_000):
        super().__init__()
        words = list(words)
        self.names: list[bytes] = []
        self.units = np.zeros(most + len(words) + 200_000, np.int32)
        self.marks = np.zeros(len(self.units), np.int8)
        for w in words:
            self[w]
        self.units[:units] = CLASSES + np.arange(units)
        self.keep, self.most = len(self.names), most + len(self.names)

    def __missing__(self, word: bytes) -> int:
        n = len(self.names)
        if n == len(self.units):
            self.units = np.concatenate([self.units, np.zeros(n, np.int32)])
            self.marks = np.concatenate([self.marks, np.zeros(n, np.int8)])
        self.units[n] = word_class(word)
        self.marks[n] = word_mark(word)
        self.names.append(word)
        self[word] = n
        return n

    def trim(self) -> None:
        if len(self.names) > self.most:
            for word in self.names[self.keep :]:
                del self[word]
            del self.names[self.keep :]

    def numbers(self, flat: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, flat), np.int64, len(flat))


def _tokens(texts: list[bytes | None]) -> tuple[list[bytes], np.ndarray]:
    """All tokens of the texts, the empty one after each text for its end, and each text's number of tokens."""
    flat: list[bytes] = []
    sizes = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = text.lower().split() if text else []
        flat += words
        flat.append(b"")
        sizes[i] = len(words) + 1
    return flat, sizes


def contexts(units: np.ndarray, marks: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each token's context: the unit before it, and the mark that it remembers."""
    before = np.concatenate([[0], units[:-1]])
    second = np.concatenate([[0, 0], marks])[: len(marks)].astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    before[starts] = second[starts] = 0
    place = np.arange(len(marks))
    last = np.concatenate([[-1], np.maximum.accumulate(np.where(marks > PLAIN, place, -1))[:-1]])
    near = (last >= np.repeat(starts, sizes)) & (last >= place - MEMORY)
    return before, np.where(near, marks[last], second)


def _gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words."""
    words: Counter[bytes] = Counter()

    def told() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(words), pa.binary()), pa.array(list(words.values()), pa.int64())], names=["word", "n"])
        words.clear()
        return out

    for part in slices(batches, 0):
        words.update(_tokens(part.column(0).to_pylist())[0])
        if len(words) >= _FLUSH:
            yield told()
    yield told()


# -- the model

#: Names of the parameters, in the order in which tasks tell them.
PARAMETERS = ("features", "before", "second", "c1", "c2", "bias")


def start(share: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """The parameters that all tasks start from: the unigram, and small vectors."""
    rng = np.random.default_rng(seed)
    draw = lambda n: rng.normal(0, 0.1, (n, DIM)).astype(np.float32)
    return {
        "features": draw(len(share)), "before": draw(len(share)), "second": draw(COARSE), "c1": np.eye(DIM, dtype=np.float32), "c2": np.eye(DIM, dtype=np.float32),
        "bias": np.log(share).astype(np.float32)[:, None],
    }


def slopes(p: dict[str, np.ndarray], target: np.ndarray, before: np.ndarray, second: np.ndarray, noise: np.ndarray, log_noise: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Slopes of the noise-contrastive objective of a batch: (rows met, their slopes) of each parameter.

    Every token is told apart from each of the ``noise`` units: the objective is the sum over tokens of log s(x) of the target
    and of log s(-x) of the noise, x being the score less ``log_noise``, the logarithm of how often the unit is drawn.
    """
    qb, qs = p["before"][before], p["second"][second]
    h = qb @ p["c1"] + qs @ p["c2"]
    own, other = p["features"][target], p["features"][noise]
    x = (h * own).sum(1) + p["bias"][target, 0] - log_noise[target]
    up = 1 / (1 + np.exp(np.clip(x, -30, 30)))
    y = h @ other.T
    y += p["bias"][noise, 0] - log_noise[noise]
    down = -1 / (1 + np.exp(-np.clip(y, -30, 30)))
    back = up[:, None] * own + down @ other
    to_before, to_second = back @ p["c1"].T, back @ p["c2"].T

    def met(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(rows, kind="stable")
        first = np.flatnonzero(np.diff(rows[order], prepend=-1))
        return rows[order][first], np.add.reduceat(values[order], first)

    both = np.concatenate([target, noise])
    all_rows = np.arange(DIM)
    return {
        "features": met(both, np.concatenate([up[:, None] * h, down.T @ h])), "before": met(before, to_before), "second": met(second, to_second),
        "c1": (all_rows, qb.T @ back), "c2": (all_rows, qs.T @ back), "bias": met(both, np.concatenate([up, down.sum(0)])[:, None]),
    }


class Trainer:
    """Gradient steps with a rate for each row that falls as its slopes add up; counts how often each row was met."""

    def __init__(self, p: dict[str, np.ndarray], share: np.ndarray, seed: int, rate: float = 0.05):
        self.p = {k: v.copy() for k, v in p.items()}
        self.squares = {k: np.full(len(v), 1e-3, np.float32) for k, v in p.items()}
        self.met = {k: np.zeros(len(v)) for k, v in p.items()}
        self.rng, self.rate = np.random.default_rng(seed), rate
        self.steps = np.cumsum(share)
        self.log_noise = np.log(NOISE * share).astype(np.float32)

    def step(self, target: np.ndarray, before: np.ndarray, second: np.ndarray) -> None:
        noise = np.minimum(np.searchsorted(self.steps, self.rng.random(NOISE)), len(self.steps) - 1)
        for k, (rows, slope) in slopes(self.p, target, before, second, noise, self.log_noise).items():
            self.squares[k][rows] += (slope**2).mean(1)
            self.p[k][rows] += self.rate * (0.3 if k in ("bias", "c1", "c2") else 1.0) * slope / np.sqrt(self.squares[k][rows])[:, None]
            self.met[k][rows] += 1

    def told(self) -> bytes:
        """Sums for the average: each row times how often it was met (a little for rows never met), and the weights."""
        return b"".join(np.concatenate([(self.p[k] * (self.met[k] + 1e-6)[:, None]).ravel(), self.met[k] + 1e-6]).astype("<f4").tobytes() for k in PARAMETERS)


def averaged(told: bytes, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    flat, out, at = np.frombuffer(told, "<f4").astype(float), {}, 0
    for k in PARAMETERS:
        n, d = like[k].shape
        rows, weight = flat[at : at + n * d].reshape(n, d), flat[at + n * d : at + n * d + n]
        out[k] = (rows / weight[:, None]).astype(np.float32)
        at += n * d + n
    return out


def _added(table: pa.Table) -> pa.Table:
    total = None
    for told in table.column("told"):
        own = np.frombuffer(told.as_buffer(), "<f4")
        total = own.astype(float) if total is None else np.add(total, own, out=total)
    return pa.table({"node": table.column("node").slice(0, 1), "told": pa.array([total.astype("<f4").tobytes()], pa.binary())})


def log_sums(p: dict[str, np.ndarray]) -> np.ndarray:
    """ln of the sum over all units of exp(score), of each context (mark, unit before)."""
    first, second = p["before"] @ p["c1"], p["second"] @ p["c2"]
    out = np.zeros((len(second), len(first)))
    for m in range(len(second)):
        for at in range(0, len(first), 512):
            score = (first[at : at + 512] + second[m]) @ p["features"].T + p["bias"][:, 0]
            most = score.max(1)
            out[m, at : at + 512] = most + np.log(np.exp(score - most[:, None]).sum(1, dtype=np.float64))
    return out


@dataclass(frozen=True)
class Model:
    """What scoring needs: words with known counts (those with units first), parameters, normalising sums, sums of the units' words."""

    names: list[bytes]
    counts: np.ndarray
    units: int
    parameters: dict[str, np.ndarray]
    log_sum: np.ndarray
    log_whole: np.ndarray
    base_whole: float
    train_tokens: int
    #: whether no word has a count besides ``names``, and else the least count that those have
    complete: bool
    least: int | None

    def log10_units(self, target: np.ndarray, before: np.ndarray, second: np.ndarray) -> np.ndarray:
        """log10 P(target | context)."""
        p = self.parameters
        h = (p["before"] @ p["c1"])[before] + (p["second"] @ p["c2"])[second]
        score = np.einsum("ij,ij->i", h, p["features"][target]) + p["bias"][target, 0]
        return (score - self.log_sum[second, before]) / np.log(10)


def _given(docs: DataFrame, held_out_of: int) -> DataFrame:
    held_out = (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % held_out_of) == 0
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), held_out.alias("held_out"), F.col("text").cast("binary").alias("text"))


def _passed(texts: DataFrame, names: list[bytes], share: np.ndarray, initial: dict[str, np.ndarray], seed: int, rate: float, batch: int) -> DataFrame:
    """node, told: what each task's trainer tells after one pass over its ``texts`` (text)."""
    known = texts.sparkSession.sparkContext.broadcast((names, share, initial))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        names, share, initial = known.value
        task = TaskContext.get().partitionId()
        lexicon, trainer = Lexicon(names, len(names), most=300_000), Trainer(initial, share, seed * 1_000_003 + task, rate)
        held: list[list[np.ndarray]] = []
        for part in slices(batches, 0):
            flat, sizes = _tokens(part.column(0).to_pylist())
            numbers = lexicon.numbers(flat)
            units = lexicon.units[numbers].astype(np.int64)
            held.append([units, *contexts(units, lexicon.marks[numbers], sizes)])
            lexicon.trim()
            if sum(len(x[0]) for x in held) >= batch:
                cells = [np.concatenate(x) for x in zip(*held, strict=True)]
                whole = len(cells[0]) // batch * batch
                for at in range(0, whole, batch):
                    trainer.step(*[c[at : at + batch] for c in cells])
                held = [[c[whole:] for c in cells]]
        if held and len(held[0][0]):
            trainer.step(*[np.concatenate(x) for x in zip(*held, strict=True)])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array([trainer.told()], pa.binary())], names=["node", "told"])

    return durable(texts.select("text").mapInArrow(run, "node long, told binary"), "parameters")


def train(texts: DataFrame, names: list[bytes], share: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """The parameters after one pass over ``texts`` (row, text); ``names`` are the words with units, ``share`` the units' shares.

    About ``WARM`` texts, chosen by the hash of their rows, first turn random vectors into a common beginning in one task, so
    that the tasks' vectors point the same way and can be averaged; all texts, those included, then train.
    """
    initial = start(share, seed)
    spread = max(1, texts.count() // WARM)
    first = texts.where(F.pmod(F.xxhash64("row"), F.lit(spread)) == 0).select("text").repartition(1)
    row = _passed(first, names, share, initial, seed, 0.15, BATCH // 4).first()
    if row:
        initial = averaged(bytes(row["told"]), initial)
    told = _passed(texts, names, share, initial, seed + 1, 0.05, BATCH)
    nodes = told.count()
    while nodes > 1:
        told = durable(told.withColumn("node", F.floor(F.col("node") / FAN)).groupBy("node").applyInArrow(_added, "node long, told binary"), "parameters")
        nodes = told.count()
    row = told.first()
    return averaged(bytes(row["told"]), initial) if row else initial


def fit(docs: DataFrame, held_out_of: int = 10, top: int = TOP, units: int = UNITS) -> tuple[Model, DataFrame]:
    """The model of the rows of ``docs`` that are not held out, and the counts (word, n) of all their words."""
    texts = _given(docs, held_out_of).where(~F.col("held_out")).select("row", "text")
    words = durable(texts.select("text").mapInArrow(_gather, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    per_class = words.groupBy(_class_of(F.col("word")).cast("int").alias("class")).agg(F.count("*").alias("distinct"), F.sum("n").alias("n")).collect()
    train_tokens, distinct = sum(r["n"] for r in per_class), sum(r["distinct"] for r in per_class)
    # the least count that at most ``top`` words have
    short = words.where(F.length("word") <= LONGEST)
    least, n = None, 0
    for r in short.groupBy("n").count().orderBy(F.col("n").desc()).limit(top + 1).collect():
        if n + r["count"] > top:
            break
        n += r["count"]
        least = r["n"]
    listed = short.where(F.col("n") >= least).orderBy(F.col("n").desc(), "word").toArrow() if least is not None else pa.table({"word": pa.array([], pa.binary()), "n": pa.array([], pa.int64())})
    names, counts = listed.column("word").to_pylist(), listed.column("n").to_numpy().astype(float)
    # the end is a class of its own; it may stand anywhere but among the words with units
    own = [i for i, w in enumerate(names[: units + 1]) if w][:units]
    chosen = set(own)
    rest = [i for i in range(len(names)) if i not in chosen]
    names, counts = [names[i] for i in own + rest], counts[own + rest]
    units = len(own)

    whole, seen = np.full(CLASSES, _SMOOTH), np.zeros(CLASSES)
    for r in per_class:
        whole[r["class"]] += r["n"] + _SMOOTH * r["distinct"]
        seen[r["class"]] += r["n"]
    for w, c in zip(names[:units], counts[:units], strict=True):
        whole[word_class(w)] -= c + _SMOOTH
        seen[word_class(w)] -= c
    if distinct:
        whole[0] -= _SMOOTH  # the end has no unseen kin
    share = np.concatenate([seen, counts[:units]]) + _SMOOTH
    share /= share.sum()
    p = train(texts, names[:units], share)
    log_whole = np.concatenate([np.log10(np.maximum(whole, _SMOOTH)), np.log10(counts[:units] + _SMOOTH)])
    base_whole = float(np.log10(train_tokens + _SMOOTH * (distinct + 1)))
    return Model(names, counts, units, p, log_sums(p), log_whole, base_whole, train_tokens, len(names) == distinct, least), words


def score(docs: DataFrame, held_out_of: int = 10, top: int = TOP, units: int = UNITS) -> DataFrame:
    """doc_id, row, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs`` (doc_id, text).

    The model learns from the rows whose crc32(doc_id as text) modulo ``held_out_of`` is not 0.
    """
    return scored(docs, *fit(docs, held_out_of, top, units), held_out_of)


def scored(docs: DataFrame, model: Model, words: DataFrame, held_out_of: int = 10) -> DataFrame:
    """As ``score``, by a model and the counts (word, n) that it was made from."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    complete = model.complete

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        lexicon = Lexicon(model.names, model.units)
        top_n = len(model.names)
        log_count = np.log10(np.append(model.counts, 0.0) + _SMOOTH)
        schema = pa.schema([("key", pa.binary()), ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("times", pa.int64())])
        for part in slices(batches, 3):
            flat, sizes = _tokens(part.column(3).to_pylist())
            numbers = lexicon.numbers(flat)
            target = lexicon.units[numbers].astype(np.int64)
            rare = numbers >= top_n
            own = np.where(rare & (not complete), 0.0, log_count[np.where(rare, top_n, numbers)])
            starts = np.cumsum(sizes) - sizes
            base = np.add.reduceat(own, starts) - sizes * model.base_whole
            learnt = np.add.reduceat(own + model.log10_units(target, *contexts(target, lexicon.marks[numbers], sizes)) - model.log_whole[target], starts)
            seen = np.add.reduceat((~rare).astype(np.int64), starts)
            rows = part.column(1).to_numpy()
            n = len(sizes)
            # a key that no word can be, one for each row
            yield pa.RecordBatch.from_arrays([pa.array([b" %d" % r for r in rows.tolist()], pa.binary()), part.column(1), part.column(0), part.column(2), pa.array(sizes), pa.array(seen), pa.array(base), pa.array(learnt), pa.array(np.zeros(n, np.int64))], schema=schema)
            if not complete:
                where = np.flatnonzero(rare)
                pairs, times = np.unique(np.repeat(np.arange(n), sizes)[where] << 32 | numbers[where], return_counts=True)
                named = [lexicon.names[i] for i in (pairs & (2**32 - 1)).tolist()]
                none = lambda kind, k=len(pairs): pa.nulls(k, kind)
                yield pa.RecordBatch.from_arrays([pa.array(named, pa.binary()), pa.array(rows[pairs >> 32]), none(pa.int64()), none(pa.bool_()), none(pa.int64()), none(pa.int64()), none(pa.float64()), none(pa.float64()), pa.array(times)], schema=schema)
            lexicon.trim()

    given = _given(docs, held_out_of)
    parts = given.select("doc_id", "row", "held_out", "text").mapInArrow(run, "key binary, row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, times long")
    if complete:
        joined = parts.withColumn("n", F.lit(None).cast("long"))
    else:
        rest = words if model.least is None else words.where((F.col("n") < model.least) | (F.length("word") > LONGEST))
        joined = parts.join(rest.select(F.col("word").alias("key"), "n"), "key", "left")
    rare = F.when(F.col("times") > 0, F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(_SMOOTH))).otherwise(0.0)
    rare_known = F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)
    out = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        F.sum(F.coalesce("n_known", F.lit(0)) + rare_known).alias("n_known"), F.sum(F.coalesce("base", F.lit(0.0)) + rare).alias("base_score"), F.sum(F.coalesce("score", F.lit(0.0)) + rare).alias("score"),
    )
    return out.select("doc_id", "row", "held_out", "n_tokens", "n_known", F.lit(model.train_tokens).cast("long").alias("train_tokens"), "base_score", "score")
