"""Packing: order-preserving dynamic programming over cuts at document and sentence ends, with monotone-queue transitions.

Documents become token ids (each followed by an end id) and lie end to end in the order of the table's partitions.  The
stream is cut into windows of at most ``length`` ids, one sequence each.  A window costs its padding (none if its length is
a power of two, else what it lacks to ``length``), a fixed cost per sequence, and a penalty for what its end truncates:
nothing at a document's end, little at a sentence's, more elsewhere.  f(j) = min f(i) + cost(i, j) over i within ``length``
of j: the padding is linear in the positions, so a monotone queue gives the best i in constant time, and the powers of two
are a few extra transitions.  Cuts elsewhere are offered every ``stride`` ids where sentences are long, and at every id of
a run's tail, so that a run of ``run_ids`` ids, the unit of the program, ends without padding.

Memory is bounded by a run and by the longest document.  Partitions pack on their own: there is no shuffle.  Sequence ids
are the partition's number times 2**33 plus a counter, so that a recomputed task gives the same rows.

Defined cases: a null text counts as empty (its end id only); a repeated row is a document of its own, told apart by
``row``; an empty table gives no piece; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, worker_cache

SCHEMA = "doc_id long, row long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

#: Texts of these characters only need neither composition nor a general regular expression.
PLAIN = re.compile("[^\t-\r -~À-ÿ]")


class WordTokens:
    """Ids (bytes, little-endian unsigned 32-bit) of the words of a lower-casing BPE with word ends, from the library and remembered."""

    _words = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \t-\ra-z0-9ß-öø-ÿ]+")

    def __init__(self, path: str, most: int = 800_000):
        from tokenizers import Tokenizer

        self.library, self.most, self.known = Tokenizer.from_file(path), most, {}
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_sentence = np.zeros_like(self.ends_word)
        for word, i in vocab.items():
            if word.endswith("</w>"):
                self.ends_word[i] = True
                self.ends_sentence[i] = not any(c.isalnum() for c in word[:-4]) and any(c in ".!?" for c in word[:-4])

    def _learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > self.most:
            self.known.clear()
        words = [w for w in words if w not in self.known]
        for at in range(0, len(words), 20_000):
            part = words[at : at + 20_000]
            ids = np.array(self.library.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(self.ends_word[ids]) + 1
            if len(stops) != len(part):  # a word that doesn't stay one word among others
                self.known.update((w, np.array(self.library.encode(w, add_special_tokens=False).ids, "<u4").tobytes()) for w in part)
                continue
            raw, last = ids.tobytes(), 0
            for w, stop in zip(part, (stops * 4).tolist(), strict=True):
                self.known[w] = raw[last:stop]
                last = stop

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """What the library's encode(text, add_special_tokens=False) gives for each text."""
        split, plain, new = [], [], set()
        for text in texts:
            fast = not text or not (PLAIN.search(text) or "<|" in text)
            words = self._words.findall(text.lower()) if fast and text else []
            split.append(words)
            plain.append(fast)
            new.update(words)
        new = new.difference(self.known)
        if new:
            before = len(self.known)
            self._learn(new)
            if len(self.known) < before + len(new):  # forgotten meanwhile
                self._learn({w for words in split for w in words}.difference(self.known))
        get = self.known.__getitem__
        return [b"".join(map(get, words)) if fast else np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes() for text, words, fast in zip(texts, split, plain, strict=True)]


def cut(n: int, documents: np.ndarray, sentences: np.ndarray, length: int = 2048, sequence_cost: float = 8, sentence_cost: float = 1, word_cost: float = 8, stride: int = 32) -> np.ndarray:
    """The best window ends in a stream of n ids: ``documents`` and ``sentences`` are the positions after which those end (the last document's is n)."""
    free = np.zeros(n + 1, bool)
    free[documents] = True
    soft = np.zeros(n + 1, bool)
    soft[sentences] = True
    offered = free | soft
    offered[0] = True
    at = np.flatnonzero(offered)
    wide = np.flatnonzero(np.diff(at) > stride)
    for a, b in zip(at[wide].tolist(), at[wide + 1].tolist(), strict=True):
        offered[a + stride : b : stride] = True
    offered[max(0, n - length) :] = True
    at = np.flatnonzero(offered)
    penalty = np.where(free[at], 0.0, np.where(soft[at], sentence_cost, word_cost)) + sequence_cost
    # predecessors at a power of two, as (j, i) by j
    later, earlier = [], []
    power = length
    while power:
        # short windows only serve to end a run
        j = np.arange(np.searchsorted(at, power if power >= 64 else max(power, n - length)), len(at))
        i = np.searchsorted(at, at[j] - power)
        hit = np.flatnonzero(at[i] == at[j] - power)
        later.append(j[hit])
        earlier.append(i[hit])
        power //= 2
    later, earlier = np.concatenate(later), np.concatenate(earlier)
    order = np.argsort(later, kind="stable")
    jumps_to, jumps_from = [*later[order].tolist(), len(at)], earlier[order].tolist()
    where, fee = at.tolist(), penalty.tolist()
    best, key, back = [0.0] * len(at), [0.0] * len(at), [0] * len(at)
    queue = deque([0])
    k = 0
    for j in range(1, len(at)):
        here = where[j]
        while where[queue[0]] < here - length:
            queue.popleft()
        i = queue[0]
        cost = key[i] + length - here
        while jumps_to[k] == j:
            if best[jumps_from[k]] < cost:
                i, cost = jumps_from[k], best[jumps_from[k]]
            k += 1
        best[j] = cost = cost + fee[j]
        back[j] = i
        key[j] = cost = cost + here
        while queue and key[queue[-1]] >= cost:
            queue.pop()
        queue.append(j)
    ends, j = [], len(at) - 1
    while j:
        ends.append(where[j])
        j = back[j]
    return np.array(ends[::-1], np.int64)


def _pieces(ids: list[int | None], rows: list[int], coded: list[bytes], end: bytes, first: int, ends_sentence: np.ndarray, options: dict) -> tuple[pa.RecordBatch, int]:
    raw = b"".join(x for c in coded for x in (c, end))
    stream = np.frombuffer(raw, "<u4")
    stops = np.cumsum([len(c) // 4 + 1 for c in coded])
    starts = np.concatenate([[0], stops[:-1]])
    ends = cut(len(stream), stops, np.flatnonzero(ends_sentence[stream]) + 1, **options)
    bounds = np.union1d(np.concatenate([[0], ends]), stops)
    begin, size = bounds[:-1], np.diff(bounds)
    doc = np.searchsorted(stops, begin, side="right")
    window = np.searchsorted(ends, begin, side="right")
    opened = np.concatenate([[0], ends])[window]
    binary = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(raw)])
    columns = [
        pa.array(ids, pa.int64()).take(pa.array(doc)), pa.array(np.asarray(rows, np.int64)[doc]), pa.array(begin - starts[doc]), pa.array(size),
        binary, pa.array((stops - starts)[doc]), pa.array(first + window), pa.array(begin - opened),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]), len(ends)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = 2048, run_ids: int = 1 << 20, **costs: float) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text): doc_id, row, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a tokenizer file; ``costs`` are those of ``cut``.
    """
    end, options = struct.pack("<I", end_id), {"length": length, **costs}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = worker_cache(f"words of {tokenizer}", lambda: WordTokens(tokenizer))
        first = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        ids: list[int | None] = []
        rows: list[int] = []
        coded: list[bytes] = []
        held = 0
        for part in slices(batches, 2):
            ids += part.column(0).to_pylist()
            rows += part.column(1).to_pylist()
            new = words.encode(part.column(2).to_pylist())
            coded += new
            held += sum(map(len, new)) // 4
            if held >= run_ids:
                out, n = _pieces(ids, rows, coded, end, first, words.ends_sentence, options)
                yield out
                first, ids, rows, coded, held = first + n, [], [], [], 0
        if ids:
            yield _pieces(ids, rows, coded, end, first, words.ends_sentence, options)[0]

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(run, SCHEMA)
