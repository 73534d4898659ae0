from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing
from tests.llm.conftest import TEXTS


def whole(pieces, library, texts):
    """Pieces hold every id once, in order; sequences are gapless and short enough."""
    by_row, by_sequence = {}, {}
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"] > 0
        by_row.setdefault(p["row"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    found = []
    for ps in by_row.values():
        ps.sort(key=lambda p: p["start"])
        assert [p["start"] for p in ps] == [0, *itertools.accumulate(p["length"] for p in ps)][:-1]
        ids = np.frombuffer(b"".join(p["ids"] for p in ps), "<u4")
        assert all(p["doc_tokens"] == len(ids) for p in ps)
        found.append((ps[0]["doc_id"], ids.tolist()))
    want = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in texts]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(found, key=key) == sorted(want, key=key)
    padding = 0
    for ps in by_sequence.values():
        ps.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in ps] == [0, *itertools.accumulate(p["length"] for p in ps)][:-1]
        n = sum(p["length"] for p in ps)
        assert n <= 2048
        padding += 0 if n & (n - 1) == 0 else 2048 - n
    return padding


def test_every_id_once(docs, path):
    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    for frame in (docs, docs.repartition(3), docs.coalesce(1)):
        whole(packing.pack(frame, path("word_bpe_49k.json")).collect(), library, [*TEXTS, TEXTS[0]])


def test_real_documents_with_little_padding(spark, path):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = packing.pack(frame, path("word_bpe_49k.json")).collect()
    padding = whole(pieces, Tokenizer.from_file(path("word_bpe_49k.json")), [(r["doc_id"], r["text"]) for r in frame.collect()])
    assert padding < 0.01 * sum(p["length"] for p in pieces)


def test_digest_in_the_query(spark, sf, path):
    from tidemark.llm.queries import op1_packing

    raw = {(p["sequence_id"], p["offset"]): zlib.crc32(p["ids"]) for p in packing.pack(spark.read.parquet(f"{sf}/documents.parquet"), path("word_bpe_49k.json")).collect()}
    assert {(r["sequence_id"], r["offset"]): r["ids_crc32"] for r in op1_packing(spark, sf).collect()} == raw


def test_no_documents(none, path):
    assert packing.pack(none, path("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_program_finds_the_least_cost(seed):
    rng = random.Random(seed)
    n, length = rng.randrange(20, 90), 16
    sentences = np.array(sorted(rng.sample(range(1, n), n // 5)))
    documents = np.array(sorted({*rng.sample(range(1, n), n // 9), n}))
    costs = {"sequence_cost": 2.0, "sentence_cost": 1.0, "word_cost": 3.0, "stride": 4}
    ends = packing.cut(n, documents, sentences, length, **costs)

    def price(bounds):
        total = 0.0
        for a, b in zip([0, *bounds], bounds, strict=False):
            size = b - a
            total += 2.0 + (0 if size & (size - 1) == 0 else length - size) + (0 if b in documents else 1.0 if b in sentences else 3.0)
        return total

    # all cuts that the program may make, tried the plain way; short powers of two only serve in the tail
    offered = {0, *documents.tolist(), *sentences.tolist(), *range(max(0, n - length), n + 1)}
    for a, b in itertools.pairwise(sorted({0, *documents.tolist(), *sentences.tolist()})):
        offered.update(range(a + 4, b, 4))
    at = sorted(offered)
    best = {0: 0.0}
    for j in at[1:]:
        options = []
        for i in at:
            size = j - i
            if 0 < size <= length and i in best:
                exact = size & (size - 1) == 0 and (size >= 64 or j >= n - length)
                options.append(best[i] + 2.0 + (0 if exact else length - size) + (0 if j in documents else 1.0 if j in sentences else 3.0))
        best[j] = min(options)
    assert ends[-1] == n and max(np.diff([0, *ends])) <= length
    assert price(ends.tolist()) <= best[n] + 1e-9


@pytest.mark.parametrize("text", ["it's we're 'sa ''s x'll", "a  b \n c ", "ÀÉÎ × ÷ ß", "²³¼ ª 日本", "\x1ca\x85b\xa0", "İΣΑΣ", "'", "don't <|x", "e\u0301", None, ""])
def test_ids_are_the_librarys(path, text):
    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    words = packing.WordTokens(path("word_bpe_49k.json"), most=3)  # forgets all the time
    for _ in range(2):
        assert np.frombuffer(words.encode([text, "one two three four five six"])[0], "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids
