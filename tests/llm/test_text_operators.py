"""Quality classifier, LM scoring, mixing, exact dedup, near-dedup, token counts against plain versions."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import exactdedup, lblm, mixing, probminhash, quality, tokencount
from tests.llm.conftest import TEXTS

ROWS = [*TEXTS, TEXTS[0]]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -- 3: quality classifier


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    grades = quality.grades_of(labels)
    fold = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    model = quality.fit(docs, grades.where(~fold), 2)
    rated = quality.rate(docs, model, 2, ("doc_id",)).join(grades.where(fold), "doc_id").collect()
    good = [r["tail"][1] >= quality.KEEP_TAIL for r in rated if r["grade"] == 2]
    poor = [r["tail"][0] >= 0.5 for r in rated if r["grade"] == 0]
    assert np.mean(good) > 0.95 and np.mean(poor) < 0.2
    assert all(0 <= r["tail"][1] <= r["tail"][0] <= 1 and abs(r["expected_grade"] - sum(r["tail"])) < 1e-9 for r in rated)


def test_sample_bounds_the_fit_only(spark):
    d = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, quality.grades_of(labels), 2, sample=40)
    assert quality.rate(docs, model, 2, ("doc_id",)).count() == docs.count()


def test_odd_documents_are_rated(spark, docs, none):
    ratings = spark.createDataFrame([(0, 2), (8, 0), (8, 1), (9, 1), (None, 1), (77, 2), (5, None)], "doc_id long, grade int")
    model = quality.fit(docs, ratings, 2)
    assert quality.rate(docs, model, 2, ("doc_id", "row")).count() == len(ROWS)
    assert quality.rate(none, model, 2, ("doc_id",)).count() == 0
    assert quality.fit(none, ratings, 2) is None
    assert {r["expected_grade"] for r in quality.rate(docs, None, 2).collect()} == {2.0}
    labels = spark.createDataFrame([(0, 1, 0), (5, 1, 0), (8, 0, 0), (9, 1, 1)], "doc_id long, quality int, toxic int")
    kept = quality.select(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() <= len(ROWS)


def test_thresholds_ascend_and_gradients_agree():
    rng = np.random.default_rng(0)
    words = [rng.choice(50, 8, replace=False) + (0 if g == 0 else 100 * g) for g in rng.integers(0, 4, 300)]
    grades = np.array([int(w.min() >= 100) + int(w.min() >= 200) + int(w.min() >= 300) for w in words])
    m = quality.CumulativeLink.fit(words, np.zeros((300, quality.SIZE - quality.WORDS)), grades, 3)
    assert (np.diff(m.thresholds) >= 0).all()
    scores = np.array([m.weights[w].sum() for w in words])
    assert (m.at_least(scores).sum(1).round() == grades).mean() > 0.95


def test_shape_of_the_whole_token():
    assert quality.shape("a" * 64 + "-42!") == "a-0!"
    assert quality.shape("x" * 100_000 + "Y" * 100_000) == "aA"
    long, longer = (quality.features("a" * 70 + end, quality.Hashed())[1] for end in ("", "#7"))
    assert (long != longer).any()


# -- 4: LM scoring


def plain_base(rows):
    def tokens(t):
        return [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), ""]

    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    count = collections.Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    base = lambda t: sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t))
    return [(i, held(i), len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), n, base(t)) for i, t in rows]


@pytest.mark.parametrize("top", [400_000, 3, 0])
def test_base_scores(docs, top):
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in lblm.score(docs, top=top).collect()), key=key)
    for a, b in zip(got, sorted(plain_base(ROWS), key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)


def plain_contexts(words, unit):
    """(unit before, remembered mark) of each of a text's tokens."""
    out = []
    for i in range(len(words)):
        marked = [lblm.word_mark(v) for v in words[max(0, i - lblm.MEMORY) : i] if lblm.word_mark(v) > lblm.PLAIN]
        out.append((unit(words[i - 1]) if i else 0, marked[-1] if marked else lblm.word_mark(words[i - 2]) if i > 1 else 0))
    return out


def test_contexts():
    texts = [b"the caf\xc3\xa9 of a man was open late and so on we went up to it in the end at last here now", b"", b"x", b"no marks here at all"]
    flat, sizes = lblm._tokens(texts)
    lexicon = lblm.Lexicon([b"the", b"of"], 1)
    numbers = lexicon.numbers(flat)
    units, marks = lexicon.units[numbers].astype(np.int64), lexicon.marks[numbers]
    unit = lambda w: lblm.CLASSES if w == b"the" else lblm.word_class(w)
    assert units.tolist() == [unit(w) for w in flat]
    assert list(zip(*(x.tolist() for x in lblm.contexts(units, marks, sizes)), strict=True)) == [c for t in texts for c in plain_contexts([*t.split(), b""], unit)]


def test_classes_are_the_same_in_sql(spark):
    words = [b"", b"a", b"word", b"words", "Äpfel".encode(), "élève".encode(), b"x" * 100]
    got = spark.createDataFrame([(i, bytearray(w)) for i, w in enumerate(words)], "i int, word binary").select("i", lblm._class_of(F.col("word")).alias("c")).orderBy("i").collect()
    assert [r["c"] for r in got] == [lblm.word_class(w) for w in words]


def test_slopes_are_those_of_the_objective():
    rng = np.random.default_rng(1)
    share = rng.dirichlet(np.ones(20))
    p = {k: v.astype(np.float64) for k, v in lblm.start(share).items()}
    target, before, second, noise = rng.integers(0, 20, 9), rng.integers(0, 20, 9), rng.integers(0, lblm.COARSE, 9), rng.integers(0, 20, 5)
    log_noise = np.log(len(noise) * share)

    def objective():
        h = p["before"][before] @ p["c1"] + p["second"][second] @ p["c2"]
        s = h @ p["features"].T + p["bias"][:, 0] - log_noise
        return -np.log1p(np.exp(-s[np.arange(9), target])).sum() - np.log1p(np.exp(s[:, noise])).sum()

    for k, (rows, slope) in lblm.slopes(p, target, before, second, noise, log_noise).items():
        for r, own in zip(rows[:4], slope, strict=False):
            for j in range(0, p[k].shape[1], 7):
                p[k][r, j] += 1e-5
                high = objective()
                p[k][r, j] -= 2e-5
                low = objective()
                p[k][r, j] += 1e-5
                assert own[j] == pytest.approx((high - low) / 2e-5, rel=1e-4, abs=1e-6)


def test_averages_are_weighted_by_row():
    share = np.full(4, 0.25)
    p = lblm.start(share)
    a, b = lblm.Trainer(p, share, 0), lblm.Trainer(p, share, 1)
    a.p["features"][0], b.p["features"][0], a.met["features"][0], b.met["features"][0] = 1.0, 4.0, 2, 1
    table = lblm._added(pa.table({"node": pa.array([0, 0], pa.int64()), "told": pa.array([a.told(), b.told()], pa.binary())}))
    got = lblm.averaged(table.column("told")[0].as_py(), p)
    assert np.allclose(got["features"][0], 2.0, atol=1e-4) and np.allclose(got["features"][1:], p["features"][1:]) and np.allclose(got["c1"], p["c1"])


@pytest.mark.parametrize("top", [400_000, 3, 0])
def test_scores_by_definition(docs, top):
    """Every token's probability in plain loops, from the model's parameters and the counts alone."""
    model, _ = lblm.fit(docs, top=top, units=5)
    p, words = model.parameters, model.names[: model.units]
    assert model.units <= min(5, top) and (top < 5 or model.units)
    tokens = lambda t: [*(w.encode() for w in WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))), b""]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    count = collections.Counter(w for i, t in ROWS if not held(i) for w in tokens(t))
    unit = lambda w: lblm.CLASSES + words.index(w) if w in words else lblm.word_class(w)
    kin = collections.defaultdict(list)
    for w, n in count.items():
        kin[unit(w)].append(n + 0.1)
    lone = lambda u: u == 0 or u >= lblm.CLASSES
    known = {}

    def log_p(w, before, second):
        if (before, second) not in known:
            h = p["before"][before].astype(float) @ p["c1"] + p["second"][second].astype(float) @ p["c2"]
            s = p["features"].astype(float) @ h + p["bias"][:, 0]
            known[before, second] = s - np.log(np.exp(s).sum())
        u = unit(w)
        return known[before, second][u] / math.log(10) + (0 if lone(u) else math.log10((count[w] + 0.1) / (sum(kin[u]) + 0.1)))

    for r in lblm.score(docs, top=top, units=5).where("n_tokens < 100").collect():
        text = next(t for i, t in ROWS if i == r["doc_id"])
        want = sum(log_p(w, *c) for w, c in zip(tokens(text), plain_contexts(tokens(text), unit), strict=True))
        assert r["score"] == pytest.approx(want, abs=2e-4)


def test_model_beats_the_unigram_on_held_out_texts(spark):
    out = lblm.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert (out["s"] - out["b"]) / out["n"] > 0.15


def test_no_documents_to_score(none):
    assert lblm.score(none).count() == 0


def test_nothing_to_learn_from(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    out = lblm.score(spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string")).collect()
    assert [(r["n_known"], r["train_tokens"], r["base_score"]) for r in out] == [(0, 0, 0.0)] * 3 and all(math.isfinite(r["score"]) for r in out)


# -- 5: mixing


def poured(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """The targets as told: the excess is shared again by weight until nothing is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, full, left = dict.fromkeys(names, 0.0), set(), share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        rest = left - sum(target[s] for s in full)
        for s in open_:
            target[s] = rest * weight[s] / sum(weight[o] for o in open_)
        over = [s for s in open_ if target[s] > most * sizes[s]]
        if not over:
            return target
        for s in over:
            target[s] = most * sizes[s]
            full.add(s)


@pytest.mark.parametrize("seed", range(5))
def test_targets(spark, seed):
    rng = np.random.default_rng(seed)
    sizes = {**{f"s{i}": int(x) for i, x in enumerate(rng.lognormal(4, 2, 7))}, None: 40, "Ω": 0}
    rows = [(s, n) for s, n in sizes.items()]
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    assert got == pytest.approx(poured(sizes))


def test_mix_emits_copies(spark, docs, none):
    sized = mixing.sizes_of(docs)
    took = mixing.with_copies(sized, mixing.plan(sized)).collect()
    assert sorted((r["doc_id"] or -1, r["size"]) for r in took) == sorted((i or -1, len(WORD.findall(t or ""))) for i, t in ROWS)
    assert all(0 <= r["copies"] <= 2 for r in took)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in took)
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))
    assert mixing.mix(none).count() == 0


def test_taken_words_come_near_their_targets(spark):
    from tidemark.llm.queries import op5_mixing

    out = op5_mixing(spark, "/root/testdata/sf0.01")
    by = out.join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r["taken"] / r["target"] - 1) < 0.05 for r in by)


# -- 7: exact dedup


def plain_groups(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((i, t or ""))
    out = []
    for bare, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        out += [(i, keep, len(members), hashlib.sha256(bare.encode()).hexdigest()) for i, _ in members]
    return sorted(out, key=str)


def test_exact_groups(docs, none):
    for frame in (docs, docs.repartition(4)):
        got = exactdedup.dedup(frame).collect()
        assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=str) == plain_groups(ROWS)
        kept = collections.Counter(r["text_sha256"] for r in got if r["kept"])
        assert set(kept.values()) == {1} and len(kept) == len({g[3] for g in plain_groups(ROWS)})
    clean = exactdedup.without_copies(docs)
    assert clean.columns == docs.columns and clean.count() == len({g[3] for g in plain_groups(ROWS)})
    assert exactdedup.dedup(none).count() == 0 and exactdedup.without_copies(none).count() == 0


@given(st.lists(st.integers(0, 2**64 - 1), min_size=0, max_size=60, unique=True))
@settings(max_examples=60, deadline=None)
def test_golomb_round_trip(values):
    x = np.array(sorted(values), np.uint64)
    k, code = exactdedup.encode(x)
    assert exactdedup.decode(len(x), k, code).tolist() == x.tolist()


def test_golomb_code_is_compact():
    x = np.sort(np.random.default_rng(0).integers(0, 2**40, 10_000).astype(np.uint64))
    assert len(exactdedup.encode(x)[1]) * 8 / len(x) < math.log2(2**40 / 10_000) + 2.5


# -- 6: near-dedup


def plain_near(texts, threshold=0.8):
    """Group of each text: all pairs, the plain way."""
    h, t, s = probminhash.shingles(texts)
    part = list(range(len(texts)))

    def top(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = slice(s[i], s[i + 1]), slice(s[j], s[j + 1])
            if max(probminhash.similarity(h[a], t[a], h[b], t[b])) >= threshold:
                part[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(texts))]


def test_near_groups_of_odd_documents(docs, none):
    got = probminhash.near_duplicates(docs).collect()
    groups = collections.defaultdict(set)
    for k, top in enumerate(plain_near([t for _, t in ROWS])):
        groups[top].add(k)
    want = sorted((tuple(sorted(str(ROWS[k][0]) for k in g))) for g in groups.values())
    mine = collections.defaultdict(list)
    for r in got:
        mine[(r["group_id"], r["group_size"])].append(str(r["doc_id"]))
    assert sorted(tuple(sorted(v)) for v in mine.values()) == want
    assert sum(r["kept"] for r in got) == len(want) == probminhash.one_of_each(docs).count()
    assert probminhash.near_duplicates(none).count() == 0


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.integers(0, len(out))] = f"x{rng.integers(0, 10**9)}"
    return " ".join(out)


@pytest.mark.parametrize("seed", range(2))
def test_planted_near_copies(spark, seed):
    rng = np.random.default_rng(seed)
    texts = []
    for _ in range(12):
        base = [f"w{x}" for x in rng.integers(0, 5000, 120)]
        texts += [" ".join(base), *[edited(rng, base, n) for n in (1, 2, 3, 4, 6, 9, 15)], " ".join(base + base[:40])]
    chain = [f"c{x}" for x in rng.integers(0, 5000, 200)]
    texts += [" ".join(chain[i : i + 100]) for i in range(0, 60, 6)]  # each near the next, the first far from the last
    want = plain_near(texts)
    out = probminhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert [r["group_id"] for r in out.orderBy("doc_id").collect()] == want


def test_a_bucket_without_a_hub(spark, monkeypatch):
    """Many edits of one text, none of them near all others, in blocks of a few."""
    monkeypatch.setattr(probminhash, "BLOCK", 4)
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 5000, 100)]
    texts = [edited(rng, base, int(n)) for n in rng.integers(1, 6, 40)]
    out = probminhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert [r["group_id"] for r in out.orderBy("doc_id").collect()] == plain_near(texts)


def repeating(rng, often):
    """Two texts of the same distinct shingles but a few, each repeating another half of them."""
    x, y = ([f"w{i}" for i in rng.integers(0, 10**6, 60)] for _ in range(2))
    return " ".join(x * often + y), " ".join(x + y * often)


def test_copies_that_repeat_other_passages(spark):
    """Near by their distinct shingles, far by weights."""
    rng = np.random.default_rng(7)
    texts = [t for _ in range(8) for t in repeating(rng, 60)]
    h, t, s = probminhash.shingles(texts[:2])
    weighted, plain = probminhash.similarity(h[: s[1]], t[: s[1]], h[s[1] :], t[s[1] :])
    assert weighted < 0.4 and plain > 0.9
    want = plain_near(texts)
    out = probminhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert len(set(want)) == 8
    assert [r["group_id"] for r in out.orderBy("doc_id").collect()] == want


def test_signatures_exclude_only_if_both_do():
    rng = np.random.default_rng(8)
    pair = repeating(rng, 60)
    rows = [r for b in probminhash._sketched([pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array([0, 1]), pa.array(pair)], names=["row", "doc_id", "text"])]) for r in b.to_pylist()]
    signed = [r["signature"] for b in probminhash._features([pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array(pair)], names=["row", "text"])]) for r in b.to_pylist()]
    meet = [(b, i, j) for i, b in enumerate(rows[0]["bands"]) for j, c in enumerate(rows[1]["bands"]) if b == c]
    found = []
    for _, i, j in meet:
        table = pa.table({"no": [i, j], "node": [0, 1], "part": [0, 1], "signature": pa.array(signed, pa.binary()), "bands": [r["bands"] for r in rows], "outside": [True, False]})
        found += probminhash._block(366, False)(table).to_pylist()
    assert [(r["a"], r["b"]) for r in found] == [(0, 1)]  # met in one of the bands they share


def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(0)
    shared = rng.integers(0, 2**63, 300).astype(np.uint64)
    for extra in (20, 100, 300):
        a = np.unique(np.concatenate([shared, rng.integers(0, 2**63, extra).astype(np.uint64)]))
        b = np.unique(np.concatenate([shared, rng.integers(0, 2**63, extra).astype(np.uint64)]))
        ta, tb = (1 + (x % np.uint64(4)).astype(np.int64) for x in (a, b))
        exact = probminhash.similarity(a, ta, b, tb)[0]
        both, times = np.concatenate([a, b]), np.concatenate([ta, tb])
        r = probminhash.sketch(both, probminhash.weights(times), np.array([0, len(a), len(a) + len(b)]), 4093)
        assert (r[0] == r[1]).mean() == pytest.approx(exact, abs=0.035)


def test_probability_jaccard_by_definition():
    rng = np.random.default_rng(3)
    for _ in range(20):
        a, b = (np.unique(rng.integers(0, 30, 15).astype(np.uint64)) for _ in range(2))
        ta, tb = rng.integers(1, 6, len(a)), rng.integers(1, 6, len(b))
        wa, wb = dict(zip(a.tolist(), probminhash.weights(ta), strict=True)), dict(zip(b.tolist(), probminhash.weights(tb), strict=True))
        want = sum(1 / sum(max(wa.get(o, 0) / wa[d], wb.get(o, 0) / wb[d]) for o in wa.keys() | wb.keys()) for d in wa.keys() & wb.keys())
        assert probminhash.similarity(a, ta, b, tb) == pytest.approx((want, len(wa.keys() & wb.keys()) / len(wa.keys() | wb.keys())))


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 120, (90, 2))] + [(200 + i, 201 + i) for i in range(40)] + [(300, 301 + i) for i in range(40)]
    got = probminhash.components(spark.createDataFrame(edges, "a long, b long")).collect()
    part = {x: x for e in edges for x in e}

    def top(x):
        while part[x] != x:
            x = part[x]
        return x

    for a, b in edges:
        part[top(a)] = top(b)
    groups = collections.defaultdict(set)
    for r in got:
        groups[r["part"]].add(r["node"])
    want = collections.defaultdict(set)
    for x in part:
        want[top(x)].add(x)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


# -- 8: token counts


def test_counts_are_the_librarys(docs, none, path):
    library = Tokenizer.from_file(path("byte_bpe_50k.json"))
    out = tokencount.count_tokens(docs, path("byte_bpe_50k.json")).collect()
    want = sorted((str(i), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS)
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in out) == want
    assert tokencount.count_tokens(none, path("byte_bpe_50k.json")).count() == 0


@pytest.fixture(scope="module")
def counter(path):
    return tokencount.Counter(path("byte_bpe_50k.json"), most=50)


@pytest.fixture(scope="module")
def library(path):
    return Tokenizer.from_file(path("byte_bpe_50k.json"))


def told(counter, text):
    return tokencount.Prefixes(tokencount.packed(counter.tables([text])[0]))


@given(st.text(alphabet="abtheing AEé'srelvd.!\n\t 10²日😀", max_size=40))
@settings(max_examples=150, deadline=None)
def test_every_prefix(counter, library, text):
    exact = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
    p = told(counter, text)
    assert [p.at(i) for i in range(len(text) + 1)] == exact
    for budget in (0, 1, 3, 8):
        assert p.cut(budget) == max(i for i, n in enumerate(exact) if n <= budget)


@pytest.mark.parametrize("text", ["it's we'll 're", "  lead", "a" * 300, "x<|endoftext|>y <|endoftext|>", "-" * 300 + "=" * 80, "naïve café — “quoted”", "a \n\n b\n\n\nc  d\t\te", "!!  <|endoftext|>  <|endoftext|>'ll", "x\u00a0\u2003 y", ""])
def test_prefixes_of_odd_texts(counter, library, text):
    p = told(counter, text)
    for i in range(0, len(text) + 1):
        assert p.at(i) == len(library.encode(text[:i], add_special_tokens=False).ids)


def test_budgets_are_answered_from_the_table_alone(spark, docs, path, library):
    out = tokencount.count_tokens(docs, path("byte_bpe_50k.json")).withColumn("fits", tokencount.fitting(F.col("prefix_table"), 7)).select("doc_id", "fits").collect()
    want = [(str(i), max(k for k in range(min(80, len(t or "")) + 1) if len(library.encode((t or "")[:k], add_special_tokens=False).ids) <= 7)) for i, t in ROWS]
    assert sorted((str(r["doc_id"]), r["fits"]) for r in out) == sorted(want)


@given(st.lists(st.integers(-300, 300), max_size=30))
@settings(max_examples=50, deadline=None)
def test_tables_round_trip(steps):
    assert tokencount.unpacked(tokencount.packed(np.array(steps, np.int32))).tolist() == steps


# -- the pipeline


def test_pipeline_stages_against_plain_versions(spark, path):
    import corpus_pipeline

    from tidemark.llm.common import durable

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "MinHash near-dedup", "mixing sources", "packing"]
    states = [docs]
    for _, stage in corpus_pipeline.STAGES:
        states.append(durable(stage(spark, states[-1], d)))
    assert all(s.columns == docs.columns for s in states[:-1])
    start, good, single, apart, mixed, packed = states
    bare = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    assert good.count() <= start.count() and good.join(start, docs.columns, "left_anti").count() == 0
    texts = [bare(r["text"]) for r in good.collect()]
    assert sorted(bare(r["text"]) for r in single.collect()) == sorted(set(texts))
    rows = single.collect()
    assert apart.count() == len(set(plain_near([r["text"] for r in rows])))
    times = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert max(times.values()) <= 2 and set(times) <= {r["doc_id"] for r in apart.collect()}
    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    total = sum(len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in mixed.collect())
    assert packed.agg(F.sum("length")).first()[0] == total
    again = corpus_pipeline.run(spark, d)
    assert sorted(map(tuple, again.select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(map(tuple, packed.select("doc_id", "start", "length", "ids_crc32").collect()))
