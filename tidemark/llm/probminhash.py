"""MinHash near-dedup: ProbMinHash of weighted shingles, banding, verification, connected components.

A text's features are its shingles of five words (lower case, words between blanks), weighted by 1 + ln(occurrences).  Each
shingle is the source of a Poisson process whose rate is its weight: its arrivals, in time order, go to registers in an order
of its own, seeded by the shingle; a register keeps the shingle that arrives first.  A shingle stops as soon as its next
arrival is later than every register's (early termination).  Two texts agree in a register with a probability equal to the
probability Jaccard similarity of their weights.  A text that repeats a shingle gets a second, plain sketch with all weights 1,
whose registers agree with the probability of the plain Jaccard similarity; of all other texts both sketches are the same.
Bands of the registers of either give candidates, and exact similarities verify them: two texts are linked if the probability
Jaccard of their weights, or the plain Jaccard of their distinct shingles, is at least ``threshold``.  Groups are the connected
components of the links.

Texts with equal shingles are one class from the start.  Within a band's bucket not all pairs are made:

1. every member meets the bucket's leader, the class with most copies; links are verified and components formed;
2. of pairs that still lie in different components, each member outside the bucket's largest component meets, in blocks of
   bounded size, all other members by signature; the most promising partner in each other component is verified;
3. all pairs still in different components whose signatures don't exclude the threshold are verified.

A bucket in which very many members stay outside the largest component (texts that share a passage or a header and nothing
else) is not met in blocks: its members are grouped anew, exactly, by their rarest shingles, see ``rarest``; steps 2 and 3 then
work on these groups, which such texts don't share.

So every pair of a bucket is either in one component already, or verified, or excluded by its signatures: longer sketches,
weighted and plain, made for members of buckets only, whose agreements both lie more than 4.5 standard deviations below the
threshold, or by having none of its rarest shingles in common.  A pair counts in the first band it shares.  No bucket, class or
component is ever held by one task, and none capped.  The table is numbered and written once, so rows are the same in all passes.

Defined cases: a null or blank text has no shingle, and all such texts are equal; a text of fewer than five words is one
shingle; the row with the smallest id of a group (null last, then the first row) stays; rows that repeat an id are rows of
their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Numbered, bitmaps, durable, join_groups, slices, worker_cache

#: Registers: a prime, so that a step size gives each shingle an order of all registers.
REGISTERS = 127
BANDS, ROWS = 25, 5
#: Registers of the longer sketches that exclude pairs within a bucket.
LONG = 509
SHINGLE = 5
THRESHOLD = 0.8
BLOCK = 512
#: Members outside a bucket's largest component beyond which the bucket is grouped anew.
CROWD = 4096

_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_POLY = np.uint64(0x100000001B3)


def step(i: int) -> np.uint64:
    """The i-th point of a Weyl sequence."""
    return np.uint64(i * 0x9E3779B97F4A7C15 % 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 500_000:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: hashes, occurrences, and where each text's begin (one more at the end)."""
    known = worker_cache("word hashes", WordHashes)
    flat: list[bytes] = []
    sizes = []
    for text in texts:
        words = text.lower().encode().split() if text else []
        if words and len(words) < SHINGLE:
            words += [b""] * (SHINGLE - len(words))
        flat += words
        sizes.append(len(words))
    hashed = np.fromiter(map(known.__getitem__, flat), np.uint64, len(flat))
    rolled = np.zeros(max(0, len(flat) - SHINGLE + 1), np.uint64)
    for j in range(SHINGLE):
        rolled = rolled * _POLY + mix(hashed[j : j + len(rolled)] + _STEP)
    rolled = mix(rolled)
    out, times, starts, at = [], [], [0], 0
    for n in sizes:
        own, often = np.unique(rolled[at : at + max(0, n - SHINGLE + 1)], return_counts=True)
        out.append(own)
        times.append(often)
        starts.append(starts[-1] + len(own))
        at += n
    return np.concatenate([*out, np.zeros(0, np.uint64)]), np.concatenate([*times, np.zeros(0, np.int64)]), np.array(starts)


def weights(times: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(times)


def sketch(hashes: np.ndarray, weight: np.ndarray, starts: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """ProbMinHash registers (texts, m) of each text's weighted elements: the element that arrives first in each; 0 without elements."""
    n = len(starts) - 1
    owner = np.repeat(np.arange(n), np.diff(starts))
    earliest, who = np.full(n * m, np.inf), np.zeros(n * m, np.uint64)
    element, rate, time = hashes, weight, np.zeros(len(hashes))
    seed = mix(hashes + _STEP)
    place, stride = (seed % np.uint64(m)).astype(np.int64), (mix(seed) % np.uint64(m - 1)).astype(np.int64) + 1
    for i in range(m):
        # the next of m - i independent exponential arrivals still to come
        draw = mix(element + step(i + 1))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (rate * (m - i))
        slot = owner * m + place
        first = time < earliest[slot]
        np.minimum.at(earliest, slot[first], time[first])
        won = first & (time == earliest[slot])
        who[slot[won]] = element[won]
        latest = earliest.reshape(n, m).max(1)
        going = np.flatnonzero(time < latest[owner])
        if not len(going):
            break
        element, rate, time, owner, stride = element[going], rate[going], time[going], owner[going], stride[going]
        place = (place[going] + stride) % m
    return who.reshape(n, m)


def sketches(hashes: np.ndarray, times: np.ndarray, starts: np.ndarray, m: int = REGISTERS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Registers by weights, registers of the distinct shingles alone, and which texts repeat a shingle: of others both are the same."""
    who = sketch(hashes, weights(times), starts, m)
    sizes = np.diff(starts)
    repeated = np.concatenate([[0], np.cumsum(times > 1)])[starts]
    again = np.diff(repeated) > 0
    if not again.any():
        return who, who, again
    plain, own = who.copy(), hashes[np.repeat(again, sizes)]
    plain[again] = sketch(own, np.ones(len(own)), np.concatenate([[0], np.cumsum(sizes[again])]), m)
    return who, plain, again


def similarity(a: np.ndarray, a_times: np.ndarray, b: np.ndarray, b_times: np.ndarray) -> tuple[float, float]:
    """Probability Jaccard of the weights and plain Jaccard, exactly, of two ascending lists of distinct shingles."""
    if not len(a) or not len(b):
        same = float(len(a) == len(b))
        return same, same
    at = np.searchsorted(b, a)
    hit = b[np.minimum(at, len(b) - 1)] == a
    both = int(hit.sum())
    plain = both / (len(a) + len(b) - both)
    if a_times.max() == 1 and b_times.max() == 1 or not both:
        return plain, plain
    wa, wb = weights(a_times), weights(b_times)
    x, y = wa[hit], wb[at[hit]]
    lone_a, lone_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    # sum over others of max(a'/a, b'/b): those of a greater ratio a'/b' count by a, the rest by b
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    above = x.sum() - np.cumsum(x) + lone_a
    upto = np.cumsum(y) + lone_b
    return float((1.0 / (above / x + upto / y)).sum()), plain


def _bands(who: np.ndarray) -> np.ndarray:
    bands = np.zeros((len(who), BANDS), np.uint64)
    for j in range(ROWS):
        bands = bands * _POLY + mix(who[:, j * BANDS : (j + 1) * BANDS] + _STEP)
    return mix(bands + np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP).view(np.int64)


def _sketched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, 2):
        hashes, times, starts = shingles(part.column(2).to_pylist())
        n = part.num_rows
        who, plain, again = sketches(hashes, times, starts)
        key = np.zeros((2, n + 1), np.uint64)
        for k in range(2):
            sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes + step(k + 1)) * times.astype(np.uint64))])
            key[k, :n] = np.diff(sums[starts])
        some = np.diff(starts) > 0
        bands = [b.tolist() if s else [] for b, s in zip(_bands(who), some, strict=True)]
        for i, more in zip(np.flatnonzero(again).tolist(), _bands(plain[again]).tolist(), strict=True):
            bands[i] += more
        yield pa.RecordBatch.from_arrays(
            [
                part.column(0), part.column(1), pa.array(key[0, :n].view(np.int64)), pa.array(key[1, :n].view(np.int64)),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            names=["row", "doc_id", "k1", "k2", "bands"],
        )


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, 1):
        hashes, times, starts = shingles(part.column(1).to_pylist())
        told, often = [], []
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            told.append(hashes[s:e].tobytes())
            often.append(b"" if not e - s or times[s:e].max() == 1 else times[s:e].astype("<u4").tobytes())
        who, plain, again = sketches(hashes, times, starts, LONG)
        long, bare = ((x & np.uint64(2**16 - 1)).astype("<u2") for x in (who, plain))
        signed = [x.tobytes() + (y.tobytes() if more else b"") for x, y, more in zip(long, bare, again.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(told, pa.binary()), pa.array(often, pa.binary()), pa.array(signed, pa.binary())], names=["node", "hashes", "times", "signature"])


def _times(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<u4") if raw else np.ones(n, np.uint32)


def _verified(threshold: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, ha, ta, hb, tb = (batch.column(c).to_pylist() for c in ("a", "b", "a_hashes", "a_times", "b_hashes", "b_times"))
            kept = []
            for i in range(batch.num_rows):
                x, y = np.frombuffer(ha[i], np.uint64), np.frombuffer(hb[i], np.uint64)
                kept.append(max(similarity(x, _times(ta[i], len(x)), y, _times(tb[i], len(y)))) >= threshold)
            pick = np.flatnonzero(kept)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(a, np.int64)[pick]), pa.array(np.array(b, np.int64)[pick])], names=["a", "b"])

    return run


def verify(pairs: DataFrame, features: DataFrame, threshold: float) -> DataFrame:
    """The rows (a, b) of ``pairs`` that are similar.  A node in many pairs as ``a`` is met by its partners in salted parts."""
    named = lambda x: features.select(F.col("node").alias(x), F.col("hashes").alias(f"{x}_hashes"), F.col("times").alias(f"{x}_times"))
    salted = pairs.withColumn("salt", F.pmod(F.hash("b"), F.lit(64)))
    hubs = salted.select("a", "salt").distinct().join(named("a"), "a")
    full = salted.join(named("b"), "b").join(hubs, ["a", "salt"])
    return full.select("a", "b", "a_hashes", "a_times", "b_hashes", "b_times").mapInArrow(_verified(threshold), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node, part: the connected components of ``links`` (a, b), each named by one of its nodes.

    Every node points to its smallest neighbour, in a random order of nodes; pointers are followed twice; the graph is then
    contracted along them, until no link is left.  Nodes of many links are looked up by broadcast, their number being bounded.
    """
    links = durable(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "links")
    labels: DataFrame | None = None
    while (total := links.count()) > 0:
        both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("node"))
        to = both.groupBy("node").agg(F.min(rank("other")).alias("least"), F.count("*").alias("degree"))
        to = to.select("node", F.least(rank("node"), F.col("least"))["node"].alias("to"), "degree")
        for _ in range(2):
            to = durable(to, "to")
            fans = to.groupBy("to").agg(F.count("*").alias("fans"))
            ahead = to.select(F.col("node").alias("to"), F.col("to").alias("next")).join(fans, "to")
            to = join_groups(to, ahead, ["to"], "fans", total, "left").select("node", F.coalesce("next", "to").alias("to"), "degree")
        to = durable(to, "to")
        for end in ("a", "b"):
            links = join_groups(links, to.select(F.col("node").alias(end), F.col("to").alias("to"), "degree"), [end], "degree", total).withColumn(end, F.col("to")).select("a", "b")
        links = durable(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "links")
        if labels is None:
            labels = to.select("node", F.col("to").alias("part"))
        else:
            sizes = labels.groupBy("part").agg(F.count("*").alias("members"))
            moved = to.select(F.col("node").alias("part"), "to").join(sizes, "part")
            labels = join_groups(labels, moved, ["part"], "members", total, "left").select("node", F.coalesce("to", "part").alias("part"))
        labels = durable(labels, "labels")
    return labels if labels is not None else links.select(F.col("a").alias("node"), F.col("b").alias("part"))


def _block(least: int, best_only: bool):
    def run(table: pa.Table) -> pa.Table:
        outside, no = table.column("outside").to_numpy(zero_copy_only=False), table.column("no").to_numpy()
        node, part = table.column("node").to_numpy(), table.column("part").to_numpy()
        # by weights and plain: of texts that repeat no shingle the same twice
        signed, named = table.column("signature").to_pylist(), table.column("bands").to_pylist()
        told = np.frombuffer(b"".join(x[: 2 * LONG] + x[-2 * LONG :] for x in signed), "<u2").reshape(len(node), 2, LONG)
        bands = np.array([x[:BANDS] + x[-BANDS:] for x in named], np.int64).reshape(len(node), 2, BANDS)
        kinds = range(2 if any(len(x) > BANDS for x in named) else 1)
        mine, them = np.flatnonzero(outside), np.flatnonzero(~outside)
        their_bands = bands[them][:, : len(kinds)]
        a, b, p, agree = [], [], [], []
        for i in mine.tolist():
            hit = part[them] != part[i]
            if no[i] >= 0:  # a pair counts in the first band it shares, in every group that no band made
                hit &= np.argmax(np.concatenate([(their_bands == bands[i, k]).any(1) for k in kinds], axis=1), axis=1) == no[i]
            hit = them[hit]
            much = np.max([(told[hit, k] == told[i, k]).sum(1) for k in kinds], axis=0)
            hit, much = hit[much >= least], much[much >= least]
            if best_only and len(hit):
                order = np.lexsort((node[hit], -much))
                hit, much = hit[order], much[order]
                _, pick = np.unique(part[hit], return_index=True)
                hit, much = hit[pick], much[pick]
            a += [node[i]] * len(hit)
            b += node[hit].tolist()
            p += part[hit].tolist()
            agree += much.tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "part": pa.array(p, pa.int64()), "agree": pa.array(agree, pa.int64())})

    return run


def _split(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` (band, no, node, part) of groups that lie in several components, with n, main (the largest component) and others."""
    parts = rows.groupBy("band", "part").agg(F.count("*").alias("n"))
    split = parts.groupBy("band").agg(F.sum("n").alias("n"), F.count("*").alias("parts"), F.max(F.struct("n", "part")).alias("most")).where("parts > 1")
    split = split.select("band", "n", F.col("most.part").alias("main"), (F.col("n") - F.col("most.n")).alias("others"))
    return durable(join_groups(rows, durable(split, "split"), ["band"], "n", total), "apart")


def _spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, shingle, weight of each distinct shingle of some nodes."""
    for batch in batches:
        for node, hashes, times in zip(*(batch.column(c).to_pylist() for c in ("node", "hashes", "times")), strict=True):
            own = np.frombuffer(hashes, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), node)), pa.array(own), pa.array(weights(_times(times, len(own)).astype(float)))], names=["node", "shingle", "weight"])


def rarest(nodes: DataFrame, features: DataFrame, threshold: float) -> DataFrame:
    """band, node: the shingles of each of ``nodes`` without which no text can be similar to it, its rarest ones.

    In the order of frequency (any one order of all shingles would do), the most frequent shingles that together have less
    than the threshold's share of a text's weight, and of its number, don't make a similarity alone: by either definition the
    similarity of two texts is at most the share that their common shingles have of one of them.  So two similar texts have
    one of the other shingles in common.  Shingles of one text are no group and go at once.
    """
    rows = durable(features.join(nodes, "node", "left_semi").select("node", "hashes", "times").mapInArrow(_spread, "node long, shingle long, weight double"), "shingles")
    often = durable(rows.groupBy("shingle").agg(F.count("*").alias("often")), "often")
    known = join_groups(rows, often, ["shingle"], "often", rows.count())
    own = Window.partitionBy("node")
    order = own.orderBy(F.col("often").desc(), "shingle").rowsBetween(Window.unboundedPreceding, 0)
    told = known.withColumn("mass", F.sum("weight").over(order) / F.sum("weight").over(own)).withColumn("share", F.count("*").over(order) / F.count("*").over(own))
    # a little slack for sums that were rounded
    return told.where((F.col("often") > 1) & (F.greatest("mass", "share") >= threshold - 1e-9)).select(F.col("shingle").alias("band"), "node")


def _apart(members: DataFrame, labels: DataFrame, signatures: DataFrame, features: DataFrame, total: int, threshold: float, best_only: bool) -> DataFrame:
    """Pairs (a, b) of members (band, no, node) of one bucket that lie in different components and whose signatures allow the threshold.

    ``signatures``: node, signature, bands.  Where more than ``CROWD`` members lie outside a bucket's largest component, the
    bucket's members are grouped anew by their rarest shingles: texts that only share a passage part there.
    """
    rows = _split(members.join(labels, "node", "left").select("band", "no", "node", F.coalesce("part", "node").alias("part")), total)
    crowd = rows.where(F.col("others") > CROWD).select("node", "part").distinct()
    if crowd.limit(1).count():
        crowd = durable(crowd, "crowd")
        anew = durable(rarest(crowd.select("node"), features, threshold).join(crowd, "node"), "rarest")
        anew = _split(anew.select("band", F.lit(-1).alias("no"), "node", "part"), anew.count())
        rows = rows.where(F.col("others") <= CROWD).unionByName(anew)
    rows = durable(rows.join(signatures, "node"), "apart")
    own = F.pmod(F.hash("node"), F.ceil(F.col("n") / BLOCK).cast("int"))
    other = F.pmod(F.hash("node"), F.ceil(F.col("others") / BLOCK).cast("int"))
    every = lambda c: F.explode(F.sequence(F.lit(0), F.ceil(F.col(c) / BLOCK).cast("int") - 1))
    value = ["band", "no", "node", "part", "signature", "bands"]
    inside = rows.select(*value, F.lit(False).alias("outside"), own.alias("x"), every("others").alias("y"))
    outside = rows.where(F.col("part") != F.col("main")).select(*value, F.lit(True).alias("outside"), every("n").alias("x"), other.alias("y"))
    least = int(threshold * LONG - 4.5 * (threshold * (1 - threshold) * LONG) ** 0.5)
    found = inside.unionByName(outside).groupBy("band", "x", "y", F.col("no") < 0).applyInArrow(_block(least, best_only), "a long, b long, part long, agree long")
    if best_only:
        found = found.groupBy("a", "part").agg(F.max(F.struct("agree", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): row, doc_id, group_id (the smallest doc_id of its group), group_size, kept."""
    return _near(Numbered(docs.select("doc_id", "text")), threshold)


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, all its columns kept."""
    held = Numbered(docs)
    return held.without(_near(held, threshold).where(~F.col("kept")))


def _near(docs: Numbered, threshold: float) -> DataFrame:
    given = docs.table.select(F.col(docs.row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketched = durable(given.mapInArrow(_sketched, "row long, doc_id long, k1 long, k2 long, bands array<long>"), "sketches")
    total = sketched.count()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    classes = sketched.groupBy("k1", "k2").agg(first, F.count("*").alias("copies"), F.first("bands").alias("bands"))
    classes = durable(classes.select("k1", "k2", F.col("first.row").alias("node"), F.col("first.doc_id").alias("doc_id"), "copies", "bands"), "classes")

    banded = classes.select("node", "copies", "bands", F.posexplode("bands").alias("no", "band"))
    # a plain band that equals the weighted one stands in the same bucket already
    banded = banded.where(~F.col("band").eqNullSafe(F.get("bands", F.col("no") - BANDS))).select("node", "copies", "no", "band")
    buckets = banded.groupBy("band").agg(F.count("*").alias("n"), F.max(F.struct(F.col("copies"), (-F.col("node")).alias("node"))).alias("lead")).where("n > 1")
    buckets = durable(buckets.select("band", "n", (-F.col("lead.node")).alias("leader")), "buckets")
    members = durable(join_groups(banded.select("band", "no", "node"), buckets, ["band"], "n", total), "members")
    # texts of members are read where they lie: a bitmap of their rows goes to each part
    met = docs.chosen(durable(bitmaps(members.select("node").distinct(), "node"), "met"))
    features = durable(met.select(F.col(docs.row).alias("node"), F.col("text").cast("string")).mapInArrow(_features, "node long, hashes binary, times binary, signature binary"), "features")
    signatures = features.select("node", "signature").join(classes.select("node", "bands"), "node")

    pairs = members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    links = durable(verify(pairs, features, threshold), "verified")
    labels = components(links)
    for best_only in (True, False):
        pairs = durable(_apart(members.select("band", "no", "node"), labels, signatures, features, total, threshold, best_only), "pairs")
        new = durable(verify(pairs, features, threshold), "verified")
        if new.limit(1).count():
            links = links.unionByName(new)
            labels = components(links)

    # classes of one component take its first row; all others are their own
    linked = classes.select("k1", "k2", "node", "doc_id", "copies").join(labels, "node", "left").select("k1", "k2", "node", "doc_id", "copies", F.coalesce("part", "node").alias("part"))
    linked = durable(linked, "linked")
    groups = linked.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("node").alias("row"))).alias("first"), F.sum("copies").alias("group_size"), F.count("*").alias("classes"))
    groups = durable(groups.select("part", F.col("first.doc_id").alias("group_id"), F.col("first.row").alias("keep_row"), "group_size", "classes"), "groups")
    known = durable(join_groups(linked.select("k1", "k2", "copies", "part"), groups, ["part"], "classes", total).select("k1", "k2", "copies", "group_id", "keep_row", "group_size"), "known")
    out = join_groups(sketched.select("row", "doc_id", "k1", "k2"), known, ["k1", "k2"], "copies", total)
    return out.select("row", "doc_id", "group_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"))
