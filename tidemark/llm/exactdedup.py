"""Exact dedup: Golomb-coded fingerprint exchange, duplicate bitmaps, byte verification of suspects.

Texts are equal when identical after deletion of every character of 0x20 and 0x09 to 0x0D.  The table is written once, with a
number and a 64-bit fingerprint for each row.  Every part of it, where it lies, sends its distinct fingerprints, sorted and
Golomb-coded, to the owners of the fingerprints' ranges.  An owner decodes its lists and answers each with a bitmap of the
fingerprints that others sent too.  Rows whose bit is set, or that meet an equal fingerprint at home, are suspects; the answers
are turned into one bitmap of places for each part and applied to the written part.  Only the suspects' texts are shuffled:
they are grouped by their bytes, after a partial aggregation in each task, so that a group of any size costs its reducer one
row per task.  All other rows are final; neither their texts nor their fingerprints leave their part.

Classes of more than a fixed share of all rows are joined back by broadcast (their number is bounded by that share), the
others by shuffle.  Whoever drops copies reads the numbered table again, so a row is the same row in every pass.

Defined cases: a null text counts as empty, so all empty, blank and null texts are equal; of equal texts the row with the
most code points stays, then the smallest id (null last), then the first row; rows that repeat an id are rows of their own;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Numbered, durable, join_groups, place_of, unused, without_blanks

#: Fingerprints an owner answers for, on average.
OWNED = 1 << 20
LEAST_OWNERS = 64


def encode(values: np.ndarray) -> tuple[int, bytes]:
    """Golomb code (divisor 2**k) of the steps between ascending integers from 0: k, and quotients in unary before remainders."""
    steps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    mean = int(values[-1]) // len(values) if len(values) else 0
    k = max(0, mean.bit_length() - 1)
    quotients = (steps >> np.uint64(k)).astype(np.int64)
    unary = np.ones(int(quotients.sum()) + len(steps), np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 0
    low = ((steps[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return k, np.packbits(np.concatenate([unary, low.ravel()])).tobytes()


def decode(n: int, k: int, code: bytes) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(code, np.uint8))
    stops = np.flatnonzero(bits == 0)[:n]
    quotients = np.diff(stops, prepend=-1) - 1
    at = int(stops[-1]) + 1 if n else 0
    low = bits[at : at + n * k].reshape(n, k).astype(np.uint64)
    steps = quotients.astype(np.uint64) << np.uint64(k)
    for j in range(k):
        steps |= low[:, j] << np.uint64(j)
    return np.cumsum(steps, dtype=np.uint64)


def _owners_of(prints: np.ndarray, bits: int) -> np.ndarray:
    return (prints >> np.uint64(64 - bits)).astype(np.int64)


def _home(prints: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct fingerprints of a partition, ascending, with the place of each row's and how many rows have it."""
    distinct, place, times = np.unique(prints.to_numpy().view(np.uint64), return_inverse=True, return_counts=True)
    return distinct, place, times


def _send(table: pa.Table, bits: int) -> pa.Table:
    part = table.column("part")[0].as_py()
    distinct, _, _ = _home(table.column("print"))
    owner = _owners_of(distinct, bits)
    rows = []
    for o in np.unique(owner).tolist():
        own = distinct[owner == o] - np.uint64(o << (64 - bits))
        k, code = encode(own)
        rows.append({"owner": o, "part": part, "n": len(own), "k": k, "code": code})
    return pa.Table.from_pylist(rows, schema=pa.schema([("owner", pa.int64()), ("part", pa.int64()), ("n", pa.int64()), ("k", pa.int32()), ("code", pa.binary())]))


def _answer(table: pa.Table) -> pa.Table:
    owner = table.column("owner")[0].as_py()
    parts, sizes = table.column("part").to_pylist(), table.column("n").to_pylist()
    lists = [decode(n, k, code) for n, k, code in zip(sizes, table.column("k").to_pylist(), table.column("code").to_pylist(), strict=True)]
    _, place, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    shared = times[place] > 1
    rows, at = [], 0
    for part, n in zip(parts, sizes, strict=True):
        rows.append({"part": part, "owner": owner, "n": n, "bitmap": np.packbits(shared[at : at + n]).tobytes()})
        at += n
    return pa.Table.from_pylist(rows, schema=pa.schema([("part", pa.int64()), ("owner", pa.int64()), ("n", pa.int64()), ("bitmap", pa.binary())]))


def _flag(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """The places of a part's suspects, as a bitmap."""
    if not rows.num_rows:
        return pa.table({"part": pa.array([], pa.int64()), "bits": pa.array([], pa.binary())})
    distinct, which, times = _home(rows.column("print"))
    shared = np.zeros(len(distinct), bool)
    at = 0
    # answers in the order of their owners cover the distinct fingerprints from end to end
    for _, n, bitmap in sorted(zip(*(answers.column(c).to_pylist() for c in ("owner", "n", "bitmap")), strict=True)):
        shared[at : at + n] = np.unpackbits(np.frombuffer(bitmap, np.uint8), count=n).astype(bool)
        at += n
    place = rows.column("place").to_numpy()
    suspect = np.zeros(int(place.max()) + 1, np.uint8)
    suspect[place] = (shared | (times > 1))[which]
    return pa.table({"part": rows.column("part").slice(0, 1), "bits": pa.array([np.packbits(suspect, bitorder="little").tobytes()], pa.binary())})


def suspects(docs: Numbered, prints: str, total: int) -> DataFrame:
    """part, bits: for each part of a numbered table the rows whose fingerprint another row has too.

    Lists are coded where the rows lie and answers applied there: only codes and bitmaps are shuffled.
    """
    owners = LEAST_OWNERS
    while owners * OWNED < total:
        owners *= 2
    bits = owners.bit_length() - 1
    here = docs.table.select(F.col(docs.part).alias("part"), place_of(F.col(docs.row)).alias("place"), F.col(prints).alias("print"))
    sent = here.select("part", "print").groupBy("part").applyInArrow(lambda t: _send(t, bits), "owner long, part long, n long, k int, code binary")
    answers = sent.groupBy("owner").applyInArrow(_answer, "part long, owner long, n long, bitmap binary")
    return here.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_flag, "part long, bits binary")


def _first(chars: Column, doc_id: Column, row: Column) -> Column:
    return F.min(F.struct((-chars).alias("chars"), doc_id.isNull().alias("none"), doc_id.alias("doc_id"), row.alias("row")))


def _dedup(docs: DataFrame) -> tuple[Numbered, DataFrame]:
    """``docs``, numbered, and for each row: row, doc_id, keep_id, group_size, kept, text_sha256."""
    chars, sha, prints = (unused(docs, c) for c in ("chars", "sha", "print"))
    known = docs.withColumn(chars, F.length(F.coalesce("text", F.lit(""))).cast("long")).withColumn(sha, F.sha2(without_blanks(F.col("text")), 256)).withColumn(prints, F.xxhash64(sha))
    held = Numbered(known)
    total = held.table.count()
    bits = durable(suspects(held, prints, total), "suspects")
    narrow = [F.col(held.row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col(chars).alias("chars"), F.col(sha).alias("sha")]
    several = held.chosen(bits)
    texts = several.select(*narrow[:3], without_blanks(F.col("text")).alias("bare"), F.col(prints).alias("print"))
    grouped = texts.groupBy("print", "bare").agg(F.count("*").alias("group_size"), _first(F.col("chars"), F.col("doc_id"), F.col("row")).alias("first"))
    classes = durable(grouped.select(F.sha2("bare", 256).alias("sha"), "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row")), "classes")
    single = held.chosen(bits, among=False).select(*narrow[:2], F.col("doc_id").cast("long").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col(sha).alias("text_sha256"))
    joined = join_groups(several.select(*narrow), classes, ["sha"], "group_size", total)
    rest = joined.select("row", "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256"))
    return held, single.unionByName(rest)


def dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): row, doc_id, keep_id, group_size, kept, text_sha256."""
    return _dedup(docs.select("doc_id", "text"))[1]


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all its columns kept."""
    held, told = _dedup(docs)
    return held.without(told.where(~F.col("kept"))).select(*[F.col(f"`{c}`") for c in docs.columns])
