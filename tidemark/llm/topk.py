"""Exact top-k search: tiled matrix products of queries and shards, partial selection per tile, tree merge per query.

Vectors are packed into tiles of integers.  Queries and candidates form a grid of cells: ``columns`` groups of candidate
tiles by ``rows`` groups of query tiles, each group of bounded bytes.  A cell multiplies its query tiles with its candidate
tiles one pair at a time, selects each query's best of the tile in linear time, and keeps a running list.  The cells'
lists meet in a tree of fan-in ``FAN``.  Only queries (a stated set) are copied to each column, candidates to each row of
the grid; one row is enough until the queries exceed ``CELL_BYTES``.

Scores are integers: components become floor(scale * x).  A product whose bound stays under 2**53 runs in double precision
without rounding; beyond, in Python's integers, and a score beyond 64 bits counts as the end of that range.

Defined cases: vectors that are null or hold a null or non-finite component take no part; only vectors of one length meet;
ties go to the smaller id; a candidate with the query's id is the query itself; candidates that repeat an id all count; of
queries that repeat an id the smallest vector stands (ranks are those of ids, not of query rows); fewer than k candidates give fewer rows; empty tables give none.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TILE = 2048
FAN = 16
CELL_BYTES = 32 << 20
_TILE_SCHEMA = "side int, dim int, serial long, ids binary, wide boolean, cells binary"
_FOUND_SCHEMA = "query_id long, cell long, vec_id long, score long"


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _pack(batches: Iterable[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """Rows (side, id, vector) into tiles of integer vectors of one side and length, 32 bits a component where all fit.

    A task's tiles have running numbers, the first one's being the task's: they are dealt in turn.
    """
    from pyspark import TaskContext

    serial = TaskContext.get().partitionId() if TaskContext.get() else 0
    held: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}

    def tile(key: tuple[int, int]) -> pa.RecordBatch:
        nonlocal serial
        parts = held.pop(key)
        ids, cells = (np.concatenate(x) for x in zip(*parts, strict=True))
        serial += 1
        wide = bool(np.abs(cells).max(initial=0) >= 2**31 - 1)
        told = {"side": key[0], "dim": key[1], "serial": serial, "ids": ids.tobytes(), "wide": wide, "cells": cells.astype("<f8" if wide else "<i4").tobytes()}
        return pa.RecordBatch.from_pylist([told], schema=schema)

    schema = pa.schema([("side", pa.int32()), ("dim", pa.int32()), ("serial", pa.int64()), ("ids", pa.binary()), ("wide", pa.bool_()), ("cells", pa.binary())])
    for batch in batches:
        side, ids, vectors = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype("<i8"), batch.column(2)
        offsets, flat = vectors.offsets.to_numpy(), vectors.values.to_numpy()
        size = np.diff(offsets)
        for s, d in {*zip(side.tolist(), size.tolist(), strict=True)}:
            hit = np.flatnonzero((side == s) & (size == d))
            cells = np.floor(scale * flat[offsets[hit][:, None] + np.arange(d)].reshape(len(hit), d).astype(float))
            for at in range(0, len(hit), TILE):
                held.setdefault((s, d), []).append((ids[hit[at : at + TILE]], cells[at : at + TILE]))
                if sum(len(x[0]) for x in held[s, d]) >= TILE:
                    yield tile((s, d))
    for key in list(held):
        yield tile(key)


def _best(q: np.ndarray, q_ids: np.ndarray, v: np.ndarray, v_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of each query's best k of one tile; -inf where there are fewer. ``v_ids`` ascend."""
    score = q @ v.T
    own = np.searchsorted(v_ids, q_ids)
    for i in np.flatnonzero((own < len(v_ids)) & (v_ids[np.minimum(own, len(v_ids) - 1)] == q_ids)):
        score[i, own[i] : np.searchsorted(v_ids, q_ids[i], side="right")] = -np.inf
    n = len(v_ids)
    if n > k:
        # one key orders by score, then by smaller id
        exact = np.abs(np.where(np.isinf(score), 0, score)).max(initial=0) * 2 * TILE < 2**53
        key = score * TILE + np.arange(n - 1, -1, -1) if exact and n <= TILE else None
        pick = np.argpartition(key, n - k, axis=1)[:, n - k :] if key is not None else np.argsort(-score, axis=1, kind="stable")[:, :k]
        score = np.take_along_axis(score, pick, 1)
        return score, v_ids[pick]
    return score, np.broadcast_to(v_ids, score.shape)


def _big_best(q: np.ndarray, q_ids: np.ndarray, v: np.ndarray, v_ids: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
    """As ``_best`` in Python's integers: lists of (-score, id)."""
    rows = [[int(x) for x in r] for r in v]
    out = []
    for mine, me in zip([[int(x) for x in r] for r in q], q_ids, strict=True):
        scores = ((sum(a * b for a, b in zip(mine, r, strict=True)), int(i)) for r, i in zip(rows, v_ids, strict=True) if i != me)
        out.append(heapq.nsmallest(k, ((-max(-(2**63), min(2**63 - 1, s)), i) for s, i in scores)))
    return out


def _cell(table: pa.Table, k: int) -> pa.Table:
    dim, cell = table.column("dim")[0].as_py(), table.column("column")[0].as_py()
    tiles: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {0: [], 1: []}
    for side, ids, wide, cells in zip(*(table.column(c).to_pylist() for c in ("side", "ids", "wide", "cells")), strict=True):
        ids = np.frombuffer(ids, "<i8")
        cells = np.frombuffer(cells, "<f8" if wide else "<i4").reshape(len(ids), dim)
        tiles[side].append((ids, cells))
    out: list[pa.Table] = []
    for q_ids, q in tiles[0]:
        q = q.astype(float)
        top, top_ids, far = np.full((len(q), 0), -np.inf), np.zeros((len(q), 0), np.int64), [[] for _ in q]
        big = False
        for v_ids, v in tiles[1]:
            order = np.argsort(v_ids, kind="stable")
            v_ids, v = v_ids[order], v[order].astype(float)
            if big or np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * max(1, dim) >= 2**53:
                big = True
                far = [heapq.nsmallest(k, x + y) for x, y in zip(far, _big_best(q, q_ids, v, v_ids, k), strict=True)]
                continue
            score, ids = _best(q, q_ids, v, v_ids, k)
            top, top_ids = np.concatenate([top, score], 1), np.concatenate([top_ids, ids], 1)
            order = np.lexsort((top_ids, -top), axis=-1)[:, :k]
            top, top_ids = np.take_along_axis(top, order, 1), np.take_along_axis(top_ids, order, 1)
        if big:
            held = [[(-int(s), int(i)) for s, i in zip(a, b, strict=True) if s > -np.inf] for a, b in zip(top, top_ids, strict=True)]
            rows = [(int(me), i, -s) for me, a, b in zip(q_ids, held, far, strict=True) for s, i in heapq.nsmallest(k, a + b)]
            owner, ids, score = (np.array(x, np.int64) for x in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 3
        else:
            real = top > -np.inf
            owner, ids, score = np.broadcast_to(q_ids[:, None], top.shape)[real], top_ids[real], top[real].astype(np.int64)
        out.append(pa.table({"query_id": owner, "cell": np.full(len(owner), cell, np.int64), "vec_id": ids, "score": score}))
    empty = pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "cell", "vec_id", "score")})
    return pa.concat_tables(out) if out else empty


def search(candidates: DataFrame, queries: DataFrame, k: int = 10, scale: float = 1024.0) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best of ``candidates``; both frames have columns id and vector."""
    spark = candidates.sparkSession
    data = candidates.select(F.lit(1).alias("side"), F.col("id").cast("long").alias("id"), "vector").where(_usable(F.col("vector")) & F.col("id").isNotNull())
    asked = queries.select(F.col("id").cast("long").alias("id"), "vector").where(_usable(F.col("vector")) & F.col("id").isNotNull())
    asked = asked.groupBy("id").agg(F.min("vector").alias("vector")).select(F.lit(0).alias("side"), "id", "vector")
    count = lambda df: df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("vector")), F.lit(0)).alias("cells")).first()
    there, wanted = count(data), count(asked)
    columns = max(1, -(-8 * there.cells // CELL_BYTES), min(4 * spark.sparkContext.defaultParallelism, -(-there.n // TILE)))
    rows = max(1, -(-8 * wanted.cells // CELL_BYTES))
    packed = lambda df: df.mapInArrow(lambda batches: _pack(batches, scale), _TILE_SCHEMA)
    tiles = packed(data).unionByName(packed(asked))
    spread = F.pmod(F.col("serial"), F.when(F.col("side") == 1, columns).otherwise(rows)).cast("long")
    others = F.sequence(F.lit(0), F.when(F.col("side") == 1, rows - 1).otherwise(columns - 1)).cast("array<long>")
    tiles = tiles.withColumn("own", spread).withColumn("other", F.explode(others))
    tiles = tiles.withColumn("row", F.when(F.col("side") == 1, F.col("other")).otherwise(F.col("own"))).withColumn("column", F.when(F.col("side") == 1, F.col("own")).otherwise(F.col("other")))
    found = tiles.drop("own", "other", "serial").groupBy("dim", "row", "column").applyInArrow(lambda t: _cell(t, k), _FOUND_SCHEMA)
    best = F.col("score").desc(), F.col("vec_id")
    while columns > FAN:
        found = found.withColumn("cell", F.floor(F.col("cell") / FAN))
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "cell").orderBy(*best))).where(F.col("rank") <= k).drop("rank")
        columns = -(-columns // FAN)
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*best))).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
