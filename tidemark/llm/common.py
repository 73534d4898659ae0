"""What the operators of this subpackage share: inputs, scratch tables, joins that hold up under hot keys."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager, suppress
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

#: Characters that count as white space throughout: 0x20 and 0x09 to 0x0D.
BLANKS = " \t\n\x0b\x0c\r"

#: A table is broadcast only when it was counted and has at most this many narrow rows.
BROADCAST_ROWS = 200_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only in local mode where none is set, as in tests."""
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemark-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


#: Scratch folders written and not deleted yet, and the catalog's name of those that have one.
_WRITTEN: dict[str, str | None] = {}


def _new_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    _WRITTEN[path] = None
    return path


def _drop(spark: SparkSession, path: str) -> None:
    if table := _WRITTEN.pop(path, None):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """While a table is written, Python workers get at most ``rows`` rows at a time; the session's own setting comes back after."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    held = spark.conf.get(key)
    if 0 < int(held) <= rows:
        yield
        return
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, held)


def durable(df: DataFrame, name: str = "t") -> DataFrame:
    """Writes ``df`` as Parquet into the shared folder and reads it back: lineage ends there, and a lost executor loses nothing.

    The folder goes when the driver ends, or earlier: see ``forget`` and ``tidy``.
    """
    path = _new_path(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Deletes tables that ``durable`` wrote, once nothing reads them any more."""
    for df in tables:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()[:1]}:
            for held in [p for p in _WRITTEN if path.endswith(p.split(":", 1)[-1])]:
                _drop(df.sparkSession, held)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Gives a ``durable`` whose tables stay; every other scratch table written inside is deleted at the end."""
    before, kept = set(_WRITTEN), set()

    def keep(df: DataFrame, name: str = "t") -> DataFrame:
        known = set(_WRITTEN)
        out = durable(df, name)
        kept.update(set(_WRITTEN) - known)
        return out

    yield keep
    for path in set(_WRITTEN) - before - kept:
        _drop(spark, path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: ``monotonically_increasing_id`` counts a partition's rows in so many bits.
_POSITION_BITS = 33


def _bitmap(table: pa.Table) -> pa.Table:
    place = table.column("place").to_numpy()
    bits = np.zeros(int(place.max()) + 1, np.uint8)
    bits[place] = 1
    return pa.table({"part": table.column("part").slice(0, 1), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})


def part_of(row: Column) -> Column:
    return F.shiftright(row, _POSITION_BITS)


def place_of(row: Column) -> Column:
    return row.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))


def bitmaps(rows: DataFrame, row: str = "row") -> DataFrame:
    """part, bits: the row numbers in column ``row`` as one bitmap for each part of a numbered table."""
    placed = rows.select(part_of(F.col(row)).alias("part"), place_of(F.col(row)).alias("place"))
    return placed.groupBy("part").applyInArrow(_bitmap, "part long, bits binary")


class Numbered:
    """A table written once, in the shared folder, with a number for each of its rows: no later read can number them otherwise.

    A row's number says in which part (the task that wrote it) and at which place it lies.  The table is bucketed by part, each
    task writing one file, so that whatever is grouped by part, or joined by it, finds the rows where they lie: row numbers
    chosen elsewhere come back as one bitmap a part, and texts are never shuffled, however many rows were chosen.
    """

    def __init__(self, df: DataFrame):
        spark = df.sparkSession
        self.columns = df.columns
        self.row, self.part = unused(df, "row"), unused(df, "part")
        path = _new_path(spark, "numbered")
        name = _WRITTEN[path] = f"tidemark_{uuid.uuid4().hex}"
        buckets = min(100_000, int(spark.conf.get("spark.sql.shuffle.partitions")))
        given = df.select("*", F.monotonically_increasing_id().alias(self.row)).withColumn(self.part, part_of(F.col(self.row)))
        given.write.format("parquet").bucketBy(buckets, self.part).option("path", path).saveAsTable(name)
        self.table = spark.table(name)

    def marked(self, bits: DataFrame, flag: str) -> DataFrame:
        """The table with a column ``flag``: whether the row's bit is set in ``bits`` (part, bits)."""
        place = place_of(F.col(self.row))
        key, value = unused(self.table, "bits_part"), unused(self.table, "bits")
        byte = F.conv(F.hex(F.substring(F.col(value), (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        told = bits.select(F.col("part").alias(key), F.col("bits").alias(value)).hint("shuffle_hash")
        joined = self.table.join(told, F.col(self.part) == F.col(key), "left")
        return joined.withColumn(flag, F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))).drop(key, value)

    def chosen(self, bits: DataFrame, among: bool = True) -> DataFrame:
        """The rows whose bit is set, or not set."""
        flag = unused(self.table, "chosen")
        return self.marked(bits, flag).where(F.col(flag) if among else ~F.col(flag)).drop(flag)

    def without(self, rows: DataFrame, row: str = "row") -> DataFrame:
        """The table as it was given, without the rows of these numbers."""
        return self.chosen(bitmaps(rows, row), among=False).select(*[F.col(f"`{c}`") for c in self.columns])


def without_blanks(text: Column) -> Column:
    """``text`` (null: empty) without any character of BLANKS."""
    out = F.coalesce(text, F.lit(""))
    for c in BLANKS:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def join_small(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Joins ``right`` by broadcast if, counted, it has at most ``rows`` rows; else by shuffle, where adaptive execution splits hot keys."""
    few = right.limit(rows + 1).count() <= rows
    return left.join(F.broadcast(right) if few else right, on, how)


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], size: str, total: int, how: str = "inner", share: int = 10_000) -> DataFrame:
    """Joins each row to its group (one row per ``on`` in ``groups``, its number of rows in ``size``) without a hot shuffle key.

    Groups above ``total / share`` rows number at most ``share``, a bound that does not grow with the data: they are
    broadcast.  The others are shuffled, and none of them can fill a task.  With ``how="left"`` rows without a group stay.
    """
    hot = unused(rows, "hot")
    value = [c for c in groups.columns if c not in on]
    own = {c: unused(rows, f"own_{c}") for c in value}
    heavy = groups.where(F.col(size) > F.lit(total // share)).select(*on, *[F.col(c).alias(own[c]) for c in value], F.lit(True).alias(hot))
    light = groups.where(F.col(size) <= F.lit(total // share))
    met = rows.join(F.broadcast(heavy), on, "left")
    given = [F.col(f"`{c}`") for c in rows.columns]
    done = met.where(F.col(hot)).select(*given, *[F.col(own[c]).alias(c) for c in value])
    rest = met.where(F.col(hot).isNull()).select(*given).join(light, on, how).select(*given, *value)
    return done.unionByName(rest)


_WORKER: dict[str, object] = {}


def _let_go() -> None:
    """Gives memory that is free back to the system: a Python worker lives on for tasks of other operators."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # where the C library can't
        ctypes.CDLL(None).malloc_trim(0)


def worker_cache(key: str, make: Callable[[], T]) -> T:
    """What a Python worker keeps from task to task: one operator's memory at a time, another's is let go."""
    if key not in _WORKER:
        _WORKER.clear()
        gc.collect()
        _let_go()
        _WORKER[key] = make()
    return _WORKER[key]


#: Rows and bytes of text that a Python worker works on at a time.
BATCH_ROWS, BATCH_BYTES = 200, 4 << 20


def slices(batches: Iterable[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Batches cut into pieces of at most ``BATCH_ROWS`` rows and, beyond one row, ``BATCH_BYTES`` of column ``text``.

    What a step holds is bounded by these and by the longest text, whatever the session's size of Arrow batches.
    """
    for batch in batches:
        sizes = np.nan_to_num(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False).astype(float)) if batch.num_rows else np.zeros(0)
        until, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            stop = int(np.searchsorted(until, (until[at - 1] if at else 0) + BATCH_BYTES, side="right"))
            stop = min(max(stop, at + 1), at + BATCH_ROWS, batch.num_rows)
            yield batch.slice(at, stop - at)
            at = stop
    _let_go()
