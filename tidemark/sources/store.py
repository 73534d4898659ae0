"""Snapshots: immutable folders of Parquet files, a log of commits that says which of them a version consists of.

Every writer writes into a folder of its own, named by chance; a commit is one small JSON file, whose creation makes the version
visible, and names the folders (one per partition) that it adds and those that no longer count.  A writer that finds its
version taken leaves everything others committed as it is: an append takes the next version, any other operation fails.
Replacing or deleting rows rewrites only the partitions that hold such rows.  All paths go through Hadoop's file systems, so a
store can be on any of them that creates a file only if it isn't there.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Operations after which a version has the same rows as the one before.
UPKEEP = ("OPTIMIZE", "VACUUM", "ANALYZE", "SET PROPERTIES")


@dataclass(frozen=True)
class Commit:
    version: int
    operation: str
    run_id: str
    at: float
    rows: int
    by: list[str] = field(default_factory=list)
    schema: str = ""
    #: folders that came, with their numbers of rows, and folders that count no more
    add: dict[str, int] = field(default_factory=dict)
    remove: list[str] = field(default_factory=list)


class Conflict(RuntimeError):
    """Another writer took this version."""


def readable_version(history: Iterable[tuple[int, str]], committed: int) -> int:
    """The last version with the rows of the committed one: upkeep may follow it, any other operation ends the walk."""
    found = committed
    for version, operation in sorted(history):
        if version <= committed:
            continue
        if operation not in UPKEEP:
            break
        found = version
    return found


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def history(self, table: str) -> list[Commit]:
        folder = self._path(table, "_log")
        if not self._fs().exists(folder):
            return []
        out = []
        for status in self._fs().listStatus(folder):
            if status.getPath().getName().endswith(".json"):
                stream = self._fs().open(status.getPath())
                try:
                    out.append(Commit(**json.loads(bytes(stream.readAllBytes()).decode())))
                finally:
                    stream.close()
        return sorted(out, key=lambda c: c.version)

    def _live(self, history: list[Commit], version: int | None = None) -> dict[str, int]:
        """Folders that a version consists of, with their numbers of rows."""
        live: dict[str, int] = {}
        for c in history:
            if version is None or c.version <= version:
                for gone in c.remove:
                    live.pop(gone)
                live |= c.add
        return live

    def _data(self, table: str, schema: StructType, folders: Iterable[str]) -> DataFrame:
        paths = [f"{self.root}/{table}/data/{f}" for f in folders]
        if not paths:
            return self.spark.createDataFrame([], schema)
        marked = StructType([*schema.fields, StructField("_commit", StringType())])
        return self.spark.read.schema(marked).option("basePath", f"{self.root}/{table}/data").parquet(*paths)

    @staticmethod
    def _folder() -> Column:
        """The folder, relative to the table's data, that a row's file lies in."""
        return F.regexp_extract(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "/data/(.*)/[^/]+$", 1)

    def _write(self, table: str, df: DataFrame, by: Sequence[str]) -> tuple[str, dict[str, int]]:
        own = f"_commit={uuid.uuid4().hex}"
        df.write.partitionBy(*by).parquet(f"{self.root}/{table}/data/{own}")
        rows = self._data(table, df.schema, [own]).groupBy(self._folder().alias("folder")).agg(F.count("*").alias("n")).collect()
        return own, {r["folder"]: r["n"] for r in rows}

    def _publish(self, table: str, held: list[Commit], commit: Commit) -> Commit:
        """Makes a commit visible under the version that follows ``held``, unless another writer did so before."""
        told = json.dumps(asdict(commit)).encode()
        try:
            stream = self._fs().create(self._path(table, "_log", f"{commit.version:020d}.json"), False)
        except Exception as error:
            raise Conflict(f"{table}: version {commit.version} exists") from error
        stream.write(bytearray(told))
        stream.close()
        return commit

    def _commit(self, table: str, held: list[Commit], df: DataFrame, operation: str, run_id: str, by: Sequence[str], remove: Iterable[str] = (), must: Column | None = None) -> Commit:
        """Writes ``df`` and publishes it in place of the folders ``remove``; rows must satisfy ``must``."""
        by = held[-1].by if held else list(by)
        own, add = self._write(table, df, by)
        try:
            if must is not None and self._data(table, df.schema, add).where(~F.coalesce(must, F.lit(False))).limit(1).count():
                raise ValueError("new rows lie outside the replaced part")
            while True:
                live = self._live(held)
                remove = [f for f in remove if f in live]
                rows = sum(live.values()) - sum(live[f] for f in remove) + sum(add.values())
                version = held[-1].version + 1 if held else 0
                try:
                    return self._publish(table, held, Commit(version, operation, run_id, time.time(), rows, by, df.schema.json(), add, remove))
                except Conflict:
                    if operation != "APPEND":
                        raise
                    held = self.history(table)  # nothing that others did can contradict new rows
        except Exception:
            self._fs().delete(self._path(table, "data", own), True)
            raise

    def read(self, table: str, version: int | None = None) -> DataFrame:
        held = self.history(table)
        if not held:
            raise LookupError(f"{table} has no version")
        wanted = held[-1].version if version is None else version
        commit = next((c for c in held if c.version == wanted), None)
        if commit is None:
            raise LookupError(f"{table} has no version {wanted}")
        schema = StructType.fromJson(json.loads(commit.schema))
        return self._data(table, schema, self._live(held, wanted)).select(*schema.names)

    def _all(self, table: str, held: list[Commit]) -> DataFrame:
        return self._data(table, StructType.fromJson(json.loads(held[-1].schema)), self._live(held))

    def overwrite(self, table: str, df: DataFrame, run_id: str = "", by: Sequence[str] = ()) -> Commit:
        held = self.history(table)
        return self._commit(table, held, df, "OVERWRITE", run_id, by, self._live(held))

    def append(self, table: str, df: DataFrame, run_id: str = "", by: Sequence[str] = ()) -> Commit:
        return self._commit(table, self.history(table), df, "APPEND", run_id, by)

    def _rewritten(self, table: str, held: list[Commit], going: DataFrame) -> tuple[list[str], DataFrame]:
        """Folders that hold any of the rows ``going`` (of ``_all``, still with their files' names), and all rows of these folders."""
        touched = sorted(r["folder"] for r in going.select(self._folder().alias("folder")).distinct().collect())
        return touched, self._data(table, StructType.fromJson(json.loads(held[-1].schema)), touched)

    def replace(self, table: str, predicate: Column, df: DataFrame, run_id: str = "", by: Sequence[str] = ()) -> Commit:
        """Rows that match go, ``df`` comes; new rows that don't match are refused.  Partitions without such rows stay as they are."""
        held, match = self.history(table), F.coalesce(predicate, F.lit(False))
        if not held:
            return self._commit(table, held, df, "REPLACE", run_id, by, must=predicate)
        touched, rows = self._rewritten(table, held, self._all(table, held).where(match))
        kept = rows.where(~match)
        if not kept.limit(1).count():
            return self._commit(table, held, df, "REPLACE", run_id, by, touched, must=predicate)
        if df.where(~match).limit(1).count():
            raise ValueError("new rows lie outside the replaced part")
        return self._commit(table, held, kept.select(*df.columns).unionByName(df), "REPLACE", run_id, by, touched)

    def delete_orphans(self, table: str, key: str, living: DataFrame, run_id: str = "", by: Sequence[str] = ()) -> Commit:
        """Rows whose key lives no more go."""
        held, alive = self.history(table), living.select(key).distinct()
        schema = StructType.fromJson(json.loads(held[-1].schema))
        folder = "__folder"
        going = self._all(table, held).withColumn(folder, self._folder()).join(alive, key, "left_anti")
        touched = sorted(r[folder] for r in going.select(folder).distinct().collect())
        kept = self._data(table, schema, touched).select(*schema.names).join(alive, key, "left_semi").select(*schema.names)
        return self._commit(table, held, kept, "DELETE", run_id, by, touched)

    def optimize(self, table: str, order: Sequence[str], files: int, run_id: str = "", by: Sequence[str] = ()) -> Commit:
        """The same rows, ranged and sorted so that scans can skip files."""
        held = self.history(table)
        return self._commit(table, held, self.read(table).repartitionByRange(files, *order).sortWithinPartitions(*order), "OPTIMIZE", run_id, by, self._live(held))

    def readable(self, table: str, committed: int) -> int:
        return readable_version([(c.version, c.operation) for c in self.history(table)], committed)

    def published(self, table: str, run_table: str = "commits") -> int:
        """The version that the latest run published, from the commit table (run_id, table, version, at)."""
        row = self.read(run_table).where(F.col("table") == table).agg(F.max_by("version", F.struct("at", "version")).alias("v")).first()
        if row is None or row["v"] is None:
            raise LookupError(f"{table} was never published")
        return row["v"]


def stage(df: DataFrame, path: str) -> DataFrame:
    """Written and read again: what follows doesn't compute it anew, and sees one state of it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export(df: DataFrame, path: str, kind: str = "tsv") -> None:
    """For checkers outside: TSV, CSV or JSON lines, instants as microseconds."""
    out = df.select(*[F.unix_micros(c).alias(c) if k == "timestamp" else F.col(c) for c, k in df.dtypes])
    if kind == "json":
        out.write.mode("overwrite").json(path)
    else:
        out.write.mode("overwrite").csv(path, header=True, sep="\t" if kind == "tsv" else ",")
