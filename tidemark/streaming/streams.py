"""Streams: discovery of landed manifests, the latest row per key, event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.landing import MANIFEST


def manifest_stream(spark: SparkSession, path: str, schema: str = MANIFEST, most_files: int = 1000) -> DataFrame:
    """Rows of new ``*.manifest.json`` files with the file they came from; a file fetched again must land under a new name."""
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.manifest.json").option("maxFilesPerTrigger", most_files).json(path)
    return stream.withColumn("_manifest_path", F.col("_metadata.file_path"))


def discover(spark: SparkSession, path: str, table_path: str, checkpoint: str) -> StreamingQuery:
    """All that is there now, appended exactly once across runs; then it stops."""
    query = manifest_stream(spark, path).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(table_path)
    query.awaitTermination()
    return query


def upsert_latest(stream: DataFrame, keys: list[str], order: list[str], table_path: str, checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Keeps the greatest row per key in the table ``latest``, partitioned by the keys' hash.

    A micro-batch rewrites only the partitions that its keys fall into, and one that was merged before a restart is not merged
    again: the last commit names the batch.
    """
    from tidemark.plans.asof import latest_per_key
    from tidemark.sources.store import SnapshotStore

    def merge(batch: DataFrame, number: int) -> None:
        store, run = SnapshotStore(batch.sparkSession, table_path), f"batch {number}"
        held = store.history("latest")
        if any(c.run_id == run for c in held):
            return
        new = latest_per_key(batch, keys, order).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        touched = F.col("bucket").isin([r["bucket"] for r in new.select("bucket").distinct().collect()])
        old = store.read("latest").where(touched) if held else new.limit(0)
        store.replace("latest", touched, latest_per_key(old.select(*new.columns).unionByName(new), keys, order), run, ["bucket"])

    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def windowed(events: DataFrame, at: str, length: str, slide: str | None = None, by: list[str] = [], value: str = "value", late: str | None = None) -> DataFrame:  # noqa: B006
    """Counts and sums per tumbling or sliding window, on a stream or a table; ``late`` sets the watermark."""
    df = events.withWatermark(at, late) if late else events
    grouped = df.groupBy(F.window(at, length, slide) if slide else F.window(at, length), *by).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return grouped.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "n", "total")


def sessions(events: DataFrame, at: str, gap: str, by: list[str], late: str | None = None) -> DataFrame:
    """Stretches of activity without a pause of ``gap``."""
    df = events.withWatermark(at, late) if late else events
    grouped = df.groupBy(F.session_window(at, gap), *by).agg(F.count("*").alias("n"))
    return grouped.select(*by, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n")
