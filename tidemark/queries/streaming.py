"""Streams, run until what is there is read; the same windows on tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.queries import frames as fr
from tidemark.streaming import streams

#: Files of manifests, so that the upsert takes several batches.
_FILES = 12


def _folder(spark, name: str) -> str:
    """A folder of its own under the shared one, or under the warehouse where none is named."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def _manifests(spark, log, root: str) -> str:
    """Manifests of a load log as files, written by tasks: one per path, and of some a second one, fetched later."""
    told = log.select(
        "path", F.lit("s").alias("source"), F.col("table").alias("dataset"), "symbol", F.col("period").cast("string").alias("period_start"), F.md5("path").alias("sha256"), F.col("rows").alias("bytes"),
        F.date_format("loaded_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("fetched_at"),
    )
    written, landed = f"{root}/written", f"{root}/landed"
    told.repartition(_FILES).write.json(written)
    # the driver only renames: a manifest is known by its ending
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    fs = path(written).getFileSystem(conf)
    fs.mkdirs(path(landed))
    for f in fs.listStatus(path(written)):
        name = f.getPath().getName()
        if name.startswith("part-") and not fs.rename(f.getPath(), path(f"{landed}/{name.removesuffix('.json')}.manifest.json")):
            raise OSError(f"{written}/{name} could not be renamed")
    return landed


def discovered(spark, log):
    """The manifests of ``log`` as a stream finds them."""
    root = _folder(spark, "manifests")
    landed = _manifests(spark, log, root)
    for _ in range(2):  # the second run finds nothing new
        streams.discover(spark, landed, f"{root}/table", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/table").select("path", "dataset", "symbol", "period_start", "sha256", "bytes", *fr.micros("fetched_at"))


def latest(spark, log):
    """The latest manifest of each path of ``log``, merged batch by batch."""
    from tidemark.sources.store import SnapshotStore

    root = _folder(spark, "latest")
    landed = _manifests(spark, log, root)
    stream = streams.manifest_stream(spark, landed, most_files=3).drop("_manifest_path")
    streams.upsert_latest(stream, ["path"], ["fetched_at", "bytes"], f"{root}/store", f"{root}/checkpoint")
    return SnapshotStore(spark, f"{root}/store").read("latest").select("path", "bytes", *fr.micros("fetched_at"))


def stream_manifest_available_now(spark, d):
    return discovered(spark, fr.load_log(spark, d))


def stream_latest_wins(spark, d):
    return latest(spark, fr.load_log(spark, d))


def tumbling_window(spark, d):
    return _told(streams.windowed(fr.table(spark, d, "events"), "ts", "6 hours", by=["event_type"]))


def sliding_window(spark, d):
    return _told(streams.windowed(fr.table(spark, d, "events"), "ts", "6 hours", "2 hours"))


def session_windows(spark, d):
    out = streams.sessions(fr.table(spark, d, "events"), "ts", "8 hours", ["user_id"])
    return out.select("user_id", *fr.micros("session_start", "session_end"), "n")


def _told(df):
    return df.select(*fr.micros("window_start", "window_end"), *[c for c in df.columns if c not in ("window_start", "window_end", "total")], F.round("total", 4).alias("total"))


def stream_tumbling_window(spark, d):
    """The tumbling window as a stream with a watermark, in one run over the table's file: complete windows and those still open."""
    root = _folder(spark, "windows")
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    events = spark.readStream.schema(schema).parquet(f"{d}/events*.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    name = f"w{uuid.uuid4().hex}"
    query = streams.windowed(events, "ts", "6 hours", by=["event_type"], late="1 hour").writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return _told(spark.table(name))


QUERIES = {f.__name__: f for f in (stream_manifest_available_now, stream_latest_wins, tumbling_window, sliding_window, session_windows, stream_tumbling_window)}

_SLIDE = """w AS (SELECT unnest(generate_series(time_bucket(INTERVAL {slide} HOUR, ts, TIMESTAMP '2024-01-01') - INTERVAL {back} HOUR, time_bucket(INTERVAL {slide} HOUR, ts, TIMESTAMP '2024-01-01'), INTERVAL {slide} HOUR)) AS s, event_type, value FROM events)"""
_TUMBLE = f"WITH {_SLIDE.format(slide=6, back=0)} SELECT epoch_us(s) AS window_start_us, epoch_us(s + INTERVAL 6 HOUR) AS window_end_us, event_type, count(*) AS n, round(sum(value), 4) AS total FROM w GROUP BY s, event_type"

ORACLE = {
    "stream_manifest_available_now": f"""WITH {fr.LOAD_LOG} SELECT path, "table" AS dataset, symbol, period AS period_start, md5(path) AS sha256, rows AS bytes, epoch_us(loaded_at) AS fetched_at_us FROM log""",
    "stream_latest_wins": f"""WITH {fr.LOAD_LOG} SELECT path, rows AS bytes, epoch_us(loaded_at) AS fetched_at_us FROM log QUALIFY row_number() OVER (PARTITION BY path ORDER BY loaded_at DESC, rows DESC) = 1""",
    "tumbling_window": _TUMBLE,
    "stream_tumbling_window": _TUMBLE,
    "sliding_window": f"WITH {_SLIDE.format(slide=2, back=4)} SELECT epoch_us(s) AS window_start_us, epoch_us(s + INTERVAL 6 HOUR) AS window_end_us, count(*) AS n, round(sum(value), 4) AS total FROM w GROUP BY s",
    "session_windows": """WITH e AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 8 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT user_id, epoch_us(min(ts)) AS session_start_us, epoch_us(max(ts) + INTERVAL 8 HOUR) AS session_end_us, count(*) AS n FROM g GROUP BY user_id, k""",
}
