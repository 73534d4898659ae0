"""Landed files: verified bytes, archives of one member, what is still to be fetched or loaded, and checks before landing."""

from __future__ import annotations

import hashlib
import io
import json
import posixpath
import zipfile
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MANIFEST = "path string, source string, dataset string, symbol string, period_start date, sha256 string, bytes long, fetched_at timestamp"


class Damaged(ValueError):
    """A file isn't what its manifest says."""


def check_sha256(content: bytes, expected: str) -> bytes:
    found = hashlib.sha256(content).hexdigest()
    if found != expected:
        raise Damaged(f"sha256 is {found}, not {expected}")
    return content


def only_member(content: bytes) -> tuple[str, bytes]:
    """Name, without any folder, and bytes of an archive's single file."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        names = [n for n in archive.namelist() if not n.endswith("/")]
        if len(names) != 1:
            raise Damaged(f"the archive has {len(names)} files, not 1")
        return posixpath.basename(names[0].replace("\\", "/")), archive.read(names[0])


def verify_files(spark: SparkSession, path: str, manifests: DataFrame) -> DataFrame:
    """path, expected, found, ok: digests of landed files, computed where the files are read."""
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.sha2("content", 256).alias("found"))
    told = manifests.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("path"), F.col("sha256").alias("expected"))
    return told.join(files, "file", "left").select("path", "expected", "found", F.coalesce(F.col("found") == F.col("expected"), F.lit(False)).alias("ok"))


def load_files(store, table: str, folder: str, manifests: DataFrame, data, run_id: str, at) -> list[str]:
    """Loads landed files into a table, verified: a file's rows replace what was loaded from it before, other files' rows stay.

    ``manifests`` say path (relative to ``folder``), symbol, period_start and sha256; ``data`` is the files' dataset.  Files whose
    bytes aren't what their manifest says are left out, and named.
    """
    from tidemark.sources.readers import read_raw, with_metadata

    spark = manifests.sparkSession
    told = {r["path"]: r for r in manifests.select("path", "symbol", F.col("period_start").cast("string").alias("period_start"), "sha256").collect()}
    checked = verify_files(spark, folder, manifests).collect()
    good = sorted(r["path"] for r in checked if r["ok"])
    rows = None
    for path in good:
        one = with_metadata(read_raw(spark, data, f"{folder}/{path}"), data, told[path]["symbol"], told[path]["period_start"], path, told[path]["sha256"], run_id, at)
        rows = one if rows is None else rows.unionByName(one)
    if rows is not None:
        store.replace(table, F.col("_source_file").isin(good), rows, run_id, ["_period_start"])
    return sorted(r["path"] for r in checked if not r["ok"])


def latest_manifests(manifests: DataFrame, key: list[str] = ["source", "dataset", "symbol", "period_start"]) -> DataFrame:  # noqa: B006
    """The last fetched file of each period."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.col("fetched_at").desc(), F.col("path").desc()))
    return manifests.withColumn("n", place).where("n = 1").drop("n")


def pending(manifests: DataFrame, loaded: DataFrame, limit: int | None = None) -> DataFrame:
    """Latest files whose path and digest are not in the load log, by period and path."""
    out = latest_manifests(manifests).join(loaded.select("path", "sha256"), ["path", "sha256"], "left_anti").orderBy("period_start", "path")
    return out if limit is None else out.limit(limit)


def to_fetch(wanted: DataFrame, landed: DataFrame, today, grace_days: int = 0) -> DataFrame:
    """Periods (source, dataset, symbol, period_start) not landed yet; ``due`` when their provider's grace is over."""
    key = ["source", "dataset", "symbol", "period_start"]
    return wanted.join(landed.select(*key), key, "left_anti").withColumn("due", F.datediff(F.lit(today), "period_start") > grace_days)


@dataclass(frozen=True)
class Outcome:
    period: str
    error: str | None = None


def sync(periods: list[str], fetch, place) -> list[Outcome]:
    """Fetches and places each period, the file before its manifest; what fails for one doesn't stop the others."""
    out = []
    for period in periods:
        try:
            content = fetch(period)
            place(period, content)
            place(period + ".manifest.json", json.dumps({"path": period, "sha256": hashlib.sha256(content).hexdigest(), "bytes": len(content)}, sort_keys=True).encode())
            out.append(Outcome(period))
        except Exception as error:  # one period's failure is its own outcome
            out.append(Outcome(period, str(error)))
    return out


# -- checks of responses, as conditions on parsed rows


def candle_problems(rows: DataFrame, step: int = 60) -> DataFrame:
    """Candles (time in s, low, high, open, close, volume, all text) off the grid, repeated, or with prices out of order."""
    n = lambda c: F.col(c).try_cast("decimal(28,10)")
    at = F.col("time").try_cast("bigint")
    times = F.count("*").over(Window.partitionBy("time"))
    why = (
        F.when(at.isNull(), "no_time").when(at % step != 0, "off_grid").when(times > 1, "repeated")
        .when(F.coalesce((n("low") <= F.least(n("open"), n("close"))) & (n("high") >= F.greatest(n("open"), n("close"))) & (n("low") > 0) & (n("volume") >= 0), F.lit(False)), None)
        .otherwise("bad_prices")
    )
    return rows.withColumn("problem", why).where("problem is not null")


def page_problems(pages: DataFrame, records: Column, token: Column) -> DataFrame:
    """Pages (page_no) without records, or that repeat the token of another."""
    times = F.count(token).over(Window.partitionBy(token))
    return pages.withColumn("problem", F.when(records.isNull(), "no_records").when(token.isNotNull() & (times > 1), "repeated_token")).where("problem is not null")


def vintage_problems(declared: DataFrame, got: DataFrame) -> DataFrame:
    """Series whose number of observations isn't what the provider declared: series_id, declared, got."""
    counted = got.groupBy("series_id").agg(F.count("*").alias("got"))
    return declared.join(counted, "series_id", "left").withColumn("got", F.coalesce("got", F.lit(0))).where("got <> declared")


def fact_problems(facts: DataFrame) -> DataFrame:
    """Facts without accession, unit or value."""
    return facts.where("accession is null or unit is null or value is null")


def document_ok(html: Column, least: int = 10_000) -> Column:
    """Long enough and closed."""
    return F.coalesce((F.length(html) >= least) & F.lower(html).contains("</html>"), F.lit(False))
