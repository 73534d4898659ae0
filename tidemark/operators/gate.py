"""The gate: measured failures against thresholds and waivers, and which days are to be compared at all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.sizes import small

ANY = "*"

# Check, subject, rate, tolerance.
THRESHOLDS = (
    ("rejection_rate", ANY, 0.01, 2.0),
    ("rejection_rate", "edgar_company_facts.duplicate_key", 1.0, 0.0),
    ("rejection_rate", "edgar_filings.duplicate_key", 1.0, 0.0),
    ("venue_divergence", ANY, 0.001, 3.0),
    ("venue_missing", ANY, 0.01, 0.0),
)


def thresholds(spark: SparkSession, own: Sequence[tuple[str, str, float, float]] = ()) -> DataFrame:
    """check, subject, rate, tolerance: the fixed ones, each replaced by one of ``own`` for the same check and subject."""
    rows = {t[:2]: t for t in (*THRESHOLDS, *own)}
    return spark.createDataFrame(list(rows.values()), "check string, subject string, rate double, tolerance double")


def judge(measured: DataFrame, thresholds: DataFrame, waivers: DataFrame | None = None) -> DataFrame:
    """``measured`` (check, subject, day, measured, failed) with allowed, passed, waived and outcome.

    ``thresholds`` (check, subject, rate, tolerance): a subject's own goes before that of ``*``; both are small.  Passed means
    failed <= rate * measured + tolerance; a check without threshold allows nothing.  ``waivers`` (check, subject, day) turn
    failures only.
    """
    named = lambda p: thresholds.select("check", "subject", F.col("rate").alias(f"{p}_rate"), F.col("tolerance").alias(f"{p}_tolerance"))
    own = small(named("own").where(F.col("subject") != ANY))
    every = small(named("any").where(F.col("subject") == ANY).drop("subject"))
    df = measured.join(own, ["check", "subject"], "left").join(every, "check", "left")
    allowed = F.coalesce(F.col("own_rate") * F.col("measured") + F.col("own_tolerance"), F.col("any_rate") * F.col("measured") + F.col("any_tolerance"), F.lit(0.0))
    df = df.withColumn("allowed", allowed).withColumn("passed", F.col("failed") <= F.col("allowed")).drop("own_rate", "own_tolerance", "any_rate", "any_tolerance")
    if waivers is None:
        df = df.withColumn("waived", F.lit(False))
    else:
        told = small(waivers.select("check", "subject", "day").distinct().withColumn("__waived", F.lit(True)))
        df = df.join(told, ["check", "subject", "day"], "left").withColumn("waived", F.coalesce("__waived", F.lit(False)) & ~F.col("passed")).drop("__waived")
    return df.withColumn("outcome", F.when(F.col("passed"), "passed").when(F.col("waived"), "waived").otherwise("failed"))


def rejections(log: DataFrame, table: str = "table", day: str = "day") -> DataFrame:
    """check, subject, day, measured, failed of a load log (table, day, rows_read, rejected_by_rule)."""
    read = log.groupBy(table, day).agg(F.sum("rows_read").alias("measured"))
    told = log.select(table, day, F.explode("rejected_by_rule").alias("rule", "n")).groupBy(table, day, "rule").agg(F.sum("n").alias("failed"))
    return told.join(read, [table, day]).select(F.concat(F.lit("rejected/"), "rule").alias("check"), F.col(table).alias("subject"), F.col(day).alias("day"), "measured", "failed")


def rejection_rates(rules: DataFrame, log: DataFrame, keys: list[str] = ["table"]) -> DataFrame:  # noqa: B006
    """Rejected, judged and rate per declared rule (keys, rule), rules without a rejection included, tables never loaded left out."""
    judged = log.groupBy(*keys).agg(F.sum("rows_read").alias("judged"))
    told = log.select(*keys, F.explode("rejected_by_rule").alias("rule", "n")).groupBy(*keys, "rule").agg(F.sum("n").alias("rejected"))
    df = rules.join(judged, keys).join(told, [*keys, "rule"], "left").withColumn("rejected", F.coalesce("rejected", F.lit(0)))
    return df.withColumn("rate", F.col("rejected") / F.nullif(F.col("judged"), F.lit(0)))


def comparisons_due(left: DataFrame, right: DataFrame, done: DataFrame, today, grace_days: int) -> DataFrame:
    """Days (key, day, hash) of two venues that are to be compared: on both sides, or one-sided beyond the grace; not when this pair of hashes was."""
    l = left.select("key", "day", F.col("hash").alias("left_hash"))
    r = right.select("key", "day", F.col("hash").alias("right_hash"))
    both = l.join(r, ["key", "day"], "full")
    ripe = (F.col("left_hash").isNotNull() & F.col("right_hash").isNotNull()) | (F.datediff(F.lit(today), "day") > grace_days)
    told = done.select(F.col("key").alias("k"), F.col("day").alias("d"), F.col("left_hash").alias("lh"), F.col("right_hash").alias("rh"))
    same = (F.col("key") == F.col("k")) & (F.col("day") == F.col("d")) & F.col("left_hash").eqNullSafe(F.col("lh")) & F.col("right_hash").eqNullSafe(F.col("rh"))
    return both.where(ripe).join(told, same, "left_anti")
