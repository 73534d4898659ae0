"""Long features with two times: every value says when all it was computed from could be known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.sizes import small

COLUMNS = ["entity", "feature", "feature_group", "event_time", "knowable_at", "value", "source_table", "source_ref"]


def feature_rows(df: DataFrame, entity: Column, feature: Column, group: str, event_time: Column, knowable_at: Column, value: Column, table: str, ref: Column) -> DataFrame:
    """Rows of a source in the eight columns of features."""
    return df.select(
        entity.cast("string").alias("entity"), feature.cast("string").alias("feature"), F.lit(group).alias("feature_group"), event_time.alias("event_time"),
        knowable_at.alias("knowable_at"), value.cast("double").alias("value"), F.lit(table).alias("source_table"), ref.cast("string").alias("source_ref"),
    )


def melt(df: DataFrame, keep: list[str], values: dict[str, Column]) -> DataFrame:
    """One row per named value that is not null: feature, value."""
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), v.cast("double").alias("value")) for n, v in values.items()])
    return df.select(*keep, F.inline(pairs)).where("value is not null")


def price_features(daily: DataFrame, window: int = 20, keys: list[str] = ["symbol"], group: str = "price", table: str = "bars_1d") -> DataFrame:  # noqa: B006
    """close, volatility_<w>d and volume_mean_<w>d of daily bars (keys, session_date, close, volume, knowable_at).

    Values over ``window`` rows exist only when all of their returns do, i.e. from row window + 1.  All are knowable with the
    last of the window + 1 bars that the returns read.
    """
    order = Window.partitionBy(*keys).orderBy("session_date")
    rows = order.rowsBetween(1 - window, 0)
    close = F.col("close").cast("double")
    found = daily.withColumn("ret", F.ln(close / F.lag(close).over(order)))
    found = found.withColumn("full", F.count("ret").over(rows) == window).withColumn("known", F.max("knowable_at").over(order.rowsBetween(-window, 0)))
    found = found.withColumn("vol", F.when(F.col("full"), F.stddev_samp("ret").over(rows))).withColumn("mean", F.when(F.col("full"), F.avg(F.col("volume").cast("double")).over(rows)))
    named = {"close": close, f"volatility_{window}d": F.col("vol"), f"volume_mean_{window}d": F.col("mean")}
    long = melt(found, [*keys, "session_date", "known"], named)
    ref = F.concat_ws("/", *[F.col(k).cast("string") for k in keys], F.col("session_date").cast("string"))
    return feature_rows(long, F.col(keys[-1]), F.col("feature"), group, F.col("session_date").cast("timestamp"), F.col("known"), F.col("value"), table, ref)


def year_over_year(vintages: DataFrame, series: str = "series_id", day: str = "observation_date", vintage: str = "vintage_date", value: str = "value", known: str = "knowable_at") -> DataFrame:
    """The change to twelve months before within one vintage: rows without that month go, an earlier 0 gives null."""
    now = vintages.select(series, vintage, F.col(day), F.col(value).cast("double").alias("now"), F.col(known).alias("now_known"))
    past = vintages.select(series, vintage, F.col(day).alias("past_day"), F.col(value).cast("double").alias("past"), F.col(known).alias("past_known"))
    joined = now.withColumn("past_day", F.add_months(day, -12)).join(past, [series, vintage, "past_day"])
    return joined.select(series, vintage, day, F.try_divide("now", F.nullif("past", F.lit(0.0))).alias("ratio"), F.greatest("now_known", "past_known").alias(known)).withColumn("yoy", F.col("ratio") - 1).drop("ratio")


def map_concepts(facts: DataFrame, mapping: DataFrame, on: list[str]) -> DataFrame:
    """Facts whose concept is mapped, for the durations that the mapping allows.  ``mapping``: on, metric, priority, durations; it is small."""
    return facts.join(small(mapping), on).where(F.array_contains("durations", F.col("duration")))


def pick_concept(facts: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by priority, then by the other columns so that the order is total."""
    rest = [F.col(c) for c in facts.columns if c not in keys]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *rest))
    return facts.withColumn("__rank", rank).where("__rank = 1").drop("__rank")
