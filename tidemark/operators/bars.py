"""Time-series bars: from trades to minutes, from minutes to days, and two venues compared over a dense grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.temporal import session_end

DEC, WIDE = "decimal(28,10)", "decimal(38,10)"


def _at(value: str, *order: str, last: bool) -> Column:
    """The value at the first or last place of a total order."""
    return (F.max_by if last else F.min_by)(F.col(value), F.struct(*order))


def _weighted(price: Column, weight: Column) -> Column:
    """Mean price by weight, in double precision; null without weight."""
    price, weight = price.cast("double"), weight.cast("double")
    total = F.sum(F.when(price.isNotNull(), weight))
    return F.when(total > 0, F.sum(price * weight) / total)


def minute_bars(trades: DataFrame, keys: list[str] = ["symbol"], unit: str = "minute") -> DataFrame:  # noqa: B006
    """OHLCV bars of ``trades`` (keys, trade_id, price, quantity, event_time, knowable_at).

    Trades at one instant follow their ids.  A bar is knowable when it is over and all its trades are knowable.
    """
    start = F.date_trunc(unit, "event_time")
    bars = trades.groupBy(*keys, start.alias("bar_time")).agg(
        _at("price", "event_time", "trade_id", last=False).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        _at("price", "event_time", "trade_id", last=True).alias("close"),
        F.sum("quantity").cast(WIDE).alias("volume"),
        F.count("*").alias("trades"),
        _weighted(F.col("price"), F.col("quantity")).alias("vwap"),
        F.max("knowable_at").alias("last_known"),
    )
    over = F.col("bar_time") + F.expr(f"INTERVAL 1 {unit.upper()}")
    return bars.withColumn("knowable_at", F.greatest(over, "last_known")).drop("last_known")


def candles_as_bars(candles: DataFrame, keys: list[str] = ["symbol"]) -> DataFrame:  # noqa: B006
    """Ready-made candles (keys, event_time, open, high, low, close, volume, knowable_at) in the shape of bars."""
    none = lambda kind: F.lit(None).cast(kind)
    return candles.select(
        *keys, F.date_trunc("minute", "event_time").alias("bar_time"), "open", "high", "low", "close", F.col("volume").cast(WIDE).alias("volume"),
        none("bigint").alias("trades"), none("double").alias("vwap"), F.greatest(F.col("event_time") + F.expr("INTERVAL 1 MINUTE"), "knowable_at").alias("knowable_at"),
    )


def daily_bars(minutes: DataFrame, keys: list[str] = ["symbol"], day: Column | None = None, zone: str = "UTC") -> DataFrame:  # noqa: B006
    """Daily bars of minute bars; ``day`` is the session's date (by default that of the bar's instant).

    The mean price weighs only minutes that have one.  Knowable at the session's end or with its last minute.
    """
    day = F.to_date("bar_time") if day is None else day
    out = minutes.groupBy(*keys, day.alias("session_date")).agg(
        _at("open", "bar_time", last=False).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        _at("close", "bar_time", last=True).alias("close"),
        F.sum("volume").cast(WIDE).alias("volume"),
        F.sum("trades").alias("trades"),
        F.count("*").alias("minutes"),
        _weighted(F.col("vwap"), F.col("volume")).alias("vwap"),
        F.max("knowable_at").alias("last_known"),
    )
    return out.withColumn("knowable_at", F.greatest(session_end(F.col("session_date"), zone), "last_known")).drop("last_known")


def with_consolidated(daily: DataFrame, consolidated: DataFrame) -> DataFrame:
    """Daily bars built here and those that a feed delivers whole, one below the other."""
    return daily.unionByName(consolidated, allowMissingColumns=True)


def day_grid(days: DataFrame, minutes: int = 1440) -> DataFrame:
    """days (keys, session_date) x every minute of the day."""
    start = F.col("session_date").cast("timestamp")
    return days.withColumn("minute", F.explode(F.sequence(start, start + F.make_interval(mins=F.lit(minutes - 1)), F.expr("INTERVAL 1 MINUTE"))))


def compare_venues(left: DataFrame, right: DataFrame, keys: list[str] = ["symbol"], most_bps: float = 100.0) -> DataFrame:  # noqa: B006
    """Every minute of every day that either venue has, with a status and the difference of closes in basis points of the right.

    ``left`` and ``right``: keys, bar_time, close.  agree, price_divergence, missing_left, missing_right or missing_both.
    """
    day = lambda df: df.select(*keys, F.to_date("bar_time").alias("session_date"))
    days = day(left).unionByName(day(right)).distinct()
    side = lambda df, name: df.select(*keys, F.date_trunc("minute", "bar_time").alias("minute"), F.col("close").alias(name))
    grid = day_grid(days).join(side(left, "left_close"), [*keys, "minute"], "left").join(side(right, "right_close"), [*keys, "minute"], "left")
    l, r = F.col("left_close").cast("double"), F.col("right_close").cast("double")
    bps = F.when(r != 0, F.abs(l - r) / F.abs(r) * 10000)
    status = (
        F.when(l.isNull() & r.isNull(), "missing_both").when(l.isNull(), "missing_left").when(r.isNull(), "missing_right").when(bps > most_bps, "price_divergence").otherwise("agree")
    )
    return grid.withColumn("diff_bps", bps).withColumn("status", status)


STATUSES = ("agree", "price_divergence", "missing_left", "missing_right", "missing_both")


def daily_status(compared: DataFrame, keys: list[str] = ["symbol"]) -> DataFrame:  # noqa: B006
    """Minutes of each status per day, and the largest difference."""
    return compared.groupBy(*keys, "session_date").agg(*[F.count_if(F.col("status") == s).alias(s) for s in STATUSES], F.max("diff_bps").alias("worst_bps"))
