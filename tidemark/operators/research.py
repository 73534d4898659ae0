"""Deterministic backtests over point-in-time inputs: windows over decision instants, no driver loop over rows.

A decision is made at every instant from what the as-of read gives for it.  The weight of an asset is its volatility target
over its annual volatility, at most ``leverage``, over the number of assets, if its momentum is positive (and, if asked for,
its income is); a macro brake scales it while inflation is above a level.  The weight of one instant earns the return to the
next, and changes of weight cost.
"""

from __future__ import annotations

import itertools
import json
import math
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.digests import of_lines
from tidemark.plans.sizes import small


@dataclass(frozen=True)
class Params:
    lookback: int
    target_vol: float
    brake: bool
    need_profit: bool
    cost_bps: float = 5.0

    def __post_init__(self) -> None:
        if self.lookback < 1 or not 0 < self.target_vol <= 1 or self.cost_bps < 0:
            raise ValueError(f"no such strategy: {self}")

    @property
    def name(self) -> str:
        return f"lb{self.lookback}-vol{self.target_vol:g}-{'brake' if self.brake else 'nobrake'}-{'profit' if self.need_profit else 'any'}"


def grid(lookbacks: tuple[int, ...] = (20, 60, 120), vols: tuple[float, ...] = (0.1, 0.2)) -> list[Params]:
    """Every combination, brakes and profit filters on and off."""
    return [Params(*p) for p in itertools.product(lookbacks, vols, (False, True), (False, True))]


def params_frame(spark: SparkSession, params: list[Params]) -> DataFrame:
    return spark.createDataFrame([(p.name, *asdict(p).values()) for p in params], "params string, lookback int, target_vol double, brake boolean, need_profit boolean, cost_bps double")


def decision_grid(spark: SparkSession, entities: DataFrame, start: str, end: str, hour: int = 6) -> DataFrame:
    """entity x every day from start to end at an hour (UTC)."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("d"))
    return entities.select("entity").distinct().crossJoin(F.broadcast(days)).select("entity", (F.col("d").cast("timestamp") + F.make_interval(hours=F.lit(hour))).alias("as_of"))


def observed(read: DataFrame, names: dict[str, str]) -> DataFrame:
    """The as-of read in columns: entity, as_of, close, close_time, vol, income, inflation; ``names`` maps these to features."""
    pick = lambda n, c="value": F.max(F.when(F.col("feature") == names[n], F.col(c))) if n in names else F.lit(None).cast("double" if c == "value" else "timestamp")
    rows = read.where(F.col("feature").isin([*names.values()]) & F.col("value").isNotNull())
    return rows.groupBy("entity", "as_of").agg(pick("close").alias("close"), pick("close", "event_time").alias("close_time"), pick("vol").alias("vol"), pick("income").alias("income"), pick("inflation").alias("inflation"))


def positions(seen: DataFrame, params: DataFrame, assets: int, periods: int = 365, brake_above: float = 0.03, brake_to: float = 0.5, leverage: float = 2.0, has_income: Column | None = None) -> DataFrame:
    """params, entity, as_of, close, weight, before (the weight held until then), ret (since the instant before).

    Momentum looks back over observations, not instants: a close counts once, where it is first seen.
    """
    by = Window.partitionBy("entity").orderBy("as_of")
    fresh = F.col("close").isNotNull() & ~F.lag("close_time").over(by).eqNullSafe(F.col("close_time"))
    # fresh closes are numbered; a close meets the one ``lookback`` numbers earlier
    rows = seen.withColumn("fresh", fresh).withColumn("n", F.sum(F.col("fresh").cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    numbered = rows.where("fresh").select("entity", F.col("n").alias("m"), F.col("close").alias("past"))
    rows = rows.withColumn("prior", F.lag("close").over(by)).crossJoin(small(params)).withColumn("m", F.col("n") - F.col("lookback"))
    rows = rows.join(numbered, ["entity", "m"], "left")
    momentum = F.try_divide(F.col("close"), F.col("past")) - 1
    size = F.least(F.col("target_vol") / (F.col("vol") * math.sqrt(periods)), F.lit(leverage))
    size = size * F.when(F.col("brake") & (F.col("inflation") > brake_above), brake_to).otherwise(1.0)
    profitable = ~F.col("need_profit") | ~(F.lit(True) if has_income is None else has_income) | F.coalesce(F.col("income") > 0, F.lit(False))
    fit = (momentum > 0) & F.coalesce(F.col("vol") > 0, F.lit(False)) & profitable
    rows = rows.withColumn("weight", F.when(F.coalesce(fit, F.lit(False)), size / assets).otherwise(0.0))
    mine = Window.partitionBy("params", "entity").orderBy("as_of")
    held = F.coalesce(F.lag("weight").over(mine), F.lit(0.0))
    ret = F.coalesce(F.try_divide(F.col("close"), F.nullif(F.col("prior"), F.lit(0.0))) - 1, F.lit(0.0))
    return rows.withColumn("before", held).withColumn("ret", ret).select("params", "cost_bps", "entity", "as_of", "close", "weight", "before", "ret")


def daily(held: DataFrame) -> DataFrame:
    """params, as_of, pnl, cost, net, gross, turnover."""
    turnover = F.sum(F.abs(F.col("weight") - F.col("before")))
    out = held.groupBy("params", "as_of", "cost_bps").agg(F.sum(F.col("before") * F.col("ret")).alias("pnl"), turnover.alias("turnover"), F.sum(F.abs("weight")).alias("gross"))
    out = out.withColumn("cost", F.col("turnover") * F.col("cost_bps") / 10_000)
    return out.select("params", "as_of", "pnl", "cost", (F.col("pnl") - F.col("cost")).alias("net"), "gross", "turnover")


def metrics(days: DataFrame, periods: int = 365) -> DataFrame:
    """Per parameter set: total and annual return, volatility (sample), Sharpe, largest drawdown, days, mean gross, turnover.

    The equity curve is a running sum of logarithms; a curve that reaches zero has no annual return.
    """
    by = Window.partitionBy("params").orderBy("as_of")
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    ruin = F.max((F.col("net") <= -1).cast("int")).over(upto) == 1
    curve = days.withColumn("equity", F.when(ruin, 0.0).otherwise(F.exp(F.sum(F.ln(F.greatest(1 + F.col("net"), F.lit(1e-300)))).over(upto))))
    curve = curve.withColumn("fall", 1 - F.col("equity") / F.greatest(F.max("equity").over(upto), F.lit(1.0)))
    out = curve.groupBy("params").agg(
        F.max_by("equity", "as_of").alias("equity"), F.count("*").alias("days"), F.avg("net").alias("mean"), F.coalesce(F.stddev_samp("net"), F.lit(0.0)).alias("std"),
        F.greatest(F.max("fall"), F.lit(0.0)).alias("max_drawdown"), F.avg("gross").alias("average_gross"), F.sum("turnover").alias("turnover"),
    )
    return out.select(
        "params", (F.col("equity") - 1).alias("total_return"),
        F.when(F.col("equity") > 0, F.pow("equity", F.lit(periods) / F.col("days")) - 1).otherwise(0.0).alias("annual_return"),
        (F.col("std") * math.sqrt(periods)).alias("annual_volatility"),
        F.when(F.col("std") > 0, F.col("mean") / F.col("std") * math.sqrt(periods)).otherwise(0.0).alias("sharpe"),
        "max_drawdown", "days", "average_gross", "turnover",
    )


def fingerprint(df: DataFrame, columns: list[str], places: int = 9) -> DataFrame:
    """rows and digest of a frame, whatever its order."""
    kinds = dict(df.dtypes)
    text = lambda c: F.coalesce((F.unix_micros(c) if kinds[c] == "timestamp" else F.col(c).cast(f"decimal(38,{places})") if kinds[c] == "double" else F.col(c)).cast("string"), F.lit("~"))
    return df.agg(F.count("*").alias("rows"), of_lines(F.concat_ws("|", *[text(c) for c in columns])).alias("digest"))


def replay_differences(recorded: DataFrame, again: DataFrame, key: list[str]) -> DataFrame:
    """key, column, recorded, replayed: every value of two runs that differs, a row that one lacks included."""
    columns = [c for c in recorded.columns if c not in key]
    a = recorded.select(*key, F.struct(*columns).alias("__a"))
    b = again.select(*key, F.struct(*columns).alias("__b"))
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col("__a")[c].cast("string").alias("recorded"), F.col("__b")[c].cast("string").alias("replayed")) for c in columns])
    return a.join(b, key, "full").select(*key, F.inline(pairs)).where(~F.col("recorded").eqNullSafe(F.col("replayed")))


def params_json(p: Params) -> str:
    return json.dumps(asdict(p), sort_keys=True)
