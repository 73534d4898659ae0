"""Audits for look-ahead: each returns the cases, and none is the right answer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.temporal import local_midnight
from tidemark.plans.asof import as_of



def open_bars(bars: DataFrame, over: Column) -> DataFrame:
    """Bars knowable before they were over, or never."""
    return bars.where(F.col("knowable_at").isNull() | (F.col("knowable_at") < over))


def knowable_from(facts: DataFrame, filings: DataFrame, zone: str = "America/New_York") -> DataFrame:
    """Per filing (symbol, accession): form, filed, period_end, and the instant it was public: its acceptance, else midnight after the filed date."""
    told = facts.groupBy("symbol", "accession").agg(
        F.max("form").alias("form"), F.max("filed").alias("filed"),
        F.coalesce(F.max(F.when(F.col("taxonomy") != "dei", F.col("period_end"))), F.max("period_end")).alias("period_end"),
    )
    joined = told.join(filings.select("symbol", "accession", "acceptance"), ["symbol", "accession"], "left")
    basis = F.when(F.col("acceptance").isNotNull(), "acceptance").otherwise("filed_date")
    return joined.withColumn("knowable_basis", basis).withColumn("knowable_from", F.coalesce("acceptance", local_midnight(F.col("filed"), zone, 1)))


def before_source(features: DataFrame, sources: DataFrame) -> DataFrame:
    """Features knowable before their source (entity, source_ref, source_knowable), or without one."""
    told = sources.select("entity", "source_ref", "source_knowable")
    joined = features.join(told, ["entity", "source_ref"], "left")
    return joined.where(F.col("source_knowable").isNull() | (F.col("knowable_at") < F.col("source_knowable")))


def visibility_probe(features: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source (entity, source_ref, source_knowable): rows of its own seen one microsecond early, and at its instant."""
    probes = {"early": F.col("source_knowable") - F.expr("INTERVAL 1 MICROSECOND"), "on_time": F.col("source_knowable")}
    out = sources.select("entity", "source_ref", "source_knowable")
    for name, at in probes.items():
        instants = sources.select("entity", "source_ref", at.alias("as_of"))
        seen = as_of(features, instants.select("entity", "as_of")).join(instants, ["entity", "as_of", "source_ref"])
        out = out.join(seen.groupBy("entity", "source_ref").agg(F.count("*").alias(name)), ["entity", "source_ref"], "left")
    return out.withColumns({n: F.coalesce(n, F.lit(0)) for n in probes})


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either that the other lacks, as a bag, with ``side``."""
    b = b.select(*a.columns)
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def differences_within(a: DataFrame, b: DataFrame, value: str = "value", tolerance: float = 1e-9) -> DataFrame:
    """Rows of either that the other lacks, as a bag keyed by all other columns; values count as equal within ``tolerance`` of the larger.

    Of rows that repeat a key the n-th smallest values meet; a null meets nulls only.  Columns: key, left, right, problem.
    """
    key = [c for c in a.columns if c != value]
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.col(value).asc_nulls_first()))
    told = lambda df, side: df.select(*key, place.alias("__n"), F.struct(F.col(value).cast("double").alias("v")).alias(side))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*key, "__n"]]
    both = told(a, "left").alias("l").join(told(b.select(*a.columns), "right").alias("r"), same, "full")
    met = both.select(*[F.coalesce(f"l.{c}", f"r.{c}").alias(c) for c in key], "left", "right")
    x, y = F.col("left.v"), F.col("right.v")
    near = x.eqNullSafe(y) | F.coalesce(F.abs(x - y) <= tolerance * F.greatest(F.abs(x), F.abs(y)), F.lit(False))
    problem = F.when(F.col("right").isNull(), "only left").when(F.col("left").isNull(), "only right").when(~near, "value")
    return met.select(*key, x.alias("left"), y.alias("right"), problem.alias("problem")).where("problem is not null")


def counterfactual(features: DataFrame, inputs: DataFrame, build: Callable[[DataFrame], DataFrame], instant, spine: DataFrame, global_entity: str | None = None) -> DataFrame:
    """What reading ``features`` at the instant gives and a rebuild from inputs knowable by then doesn't, and the other way round."""
    rebuilt = build(inputs.where(F.col("knowable_at") <= F.lit(instant)))
    probes = spine.select("entity").distinct().withColumn("as_of", F.lit(instant))
    return differences(as_of(features, probes, global_entity), as_of(rebuilt, probes, global_entity))


def audit_instants(knowable: list, latest: int = 3, spread: int = 3) -> list:
    """One microsecond before each of the latest instants and of some spread evenly over the rest."""
    from datetime import timedelta

    found = sorted(set(knowable))
    head, tail = found[:-latest] if latest else found, found[-latest:] if latest else []
    step = [head[round(i * (len(head) - 1) / max(1, spread - 1))] for i in range(spread)] if head and spread else []
    return [t - timedelta(microseconds=1) for t in sorted({*step, *tail})]


def sample(cases: DataFrame, n: int = 5) -> DataFrame:
    """A few cases as JSON."""
    return cases.select(F.to_json(F.struct(*cases.columns)).alias("case")).orderBy("case").limit(n)
