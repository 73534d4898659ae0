"""Looking after tables: freshness, profiles and drift, costs at the price of the time, retention, staging."""

from __future__ import annotations

import os
import time
from collections.abc import Iterable, Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.sizes import small


def newest(tables: dict[str, DataFrame], floors: dict[str, object] | None = None, known: str = "knowable_at") -> DataFrame:
    """table, newest: the latest knowable instant per table.  A floor (the last one found) prunes the scan; where it leaves nothing, the whole table counts."""
    out = None
    for name, df in tables.items():
        floor = (floors or {}).get(name)
        kept = df if floor is None else df.where(F.col(known) >= F.lit(floor))
        if floor is not None and not kept.limit(1).count():
            kept = df
        one = kept.agg(F.max(known).alias("newest")).select(F.lit(name).alias("table"), "newest")
        out = one if out is None else out.unionByName(one)
    return out


def staleness(found: DataFrame, tolerances: DataFrame, now) -> DataFrame:
    """age_days and stale: older than the table's tolerance in days, or empty."""
    age = (F.unix_micros(F.lit(now)) - F.unix_micros("newest")) / F.lit(86_400_000_000.0)
    joined = found.join(small(tolerances), "table").withColumn("age_days", age)
    return joined.withColumn("stale", F.col("age_days").isNull() | (F.col("age_days") > F.col("tolerance_days")))


def profile(df: DataFrame, at: str, unit: str, numbers: list[str], categories: list[str], slices: list[str] = [], most: int = 100) -> DataFrame:  # noqa: B006
    """Per window (and slice) and column: rows, distinct values, exact median of numbers, and the categories' values if at most ``most``."""
    by = [F.date_trunc(unit, at).alias("window_start"), *slices]
    keys = ["window_start", *slices]
    rows = df.groupBy(*by).agg(F.count("*").alias("rows"))
    out = rows.select(*keys, F.lit(":table").alias("column_name"), "rows", F.lit(None).cast("bigint").alias("distinct"), F.lit(None).cast("double").alias("median"), F.lit(None).cast("array<string>").alias("items"))
    for c in numbers:
        one = df.groupBy(*by).agg(F.count(c).alias("rows"), F.count_distinct(c).alias("distinct"), F.median(c).alias("median"))
        out = out.unionByName(one.select(*keys, F.lit(c).alias("column_name"), "rows", "distinct", "median", F.lit(None).cast("array<string>").alias("items")))
    for c in categories:
        # values are grouped first: a window's list has its distinct values, not its rows
        values = df.groupBy(*by, F.col(c).cast("string").alias("v")).agg(F.count("*").alias("n"))
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("n").desc(), "v"))
        one = values.withColumn("place", place).groupBy(*keys).agg(F.sum("n").alias("rows"), F.count("v").alias("distinct"), F.sort_array(F.collect_list(F.when(F.col("place") <= most, F.col("v")))).alias("items"))
        out = out.unionByName(one.select(*keys, F.lit(c).alias("column_name"), "rows", "distinct", F.lit(None).cast("double").alias("median"), "items"))
    return out


def drift(profiles: DataFrame, levels: list[str], amounts: list[str], categories: list[str], slices: list[str] = [], share: float = 0.1, level_factor: float = 2.0, amount_factor: float = 10.0) -> DataFrame:  # noqa: B006
    """The newest full window against the full one before it.

    Full: at least ``share`` of the median window's rows.  Numbers drift when medians differ by more than a factor; categories
    when a value appears or disappears, judged only where both lists are complete.
    """
    table = profiles.where((F.col("column_name") == ":table") & (F.col("rows") > 0))
    middle = table.groupBy(*slices).agg(F.median("rows").alias("middle"))
    full = (table.join(middle, slices) if slices else table.crossJoin(middle)).where(F.col("rows") >= share * F.col("middle")).select(*slices, "window_start")
    order = Window.partitionBy(*(slices or [F.lit(0)])).orderBy(F.col("window_start").desc())
    pair = full.withColumn("baseline_start", F.lead("window_start").over(order)).withColumn("n", F.row_number().over(order)).where("n = 1 and baseline_start is not null").drop("n")
    side = lambda p, at: profiles.select(*slices, F.col("window_start").alias(at), "column_name", F.col("median").alias(f"{p}_median"), F.col("items").alias(f"{p}_items"), F.col("distinct").alias(f"{p}_distinct"))
    both = pair.join(side("new", "window_start"), [*slices, "window_start"]).join(side("old", "baseline_start"), [*slices, "baseline_start", "column_name"])
    a, b = F.col("new_median"), F.col("old_median")
    factor = F.when(a.isNull() | b.isNull(), None).when((a <= 0) | (b <= 0), F.when(a == b, 1.0).otherwise(float("inf"))).otherwise(F.greatest(a, b) / F.least(a, b))
    allowed = F.when(F.col("column_name").isin(levels), level_factor).when(F.col("column_name").isin(amounts), amount_factor)
    numbers = both.where(F.col("column_name").isin([*levels, *amounts])).withColumn("factor", factor).where("factor is not null").withColumn("allowed", allowed)
    keep = [*slices, "column_name", "window_start", "baseline_start"]
    none = F.lit(None)
    numbers = numbers.select(*keep, "factor", "allowed", F.array().cast("array<string>").alias("appeared"), F.array().cast("array<string>").alias("disappeared"), (F.col("factor") > F.col("allowed")).alias("drifted"))
    complete = (F.size("new_items") == F.col("new_distinct")) & (F.size("old_items") == F.col("old_distinct"))
    named = both.where(F.col("column_name").isin(categories) & complete).withColumn("appeared", F.sort_array(F.array_except("new_items", "old_items"))).withColumn("disappeared", F.sort_array(F.array_except("old_items", "new_items")))
    named = named.select(*keep, none.cast("double").alias("factor"), none.cast("double").alias("allowed"), "appeared", "disappeared", ((F.size("appeared") > 0) | (F.size("disappeared") > 0)).alias("drifted"))
    return numbers.unionByName(named)


def priced(usage: DataFrame, prices: DataFrame, on: list[str], at: str = "at") -> DataFrame:
    """Usage with the price valid at its time: price_start <= at < price_end, an open end being null; usage without a price stays.

    ``prices`` (on, price_start, price_end, price): the validity is a residual of an equi-join.
    """
    valid = (F.col(f"u.{at}") >= F.col("p.price_start")) & (F.col("p.price_end").isNull() | (F.col(f"u.{at}") < F.col("p.price_end")))
    for c in on:
        valid = (F.col(f"u.{c}") == F.col(f"p.{c}")) & valid
    return usage.alias("u").join(prices.alias("p"), valid, "left").select("u.*", F.col("p.price").alias("price"))


def cost_rollup(with_price: DataFrame, by: list[str | Column], quantity: str = "quantity") -> DataFrame:
    return with_price.groupBy(*by).agg(F.sum(quantity).alias("quantity"), F.sum(F.col(quantity) * F.col("price")).alias("cost"), (F.count("*") - F.count("price")).alias("unpriced"))


def latest_name(changes: DataFrame, key: str, name: str = "name", at: str = "change_time") -> DataFrame:
    """key and its latest name."""
    return changes.groupBy(key).agg(F.max_by(name, F.struct(at, name)).alias(name))


def query_stats(history: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Per day and workload: queries, seconds, files read and pruned, bytes, rows."""
    df = history if names is None else history.join(names, "job_id", "left")
    workload = F.coalesce(*([F.col("name")] if names is not None else []), F.col("client"), F.lit("other"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return df.groupBy(F.to_date("start_time").alias("day"), workload.alias("workload")).agg(F.count("*").alias("queries"), (F.coalesce(F.sum("duration_ms"), F.lit(0)) / 1000).cast("double").alias("duration_s"), total("read_files"), total("pruned_files"), total("read_bytes"), total("read_rows"))


def maintenance(operations: DataFrame) -> DataFrame:
    return operations.groupBy("schema_name", "table_name", "operation").agg(F.max("end_time").alias("last_run"), F.count("*").alias("runs"), F.count_if(F.col("status") != "SUCCESSFUL").alias("failed"))


def alert(judged: DataFrame, bad: Column, text: Column) -> DataFrame:
    """One row: how many are bad, and their texts in one line."""
    return judged.agg(F.count_if(bad).alias("bad"), F.array_join(F.sort_array(F.collect_list(F.when(bad, text))), "; ").alias("message"))


def retention_issues(properties: dict[str, dict[str, str]], wanted: dict[str, str]) -> list[str]:
    """What each table's properties lack of those wanted."""
    return [f"{table}: {p} is {found.get(p, 'unset')}, not {v}" for table, found in sorted(properties.items()) for p, v in sorted(wanted.items()) if found.get(p) != v]


def staged(root: Path) -> Iterator[tuple[Path, float]]:
    """Staging folders with the time of their newest file."""
    for entry in sorted(p for p in root.iterdir() if p.is_dir()) if root.is_dir() else []:
        yield entry, max((os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(entry) for f in names), default=0.0)


def expired(folders: Iterable[tuple[Path, float]], days: float = 7, now: float | None = None) -> list[Path]:
    return [p for p, at in folders if at < (time.time() if now is None else now) - days * 86_400]


def groups_by_dependency(depends: dict[str, list[str]]) -> list[list[str]]:
    """Tables that look one another up, directly or not, together; groups and members in order of name."""
    root = {t: t for t in {*depends, *[d for ds in depends.values() for d in ds]}}

    def top(t: str) -> str:
        while root[t] != t:
            t = root[t]
        return t

    for t, others in depends.items():
        for o in others:
            a, b = sorted((top(t), top(o)))
            root[b] = a
    found: dict[str, list[str]] = {}
    for t in sorted(root):
        found.setdefault(top(t), []).append(t)
    return [found[k] for k in sorted(found)]
