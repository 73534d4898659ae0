"""Declared cleaning: typed columns, look-ups, ordered rules, duplicates, quarantine, halts, gaps."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.sizes import small

DROP, HALT, RECORD = "drop", "halt", "record"
DUPLICATE = "duplicate_key"
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


@dataclass(frozen=True)
class Rule:
    """A row passes when ``condition`` (SQL) is true; null counts as failed.  Rules without a condition are judged elsewhere."""

    name: str
    condition: str | None
    action: str = DROP
    why: str = ""


@dataclass(frozen=True)
class Lookup:
    """Columns of a small table, joined by key pairs (ours, theirs); of rows that repeat a key the smallest counts."""

    table: str
    on: tuple[tuple[str, str], ...]
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Spec:
    """How one raw table becomes a typed one; expressions are SQL text over the raw columns and earlier steps."""

    table: str
    columns: dict[str, tuple[str, str]]  # name: (type, expression)
    event_time: str
    knowable_at: str
    key: tuple[str, ...]
    rules: tuple[Rule, ...] = ()
    lookups: tuple[Lookup, ...] = ()
    derived: dict[str, tuple[str, str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        names = [*self.columns, *self.derived]
        for name in [self.table, *names, *self.key, *[r.name for r in self.rules]]:
            if not _NAME.fullmatch(name):
                raise ValueError(f"{name!r} is no identifier")
        if len(names) != len(set(names)):
            raise ValueError("a column is declared twice")
        if len({r.name for r in self.rules}) != len(self.rules):
            raise ValueError("a rule is declared twice")
        if missing := set(self.key) - set(names):
            raise ValueError(f"the key needs {sorted(missing)}")
        bad = [r.action for r in self.rules if r.action not in (DROP, HALT, RECORD)]
        if bad:
            raise ValueError(f"no such action: {bad}")


# Names, conditions and bounds of the rules of the domain.
LEAST_DOCUMENT = 10_000
ACCEPTED_HOURS = (6, 22)


def positive(*columns: str) -> Rule:
    return Rule("price_and_quantity_positive", " AND ".join(f"{c} > 0" for c in columns), why="a price or quantity that no trade can have")


BAR_CONSISTENT = Rule("ohlc_consistent", "low <= least(open, close) AND high >= greatest(open, close)", why="a range that doesn't hold its own ends")


def reported(column: str = "value") -> Rule:
    return Rule("value_reported", f"{column} IS NOT NULL", why="the release has no value for this date")


def numeric(column: str = "value") -> Rule:
    return Rule("value_numeric", f"try_cast({column} AS DECIMAL(38,6)) IS NOT NULL", why="no number")


PERIOD_ORDERED = Rule("period_ordered", "period_start IS NULL OR period_start <= period_end", why="a period that ends before it starts")


def document_has_text(chars: str = "html_chars", least: int = LEAST_DOCUMENT) -> Rule:
    return Rule("document_has_text", f"{chars} >= {least}", why="too short to be a report")


def accepted_in_hours(at: str = "acceptance_time", filed: str = "filing_date", zone: str = "America/New_York", days: int = 7) -> Rule:
    """Accepted in the office's hours, not after the filing's day and not more than ``days`` before it, there."""
    there = f"from_utc_timestamp({at}, '{zone}')"
    window = f"to_date({there}) BETWEEN date_sub({filed}, {days}) AND {filed}"
    return Rule("timestamp_plausible", f"{window} AND hour({there}) BETWEEN {ACCEPTED_HOURS[0]} AND {ACCEPTED_HOURS[1]}", why="no filing is accepted then")


def broken(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """rule, rows: how many rows fail each rule, judged on its own."""
    counts = df.agg(*[F.count_if(~F.coalesce(F.expr(r.condition), F.lit(False))).alias(r.name) for r in rules])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("rows")) for r in rules])))


#: Rules that every table can take; expressions name the columns that ``prepare`` makes.
def standard_rules(spec_key: tuple[str, ...], low: str = "TIMESTAMP'2000-01-01'", high: str = "TIMESTAMP'2100-01-01'") -> tuple[Rule, ...]:
    return (
        Rule("record_parses", "_corrupt_record IS NULL"),
        Rule("source_registered", "_registered", HALT),
        Rule("key_present", " AND ".join(f"{k} IS NOT NULL" for k in spec_key)),
        Rule("timestamp_plausible", f"event_time >= {low} AND event_time < {high}"),
        Rule("knowable_at_present", "knowable_at IS NOT NULL", HALT),
        Rule("knowable_at_not_before_event", "knowable_at >= event_time", HALT),
        Rule(DUPLICATE, None),
    )


def typed(df: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Declared columns by SQL text; what doesn't cast becomes null."""
    return df.withColumns({n: F.expr(e).try_cast(kind) for n, (kind, e) in columns.items()})


def with_registry(df: DataFrame, registry: DataFrame, on: list[str]) -> DataFrame:
    """_registered: whether the row's source is in the (small) registry."""
    known = registry.select(*on).distinct().withColumn("_registered", F.lit(True))
    return df.join(small(known), on, "left").withColumn("_registered", F.coalesce("_registered", F.lit(False)))


def look_up(df: DataFrame, table: DataFrame, lookup: Lookup) -> DataFrame:
    theirs = [t for _, t in lookup.on]
    right = table.groupBy(*theirs).agg(F.min(F.struct(*lookup.columns)).alias("__found"))
    right = right.select(*[F.col(t).alias(f"__{t}") for t in theirs], *[F.col("__found")[c].alias(c) for c in lookup.columns])
    on = None
    for ours, t in lookup.on:
        one = F.col(ours) == F.col(f"__{t}")
        on = one if on is None else on & one
    return df.join(right, on, "left").drop(*[f"__{t}" for t in theirs])


def prepare(raw: DataFrame, spec: Spec, tables: dict[str, DataFrame] | None = None, registry: DataFrame | None = None, registry_on: list[str] = ["_source", "_dataset"]) -> DataFrame:  # noqa: B006
    """Typed columns, registry flag, look-ups, derived columns, event_time and knowable_at, in that order; raw columns stay."""
    df = typed(raw, spec.columns)
    df = with_registry(df, registry, registry_on) if registry is not None else df.withColumn("_registered", F.lit(True))
    for lookup in spec.lookups:
        df = look_up(df, (tables or {})[lookup.table], lookup)
    df = typed(df, spec.derived)
    return df.withColumn("event_time", F.expr(spec.event_time)).withColumn("knowable_at", F.expr(spec.knowable_at))


def first_failure(rules: tuple[Rule, ...]) -> Column:
    """The name of the first rule that fails, or null; recording rules and those without a condition are left out."""
    out = F.lit(None).cast("string")
    for rule in reversed([r for r in rules if r.condition and r.action != RECORD]):
        out = F.when(~F.coalesce(F.expr(rule.condition), F.lit(False)), rule.name).otherwise(out)
    return out


def passes(rules: tuple[Rule, ...], names: list[str] | None = None) -> Column:
    """Whether all rules, or those named, hold."""
    out = F.lit(True)
    for rule in rules:
        if rule.condition and (names is None or rule.name in names):
            out = out & F.coalesce(F.expr(rule.condition), F.lit(False))
    return out


def flag_duplicates(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """``rule`` becomes duplicate_key on all but the first passing row of a key; a failed row never takes a good one's place.

    Null parts of a key are equal.  ``order`` is completed by all columns, so that the choice is the same every time.
    """
    plain = [F.to_json(F.struct(*df.columns))]
    place = F.row_number().over(Window.partitionBy(*key, F.col("rule").isNull()).orderBy(*order, *plain))
    return df.withColumn("__place", place).withColumn("rule", F.when(F.col("rule").isNull() & (F.col("__place") > 1), DUPLICATE).otherwise(F.col("rule"))).drop("__place")


def evaluate(prepared: DataFrame, spec: Spec, scope: list[str] = [], order: list[Column] = []) -> DataFrame:  # noqa: B006
    """``rule``: the first rule each row fails.  ``scope`` adds columns (such as the file) within which keys are unique."""
    judged = prepared.withColumn("rule", first_failure(spec.rules))
    if any(r.name == DUPLICATE for r in spec.rules):
        judged = flag_duplicates(judged, [*scope, *spec.key], order)
    return judged


def accepted(judged: DataFrame, spec: Spec, lineage: list[str] = []) -> DataFrame:  # noqa: B006
    return judged.where("rule is null").select(*spec.columns, *spec.derived, "event_time", "knowable_at", *lineage)


def quarantined(judged: DataFrame, spec: Spec, raw_columns: list[str], lineage: list[str] = []) -> DataFrame:  # noqa: B006
    """Rejected rows with the rule, both times and the raw record as JSON."""
    drops = [r.name for r in spec.rules if r.action == DROP]
    rows = judged.where(F.col("rule").isin(drops))
    return rows.select(F.lit(spec.table).alias("table"), "rule", "event_time", "knowable_at", F.to_json(F.struct(*raw_columns)).alias("record"), *lineage)


def failures(judged: DataFrame, by: list[str] = []) -> DataFrame:  # noqa: B006
    """Rows per rule (null: accepted), within ``by``."""
    return judged.groupBy(*by, "rule").agg(F.count("*").alias("rows"))


def load_log(judged: DataFrame, by: list[str]) -> DataFrame:
    """One row per file: rows read, accepted, and a map of rejections by rule."""
    counted = failures(judged, by)
    pairs = F.collect_list(F.when(F.col("rule").isNotNull(), F.struct("rule", "rows")))
    return counted.groupBy(*by).agg(
        F.sum("rows").alias("rows_read"), F.coalesce(F.sum(F.when(F.col("rule").isNull(), F.col("rows"))), F.lit(0)).alias("rows_accepted"), F.map_from_entries(F.sort_array(pairs)).alias("rejected_by_rule")
    )


class Halted(RuntimeError):
    """A rule that must hold does not: nothing may be written."""


def halt_violations(judged: DataFrame, spec: Spec, sample: int = 5) -> DataFrame:
    """Per halting rule that failed: rows, and a few of them as JSON, the smallest ones."""
    halts = [r.name for r in spec.rules if r.action == HALT]
    bad = judged.where(F.col("rule").isin(halts)).withColumn("record", F.to_json(F.struct(*[c for c in judged.columns if c != "rule"])))
    few = bad.withColumn("n", F.row_number().over(Window.partitionBy("rule").orderBy("record"))).where(F.col("n") <= sample)
    told = few.groupBy("rule").agg(F.sort_array(F.collect_list("record")).alias("sample"))
    return bad.groupBy("rule").agg(F.count("*").alias("rows")).join(told, "rule")


def check_halts(judged: DataFrame, spec: Spec) -> None:
    found = halt_violations(judged, spec).select("rule", "rows").collect()
    if found:
        raise Halted(f"{spec.table}: " + ", ".join(f"{r['rule']}: {r['rows']} rows" for r in sorted(found)))


def drill(prepared: DataFrame, spec: Spec, by: list[str], order: list[Column], fault: str = "missing") -> DataFrame:
    """A rehearsal: the first row of each file that passes loses its knowable_at (missing) or gets one before its event (early)."""
    good = passes(spec.rules, [r.name for r in spec.rules if r.action == DROP])
    place = F.row_number().over(Window.partitionBy(*by, good).orderBy(*order))
    to = F.lit(None).cast("timestamp") if fault == "missing" else F.col("event_time") - F.expr("INTERVAL 1 SECOND")
    hit = good & (place == 1)
    return prepared.withColumn("__hit", hit).withColumn("knowable_at", F.when(F.col("__hit"), to).otherwise(F.col("knowable_at"))).drop("__hit")


def sequence_gaps(rows: DataFrame, keys: list[str], position: str, step: int = 1, first: Column | None = None, last: Column | None = None) -> DataFrame:
    """Missing stretches of an evenly stepped sequence: keys, gap_start, gap_end, missing.

    With ``first`` or ``last`` (functions of the keys) also what lacks before and after; a group without any row has no gap.
    """
    order = Window.partitionBy(*keys).orderBy(position)
    here = F.col(position).cast("long")
    inner = rows.select(*keys, (F.lag(here).over(order) + step).alias("gap_start"), (here - step).alias("gap_end")).where(F.col("gap_end") >= F.col("gap_start"))
    if first is not None or last is not None:
        ends = rows.groupBy(*keys).agg(F.min(here).alias("low"), F.max(here).alias("high"))
        if first is not None:
            inner = inner.unionByName(ends.select(*keys, first.cast("long").alias("gap_start"), (F.col("low") - step).alias("gap_end")).where(F.col("gap_end") >= F.col("gap_start")))
        if last is not None:
            inner = inner.unionByName(ends.select(*keys, (F.col("high") + step).alias("gap_start"), last.cast("long").alias("gap_end")).where(F.col("gap_end") >= F.col("gap_start")))
    return inner.withColumn("missing", F.floor((F.col("gap_end") - F.col("gap_start")) / step) + 1)


def gap_totals(gaps: DataFrame, by: list[str]) -> DataFrame:
    return gaps.groupBy(*by).agg(F.count("*").alias("gaps"), F.sum("missing").alias("missing"))
