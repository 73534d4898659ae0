"""Served queries: SQL text with named parameters over registered views, and the portfolio's windows.

``run`` refuses unknown names and parameters; values never enter the text.
"""

from __future__ import annotations

import re
import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.plans.sizes import small


@dataclass(frozen=True)
class View:
    sql: str
    parameters: dict[str, type] = field(default_factory=dict)


#: load_log(path, table, symbol, period, rows, rejected, run, loaded_at, rules map), facts, days, comparisons, registry, stored(key, result, at), history(client, pruned_files, read_files, workload, seconds), results(run_id, checked_at, check, outcome, drill), backtests(run_id, at, metrics map)
VIEWS = {
    "coverage": View(
        """SELECT `table`, symbol, min(period) AS first_period, max(period) AS last_period, count(DISTINCT period) AS periods, sum(rows) AS rows, max(loaded_at) AS last_loaded
        FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY loaded_at DESC, run DESC) AS n FROM load_log) WHERE n = 1 GROUP BY ALL"""
    ),
    "trailing_days": View(
        """SELECT `table`, period, sum(rows) AS rows, sum(rejected) AS rejected FROM (SELECT *, max(period) OVER (PARTITION BY `table`) AS newest FROM load_log)
        WHERE period > date_sub(newest, :days) GROUP BY ALL""",
        {"days": int},
    ),
    "rejected_share": View(
        """SELECT `table`, sum(rejected) AS rejected, sum(rows) AS judged, sum(rejected) / nullif(sum(rows), 0) AS rate FROM load_log GROUP BY `table` ORDER BY rate DESC, `table`"""
    ),
    "latest_gate": View(
        """SELECT check, outcome, count(*) AS n FROM results WHERE run_id = (SELECT max_by(run_id, struct(checked_at, run_id)) FROM results WHERE NOT drill) GROUP BY ALL"""
    ),
    "newest_backtests": View(
        """SELECT run_id, at, element_at(metrics, 'sharpe') AS sharpe, element_at(metrics, 'days') AS days FROM backtests ORDER BY at DESC, run_id LIMIT :most""",
        {"most": int},
    ),
    "pruned_share": View(
        """SELECT client, sum(pruned_files) AS pruned, sum(read_files) AS read, try_divide(sum(pruned_files), sum(pruned_files) + sum(read_files)) AS share FROM history
        WHERE client LIKE :client GROUP BY client""",
        {"client": str},
    ),
    "day_range": View("""SELECT symbol, min(session_date) AS first_day, max(session_date) AS last_day, count(*) AS days FROM days GROUP BY symbol"""),
    "known_days": View(
        """SELECT symbol, session_date, CAST(close AS DOUBLE) AS close, knowable_at <= :as_of AS known FROM days
        WHERE session_date BETWEEN date_sub(CAST(:as_of AS DATE), :back) AND date_add(CAST(:as_of AS DATE), :ahead)""",
        {"as_of": object, "back": int, "ahead": int},
    ),
    "known_plus_upcoming": View(
        """(SELECT entity, source_ref, knowable_at, true AS known FROM facts WHERE knowable_at <= :as_of ORDER BY knowable_at DESC, source_ref DESC LIMIT :known)
        UNION ALL (SELECT entity, source_ref, knowable_at, false FROM facts WHERE knowable_at > :as_of ORDER BY knowable_at, source_ref LIMIT :upcoming)""",
        {"as_of": object, "known": int, "upcoming": int},
    ),
    "filtered_maxima": View(
        """SELECT entity, max(value) FILTER (WHERE feature = :feature) AS of_feature, max(value) FILTER (WHERE feature <> :feature) AS of_others, count(*) AS facts FROM facts WHERE knowable_at <= :as_of GROUP BY entity""",
        {"feature": str, "as_of": object},
    ),
    "snapshot": View(
        """SELECT entity, feature, max_by(value, struct(event_time, knowable_at)) AS value, max_by(event_time, struct(event_time, knowable_at)) AS event_time, max_by(knowable_at, struct(event_time, knowable_at)) AS knowable_at
        FROM facts WHERE entity IN (:entity, :shared) AND knowable_at <= :as_of GROUP BY entity, feature""",
        {"entity": str, "shared": str, "as_of": object},
    ),
    "latest_checks": View("""SELECT run_id, check, outcome, drill FROM results WHERE checked_at = (SELECT max(checked_at) FROM results)"""),
    "latest_comparisons": View(
        """SELECT left_venue, right_venue, day, agreed, differing FROM (SELECT *, row_number() OVER (PARTITION BY left_venue, right_venue, day ORDER BY compared_at DESC, run_id DESC) AS n FROM comparisons) WHERE n = 1"""
    ),
    "registry": View("""SELECT source, table, entity FROM registry"""),
    "reusable": View("""SELECT key, result, at FROM stored WHERE array_contains(:keys, key) ORDER BY at, key""", {"keys": list}),
    "cost_by_workload": View("""SELECT workload, sum(seconds) AS seconds, count(*) AS queries FROM history GROUP BY workload"""),
    "rejects_by_rule": View("""SELECT rule, sum(n) AS rejected FROM (SELECT explode(rules) AS (rule, n) FROM load_log) GROUP BY rule HAVING sum(n) > 0"""),
    "stale_tables": View("""SELECT `table`, max(loaded_at) AS last_loaded FROM load_log GROUP BY `table` HAVING max(loaded_at) < timestampadd(DAY, -:days, :as_of)""", {"days": int, "as_of": object}),
    "rows_per_day": View("""SELECT to_date(loaded_at) AS day, sum(rows) AS rows FROM load_log GROUP BY 1"""),
    "waived_failures": View("""SELECT run_id, check, count(*) AS n FROM results WHERE outcome = 'failed' AND drill GROUP BY ALL"""),
    "top_sharpe": View("""SELECT run_id, at, element_at(metrics, 'sharpe') AS sharpe FROM backtests ORDER BY sharpe DESC NULLS LAST, run_id LIMIT :most""", {"most": int}),
    "first_reports": View(
        """SELECT entity, feature, event_time, min_by(value, struct(knowable_at, value)) AS value, min(knowable_at) AS first_known FROM facts WHERE knowable_at <= :as_of GROUP BY ALL""", {"as_of": object}
    ),
    "top_differences": View(
        """SELECT a.session_date, CAST(a.close - b.close AS DOUBLE) AS difference FROM days a JOIN days b ON a.session_date = b.session_date AND a.symbol = :left AND b.symbol = :right
        ORDER BY abs(a.close - b.close) DESC, a.session_date LIMIT :most""",
        {"left": str, "right": str, "most": int},
    ),
}


class BadRequest(ValueError):
    pass


def run(spark: SparkSession, name: str, **parameters) -> DataFrame:
    view = VIEWS.get(name)
    if view is None:
        raise BadRequest(f"no view {name}")
    if set(parameters) != set(view.parameters):
        raise BadRequest(f"{name} takes {sorted(view.parameters)}")
    for key, kind in view.parameters.items():
        if not isinstance(parameters[key], kind):
            raise BadRequest(f"{key} must be {kind.__name__}")
    return spark.sql(view.sql, args=parameters)


class Cache:
    """Rows of small answers by view and parameters, for a while."""

    def __init__(self, spark: SparkSession, seconds: float = 60.0):
        self.spark, self.seconds, self.held = spark, seconds, {}

    def rows(self, name: str, refresh: bool = False, **parameters) -> list:
        key = (name, tuple(sorted((k, str(v)) for k, v in parameters.items())))
        at, rows = self.held.get(key, (0.0, None))
        if refresh or rows is None or time.monotonic() - at > self.seconds:
            rows = run(self.spark, name, **parameters).collect()
            self.held[key] = time.monotonic(), rows
        return rows


class Leak(AssertionError):
    """A value that was not public at the instant asked about."""


def check_public(df: DataFrame, as_of, known: str = "knowable_at") -> DataFrame:
    """The frame, if all it holds was public by then."""
    late = df.where(F.col(known).isNull() | (F.col(known) > F.lit(as_of))).count()
    if late:
        raise Leak(f"{late} values were not public at {as_of}")
    return df


def later_dates(answer: Column, question: Column, as_of: Column) -> Column:
    """ISO dates in an answer that lie after the instant and that the question didn't name."""
    pattern = F.lit(r"\b(\d{4}-\d{2}-\d{2})\b")
    told = F.array_except(F.regexp_extract_all(answer, pattern, F.lit(1)), F.regexp_extract_all(question, pattern, F.lit(1)))
    return F.filter(told, lambda x: x.try_cast("date") > F.to_date(as_of))


# -- portfolio


def carried_forward(prices: DataFrame, holdings: DataFrame, key: str = "symbol", day: str = "session_date", price: str = "close") -> DataFrame:
    """day, value of ``holdings`` (key, quantity): each day's last known prices, from the day on which all held have one."""
    held = small(holdings.groupBy(key).agg(F.sum("quantity").alias("quantity")))
    mine = prices.join(held, key)
    days = mine.select(day).distinct()
    grid = days.crossJoin(held)
    rows = grid.join(mine.select(key, day, price), [key, day], "left")
    last = F.last(price, ignorenulls=True).over(Window.partitionBy(key).orderBy(day).rowsBetween(Window.unboundedPreceding, 0))
    filled = rows.withColumn("p", last)
    return filled.groupBy(day).agg(F.sum(F.col("p").cast("double") * F.col("quantity")).alias("value"), F.count_if(F.col("p").isNull()).alias("missing")).where("missing = 0").drop("missing")


def indexed(prices: DataFrame, key: str = "symbol", day: str = "session_date", price: str = "close") -> DataFrame:
    """Series that start at 100 on the first day that all have."""
    start = prices.groupBy(key).agg(F.min(day).alias("first")).agg(F.max("first").alias("start"))
    rows = prices.crossJoin(F.broadcast(start)).where(F.col(day) >= F.col("start"))
    base = F.first(F.col(price).cast("double")).over(Window.partitionBy(key).orderBy(day).rowsBetween(Window.unboundedPreceding, 0))
    return rows.select(key, day, (F.col(price).cast("double") / base * 100).alias("index"))


def changes(prices: DataFrame, sessions: tuple[int, ...] = (1, 5, 20), days: tuple[int, ...] = (7,), key: str = "symbol", day: str = "session_date", price: str = "close") -> DataFrame:
    """The newest price's change over so many sessions, and since the last price on or before so many days ago."""
    by = Window.partitionBy(key).orderBy(day)
    p = F.col(price).cast("double")
    rows = prices.withColumn("__p", p).withColumn("__d", F.datediff(F.col(day), F.lit("1970-01-01").cast("date")))
    for n in sessions:
        rows = rows.withColumn(f"sessions_{n}", F.col("__p") / F.lag("__p", n).over(by) - 1)
    for n in days:
        before = Window.partitionBy(key).orderBy("__d").rangeBetween(Window.unboundedPreceding, -n)
        rows = rows.withColumn(f"days_{n}", F.col("__p") / F.last("__p").over(before) - 1)
    newest = F.row_number().over(Window.partitionBy(key).orderBy(F.col(day).desc()))
    return rows.withColumn("__n", newest).where("__n = 1").select(key, day, *[f"sessions_{n}" for n in sessions], *[f"days_{n}" for n in days])


def weights(value_by_holding: DataFrame, value: str = "value") -> DataFrame:
    """Each holding's share of what is known."""
    total = value_by_holding.agg(F.sum(value).alias("__total"))
    return value_by_holding.crossJoin(F.broadcast(total)).withColumn("weight", F.try_divide(value, "__total")).drop("__total")
