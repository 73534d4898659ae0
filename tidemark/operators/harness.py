"""Running a decider whose answers vary: strict answers, a bounded agent, tools bound to an instant, and rounds of samples."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import counterfactual as cf
from tidemark.operators import views


def strict_answer(text: str, allowed: dict[str, Sequence[str]]) -> dict[str, str] | None:
    """A JSON object with exactly the parts asked for, each with an allowed value; else None."""
    try:
        found = json.loads(text)
    except ValueError:
        return None
    if not isinstance(found, dict) or set(found) != set(allowed) or any(found[k] not in v for k, v in allowed.items()):
        return None
    return found


class Tools:
    """Five questions about what was public at one instant; nothing later can be asked for, and every row is checked again.

    They read the registered views ``days`` and ``facts`` and return JSON lines.
    """

    def __init__(self, spark: SparkSession, as_of: datetime, holdings: DataFrame, entity: str = "GLOBAL"):
        self.spark, self.as_of, self.holdings, self.shared = spark, as_of, holdings, entity
        self.all = {f.__name__: f for f in (self.symbol_digest, self.price_history, self.compare_symbols, self.my_portfolio, self.macro)}

    def _days(self) -> DataFrame:
        return self.spark.table("days").where(F.col("knowable_at") <= F.lit(self.as_of))

    def _said(self, df: DataFrame) -> str:
        rows = views.check_public(df, self.as_of)
        return "\n".join(r["j"] for r in rows.select(F.to_json(F.struct("*")).alias("j")).sort("j").collect())

    def symbol_digest(self, symbol: str) -> str:
        return self._said(views.run(self.spark, "snapshot", entity=symbol, shared=symbol, as_of=self.as_of))

    def price_history(self, symbol: str, days: int) -> str:
        if not 1 <= days <= 1000:
            raise views.BadRequest("days must lie between 1 and 1000")
        return self._said(self._days().where((F.col("symbol") == symbol) & (F.col("session_date") >= F.date_sub(F.lit(self.as_of).cast("date"), days))).select("session_date", "close", "knowable_at"))

    def compare_symbols(self, symbols: list[str]) -> str:
        if not 2 <= len(set(symbols)) <= 3:
            raise views.BadRequest("two or three symbols can be compared")
        known = self._days().where(F.col("symbol").isin(symbols))
        return self._said(views.changes(known).join(known.select("symbol", "session_date", "knowable_at"), ["symbol", "session_date"]))

    def my_portfolio(self) -> str:
        value = self._days().groupBy("symbol").agg(F.max_by(F.col("close").cast("double"), "session_date").alias("price"), F.max("knowable_at").alias("knowable_at"))
        held = self.holdings.groupBy("symbol").agg(F.sum("quantity").alias("quantity")).join(value, "symbol")
        worth = held.select("symbol", (F.col("quantity") * F.col("price")).alias("value"), "knowable_at")
        return self._said(views.weights(worth))

    def macro(self) -> str:
        return self._said(views.run(self.spark, "snapshot", entity=self.shared, shared=self.shared, as_of=self.as_of))


def run_agent(model: Callable[[list[dict]], dict], tools: dict[str, Callable[..., str]], question: str, steps: int = 8) -> dict:
    """A bounded loop: the model answers or calls a tool; tool errors go back to it, a leak ends it; after ``steps`` there is no answer."""
    told: list[dict] = [{"role": "user", "text": question}]
    calls = []
    for _ in range(steps):
        said = model(told)
        if "answer" in said:
            return {"answer": said["answer"], "calls": calls}
        name, arguments = said.get("tool"), said.get("arguments", {})
        calls.append((name, json.dumps(arguments, sort_keys=True)))
        try:
            result = tools[name](**arguments)
        except views.Leak:
            raise
        except Exception as error:  # what a tool raises is an answer to the model
            result = f"error: {error}"
        told.append({"role": "tool", "name": name, "text": result})
    return {"answer": None, "calls": calls}


def rounds(worlds: DataFrame, ask: Callable[[DataFrame], DataFrame], was: DataFrame, total: int, least: float, size: int = 5, stage: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """world, sample, part, value: up to ``total`` samples of each of ``worlds`` (world), in rounds of ``size``.

    ``ask`` takes (world, sample) and returns the answers; null values are invalid ones.  A world is asked again only while every
    part may still be settled as it ``was`` (part, value).  ``stage`` writes a round down, so that none is asked twice.
    """
    told, still = None, worlds.select("world")
    for first in range(0, total, size):
        numbers = F.explode(F.sequence(F.lit(first), F.lit(min(total, first + size) - 1)))
        new = stage(ask(still.select("world", numbers.alias("sample"))))
        told = new if told is None else told.unionByName(new)
        asked = min(total, first + size)
        valid = told.groupBy("world", "sample").agg(F.min(F.col("value").isNotNull()).alias("ok")).groupBy("world").agg(F.count_if("ok").alias("valid"))
        agree = told.join(was.select("part", F.col("value").alias("was")), "part").groupBy("world", "part").agg(F.count_if(F.col("value") == F.col("was")).alias("agree"))
        hope = cf.can_settle(F.col("agree"), F.col("valid"), F.lit(asked), total, least)
        state = stage(agree.join(valid, "world").groupBy("world").agg(F.min(hope).alias("hope")))
        still = still.join(state.where("hope"), "world", "left_semi")
    return told
