"""Mixing sources to target weights: tokens per source give repetition rates, a hash-seeded Bernoulli draw gives the rest.

Targets fill up like vessels: every source gets its weight's part of the mix but stops at ``most`` times its own size, and
what it can't take is shared among the others by weight.  A document is emitted floor(rate) times, and once more if its
draw is below the rate's fraction.  The draws come from SHA-256 digests of the document's id; each source uses, of
``DRAWS`` such seeds, the one whose total comes nearest to its target, which a second aggregation over sizes finds.  Texts
are never shuffled and a source of any size is spread over all tasks.  DataFrame functions only.

Defined cases: a null text has size 0, a null source is a source of its own and comes last; a null id counts as an empty
one; rows that repeat an id share its draw; sources without a word have target 0; an empty table gives an empty result.
The table of sources, one narrow row each, is ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_ROWS, durable, join_groups, unused

#: Seeds tried for each source: eight draws of 32 bits from each of four digests.
DRAWS = 32
_ONE = 2.0**32


def words(text: Column) -> Column:
    """Number of maximal runs of characters other than 0x20 and 0x09 to 0x0D."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target, rate: from ``sizes`` (source, size), with ``weights`` dealt in turn over the sources in code-point order."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.partitionBy(F.lit(0))
    turn = F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights)).cast("int") + 1)
    by = by.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(most))
    full = every.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    others = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    by = by.withColumn("left", left).withColumn("others", others).withColumn("over", F.col("most") * F.col("others") >= F.col("weight") * F.col("left"))
    # the first source that is not full sets the level of all that follow
    level_left = F.first(F.when(F.col("over"), F.col("left")), ignorenulls=True).over(full.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level_others = F.first(F.when(F.col("over"), F.col("others")), ignorenulls=True).over(full.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.when(F.col("over"), F.col("weight") * F.col("level_left") / F.col("level_others")).otherwise(F.col("most"))
    by = by.withColumn("level_left", level_left).withColumn("level_others", level_others).withColumn("target", F.least(target, F.col("most")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return by.select("source", "source_size", "target", rate.alias("rate"))


def _key() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))


def _digests() -> list[Column]:
    return [F.sha2(F.concat(F.lit(f"{j}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256) for j in range(DRAWS // 8)]


def _with_source(docs: DataFrame, sources: DataFrame, key: str, rows: str) -> DataFrame:
    """Each row with its source's columns: by broadcast of sources that were counted, of those alone that hold a fixed share of
    all rows where there are more than ``BROADCAST_ROWS`` (the others by shuffle), so that no source ever fills a task."""
    there = sources.agg(F.count("*").alias("n"), F.coalesce(F.sum(rows), F.lit(0)).alias("rows")).first()
    if there.n <= BROADCAST_ROWS:
        return docs.join(F.broadcast(sources), key)
    return join_groups(docs, sources, [key], rows, there.rows)


def plan(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """key (of the source), rows, source_size, target, whole, part, seed: one row per source of ``sizes`` (doc_id, source, size)."""
    rate = F.col("rate")
    often = sizes.groupBy(_key().alias("key")).agg(F.count("*").alias("rows"))
    level = targets(sizes, weights, share, most).select(_key().alias("key"), "source_size", "target", F.floor(rate).alias("whole"), (rate - F.floor(rate)).alias("part"))
    level = durable(level.join(often, "key"), "targets")
    rated = _with_source(sizes.select("doc_id", "size", _key().alias("key")), level, "key", "rows").withColumn("digests", F.array(*_digests()))
    draws = [F.conv(F.substring(F.col("digests")[k // 8], 1 + 8 * (k % 8), 8), 16, 10).cast("double") for k in range(DRAWS)]
    below = [F.sum(F.when(draw < F.col("part") * _ONE, F.col("size")).otherwise(0)).alias(f"d{k}") for k, draw in enumerate(draws)]
    drawn = rated.groupBy("key", "rows", "source_size", "target", "whole", "part").agg(*below)
    off = [F.struct(F.abs(F.col("whole") * F.col("source_size") + F.col(f"d{k}") - F.col("target")).alias("off"), F.lit(k).alias("seed")) for k in range(DRAWS)]
    return durable(drawn.select("key", "rows", "source_size", "target", "whole", "part", F.least(*off)["seed"].alias("seed")), "plan")


def with_copies(docs: DataFrame, planned: DataFrame, names: tuple[str, str, str] = ("source_size", "target", "copies")) -> DataFrame:
    """``docs`` (doc_id, source and any other columns) with its source's size and target, and how often the mix takes the row.

    """
    own = {c: unused(docs, f"mix_{c}") for c in planned.columns}
    keyed = docs.withColumn(own["key"], _key())
    joined = _with_source(keyed, planned.select(*[F.col(c).alias(n) for c, n in own.items()]), own["key"], own["rows"])
    seed = F.col(own["seed"])
    digest = F.element_at(F.array(*_digests()), F.floor(seed / 8).cast("int") + 1)
    draw = F.conv(digest.substr(1 + 8 * (seed % 8), F.lit(8)), 16, 10).cast("double")
    copies = F.col(own["whole"]) + (draw < F.col(own["part"]) * _ONE).cast("long")
    given = [F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*given, F.col(own["source_size"]).alias(names[0]), F.col(own["target"]).alias(names[1]), copies.alias(names[2]))


def sizes_of(docs: DataFrame) -> DataFrame:
    """doc_id, source, size of every row, written down: texts are read once for all that follows."""
    return durable(docs.select("doc_id", "source", words(F.col("text")).alias("size")), "sizes")


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it, with all its columns."""
    names = tuple(unused(docs, f"mix_{c}") for c in ("source_size", "target", "copies"))
    taken = with_copies(docs, plan(sizes_of(docs), weights, share, most), names)
    again = unused(taken, "again")
    return taken.withColumn(again, F.explode(F.array_repeat(F.lit(1), F.col(names[2]).cast("int")))).select(*[F.col(f"`{c}`") for c in docs.columns])
