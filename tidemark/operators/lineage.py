"""Information items, the sets of them that were known, and worlds without some of them.

An item is a piece of information that became public at one instant: a bar, a filing, a release.  Every derived row depends
on items; withholding items means removing the rows they own and recomputing the rows that depend on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.digests import of_lines
from tidemark.operators.features import price_features
from tidemark.plans.sizes import small

#: Kinds in the order in which searches split them.
KINDS = ("bar", "filing", "release")


def item_id(kind: str, *parts: Column) -> Column:
    return F.concat(F.lit(f"{kind}:"), F.concat_ws("/", *[p.cast("string") for p in parts]))


def _text(c: str, kind: str) -> Column:
    """One text for a value in every engine: instants as microseconds, doubles to nine places."""
    col = F.col(c)
    if kind == "timestamp":
        col = F.unix_micros(col)
    elif kind in ("double", "float"):
        col = col.cast("decimal(28,9)")
    return F.coalesce(col.cast("string"), F.lit("~"))


def canonical(df: DataFrame, columns: list[str]) -> Column:
    kinds = dict(df.dtypes)
    return F.concat_ws("|", *[_text(c, kinds[c]) for c in columns])


def items(rows: DataFrame, kind: str, keys: list[str], content: list[str]) -> DataFrame:
    """item_id, kind, entity (the first key), knowable_at and a digest over the item's rows in sorted order."""
    told = rows.withColumn("__row", canonical(rows, [*keys, *content]))
    return told.groupBy(*keys).agg(F.max("knowable_at").alias("knowable_at"), F.sha2(F.concat_ws("\n", F.sort_array(F.collect_list("__row"))), 256).alias("digest")).select(
        item_id(kind, *[F.col(k) for k in keys]).alias("item_id"), F.lit(kind).alias("kind"), F.col(keys[0]).cast("string").alias("entity"), "knowable_at", "digest"
    )


def ambiguous(found: DataFrame) -> DataFrame:
    """Ids that name more than one item: there must be none."""
    return found.groupBy("item_id").count().where("count > 1")


class UnknownItem(ValueError):
    """An item to be withheld was not known at that instant."""


def information_set(found: DataFrame, instant, omit: list[str] = []) -> DataFrame:  # noqa: B006
    """Items knowable at the instant, without those omitted, all of which must be among them."""
    known = found.where(F.col("knowable_at") <= F.lit(instant))
    if omit:
        there = known.where(F.col("item_id").isin(omit)).select("item_id").distinct().count()
        if there != len(set(omit)):
            raise UnknownItem(f"{len(set(omit)) - there} of the items to withhold were not known")
        known = known.where(~F.col("item_id").isin(omit))
    return known


def set_hash(known: DataFrame) -> DataFrame:
    """items and set_hash: one digest of a whole set, from its items' ids and digests."""
    return known.agg(F.count("*").alias("items"), of_lines(F.concat_ws("=", "item_id", "digest")).alias("set_hash"))


def price_edges(daily: DataFrame, window: int = 20, keys: list[str] = ["symbol"]) -> DataFrame:  # noqa: B006
    """Which bars each price feature reads: row_id, item_id; the bar itself and up to ``window`` before it."""
    order = Window.partitionBy(*keys).orderBy("session_date")
    named = daily.withColumn("__id", item_id("bar", *[F.col(k) for k in keys], F.col("session_date")))
    ref = F.concat_ws("/", *[F.col(k).cast("string") for k in keys], F.col("session_date").cast("string"))
    read = F.array_compact(F.array("__id", *[F.lag("__id", n).over(order) for n in range(1, window + 1)]))
    return named.select(ref.alias("row_id"), read.alias("__ids")).select("row_id", F.explode("__ids").alias("item_id"))


def owner(features: DataFrame, kind: str = "bar") -> Column:
    """The item that owns a feature row: the one its reference names."""
    return F.concat(F.lit(f"{kind}:"), F.col("source_ref"))


def world(features: DataFrame, known: DataFrame, kind: str = "bar") -> DataFrame:
    """Feature rows owned by items of the set."""
    return features.withColumn("__owner", owner(features, kind)).join(known.select(F.col("item_id").alias("__owner")), "__owner", "left_semi").drop("__owner")


def unaccounted(features: DataFrame, found: DataFrame, instant, kind: str = "bar") -> DataFrame:
    """Rows knowable at the instant whose item is not: there must be none."""
    rows = features.where(F.col("knowable_at") <= F.lit(instant)).withColumn("__owner", owner(features, kind))
    return rows.join(information_set(found, instant).select(F.col("item_id").alias("__owner")), "__owner", "left_anti").drop("__owner")


def account(features: DataFrame, edges: DataFrame, known: DataFrame, kind: str = "bar") -> DataFrame:
    """Items of the set that the given rows read, and those nobody read: item_id, reads."""
    used = features.select(F.col("source_ref").alias("row_id")).distinct().join(edges, "row_id").groupBy("item_id").agg(F.count("*").alias("reads"))
    return known.select("item_id").join(used, "item_id", "left").withColumn("reads", F.coalesce("reads", F.lit(0)))


def hide(features: DataFrame, withheld: list[str], kind: str = "bar") -> DataFrame:
    """Only the owned rows go: the wrong way, kept as a control that audits must catch."""
    return features.where(~owner(features, kind).isin(withheld))


def rebuild(daily: DataFrame, withheld: list[str], window: int = 20, keys: list[str] = ["symbol"]) -> DataFrame:  # noqa: B006
    """All features anew from the bars that remain."""
    left = daily.where(~item_id("bar", *[F.col(k) for k in keys], F.col("session_date")).isin(withheld))
    return price_features(left, window, keys)


def affected(edges: DataFrame, withheld: DataFrame) -> DataFrame:
    """world, row_id: rows that depend on an item withheld in a world (world, item_id)."""
    return edges.join(withheld, "item_id").select("world", "row_id").distinct()


def recompute(daily: DataFrame, withheld: DataFrame, window: int = 20, keys: list[str] = ["symbol"]) -> DataFrame:  # noqa: B006
    """The rows that change in each world, recomputed in one pass for all worlds: world and the columns of features.

    ``withheld``: world, item_id.  Each world gets, under its own tag, the bars of its withheld bars' neighbourhood only: a
    row's value reads ``window`` bars before it, so ``2 * window + 1`` places around each withheld bar suffice.
    """
    order = Window.partitionBy(*keys).orderBy("session_date")
    placed = daily.withColumn("__at", F.row_number().over(order)).withColumn("item_id", item_id("bar", *[F.col(k) for k in keys], F.col("session_date")))
    gone = placed.select(*keys, F.col("__at").alias("__gone"), "item_id").join(withheld, "item_id").groupBy("world", *keys).agg(F.collect_set("__gone").alias("__gone"))
    near = placed.join(small(gone), keys)
    # the rows that follow a withheld bar are counted in bars that stay, hence the slack of all withheld ones
    slack = F.size("__gone")
    inside = F.exists("__gone", lambda g: F.col("__at").between(g - window - slack - 1, g + window + slack))
    left = near.where(inside & ~F.array_contains("__gone", F.col("__at")))
    out = price_features(left, window, ["world", *keys]).withColumn("world", F.split("source_ref", "/")[0]).withColumn("source_ref", F.expr("substring(source_ref, length(world) + 2)"))
    return out


def patch(features: DataFrame, touched: DataFrame, anew: DataFrame, world_name: str) -> DataFrame:
    """A world: the rows that nothing touched, and of the recomputed ones those that were touched and still exist."""
    mine = touched.where(F.col("world") == world_name).select(F.col("row_id").alias("source_ref"))
    untouched = features.join(mine, "source_ref", "left_anti").select(*features.columns)
    again = anew.where(F.col("world") == world_name).join(mine, "source_ref", "left_semi").select(*features.columns)
    return untouched.unionByName(again)


def coherence(patched: DataFrame, rebuilt: DataFrame, known: DataFrame, withheld: list[str], recorded: str, kind: str = "bar") -> DataFrame:
    """One row: whether a world without some items is what it claims to be.

    ``patched``: the world's rows; ``rebuilt``: all features anew without the items; ``known``: the whole information set;
    ``recorded``: its hash when nothing was withheld.  differences from the rebuild, rows still owned by a withheld item, rows
    that no item of the remaining set accounts for, whether a world that withholds nothing keeps the hash; coherent: all of them.
    """
    from tidemark.operators.leakage import differences_within

    left = known.where(~F.col("item_id").isin(withheld)) if withheld else known
    lone = patched.withColumn("__owner", owner(patched, kind)).join(left.select(F.col("item_id").alias("__owner")), "__owner", "left_anti")
    mine = patched.where(owner(patched, kind).isin(withheld)) if withheld else patched.limit(0)
    count = lambda df, name: df.agg(F.count("*").alias(name))
    told = count(differences_within(patched, rebuilt), "differences").join(count(mine, "owned"), F.lit(True)).join(count(lone, "unaccounted"), F.lit(True)).join(set_hash(left).select("set_hash"), F.lit(True))
    keeps = F.lit(bool(withheld)) | (F.col("set_hash") == recorded)
    return told.withColumn("keeps", keeps).withColumn("coherent", (F.col("differences") == 0) & (F.col("owned") == 0) & (F.col("unaccounted") == 0) & F.col("keeps")).drop("set_hash")
