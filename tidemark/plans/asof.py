"""The point-in-time read: what could be known of each entity's features at each probe instant.

A fact has an event time (what it describes) and a knowable instant.  At a probe the winner is, among facts knowable by then,
the one with the latest event time; of its revisions the latest; then the greatest source table, reference and value.  Two
plans give the same rows:

* ``merge``: facts and probes in one shuffle, sorted by instant, a running maximum.  For spines of any size.
* ``interval``: each winner's validity, then a range join with a broadcast spine.  For spines counted small, and for a
  visibility table worth keeping.

Facts of a global entity reach every probed entity; they are read once per instant, not once per entity.
Facts without a knowable instant are never visible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampType

from tidemark.plans.sizes import small

VALUE = ["event_time", "knowable_at", "source_table", "source_ref", "value"]
RESULT = ["entity", "as_of", "feature", *VALUE]
#: A spine of at most so many rows is broadcast.
SMALL_SPINE = 50_000
#: Probes of one entity that the interval plan takes.
FEW_PROBES = 64


class SpineError(ValueError):
    """A spine must have entity STRING and as_of TIMESTAMP."""


def check_spine(spine: DataFrame) -> DataFrame:
    kinds = {f.name: f.dataType for f in spine.schema}
    for name, kind in (("entity", StringType()), ("as_of", TimestampType())):
        if kinds.get(name) != kind:
            raise SpineError(f"{name} must be {kind.simpleString()}, not {kinds.get(name)}")
    return spine.select("entity", "as_of").where("entity is not null and as_of is not null").distinct()


def _won() -> Column:
    return F.struct(*VALUE)


def _known(facts: DataFrame) -> DataFrame:
    return facts.where("knowable_at is not null").select("entity", "feature", *VALUE)


def merge_plan(facts: DataFrame, spine: DataFrame) -> DataFrame:
    """Probes are dealt to the features their entity has; one window over the union of facts and probes."""
    facts = _known(facts)
    # an entity's features travel with its probes: no shuffle of facts for it beyond map-side distinct
    features = facts.select("entity", "feature").distinct()
    probes = spine.join(features, "entity").select("entity", "feature", F.col("as_of").alias("t"), F.lit(1).alias("probe"), F.lit(None).cast(facts.select(_won().alias("w")).schema["w"].dataType).alias("w"))
    both = facts.select("entity", "feature", F.col("knowable_at").alias("t"), F.lit(0).alias("probe"), _won().alias("w")).unionByName(probes)
    running = Window.partitionBy("entity", "feature").orderBy("t", "probe").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = both.withColumn("w", F.max("w").over(running)).where("probe = 1 and w is not null")
    return seen.select("entity", F.col("t").alias("as_of"), "feature", "w.*")


def visibility(facts: DataFrame) -> DataFrame:
    """entity, feature, the winner's columns, valid_from and valid_to (null: still valid): one row per change of winner."""
    revisions = _known(facts).groupBy("entity", "feature", F.col("knowable_at").alias("valid_from")).agg(F.max(_won()).alias("w"))
    order = Window.partitionBy("entity", "feature").orderBy("valid_from")
    running = revisions.withColumn("w", F.max("w").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    changed = running.withColumn("before", F.lag("w").over(order)).where(~F.col("w").eqNullSafe(F.col("before")))
    return changed.withColumn("valid_to", F.lead("valid_from").over(order)).select("entity", "feature", "w.*", "valid_from", "valid_to")


def interval_plan(facts: DataFrame, spine: DataFrame) -> DataFrame:
    """Validities joined to the probes; these are broadcast if they are few enough."""
    probes = spine.withColumnRenamed("entity", "probed")
    during = (F.col("valid_from") <= F.col("as_of")) & (F.col("valid_to").isNull() | (F.col("as_of") < F.col("valid_to")))
    return visibility(facts).join(small(probes, SMALL_SPINE), (F.col("entity") == F.col("probed")) & during).select(*RESULT)


def as_of(facts: DataFrame, spine: DataFrame, global_entity: str | None = None, plan: str = "auto") -> DataFrame:
    """entity, as_of, feature and the winner's columns for every probe of ``spine`` and feature known by then.

    ``plan``: merge, interval, or auto, which counts the spine and each entity's probes: the interval plan compares every change
    of an entity with every one of its probes.
    """
    spine = check_spine(spine)

    def read(facts: DataFrame, spine: DataFrame) -> DataFrame:
        chosen = plan
        if plan == "auto":
            few = spine.limit(SMALL_SPINE + 1).count() <= SMALL_SPINE
            chosen = "interval" if few and not spine.groupBy("entity").count().where(F.col("count") > FEW_PROBES).limit(1).count() else "merge"
        return (merge_plan if chosen == "merge" else interval_plan)(facts, spine)

    if global_entity is None:
        return read(facts, spine).select(*RESULT)
    own = read(facts.where(F.col("entity") != global_entity), spine)
    instants = spine.select(F.lit(global_entity).alias("entity"), "as_of").distinct()
    shared = read(facts.where(F.col("entity") == global_entity), instants).withColumnRenamed("entity", "shared")
    everywhere = spine.join(shared, "as_of").drop("shared")
    both = own.select(*RESULT).unionByName(everywhere.select(*RESULT))
    best = both.groupBy("entity", "as_of", "feature").agg(F.max(_won()).alias("w"))
    return best.select("entity", "as_of", "feature", "w.*")


def features_at(facts: DataFrame, instant, entities: list[str] | None = None, features: list[str] | None = None, global_entity: str | None = None) -> DataFrame:
    """The read at one instant, an aware datetime; filters go to the scan."""
    if instant.tzinfo is None:
        raise SpineError("the instant needs a time zone")
    if features is not None:
        facts = facts.where(F.col("feature").isin(features))
    at = F.lit(instant)
    known = _known(facts).where(F.col("knowable_at") <= at)
    if global_entity is None and entities is not None:
        known = known.where(F.col("entity").isin(entities))
    if global_entity is not None and entities is not None:
        spine = facts.sparkSession.createDataFrame([(e, instant) for e in entities], "entity string, as_of timestamp")
        return as_of(known, spine, global_entity)
    won = known.groupBy("entity", "feature").agg(F.max(_won()).alias("w"))
    return won.select("entity", at.alias("as_of"), "feature", "w.*").select(*RESULT)


def first_reported(facts: DataFrame, keys: list[str]) -> DataFrame:
    """For each key the fact that became knowable first; then the smallest reference and value."""
    rest = [c for c in facts.columns if c not in keys]
    order = F.struct("knowable_at", *[c for c in rest if c != "knowable_at"])
    return facts.where("knowable_at is not null").groupBy(*keys).agg(F.min(order).alias("w")).select(*keys, "w.*")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """For each key the row that is greatest in ``order``, then in its other columns; nulls are smallest."""
    rest = [*order, *[c for c in df.columns if c not in keys and c not in order]]
    return df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("w")).select(*keys, "w.*").select(*df.columns)


def changes_between(facts: DataFrame, earlier, later) -> DataFrame:
    """Entities' features whose winner differs between two instants, with both values."""
    a, b = (features_at(facts, t).select("entity", "feature", F.struct(*VALUE).alias(n)) for t, n in ((earlier, "before"), (later, "after")))
    return b.join(a, ["entity", "feature"], "left").where(~F.col("before").eqNullSafe(F.col("after"))).select("entity", "feature", F.col("before.value").alias("value_before"), F.col("after.value").alias("value_after"))
