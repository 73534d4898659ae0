"""World bundles: one information set with the rows its items own, as content-addressed canonical JSON under the strictest licence.

A bundle is for readers without Spark.  What it holds is one decision's reach, a bounded extract: ``most`` rows at most, and
an error beyond, never a silent cut.
"""

from __future__ import annotations

import gzip
import hashlib
import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lineage import information_set, unaccounted, world

VERSION = "world/1"


@dataclass(frozen=True)
class Terms:
    licence: str
    credit: str


#: Licences from the strictest to the freest.
STRICTEST_FIRST = ("not for redistribution", "share alike", "public domain")


class Refused(ValueError):
    """What must not be exported, or isn't what it says it is."""


def licence_of(feeds: Iterable[str], terms: dict[str, Terms]) -> dict:
    """The strictest licence of the feeds, and whom to credit; a feed without terms can't be exported."""
    feeds = sorted(set(feeds))
    if missing := [f for f in feeds if f not in terms]:
        raise Refused(f"no terms for {missing}")
    unknown = [terms[f].licence for f in feeds if terms[f].licence not in STRICTEST_FIRST]
    if unknown:
        raise Refused(f"no such licence: {unknown}")
    rank = min((STRICTEST_FIRST.index(terms[f].licence) for f in feeds), default=len(STRICTEST_FIRST) - 1)
    return {"licence": STRICTEST_FIRST[rank], "credits": {f: terms[f].credit for f in feeds}}


def _canonical(found: dict) -> bytes:
    return json.dumps(found, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()


def _rows(df: DataFrame, most: int) -> list[list]:
    columns = [F.unix_micros(c).alias(c) if k == "timestamp" else F.col(c) for c, k in df.dtypes]
    rows = df.select(*columns).limit(most + 1).collect()
    if len(rows) > most:
        raise Refused(f"more than {most} rows")
    return sorted(([*r] for r in rows), key=lambda r: json.dumps(r, default=str))


def export(features: DataFrame, items: DataFrame, instant, terms: dict[str, Terms], feed: str = "kind", omit: list[str] = [], most: int = 100_000) -> bytes:  # noqa: B006
    """A compressed bundle of what was known at the instant, without the items omitted; refused if a row has no item."""
    if not omit and unaccounted(features, items, instant).limit(1).count():
        raise Refused("a row is owned by no item of the set")
    known = information_set(items, instant, omit)
    found = {
        "format": VERSION, "at": str(instant), "omitted": sorted(omit), "items": _rows(known.select("item_id", "kind", "entity", "knowable_at", "digest"), most),
        "rows": _rows(world(features.where(F.col("knowable_at") <= F.lit(instant)), known), most),
        "terms": licence_of([r[feed] for r in known.select(feed).distinct().limit(most).collect()], terms),
    }
    found["id"] = hashlib.sha256(_canonical(found)).hexdigest()
    return gzip.compress(_canonical(found), mtime=0)


def open_bundle(content: bytes) -> dict:
    """The bundle's contents, if they are what its id says."""
    found = json.loads(gzip.decompress(content))
    told = found.pop("id", None)
    if found.get("format") != VERSION or hashlib.sha256(_canonical(found)).hexdigest() != told:
        raise Refused("the bundle was changed, or is of another format")
    return found | {"id": told}


def redistributable(bundle: dict) -> bool:
    return bundle["terms"]["licence"] != STRICTEST_FIRST[0]
