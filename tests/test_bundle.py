from __future__ import annotations

import gzip
import json
from datetime import timedelta

import pytest

from tests.test_lineage_research import T0, daily
from tidemark.operators import features, lineage
from tidemark.sources import bundle

TERMS = {"bar": bundle.Terms("share alike", "the venue"), "filing": bundle.Terms("public domain", "the regulator"), "secret": bundle.Terms("not for redistribution", "the vendor")}


def test_round_trip_is_reproducible(spark):
    d = daily(spark, 30)
    f, items = features.price_features(d), lineage.items(d, "bar", ["symbol", "session_date"], ["close"])
    at = T0 + timedelta(days=24)
    a, b = (bundle.export(x, items, at, TERMS) for x in (f, f.repartition(5)))
    assert a == b
    opened = bundle.open_bundle(a)
    assert len(opened["items"]) == 25 and opened["terms"]["licence"] == "share alike" and bundle.redistributable(opened)
    assert len(opened["rows"]) == 25 + 2 * 5
    less = bundle.open_bundle(bundle.export(f, items, at, TERMS, omit=["bar:S/2024-01-05"]))
    assert len(less["items"]) == 24 and less["id"] != opened["id"]


def test_changed_bundles_are_refused(spark):
    d = daily(spark, 3)
    f, items = features.price_features(d), lineage.items(d, "bar", ["symbol", "session_date"], ["close"])
    raw = json.loads(gzip.decompress(bundle.export(f, items, T0 + timedelta(days=9), TERMS)))
    raw["rows"][0][5] = 1.0
    with pytest.raises(bundle.Refused):
        bundle.open_bundle(gzip.compress(json.dumps(raw).encode()))
    with pytest.raises(bundle.Refused):
        bundle.export(f, items, T0 + timedelta(days=9), TERMS, most=2)
    with pytest.raises(bundle.Refused):
        bundle.export(f, items.where("item_id <> 'bar:S/2024-01-02'"), T0 + timedelta(days=9), TERMS)


def test_the_strictest_licence_counts():
    assert bundle.licence_of(["bar", "secret", "filing"], TERMS)["licence"] == "not for redistribution"
    assert bundle.licence_of(["filing"], TERMS)["licence"] == "public domain"
    with pytest.raises(bundle.Refused):
        bundle.licence_of(["else"], TERMS)
