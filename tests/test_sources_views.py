from __future__ import annotations

import hashlib
import io
import json
import zipfile
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import views
from tidemark.sources import landing, readers, store


def put(path, content):
    path.write_text(content)
    return str(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_csv(spark, tmp_path):
    d = readers.Dataset("s", "d", ("a", "b"))
    assert rows(readers.read_raw(spark, d, put(tmp_path / "x.csv", "1,2\n3\n"))) == [("1", "2", None), ("3", None, "3")]


def test_json_rows(spark, tmp_path):
    d = readers.Dataset("s", "d", ("a", "b"), "json_rows")
    got = rows(readers.read_raw(spark, d, put(tmp_path / "x.json", '[[1,"x"],[2],null]\noops\n')))
    assert got == sorted([("1", "x", None), (None, None, '["2"]'), (None, None, "null"), (None, None, "oops")], key=str)


def test_json_records(spark, tmp_path):
    d = readers.Dataset("s", "d", ("a", "b"), "json_records", "data.list")
    got = rows(readers.read_raw(spark, d, put(tmp_path / "x.json", '{"data":{"list":[{"a":1,"b":2},{"a":3},null]}}\n{"data":{}}\n')))
    assert got == sorted([("1", "2", None), ("3", None, None), (None, None, "null"), (None, None, '{"data":{}}')], key=str)


def test_json_columns(spark, tmp_path):
    d = readers.Dataset("s", "d", ("a", "b"), "json_columns", "c")
    got = rows(readers.read_raw(spark, d, put(tmp_path / "x.json", '{"c":{"a":[1,2],"b":["x","y"]}}\n{"c":{"a":[1],"b":[]}}\n')))
    assert got == sorted([("1", "x", None), ("2", "y", None), (None, None, '{"c":{"a":[1],"b":[]}}')], key=str)


def test_facts(spark, tmp_path):
    d = readers.Dataset("s", "d", ("taxonomy", "concept", "unit", "val", "accn"), "facts")
    doc = {"facts": {"gaap": {"Sales": {"units": {"USD": [{"val": 5, "accn": "A"}, {"val": 6, "accn": "B"}]}}}}}
    assert rows(readers.read_raw(spark, d, put(tmp_path / "x.json", json.dumps(doc)))) == [("gaap", "Sales", "USD", "5", "A", None), ("gaap", "Sales", "USD", "6", "B", None)]
    assert rows(readers.read_raw(spark, d, put(tmp_path / "y.json", "no"))) == [(None, None, None, None, None, "no")]


def test_facts_of_several_documents_in_a_file(spark, tmp_path):
    d = readers.Dataset("s", "d", ("taxonomy", "concept", "unit", "val", "accn"), "facts")
    one, two = ({"facts": {t: {"S": {"units": {"USD": [{"val": "}\n{ } x", "accn": t}]}}}}} for t in "ab")
    told = [(t, "S", "USD", "}\n{ } x", t, None) for t in "ab"]
    a, b = json.dumps(one), json.dumps(two)
    assert rows(readers.read_raw(spark, d, put(tmp_path / "lines.json", f"{a}\n{b}\n"))) == told
    assert rows(readers.read_raw(spark, d, put(tmp_path / "indented.json", f"{json.dumps(one, indent=1)}\n\n{json.dumps(two, indent=1)}"))) == told
    assert rows(readers.read_raw(spark, d, put(tmp_path / "rest.json", f"{a}\nrest"))) == sorted([told[0], (None,) * 5 + ("rest",)], key=str)
    for i, text in enumerate((f"{a} rest", f"{a}{b}", f"{a}, {b}", f"{a}]rest", f"{a}}}", f'{a},{{"facts end":""}}] rest')):
        assert rows(readers.read_raw(spark, d, put(tmp_path / f"{i}.json", text))) == [(None,) * 5 + (text,)]


def test_documents(spark, tmp_path):
    d = readers.Dataset("s", "d", ("html",), "document")
    assert rows(readers.read_raw(spark, d, put(tmp_path / "x.html", "<p>\nx</p>"))) == [("<p>\nx</p>", None)]
    with pytest.raises(ValueError):
        readers.read_raw(spark, readers.Dataset("s", "d", ("a",), "xml"), "x")


def test_metadata_and_counts(spark, tmp_path):
    d = readers.Dataset("s", "d", ("a", "b"))
    df = readers.with_metadata(readers.read_raw(spark, d, put(tmp_path / "x.csv", "1,2\n3\n")), d, "S", "2024-01-01", "x.csv", "0", "r", datetime(2024, 1, 1))
    assert rows(readers.row_counts(df)) == [("x.csv", 2, 1, 2)] and len(df.columns) == 3 + 8


def test_verified_bytes(spark, tmp_path):
    content = b"abc"
    assert landing.check_sha256(content, hashlib.sha256(content).hexdigest()) == content
    with pytest.raises(landing.Damaged):
        landing.check_sha256(content, "0")
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("../../evil.csv", "1,2")
    assert landing.only_member(buffer.getvalue()) == ("evil.csv", b"1,2")
    with zipfile.ZipFile(buffer, "a") as z:
        z.writestr("two", "")
    with pytest.raises(landing.Damaged):
        landing.only_member(buffer.getvalue())
    (tmp_path / "a.bin").write_bytes(content)
    told = spark.createDataFrame([("a.bin", hashlib.sha256(content).hexdigest()), ("b.bin", "0")], "path string, sha256 string")
    assert {r["path"]: r["ok"] for r in landing.verify_files(spark, str(tmp_path / "*.bin"), told).collect()} == {"a.bin": True, "b.bin": False}


def test_sync_isolates_failures():
    placed = []

    def fetch(p):
        if p == "b":
            raise OSError("down")
        return p.encode()

    out = landing.sync(["a", "b", "c"], fetch, lambda p, c: placed.append(p))
    assert [(o.period, o.error) for o in out] == [("a", None), ("b", "down"), ("c", None)]
    assert placed == ["a", "a.manifest.json", "c", "c.manifest.json"]


def test_response_checks(spark):
    c = spark.createDataFrame([("60", "1", "3", "2", "2", "5"), ("61", "1", "3", "2", "2", "5"), ("120", "9", "3", "2", "2", "5"), ("180", "1", "3", "2", "2", "5"), ("180", "1", "3", "2", "2", "5"), ("x", "1", "1", "1", "1", "1")], "time string, low string, high string, open string, close string, volume string")
    assert sorted(r["problem"] for r in landing.candle_problems(c).collect()) == ["bad_prices", "no_time", "off_grid", "repeated", "repeated"]
    html = spark.createDataFrame([("x" * 20 + "</HTML>",), ("x",), (None,)], "h string").select(landing.document_ok(F.col("h"), 10).alias("ok"))
    assert [r["ok"] for r in html.collect()] == [True, False, False]
    declared = spark.createDataFrame([("a", 2), ("b", 1)], "series_id string, declared long")
    assert [tuple(r) for r in landing.vintage_problems(declared, spark.createDataFrame([("a",), ("a",)], "series_id string")).collect()] == [("b", 1, 0)]


def test_store(spark, tmp_path):
    s = store.SnapshotStore(spark, str(tmp_path / "store"))
    df = lambda *ids: spark.createDataFrame([(i, i % 2) for i in ids], "id long, p long")
    assert s.overwrite("t", df(1, 2, 3, 4), by=["p"]).version == 0
    s.replace("t", F.col("p") == 0, df(6), by=["p"])
    assert sorted(r["id"] for r in s.read("t").collect()) == [1, 3, 6]
    assert s.read("t", 0).count() == 4
    with pytest.raises(ValueError):
        s.replace("t", F.col("p") == 0, df(7))
    s.append("t", df(8))
    s.delete_orphans("t", "id", df(1, 8))
    assert sorted(r["id"] for r in s.read("t").collect()) == [1, 8]
    s.optimize("t", ["id"], 1)
    assert [c.operation for c in s.history("t")] == ["OVERWRITE", "REPLACE", "APPEND", "DELETE", "OPTIMIZE"]
    assert s.readable("t", 3) == 4 and s.readable("t", 1) == 1
    with pytest.raises(LookupError):
        s.read("t", 9)
    s.overwrite("commits", spark.createDataFrame([("r1", "t", 2, datetime(2024, 1, 1)), ("r2", "t", 3, datetime(2024, 1, 2))], "run_id string, table string, version long, at timestamp"))
    assert s.published("t") == 3
    with pytest.raises(LookupError):
        s.published("u")


def test_a_losing_writer_destroys_nothing(spark, tmp_path, monkeypatch):
    df = lambda *ids: spark.createDataFrame([(i, i % 2) for i in ids], "id long, p long")
    mine, other = (store.SnapshotStore(spark, str(tmp_path / "store")) for _ in range(2))
    ids = lambda version=None: sorted(r["id"] for r in mine.read("t", version).collect())
    mine.overwrite("t", df(1, 2), by=["p"])
    publish = mine._publish

    def late(table, held, commit):
        monkeypatch.setattr(mine, "_publish", publish)
        other.append("t", df(3))
        return publish(table, held, commit)

    monkeypatch.setattr(mine, "_publish", late)
    with pytest.raises(store.Conflict):
        mine.replace("t", F.col("p") == 0, df(4))
    assert ids() == [1, 2, 3] and ids(0) == [1, 2]
    monkeypatch.setattr(mine, "_publish", late)
    assert mine.append("t", df(5)).version == 3 and ids() == [1, 2, 3, 3, 5] and ids(2) == [1, 2, 3, 3]
    assert [c.rows for c in mine.history("t")] == [2, 3, 4, 5]
    folders = {f.name for f in (tmp_path / "store" / "t" / "data").iterdir()}
    assert len(folders) == 4  # what the loser wrote is gone


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    s = store.SnapshotStore(spark, str(tmp_path / "store"))
    rows = spark.range(100).select("id", F.concat(F.lit("a b/"), (F.col("id") % 10).cast("string")).alias("p"), (F.col("id") % 3).alias("f"))
    s.append("t", rows, by=["p"])
    c = s.replace("t", F.col("p") == "a b/3", rows.where("p = 'a b/3' and id < 50"))
    assert len(c.add) == len(c.remove) == 1 and c.rows == 95
    c = s.replace("t", (F.col("f") == 1) & (F.col("id") < 5), rows.where("id = 4"))  # 1 and 4, each in a partition of its own
    assert len(c.remove) == 2 and c.rows == 94 and sorted(r["id"] for r in s.read("t").where("id < 6").collect()) == [0, 2, 3, 4, 5]
    c = s.delete_orphans("t", "id", rows.where("id <> 7"))
    assert len(c.remove) == 1 and c.rows == 93 and s.read("t").count() == 93
    assert s.read("t", 0).count() == 100
    with pytest.raises(ValueError):
        s.replace("t", F.col("p") == "a b/3", rows.where("p = 'a b/4'"))
    assert s.history("t")[-1].version == 3


def test_loading_replaces_a_files_rows_alone(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    d, s, at = readers.Dataset("s", "d", ("a", "b")), store.SnapshotStore(spark, str(tmp_path / "store")), datetime(2024, 1, 1, tzinfo=UTC)

    def told(**files):
        for name, content in files.items():
            (landed / f"{name}.csv").write_text(content)
        return spark.createDataFrame([(f"{n}.csv", "S", date(2024, 1, 1 + k), hashlib.sha256(c.encode()).hexdigest()) for k, (n, c) in enumerate(files.items())], "path string, symbol string, period_start date, sha256 string")

    assert landing.load_files(s, "raw", str(landed), told(x="1,2\n3,4\n", y="5,6\n"), d, "r1", at) == []
    again = told(x="7,8\n", y="5,6\n").where("path = 'x.csv'")
    assert landing.load_files(s, "raw", str(landed), again, d, "r2", at) == []
    assert sorted((r["a"], r["_source_file"], r["_load_run_id"]) for r in s.read("raw").collect()) == [("5", "y.csv", "r1"), ("7", "x.csv", "r2")]
    (landed / "y.csv").write_text("changed")
    assert landing.load_files(s, "raw", str(landed), told(x="7,8\n").unionByName(spark.createDataFrame([("y.csv", "S", date(2024, 1, 2), "0")], again.schema)), d, "r3", at) == ["y.csv"]
    assert s.read("raw").count() == 2 and s.read("raw", 0).count() == 3


def test_readable_version_stops_at_the_first_write():
    history = [(1, "WRITE"), (2, "OPTIMIZE"), (3, "VACUUM"), (4, "WRITE"), (5, "OPTIMIZE")]
    assert store.readable_version(history, 1) == 3 and store.readable_version(history, 4) == 5


def test_stage_and_export(spark, tmp_path):
    staged = store.stage(spark.range(5), str(tmp_path / "s"))
    assert staged.count() == 5
    store.export(spark.createDataFrame([(datetime(2024, 1, 1, tzinfo=UTC), "a\tb")], "t timestamp, s string"), str(tmp_path / "e"))
    assert "1704067200000000" in "".join(p.read_text() for p in (tmp_path / "e").glob("*.csv"))


def test_views_refuse_what_they_do_not_know(spark):
    with pytest.raises(views.BadRequest):
        views.run(spark, "nope")
    with pytest.raises(views.BadRequest):
        views.run(spark, "trailing_days")
    with pytest.raises(views.BadRequest):
        views.run(spark, "trailing_days", days="1 OR 1=1")


def test_public_check_and_cache(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, tzinfo=UTC),)], "knowable_at timestamp")
    views.check_public(df, datetime(2024, 1, 1, tzinfo=UTC))
    with pytest.raises(views.Leak):
        views.check_public(df, datetime(2023, 12, 31, tzinfo=UTC))
    spark.createDataFrame([("S", date(2024, 1, 1))], "symbol string, session_date date").createOrReplaceTempView("days")
    cache = views.Cache(spark)
    first = cache.rows("day_range")
    spark.createDataFrame([("T", date(2024, 1, 1))], "symbol string, session_date date").createOrReplaceTempView("days")
    assert cache.rows("day_range") == first and cache.rows("day_range", refresh=True) != first


def test_portfolio(spark):
    p = spark.createDataFrame([("a", date(2024, 1, 1), 1.0), ("b", date(2024, 1, 2), 10.0), ("a", date(2024, 1, 3), 2.0)], "symbol string, session_date date, close double")
    held = spark.createDataFrame([("a", 2.0), ("b", 1.0)], "symbol string, quantity double")
    assert rows(views.carried_forward(p, held)) == [(date(2024, 1, 2), 12.0), (date(2024, 1, 3), 14.0)]
    assert rows(views.indexed(p)) == [("a", date(2024, 1, 3), 100.0), ("b", date(2024, 1, 2), 100.0)]


def test_price_validity(spark):
    from tidemark.operators import ops

    usage = spark.createDataFrame([("x", datetime(2024, 1, d), 1.0) for d in (1, 5, 9)], "sku string, at timestamp, quantity double")
    prices = spark.createDataFrame([("x", datetime(2024, 1, 1), datetime(2024, 1, 5), 2.0), ("x", datetime(2024, 1, 6), None, 3.0)], "sku string, price_start timestamp, price_end timestamp, price double")
    got = ops.cost_rollup(ops.priced(usage, prices, ["sku"]), ["sku"]).first()
    assert (got["quantity"], got["cost"], got["unpriced"]) == (3.0, 5.0, 1)


def test_staging_and_retention(tmp_path):
    from tidemark.operators import ops

    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "f").write_text("x")
    assert [p.name for p in ops.expired(ops.staged(tmp_path), 7, now=2e9 * 2)] == ["old"] and ops.expired(ops.staged(tmp_path), 7) == []
    assert ops.retention_issues({"t": {"keep": "30"}}, {"keep": "365"}) == ["t: keep is 30, not 365"]
