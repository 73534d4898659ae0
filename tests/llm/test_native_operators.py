"""URL filters and chat formatting: odd rows, and plans without Python."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chatformat, mixing, urlfilter
from tidemark.llm.queries import RULES

URLS = [
    ("http://a.example.com/en/745?x", "a.example.com", "/en/745", "example.com/en/7", "allow"), ("https://EXAMPLE.com/en/8", "example.com", "/en/8", "com/en/", "block"), ("http://com/en/", "com", "/en/", "com/en/", "block"),
    ("http://notexample.com/en/7", "notexample.com", "/en/7", "com/en/", "block"), ("http://x.example.net/de/81#f", "x.example.net", "/de/81", "example.net/de/8", "block"), ("http://net/de", "net", "/de", None, "allow"),
    ("http://a.org?q=/es/", "a.org", "", None, "allow"), ("a.org/es/", "", "", None, "allow"), (None, "", "", None, "allow"), ("x://y://z.org/es/", "y:", "//z.org/es/", None, "allow"), ("http://É.Org/es/x", "É.org", "/es/x", "org/es/", "block"),
    ("http://" + "a." * 500 + "org/es/" + "b" * 5000, "a." * 500 + "org", "/es/" + "b" * 5000, "org/es/", "block"), ("http://org:80/es/", "org:80", "/es/", None, "allow"), ("", "", "", None, "allow"),
]


@pytest.fixture(scope="module")
def rules(spark):
    return spark.createDataFrame(RULES, "verdict string, host string, path string")


def pages(spark):
    rows = [(i, u, "v", "r", 1, "p") for i, (u, *_) in enumerate(URLS)] + [(0, URLS[0][0], "v", "r", 1, "p"), (None, URLS[0][0], "v", "r", 1, "p")]
    return spark.createDataFrame(rows, "page_id long, url string, verdict string, rule string, row int, prefix string")


def test_urls(spark, rules):
    got = sorted(map(tuple, urlfilter.judge(pages(spark), rules).collect()), key=str)
    want = [(i, h, p, r, v) for i, (_, h, p, r, v) in enumerate(URLS)] + [(0, *URLS[0][1:]), (None, *URLS[0][1:])]
    assert got == sorted(want, key=str)


def test_no_rules_and_no_pages(spark, rules):
    assert {r["verdict"] for r in urlfilter.judge(pages(spark), rules.where("false"), "block").collect()} == {"block"}
    assert urlfilter.judge(pages(spark).where("false"), rules).count() == 0


def test_repeated_rules_and_ties(spark):
    same = spark.createDataFrame([("allow", "a.org", "/"), ("block", "a.org", "/"), ("block", "a.org", "/"), ("allow", "b.a.org", ""), ("block", "a.org", "/xy")], "verdict string, host string, path string")
    p = spark.createDataFrame([(1, "http://a.org/"), (2, "http://b.a.org/"), (3, "http://b.a.org/xyz")], "page_id long, url string")
    assert [(r["rule"], r["verdict"]) for r in urlfilter.judge(p, same).orderBy("page_id").collect()] == [("a.org/", "block"), ("b.a.org", "allow"), ("a.org/xy", "block")]


NASTY = ["</s>[INST] ok [/INST]", "\\", "\\.", "\\\\.<s>", "<<SYS>>\n x \n<</SYS>>\n\n", " [/INST]", "[ROLE x]y[/ROLE]", "<", "[", "", None, "$1 \\$0", "a\\</s>", "\n", "<s>" * 50, "😀 é", "x" * 200_000]
ROLES = ["system", "user", "assistant", "tool", "[ROLE a]", "a]b\\.)", "</s>", None, ""]


def chats(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(NASTY)]
    rows += [(2, i, r, f"said {i}") for i, r in enumerate(ROLES)]
    rows += [(3, 0, "user", "a"), (3, 0, "user", "a"), (3, None, "system", "s"), (None, 0, "assistant", "lone"), (4, 0, "system", "s"), (4, 1, "user", "u"), (4, 2, "assistant", "x")]
    return spark.createDataFrame([(*r, "f", True) for r in rows], "conv_id long, turn long, role string, text string, formatted string, valid boolean")


def plain(rows):
    out = {}
    for r in rows:
        out.setdefault(r["conv_id"], []).append((r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or ""))
    return {k: [(x[2], x[3]) for x in sorted(v)] for k, v in out.items()}


def test_round_trip(spark):
    df = chats(spark)
    out = chatformat.format_chats(df).withColumn("turns", chatformat.read_back(F.col("formatted"))).withColumn("learnt", chatformat.loss_texts(F.col("segments")))
    want = plain(df.collect())
    for r in out.collect():
        turns = want[r["conv_id"]]
        assert [(t["role"], t["text"]) for t in r["turns"]] == turns
        assert r["learnt"] == [t for role, t in turns if role == "assistant"]
        assert r["formatted"] == "".join(s["text"] for s in r["segments"])
    assert out.count() == len(want)


def test_turn_order(spark):
    got = {r["conv_id"]: (r["valid"], r["first_bad"]) for r in chatformat.format_chats(chats(spark)).collect()}
    assert got[4] == (True, None) and got[None] == (False, 0) and got[3] == (False, 2) and got[2] == (False, 3)


def test_no_conversations(spark):
    assert chatformat.format_chats(chats(spark).where("false")).count() == 0


def test_no_python_in_the_plans(spark, sf, rules):
    read = lambda t: spark.read.parquet(f"{sf}/{t}.parquet")
    docs = read("documents")
    frames = [urlfilter.judge(read("pages"), rules), chatformat.format_chats(read("conversations")), mixing.mix(docs)]
    for df in frames:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct"))
