"""The queries of this subpackage and, where SQL can express them, the same in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chatformat, exactdedup, lblm, mixing, packing, probminhash, quality, tokencount, topk, urlfilter
from tidemark.llm.common import read


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file is."""
    import public_tokenizers

    return public_tokenizers.path(name)

RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("block", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return topk.search(vectors, vectors.where("id % 100 = 0"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, quality.grades_of(read(spark, sf_dir, "labels")), 2)
    rated = quality.rate(docs, model, 2, ("doc_id",))
    return rated.select("doc_id", "expected_grade", F.col("tail")[0].alias("p_well_written"), F.col("tail")[1].alias("p_clean"), (F.col("tail")[1] >= quality.KEEP_TAIL).alias("kept"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lblm.score(read(spark, sf_dir, "documents")).drop("row")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sized = mixing.sizes_of(docs)
    took = mixing.with_copies(sized, mixing.plan(sized))
    return took.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(read(spark, sf_dir, "documents")).drop("row")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.dedup(read(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokencount.count_tokens(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"), tokencount.fitting(F.col("prefix_table"), 512).alias("fitting_chars"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, RULES))} AS t(verdict, host, path)")
    return urlfilter.judge(read(spark, sf_dir, "pages"), rules)


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT CAST(conv_id AS LONG) AS conv_id, CAST(turn AS LONG) AS turn, role, text FROM VALUES (-1, 0, 'user', '{said}'), (-1, 1, 'assistant', '{said}') AS t(conv_id, turn, role, text)")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = chatformat.format_chats(rows).withColumn("turns", chatformat.read_back(F.col("formatted"))).withColumn("learnt", F.concat_ws("", chatformat.loss_texts(F.col("segments"))))
    told = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        "first_bad",
    )


QUERIES = {"op1_packing": op1_packing, "op2_topk_search": op2_topk_search, "op3_quality_classifier": op3_quality_classifier, "op4_lm_scoring": op4_lm_scoring, "op5_mixing": op5_mixing, "op6_minhash_near_dedup": op6_minhash_near_dedup, "op7_exact_dedup": op7_exact_dedup, "op8_token_counts": op8_token_counts, "op9_url_filters": op9_url_filters, "op10_chat_formatting": op10_chat_formatting}

_ESC = r"regexp_replace(replace(coalesce(text, ''), '\', '\\'), '([<\[])(/?s>|</?SYS>>|/?INST\]|/?ROLE[ \]])', '\1\\.\2', 'g')"
#: The longest rule of those that fit, as a union over the rules.
_VERDICTS = " UNION ALL ".join(f"SELECT '{v}' AS v, '{h}' AS h, '{p}' AS p" for v, h, p in RULES)

ORACLE: dict[str, str] = {
    "op2_topk_search": """
WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)]), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op7_exact_dedup": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare FROM documents),
r AS (SELECT *, first_value(doc_id) OVER (PARTITION BY bare ORDER BY length(t) DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY bare) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256 FROM r""",
    "op9_url_filters": f"""
WITH r AS ({_VERDICTS}),
u AS (SELECT page_id, url,
        translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
        row_number() OVER () AS k FROM pages),
m AS (SELECT u.k, r.v, r.h || r.p AS rule, row_number() OVER (PARTITION BY u.k ORDER BY length(r.h || r.p) DESC, length(r.h) DESC, r.v DESC) AS n
      FROM u JOIN r ON (u.host = r.h OR ends_with(u.host, '.' || r.h)) AND starts_with(u.path, r.p))
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.v, 'allow') AS verdict FROM u LEFT JOIN m ON u.k = m.k AND m.n = 1""",
    "op10_chat_formatting": rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, {_ESC} AS esc FROM c),
o AS (SELECT *, row_number() OVER w - 1 AS pos, lag(role) OVER w AS before FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
g AS (SELECT *, NOT coalesce(CASE WHEN pos = 0 THEN role IN ('system', 'user') WHEN before IN ('system', 'assistant') THEN role = 'user' WHEN before = 'user' THEN role = 'assistant' END, false) AS bad FROM o),
a AS (SELECT conv_id, count(*) AS n_turns, CAST(min(CASE WHEN bad THEN pos END) AS INTEGER) AS first_bad, arg_max(role, pos) AS final,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS told,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS learnt,
    sum(length(esc) + CASE role WHEN 'system' THEN 19 WHEN 'user' THEN 15 WHEN 'assistant' THEN 5 ELSE 14 + length(role) END) + 3 AS formatted_chars
  FROM g GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, CAST(length(learnt) AS BIGINT) AS loss_chars, sha256(learnt) AS loss_sha256,
  CAST(formatted_chars AS BIGINT) AS formatted_chars, first_bad IS NULL AND final = 'assistant' AS valid, first_bad FROM a""",
    "op5_mixing": r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][CAST(i % 3 AS BIGINT) + 1] AS weight, source_size * 2.0::DOUBLE AS most FROM s),
f AS (SELECT *, row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS r FROM w),
b AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE - coalesce(sum(most) OVER (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remains,
    sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS others FROM f),
l AS (SELECT remains, others FROM b WHERE most * others >= weight * remains ORDER BY r LIMIT 1),
t AS (SELECT b.source, b.source_size, CASE WHEN most * b.others >= weight * b.remains THEN least(weight * l.remains / l.others, most) ELSE most END AS target FROM b LEFT JOIN l ON true),
p AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t),
x AS (SELECT d.doc_id, d.source, d.size, [sha256(j || ':' || coalesce(CAST(d.doc_id AS VARCHAR), '')) FOR j IN [0, 1, 2, 3]] AS dig FROM d),
y AS (SELECT x.*, p.source_size, p.target, floor(p.rate) AS whole, (p.rate - floor(p.rate)) * 4294967296.0::DOUBLE AS part FROM x JOIN p ON x.source IS NOT DISTINCT FROM p.source),
k AS (SELECT y.source, g.k, y.whole * y.source_size + sum(CASE WHEN CAST('0x' || substr(dig[CAST(g.k // 8 AS BIGINT) + 1], CAST(1 + 8 * (g.k % 8) AS BIGINT), 8) AS BIGINT) < part THEN size ELSE 0 END) - y.target AS off
  FROM y, range(32) g(k) GROUP BY y.source, g.k, y.whole, y.source_size, y.target),
z AS (SELECT source, k, row_number() OVER (PARTITION BY source ORDER BY abs(off), k) AS n FROM k)
SELECT y.doc_id, y.size, y.source_size, y.target,
  CAST(y.size * (whole + CASE WHEN CAST('0x' || substr(dig[CAST(z.k // 8 AS BIGINT) + 1], CAST(1 + 8 * (z.k % 8) AS BIGINT), 8) AS BIGINT) < part THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM y JOIN z ON z.source IS NOT DISTINCT FROM y.source AND z.n = 1""",
}
