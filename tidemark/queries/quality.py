"""Rules, duplicates, gaps, gates, and the joins and set operations around loading."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.functions.temporal import duration_class, from_epoch, from_rfc3339, local_midnight
from tidemark.operators import gate, rules
from tidemark.queries import frames as fr

#: Text as a raw table has it: some values are broken on purpose, by id.
SPEC = rules.Spec(
    table="trades",
    columns={
        "trade_id": ("bigint", "raw_id"),
        "price": ("decimal(28,10)", "raw_price"),
        "quantity": ("decimal(28,10)", "raw_quantity"),
        "at": ("timestamp", "timestamp_micros(try_cast(raw_time AS BIGINT))"),
    },
    event_time="at",
    knowable_at="timestamp_micros(unix_micros(at) + lag_us)",
    key=("symbol_key", "trade_id"),
    derived={"symbol_key": ("string", "nullif(raw_symbol, '')")},
    rules=(
        rules.Rule("record_parses", "_corrupt_record IS NULL"),
        rules.Rule("key_present", "symbol_key IS NOT NULL AND trade_id IS NOT NULL"),
        rules.Rule("timestamp_plausible", "event_time >= TIMESTAMP'2024-01-01' AND event_time < TIMESTAMP'2024-01-28'"),
        rules.Rule("price_and_quantity_positive", "price > 0 AND quantity > 0"),
        rules.Rule("knowable_at_not_before_event", "knowable_at >= event_time", rules.HALT),
        rules.Rule(rules.DUPLICATE, None),
    ),
)
RAW = ["raw_id", "raw_symbol", "raw_price", "raw_quantity", "raw_time"]


def raw(spark, d):
    e = fr.table(spark, d, "events")
    i = F.col("event_id")
    return e.select(
        F.when(i % 53 == 0, "x").otherwise((i - F.when(i % 10 == 9, 1).otherwise(0)).cast("string")).alias("raw_id"),
        F.when(i % 71 == 0, "").otherwise(F.col("event_type")).alias("raw_symbol"),
        F.when(i % 41 == 0, "-1").when(i % 43 == 0, "?").otherwise(F.col("value").cast("decimal(28,10)").cast("string")).alias("raw_price"),
        (i % 5 + 1).cast("string").alias("raw_quantity"),
        F.unix_micros("ts").cast("string").alias("raw_time"),
        F.when(i % 61 == 0, "{").alias("_corrupt_record"),
        F.when(i % 997 == 5, -1000).otherwise(i % 7).alias("lag_us"),
        F.concat(F.lit("f"), F.to_date("ts").cast("string")).alias("_source_file"),
        i.alias("raw_order"),
    )


def judged(spark, d, scope=()):
    return rules.evaluate(rules.prepare(raw(spark, d), SPEC), SPEC, list(scope), [F.col("raw_order")])


def rules_first_failure_counts(spark, d):
    return rules.failures(judged(spark, d)).withColumn("rule", F.coalesce("rule", F.lit("accepted")))


def rules_accepted(spark, d):
    out = rules.accepted(judged(spark, d), SPEC, ["_source_file"])
    return out.groupBy("symbol_key", "_source_file").agg(F.count("*").alias("rows"), F.sum("price").cast("double").alias("price"), F.max(F.unix_micros("knowable_at")).alias("known_us"))


def rules_quarantine(spark, d):
    q = rules.quarantined(judged(spark, d), SPEC, RAW, ["_source_file"])
    return q.select("rule", F.get_json_object("record", "$.raw_id").alias("raw_id"), F.get_json_object("record", "$.raw_price").alias("raw_price"), "_source_file", *fr.micros("event_time"))


def rules_domain(spark, d):
    """Bars, releases, facts, documents and filings made of orders, some of them broken by their keys."""
    o = fr.table(spark, d, "orders")
    k, price = F.col("o_orderkey"), F.col("o_totalprice").cast("decimal(18,2)")
    day = F.to_date("o_orderdate")
    rows = o.select(
        price.alias("open"), (price + 1).alias("close"), F.when(k % 17 == 0, price + 2).otherwise(price).alias("low"), F.when(k % 19 == 0, price).otherwise(price + 1).alias("high"), (k % 5).alias("quantity"),
        F.when(k % 7 == 0, None).when(k % 11 == 0, ".").otherwise(price.cast("string")).alias("value"), F.when(k % 3 > 0, F.date_add(day, (k % 9 - 1).cast("int"))).alias("period_start"), F.date_add(day, 5).alias("period_end"),
        (k % 20_000).alias("html_chars"), (F.col("o_orderdate") + F.make_interval(hours=(k % 48).cast("int"))).alias("acceptance_time"), F.date_add(day, 1).alias("filing_date"),
    )
    return rules.broken(rows, [rules.positive("open", "quantity"), rules.BAR_CONSISTENT, rules.reported(), rules.numeric(), rules.PERIOD_ORDERED, rules.document_has_text(), rules.accepted_in_hours(zone="UTC")])


def dedup_scope_file(spark, d):
    return rules.failures(judged(spark, d, ["_source_file"]), ["_source_file"]).where(F.col("rule") == rules.DUPLICATE).select("_source_file", "rows")


def dedup_scope_key(spark, d):
    li = fr.table(spark, d, "lineitem").withColumn("rule", F.when(F.col("l_quantity") > 45, "too_many"))
    flagged = rules.flag_duplicates(li, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice")])
    return flagged.groupBy("l_returnflag", F.coalesce("rule", F.lit("accepted")).alias("rule")).agg(F.count("*").alias("rows"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))


def load_log_by_rule(spark, d):
    log = rules.load_log(judged(spark, d), ["_source_file"])
    return log.select("_source_file", "rows_read", "rows_accepted", F.explode_outer("rejected_by_rule").alias("rule", "n"))


def halt_violations(spark, d):
    return rules.halt_violations(judged(spark, d), SPEC).select("rule", "rows", F.size("sample").alias("sampled"))


def halt_drill(spark, d):
    drilled = rules.drill(rules.prepare(raw(spark, d), SPEC), SPEC, ["_source_file"], [F.col("raw_order")], "early")
    return rules.evaluate(drilled, SPEC, [], [F.col("raw_order")]).where(F.col("rule") == "knowable_at_not_before_event").groupBy("_source_file").agg(F.count("*").alias("rows"))


def sequence_gaps(spark, d):
    kept = fr.table(spark, d, "events").where("event_id % 10 < 7 or event_id % 13 = 0").select("event_id", F.lit("all").alias("series"), F.to_date("ts").alias("day"))
    return rules.sequence_gaps(kept, ["series"], "event_id")


def sequence_gaps_edges(spark, d):
    e = fr.table(spark, d, "events").select("event_type", F.to_date("ts").alias("day"), F.unix_seconds(F.date_trunc("hour", "ts")).alias("hour")).distinct()
    start = F.unix_seconds(F.col("day").cast("timestamp"))
    return rules.sequence_gaps(e, ["event_type", "day"], "hour", 3600, start, start + 23 * 3600)


def gap_totals(spark, d):
    return rules.gap_totals(sequence_gaps_edges(spark, d), ["event_type"])


def turn_gaps(spark, d):
    return rules.sequence_gaps(fr.table(spark, d, "conversations").where("turn <> 2"), ["conv_id"], "turn", 1, F.lit(0)).groupBy("missing").agg(F.count("*").alias("gaps"))


def _log(spark, d):
    return fr.load_log(spark, d).select("table", F.col("period").alias("day"), F.col("rows").alias("rows_read"), F.create_map(F.lit("bad_price"), F.col("rejected"), F.lit("duplicate"), F.col("run") % 3).alias("rejected_by_rule"))


def gate_thresholds(spark, d):
    limits = spark.createDataFrame([("rejected/bad_price", "*", 0.02, 2.0), ("rejected/bad_price", "t1", 0.05, 1.0), ("rejected/duplicate", "*", 0.01, 1.0)], "check string, subject string, rate double, tolerance double")
    waived = spark.createDataFrame([("rejected/bad_price", "t3", date(1997, 5, 28)), ("rejected/duplicate", "t1", date(1998, 10, 3))], "check string, subject string, day date")
    j = gate.judge(gate.rejections(_log(spark, d)), limits, waived)
    return j.select("check", "subject", "day", "measured", "failed", F.round("allowed", 6).alias("allowed"), "outcome")


def rejection_rates(spark, d):
    declared = spark.createDataFrame([(f"t{i}", r) for i in range(5) for r in ("bad_price", "duplicate", "never")], "table string, rule string")
    return gate.rejection_rates(declared, _log(spark, d)).select("table", "rule", "judged", "rejected", F.round("rate", 9).alias("rate"))


def comparisons_due(spark, d):
    log = fr.load_log(spark, d).groupBy(F.col("table").alias("key"), F.col("period").alias("day")).agg(F.max("run").cast("string").alias("hash"))
    left, right = log.where("hash % 3 <> 0"), log.where("hash % 3 <> 1")
    done = log.where("hash % 6 = 2").select("key", "day", F.col("hash").alias("left_hash"), F.col("hash").alias("right_hash"))
    return gate.comparisons_due(left, right, done, date(2001, 8, 1), 400)


# -- joins and sets


def semi_chosen_files(spark, d):
    log = fr.load_log(spark, d)
    chosen = log.where("rejected = 4").select("path").distinct()
    return log.join(chosen, "path", "left_semi").groupBy("table").agg(F.count("*").alias("files"), F.sum("rows").alias("rows"))


def anti_pending(spark, d):
    from tidemark.sources.landing import pending

    log = fr.load_log(spark, d)
    manifests = log.select("path", F.lit("s").alias("source"), F.col("table").alias("dataset"), "symbol", F.col("period").alias("period_start"), F.md5(F.col("path")).alias("sha256"), F.col("loaded_at").alias("fetched_at"))
    loaded = manifests.where("right(path, 1) in ('0', '4', '8')").select("path", "sha256").distinct()
    return pending(manifests, loaded).select("path", "dataset", "symbol", "period_start", *fr.micros("fetched_at"))


def lookup_left(spark, d):
    c = fr.table(spark, d, "customer").where("c_custkey % 3 <> 0").select("c_custkey", "c_name", "c_mktsegment")
    both = c.unionByName(c.withColumn("c_name", F.concat(F.lit("~"), "c_name")))  # keys repeat: the smallest row counts
    out = rules.look_up(fr.table(spark, d, "orders"), both, rules.Lookup("customer", (("o_custkey", "c_custkey"),), ("c_name", "c_mktsegment")))
    return out.select("o_orderkey", "c_name", "c_mktsegment")


def registry_flag(spark, d):
    log = fr.load_log(spark, d)
    registry = log.where("symbol <> 'S3'").select("table", "symbol").distinct()
    return rules.with_registry(log, registry, ["table", "symbol"]).groupBy("symbol", "_registered").agg(F.count("*").alias("rows")).withColumnRenamed("_registered", "registered")


def symmetric_difference(spark, d):
    from tidemark.operators.leakage import differences

    li = fr.table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_tax")
    return differences(li.where("l_tax < 0.06"), li.where("l_tax > 0.01")).groupBy("side", "l_returnflag").agg(F.count("*").alias("rows"))


def set_subtract_both(spark, d):
    n = fr.table(spark, d, "lineitem").select("l_partkey", "l_quantity")
    a, b = n.where("l_quantity < 40").select("l_partkey"), n.where("l_quantity > 20").select("l_partkey")
    return a.subtract(b).withColumn("side", F.lit("removed")).unionByName(b.subtract(a).withColumn("side", F.lit("added")))


def scalar_times(spark, d):
    e = fr.table(spark, d, "events")
    s = F.unix_seconds("ts").cast("string")
    return e.select(
        "event_id", F.unix_micros(local_midnight(F.to_date("ts"), "America/New_York", 1)).alias("ny_us"), F.unix_micros(from_epoch(s, "s")).alias("epoch_us"),
        F.unix_micros(from_epoch(F.concat(s, F.lit("x")), "s")).alias("broken_us"),
        F.unix_micros(from_rfc3339(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("789Z")))).alias("rfc_us"),
        duration_class(F.lit("2024-01-01").cast("date"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("event_id") % 400).cast("int"))).alias("duration"),
    )


QUERIES = {f.__name__: f for f in (
    rules_domain,
    rules_first_failure_counts, rules_accepted, rules_quarantine, dedup_scope_file, dedup_scope_key, load_log_by_rule, halt_violations, halt_drill, sequence_gaps, sequence_gaps_edges, gap_totals, turn_gaps,
    gate_thresholds, rejection_rates, comparisons_due, semi_chosen_files, anti_pending, lookup_left, registry_flag, symmetric_difference, set_subtract_both, scalar_times,
)}


def _judged(scope: str = "", early: bool = False) -> str:
    """The spec as SQL, written out."""
    known = "epoch_us(event_time) + lag_us"
    drill = ""
    if early:
        known = "CASE WHEN place = 1 AND good THEN epoch_us(event_time) - 1000000 ELSE epoch_us(event_time) + lag_us END"
        drill = """, row_number() OVER (PARTITION BY file, good ORDER BY raw_order) AS place"""
    return f"""raw AS (SELECT event_id AS raw_order, CASE WHEN event_id % 53 = 0 THEN 'x' ELSE CAST(event_id - CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END AS VARCHAR) END AS raw_id,
  CASE WHEN event_id % 71 = 0 THEN '' ELSE event_type END AS raw_symbol,
  CASE WHEN event_id % 41 = 0 THEN '-1' WHEN event_id % 43 = 0 THEN '?' ELSE CAST(CAST(value AS DECIMAL(28,10)) AS VARCHAR) END AS raw_price, event_id % 5 + 1 AS quantity, ts AS event_time,
  CASE WHEN event_id % 61 = 0 THEN '{{' END AS corrupt, CASE WHEN event_id % 997 = 5 THEN -1000 ELSE event_id % 7 END AS lag_us, 'f' || CAST(CAST(ts AS DATE) AS VARCHAR) AS file FROM events),
typed AS (SELECT *, TRY_CAST(raw_id AS BIGINT) AS trade_id, nullif(raw_symbol, '') AS symbol_key, TRY_CAST(raw_price AS DECIMAL(28,10)) AS price FROM raw),
ok AS (SELECT *, corrupt IS NULL AND symbol_key IS NOT NULL AND trade_id IS NOT NULL AND event_time >= TIMESTAMP '2024-01-01' AND event_time < TIMESTAMP '2024-01-28' AND coalesce(price > 0, false) AS good FROM typed),
dr AS (SELECT *{drill} FROM ok),
kn AS (SELECT *, {known} AS known_us FROM dr),
jj AS (SELECT *, CASE WHEN corrupt IS NOT NULL THEN 'record_parses' WHEN symbol_key IS NULL OR trade_id IS NULL THEN 'key_present'
  WHEN NOT (event_time >= TIMESTAMP '2024-01-01' AND event_time < TIMESTAMP '2024-01-28') THEN 'timestamp_plausible' WHEN NOT coalesce(price > 0, false) THEN 'price_and_quantity_positive'
  WHEN known_us < epoch_us(event_time) THEN 'knowable_at_not_before_event' END AS first FROM kn),
judged AS (SELECT * EXCLUDE (first), CASE WHEN first IS NULL AND row_number() OVER (PARTITION BY {scope} symbol_key, trade_id, first IS NULL ORDER BY raw_order) > 1 THEN 'duplicate_key' ELSE first END AS rule FROM jj)"""


_GLOG = f"""{fr.LOAD_LOG},
lr AS (SELECT "table", period AS day, rows, 'bad_price' AS rule, rejected AS n FROM log UNION ALL SELECT "table", period, rows, 'duplicate', run % 3 FROM log)"""
_EDGES = """h AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS day, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS p FROM events),
b AS (SELECT *, CAST(epoch(CAST(day AS TIMESTAMP)) AS BIGINT) AS s, lag(p) OVER (PARTITION BY event_type, day ORDER BY p) AS q FROM h),
g AS (SELECT event_type, day, q + 3600 AS gap_start, p - 3600 AS gap_end FROM b WHERE q IS NOT NULL
  UNION ALL SELECT event_type, day, s, min(p) - 3600 FROM b GROUP BY event_type, day, s UNION ALL SELECT event_type, day, max(p) + 3600, s + 23 * 3600 FROM b GROUP BY event_type, day, s),
gaps AS (SELECT *, CAST((gap_end - gap_start) // 3600 + 1 AS BIGINT) AS missing FROM g WHERE gap_end >= gap_start)"""

ORACLE = {
    "rules_first_failure_counts": f"WITH {_judged()} SELECT coalesce(rule, 'accepted') AS rule, count(*) AS rows FROM judged GROUP BY 1",
    "rules_accepted": f"WITH {_judged()} SELECT symbol_key, file AS _source_file, count(*) AS rows, CAST(sum(price) AS DOUBLE) AS price, max(known_us) AS known_us FROM judged WHERE rule IS NULL GROUP BY ALL",
    "rules_quarantine": f"WITH {_judged()} SELECT rule, raw_id, raw_price, file AS _source_file, epoch_us(event_time) AS event_time_us FROM judged WHERE rule IS NOT NULL AND rule NOT IN ('knowable_at_not_before_event')",
    "rules_domain": """WITH x AS (SELECT o_orderkey AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS p, CAST(o_orderdate AS DATE) AS day, o_orderdate + to_hours(o_orderkey % 48) AS t FROM orders)
SELECT unnest(['price_and_quantity_positive', 'ohlc_consistent', 'value_reported', 'value_numeric', 'period_ordered', 'document_has_text', 'timestamp_plausible']) AS rule,
  unnest([count(*) FILTER (WHERE NOT (p > 0 AND k % 5 > 0)), count(*) FILTER (WHERE k % 17 = 0 OR k % 19 = 0), count(*) FILTER (WHERE k % 7 = 0), count(*) FILTER (WHERE k % 7 = 0 OR k % 11 = 0),
    count(*) FILTER (WHERE k % 3 > 0 AND k % 9 - 1 > 5), count(*) FILTER (WHERE k % 20000 < 10000), count(*) FILTER (WHERE NOT (CAST(t AS DATE) BETWEEN day - 6 AND day + 1 AND hour(t) BETWEEN 6 AND 22))]) AS rows FROM x""",
    "dedup_scope_file": f"WITH {_judged('file,')} SELECT file AS _source_file, count(*) AS rows FROM judged WHERE rule = 'duplicate_key' GROUP BY 1",
    "dedup_scope_key": """WITH x AS (SELECT *, CASE WHEN l_quantity > 45 THEN 'too_many' END AS r FROM lineitem),
y AS (SELECT *, CASE WHEN r IS NULL AND row_number() OVER (PARTITION BY l_orderkey, l_linenumber, r IS NULL ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) > 1 THEN 'duplicate_key' ELSE r END AS rule FROM x)
SELECT l_returnflag, coalesce(rule, 'accepted') AS rule, count(*) AS rows, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM y GROUP BY ALL""",
    "load_log_by_rule": f"""WITH {_judged()}, c AS (SELECT file, rule, count(*) AS n FROM judged GROUP BY ALL),
t AS (SELECT file, CAST(sum(n) AS BIGINT) AS rows_read, CAST(coalesce(sum(n) FILTER (WHERE rule IS NULL), 0) AS BIGINT) AS rows_accepted FROM c GROUP BY file)
SELECT t.file AS _source_file, rows_read, rows_accepted, c.rule, c.n FROM t LEFT JOIN c ON c.file = t.file AND c.rule IS NOT NULL""",
    "halt_violations": f"WITH {_judged()} SELECT rule, count(*) AS rows, CAST(least(count(*), 5) AS INTEGER) AS sampled FROM judged WHERE rule = 'knowable_at_not_before_event' GROUP BY rule",
    "halt_drill": f"WITH {_judged(early=True)} SELECT file AS _source_file, count(*) AS rows FROM judged WHERE rule = 'knowable_at_not_before_event' GROUP BY 1",
    "sequence_gaps": """WITH k AS (SELECT 'all' AS series, event_id, lag(event_id) OVER (ORDER BY event_id) AS q FROM events WHERE event_id % 10 < 7 OR event_id % 13 = 0)
SELECT series, q + 1 AS gap_start, event_id - 1 AS gap_end, event_id - 1 - q AS missing FROM k WHERE event_id - 1 >= q + 1""",
    "sequence_gaps_edges": f"WITH {_EDGES} SELECT event_type, day, gap_start, gap_end, missing FROM gaps",
    "gap_totals": f"WITH {_EDGES} SELECT event_type, count(*) AS gaps, CAST(sum(missing) AS BIGINT) AS missing FROM gaps GROUP BY 1",
    "turn_gaps": """WITH k AS (SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS q FROM conversations WHERE turn <> 2),
g AS (SELECT turn - 1 - q AS missing FROM k WHERE turn - 1 > q UNION ALL SELECT min(turn) FROM conversations WHERE turn <> 2 GROUP BY conv_id HAVING min(turn) > 0)
SELECT missing, count(*) AS gaps FROM g GROUP BY missing""",
    "gate_thresholds": f"""WITH {_GLOG},
m AS (SELECT 'rejected/' || l.rule AS "check", l."table" AS subject, l.day, CAST(max(r.measured) AS BIGINT) AS measured, CAST(sum(l.n) AS BIGINT) AS failed
  FROM lr l JOIN (SELECT "table", period AS day, sum(rows) AS measured FROM log GROUP BY ALL) r USING ("table", day) GROUP BY ALL),
t AS (SELECT m.*, CASE WHEN "check" = 'rejected/bad_price' AND subject = 't1' THEN 0.05::DOUBLE * measured + 1.0::DOUBLE WHEN "check" = 'rejected/bad_price' THEN 0.02::DOUBLE * measured + 2.0::DOUBLE ELSE 0.01::DOUBLE * measured + 1.0::DOUBLE END AS allowed FROM m)
SELECT "check", subject, day, measured, failed, round(allowed, 6) AS allowed, CASE WHEN failed <= allowed THEN 'passed'
  WHEN ("check" = 'rejected/bad_price' AND subject = 't3' AND day = DATE '1997-05-28') OR ("check" = 'rejected/duplicate' AND subject = 't1' AND day = DATE '1998-10-03') THEN 'waived' ELSE 'failed' END AS outcome FROM t""",
    "rejection_rates": f"""WITH {_GLOG}, d AS (SELECT 't' || i AS "table", r AS rule FROM range(5) t(i), (VALUES ('bad_price'), ('duplicate'), ('never')) v(r)),
j AS (SELECT "table", CAST(sum(rows) AS BIGINT) AS judged FROM log GROUP BY 1), x AS (SELECT "table", rule, CAST(sum(n) AS BIGINT) AS rejected FROM lr GROUP BY ALL)
SELECT d."table", d.rule, j.judged, coalesce(x.rejected, 0) AS rejected, round(coalesce(x.rejected, 0) / j.judged, 9) AS rate FROM d JOIN j USING ("table") LEFT JOIN x USING ("table", rule)""",
    "comparisons_due": f"""WITH {fr.LOAD_LOG}, h AS (SELECT "table" AS key, period AS day, max(run) AS run FROM log GROUP BY ALL),
l AS (SELECT key, day, CAST(run AS VARCHAR) AS left_hash FROM h WHERE run % 3 <> 0), r AS (SELECT key, day, CAST(run AS VARCHAR) AS right_hash FROM h WHERE run % 3 <> 1),
b AS (SELECT * FROM l FULL JOIN r USING (key, day))
SELECT key, day, left_hash, right_hash FROM b WHERE ((left_hash IS NOT NULL AND right_hash IS NOT NULL) OR date_diff('day', day, DATE '2001-08-01') > 400)
  AND NOT EXISTS (SELECT 1 FROM h WHERE h.run % 6 = 2 AND h.key = b.key AND h.day = b.day AND CAST(h.run AS VARCHAR) = b.left_hash AND CAST(h.run AS VARCHAR) = b.right_hash)""",
    "semi_chosen_files": f"""WITH {fr.LOAD_LOG} SELECT "table", count(*) AS files, CAST(sum(rows) AS BIGINT) AS rows FROM log WHERE path IN (SELECT path FROM log WHERE rejected = 4) GROUP BY 1""",
    "anti_pending": f"""WITH {fr.LOAD_LOG}, m AS (SELECT path, "table" AS dataset, symbol, period AS period_start, loaded_at FROM log QUALIFY row_number() OVER (PARTITION BY "table", symbol, period ORDER BY loaded_at DESC, path DESC) = 1)
SELECT path, dataset, symbol, period_start, epoch_us(loaded_at) AS fetched_at_us FROM m WHERE right(path, 1) NOT IN ('0', '4', '8')""",
    "scalar_times": """SELECT event_id, epoch_us(timezone('UTC', timezone('America/New_York', CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP)))) AS ny_us, CAST(epoch(date_trunc('second', ts)) AS BIGINT) * 1000000 AS epoch_us, CAST(NULL AS BIGINT) AS broken_us, epoch_us(ts) AS rfc_us,
  CASE WHEN event_id % 400 + 1 BETWEEN 80 AND 100 THEN 'quarter' WHEN event_id % 400 + 1 BETWEEN 350 AND 380 THEN 'annual' END AS duration FROM events""",
    "lookup_left": "SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 3 <> 0",
    "registry_flag": f"""WITH {fr.LOAD_LOG} SELECT symbol, symbol <> 'S3' AS registered, count(*) AS rows FROM log GROUP BY ALL""",
    "symmetric_difference": """WITH x AS (SELECT l_returnflag, l_linestatus, l_linenumber, l_tax FROM lineitem),
a AS (SELECT * FROM x WHERE l_tax < 0.06 EXCEPT ALL SELECT * FROM x WHERE l_tax > 0.01), b AS (SELECT * FROM x WHERE l_tax > 0.01 EXCEPT ALL SELECT * FROM x WHERE l_tax < 0.06)
SELECT 'left' AS side, l_returnflag, count(*) AS rows FROM a GROUP BY ALL UNION ALL SELECT 'right', l_returnflag, count(*) FROM b GROUP BY ALL""",
    "set_subtract_both": """WITH a AS (SELECT l_partkey FROM lineitem WHERE l_quantity < 40), b AS (SELECT l_partkey FROM lineitem WHERE l_quantity > 20)
SELECT l_partkey, 'removed' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT l_partkey, 'added' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
}
