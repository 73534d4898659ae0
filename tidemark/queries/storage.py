"""Readers over files that tasks write, verified loads, and the snapshot store."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import functions as F

from tidemark.queries import frames as fr
from tidemark.sources import landing, readers, store

AT = datetime(2024, 2, 1, tzinfo=UTC)


def _folder(spark, name: str) -> str:
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def _lines(spark, rows, name: str, *by: str) -> str:
    """One column of text as files, apart by the columns named."""
    path = _folder(spark, name)
    rows.write.partitionBy(*by).text(path)
    return path


def _orders(spark, d):
    o = fr.table(spark, d, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p"), (F.col("o_orderkey") % 50).alias("broken"))


def read_csv_rows(spark, d):
    """A line of two fields of three is kept, marked as corrupt."""
    o = _orders(spark, d)
    path = _lines(spark, o.select(F.when(F.col("broken") == 0, F.concat_ws(",", "k", "s")).otherwise(F.concat_ws(",", "k", "s", "p")).alias("value")), "csv")
    return readers.read_raw(spark, readers.Dataset("s", "csv", ("k", "s", "p")), path)


def read_json_rows(spark, d):
    o = _orders(spark, d)
    row = F.when(F.col("broken") == 0, F.to_json(F.array("k", "s"))).otherwise(F.to_json(F.array("k", "s", "p")))
    path = _lines(spark, o.select(F.when(F.col("broken") == 1, F.concat(F.lit("oops "), "k")).otherwise(F.concat(F.lit("["), row, F.lit("]"))).alias("value")), "json_rows")
    return readers.read_raw(spark, readers.Dataset("s", "rows", ("k", "s", "p"), "json_rows"), path)


def read_json_records(spark, d):
    o = _orders(spark, d).groupBy("s").agg(F.array_sort(F.collect_list(F.struct("k", "p"))).alias("results"))
    path = _lines(spark, o.select(F.to_json(F.struct(F.struct("results").alias("page"))).alias("value")), "json_records")
    return readers.read_raw(spark, readers.Dataset("s", "records", ("k", "p"), "json_records", "page.results"), path)


def read_json_columns(spark, d):
    o = _orders(spark, d).groupBy("s").agg(F.array_sort(F.collect_list(F.struct("k", "p"))).alias("r"))
    told = F.to_json(F.struct(F.struct(F.col("r.k").alias("k"), F.col("r.p").alias("p")).alias("recent")))
    path = _lines(spark, o.select(told.alias("value")), "json_columns")
    return readers.read_raw(spark, readers.Dataset("s", "columns", ("k", "p"), "json_columns", "recent"), path)


def read_facts(spark, d):
    """Nested maps of taxonomy, concept and unit; one file for each status and every 100,000 keys, so that no file grows with the table."""
    o = fr.table(spark, d, "orders").where("o_orderstatus <> 'P'").withColumn("part", F.expr("o_orderkey div 100000"))
    fact = F.struct(F.col("o_orderkey").cast("string").alias("accn"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("val"))
    units = o.groupBy("o_orderstatus", "part", "o_orderpriority").agg(F.array_sort(F.collect_list(fact)).alias("facts"))
    concepts = units.groupBy("o_orderstatus", "part").agg(F.map_from_entries(F.collect_list(F.struct("o_orderpriority", F.struct(F.create_map(F.lit("USD"), "facts").alias("units"))))).alias("c"))
    told = F.to_json(F.struct(F.create_map("o_orderstatus", "c").alias("facts")))
    path = _lines(spark, concepts.select("o_orderstatus", "part", told.alias("value")), "facts", "o_orderstatus", "part")
    return readers.read_raw(spark, readers.Dataset("s", "facts", ("taxonomy", "concept", "unit", "accn", "val"), "facts", "facts"), path)


def read_documents(spark, d):
    """Whole files: their digests and sizes."""
    pages = fr.table(spark, d, "pages").select("page_id", F.regexp_replace("html", r"[\r\n]+", " ").alias("value"))
    path = _lines(spark, pages.where("value <> ''").select("value").repartition(4, "value"), "documents")
    read = readers.read_raw(spark, readers.Dataset("s", "documents", ("document",), "document"), path)
    return read.select(F.explode(F.split("document", "\n")).alias("line")).where("line <> ''").select(F.sha2("line", 256).alias("sha"), F.length("line").alias("chars"))


# -- the store


def _rows(spark, d):
    return fr.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("year"))


def _store(spark, d):
    """All orders but those of 1997; then these; then 1995 anew without its open ones; then every third order gone."""
    s, rows = store.SnapshotStore(spark, _folder(spark, "store")), _rows(spark, d)
    s.overwrite("orders", rows.where("year <> 1997"), "r0", ["year"])
    s.append("orders", rows.where("year = 1997"), "r1")
    s.replace("orders", F.col("year") == 1995, rows.where("year = 1995 and o_orderstatus <> 'O'"), "r2")
    s.delete_orphans("orders", "o_orderkey", rows.where("o_orderkey % 3 <> 0"), "r3")
    return s


def _summary(df):
    return df.groupBy("year", "o_orderstatus").agg(F.count("*").alias("rows"), F.sum("o_custkey").alias("customers"))


def store_current(spark, d):
    return _summary(_store(spark, d).read("orders"))


def store_time_travel(spark, d):
    s = _store(spark, d)
    every = [_summary(s.read("orders", v)).withColumn("version", F.lit(v)) for v in range(3)]
    return every[0].unionByName(every[1]).unionByName(every[2])


def store_history(spark, d):
    """What each commit did: rows after it, partitions that came and went."""
    h = _store(spark, d).history("orders")
    return spark.createDataFrame([(c.version, c.operation, c.run_id, c.rows, len(c.add), len(c.remove)) for c in h], "version int, operation string, run_id string, rows long, came int, went int")


def load_replaces_files(spark, d):
    """Files of a year each, loaded; one lands again with other rows, one whose bytes aren't its manifest's is left out."""
    root = _folder(spark, "landed")
    rows = _rows(spark, d)
    years = sorted(r["year"] for r in rows.select("year").distinct().collect())
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    fs = path(root).getFileSystem(conf)

    def land(year: int, which: str, name: str) -> None:
        rows.where(f"year = {year} and {which}").select(F.concat_ws(",", "o_orderkey", "o_orderstatus").alias("value")).coalesce(1).write.text(f"{root}/parts/{name}")
        part = next(f.getPath() for f in fs.listStatus(path(f"{root}/parts/{name}")) if f.getPath().getName().startswith("part-"))
        fs.mkdirs(path(f"{root}/landed"))
        fs.delete(path(f"{root}/landed/{year}.csv"), False)
        if not fs.rename(part, path(f"{root}/landed/{year}.csv")):
            raise OSError(f"{name} could not be landed")

    def manifests(told):
        files = spark.read.format("binaryFile").load(f"{root}/landed/*.csv")
        year = F.regexp_extract("path", r"(\d+)\.csv$", 1)
        found = files.select(F.concat(year, F.lit(".csv")).alias("path"), F.lit("S").alias("symbol"), F.to_date(F.concat(year, F.lit("-01-01"))).alias("period_start"), F.when(year == str(years[1]), "0").otherwise(F.sha2("content", 256)).alias("sha256"))
        return found.where(F.col("path").isin([f"{y}.csv" for y in told]))

    data, s = readers.Dataset("s", "orders", ("k", "status")), store.SnapshotStore(spark, f"{root}/store")
    for year in years:
        land(year, "o_orderkey % 2 = 0", f"{year}-first")
    landing.load_files(s, "raw", f"{root}/landed", manifests(years), data, "r0", AT)
    land(years[0], "o_orderkey % 2 = 1", f"{years[0]}-again")
    landing.load_files(s, "raw", f"{root}/landed", manifests(years[:1]), data, "r1", AT)
    return s.read("raw").groupBy("_source_file", "_load_run_id").agg(F.count("*").alias("rows"), F.sum(F.col("k").cast("long")).alias("keys"))


QUERIES = {f.__name__: f for f in (read_csv_rows, read_json_rows, read_json_records, read_json_columns, read_facts, read_documents, store_current, store_time_travel, store_history, load_replaces_files)}

_Y = "y AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)"
_SUM = "count(*) AS rows, CAST(sum(o_custkey) AS BIGINT) AS customers"

ORACLE = {
    "read_csv_rows": """SELECT CAST(o_orderkey AS VARCHAR) AS k, o_orderstatus AS s, CASE WHEN o_orderkey % 50 <> 0 THEN o_orderpriority END AS p, CASE WHEN o_orderkey % 50 = 0 THEN CAST(o_orderkey AS VARCHAR) || ',' || o_orderstatus END AS _corrupt_record FROM orders""",
    "read_json_rows": """SELECT CASE WHEN o_orderkey % 50 > 1 THEN CAST(o_orderkey AS VARCHAR) END AS k, CASE WHEN o_orderkey % 50 > 1 THEN o_orderstatus END AS s, CASE WHEN o_orderkey % 50 > 1 THEN o_orderpriority END AS p,
  CASE o_orderkey % 50 WHEN 0 THEN '["' || CAST(o_orderkey AS VARCHAR) || '","' || o_orderstatus || '"]' WHEN 1 THEN 'oops ' || CAST(o_orderkey AS VARCHAR) END AS _corrupt_record FROM orders""",
    "read_json_records": "SELECT CAST(o_orderkey AS VARCHAR) AS k, o_orderpriority AS p, CAST(NULL AS VARCHAR) AS _corrupt_record FROM orders",
    "read_json_columns": "SELECT CAST(o_orderkey AS VARCHAR) AS k, o_orderpriority AS p, CAST(NULL AS VARCHAR) AS _corrupt_record FROM orders",
    "read_facts": "SELECT o_orderstatus AS taxonomy, o_orderpriority AS concept, 'USD' AS unit, CAST(o_orderkey AS VARCHAR) AS accn, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS val, CAST(NULL AS VARCHAR) AS _corrupt_record FROM orders WHERE o_orderstatus <> 'P'",
    "read_documents": r"WITH p AS (SELECT regexp_replace(html, '[\r\n]+', ' ', 'g') AS line FROM pages WHERE html <> '') SELECT sha256(line) AS sha, CAST(length(line) AS INTEGER) AS chars FROM p",
    "store_current": f"WITH {_Y} SELECT year, o_orderstatus, {_SUM} FROM y WHERE NOT (year = 1995 AND o_orderstatus = 'O') AND o_orderkey % 3 <> 0 GROUP BY ALL",
    "store_time_travel": f"""WITH {_Y} SELECT 0 AS version, year, o_orderstatus, {_SUM} FROM y WHERE year <> 1997 GROUP BY ALL UNION ALL SELECT 1, year, o_orderstatus, {_SUM} FROM y GROUP BY ALL
UNION ALL SELECT 2, year, o_orderstatus, {_SUM} FROM y WHERE NOT (year = 1995 AND o_orderstatus = 'O') GROUP BY ALL""",
    "store_history": f"""WITH {_Y}, k AS (SELECT * FROM y WHERE NOT (year = 1995 AND o_orderstatus = 'O')), g AS (SELECT CAST(count(DISTINCT year) AS INTEGER) AS n FROM k WHERE o_orderkey % 3 = 0)
SELECT 0 AS version, 'OVERWRITE' AS operation, 'r0' AS run_id, count(*) AS rows, CAST(count(DISTINCT year) AS INTEGER) AS came, 0 AS went FROM y WHERE year <> 1997
UNION ALL SELECT 1, 'APPEND', 'r1', count(*), CAST(count(DISTINCT year) FILTER (WHERE year = 1997) AS INTEGER), 0 FROM y
UNION ALL SELECT 2, 'REPLACE', 'r2', count(*), CAST(count(DISTINCT year) FILTER (WHERE year = 1995) AS INTEGER), (SELECT CAST(count(DISTINCT year) AS INTEGER) FROM y WHERE year = 1995) FROM k
UNION ALL SELECT 3, 'DELETE', 'r3', count(*) FILTER (WHERE o_orderkey % 3 <> 0), (SELECT CAST(count(DISTINCT year) AS INTEGER) FROM k WHERE o_orderkey % 3 <> 0 AND year IN (SELECT year FROM k WHERE o_orderkey % 3 = 0)), (SELECT n FROM g) FROM k""",
    "load_replaces_files": f"""WITH {_Y}, n AS (SELECT DISTINCT year FROM y), r AS (SELECT year, row_number() OVER (ORDER BY year) AS i FROM n)
SELECT CAST(year AS VARCHAR) || '.csv' AS _source_file, CASE WHEN i = 1 THEN 'r1' ELSE 'r0' END AS _load_run_id, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys
FROM y JOIN r USING (year) WHERE i <> 2 AND o_orderkey % 2 = CASE WHEN i = 1 THEN 1 ELSE 0 END GROUP BY ALL""",
}
