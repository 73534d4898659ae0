"""Raw files to all-string rows: what doesn't parse is kept in ``_corrupt_record``, never dropped.

Formats: csv; json_rows (lines of arrays of arrays); json_records (lines of objects with an array of objects under a key);
json_columns (lines of objects with parallel arrays); facts (documents of nested maps taxonomy, concept, unit, facts); document (whole file).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Dataset:
    source: str
    name: str
    columns: tuple[str, ...]
    format: str = "csv"
    path: str = ""  # dotted, where the format looks for its array or columns
    header: bool = False
    stale_after_days: float = 3.0


def _strings(names: tuple[str, ...]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def _nested(path: str, leaf) -> StructType:
    for name in reversed(path.split(".")):
        leaf = StructType([StructField(name, leaf)])
    return leaf


def _corrupt(df: DataFrame, names: tuple[str, ...], raw: Column) -> DataFrame:
    return df.select(*[F.lit(None).cast("string").alias(n) for n in names], raw.alias(CORRUPT))


def read_csv(spark: SparkSession, data: Dataset, path: str) -> DataFrame:
    # without pruning: whether a row is corrupt must not depend on the columns a query reads
    schema = _strings(data.columns).add(CORRUPT, StringType())
    return spark.read.schema(schema).option("columnPruning", False).csv(path, header=data.header, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(F.trim("value") != "")


def read_json_rows(spark: SparkSession, data: Dataset, path: str) -> DataFrame:
    """A row of the wrong width is corrupt, as JSON; a line that isn't an array of arrays is corrupt as it is."""
    parsed = _lines(spark, path).withColumn("rows", F.from_json("value", ArrayType(ArrayType(StringType()))))
    rows = parsed.where("rows is not null").select(F.explode("rows").alias("row"))
    fits = F.col("row").isNotNull() & (F.size("row") == len(data.columns))
    good = [F.when(fits, F.get("row", F.lit(i))).alias(n) for i, n in enumerate(data.columns)]
    out = rows.select(*good, F.when(~F.coalesce(fits, F.lit(False)), F.coalesce(F.to_json("row"), F.lit("null"))).alias(CORRUPT))
    return out.unionByName(_corrupt(parsed.where("rows is null"), data.columns, F.col("value")))


def read_json_records(spark: SparkSession, data: Dataset, path: str) -> DataFrame:
    schema = _nested(data.path, ArrayType(_strings(data.columns)))
    parsed = _lines(spark, path).withColumn("found", F.from_json("value", schema)[data.path.split(".")[0]])
    for name in data.path.split(".")[1:]:
        parsed = parsed.withColumn("found", F.col("found")[name])
    rows = parsed.where("found is not null").select(F.explode("found").alias("r"))
    out = rows.select(*[F.col("r")[n].alias(n) for n in data.columns], F.when(F.col("r").isNull(), "null").alias(CORRUPT))
    return out.unionByName(_corrupt(parsed.where("found is null"), data.columns, F.col("value")))


def read_json_columns(spark: SparkSession, data: Dataset, path: str) -> DataFrame:
    """All arrays must be of one size, else the whole line is corrupt."""
    leaf = StructType([StructField(n, ArrayType(StringType())) for n in data.columns])
    parsed = _lines(spark, path).withColumn("c", F.from_json("value", _nested(data.path, leaf) if data.path else leaf))
    for name in data.path.split(".") if data.path else []:
        parsed = parsed.withColumn("c", F.col("c")[name])
    sizes = [F.size(F.col("c")[n]) for n in data.columns]
    even = F.lit(True)
    for s in sizes:
        even = even & (s == sizes[0]) & (s >= 0)
    parsed = parsed.withColumn("even", F.coalesce(even, F.lit(False)) & F.col("c").isNotNull())
    rows = parsed.where("even").select(F.explode(F.arrays_zip(*[F.col("c")[n].alias(n) for n in data.columns])).alias("r"))
    out = rows.select(*[F.col("r")[n].alias(n) for n in data.columns], F.lit(None).cast("string").alias(CORRUPT))
    return out.unionByName(_corrupt(parsed.where("not even"), data.columns, F.col("value")))


def _json_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """value: each JSON document's text; document: its fields, null unless the text is one value to its end.

    from_json stops at the end of the first value.  Inside a value no line break stands between a brace that closes and anything
    but a comma or another closing mark, so files are cut there.  What else follows a value on its line shows as the text is read
    as an array: the mark behind it, which no text can hold of itself, must come second and last.
    """
    value = F.explode(F.split("value", r"(?<=\})[^\S\r\n]*+[\r\n]\s*+(?=[^\s,}\]])")).alias("value")
    texts = spark.read.text(path, wholetext=True).select(value)
    end = f"{schema.fieldNames()[0]} end"
    sha = F.sha2("value", 256)
    read = F.from_json(F.concat(F.lit("["), F.col("value"), F.lit(f',{{"{end}":"'), sha, F.lit('"}]')), ArrayType(StructType([*schema.fields, StructField(end, StringType())])))
    whole = (F.size("read") == 2) & (F.get("read", F.lit(1))[end] == sha)
    return texts.withColumn("read", read).select("value", F.when(whole, F.get("read", F.lit(0))).alias("document"))


def read_facts(spark: SparkSession, data: Dataset, path: str) -> DataFrame:
    """taxonomy, concept, unit, then the fact's own columns: {path: {taxonomy: {concept: {units: {unit: [fact]}}}}}.

    A file holds one document or several, each from a line of its own on; one that has more than its value is corrupt.
    """
    own = tuple(c for c in data.columns if c not in ("taxonomy", "concept", "unit"))
    concept = StructType([StructField("units", MapType(StringType(), ArrayType(_strings(own))))])
    schema = _nested(data.path or "facts", MapType(StringType(), MapType(StringType(), concept)))
    key = (data.path or "facts").split(".")[0]
    parsed = _json_documents(spark, path, schema).withColumn("f", F.col("document")[key])
    by = parsed.where("f is not null").select(F.explode("f").alias("taxonomy", "c")).select("taxonomy", F.explode("c").alias("concept", "u")).select("taxonomy", "concept", F.explode("u.units").alias("unit", "fs")).select("taxonomy", "concept", "unit", F.explode("fs").alias("r"))
    out = by.select(*[F.col(n) if n in ("taxonomy", "concept", "unit") else F.col("r")[n].alias(n) for n in data.columns], F.when(F.col("r").isNull(), "null").alias(CORRUPT))
    return out.unionByName(_corrupt(parsed.where("f is null"), data.columns, F.col("value")))


def read_document(spark: SparkSession, data: Dataset, path: str) -> DataFrame:
    """One row per file; an empty file is corrupt."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.nullif(F.col("value"), F.lit("")).alias(data.columns[0]), F.when(F.coalesce(F.length("value"), F.lit(0)) == 0, "").alias(CORRUPT))


READERS = {"csv": read_csv, "json_rows": read_json_rows, "json_records": read_json_records, "json_columns": read_json_columns, "facts": read_facts, "document": read_document}


def read_raw(spark: SparkSession, data: Dataset, path: str) -> DataFrame:
    """Rows of strings and _corrupt_record."""
    if data.format not in READERS:
        raise ValueError(f"no reader for {data.format}")
    return READERS[data.format](spark, data, path)


def with_metadata(df: DataFrame, data: Dataset, symbol: str, period: str, file: str, sha256: str, run_id: str, at) -> DataFrame:
    return df.withColumns({
        "_source": F.lit(data.source), "_dataset": F.lit(data.name), "_symbol": F.lit(symbol), "_period_start": F.lit(period).cast("date"),
        "_source_file": F.lit(file), "_source_sha256": F.lit(sha256), "_ingested_at": F.lit(at), "_load_run_id": F.lit(run_id),
    })


def row_counts(df: DataFrame) -> DataFrame:
    """Rows, corrupt rows, and rows with a first column, per file.  (A scan of the corrupt column alone isn't allowed.)"""
    return df.groupBy("_source_file").agg(F.count("*").alias("rows"), F.count(CORRUPT).alias("corrupt"), F.count(df.columns[0]).alias("filled"))
