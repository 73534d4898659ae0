"""The corpus pipeline: quality classifier, exact dedup, MinHash near-dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a DataFrame; ``run`` writes each
result as Parquet into the shared folder and rereads it as the next stage's documents.

Defined cases: null, blank and very long texts, ties, repeated rows and clashing columns are what each operator's module says;
all stages but the last return every column of the documents, of any name; a table without rows gives one without rows; without
labels nothing is rejected.  A document taken twice by the mix is packed twice, told apart by ``row``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exactdedup, mixing, packing, probminhash, quality
from tidemark.llm.common import read, tidy
from tidemark.llm.queries import tokenizer_path


def _frugal(spark: SparkSession) -> None:
    """The pipeline's session hands Python workers few rows at a time: its stages share executors with what earlier ones left."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of the documents at hand, does not reject."""
    _frugal(spark)
    return quality.select(docs, read(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    _frugal(spark)
    return exactdedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    _frugal(spark)
    return probminhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask."""
    _frugal(spark)
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens; ``row`` tells apart the copies of a document."""
    _frugal(spark)
    pieces = packing.pack(docs, tokenizer_path("word_bpe_49k.json"))
    return pieces.select("doc_id", "row", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality classifier", select_quality),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        with tidy(spark) as keep:  # the stage's scratch tables go, its result stays
            docs = keep(stage(spark, docs, sf_dir), "stage")
    return docs


#: The classifier's fit, the sketches and the packing program are beyond SQL: tests hold the pipeline against a plain version.
ORACLE_SQL = None
