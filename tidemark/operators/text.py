"""Documents to lines and chunks, by Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.html import chunk, html_lines


def to_lines(docs: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """id, line_no (from 0), line."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, n, line) for i, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for n, line in enumerate(html_lines(html))]
            yield _batch(found, {id_col: pa.int64(), "line_no": pa.int32(), "line": pa.string()})

    return docs.select(F.col(id_col).cast("long"), F.col(html_col).cast("string")).mapInArrow(run, f"{id_col} long, line_no int, line string")


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))


def to_chunks(docs: DataFrame, id_col: str, text_col: str, html: bool = False, size: int = 2000, overlap: int = 300, partitions: int | None = None) -> DataFrame:
    """id, chunk_id, chunk_index, section, text: chunks of HTML or of plain lines.

    ``partitions`` deals long documents out by id first.  A chunk's id is the head of a digest of id, index and text.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                lines = html_lines(text) if html else [x for x in (y.strip() for y in (text or "").split("\n")) if x]
                found += [(i, *c) for c in chunk(lines, size, overlap)]
            yield _batch(found, {id_col: pa.int64(), "chunk_index": pa.int32(), "section": pa.string(), "text": pa.string()})

    given = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    if partitions:
        given = given.repartition(partitions, id_col)
    found = given.mapInArrow(run, f"{id_col} long, chunk_index int, section string, text string")
    return found.withColumn("chunk_id", chunk_id(F.col(id_col), F.col("chunk_index"), F.col("text")))


def chunk_id(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("\x1f", *[p.cast("string") for p in parts]), 256), 1, 32)


def context(title: str, section: Column, day: Column) -> Column:
    """The line that stands before a chunk: what document, of when, which section."""
    return F.concat_ws(" - ", F.lit(title), day.cast("string"), F.nullif(section, F.lit("")))
