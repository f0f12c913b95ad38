"""Small helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import discard, materialize

# Bytes of text that a Python task handles at once; one longer text is handled alone.
SLICE_BYTES = 4 << 20

__all__ = [
    "SLICE_BYTES", "bucket_of", "discard", "free_name", "identified", "materialize", "read_table",
    "slices", "texts_of",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, with underscores added until no column of `df` has that name."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def bucket_of(column: str, buckets: int) -> Column:
    """crc32 of the number as text, modulo `buckets`; a null counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % buckets


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and text_key, a 64-bit hash of the text.

    (doc_id, text_key) names a document whatever task or attempt reads it. Rows that agree
    in both are repeats of one document: they share its result and do not match each other.
    """
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_key"))


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES,
) -> Iterator[pa.RecordBatch]:
    """The rows of `batches`, in pieces of at most `most` bytes of text or one row."""
    for batch in batches:
        start = size = 0
        lengths = pa.compute.binary_length(batch.column(text)).to_pylist()
        for row, length in enumerate(lengths):
            if row > start and size + (length or 0) > most:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += length or 0
        if len(lengths) > start:
            yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[str]:
    return [value or "" for value in batch.column(text).to_pylist()]
