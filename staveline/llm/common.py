"""What the corpus operators share: tables, text forms, and sizes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the contracts: ASCII white space, and the letters that are lower-cased.
ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())

ROW = "__row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_row(df: DataFrame, *own: Column) -> DataFrame:
    """The whole input row in one struct, so that its names cannot clash, and own columns."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW), *own)


def unpacked(df: DataFrame, columns: list[str], *own: str) -> DataFrame:
    """The columns of the input again; own columns replace those of the same name."""
    kept = [F.col(f"{ROW}.`{c}`").alias(c) for c in columns if c not in own]
    return df.select(*kept, *own)


def encoded_texts(batches: Iterable[pa.RecordBatch], ids: str, text: str) -> Iterator[tuple]:
    """(id, text as UTF-8 bytes) of each row, one batch in memory."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
        keys = batch.column(batch.schema.get_field_index(ids)).to_pylist()
        for key, value in zip(keys, texts):
            yield key, value.as_py() or b""


def held_out(remainder: int, modulus: int, doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves this remainder; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % modulus == remainder
