"""Chunks of words kept as a table, so that small answers can be brought to them without moving them.

A chunk is what one task reads of some documents: its distinct words and all words as
numbers of these. Chunks are stored once, in buckets of their own number; each later
pass joins them with what was found for them, and only the findings are shuffled.
Chunks are numbered as they are stored, so nothing depends on the order of the input.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staveline.llm.chunks import squeeze, unsqueeze
from staveline.llm.common import partitions
from staveline.session import scratch_folder, shuffles_dropped

CHUNK = "chunk long, head array<long>, sizes array<int>, words binary, codes binary"
SEED = 42
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bucketed(rows: DataFrame, label: str, drop_shuffles: bool = False) -> DataFrame:
    """The rows written in buckets of ``chunk``; joins on it leave them in place.

    ``drop_shuffles`` as in ``settled``.
    """
    spark = rows.sparkSession
    name = f"{label}_{uuid.uuid4().hex}".replace("-", "_")
    writer = rows.write.bucketBy(partitions(spark), "chunk").sortBy("chunk")
    with shuffles_dropped(spark, drop_shuffles):
        writer.option("path", scratch_folder(spark, label)).saveAsTable(name)
    return spark.table(name)


def store_chunks(chunks: DataFrame, label: str) -> DataFrame:
    """The chunks numbered and stored in buckets."""
    return bucketed(chunks.withColumn("chunk", F.monotonically_increasing_id()), label)


def chunk_columns(words: list[bytes], codes: np.ndarray) -> list[pa.Array]:
    """The columns ``words`` and ``codes`` of one chunk; words hold no space."""
    blob = zstandard.ZstdCompressor(level=3).compress(b" ".join(words))
    return [pa.array([blob], pa.binary()), pa.array([squeeze(codes)], pa.binary())]


def chunk_words(blob: pa.Scalar) -> list[bytes]:
    text = zstandard.ZstdDecompressor().decompress(blob.as_py())
    return text.split(b" ") if text else []


def chunk_codes(blob: pa.Scalar) -> np.ndarray:
    return unsqueeze(blob.as_py())


def word_hashes(words: list[bytes], seed: int = SEED) -> np.ndarray:
    """A 64-bit number for each word."""
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def each_row(
    work: Callable[[dict[str, pa.Scalar]], Iterable[pa.RecordBatch]],
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function over batches from one over single rows, for rows as large as a chunk."""

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from work({name: batch.column(j)[i] for j, name in enumerate(batch.schema.names)})

    return over


@contextmanager
def few_rows_a_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """Queries that run within send a worker so many rows at a time, for rows as large as a chunk."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, rows)
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def listed(value: pa.ListScalar, kind: type = np.int64) -> np.ndarray:
    """The numbers of a list; a missing list is empty."""
    if value.values is None:
        return np.zeros(0, kind)
    return value.values.to_numpy(zero_copy_only=False).astype(kind, copy=False)


def mixed(a: np.ndarray) -> np.ndarray:
    """64-bit numbers well mixed, so that any bits of them are as good as others."""
    a = a ^ (a >> np.uint64(31))
    a = a * np.uint64(0x9E3779B97F4A7C15)
    return a ^ (a >> np.uint64(29))


def rolled(numbers: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit number for each run of n numbers, by place of its first."""
    out = np.zeros(max(len(numbers) - n + 1, 0), np.uint64)
    for j in range(n):
        out = mixed(out + numbers[j : j + len(out)])
    return out
