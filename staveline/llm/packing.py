"""Best-fit packing of token pieces by minimum bin slack."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staveline.llm.common import encoded_texts, partitions
from staveline.llm.tokens import byte_bpe
from staveline.session import settled

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(
    docs: DataFrame,
    vocabulary: str,
    capacity: int,
    end_id: int = 0,
    encoder: Callable[[str], Callable[[bytes], np.ndarray]] = byte_bpe,
) -> DataFrame:
    """The token pieces of each document: its ids, then ``end_id``.

    Documents of more than ``capacity`` ids are cut so that all pieces but the
    first are full. Null text is empty: one piece with only ``end_id``.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            out = []
            for doc_id, text in encoded_texts([batch], "doc_id", "text"):
                ids = np.concatenate([encode(text), end])
                bounds = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                if len(ids) < capacity:
                    bounds = [0, len(ids)]
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    out.append((doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            columns = zip(*out) if out else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(cut, PIECES)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How often to take each length so that their sum is as near to ``room`` as can be.

    Subset sums as the bits of one integer: bit s is set when s can be reached.
    Long lengths come last, so that they are taken first on the way back.
    """
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted(n for n in counts if n <= room):
        left, part = min(counts[length], room // length), 1
        while left:
            take = min(part, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, part = left - take, part * 2
        # The sum of all parts is the count, so no length is taken too often.
    at, taken = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if at >= length * take and before >> (at - length * take) & 1:
            at -= length * take
            taken[length] = taken.get(length, 0) + take
    return taken


def bin_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Which pieces share a sequence, for a table of piece lengths and their counts.

    Each bin takes the longest length left and the combination that leaves the
    least slack; it is repeated while its lengths last. So each step uses up a
    length or leaves less than one bin takes of it: at most about four times the
    capacity of steps, whatever the corpus. Rows: length, first and last+1 rank among the pieces of the length,
    pieces per sequence, first sequence, offset of the first such piece.
    """
    left = {k: v for k, v in counts.items() if v}
    used = dict.fromkeys(left, 0)
    plan, sequence = [], 0
    while left:
        longest = max(left)
        rest = {**left, longest: left[longest] - 1}
        chosen = fullest({k: v for k, v in rest.items() if v}, capacity - longest)
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[k] // n for k, n in chosen.items())
        offset = 0
        for length, n in sorted(chosen.items(), reverse=True):
            plan.append((length, used[length], used[length] + n * times, n, sequence, offset))
            used[length] += n * times
            offset += n * length
            left[length] -= n * times
            if not left[length]:
                del left[length]
        sequence += times
    return plan


def ranked(df: DataFrame, group: str, order: list[str], buckets: int) -> DataFrame:
    """``rank`` from 0 within each group, without bringing a group into one task.

    Rows are numbered in hash buckets of their group; the buckets before add
    their counts. Rows that agree in all of ``order`` are alike and may swap.
    """
    keyed = df.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = keyed.groupBy(group, "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy(group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(group, "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy(group, "bucket").orderBy(*order)
    numbered = keyed.withColumn("inside", F.row_number().over(inside) - 1)
    return (
        numbered.join(first, [group, "bucket"])
        .withColumn("rank", F.col("first") + F.col("inside"))
        .drop("bucket", "inside", "first")
    )


def pack(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 2048,
    end_id: int = 0,
    encoder: Callable[[str], Callable[[bytes], np.ndarray]] = byte_bpe,
) -> DataFrame:
    """Every piece of every document with its place: sequence_id and offset.

    Only the lengths decide who shares a sequence, so the plan is made from the
    count of each length: at most ``capacity`` numbers, whatever the corpus. It
    has at most about four times as many combinations, and its table is broadcast. Pieces of
    one length are told apart by their rank, which is counted in buckets, so that
    a length that most pieces have is spread over all tasks.

    Each row is packed by itself, also where doc_ids repeat or are null. Other
    columns are not read. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    cut = settled(pieces(docs, vocabulary, capacity, end_id, encoder), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(
        bin_plan(counts, capacity),
        "length long, from_rank long, to_rank long, per_bin long, base long, at long",
    )
    order = ["doc_id", "piece", "start", "ids_crc32"]
    places = ranked(cut, "length", order, partitions(spark))
    inside = F.col("rank") - F.col("from_rank")
    return (
        places.alias("p")
        .join(
            F.broadcast(plan).alias("q"),
            (F.col("p.length") == F.col("q.length"))
            & (F.col("rank") >= F.col("from_rank"))
            & (F.col("rank") < F.col("to_rank")),
        )
        .select(
            "doc_id",
            "piece",
            "start",
            F.col("p.length").alias("length"),
            "ids_crc32",
            (F.col("base") + F.floor(inside / F.col("per_bin"))).alias("sequence_id"),
            (F.col("at") + inside % F.col("per_bin") * F.col("p.length")).alias("offset"),
        )
    )
