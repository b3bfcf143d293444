"""Sharding by vector bin packing: bytes, tokens and rows together."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staveline.llm.common import partitions, text_or_empty, unpacked, with_row
from staveline.session import settled

BUNDLES = 16384
EXTRA_BYTES = 16


def place(loads: np.ndarray, shards: int) -> np.ndarray:
    """A shard for each unit (bytes, tokens, rows), greatest units first.

    A unit goes where the dot product of its vector with the residual capacity is
    highest, both measured in capacities; ties go to the smaller shard.
    """
    total = np.maximum(loads.sum(axis=0), 1) / shards
    sizes = loads / total
    residual = np.ones((shards, loads.shape[1]))
    placed = np.zeros(len(loads), dtype=np.int32)
    for i in np.argsort(-sizes.max(axis=1), kind="stable"):
        placed[i] = best = int(np.argmax(residual @ sizes[i]))
        residual[best] -= sizes[i]
    return placed


def shard(docs: DataFrame, shards: int = 40, bundles: int = BUNDLES) -> DataFrame:
    """Rows with equal texts together, shards near equal in bytes, tokens and rows.

    A group of equal texts that is a sixteenth of a shard or more is a unit of its
    own; so there are at most 16 * shards of them. All other groups fall into a
    fixed number of bundles by hash. Units are placed greedily on the driver:
    their number is bounded by the parameters, whatever the corpus. A group stays whole
    as long as its bytes fit a shard of mean size. A larger one is cut into parts of
    about a quarter of a shard by hash of its rows, as no shard could hold it and stay
    equal. A
    single text is never cut; one that is larger than a shard makes its shard larger.

    Returns the input columns without ``text``, and size (UTF-8 bytes of the text
    plus 16; null: 16), tokens (words between ASCII white space), text_crc32,
    shard, slot (gapless from 0 in each shard); input columns of these names are
    replaced. Null text is empty. Null or repeated doc_ids and repeated rows are
    rows like others. An empty table gives an empty table.

    Text is read once and not shuffled. Groups and units are summed before the
    shuffle; slots are counted in buckets, so no shard is one task.
    """
    spark = docs.sparkSession
    text = text_or_empty()
    others = [c for c in docs.columns if c != "text"]
    measured = with_row(
        docs,
        F.col("doc_id").alias("doc"),
        (F.octet_length(text) + EXTRA_BYTES).cast("long").alias("size"),
        F.size(F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).cast("long").alias("tokens"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("g1"),
        F.xxhash64(F.lit("second"), text).alias("g2"),
    ).withColumn("__row", F.struct(*[F.col(f"__row.`{c}`").alias(c) for c in others]))
    rows = settled(measured, "shard-rows")
    share = (rows.agg(F.sum("size")).first()[0] or 0) / shards
    groups = rows.groupBy("g1", "g2").agg(F.sum("size").alias("bytes"))
    heavy = settled(
        groups.filter(F.col("bytes") >= share / 16).select(
            "g1",
            "g2",
            F.when(F.col("bytes") > share, F.ceil(F.col("bytes") * 4 / share))
            .otherwise(1)
            .cast("int")
            .alias("parts"),
        ),
        "shard-heavy",
    )
    # At most 16 * shards rows, by the sum of the sizes.
    joined = rows.join(F.broadcast(heavy), ["g1", "g2"], "left")
    part = F.pmod(F.xxhash64("doc", "size"), F.col("parts")).cast("int")
    bundle = F.pmod(F.xxhash64("g1", "g2"), F.lit(bundles))
    own = F.col("parts").isNotNull()
    united = joined.select(
        *[c for c in rows.columns if c not in ("g1", "g2")],
        F.when(own, F.col("g1")).otherwise(bundle).alias("u1"),
        F.when(own, F.col("g2")).otherwise(F.lit(0)).alias("u2"),
        F.when(own, part).otherwise(F.lit(-1)).alias("u3"),
    )
    unit = ["u1", "u2", "u3"]
    sums = united.groupBy(*unit).agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("r"))
    units = sums.orderBy(*unit).collect()
    placed = place(np.array([[u["b"], u["t"], u["r"]] for u in units], dtype=float).reshape(-1, 3), shards)
    where = spark.createDataFrame(
        [(u["u1"], u["u2"], u["u3"], int(s)) for u, s in zip(units, placed)],
        "u1 long, u2 long, u3 int, shard int",
    )
    dealt = settled(united.join(F.broadcast(where), unit).drop(*unit), "shard-dealt")
    bucket = F.pmod(F.xxhash64("doc", "text_crc32", "size"), F.lit(partitions(spark)))
    keyed = dealt.withColumn("bucket", bucket)
    counts = keyed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc", "text_crc32", "size")
    slotted = (
        keyed.withColumn("inside", F.row_number().over(inside) - 1)
        .join(first, ["shard", "bucket"])
        .withColumn("slot", F.col("first") + F.col("inside"))
    )
    return unpacked(slotted, others, "size", "tokens", "text_crc32", "shard", "slot")
