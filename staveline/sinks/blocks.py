"""Record tables laid out by block, so that what joins on a block needs no shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staveline.session import scratch_folder

BLOCK = "BlockId"
SORTED = (BLOCK, "service", "Quarter")
# Rows of one block that one task may hold; beyond it tables are not bucketed.
LARGEST_BLOCK = 2_000_000
# Joins on a block and more find both sides bucketed by the block alone.
SUBSET_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def join_by_block(spark: SparkSession) -> None:
    """Have joins on a block and more take rows dealt by the block alone as they lie."""
    spark.conf.set(SUBSET_KEYS, "false")


def largest_block(tables: Mapping[str, DataFrame]) -> int:
    """Rows of the block that has most, over all tables; counted before it is shuffled."""
    counts = [df.groupBy(BLOCK).agg(F.count("*").alias("rows")) for df in tables.values()]
    total = reduce(DataFrame.unionByName, counts).groupBy(BLOCK).agg(F.sum("rows").alias("rows"))
    return total.agg(F.max("rows")).first()[0] or 0


def store_by_block(
    tables: Mapping[str, DataFrame], label: str, buckets: int | None = None,
    largest: int = LARGEST_BLOCK,
) -> dict[str, DataFrame]:
    """The tables stored in buckets of their block, sorted by block and file.

    Claims, sales and recordings of a block then lie in buckets of the same number:
    the block join, the sums per claim and the songs of artists read them in place.
    As many buckets as the session has shuffle partitions, unless given; tables that
    are joined need the same number.

    A bucket is not split at run time. So the largest block is counted, in place, and
    where it has more than ``largest`` rows the files are read as plain ones: the same
    operators then shuffle them, and split what is skewed.
    """
    spark = next(iter(tables.values())).sparkSession
    number = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = scratch_folder(spark, label)
    stored = {}
    for name, df in tables.items():
        table = f"{label}_{name}_{uuid.uuid4().hex}".replace("-", "_")
        # Rows of a bucket come together, so that a bucket is one sorted file.
        together = df.repartition(number, F.col(BLOCK))
        writer = together.write.bucketBy(number, BLOCK).sortBy(*SORTED)
        writer.option("path", f"{folder}/{name}").saveAsTable(table)
        stored[name] = spark.table(table)
        stored[name].buckets = number
    if largest_block(stored) > largest:
        return {name: spark.read.schema(df.schema).parquet(f"{folder}/{name}") for name, df in tables.items()}
    join_by_block(spark)
    return stored


def buckets_of(df: DataFrame) -> int | None:
    """The number of buckets ``store_by_block`` has put the table in; none for other frames."""
    return df.__dict__.get("buckets")
