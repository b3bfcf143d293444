"""One key with a third of all rows, or more: no task may get all of them."""

import pytest
from pyspark.sql import functions as F

from staveline.operators import match, series
from staveline.operators.usage import artist_usage, block_usage, sold_claims
from tests.test_royalty import LI, SU

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20kb",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def small_partitions(spark):
    """Sizes at which the test tables are split as large ones would be."""
    before = {k: spark.conf.get(k) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_isrc_is_split(small_partitions):
    spark = small_partitions
    n = 60_000
    isrc = F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("I"), F.col("id").cast("string")))
    tracks = spark.range(n).repartition(8).select(F.col("id").alias("name"), isrc.alias("isrc"))
    perf = spark.createDataFrame([("W", "HOT"), ("V", "I1")], "comp_id string, isrc string")
    found = match.catalogue_match(tracks, perf)
    assert "skew=true" in final_plan(found)
    assert found.where("Match = 'MATCH'").count() == n // 3 + 1


def test_hot_transaction_is_split_before_it_is_summed(small_partitions):
    spark = small_partitions
    n = 60_000
    txn = F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("T"), F.col("id").cast("string")))
    li = spark.range(n).repartition(8).select(
        F.lit("ads").alias("service"), F.lit("q").alias("Quarter"), F.lit("B").alias("BlockId"),
        txn.alias("ParentSalesTransactionId"), F.lit("Residual").alias("RightsController"),
        F.lit("c").alias("PUBLISHERS_SONGCODE"), (F.col("id") % 5).cast("double").alias("RightSharePercent"),
        F.lit("MechanicalRight").alias("RightsType"), F.lit(1.0).alias("AllocatedNetRevenue"),
        F.lit(1.0).alias("AllocatedAmount"), F.rand(1).alias("AllocatedUsages"),
    )
    su = spark.createDataFrame([("ads", "q", "B", "HOT", "R", 2.0, 3.0, "v", "d")], SU)
    assert set(li.columns) == {f.split()[0] for f in LI.split(", ")}
    found = sold_claims(su.unionByName(su), li)
    assert "skew=true" in final_plan(found)
    assert found.agg(F.sum("AAmount"), F.sum("Usages")).first() == (2 * n / 3, 4.0 * n / 3)


def test_one_large_block_is_ranked_without_its_pairs(spark):
    """20,000 recordings and 20,000 claims of one block: 400 million merged rows."""
    n = 20_000
    number = F.col("id").cast("string")
    as_ = spark.range(n).select(
        F.lit("ads").alias("service"), F.lit("q").alias("Quarter"), F.lit("B").alias("BlockId"),
        F.concat(F.lit("I"), number).alias("ResourceISRC"), F.lit("t").alias("ResourceTitle"),
        F.when(F.col("id") % 2 == 0, "Ada").otherwise("Ada & Bob").alias("ResourceDisplayArtistName"),
        F.lit("k").alias("ResourceType"), F.lit(None).cast("string").alias("ResourceSubTitle"),
    )
    txn = F.concat(F.lit("T"), number)
    su = spark.range(n).select(
        F.lit("ads").alias("service"), F.lit("q").alias("Quarter"), F.lit("B").alias("BlockId"),
        txn.alias("SalesTransactionId"), F.lit(2.0).alias("Usages"), F.lit(1.0).alias("NetRevenue"),
    )
    li = spark.range(n).select(
        F.lit("ads").alias("service"), F.lit("q").alias("Quarter"), F.lit("B").alias("BlockId"),
        txn.alias("ParentSalesTransactionId"), F.lit("Residual").alias("RightsController"),
        F.lit(40.0).alias("RightSharePercent"), F.lit("MechanicalRight").alias("RightsType"),
        F.lit(1.0).alias("AllocatedUsages"), F.lit(1.0).alias("AllocatedAmount"),
        F.lit(1.0).alias("AllocatedNetRevenue"),
    )
    found = {r.Artist: r for r in artist_usage(as_, block_usage(su, li)).collect()}
    assert found["ada"].ResidualObservations == n * n
    assert found["bob"].ResidualObservations == n * n // 2
    assert found["bob"].TotalUsages == 2.0 * n * n / 2
    assert found["ada"].AvgResidualRightsSharePctg == 40.0


def test_one_block_in_many_files_takes_bytes_in_proportion(spark):
    """All claims of a block in every file: rows do not grow with the number of files."""
    sizes = {}
    for files in (200, 800):
        quarter = F.concat(F.lit("q"), (F.col("id") % files).cast("string")).alias("Quarter")
        row = spark.range(2 * files).repartition(4)
        txn = F.concat(F.lit("T"), (F.col("id") / files).cast("int").cast("string"))
        su = row.select(
            F.lit("ads").alias("service"), quarter, F.lit("B").alias("BlockId"), txn.alias("SalesTransactionId"),
            F.lit(2.0).alias("Usages"), F.lit(1.0).alias("NetRevenue"),
        )
        li = row.select(
            F.lit("ads").alias("service"), quarter, F.lit("B").alias("BlockId"),
            txn.alias("ParentSalesTransactionId"), F.lit("Residual").alias("RightsController"),
            F.lit(40.0).alias("RightSharePercent"), F.lit("MechanicalRight").alias("RightsType"),
            F.lit(1.0).alias("AllocatedUsages"), F.lit(1.0).alias("AllocatedAmount"),
            F.lit(1.0).alias("AllocatedNetRevenue"),
        )
        as_ = row.where(F.col("id") < files).select(
            F.lit("ads").alias("service"), quarter, F.lit("B").alias("BlockId"), F.lit("I").alias("ResourceISRC"),
            F.lit("t").alias("ResourceTitle"), F.lit("Ada & Bob").alias("ResourceDisplayArtistName"),
            F.lit("k").alias("ResourceType"), F.lit(None).cast("string").alias("ResourceSubTitle"),
        )
        blocks = block_usage(su, li)
        found = artist_usage(as_, blocks).where("Artist = 'ada'").first()
        assert (found.ResidualObservations, found.AvgResidualRightsSharePctg) == (2, 40.0)
        assert found.TotalUsages == 4.0 * files
        sizes[files] = sum(len(str(r)) for r in blocks.collect())
    assert sizes[800] < 4.2 * sizes[200]


@pytest.mark.parametrize("n, slices", [(40_000, 200), (100_000, 5_000)])
def test_long_series_is_cut(spark, n, slices):
    key = F.when(F.col("id") % 3 > 0, "HOT").otherwise(F.col("id").cast("string"))
    points = spark.range(n).select(key.alias("k"), F.col("id").alias("t"), F.rand(3).alias("v"))
    dealt = series.cut(points, ["k"], "t", slices=slices)
    largest = dealt.groupBy("k", "__slice").count().agg(F.max("count")).first()[0]
    assert largest <= 2 * n / slices
    # No expression of the plan grows with the ranges.
    assert len(dealt._jdf.queryExecution().analyzed().toString()) < 2_000


@pytest.mark.parametrize("slices", [2, 200])
def test_carried_values_of_a_long_series(spark, slices):
    key = F.when(F.col("id") % 3 > 0, "HOT").otherwise((F.col("id") % 9).cast("string"))
    value = F.when(F.col("id") % 7 > 0, F.col("id") * F.col("id"))
    points = spark.range(3_000).select(key.alias("k"), (F.col("id") / 2).cast("long").alias("t"), "id", value.alias("v"))
    found = series.series_diff(points, ["k"], "t", "v", ["id"], slices=slices)
    last, want = {}, {}
    for r in points.where("v IS NOT NULL").orderBy("id").collect():
        want[r.id] = r.v - last[r.k] if r.k in last else None
        last[r.k] = r.v
    assert {r.id: r.difference for r in found.collect()} == want
