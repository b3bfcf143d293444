"""Report records made from the driver tables, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import table
from staveline.session import settled
from staveline.sinks.blocks import join_by_block, store_by_block

CLAIMANT = "PubA"
# Money with four decimals sums to the same digits in any order.
EXACT = "decimal(28,4)"
# Stored bytes of the line items that one task makes records of.
BYTES_OF_A_PART = 2 << 20


@dataclass(frozen=True)
class Records:
    sy: DataFrame
    li: DataFrame
    su: DataFrame
    as_: DataFrame


def service_col(order_key: Column) -> Column:
    names = F.array(*[F.lit(s) for s in ("ads", "hardware", "subs_music", "subs_premium")])
    return F.get(names, (order_key % 4).cast("int"))


def quarter_col(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("_Q"), F.quarter(day).cast("string"))


def _money(name: str) -> Column:
    return F.col(name).cast("decimal(18,2)")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        service_col(F.col("o_orderkey")).alias("service"),
        quarter_col(F.col("o_orderdate")).alias("Quarter"),
    )


def _parts(spark: SparkSession, sf_dir: str) -> int | None:
    """Parts the line items are dealt into; none where Spark's own number will do."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/lineitem.parquet")
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = system.getContentSummary(place).getLength() // BYTES_OF_A_PART
    return parts if parts > spark.sparkContext.defaultParallelism else None


def _dealt(rows: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of line items by block, into more parts the larger the table is.

    Left to itself Spark brings parts together by their compressed bytes. Line items are
    short and their records long, so a task would get millions of them.
    """
    parts = _parts(rows.sparkSession, sf_dir)
    return rows if parts is None else rows.repartition(parts, F.col("BlockId"))


def _block(order_key: str) -> Column:
    return F.col(order_key).cast("string").alias("BlockId")


def _ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that have a customer and a nation, by block.

    The texts of an order are made behind the join with its customer, so they are not
    sent about twice.
    """
    places = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(F.col("c_custkey").alias("o_custkey"), "n_name")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return orders.join(places, "o_custkey").select(
        _block("o_orderkey"),
        service_col(F.col("o_orderkey")).alias("service"),
        quarter_col(F.col("o_orderdate")).alias("Quarter"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        "n_name",
    )


def _sold(spark: SparkSession, sf_dir: str, together: Sequence[str] = ()) -> DataFrame:
    """Line items with service, quarter and transaction id, dealt by block.

    Those that are to be written in folders come ``together`` by these columns instead,
    before the texts of a record are made, which are longer than what they are made of.

    They meet their orders by the block alone. So claims, sales and recordings lie by
    block, as record tables do that are stored by block, and what joins or sums them by
    the block and more needs no further shuffle.
    """
    join_by_block(spark)
    # Both sides grow with the data, so neither is to be broadcast.
    orders = _ordered(spark, sf_dir).hint("merge")
    sale = F.concat(
        F.lit("T"), "BlockId", F.lit("-"),
        F.col("l_partkey").cast("string"),
        F.when(F.col("l_partkey") % 50 == 0, "").otherwise(F.concat(F.lit(":"), "n_name")),
    )
    lines = table(spark, sf_dir, "lineitem").select(_block("l_orderkey"), "*")
    sold = _dealt(lines, sf_dir).join(orders, "BlockId")
    if together:
        sold = sold.hint("rebalance", *[F.col(c) for c in together])
    return sold.withColumn("SalesTransactionId", sale)


def recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part once in a block and quarter, dealt by block as line items are."""
    join_by_block(spark)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    brand, kind = F.col("p_brand"), F.col("p_type")
    number = F.col("l_partkey") % 7
    artist = (
        F.when(number == 0, F.lit(None).cast("string"))
        .when(number == 1, F.lit("-"))
        .when(number == 2, F.concat(brand, F.lit(" feat. "), kind))
        .when(number == 3, F.concat(brand, F.lit(", "), "p_name"))
        .otherwise(F.concat(brand, F.lit(" & "), kind))
    )
    # Copies go before the joins, where they would multiply.
    lines = table(spark, sf_dir, "lineitem").select(_block("l_orderkey"), "l_partkey")
    lines = lines.repartition(F.col("l_partkey")).distinct().hint("merge")
    orders = _ordered(spark, sf_dir).select("BlockId", "service", "Quarter")
    # Dealt as the line items are, or these would follow the number of the orders.
    orders = _dealt(orders.repartition(F.col("BlockId")), sf_dir).distinct().hint("merge")
    lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")
    sold = _dealt(lines, sf_dir).join(orders, "BlockId")
    key = F.col("l_partkey").cast("string")
    none = F.lit(None).cast("string")
    return sold.select(
        "service", "Quarter", "BlockId",
        F.lit("R1").alias("ResourceReference"),
        F.concat(F.lit("R"), key).alias("DspResourceId"),
        F.concat(F.lit("ISRC"), key).alias("ResourceISRC"),
        F.col("p_name").alias("ResourceTitle"),
        none.alias("ResourceSubTitle"),
        artist.alias("ResourceDisplayArtistName"),
        none.alias("ResourceDisplayArtistPartyId"),
        none.alias("ResourceDuration"),
        kind.alias("ResourceType"),
        none.alias("IsMasterRecording"),
        none.alias("IsSubjectToOwnershipConflict"),
        none.alias("LastConflictCheck"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sold(spark, sf_dir).groupBy(
        "service", "Quarter", "BlockId", "SalesTransactionId", "l_partkey", "day"
    ).agg(
        F.sum(_money("l_quantity")).cast("double").alias("Usages"),
        F.sum(_money("l_extendedprice")).cast("double").alias("NetRevenue"),
    )
    return rows.select(
        "service", "Quarter", "BlockId", "SalesTransactionId",
        F.lit("S1").alias("SummaryRecordId"),
        F.concat(F.lit("R"), F.col("l_partkey").cast("string")).alias("DspResourceId"),
        "Usages", "NetRevenue",
        F.col("day").alias("ValidityPeriodStart"),
        F.col("day").alias("DATE_SALE"),
        F.lit("Music").alias("ContentCategory"),
        F.lit("true").alias("IsRoyaltyBearing"),
    )


def claims(spark: SparkSession, sf_dir: str, together: Sequence[str] = ()) -> DataFrame:
    rest = 1 - F.col("l_discount").cast("decimal(4,2)")
    controllers = F.array(F.lit("Residual"), F.lit("PubA"), F.lit("PubB"))
    return _sold(spark, sf_dir, together).select(
        "service", "Quarter", "BlockId",
        F.lit("S1").alias("SummaryRecordId"),
        F.get(controllers, (F.col("l_suppkey") % 3).cast("int")).alias("RightsController"),
        F.lit(None).cast("string").alias("RightsControllerPartyId"),
        F.concat(F.lit("C_"), F.col("l_partkey").cast("string")).alias("PUBLISHERS_SONGCODE"),
        (F.col("l_discount").cast("decimal(4,2)") * 100).cast("double").alias("RightSharePercent"),
        F.when(F.col("l_returnflag") == "N", "PerformingRight").otherwise("MechanicalRight")
        .alias("RightsType"),
        (_money("l_extendedprice") * rest).cast("double").alias("AllocatedNetRevenue"),
        (_money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)")).cast("double")
        .alias("AllocatedAmount"),
        (_money("l_quantity") * rest).cast("double").alias("AllocatedUsages"),
        F.col("SalesTransactionId").alias("ParentSalesTransactionId"),
        F.lit(None).cast("string").alias("LicensorDataRecordId"),
    )


def summary_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    controllers = F.array(F.lit("PubA"), F.lit("PubB"), F.lit("Residual"))
    # A third of the order total, cut after four decimals.
    units = (_money("o_totalprice") * 10000).cast("long")
    third = ((units - F.pmod(units, F.lit(3))) / 3).cast("long")
    return _orders(spark, sf_dir).select(
        "service", "Quarter",
        F.col("o_orderkey").cast("string").alias("SummaryRecordId"),
        F.explode(controllers).alias("RightsController"),
        (third / F.lit(10000.0)).alias("AllocatedRevenue"),
    )


KEPT: dict[str, Records] = {}


def report_records(spark: SparkSession, sf_dir: str) -> Records:
    if sf_dir in KEPT:
        return KEPT[sf_dir]
    return Records(
        sy=summary_rows(spark, sf_dir), li=claims(spark, sf_dir), su=sales(spark, sf_dir),
        as_=recordings(spark, sf_dir),
    )


def block_records(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Claims, sales and recordings stored by block, for queries that read them often."""
    r = KEPT.get(sf_dir)
    if r is not None:
        return {"as_": r.as_, "su": r.su, "li": r.li}
    r = report_records(spark, sf_dir)
    # One bucket for each part, so that the records are not dealt a second time.
    return store_by_block({"as_": r.as_, "su": r.su, "li": r.li}, "records", _parts(spark, sf_dir))


def stored_records(spark: SparkSession, sf_dir: str) -> Records:
    """The records, stored as record tables are."""
    summaries = settled(report_records(spark, sf_dir).sy, "records")
    return Records(sy=summaries, **block_records(spark, sf_dir))


def keep_records(spark: SparkSession, sf_dir: str) -> None:
    """From now on the stored records are the input, so that making them is not timed."""
    KEPT[sf_dir] = stored_records(spark, sf_dir)


# The same records as common table expressions.
RECORDS_SQL = """
sold AS (
    SELECT l.*, CAST(l_orderkey AS VARCHAR) AS "BlockId",
        CASE l_orderkey % 4 WHEN 0 THEN 'ads' WHEN 1 THEN 'hardware'
            WHEN 2 THEN 'subs_music' ELSE 'subs_premium' END AS service,
        CAST(year(o_orderdate) AS VARCHAR) || '_Q' || CAST(quarter(o_orderdate) AS VARCHAR)
            AS "Quarter",
        strftime(o_orderdate, '%Y-%m-%d') AS day,
        'T' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
            || CASE WHEN l_partkey % 50 = 0 THEN '' ELSE ':' || n_name END
            AS "SalesTransactionId"
    FROM lineitem l JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
su AS (
    SELECT service, "Quarter", "BlockId", "SalesTransactionId",
        'R' || CAST(l_partkey AS VARCHAR) AS "DspResourceId",
        day AS "ValidityPeriodStart", day AS "DATE_SALE",
        CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS "Usages",
        CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS "NetRevenue"
    FROM sold GROUP BY ALL
),
as_ AS (
    SELECT DISTINCT service, "Quarter", "BlockId", 'R' || CAST(l_partkey AS VARCHAR) AS "DspResourceId",
        'ISRC' || CAST(l_partkey AS VARCHAR) AS "ResourceISRC", p_name AS "ResourceTitle",
        CAST(NULL AS VARCHAR) AS "ResourceSubTitle", p_type AS "ResourceType",
        CASE l_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '-'
            WHEN 2 THEN p_brand || ' feat. ' || p_type WHEN 3 THEN p_brand || ', ' || p_name
            ELSE p_brand || ' & ' || p_type END AS "ResourceDisplayArtistName"
    FROM sold JOIN part ON l_partkey = p_partkey
),
li AS (
    SELECT service, "Quarter", "BlockId", "SalesTransactionId" AS "ParentSalesTransactionId",
        CASE l_suppkey % 3 WHEN 0 THEN 'Residual' WHEN 1 THEN 'PubA' ELSE 'PubB' END
            AS "RightsController",
        'C_' || CAST(l_partkey AS VARCHAR) AS "PUBLISHERS_SONGCODE",
        CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS DOUBLE) AS "RightSharePercent",
        CASE WHEN l_returnflag = 'N' THEN 'PerformingRight' ELSE 'MechanicalRight' END
            AS "RightsType",
        CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
            AS DOUBLE) AS "AllocatedNetRevenue",
        CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))
            AS DOUBLE) AS "AllocatedAmount",
        CAST(CAST(l_quantity AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
            AS DOUBLE) AS "AllocatedUsages"
    FROM sold
),
sy AS (
    SELECT service, "Quarter", controller AS "RightsController",
        ((cents * 100) // 3) / 10000.0::DOUBLE AS "AllocatedRevenue"
    FROM (
        SELECT CASE o_orderkey % 4 WHEN 0 THEN 'ads' WHEN 1 THEN 'hardware'
                WHEN 2 THEN 'subs_music' ELSE 'subs_premium' END AS service,
            CAST(year(o_orderdate) AS VARCHAR) || '_Q' || CAST(quarter(o_orderdate) AS VARCHAR)
                AS "Quarter",
            CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents
        FROM orders
    ) CROSS JOIN (VALUES ('PubA'), ('PubB'), ('Residual')) AS c(controller)
)
"""

MERGED_SQL = """
merged AS MATERIALIZED (
    SELECT "ResourceType", "ResourceDisplayArtistName", a."BlockId", "ResourceISRC",
        "ResourceTitle", "ResourceSubTitle", "SalesTransactionId", "RightsController",
        "RightSharePercent",
        CAST(sum(CAST("AllocatedUsages" AS DECIMAL(28,4))) AS DOUBLE) AS "AUsages",
        CAST(sum(CAST("AllocatedAmount" AS DECIMAL(28,4))) AS DOUBLE) AS "AAmount",
        CAST(sum(CAST("AllocatedNetRevenue" AS DECIMAL(28,4))) AS DOUBLE) AS "ANetRevenue",
        CAST(sum(CAST("Usages" AS DECIMAL(28,4))) AS DOUBLE) AS "Usages",
        CAST(sum(CAST("NetRevenue" AS DECIMAL(28,4))) AS DOUBLE) AS "NetRevenue"
    FROM {recordings} a
    JOIN su s ON a.service = s.service AND a."BlockId" = s."BlockId" AND a."Quarter" = s."Quarter"
    JOIN li l ON a.service = l.service AND a."BlockId" = l."BlockId" AND a."Quarter" = l."Quarter"
        AND l."ParentSalesTransactionId" = s."SalesTransactionId"
    WHERE "RightsType" = 'MechanicalRight'
    GROUP BY ALL
),
split AS MATERIALIZED (
    SELECT *, trim(value) AS "Artist" FROM (
        SELECT *, unnest(regexp_split_to_array(lower("ResourceDisplayArtistName"),
            '[,;/|&+]|\\s(?:feat\\.|ft\\.|featuring|vs\\.)\\s')) AS value
        FROM merged WHERE "ResourceDisplayArtistName" IS NOT NULL
    ) WHERE value <> '-'
),
totals AS MATERIALIZED (
    SELECT "Artist", {totals} FROM split GROUP BY "Artist"
),
residual AS MATERIALIZED (
    SELECT "Artist",
        CAST(sum(CAST("RightSharePercent" AS DECIMAL(28,4))) AS DOUBLE) / count("RightSharePercent")
            AS "AvgResidualRightsSharePctg",
        {residual_totals},
        count("Usages") AS "ResidualObservations"
    FROM split WHERE "RightsController" = 'Residual' GROUP BY "Artist"
),
ranked AS (
    SELECT t."Artist", r.* EXCLUDE ("Artist"),
        "ResidualTotalUsages" / NULLIF("TotalUsages", 0) AS "ResidualUsagesPctg",
        ("ResidualObservations" / (SELECT max("ResidualObservations") FROM residual)) * 0.65::DOUBLE
        + ("ResidualTotalUsages" / (SELECT max("ResidualTotalUsages") FROM residual)) * 0.35::DOUBLE
            AS "ArtistIndex"
    FROM totals t JOIN residual r ON t."Artist" = r."Artist"
)
"""


def merged_sql(recordings: str = "as_") -> str:
    names = ["Usages", "AUsages", "ANetRevenue", "AAmount", "NetRevenue"]

    def sums(prefix: str) -> str:
        return ", ".join(
            f'CAST(sum(CAST("{n}" AS DECIMAL(28,4))) AS DOUBLE) AS "{prefix}{n}"' for n in names
        )

    return MERGED_SQL.format(
        recordings=recordings, totals=sums("Total"), residual_totals=sums("ResidualTotal")
    )


def with_records(select: str, *more: str) -> str:
    return "WITH " + ",".join([RECORDS_SQL, *more]) + select
