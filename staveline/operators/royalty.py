"""Joins and scalars of the royalty report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staveline.functions.numbers import summable

MECHANICAL = "MechanicalRight"

CLAIM_COLUMNS = (
    "RightsController", "PUBLISHERS_SONGCODE", "RightSharePercent", "AllocatedNetRevenue",
    "AllocatedAmount", "AllocatedUsages",
)
SALE_COLUMNS = ("Usages", "NetRevenue", "ValidityPeriodStart", "DATE_SALE")
RECORDING_COLUMNS = ("ResourceISRC", "ResourceTitle", "ResourceDisplayArtistName")


def claims_of(li: DataFrame, claimant: str, rights_type: str | None = MECHANICAL) -> DataFrame:
    """Claims of one rights controller, by default mechanical ones."""
    test = F.col("RightsController") == claimant
    if rights_type:
        test = test & (F.col("RightsType") == rights_type)
    return li.where(test)


def royalty_rows(claims: DataFrame, su: DataFrame, as_: DataFrame) -> DataFrame:
    """Claims joined to their sale and recording, each combination once.

    One claimant has a small part of the file. Sales and recordings are first
    cut down to its transactions and blocks, and copies are taken out before
    the join, where they would multiply. ``claims`` is read three times, so
    store it first.
    """
    # The key with most values comes first: sorting for a join compares that first.
    block = ["BlockId", "Quarter", "service"]
    transaction = ["SalesTransactionId", *block]
    claim = claims.select(
        *block, F.col("ParentSalesTransactionId").alias("SalesTransactionId"), *CLAIM_COLUMNS
    ).distinct()
    sale = (
        su.select(*block, "SalesTransactionId", "DspResourceId", *SALE_COLUMNS)
        .join(claim.select(*transaction).distinct(), transaction, "left_semi")
        .distinct()
    )
    recording = (
        as_.select(*block, "DspResourceId", *RECORDING_COLUMNS)
        .join(claim.select(*block).distinct(), block, "left_semi")
        .distinct()
    )
    return claim.join(sale, transaction).join(recording, [*block, "DspResourceId"])


def usage_denominator(
    claims: DataFrame, by: tuple[str, ...] = ("service",), money_type: str = "double"
) -> DataFrame:
    """All allocated usages of the claims, joined to a sale or not."""
    total = F.sum(summable(F.col("AllocatedUsages"), money_type)).cast("double")
    return claims.groupBy(*by).agg(total.alias("UsagesTotal"))


def pool(
    sy: DataFrame, li: DataFrame, claimant: str, by: tuple[str, ...] = ("service",),
    money_type: str = "double",
) -> DataFrame:
    """Summary revenue minus line amounts of the claimant, for any rights type.

    NULL where one of the two has no rows.
    """
    def total(df: DataFrame, value: str, name: str) -> DataFrame:
        own = claims_of(df, claimant, rights_type=None)
        return own.groupBy(*by).agg(F.sum(summable(F.col(value), money_type)).alias(name))

    both = total(sy, "AllocatedRevenue", "__in").join(
        total(li, "AllocatedAmount", "__out"), list(by), "full"
    )
    return both.select(*by, (F.col("__in") - F.col("__out")).cast("double").alias("Pool"))


def with_scalars(rows: DataFrame, scalars: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Attach the per-service (and per-quarter) scalars to the rows.

    There is one row per service or per service and quarter, so broadcasting
    stays small whatever the size of the report.
    """
    return rows.join(F.broadcast(scalars), list(by), "left")
