"""The royalty report of one rights controller."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staveline.functions.numbers import pool_payment, royalty, usage_share, whole_units
from staveline.functions.text import clean_song_code, country_of_sale, distribution_description
from staveline.operators.royalty import (
    CLAIM_COLUMNS,
    claims_of,
    pool,
    royalty_rows,
    usage_denominator,
    with_scalars,
)
from staveline.session import settled

# Names, order and types of the report columns.
REPORT_FIELDS = """
    BlockId string, ISRC string, SONG_TITLE string, ResourceDisplayArtistName string,
    Quarter string, Usages double, NetRevenue double, ValidityPeriodStart string,
    DATE_SALE string, RightsController string, PUBLISHERS_SONGCODE string,
    RightSharePercent double, AllocatedNetRevenue double, AllocatedAmount double,
    AllocatedUsages double, UsagesShare double, PAYEE string, Distribution_Description string,
    STORE_ID string, COUNTRY_OF_SALE string, CURRENCY string, GEPaymentsShare double,
    ROYALTIES_TO_BE_PAID double, TOTAL_UNITS long
"""
REPORT_COLUMNS = [field.split()[0] for field in REPORT_FIELDS.split(",")]


@dataclass(frozen=True)
class ReportTerms:
    """Who the report is for, its constant columns and its options."""

    claimant: str
    payee: str
    store_id: str
    currency: str
    by_quarter: bool = False  # scalars per quarter, not over all quarters present
    strict: bool = False  # fail on a zero denominator or an id without country
    strict_prefix: bool = False  # strip the song code prefix only at the start
    money_type: str = "double"

    @property
    def scope(self) -> tuple[str, ...]:
        return ("service", "Quarter") if self.by_quarter else ("service",)


def own_claims(li: DataFrame, terms: ReportTerms) -> DataFrame:
    """All claims of the claimant, stored.

    The claim table is then scanned once for the whole report, and what is left
    of it has a known size: small enough, it is broadcast and the other tables
    need no shuffle.
    """
    own = claims_of(li, terms.claimant, rights_type=None).select(
        "service", "Quarter", "BlockId", "ParentSalesTransactionId", "RightsType", *CLAIM_COLUMNS
    )
    return settled(own, "claims")


def distinct_rows(li: DataFrame, su: DataFrame, as_: DataFrame, terms: ReportTerms) -> DataFrame:
    """Report rows before any amount is worked out."""
    joined = royalty_rows(claims_of(li, terms.claimant), su, as_)
    country = country_of_sale(F.col("SalesTransactionId"), terms.strict)
    return (
        joined.withColumn("COUNTRY_OF_SALE", country)
        .drop("SalesTransactionId", "DspResourceId")
        .distinct()
    )


def with_usage_share(
    rows: DataFrame, li: DataFrame, terms: ReportTerms, total: DataFrame | None = None
) -> DataFrame:
    if total is None:
        total = usage_denominator(claims_of(li, terms.claimant), terms.scope, terms.money_type)
    share = usage_share(F.col("AllocatedUsages"), F.col("UsagesTotal"), terms.strict)
    return with_scalars(rows, total, terms.scope).withColumn("UsagesShare", share).drop(
        "UsagesTotal"
    )


def royalty_report(
    sy: DataFrame | None, li: DataFrame, su: DataFrame, as_: DataFrame, terms: ReportTerms,
    scalars: DataFrame | None = None,
) -> DataFrame:
    """The 24 report columns, and the service each row belongs to.

    The share denominator and the pool cover the records given, or are taken from
    ``scalars`` (UsagesTotal and Pool in the scope of the terms), which may cover more;
    ``sy`` is not read then.
    """
    own = own_claims(li, terms)
    if scalars is None:
        total, rest = None, pool(sy, own, terms.claimant, terms.scope, terms.money_type)
    else:
        total, rest = scalars.drop("Pool"), scalars.drop("UsagesTotal")
    rows = with_usage_share(distinct_rows(own, su, as_, terms), own, terms, total)
    amounts = with_scalars(rows, rest, terms.scope)
    share, general = F.col("UsagesShare"), F.col("Pool")
    values = {
        "ISRC": F.col("ResourceISRC"),
        "SONG_TITLE": F.col("ResourceTitle"),
        "PUBLISHERS_SONGCODE": clean_song_code(
            F.col("PUBLISHERS_SONGCODE"), terms.strict_prefix
        ),
        "PAYEE": F.lit(terms.payee),
        "Distribution_Description": distribution_description(
            F.col("service"), F.col("Quarter"), terms.payee
        ),
        "STORE_ID": F.lit(terms.store_id),
        "CURRENCY": F.lit(terms.currency),
        "GEPaymentsShare": pool_payment(general, share),
        "ROYALTIES_TO_BE_PAID": royalty(general, share, F.col("AllocatedAmount")),
        "TOTAL_UNITS": whole_units(F.col("AllocatedUsages")),
    }
    return amounts.select(
        "service", *[values.get(n, F.col(n)).alias(n) for n in REPORT_COLUMNS]
    )
