"""One quarter worked out by hand, and the properties of the report."""

import pytest
from pyspark.sql import functions as F

from staveline.operators.royalty import pool
from staveline.plans.report import REPORT_COLUMNS, REPORT_FIELDS, ReportTerms, royalty_report
from staveline.sinks.tables import check_schema
from tests.helpers import rows

LI = (
    "service string, Quarter string, BlockId string, ParentSalesTransactionId string, "
    "RightsController string, PUBLISHERS_SONGCODE string, RightSharePercent double, "
    "RightsType string, AllocatedNetRevenue double, AllocatedAmount double, AllocatedUsages double"
)
SU = (
    "service string, Quarter string, BlockId string, SalesTransactionId string, "
    "DspResourceId string, Usages double, NetRevenue double, ValidityPeriodStart string, "
    "DATE_SALE string"
)
AS = (
    "service string, Quarter string, BlockId string, DspResourceId string, ResourceISRC string, "
    "ResourceTitle string, ResourceDisplayArtistName string, ResourceType string, "
    "ResourceSubTitle string"
)
SY = "service string, Quarter string, RightsController string, AllocatedRevenue double"
Q = "2024_Q1"
M = "MechanicalRight"

SHOP = ("YOUTUBE", "youtube_comp", "USD")


@pytest.fixture(scope="module")
def quarter(spark):
    li = spark.createDataFrame([
        ("ads", Q, "B1", "T1:BR", "Us", "C_1", 50.0, M, 10.0, 6.0, 3.0),
        ("ads", Q, "B2", "T2:CO", "Us", "X_2", 25.0, M, 8.0, 2.0, 1.0),
        ("ads", Q, "B2", "T2:CO", "Us", "X_2", 25.0, "PerformingRight", 8.0, 2.0, 1.0),
        ("ads", Q, "B2", "T2:CO", "Them", "X_2", 75.0, M, 8.0, 5.0, 9.0),
    ], LI)
    su = spark.createDataFrame([
        ("ads", Q, "B1", "T1:BR", "R1", 100.0, 20.0, "v", "d"),
        ("ads", Q, "B2", "T2:CO", "R2", 50.0, 10.0, "v", "d"),
    ], SU)
    as_ = spark.createDataFrame([
        ("ads", Q, "B1", "R1", "I1", "One", "A", "t", None),
        ("ads", Q, "B2", "R2", "I2", "Two", "B", "t", None),
        ("ads", Q, "B2", "R3", "I3", "Three", "C", "t", None),
    ], AS)
    sy = spark.createDataFrame([
        ("ads", Q, "Us", 20.0), ("ads", Q, "Us", 10.0), ("ads", Q, "Them", 99.0),
    ], SY)
    return sy, li, su, as_


def report(quarter, **terms):
    return royalty_report(*quarter, ReportTerms("Us", *SHOP, **terms))


def test_golden_report(quarter):
    # Denominator 3 + 1 = 4; pool 30 - (6 + 2 + 2) = 20.
    found = {r.BlockId: r.asDict() for r in report(quarter).collect()}
    assert set(found) == {"B1", "B2"}
    one, two = found["B1"], found["B2"]
    assert (one["UsagesShare"], one["GEPaymentsShare"], one["ROYALTIES_TO_BE_PAID"]) == (0.75, 15.0, 21.0)
    assert (two["UsagesShare"], two["GEPaymentsShare"], two["ROYALTIES_TO_BE_PAID"]) == (0.25, 5.0, 7.0)
    assert one["PUBLISHERS_SONGCODE"] == "1" and two["PUBLISHERS_SONGCODE"] == "X_2"
    assert (one["ISRC"], one["SONG_TITLE"], one["COUNTRY_OF_SALE"]) == ("I1", "One", "BR")
    assert one["Distribution_Description"] == "YOUTUBE ADS 2024_Q1"
    assert (one["TOTAL_UNITS"], one["CURRENCY"], one["PAYEE"]) == (3, "USD", "YOUTUBE")


def test_schema(spark, quarter):
    frame = report(quarter)
    assert frame.columns == ["service", *REPORT_COLUMNS] and len(REPORT_COLUMNS) == 24
    assert check_schema(frame, REPORT_FIELDS).columns == REPORT_COLUMNS
    with pytest.raises(TypeError):
        check_schema(frame.withColumn("Usages", F.lit("x")), REPORT_FIELDS)


def test_decimal_money_gives_the_same(quarter):
    assert rows(report(quarter)) == rows(report(quarter, money_type="decimal(28,6)"))


def test_shares_sum_to_one_without_loss(quarter):
    total = report(quarter).agg(
        F.sum("UsagesShare").alias("s"), F.sum("ROYALTIES_TO_BE_PAID").alias("r"),
        F.sum("AllocatedAmount").alias("a"),
    ).first()
    assert total.s == pytest.approx(1.0)
    assert total.r == pytest.approx(20.0 + total.a)


def test_copies_of_records_do_not_multiply_rows(quarter):
    sy, li, su, as_ = quarter
    twice = royalty_report(sy, li, su.union(su), as_.union(as_), ReportTerms("Us", *SHOP))
    assert rows(twice) == rows(report(quarter))


def test_repeated_claims_change_the_scalars_only(quarter):
    # Claims loaded twice: shares halve and the pool loses the amounts again.
    sy, li, su, as_ = quarter
    found = {
        r.BlockId: r for r in royalty_report(sy, li.union(li), su, as_, ReportTerms("Us", *SHOP)).collect()
    }
    assert len(found) == 2
    assert found["B1"].UsagesShare == 0.375
    assert found["B1"].GEPaymentsShare == pytest.approx(10.0 * 0.375)


def test_zero_denominator(spark, quarter):
    sy, li, su, as_ = quarter
    zero = li.withColumn("AllocatedUsages", F.lit(0.0))
    row = royalty_report(sy, zero, su, as_, ReportTerms("Us", *SHOP)).first()
    assert row.UsagesShare is None and row.ROYALTIES_TO_BE_PAID is None
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        royalty_report(sy, zero, su, as_, ReportTerms("Us", *SHOP, strict=True)).collect()


def test_pool_is_null_without_summary(spark, quarter):
    sy, li, su, as_ = quarter
    assert pool(sy.limit(0), li, "Us").first().Pool is None
    assert royalty_report(sy.limit(0), li, su, as_, ReportTerms("Us", *SHOP)).first().GEPaymentsShare is None


def test_scalars_by_quarter(spark, quarter):
    sy, li, su, as_ = quarter
    later = [df.withColumn("Quarter", F.lit("2024_Q2")) for df in (sy, li, su, as_)]
    both = [a.unionByName(b) for a, b in zip((sy, li, su, as_), later)]
    every = royalty_report(*both, ReportTerms("Us", *SHOP))
    assert every.where("BlockId = 'B1'").first().UsagesShare == 0.375
    apart = royalty_report(*both, ReportTerms("Us", *SHOP, by_quarter=True))
    assert {r.UsagesShare for r in apart.where("BlockId = 'B1'").collect()} == {0.75}


def test_quarters_and_services_do_not_mix(spark, quarter):
    sy, li, su, as_ = quarter
    other = su.withColumn("service", F.lit("hardware"))
    assert royalty_report(sy, li, other, as_, ReportTerms("Us", *SHOP)).count() == 0
