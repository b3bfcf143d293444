"""Records made from the driver tables lie by block, and what joins on a block leaves them there."""

import datetime
import re

import pytest

from checks import intake_checks, standins
from checks.registry import QUERIES
from checks.standins import report_records
from staveline.operators.usage import merged_usage
from staveline.plans.report import ReportTerms, distinct_rows
from staveline.sinks import blocks
from tests.test_usage import MONEY, random_records

DAY = datetime.datetime(2024, 2, 3)


@pytest.fixture
def tables(spark, tmp_path):
    """Orders that come twice, also with another day, and keys that are null or unknown."""
    made = {
        "nation": ("n_nationkey long, n_name string", [(1, "BRAZIL"), (2, "CHAD")]),
        "customer": ("c_custkey long, c_nationkey long", [(1, 1), (2, 2), (2, 1), (3, None), (None, 1)]),
        "orders": ("o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp", [
            (1, 1, 9.0, DAY), (1, 1, 9.0, DAY), (2, 2, 9.0, DAY), (2, 1, 9.0, DAY.replace(month=9)),
            (3, 3, 9.0, DAY), (4, None, 9.0, DAY), (5, 1, 9.0, None), (None, 1, 9.0, DAY), (6, 9, 9.0, DAY),
        ]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string", [
            (50, "hot bolt", "B1", "LARGE"), (51, "ring", "B2", "SMALL"), (51, "ring", "B2", "SMALL"), (52, None, None, "k"),
        ]),
        "lineitem": (
            "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
            "l_discount double, l_returnflag string",
            [(o, p, p, 2.0, 4.0, 0.1, f) for o in (1, 2, 3, 4, 5, 6, None) for p, f in ((50, "N"), (51, "A"), (51, "A"), (52, "R"), (None, "A"))],
        ),
    }
    for name, (fields, data) in made.items():
        spark.createDataFrame(data, fields).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.fixture
def large_tables(spark):
    """Joins as between tables that are too large to be sent to every task."""
    kept = {k: spark.conf.get(k) for k in (blocks.SUBSET_KEYS, "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for key, value in kept.items():
        spark.conf.set(key, value)


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def other_shuffles(df):
    """Shuffles by a block and more, or by a transaction."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((?:BlockId#\d+, [a-zA-Z]|SalesT|ResourceT|service).*", plan)


def test_records_lie_by_block(spark, tables, large_tables):
    r = report_records(spark, tables)
    for df in (r.li, r.su, r.as_):
        assert shuffles(df.groupBy("service", "Quarter", "BlockId").count()) == shuffles(df)
    merged = merged_usage(r.as_, r.su, r.li, money_type=MONEY)
    assert shuffles(merged) == shuffles(r.li) + shuffles(r.su) + shuffles(r.as_)


def test_parts_grow_with_the_table(spark, tables, large_tables, monkeypatch):
    before = [sorted(map(str, df.collect())) for df in vars(report_records(spark, tables)).values()]
    monkeypatch.setattr(standins, "BYTES_OF_A_PART", 100)
    r = report_records(spark, tables)
    merged = merged_usage(r.as_, r.su, r.li, money_type=MONEY)
    assert not other_shuffles(merged)
    assert r.li.rdd.getNumPartitions() > 2 * spark.sparkContext.defaultParallelism
    assert [sorted(map(str, df.collect())) for df in vars(r).values()] == before


def test_rows_of_the_records(spark, tables, large_tables):
    r = report_records(spark, tables)
    first, third = ("2024_Q1", "hardware"), ("2024_Q3", "subs_music")
    sold = [(x.BlockId, x.SalesTransactionId, x.Quarter, x.Usages) for x in r.su.collect()]
    # Two equal orders count twice, and so do two customers of one key.
    assert sorted(x for x in sold if x[0] == "1" and x[1]) == [
        ("1", "T1-50", first[0], 4.0), ("1", "T1-51:BRAZIL", first[0], 8.0), ("1", "T1-52:BRAZIL", first[0], 4.0),
    ]
    assert ("2", "T2-50", first[0], 4.0) in sold and ("2", "T2-50", third[0], 2.0) in sold
    assert {x[0] for x in sold} == {"1", "2", "5"} and ("1", None, first[0], 4.0) in sold
    # A part that comes twice gives two recordings in each quarter of a block.
    found = [(x.BlockId, x.Quarter, x.service, x.ResourceISRC) for x in r.as_.collect()]
    assert sorted(x for x in found if x[0] == "2") == sorted(
        ("2", q, "subs_music", f"ISRC{p}") for q in (first[0], third[0]) for p in (50, 51, 51, 52)
    )
    assert sum(x[1] is None for x in found) == 4 and len(found) == 16
    assert r.li.count() == 5 * (2 + 3 + 1)


@pytest.mark.parametrize("seed", range(2))
def test_merged_rows_are_not_grouped(spark, seed, large_tables):
    """The table of pairs is larger than the records, so no step may hold or send it."""
    merged = merged_usage(*random_records(spark, seed), money_type=MONEY)
    plan = merged._jdf.queryExecution().sparkPlan().toString()
    assert 0 < plan.index("SortMergeJoin") < plan.index("Aggregate")
    few = merged_usage(*random_records(spark, seed), money_type="decimal(20,2)")
    assert few.count() == merged.count()


def test_report_rows_need_no_shuffle_of_recordings(spark, tables, large_tables):
    r = report_records(spark, tables)
    found = distinct_rows(r.li.where("RightsController = 'PubA'"), r.su, r.as_, ReportTerms("PubA", "p", "s", "c"))
    above = found._jdf.queryExecution().executedPlan().toString().split("Join")[0]
    assert "Exchange" not in above


def test_records_are_stored_as_they_were_dealt(spark, tables, large_tables, monkeypatch):
    """One bucket for each part: storing the records by block shuffles nothing a second time."""
    plain = [sorted(map(str, df.collect())) for df in vars(report_records(spark, tables)).values()]
    monkeypatch.setattr(standins, "BYTES_OF_A_PART", 100)
    parts = standins._parts(spark, tables)
    r = report_records(spark, tables)
    for df in (r.li, r.su, r.as_):
        assert shuffles(df.repartition(parts, "BlockId")) == shuffles(df)
        assert df.rdd.getNumPartitions() == parts
    stored = standins.block_records(spark, tables)
    assert {blocks.buckets_of(df) for df in stored.values()} == {parts}
    names = ("li", "su", "as_")
    assert [sorted(map(str, stored[n].collect())) for n in names] == plain[1:]


def test_report_files_follow_their_folders(spark, tables, large_tables, tmp_path):
    """However many tasks make the lines, those of a folder lie in one file."""
    rows = standins.claims(spark, tables)
    spread = rows.unionByName(rows).repartition(16)
    intake_checks._write_lines(spread, "LI01.03", f"{tmp_path}/spread")
    made = standins.claims(spark, tables, intake_checks.FOLDER)
    assert sorted(map(str, made.collect())) == sorted(map(str, rows.collect()))
    part = made.where("Quarter = '2024_Q1'")
    intake_checks._write_lines(part, "LI01.03", f"{tmp_path}/part", together=True)
    for place, lines in (("spread", 2 * rows.count()), ("part", part.count())):
        files = list((tmp_path / place).rglob("part-*"))
        assert len(files) == len({f.parent for f in files}) > 1
        assert spark.read.option("recursiveFileLookup", "true").text(f"{tmp_path}/{place}").count() == lines


def test_no_file_is_left_for_each_task(spark, tables, large_tables, tmp_path, monkeypatch):
    """The landing folder of the intake query, with line items in very many parts."""
    monkeypatch.setattr(standins, "BYTES_OF_A_PART", 100)
    monkeypatch.setattr(intake_checks, "scratch_folder", lambda *a: f"{tmp_path}/intake")
    found = QUERIES["stream_ingest"](spark, tables)
    written = spark.read.option("recursiveFileLookup", "true").text(f"{tmp_path}/intake/landing")
    assert found.count() == written.count() == standins.claims(spark, tables).count()
    files = list((tmp_path / "intake" / "landing").rglob("part-*"))
    assert len(files) == len({f.parent for f in files}) > 1


def test_scalars_are_loaded_from_few_files(spark, tables, large_tables, tmp_path, monkeypatch):
    """Two loads of claims and summaries: one file of each for a service and quarter."""
    expected = sorted(map(str, QUERIES["loaded_scalars"](spark, tables).collect()))
    monkeypatch.setattr(standins, "BYTES_OF_A_PART", 100)
    monkeypatch.setattr(intake_checks, "scratch_folder", lambda *a: f"{tmp_path}/scalars")
    assert sorted(map(str, QUERIES["loaded_scalars"](spark, tables).collect())) == expected != []
    files = list((tmp_path / "scalars" / "landing").rglob("part-*"))
    assert 0 < len(files) <= 2 * len({f.parent for f in files})
