"""Merged usage, and artist totals that must agree with it."""

import random

import pytest

from staveline.operators.usage import (
    artist_maxima,
    artist_stats,
    artist_usage,
    block_usage,
    merged_usage,
    ranked_artists,
    residual_totals,
    songs_of,
    with_artists,
)
from staveline.plans import ranking
from staveline.plans.ranking import (
    RankingTerms,
    artist_statistics,
    top_artist_songs,
    top_residual_artists,
)
from staveline.session import settled
from staveline.sinks import blocks
from tests.helpers import close, column, rows
from tests.test_royalty import AS, LI, SU

MONEY = "decimal(28,6)"
# Column names and services of the definition that is compared.
SERVICES = ["ads", "hardware", "subs_music", "subs_premium"]
M, P = "MechanicalRight", "PerformingRight"


def random_records(spark, seed, size=60):
    """Few blocks in several files, with copies, NULLs and missing usages."""
    pick = random.Random(seed)
    artists = ["A", "A & B", "a, b", "-", " -", None, "B feat. C", "A & A", ""]

    def file():
        return pick.choice(SERVICES), pick.choice(["2024_Q1", "2024_Q2"])

    def money(nulls=0.2):
        return None if pick.random() < nulls else pick.randrange(1, 100) / 4

    as_, su, li = [], [], []
    for _ in range(size):
        block, txn = f"B{pick.randrange(3)}", f"T{pick.randrange(4)}"
        as_.append((*file(), block, f"R{pick.randrange(2)}", f"I{pick.randrange(2)}", "t",
                    pick.choice(artists), "k", None))
        su.append((*file(), block, txn, "R0", money(), money(), "v", "d"))
        li.append((*file(), block, txn, pick.choice(["Residual", "PubA"]), "C_1",
                   pick.choice([None, 50.0, 25.0]), pick.choice([M, M, P]), money(), money(),
                   money()))
    return (spark.createDataFrame(as_, AS), spark.createDataFrame(su, SU),
            spark.createDataFrame(li, LI))


def plain_merged(spark, as_, su, li, services=SERVICES):
    """The definition, as one SQL statement."""
    for name, df in (("a", as_), ("s", su), ("l", li)):
        df.createOrReplaceTempView(f"plain_{name}")
    listed = ", ".join(f"'{x}'" for x in services)
    return spark.sql(f"""
        SELECT ResourceType, ResourceDisplayArtistName, a.BlockId, ResourceISRC, ResourceTitle,
            ResourceSubTitle, SalesTransactionId, RightsController, RightSharePercent,
            CAST(sum(CAST(AllocatedUsages AS decimal(28,6))) AS double) AS AUsages,
            CAST(sum(CAST(AllocatedAmount AS decimal(28,6))) AS double) AS AAmount,
            CAST(sum(CAST(AllocatedNetRevenue AS decimal(28,6))) AS double) AS ANetRevenue,
            CAST(sum(CAST(Usages AS decimal(28,6))) AS double) AS Usages,
            CAST(sum(CAST(NetRevenue AS decimal(28,6))) AS double) AS NetRevenue
        FROM plain_a a
        JOIN plain_s s ON a.service = s.service AND a.BlockId = s.BlockId AND a.Quarter = s.Quarter
        JOIN plain_l l ON a.service = l.service AND a.BlockId = l.BlockId
            AND a.Quarter = l.Quarter AND l.ParentSalesTransactionId = s.SalesTransactionId
        WHERE l.RightsType = 'MechanicalRight' AND a.service IN ({listed})
        GROUP BY ALL""")


@pytest.mark.parametrize("seed", range(4))
def test_merged_usage_is_the_plain_join(spark, seed):
    records = random_records(spark, seed)
    assert rows(merged_usage(*records, money_type=MONEY)) == rows(plain_merged(spark, *records))


@pytest.mark.parametrize("seed", range(6))
def test_artist_usage_needs_no_merged_table(spark, seed):
    as_, su, li = random_records(spark, seed, size=80)
    expected = artist_stats(merged_usage(as_, su, li, money_type=MONEY), MONEY)
    found = artist_usage(as_, block_usage(su, li, MONEY), money_type=MONEY)
    assert rows(found.drop("HasResidual")) == rows(expected.drop("HasResidual"))
    kept = [sorted(column(residual_totals(f), "Artist")) for f in (found, expected)]
    assert kept[0] == kept[1]


def test_double_money_differs_in_rounding_only(spark):
    as_, su, li = random_records(spark, 9)
    exact = artist_usage(as_, block_usage(su, li, MONEY), money_type=MONEY)
    double = artist_usage(as_, block_usage(su, li))
    assert close(rows(exact), rows(double))


def test_services_and_compatible_mode(spark):
    as_, su, li = random_records(spark, 21, size=80)
    some = ["ads", "hardware"]
    assert rows(merged_usage(as_, su, li, services=some, money_type=MONEY)) == rows(
        plain_merged(spark, as_, su, li, some)
    )
    fixed = ["ads", "subs_music", "subs_premium"]
    hardware = merged_usage(as_, su, li, current_service="hardware", money_type=MONEY)
    assert rows(hardware) == rows(plain_merged(spark, as_, su, li))
    twice = as_.unionByName(as_.where("service = 'ads'"))
    assert rows(merged_usage(as_, su, li, current_service="ads", money_type=MONEY)) == rows(
        plain_merged(spark, twice, su, li, fixed)
    )
    compatible = artist_usage(
        as_, block_usage(su, li, MONEY), current_service="ads", money_type=MONEY
    )
    expected = artist_stats(
        merged_usage(as_, su, li, current_service="ads", money_type=MONEY), MONEY
    )
    assert rows(compatible.drop("HasResidual")) == rows(expected.drop("HasResidual"))


def test_block_fan_out_is_kept(spark):
    """A block with two recordings counts each sale for both."""
    as_ = spark.createDataFrame([
        ("ads", "q", "B", "R1", "I1", "t", "A", "k", None),
        ("ads", "q", "B", "R2", "I2", "t", "A", "k", None),
    ], AS)
    su = spark.createDataFrame([("ads", "q", "B", "T", "R1", 10.0, 1.0, "v", "d")], SU)
    li = spark.createDataFrame([("ads", "q", "B", "T", "Residual", "c", 5.0, M, 1.0, 1.0, 1.0)], LI)
    stats = artist_usage(as_, block_usage(su, li)).first()
    assert (stats.TotalUsages, stats.ResidualObservations) == (20.0, 2)


def test_dash_is_tested_before_the_trim(spark):
    names = ["A & A", "-", " -", "b, -", "B &-", "", None]
    frame = spark.createDataFrame([(i, n) for i, n in enumerate(names)],
                                  "i int, ResourceDisplayArtistName string")
    found = sorted(column(with_artists(frame), "i", "Artist"))
    assert found == [(0, "a"), (0, "a"), (2, "-"), (3, "-"), (3, "b"), (4, "b"), (5, "")]


def stats_frame(spark, values):
    names = ["Usages", "AUsages", "ANetRevenue", "AAmount", "NetRevenue"]
    fields = ["Artist string", *[f"Total{n} double" for n in names],
              "AvgResidualRightsSharePctg double", *[f"ResidualTotal{n} double" for n in names],
              "ResidualObservations long", "HasResidual boolean"]
    data = [(a, t, 0., 0., 0., 0., 1., u, 0., 0., 0., 0., o, h) for a, t, u, o, h in values]
    return spark.createDataFrame(data, ", ".join(fields))


def test_ranking(spark):
    stats = stats_frame(spark, [
        ("b", 10.0, 5.0, 4, True), ("a", 10.0, 5.0, 4, True), ("c", 0.0, 10.0, 1, True),
        ("d", 99.0, None, 0, False), ("e", 1.0, None, 2, True),
    ])
    top = ranked_artists(stats, 10).collect()
    # 0.65 * 4/4 + 0.35 * 5/10; ties by name, no usages at all comes last.
    assert [r.Artist for r in top] == ["a", "b", "c", "e"]
    assert top[0].ArtistIndex == pytest.approx(0.825) and top[0].ResidualUsagesPctg == 0.5
    assert top[2].ResidualUsagesPctg is None and top[3].ArtistIndex is None
    assert [r.Artist for r in ranked_artists(stats, 2).collect()] == ["a", "b"]
    most = artist_maxima(stats).first()
    assert (most.MaxResidualObservations, most.MaxResidualTotalUsages) == (4, 10.0)
    usages_first = ranked_artists(stats, 1, observation_weight=0.0, usage_weight=1.0)
    assert usages_first.first().Artist == "c"


def test_songs_are_the_merged_rows_of_the_artists(spark):
    as_, su, li = random_records(spark, 3, size=80)
    wanted = spark.createDataFrame([("a",), ("c",), ("nobody",)], "Artist string")
    merged = merged_usage(as_, su, li, money_type=MONEY)
    found = songs_of(wanted, as_, su, li, money_type=MONEY)
    expected = with_artists(merged).join(wanted, "Artist", "left_semi")
    assert rows(found) == rows(expected)


def from_tables(df, *tables):
    """Shuffles in the final plan that stand above a scan of one of these tables and no aggregation."""
    df.write.format("noop").mode("overwrite").save()
    found, stack = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        depth = len(line) - len(line.lstrip(" :+-"))
        while stack and stack[-1][0] >= depth:
            stack.pop()
        stack.append((depth, line.strip(" :+-*()0123456789")))
        if any(t in line for t in tables):
            found += [x for _, x in stack if x.startswith("Exchange")]
    return found


def test_tables_stored_by_block_join_without_a_shuffle(spark):
    before = spark.conf.get(blocks.SUBSET_KEYS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = dict(zip(("as_", "su", "li"), random_records(spark, 3, size=80)))
        stored = blocks.store_by_block(plain, "records")
        assert all(rows(stored[n]) == rows(plain[n]) for n in plain)
        summed = [block_usage(t["su"], t["li"], MONEY) for t in (plain, stored)]
        assert from_tables(summed[1], "records_su", "records_li") == [] and rows(summed[0]) == rows(summed[1])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
        # Stored as a ranking is: its size is known, so Spark sends it to the recordings.
        wanted = settled(spark.createDataFrame([("a",), ("c",)], "Artist string"), "top-artists")
        songs = [songs_of(wanted, t["as_"], t["su"], t["li"], money_type=MONEY) for t in (plain, stored)]
        assert from_tables(songs[1], "records_as_", "records_su", "records_li") == []
        assert rows(songs[0]) == rows(songs[1]) and songs[0].count() > 0
        # A block that is too large for one task: no buckets, so that joins can split it.
        large = blocks.store_by_block(plain, "records", largest=5)
        assert all("spark_catalog" not in large[n]._jdf.queryExecution().toString() for n in plain)
        assert all(rows(large[n]) == rows(plain[n]) for n in plain)
        empty = {n: df.limit(0) for n, df in plain.items()}
        assert blocks.store_by_block(empty, "records")["su"].count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set(blocks.SUBSET_KEYS, before)


def test_a_name_that_stands_twice_is_two_rows(spark):
    as_ = spark.createDataFrame([("ads", q, "B", "R1", "I1", "t", "A & A, a", "k", None) for q in "qqr"], AS)
    su = spark.createDataFrame([("ads", q, "B", "T", "R1", 10.0, 1.0, "v", "d") for q in "qr"], SU)
    li = spark.createDataFrame([("ads", q, "B", "T", "Us", "c", 5.0, M, 1.0, 1.0, 1.0) for q in "qr"], LI)
    wanted = spark.createDataFrame([("a",)], "Artist string")
    expected = with_artists(merged_usage(as_, su, li)).join(wanted, "Artist", "left_semi")
    assert rows(songs_of(wanted, as_, su, li)) == rows(expected) and expected.count() == 3


def test_songs_are_made_in_place(spark):
    """A block of many songs and claims: its merged rows are neither grouped nor sent."""
    before = {k: spark.conf.get(k) for k in (blocks.SUBSET_KEYS, "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        as_, su, li = random_records(spark, 4, size=80)
        wanted = spark.createDataFrame([("a",), ("b",)], "Artist string")
        songs = songs_of(wanted, as_, su, li, money_type=MONEY)
        plan = songs._jdf.queryExecution().sparkPlan().toString()
        assert 0 < plan.index("SortMergeJoin") < plan.index("Aggregate")
        for chosen in ({}, {"current_service": "ads"}):
            merged = merged_usage(as_, su, li, money_type=MONEY, **chosen)
            expected = with_artists(merged).join(wanted, "Artist", "left_semi")
            assert rows(songs_of(wanted, as_, su, li, money_type=MONEY, **chosen)) == rows(expected)
            assert expected.count() > 0
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_statistics_of_stored_records_lie_in_their_buckets(spark, monkeypatch):
    before = {k: spark.conf.get(k) for k in (blocks.SUBSET_KEYS, "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = dict(zip(("as_", "su", "li"), random_records(spark, 6, size=80)))
        stored = blocks.store_by_block(plain, "records", buckets=5)
        terms = RankingTerms(money_type=MONEY)
        assert blocks.buckets_of(stored["li"]) == 5 and blocks.buckets_of(plain["li"]) is None
        kept, store = [], ranking.store_by_block
        monkeypatch.setattr(ranking, "store_by_block", lambda *a: kept.append(a) or store(*a))
        stats = [artist_statistics(t["as_"], t["su"], t["li"], terms) for t in (plain, stored)]
        assert [a[1:] for a in kept] == [("block-usage", 5)]
        assert from_tables(kept[0][0]["blocks"], "records_su", "records_li") == []
        plan = stats[1]._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(BlockId" not in plan
        assert rows(stats[0]) == rows(stats[1])
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_whole_ranking(spark):
    as_, su, li = random_records(spark, 5, size=80)
    terms = RankingTerms(k=2, money_type=MONEY)
    top = top_residual_artists(as_, su, li, terms)
    full = ranked_artists(artist_stats(merged_usage(as_, su, li, money_type=MONEY), MONEY), 100)
    assert rows(top) == rows(full.limit(2))
    assert all(0 <= i <= 1 for i in column(top, "ArtistIndex"))
    songs = top_artist_songs(top, as_, su, li, terms)
    assert set(column(songs, "Artist")) == set(column(top, "Artist"))
