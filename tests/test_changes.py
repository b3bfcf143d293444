"""Intake by a log of changes: parts, versions, and what is read."""

import json

import pytest
from pyspark.sql import functions as F

from staveline.sources.dsr import typed_records
from staveline.streaming import changes, intake
from tests.helpers import column


@pytest.fixture
def places(tmp_path):
    (tmp_path / "landing").mkdir()
    return tmp_path


def send(places, number, *files, announced=True):
    """Write files (quarter, name, blocks, usages) and a log file that names them, a minute later each time."""
    events = []
    for quarter, name, blocks, usages in files:
        folder = places / "landing" / quarter
        folder.mkdir(exist_ok=True)
        (folder / name).write_text("".join(f"ST01\t{b}\tT\tS\t{usages}\n" for b in blocks))
        events.append({"kind": "finalized", "name": f"landing/{quarter}/{name}", "at": f"2024-05-01T10:{number:02}:00Z"})
    if announced:
        log(places, number, *events)


def log(places, number, *events):
    (places / "log").mkdir(exist_ok=True)
    (places / "log" / f"{number}.json").write_text("".join(json.dumps(e) + "\n" for e in events))


def run(spark, places, state="state", **options):
    return changes.ingest_changes(
        spark, f"{places}/log", f"{places}/landing", f"{places}/store", f"{places}/{state}", **options
    )


def stored(spark, places):
    rows = typed_records(changes.part_records(spark, f"{places}/store"), "ST01")
    return sorted(column(rows, "service", "Quarter", "BlockId", "Usages"))


def test_a_part_under_a_new_name_replaces_the_old_one(spark, places):
    send(places, 1, ("2024_Q1", "Ads_US_1of2_0501.tsv", "ab", 1), ("2024_Q1", "Ads_US_2of2_0501.tsv", "c", 1),
         ("2024_Q1", "Ads_GB_1of2_0501.tsv", "d", 1), ("2024_Q2", "Ads_US_1of2_0501.tsv", "e", 1))
    assert len(run(spark, places).loads) == 1
    send(places, 2, ("2024_Q1", "ads_us_1of2_0601.tsv", "ax", 2))
    run(spark, places)
    assert run(spark, places) == changes.Taken()
    assert stored(spark, places) == [("ads", "2024_Q1", b, n) for b, n in (("a", 2), ("c", 1), ("d", 1), ("x", 2))] + [
        ("ads", "2024_Q2", "e", 1)
    ]
    # One part instead of two: both go.
    send(places, 3, ("2024_Q1", "Ads_US_1of1_0701.tsv", "z", 3))
    run(spark, places)
    assert [r[2:] for r in stored(spark, places)] == [("d", 1), ("z", 3), ("e", 1)]


def test_the_log_decides_and_not_the_folder(spark, places):
    send(places, 5, ("2024_Q1", "Ads.tsv", "a", 5), ("2024_Q1", "Hardware [1]*.tsv", "h", 5))
    send(places, 6, ("2024_Q1", "Unannounced_ads.tsv", "u", 6), announced=False)
    gone = {"kind": "finalized", "name": "landing/2024_Q1/gone_ads.tsv", "at": "2024-05-01T10:06:00Z"}
    log(places, 6, gone, {"kind": "deleted", "name": "landing/2024_Q1/Ads.tsv", "at": "2024-05-01T10:07:00Z"})
    assert run(spark, places).absent == ["landing/2024_Q1/gone_ads.tsv"]
    assert [r[2:] for r in stored(spark, places)] == [("a", 5), ("h", 5)]
    # An older event that comes late, and one that comes twice, change nothing.
    late = {"kind": "finalized", "name": "landing/2024_Q1/Ads.tsv", "at": "2024-05-01T10:01:00Z"}
    (places / "landing/2024_Q1/Ads.tsv").write_text("ST01\tlate\tT\tS\t1\n")
    log(places, 7, late)
    run(spark, places)
    log(places, 8, {**late, "at": "2024-05-01T10:05:00Z", "name": "landing/2024_Q1/Hardware [1]*.tsv"})
    run(spark, places)
    assert [r[2:] for r in stored(spark, places)] == [("a", 5), ("h", 5)]


def test_an_empty_log_and_bad_text(spark, places):
    assert run(spark, places) == changes.Taken()
    assert changes.current_parts(spark, f"{places}/store").count() == 0
    (places / "log" / "bad.json").write_text("no event\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|STREAM_FAILED"):
        run(spark, places)


def test_a_new_checkpoint_gives_the_same(spark, places):
    send(places, 1, ("2024_Q1", "Ads_1of2.tsv", "a", 1), ("2024_Q1", "Ads_2of2.tsv", "b", 1))
    send(places, 2, ("2024_Q1", "Ads_1of2_new.tsv", "c", 2))
    run(spark, places, files_per_batch=1)
    first = stored(spark, places)
    run(spark, places, state="other")
    assert stored(spark, places) == first and [r[2:] for r in first] == [("b", 1), ("c", 2)]


def test_a_run_cut_short_before_its_commit_is_made_up_for(spark, places, monkeypatch):
    send(places, 1, ("2024_Q1", "Ads_1of1_a.tsv", "a", 1))
    run(spark, places)
    send(places, 2, ("2024_Q1", "Ads_1of1_b.tsv", "b", 2))

    def broken(*_):
        raise OSError("no space")

    with monkeypatch.context() as m:
        m.setattr(changes, "_commit", broken)
        with pytest.raises(Exception, match="no space"):
            run(spark, places)
    assert [r[2:] for r in stored(spark, places)] == [("a", 1)]
    assert len(run(spark, places).loads) == 1
    assert [r[2:] for r in stored(spark, places)] == [("b", 2)]


def test_a_rejected_part_is_not_read_and_few_snapshots_stay(spark, places):
    store = f"{places}/store"
    for number in range(1, 5):
        send(places, number, ("2024_Q1", f"Ads_1of1_{number}.tsv", "a", number))
        run(spark, places)
    versions = [p for p in (places / "store/parts").iterdir() if not p.name.startswith("_")]
    assert len(versions) == 2
    assert [r[2:] for r in stored(spark, places)] == [("a", 4)]
    folder = places / "landing" / "2024_Q1"
    (folder / "Ads_1of1_5.tsv").write_text("ST01\tshort\n" * 3)
    log(places, 5, {"kind": "finalized", "name": "landing/2024_Q1/Ads_1of1_5.tsv", "at": "2024-05-01T10:59:00Z"})
    run(spark, places, max_bad=1)
    assert stored(spark, places) == []
    assert column(changes.current_parts(spark, store), "status") == [intake.REJECTED]


def test_names_of_parts(spark):
    names = ["l/q/DSR_x_US_1of12_2024.tsv", "l/q/dsr-x-2of3.tsv", "l/q/proof1.tsv", "l/q/x_10of10", None]
    rows = spark.createDataFrame([(n,) for n in names], "file string")
    found = column(rows.select(*[c.alias(n) for n, c in changes.numbered_part(F.col("file")).items()]), "series", "part",
                   "parts")
    assert found == [("dsr_x_us", 1, 12), ("dsr-x", 2, 3), ("l/q/proof1.tsv", 0, 0), ("x", 10, 10), (None, 0, 0)]
