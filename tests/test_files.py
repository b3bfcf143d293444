"""Tables, exports and the streaming intake."""

import glob
import os
import subprocess
import sys
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from staveline.session import release, scratch_folder, settled
from staveline.sinks import tables
from staveline.sources.dsr import read_dsr, typed_records
from staveline.streaming import gate, intake
from tests.helpers import column, rows


def frame(spark, *values):
    return spark.createDataFrame(list(values), "service string, Quarter string, n int")


def test_append_replaces_its_own_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_records(frame(spark, ("ads", "q1", 1), ("ads", "q2", 2)), path)
    tables.append_records(frame(spark, ("ads", "q2", 3)), path)
    tables.append_records(frame(spark, ("ads", "q2", 3)), path)
    assert rows(spark.read.parquet(path)) == [("q1", 1, "ads"), ("q2", 3, "ads")]
    tables.write_replace(frame(spark, ("ads", "q9", 9)), path)
    assert column(spark.read.parquet(path), "n") == [9]


def report_rows(spark, path):
    latest = column(tables.read_report(spark, path), "service", "Quarter", "n")
    return sorted(latest), sorted(column(tables.read_report(spark, path, tables.BY_PERIOD), "period", "service", "n"))


def test_report_keeps_a_copy_per_period(spark, tmp_path):
    path = str(tmp_path / "report")
    with pytest.raises(ValueError):
        tables.read_report(spark, path)
    tables.write_report(frame(spark, ("ads", "2024_Q1", 1)), path, "2024_Q1")
    tables.write_report(frame(spark, ("ads", "2024_Q2", 2)), path, "2024_Q2")
    tables.write_report(frame(spark, ("hardware", "2024_Q2", 3)), path, "2024_Q2")
    tables.write_report(frame(spark, ("x", "q", 0)).limit(0), path, "2024_Q3")
    assert report_rows(spark, path) == (
        [("ads", "2024_Q2", 2), ("hardware", "2024_Q2", 3)],
        [("2024Q1", "ads", 1), ("2024Q2", "ads", 2), ("2024Q2", "hardware", 3)],
    )
    # The same period again replaces its copy.
    tables.write_report(frame(spark, ("ads", "2024_Q2", 7)), path, "2024_Q2")
    want = report_rows(spark, path)
    assert ("2024Q2", "ads", 7) in want[1] and len(want[1]) == 3
    removed = tables.drop_old_versions(spark, path)
    assert len(removed) == 3 and report_rows(spark, path) == want


def test_a_report_is_published_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "report")
    tables.write_report(frame(spark, ("ads", "2024_Q1", 1)), path, "2024_Q1")
    before = report_rows(spark, path)
    write, commit = tables._write_version, tables._commit

    def second_fails(df, folder, *partitions):
        write(df, folder, *partitions)
        if tables.BY_PERIOD in folder:
            raise OSError("disk full")

    monkeypatch.setattr(tables, "_write_version", second_fails)
    with pytest.raises(OSError):
        tables.write_report(frame(spark, ("ads", "2024_Q2", 2)), path, "2024_Q2")
    assert report_rows(spark, path) == before
    monkeypatch.setattr(tables, "_write_version", write)

    def beaten(spark_, path_, number, content):
        commit(spark_, path_, number, before_content)
        commit(spark_, path_, number, content)

    before_content = tables._newest_commit(spark, path)[1]
    monkeypatch.setattr(tables, "_commit", beaten)
    with pytest.raises(RuntimeError):
        tables.write_report(frame(spark, ("ads", "2024_Q2", 2)), path, "2024_Q2")
    monkeypatch.setattr(tables, "_commit", commit)
    assert report_rows(spark, path) == before
    tables.write_report(frame(spark, ("ads", "2024_Q2", 2)), path, "2024_Q2")
    assert len(tables.drop_old_versions(spark, path)) == 5
    assert report_rows(spark, path)[0] == [("ads", "2024_Q2", 2)]


def test_a_quarter_is_emitted_once(spark, tmp_path):
    store, state = str(tmp_path / "store"), str(tmp_path / "gate")
    fields = intake.MANIFEST_FIELDS

    def arrive(load, *files):
        data = [(load, status, service, quarter, f"{quarter}/{service}", datetime(2024, 1, 1), 1, 0)
                for service, quarter, status in files]
        spark.createDataFrame(data, fields).write.partitionBy("status").parquet(
            f"{store}/{intake.MANIFEST}/load={load}")

    def run():
        return gate.emit_completed(spark, store, state, ["a", "b"])

    assert run() == [] and gate.completed(spark, store).count() == 0
    arrive("1", ("a", "q1", "good"), ("b", "q1", "rejected"), ("a", "q2", "good"), ("a", None, "good"))
    assert run() == []
    arrive("2", ("b", "q1", "good"), ("b", "q3", "good"))
    assert run() == ["q1"]
    assert run() == []
    arrive("3", ("a", "q1", "good"), ("b", "q1", "good"))
    arrive("4", ("b", "q2", "good"), ("c", "q2", "good"), ("a", "q3", "good"))
    assert run() == ["q2", "q3"]
    # A batch that failed after it was written, and runs again, replaces its folder.
    last = max(int(os.path.basename(p)) for p in glob.glob(f"{state}/commits/[0-9]*"))
    os.remove(f"{state}/commits/{last}")
    os.remove(f"{state}/commits/.{last}.crc")
    run()
    assert sorted(column(gate.completed(spark, store), "quarter")) == ["q1", "q2", "q3"]


def test_csv_exports(spark, tmp_path):
    one = str(tmp_path / "one")
    tables.export_csv(frame(spark, ("ads", "q", 1), ("ads", "q", 2)).repartition(2), one, single=True)
    assert len([f for f in os.listdir(one) if f.endswith(".csv")]) == 1
    people = spark.createDataFrame([("Yo No", 1), ("Tu", 2)], "artist string, n int")
    tables.write_by_key(people, "artist", str(tmp_path), "tracks", "2021-01-01", "2024-01-01")
    folder = tmp_path / "tracks_2021-01-01_2024-01-01"
    assert {"artist_folder=Yo_No", "artist_folder=Tu"} <= set(os.listdir(folder))


STORE = """
import sys
from pyspark.sql import SparkSession
from staveline.session import local_session, scratch_folder, settled
if sys.argv[1] == "own":
    spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
    try:
        scratch_folder(spark, "x")
    except ValueError as error:
        print("refused:", "spark.checkpoint.dir" in str(error))
else:
    spark = local_session("1", "alone")
    one, two = settled(spark.range(3), "x"), settled(spark.range(4), "x")
    print("stored:", one.count(), two.count(), one.stored_in != two.stored_in)
"""


@pytest.mark.parametrize(("session", "said"), [("library", "stored: 3 4 True"), ("own", "refused: True")])
def test_sessions_without_settings_of_their_machine(tmp_path, session, said):
    """Real sessions, with no defaults that name a checkpoint folder."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": root}
    run = subprocess.run([sys.executable, "-c", STORE, session], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert said in run.stdout, run.stderr[-2000:]


def test_scratch_folder_is_taken_from_the_session(spark):
    one, two = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    base = spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert one != two and one.startswith(f"{base}/x-")


WORKER = """
import sys
sys.path.insert(0, sys.argv[1])
from staveline.functions import text
from staveline.session import local_session, ship_package

spark = ship_package(ship_package(local_session("1", "elsewhere")))

def names(batches):
    import staveline.session
    yield from batches

print("rows:", spark.range(3).mapInArrow(names, "id long").count())
"""


def test_workers_find_the_package_from_anywhere(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", WORKER, root], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert "rows: 3" in run.stdout, run.stderr[-2000:]


def test_stored_frames_can_be_released(spark):
    kept = settled(spark.range(5).toDF("n"), "kept")
    folder = kept.stored_in
    assert kept.count() == 5 and os.path.isdir(folder.removeprefix("file:"))
    release(kept)
    assert not os.path.exists(folder.removeprefix("file:"))
    with pytest.raises(ValueError):
        release(spark.range(1))


# --- intake ---------------------------------------------------------------------

def put(landing, quarter, name, *lines):
    folder = landing / quarter
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(f"{x}\n" for x in lines))


def st(block, usages):
    return f"ST01\t{block}\tT\tS\t{usages}"


@pytest.fixture
def places(tmp_path):
    (tmp_path / "landing").mkdir()
    return tmp_path / "landing", str(tmp_path / "store"), str(tmp_path / "state")


def stored(spark, store):
    return rows(typed_records(intake.records(spark, store), "ST01"))


def test_files_one_at_a_time_equal_one_batch(spark, places):
    landing, store, state = places
    put(landing, "2024_Q1", "Report_ads.tsv", st("a", 1), st("b", 2))
    intake.ingest(spark, str(landing), store, state)
    put(landing, "2024_Q1", "Report_hardware.tsv", st("c", 3))
    put(landing, "2024_Q2", "Report_ads.tsv", st("d", 4))
    intake.ingest(spark, str(landing), store, state, files_per_batch=1)
    intake.ingest(spark, str(landing), store, state)
    batch = typed_records(read_dsr(spark, str(landing)), "ST01")
    assert stored(spark, store) == rows(batch) and batch.count() == 4


def age(landing, quarter, name, seconds):
    """Set the time of modification that many seconds from now."""
    path, now = landing / quarter / name, time.time()
    os.utime(path, (now + seconds, now + seconds))


def test_a_file_sent_again_replaces_itself(spark, places):
    landing, store, state = places
    put(landing, "2024_Q1", "Report_ads.tsv", st("a", 1), st("b", 2))
    put(landing, "2024_Q1", "Report ads 2.tsv", st("z", 9))
    intake.ingest(spark, str(landing), store, state)
    put(landing, "2024_Q1", "Report_ads.tsv", st("a", 7))
    age(landing, "2024_Q1", "Report_ads.tsv", 10)
    assert len(intake.ingest(spark, str(landing), store, state)) == 1
    assert intake.ingest(spark, str(landing), store, state) == []
    found = typed_records(intake.records(spark, store), "ST01")
    assert sorted(column(found, "BlockId", "Usages")) == [("a", 7), ("z", 9)]


def test_a_new_checkpoint_loses_and_doubles_nothing(spark, places):
    landing, store, state = places
    put(landing, "2024_Q1", "Report_ads.tsv", st("a", 1), st("b", 2))
    intake.ingest(spark, str(landing), store, state)
    put(landing, "2024_Q1", "Report_hardware.tsv", st("h", 3))
    intake.ingest(spark, str(landing), store, state + "-2")
    (landing / "2024_Q1" / "Report_ads.tsv").unlink()
    intake.ingest(spark, str(landing), store, state + "-3")
    assert [r[0] for r in stored(spark, store)] == ["a", "b", "h"]
    assert intake.manifest(spark, store).count() == 2


def test_a_rejected_file_holds_up_no_other(spark, places):
    landing, store, state = places
    put(landing, "2024_Q1", "Report_ads.tsv", st("a", 1), "ST01\tshort")
    put(landing, "2024_Q1", "Report_hardware.tsv", *["ST01\tx"] * 3, st("h", 1))
    intake.ingest(spark, str(landing), store, state, max_bad=2)
    put(landing, "2024_Q1", "Report_subscriptionpremium.tsv", st("p", 1))
    intake.ingest(spark, str(landing), store, state, max_bad=2)
    assert [r[0] for r in stored(spark, store)] == ["a", "p"]
    assert column(intake.rejected(spark, store), "service", "rows", "bad") == [("hardware", 4, 3)]
    reasons = column(intake.quarantine(spark, store), "reason")
    assert sorted(reasons) == ["rejected", "width", "width", "width", "width"]
    # Mended and sent again, it is taken; its old rows leave the quarantine.
    put(landing, "2024_Q1", "Report_hardware.tsv", st("h", 2))
    age(landing, "2024_Q1", "Report_hardware.tsv", 10)
    intake.ingest(spark, str(landing), store, state, max_bad=2)
    assert [r[0] for r in stored(spark, store)] == ["a", "h", "p"]
    assert column(intake.quarantine(spark, store), "reason") == ["width"]


def test_a_retry_replaces_its_load(spark, places):
    landing, store, state = places
    lines = spark.createDataFrame(
        [(st("a", 1), "landing/2024_Q1/Report_ads.tsv", datetime(2024, 1, 1))],
        "value string, file string, modified timestamp",
    )
    intake.load_batch(lines, "q-0", store)
    intake.load_batch(lines, "q-0", store)
    assert len(stored(spark, store)) == 1


def test_files_do_not_multiply_with_tasks(spark, places):
    landing, store, state = places
    for name in ("ads", "hardware"):
        for i in range(12):
            put(landing, "2024_Q1", f"Report_{name}_{i}.tsv", st("a", i), "LI01.03" + "\t" * 12)
    [load] = intake.ingest(spark, str(landing), store, state)
    folders = [f for _, _, f in os.walk(f"{store}/records/load={load}")]
    counts = [sum(x.endswith(".parquet") for x in f) for f in folders]
    assert max(counts) == 1 and sum(counts) == 4
    path = str(landing.parent / "appended")
    rows = spark.range(4000).repartition(16).select(
        (F.col("id") % 2).cast("string").alias("service"), F.lit("q").alias("Quarter"), "id"
    )
    tables.append_records(rows, path)
    assert max(sum(x.endswith(".parquet") for x in f) for _, _, f in os.walk(path)) == 1


def test_unroutable_files_are_kept_aside(spark, places):
    landing, store, state = places
    put(landing, "2024_Q1", "Report_other.tsv", st("a", 1))
    put(landing, "2024_Q1", "Report_ads.tsv", st("b", 1))
    intake.ingest(spark, str(landing), store, state)
    assert column(intake.quarantine(spark, store), "reason") == ["route"]
    assert len(stored(spark, store)) == 1


def test_metadata_files_go_their_own_way(spark, places):
    landing, store, state = places
    name = "top_residual_artists_metadata"
    put(landing, "extra", f"{name}_1.tsv", "Artist\tgenre\tnote", "ada\tpop\t1")
    put(landing, "extra", f"{name}_2.tsv", "Artist\tgenre\tnote", "ada\tpop\t1")
    put(landing, "2024_Q1", "Report_ads.tsv", st("a", 1), "ZZ99\tunknown")
    intake.ingest(spark, str(landing), store, state)
    found = intake.artist_metadata(spark, store, ["Artist", "genre", "note"])
    assert rows(found) == [("ada", "pop", "1")] * 2
    assert intake.quarantine(spark, store).count() == 0
    assert column(intake.manifest(spark, store), "service") == ["ads"]
    assert sorted(column(intake.records(spark, store), "record_type")) == ["ST01", "other"]


def test_gate_names_every_missing_service(spark, places):
    landing, store, state = places
    for name in ("ads", "hardware", "subscriptionpremium", "subscriptionmusic"):
        put(landing, "2024_Q1", f"Report_{name}.tsv", st("a", 1))
    put(landing, "2024_Q2", "Report_ads.tsv", st("a", 1))
    intake.ingest(spark, str(landing), store, state)
    files = intake.manifest(spark, store)
    gate = {r.quarter: r.missing for r in intake.missing_services(files).collect()}
    assert gate == {"2024_Q1": [], "2024_Q2": ["hardware", "subs_premium", "subs_music"]}
    assert column(intake.complete_quarters(files), "quarter") == ["2024_Q1"]


def test_record_types_are_folders(spark, places):
    landing, store, state = places
    put(landing, "2024_Q1", "Report_ads.tsv", st("a", 1), "LI01.03" + "\t" * 12)
    intake.ingest(spark, str(landing), store, state)
    plan = intake.records(spark, store).where(F.col("record_type") == "ST01")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "record_type" in text.split("PartitionFilters")[1][:400]
