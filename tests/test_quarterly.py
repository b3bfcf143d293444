"""Files in, reports and ranking out."""

import os
import time
from dataclasses import replace

from staveline.operators.royalty import claims_of, pool, usage_denominator
from staveline.plans.quarterly import on_new_files, quarter_records
from staveline.plans.ranking import RankingTerms, top_residual_artists
from staveline.plans.report import ReportTerms
from staveline.plans.scalars import loaded_scalars, update_scalars
from staveline.sinks.tables import read_report
from staveline.sources.dsr import summaries, typed_records
from staveline.streaming.intake import ingest, records
from tests.helpers import rows

MARKERS = ["ads", "hardware", "subscriptionpremium", "subscriptionmusic"]


def lines(k):
    """One block: a claim of each controller, a sale, a recording, a summary."""
    sy = ["S", *[""] * 6, "Us", "", "Mech", "5", "1", "", "1", "30.0", *[""] * 10]
    return [
        "\t".join(["SY05.03", *sy]),
        "\t".join(["SY05.03", *sy]),
        f"LI01.03\tB{k}\tS\tUs\t\tC_{k}\t50\tMechanicalRight\t1\t2\t4\tT{k}:BR\t",
        f"LI01.03\tB{k}\tS\tResidual\t\tC_{k}\t50\tMechanicalRight\t1\t2\t4\tT{k}:BR\t",
        f"SU03.02\tB{k}\tT{k}:BR\tS\tR\t{k}\t9\tv\td\tc\ttrue",
        f"AS01.02\tB{k}\tr\tR\tI{k}\tsong\t\tAda & Bob\t\t\tMusic\t\t\t",
    ]


def test_whole_quarter(spark, tmp_path):
    landing = tmp_path / "landing"
    folder = landing / "2024_Q1"
    folder.mkdir(parents=True)
    store, state, out = (str(tmp_path / p) for p in ("store", "state", "out"))
    terms, ranking = ReportTerms("Us", "Payee", "store", "EUR"), RankingTerms(k=1)
    for i, marker in enumerate(MARKERS):
        (folder / f"Report_{marker}.tsv").write_text("\n".join(lines(i + 1)) + "\n")
        missing = on_new_files(spark, str(landing), store, state, out, terms, ranking)
        assert list(missing) == ["2024_Q1"] and len(missing["2024_Q1"]) == 3 - i
        assert os.path.exists(f"{out}/top_residual_artists") == (i == 3)
    latest = {r.service: r for r in read_report(spark, f"{out}/report").collect()}
    assert set(latest) == {"ads", "hardware", "subs_premium", "subs_music"}
    # The summary line came twice and counts once: pool 30 - 2.
    assert latest["ads"].GEPaymentsShare == 28.0 and latest["ads"].ROYALTIES_TO_BE_PAID == 30.0
    assert read_report(spark, f"{out}/report", "by_period").first().period == "2024Q1"

    r = quarter_records(spark, store, "2024_Q1")
    top = top_residual_artists(r["as_"], r["su"], r["li"], ranking)
    exported = spark.read.option("header", "true").schema(top.schema).csv(f"{out}/top_residual_artists")
    assert rows(exported) == rows(top) and exported.first().Artist == "ada"
    songs = spark.read.parquet(f"{out}/top_residual_artists_songs")
    assert songs.count() == 8 and {x.Artist for x in songs.collect()} == {"ada"}


def test_every_quarter_that_arrived_is_published(spark, tmp_path):
    landing = tmp_path / "landing"
    store, state, out = (str(tmp_path / p) for p in ("store", "state", "out"))
    terms = ReportTerms("Us", "Payee", "store", "EUR", by_quarter=True)
    for quarter in ("2023_Q4", "2024_Q1"):
        (landing / quarter).mkdir(parents=True)
        (landing / quarter / "Report_ads.tsv").write_text("\n".join(lines(1)) + "\n")
    missing = on_new_files(spark, str(landing), store, state, out, terms)
    assert list(missing) == ["2023_Q4", "2024_Q1"]
    kept = read_report(spark, f"{out}/report", "by_period")
    assert {r.period for r in kept.collect()} == {"2023Q4", "2024Q1"}
    assert on_new_files(spark, str(landing), store, state, out, terms) == {}


def test_scalars_of_all_loaded_quarters(spark, tmp_path):
    """The stored sums give what a report over all records gives, through every kind of change."""
    landing = tmp_path / "landing"
    store, state = (str(tmp_path / p) for p in ("store", "state"))
    terms = ReportTerms("Us", "Payee", "store", "EUR", money_type="decimal(28,6)")

    def send(quarter, marker, *blocks, wrong=0):
        folder = landing / quarter
        folder.mkdir(parents=True, exist_ok=True)
        text = [line for k in blocks for line in lines(k)] + ["LI01.03\tx"] * wrong
        path = folder / f"Report_{marker}.tsv"
        path.write_text("\n".join(text) + "\n")
        stamp = time.time() + next(clock)
        os.utime(path, (stamp, stamp))

    def take():
        ingest(spark, str(landing), store, state, max_bad=2)
        worked = update_scalars(spark, store, terms)
        assert update_scalars(spark, store, terms) == []
        for scope in (terms, replace(terms, by_quarter=True)):
            got = loaded_scalars(spark, store, scope).where("UsagesTotal IS NOT NULL OR Pool IS NOT NULL")
            parsed = records(spark, store)
            li = typed_records(parsed, "LI01.03")
            usages = usage_denominator(claims_of(li, "Us"), scope.scope, scope.money_type)
            rest = pool(summaries(parsed).distinct(), li, "Us", scope.scope, scope.money_type)
            assert rows(got) == rows(usages.join(rest, list(scope.scope), "full").select(*got.columns))
        return worked

    clock = iter(range(10, 100, 10))
    send("2024_Q1", "ads", 1, 2)
    send("2024_Q1", "hardware", 3)
    assert take() == [("ads", "2024_Q1"), ("hardware", "2024_Q1")]
    send("2024_Q2", "ads", 4)
    assert take() == [("ads", "2024_Q2")]
    send("2024_Q1", "ads", 5)  # sent again with other lines
    assert take() == [("ads", "2024_Q1")]
    send("2024_Q2", "ads", 6, wrong=3)  # sent again and turned down
    assert take() == [("ads", "2024_Q2")]
    total = {r.service: r.UsagesTotal for r in loaded_scalars(spark, store, terms).collect()}
    assert total == {"ads": 4.0, "hardware": 4.0}
