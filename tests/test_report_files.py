import pytest
from pyspark.sql import functions as F

from staveline.sources import dsr
from staveline.sources.layouts import LAYOUTS, TABLE_OF_CODE
from staveline.sources.lookups import is_artist_metadata, load_artist_metadata
from tests.helpers import column, rows

FILE = "dsr/2024_Q1/Report_ads.tsv"


def line(code, *values):
    fields = [""] * len(LAYOUTS[code])
    fields[: len(values)] = values
    return "\t".join([code, *fields])


def parsed(spark, lines, file=FILE):
    return dsr.parse_lines(spark.createDataFrame([(x, file) for x in lines], "value string, file string"))


def test_layouts_have_the_documented_widths():
    widths = {code: len(fields) for code, fields in LAYOUTS.items()}
    assert widths == {
        "HEAD": 15, "SY05.03": 25, "SY02.03": 21, "AS01.02": 13, "RU01.02": 6, "SU03.02": 10,
        "LI01.03": 12, "MW01.02": 18, "LC01": 22, "SY04.02": 19, "SY09.01": 21, "ST01": 4,
    }
    assert set(TABLE_OF_CODE) == set(LAYOUTS)


@pytest.mark.parametrize("name, service, quarter", [
    ("dsr/2024_Q1/Report_Ads.tsv", "ads", "2024_Q1"),
    ("uploads/2024_Q1/hardware.tsv", "hardware", "2024_Q1"),
    ("dsr/2024_Q1/x_SubscriptionPremium.tsv", "subs_premium", "2024_Q1"),
    ("dsr/2024_Q1/x_subscriptionmusic.tsv", "subs_music", "2024_Q1"),
    ("dsr/2024_Q1/ads_hardware.tsv", "ads", "2024_Q1"),
    ("dsr/2024_Q1/other.tsv", "", "2024_Q1"),
    ("dsr/Quarter=2024_Q1/report=ads/part-0.txt", "ads", "2024_Q1"),
    ("ads.tsv", "ads", None),
    ("dsr/ads.tsv", "ads", None),
])
def test_route(spark, name, service, quarter):
    where = dsr.route(F.lit(name))
    found = spark.range(1).select(where["service"].alias("s"), where["quarter"].alias("q")).first()
    assert (found.s, found.q) == (service, quarter)


def test_unrouted_lines_go_to_quarantine(spark):
    frame = parsed(spark, ["ST01\tb"]).unionByName(parsed(spark, ["ST01\tb"], "dsr/2024_Q1/zzz.tsv"))
    good, bad = dsr.split_routed(frame)
    assert (good.count(), bad.count()) == (1, 1)


def test_quotes_carriage_return_and_unicode_stay(spark):
    frame = parsed(spark, ['ST01\tb"1\tsão\ts\t7\r'])
    record = dsr.typed_records(frame, "ST01").first()
    assert (record.BlockId, record.ParentSalesTransactionId, record.Usages) == ('b"1', "são", 7)
    assert (record.service, record.Quarter) == ("ads", "2024_Q1")


def test_typed_fields(spark):
    head = line("HEAD", "1", "p", "v", "m", "d", "3", "4", "2024-01-01", "2024-03-31")
    record = dsr.typed_records(parsed(spark, [head]), "HEAD").first()
    assert (record.FileNumber, str(record.UsageEndDate)) == (3, "2024-03-31")
    kinds = dict(dsr.typed_records(parsed(spark, [head]), "RU01.02").dtypes)
    assert kinds["Usages"] == "string"


def test_empty_and_bad_numbers(spark):
    empty, bad = parsed(spark, ["ST01\tb\tt\ts\t"]), parsed(spark, ["ST01\tb\tt\ts\tx"])
    assert dsr.typed_records(empty, "ST01").first().Usages is None
    assert dsr.typed_records(bad, "ST01", lenient=True).first().Usages is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        dsr.typed_records(empty, "ST01", strict=True).collect()
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        dsr.typed_records(bad, "ST01").collect()


def test_variant_is_chosen_per_file_set(spark):
    wide = line("SY05.03", "w")
    narrow = line("SY02.03", "n")
    frame = parsed(spark, [wide, narrow]).unionByName(
        parsed(spark, [narrow], "dsr/2024_Q1/Report_hardware.tsv")
    )
    result = dsr.summaries(frame)
    assert sorted(column(result, "service", "SummaryRecordId")) == [("ads", "w"), ("hardware", "n")]
    assert {"Users", "ParentSummaryRecordId"} <= set(result.columns)


def test_bad_rows_and_budget(spark):
    good = ["ST01\tb\tt\ts\t7", "ST01\tb\tt\ts\t7\t\t", "ZZ99\tanything"]
    bad = ["ST01\tb\tt\ts", "ST01\tb\tt\ts\t7\tx"]
    kept, quarantine = dsr.check_bad_rows(parsed(spark, good + bad), max_bad=2)
    assert (kept.count(), quarantine.count()) == (3, 2)
    with pytest.raises(dsr.BadRowsError, match="Report_ads.tsv: 2"):
        dsr.check_bad_rows(parsed(spark, good + bad), max_bad=1)
    other = parsed(spark, bad, "dsr/2024_Q1/Report_hardware.tsv")
    _, quarantine = dsr.check_bad_rows(parsed(spark, bad).unionByName(other), max_bad=2)
    assert quarantine.count() == 4


def test_round_trip_of_every_layout(spark):
    sample = {"string": "text", "long": "12", "double": "1.5", "date": "2024-01-31"}
    lines = ["\t".join([c, *[sample[f.type] for f in fields]]) for c, fields in LAYOUTS.items()]
    frame = parsed(spark, lines)
    for code in LAYOUTS:
        again = dsr.to_lines(dsr.typed_records(frame, code), code)
        assert column(again, "value") == [x for x in lines if x.startswith(code + "\t")]


def test_demux_and_counts(spark):
    frame = parsed(spark, [line("LI01.03", "b"), line("LI01.03", "c"), "ST01\tb\tt\ts\t1"])
    tables = dsr.demux(frame)
    assert tables["LI01.03"].count() == 2 and tables["HEAD"].count() == 0
    counts = {r.record_type: r.records for r in dsr.record_counts(frame).collect()}
    assert counts == {"LI01.03": 2, "ST01": 1}


def test_read_dsr_from_folders(spark, tmp_path):
    for quarter, name in (("2024_Q1", "Report_ads.tsv"), ("2024_Q2", "Report_hardware.tsv")):
        folder = tmp_path / "landing 1" / quarter
        folder.mkdir(parents=True)
        (folder / name).write_text("ST01\tb\tt\ts\t1\r\nST01\tc\tt\ts\t2\n")
    frame = dsr.read_dsr(spark, str(tmp_path / "landing 1"))
    found = dsr.typed_records(frame, "ST01").select("service", "Quarter", "BlockId", "Usages")
    assert rows(found) == [
        ("b", "2024_Q1", 1, "ads"), ("b", "2024_Q2", 1, "hardware"),
        ("c", "2024_Q1", 2, "ads"), ("c", "2024_Q2", 2, "hardware"),
    ]


def test_artist_metadata_appends_and_fails_on_bad_rows(spark, tmp_path):
    source = tmp_path / "top_residual_artists_metadata.tsv"
    source.write_text('Artist\tgenre\tnote\na "x"\tpop\t1\n')
    table = str(tmp_path / "table")
    schema = "Artist string, genre string, note int"
    load_artist_metadata(spark, str(source), table, schema)
    assert load_artist_metadata(spark, str(source), table, schema).count() == 2
    source.write_text("Artist\tgenre\tnote\na\tpop\tnot a number\n")
    with pytest.raises(Exception):
        load_artist_metadata(spark, str(source), table, schema)
    assert spark.range(1).select(is_artist_metadata(F.lit(str(source)))).first()[0]
