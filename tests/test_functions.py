import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from staveline.functions import dates, numbers, text
from tests.helpers import column


def apply(spark, values, function, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    result = frame.select("i", function(F.col("v")).alias("r")).orderBy("i")
    return column(result, "r")


def test_country_of_sale(spark):
    ids = ["T1:BR", "T1", None, "T1:BR:x", "T1:"]
    assert apply(spark, ids, text.country_of_sale) == ["BR", None, None, "BR", ""]
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        apply(spark, ["T1"], lambda c: text.country_of_sale(c, strict=True))


def test_distribution_description_is_null_without_a_part(spark):
    result = apply(
        spark, ["2024_Q1", None], lambda q: text.distribution_description(F.lit("subs_music"), q)
    )
    assert result == ["YOUTUBE SUBS_MUSIC 2024_Q1", None]


def test_song_code_wildcard_and_remove_all(spark):
    codes = ["C_12", "CAC_1", "X_1", "C", "C_C_5", None, "XC_1"]
    assert apply(spark, codes, text.clean_song_code) == [
        "12", "CA1", "X_1", "C", "5", None, "XC_1"
    ]
    strict = apply(spark, codes, lambda c: text.clean_song_code(c, strict_prefix=True))
    assert strict == ["12", "CAC_1", "X_1", "C", "C_5", None, "XC_1"]


def test_split_artists(spark):
    names = ["A feat. B", "A, B & C", "-", "", None, "Daft & -", "AC/DC", "craft", "X vs. Y"]
    assert apply(spark, names, text.split_artists) == [
        ["a", "b"], ["a", " b ", " c"], ["-"], [""], None, ["daft ", " -"], ["ac", "dc"], ["craft"],
        ["x", "y"],
    ]


def test_separators_are_a_parameter(spark):
    result = apply(spark, ["a x b, c"], lambda c: text.split_artists(c, marks=(), words=("x",)))
    assert result == [["a", "b, c"]]


def test_path_name_and_tags(spark):
    assert apply(spark, ["Yo No", None], text.path_name) == ["Yo_No", None]
    assert apply(spark, [["a", "b"], []], text.tags_text, "array<string>") == ["a, b", ""]


UTC = [
    ("2024-01-05T00:00:00.000Z", "2024-01-05"),
    ("2024-1-5T00:00:00.000Z", "2024-01-05"),
    ("2024-13-01T00:00:00.000Z", "2024-13-01T00:00:00.000Z"),
    ("2024-01-05T00:00:00Z", "2024-01-05T00:00:00Z"),
    ("2024-01-05T10:00:00.000Z", "2024-01-05T10:00:00.000Z"),
    ("24-01-05T00:00:00.000Z", "24-01-05T00:00:00.000Z"),
    ("2024-01T00:00:00.000Z", "2024-01T00:00:00.000Z"),
    ("nonsense", "nonsense"),
    ("", ""),
    (None, None),
]


def test_utc_midnight_date(spark):
    given_, expected = zip(*UTC)
    assert apply(spark, given_, dates.utc_midnight_date) == list(expected)


def test_full_and_partial_timestamp(spark):
    zeros = ["2024-01-05T00:00:00." + "0" * n for n in range(2, 8)]
    assert apply(spark, zeros, dates.full_timestamp_date) == [
        zeros[0], "2024-01-05", "2024-01-05", "2024-01-05", "2024-01-05", zeros[5]
    ]
    assert apply(spark, ["2024-02-30T00:00:00", "2024-02-29T00:00:00"],
                 dates.partial_timestamp_date) == ["2024-02-30T00:00:00", "2024-02-29"]


def test_epoch_and_any_timestamp(spark):
    assert apply(spark, [0, 86_399_999, 86_400_000, -1, None], dates.epoch_ms_date, "bigint") == [
        "1970-01-01", "1970-01-01", "1970-01-02", "1969-12-31", None
    ]
    written = ["2024-01-01T23:30:00-05:00", "2024-01-01", "2024-01-01T00:00:00.000Z", None]
    assert apply(spark, written, dates.timestamp_text_date) == ["2024-01-01"] * 3 + [None]


def test_trailing_window_is_inclusive(spark):
    as_of = F.lit("2024-06-30").cast("date")
    days = ["2021-07-01", "2021-07-02", "2024-06-30", "2024-07-01"]
    inside = apply(spark, days, lambda d: dates.in_trailing_days(d.cast("date"), as_of))
    assert inside == [True, True, True, False]
    assert apply(spark, ["2024-08-31"], lambda d: dates.months_before(d.cast("date")).cast("string")) \
        == ["2024-02-29"]


def test_shares_and_units(spark):
    frame = spark.createDataFrame([(3.0, 2.0), (3.0, 0.0), (2.0, 4.0)], "a double, b double")
    assert column(frame.select(numbers.usage_share(F.col("a"), F.col("b")).alias("r")), "r") == [
        1.5, None, 0.5
    ]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        frame.select(numbers.usage_share(F.col("a"), F.col("b"), strict=True)).collect()
    assert apply(spark, [0.0, 0.1, 2.0, -1.5, None], numbers.whole_units, "double") == [
        0, 1, 2, -1, None
    ]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.sampled_from("abC_ "), min_size=0, max_size=8).map("".join))
def test_song_code_matches_plain_python(spark, code):
    cleaned = apply(spark, [code], text.clean_song_code)[0]
    matches = len(code) >= 2 and code[0] == "C"
    assert cleaned == (code.replace("C_", "") if matches else code)
