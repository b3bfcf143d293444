"""Rules of the metric jobs that their queries do not show."""

import pytest
from pyspark.sql import functions as F

from staveline.plans import artists, audio, history, tracks
from staveline.plans.naming import Provider
from staveline.sources.landed import parse_bare, parse_landed
from tests.helpers import column, rows


def docs(spark, bodies, kind, tags="", bare=False):
    names = [t.split()[0] for t in tags.split(",")] if tags else []
    schema = (tags + ", " if tags else "") + "body string"
    frame = spark.createDataFrame([(*b[: len(names)], b[-1]) for b in bodies], schema)
    return (parse_bare if bare else parse_landed)(frame, "body", kind)


def test_provider_names():
    acme = Provider("Acme")
    assert (acme.label("Track ID"), acme.member("ids")) == ("Acme Track ID", "acme_ids")
    assert (Provider().label("Track ID"), Provider().member("ids")) == ("Track ID", "ids")


def test_artist_text_can_be_dropped(spark):
    frame = docs(
        spark,
        [('{"obj": {"id": 1, "name": "n", "cm_statistics": {"a": 1}, "cover_url": "u", '
          '"genres": {"primary": {"name": "pop", "id": 3}}}}',)],
        "struct<id: long, name: string, cm_statistics: struct<a: long>, cover_url: string, "
        "genres: struct<primary: struct<name: string, id: long>>>",
    )
    assert artists.artist_metadata(frame).columns == [
        "Artist ID", "Artist Name", "cm.artist.primaryGenre"
    ]
    assert artists.artist_metadata(frame, keep_text=False).columns == [
        "Artist ID", "cm.artist.primaryGenre"
    ]
    listed = artists.artist_metadata(frame, dropped=["cm_statistics.a"])
    assert "cover_url" in listed.columns and "cm_statistics.a" not in listed.columns


def test_tatums_come_from_tatums(spark):
    frame = docs(
        spark,
        [("s1", '{"tempo": 1.0, "bars": [{"start": 1.0}], "beats": [], "sections": [], '
                '"segments": [], "tatums": [{"start": 5.0}, {"start": 6.0}]}')],
        "struct<tempo: double, bars: array<struct<start: double>>, "
        "beats: array<struct<start: double>>, sections: array<struct<start: double>>, "
        "segments: array<struct<start: double>>, tatums: array<struct<start: double>>>",
        "track_id string", bare=True,
    )
    tables = audio.audio_analysis(frame)
    assert column(tables["tatums"], "start", "Tatum Number") == [(5.0, 1), (6.0, 2)]
    assert tables["track"].columns == ["Spotify Track ID", "tempo"]


def test_fan_metric_copies_differ_only_in_dropped_columns(spark):
    point = '{"timestp": "2024-01-01T00:00:00.000Z", "value": 1.0, "diff": 0.0, "weekly_diff": %d}'
    body = '{"obj": {"followers": [%s, %s], "unknown": [%s]}}' % (point % 1, point % 2, point % 3)
    frame = docs(
        spark, [(1, "spotify", body)],
        "map<string, array<struct<timestp: string, value: double, diff: double, weekly_diff: long>>>",
        "artist_id int, platform string",
    )
    assert rows(artists.fan_metrics(frame)) == [(1, "2024-01-01", "followers", "spotify", 1.0, 0.0)]


STATS = "array<struct<data: array<struct<value: double, timestp: string>>>>"


def test_history_keeps_series_apart(spark):
    body = ('{"obj": [{"data": [{"value": 1, "timestp": "2024-01-01"}, {"timestp": "2024-01-02"}, '
            '{"value": 4, "timestp": "2024-01-03"}]}, {"data": [{"value": 9, "timestp": "2024-01-01"}]}, '
            '{"data": []}]}')
    frame = docs(spark, [("a", "t", "i", "spotify", body), ("a", "t", "i", "radio", body)], STATS,
                 "Artist string, Track string, ISRC string, Platform string")
    assert column(history.stat_history(frame), "Value", "Value_Diff", "Date") == [
        (1.0, None, "2024-01-01"), (4.0, 3.0, "2024-01-03"), (9.0, None, "2024-01-01")
    ]


def test_history_of_the_trailing_days_starts_anew(spark):
    body = ('{"obj": [{"data": [{"value": 1, "timestp": "2024-01-01T00:00:00.000Z"}, '
            '{"value": 4, "timestp": "2024-01-03"}, {"value": 6, "timestp": "2024-01-04"}]}]}')
    frame = docs(spark, [("a", "t", "i", "spotify", body)], STATS,
                 "Artist string, Track string, ISRC string, Platform string")
    found = history.stat_history(frame, F.lit("2024-01-03").cast("date"), days=1)
    assert column(found, "Value", "Value_Diff") == [(4.0, None)]
    assert history.stat_history(frame, F.lit("2024-01-03").cast("date")).count() == 2


def test_history_of_each_artist_is_its_own(spark):
    tracks_ = docs(spark, [("x", '{"obj": [{"id": 1, "name": "one", "isrc": "I"}]}'),
                           ("y", '{"obj": [{"id": 2, "name": "two", "isrc": "J"}]}')],
                   "array<struct<id: long, name: string, isrc: string>>", "artist string")
    body = '{"obj": [{"data": [{"value": 1, "timestp": "2024-01-01"}]}]}'
    stats = docs(spark, [(1, "spotify", body), (2, "spotify", body)], STATS,
                 "track_id long, platform string")
    found = history.history_by_artist(tracks_, stats)
    assert sorted(column(found, "Artist", "Track")) == [("x", "one"), ("y", "two")]


def test_airplay_rejects_other_ids(spark):
    with pytest.raises(ValueError):
        tracks.airplay(spark.range(1), "album")


def test_market_parts_may_be_missing(spark):
    kind = ("struct<insights: struct<cities: array<struct<params_id: string, timestp: string, name: string, "
            "lat: double, lng: double, code2: string, city_id: long, region: string, "
            "current_max_count: long, rank: long, trend: array<struct<timestp: string, monthlyviews: long>>>>>, "
            "marketInsights: struct<marketCities: array<struct<youtubeforartist_location: string, name: string, "
            "lat: double, lng: double, code2: string, city_id: long, region: string, value: long, "
            "prev_value: long, weight: double, market_max_cm_artist_id: long, "
            "market_max_artist_name: string>>>, artistTotalViews: long>")
    frame = docs(spark, [(1, '{"obj": {"artistTotalViews": 7}}')], kind, "artist_id long")
    parts = artists.video_market(frame, F.lit("2024-01-31").cast("date"))
    assert [parts[p].count() for p in ("trends", "markets", "totals")] == [0, 0, 1]
    assert parts["totals"].first()["Current Date"] == "2024-01-31"
