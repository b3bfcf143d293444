"""Statistics of tracks over time, and tracks against the catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staveline.functions.dates import TRAILING_DAYS, in_trailing_days, timestamp_text_date
from staveline.operators.match import catalogue_match
from staveline.operators.nested import flatten, path_or_null
from staveline.operators.series import item_points

# Platforms whose statistics are followed.
PLATFORMS = ("spotify", "youtube", "soundcloud", "shazam", "tiktok", "genius")


def stat_history(
    stats: DataFrame, as_of: Column | None = None, days: int = TRAILING_DAYS
) -> DataFrame:
    """Points with a value, and the step from the point before.

    ``stats`` has one row per request: Artist, Track, ISRC, Platform and the
    payload, a list of series. Each series is one list, so the whole job is a
    projection without a shuffle. ``as_of`` keeps the points of the days up to
    that date.
    """
    listed = stats.where(F.col("Platform").isin(list(PLATFORMS)))
    tags = ["Artist", "Track", "ISRC", "Platform"]
    items = listed.select(*tags, F.explode("obj").alias("item"))
    data = F.col("item.data")
    if as_of is not None:
        data = F.filter(data, lambda p: in_trailing_days(_written_day(p), as_of, days))
    rows = items.select(*tags, F.explode(item_points(data)).alias("p"))
    return rows.select(
        *tags,
        F.col("p.point.value").alias("Value"),
        timestamp_text_date(F.col("p.point.timestp")).alias("Date"),
        F.col("p.difference").alias("Value_Diff"),
    )


def _written_day(point: Column) -> Column:
    return point.getField("timestp").cast("timestamp_ntz").cast("date")


def history_by_artist(tracks: DataFrame, stats: DataFrame, **window) -> DataFrame:
    """History of all tracks of the seed artists.

    ``tracks``: seed ``artist`` and the list of its tracks; ``stats``:
    ``track_id``, ``platform`` and payload.
    """
    flat = flatten(tracks, keep=["artist"])
    named = flat.select(
        F.col("id").alias("track_id"),
        F.col("artist").alias("Artist"),
        F.col("name").alias("Track"),
        F.col("isrc").alias("ISRC"),
    )
    return stat_history(stats.withColumnRenamed("platform", "Platform").join(named, "track_id"), **window)


def history_by_isrc(
    ids: DataFrame, metadata: DataFrame, stats: DataFrame, id_field: str = "ids", **window
) -> DataFrame:
    """History of ISRCs: the first id of each, named by its first artist.

    ``ids``: ``isrc`` and the id lists found for it; ``metadata``: ``track_id``
    and the track; ``stats``: ``track_id``, ``platform`` and payload.
    """
    first = ids.select(
        F.col("isrc").alias("ISRC"),
        F.get(path_or_null(ids, "obj", id_field), F.lit(0)).alias("track_id"),
    )
    named = metadata.select(
        "track_id",
        path_or_null(metadata, "obj", "name").alias("Track"),
        path_or_null(metadata, "obj", "artists.name").alias("Artist"),
    )
    seeds = first.where(F.col("track_id").isNotNull()).join(named, "track_id")
    return stat_history(stats.withColumnRenamed("platform", "Platform").join(seeds, "track_id"), **window)


def tracks_of_artists(tracks: DataFrame) -> DataFrame:
    """All tracks of the seed artists, flat, with the seed ``artist``."""
    return flatten(tracks, keep=["artist"])


def matched_tracks(tracks: DataFrame, perf: DataFrame) -> DataFrame:
    """Tracks of the seed artists against the catalogue."""
    return catalogue_match(tracks_of_artists(tracks), perf)
