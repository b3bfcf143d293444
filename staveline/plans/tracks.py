"""Jobs on track responses.

Every job takes a frame with the typed payload in ``obj`` and the tags of the
request (``track_id``, ``platform``, ...) as columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staveline.functions.dates import epoch_ms_date, timestamp_date, utc_midnight_date
from staveline.operators.frames import (
    drop_all_null,
    present,
    quoted,
    select_attributes,
    stack_outer,
    tag_with_reference,
)
from staveline.operators.nested import (
    double_explode,
    first_element,
    flatten,
    map_rows,
    path_or_null,
    record_path,
    renamed_fields,
    unwrap_single,
)
from staveline.operators.series import record_days
from staveline.plans.naming import NO_PROVIDER, Provider

# Charts, statistics and playlist fields that are read.
CHARTS = [
    {"chart_id": "spotify_top_daily", "Platform": "Spotify", "Chart Frequency": "Daily",
     "Chart Type": "Top"},
    {"chart_id": "spotify_viral_daily", "Platform": "Spotify", "Chart Frequency": "Daily",
     "Chart Type": "Viral"},
    {"chart_id": "applemusic_daily", "Platform": "Apple Music", "Chart Frequency": "Daily",
     "Chart Type": "Top"},
]
PEAK_ATTRIBUTES = ["cm_track", "isrc", "code2", "peak_rank", "peak_date"]
TRACK_STATISTICS = [
    {"platform": "spotify", "stat": "streams"},
    {"platform": "spotify", "stat": "popularity"},
    {"platform": "youtube", "stat": "views"},
    {"platform": "shazam", "stat": "play_counts"},
    {"platform": "soundcloud", "stat": "play_counts"},
    {"platform": "tiktok", "stat": "post_counts"},
]
VIDEO_PARENTS = [
    "created_at", "username", "video_id", "thumbnail_url", "followers", "cm_id", "sound_id",
    "tiktok", "tiktok_video", "link",
]
PLAYLIST_FIELDS = {
    "spotify": [
        "playlist_id", "peak_position", "position", "added_at", "removed_at", "period",
        "followers", "id", "name", "description", "sys_last_updated", "personalized",
        "owner_name", "owner_id", "official", "tags", "num_track", "catalog", "active_ratio",
    ],
    "applemusic": [
        "playlist_id", "track_id", "min_position", "min_added_at", "min_removed_at",
        "num_countries", "peak_position", "max_period", "id", "name", "description",
        "curator_id", "with_storefronts", "sys_last_updated", "code2", "owner_id", "owner_name",
        "official", "storefronts", "last_added", "last_removed", "num_track", "tags", "catalog",
        "active_ratio", "period", "position", "added_at", "removed_at",
    ],
    "deezer": [
        "playlist_id", "peak_position", "position", "added_at", "removed_at", "period",
        "followers", "id", "name", "description", "sys_last_updated", "owner_name", "owner_id",
        "official", "tags", "num_track", "catalog", "active_ratio",
    ],
}
PLAYLIST_DETAILS = "applemusic"
EVOLUTION_PLATFORMS = ("spotify", "youtube")
EVOLUTION_FIELDS = {
    "created_at": "Metric Date",
    "playlist_count": "Playlist Count",
    "ed_playlist_count": "Editorial Playlist Count",
    "playlist_total_reach": "Playlist Total Reach",
    "ed_playlist_total_reach": "Editorial Playlist Total Reach",
}


def track_crosswalk(df: DataFrame, provider: Provider = NO_PROVIDER) -> DataFrame:
    """ISRC to track ids: every pairing of the ids listed for it."""
    track = provider.label("Track ID")
    rows = renamed_fields(
        flatten(df), {"isrc": "isrc", provider.member("ids"): track, "spotify_ids": "Spotify ID"}
    )
    return double_explode(rows, track, "Spotify ID")


def track_id_lists(df: DataFrame, provider: Provider = NO_PROVIDER) -> DataFrame:
    """The same with the id lists of the first result left whole; ``isrc`` is a tag."""
    first = first_element(F.col("obj"))
    return df.select(
        "isrc",
        first.getField(provider.member("ids")).alias(provider.label("Track ID")),
        first.getField("spotify_ids").alias("Spotify ID"),
    )


def chart_rows(df: DataFrame) -> DataFrame:
    """All chart positions with platform, frequency and type of their chart."""
    rows = record_path(df, ["data"], keep=["chart_id"])
    return tag_with_reference(rows, CHARTS, ["chart_id"]).drop("chart_id")


def peak_charts(df: DataFrame, provider: Provider = NO_PROVIDER) -> DataFrame:
    """Peak rank and date per chart, dates as plain date text."""
    rows = select_attributes(
        record_path(df, ["data"], keep=["chart_id"]), ["chart_id", *PEAK_ATTRIBUTES]
    )
    tagged = tag_with_reference(rows, CHARTS, ["chart_id"])
    return tagged.select(
        F.col("cm_track").alias(provider.label("Track ID")),
        "isrc",
        F.col("code2").alias("Chart Country"),
        F.col("peak_rank").alias("Track Peak Rank"),
        utc_midnight_date(F.col("peak_date")).alias("Track Peak Date"),
        F.lit(None).cast("string").alias("Chart City"),
        "Platform",
        "Chart Frequency",
        "Chart Type",
    )


def stacked_charts(*charts: DataFrame) -> DataFrame:
    """Rows of several chart responses; a field one of them lacks is NULL."""
    return stack_outer(*[record_path(c, ["data"]) for c in charts])


def video_history(df: DataFrame) -> DataFrame:
    """One row per history point of a video, with fields of the video."""
    rows = record_path(
        df, ["tiktokVideoHistoricalStats"], meta=[[p] for p in VIDEO_PARENTS],
        record_prefix="video.", keep=["track_id"],
    )
    return rows.withColumnRenamed("track_id", "cm_track_id")


def track_metadata(df: DataFrame, provider: Provider = NO_PROVIDER) -> DataFrame:
    """Track id with first artist, its creation date, and first album."""
    created = timestamp_date(path_or_null(df, "obj", "artists.created_at").cast("string"))
    return df.select(
        path_or_null(df, "obj", "id").alias(provider.label("Track ID")),
        path_or_null(df, "obj", "artists.id").alias("CM.artist.id"),
        created.alias("CM.primaryArtist.createDt"),
        path_or_null(df, "obj", "albums.id").alias("CM.album.id"),
    )


def track_stats(df: DataFrame, provider: Provider = NO_PROVIDER) -> DataFrame:
    """Statistics of the listed (platform, stat) pairs as one long series."""
    listed = tag_with_reference(present(df, "track_id"), TRACK_STATISTICS, ["platform", "stat"])
    rows = record_path(listed, ["data"], keep=["platform", "stat", "track_id"])
    return rows.select(
        F.col("platform").alias("Track Metric Platform"),
        F.col("stat").alias("Track Metric Name"),
        F.col("track_id").alias(provider.label("Track ID")),
        F.col("value").alias("Track Metric Value"),
        utc_midnight_date(F.col("timestp")).alias("Track Metric Date"),
        F.col("diff").alias("Track Metric Difference"),
    )


def playlist_requests(tracks: DataFrame, provider: Provider = NO_PROVIDER) -> DataFrame:
    """Tracks to look up: distinct (id, release date), rows without either left out."""
    wanted = select_attributes(tracks, [provider.label("Track ID"), "release_date"])
    return drop_all_null(wanted.distinct())


def track_playlists(df: DataFrame, platform: str, provider: Provider = NO_PROVIDER) -> DataFrame:
    """Playlist rows of one platform; stack the platforms with ``stack_outer``."""
    rows = df.where(F.col("platform") == platform)
    fields = PLAYLIST_FIELDS[platform]
    if platform == PLAYLIST_DETAILS:
        out = record_path(
            rows, ["playlist", "details"], meta=[["playlist", f] for f in fields],
            keep=["track_id"],
        )
    else:
        out = select_attributes(
            flatten(rows, keep=["track_id"]), ["track_id", *[f"playlist.{f}" for f in fields]]
        )
    return out.withColumn("playlist.platform", F.lit(platform)).withColumnRenamed(
        "track_id", provider.label("Track ID")
    )


def all_track_playlists(
    frames: dict[str, DataFrame], provider: Provider = NO_PROVIDER
) -> DataFrame:
    return stack_outer(*[track_playlists(df, p, provider) for p, df in frames.items()])


def playlist_evolution(
    df: DataFrame, entity: str, provider: Provider = NO_PROVIDER
) -> DataFrame:
    """Playlist counts and reach over time, for ``artist`` or ``track`` responses."""
    kind = entity.capitalize()
    rows = map_rows(
        df, F.map_filter("obj", lambda k, _: k.isin(list(EVOLUTION_PLATFORMS))), "Platform",
        keep=["id"],
    )
    names = {
        old: (new if kind == "Artist" and old == "created_at" else f"{kind} {new}")
        for old, new in EVOLUTION_FIELDS.items()
    }
    return rows.withColumnsRenamed(names).withColumnRenamed("id", provider.label(f"{kind} ID"))


def record_dates(tracks: DataFrame, provider: Provider = NO_PROVIDER) -> DataFrame:
    """Track x day from album release to end date."""
    return record_days(
        tracks, "Album Release Date", "End Date", "Record Date", keep=[provider.label("Track ID")]
    )


def airplay(df: DataFrame, id_type: str, provider: Provider = NO_PROVIDER) -> DataFrame:
    """Radio spins per day of an artist or a track."""
    if id_type not in ("artist", "track"):
        raise ValueError("id_type is 'artist' or 'track'")
    rows = flatten(df, keep=["id"])
    label = provider.label("Track ID" if id_type == "track" else "Artist ID")
    return (
        rows.withColumn("Metric Date", epoch_ms_date(F.col("air_date")))
        .drop("air_date")
        .withColumnsRenamed({"id": label, "spins": f"cm.{id_type}.numberAirplaySpins"})
    )


def first_hit(df: DataFrame, member: str, id_field: str = "id") -> DataFrame:
    """Search responses to ids: the first result, NULL when there is none."""
    return df.select(
        "query", path_or_null(df, "obj", f"{member}.{id_field}").cast("long").alias("id")
    )


def single_ids(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``<column> (single)`` with the only id of one-element lists."""
    return df.withColumns(
        {f"{c} (single)": unwrap_single(F.col(quoted(c))) for c in columns}
    )
