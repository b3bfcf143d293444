"""Jobs on artist responses; same frame shape as the track jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staveline.functions.dates import utc_midnight_date
from staveline.functions.text import tags_text
from staveline.operators.frames import drop_columns, rename, stack_outer, tag_with_reference
from staveline.operators.nested import first_element, flatten, map_rows, record_path
from staveline.plans.naming import NO_PROVIDER, Provider
from staveline.plans.tracks import single_ids

# Metrics, audience figures and columns that are read or dropped.
FAN_METRICS = {
    "spotify": ["followers", "popularity", "listeners", "followers_to_listeners_ratio"],
    "facebook": ["likes", "talks"],
    "twitter": ["followers", "retweets"],
    "youtube_channel": ["subscribers", "views", "comments", "videos"],
    "youtube_artist": ["daily_views", "monthly_views"],
    "tiktok": ["followers", "likes"],
}
AUDIENCE_SHORT = [("instagram", "followers"), ("tiktok", "followers"), ("youtube", "followers")]
AUDIENCE_LONG = [
    ("instagram", "likes"), ("instagram", "followers"), ("tiktok", "followers"),
    ("youtube", "followers"), ("youtube", "commenters"),
]
AUDIENCE = {
    "stat": AUDIENCE_SHORT,
    "language": AUDIENCE_LONG,
    "country": AUDIENCE_LONG,
    "demographic": AUDIENCE_LONG,
}
AUDIENCE_DROPPED = ["avg_likes_per_post", "avg_comments_per_post", "avg_views_per_post"]
ARTIST_DROPPED_PREFIX = "cm_statistics."
ARTIST_DROPPED = [
    "topTracks", "cover_url", "image_url", "type", "gender_title", "current_city_id",
    "band_members", "record_label", "genres.primary.id", "code2", "topSongwriterId",
    "booking_agent", "general_manager", "press_contact", "rank_eg", "rank_fb",
    "topSongwriterCollaborators", "genres.primary.link_type", "created_at",
    "artist_stage.career_stage", "artist_stage.carrer_stage_score", "artist_stage.career_growth",
    "artist_stage.career_growth_score", "band", "gender", "isni", "tags",
]
# Also dropped unless asked for, although a label for them exists.
ARTIST_TEXT = ["description", "name"]
ARTIST_LABELS = {
    "id": "Artist ID",
    "name": "Artist Name",
    "cm_artist_rank": "Current Artist Rank",
    "cm_artist_score": "Artist Score",
    "description": "Artist Description",
    "genres.primary.score": "Artist Primary Genre Score",
    "genres.secondary": "Artist Secondary Genre",
    "genres.sub": "Artist Sub Genre",
}
LISTENER_FIELDS = {
    "timestp": "Metric Date",
    "code2": "Metric Country Code",
    "region": "Metric Type",
    "listeners": "Listeners",
    "artist_city_rank": "Artist City Rank",
    "population": "Region Population",
}
REGION_FIELDS = {
    "name": "Region Name",
    "lat": "Region Latitude",
    "lng": "Region Longitude",
    "code2": "Region Country Code",
    "city_id": "Region City ID",
    "region": "Region Type",
}
ARTIST_ID_LISTS = {
    "spotify_artist_ids": "Spotify ID",
    "itunes_artist_ids": "Apple ID",
    "deezer_artist_ids": "Deezer ID",
    "amazon_artist_ids": "Amazon ID",
}


def artist_metadata(
    df: DataFrame, provider: Provider = NO_PROVIDER, keep_text: bool = True,
    dropped: Sequence[str] | None = None,
) -> DataFrame:
    """Flat artist profile without statistics.

    ``keep_text`` keeps name and description. ``dropped`` replaces the prefix
    rule by a list of names.
    """
    flat = flatten(df)
    text = [] if keep_text else ARTIST_TEXT
    if dropped is None:
        pruned = drop_columns(flat, [*ARTIST_DROPPED, *text], [ARTIST_DROPPED_PREFIX])
    else:
        pruned = drop_columns(flat, dropped)
    labels = {old: provider.label(new) for old, new in ARTIST_LABELS.items()}
    return rename(pruned, {**labels, "genres.primary.name": "cm.artist.primaryGenre"})


def artist_crosswalk(df: DataFrame, provider: Provider = NO_PROVIDER) -> DataFrame:
    """One row per artist with its id lists; one-element lists also as a value."""
    first = first_element(F.col("obj"))
    rows = df.select(
        first.getField(provider.member("id")).alias(provider.label("Artist ID")),
        first.getField("artist_name").alias("Artist Name"),
        *[first.getField(old).alias(new) for old, new in ARTIST_ID_LISTS.items()],
    )
    return single_ids(rows, list(ARTIST_ID_LISTS.values()))


def fan_metrics(df: DataFrame, provider: Provider = NO_PROVIDER) -> DataFrame:
    """Listed fan metrics of each platform as one long series, copies removed."""
    listed = [
        {"platform": platform, "metric": metric}
        for platform, metrics in FAN_METRICS.items() for metric in metrics
    ]
    rows = map_rows(df, F.col("obj"), "metric", keep=["artist_id", "platform"])
    chosen = tag_with_reference(rows, listed, ["platform", "metric"])
    return chosen.select(
        F.col("artist_id").alias(provider.label("Artist ID")),
        F.col("platform").alias("Metric Platform"),
        F.col("metric").alias("Metric Name"),
        utc_midnight_date(F.col("timestp")).alias("Artist Metric Date"),
        F.col("value").alias("Metric Value"),
        F.col("diff").alias("Metric Value Difference"),
    ).distinct()


def _region() -> list[Column]:
    return [F.col(old).alias(new) for old, new in REGION_FIELDS.items()]


def video_market(
    df: DataFrame, as_of: Column, provider: Provider = NO_PROVIDER
) -> dict[str, DataFrame]:
    """Video views of an artist: city trends, market share and the total."""
    artist = provider.label("Artist ID")

    def head(kind: str) -> list[Column]:
        return [
            F.col("artist_id").alias(artist),
            F.lit("YouTube").alias("Platform"),
            F.lit(kind).alias("Metric Type"),
        ]

    trend_parents = [
        "params_id", "timestp", *REGION_FIELDS, "current_max_count", "rank",
    ]
    cities = df.select("artist_id", F.explode("obj.insights.cities").alias("obj"))
    trends = record_path(
        cities, ["trend"], meta=[[p] for p in trend_parents], record_prefix="trend.",
        keep=["artist_id"],
    )
    today = F.date_format(as_of, "yyyy-MM-dd").alias("Current Date")
    markets = flatten(
        df.select("artist_id", F.col("obj.marketInsights.marketCities").alias("obj")),
        keep=["artist_id"],
    )
    return {
        "trends": trends.select(
            *head("Views Insights"),
            F.col("params_id").alias("Metric Query ID"),
            F.col("timestp").alias("Current Date"),
            *_region(),
            F.col("current_max_count").alias("Region Current Max Count"),
            F.col("rank").alias("Region Current Rank for Artist"),
            F.col("`trend.timestp`").alias("Region Historical Views Timestamp"),
            F.col("`trend.monthlyviews`").alias("Region Historical Views Count"),
        ),
        "markets": markets.select(
            *head("Views Market Coverage"),
            F.col("youtubeforartist_location").alias("Metric Query ID"),
            today,
            *_region(),
            F.col("value").alias("Region Current Number of Views"),
            F.col("prev_value").alias("Region Previous Number of Views"),
            F.col("weight").alias("Region Views Market Share"),
            F.col("market_max_cm_artist_id").alias(
                "Region Leading " + provider.label("Artist ID")
            ),
            F.col("market_max_artist_name").alias("Region Leading Artist Name"),
        ),
        "totals": df.where(F.col("obj.artistTotalViews").isNotNull()).select(
            *head("Total Artist Views"),
            today,
            F.col("obj.artistTotalViews").alias("Current Metric Value"),
        ),
    }


def social_audience(df: DataFrame, kind: str, provider: Provider = NO_PROVIDER) -> DataFrame:
    """Audience figures of one kind: stat, language, country or demographic."""
    listed = [
        {"platform": p, "audience": a, "Metric": a.capitalize()} for p, a in AUDIENCE[kind]
    ]
    rows = flatten(df.where(F.col("kind") == kind), keep=["artist_id", "platform", "audience"])
    tagged = tag_with_reference(rows, listed, ["platform", "audience"])
    return drop_columns(tagged, ["audience", *AUDIENCE_DROPPED]).withColumnsRenamed(
        {"artist_id": provider.label("Artist ID"), "platform": "Platform"}
    )


def listeners(df: DataFrame, provider: Provider = NO_PROVIDER) -> DataFrame:
    """Monthly listeners by city and by country."""
    parts = [
        map_rows(df, F.col(f"obj.{dimension}"), "Region Name", keep=["artist_id"])
        for dimension in ("cities", "countries")
    ]
    rows = stack_outer(*parts).withColumnsRenamed(
        {**LISTENER_FIELDS, "artist_id": provider.label("Artist ID")}
    )
    return rows.withColumn("Platform", F.lit("Spotify")).withColumn(
        "Metric Date", utc_midnight_date(F.col("Metric Date"))
    )


# Label -> field of the playlist, or of a track on it.
PLAYLIST_LABELS = {
    "Playlist ID": "id",
    "Playlist Name": "name",
    "Track Peak Position": "track.peak_position",
    "Current Track Position": "track.position",
    "Monthly Change in Followers": "fdiff_month",
    "Weekly Change in Followers": "fdiff_week",
    "Playlist Track Addition Date": "track.added_at",
    "Playlist Track Removal Date": "track.removed_at",
    "Playlist Track Inclusion Period": "track.period",
    "Playlist Latest Followers Count": "followers",
    "Playlist Country Code": "code2",
    "Playlist Curator": "curator_name",
    "Personalized Playlist": "personalized",
    "Official Playlist": "official",
    "Playlist Tags": "tags",
    "Playlist Latest Track Count": "num_tracks",
    "Playlist Active Ratio": "active_ratio",
    "Last Track Position on Playlist": "last_position",
    "Peak Track Position on Playlist": "peak_position",
    "Track ISRC": "track.isrc",
    "Platform Track ID": "track.spotify_track_ids",
    "Track ID": "track.cm_track",
    "Artist ID": "track.cm_artist",
    "Platform Track Genres": "track.genres",
}
PROVIDER_IDS = ("track.cm_track", "track.cm_artist")
PLAYLIST_LISTS = ("tags", "track.genres")


def artist_playlists(df: DataFrame, provider: Provider = NO_PROVIDER) -> DataFrame:
    """Playlists an artist's tracks are on: one row per playlist and track."""
    of_playlist = [[f] for f in PLAYLIST_LABELS.values() if not f.startswith("track.")]
    rows = record_path(df, ["tracks"], meta=of_playlist, record_prefix="track.", keep=["artist"])

    def labelled(label: str, name: str) -> Column:
        value = F.col(f"`{name}`")
        value = tags_text(value) if name in PLAYLIST_LISTS else value
        return value.alias(provider.label(label) if name in PROVIDER_IDS else label)

    return rows.select("artist", *[labelled(k, v) for k, v in PLAYLIST_LABELS.items()])


def linked_artists(df: DataFrame) -> DataFrame:
    """Related or neighbouring artists, all fields flat, with the seed ``artist``."""
    return flatten(df, keep=["artist"])
