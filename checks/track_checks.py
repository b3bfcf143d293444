"""Track jobs on landed responses made from the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.frame_checks import PERF_SQL, perf
from checks.landed import choice, choice_sql, day, landed, landed_bare, midnight, record, source, tagged, text
from checks.registry import check, table
from staveline.operators.frames import stack_outer
from staveline.plans import audio, history, tracks
from staveline.plans.naming import Provider

ACME = Provider("Acme")
CODES = ["FR", "CO", "BR", "US"]
CHART_IDS = ["spotify_top_daily", "spotify_viral_daily", "applemusic_daily", "unlisted"]


# --- ids and search ---------------------------------------------------------------

ID_PAYLOAD = "array<struct<isrc: string, acme_ids: array<bigint>, spotify_ids: array<string>>>"


def _track_ids(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("p_partkey")
    found = record(
        isrc=tagged("ISRC", key),
        acme_ids=F.slice(F.array(key, key + 100000), F.lit(1), F.col("p_size") % 3),
        spotify_ids=F.slice(F.array(tagged("s", key), tagged("t", key)), F.lit(1), F.col("p_size") % 2 + 1),
    )
    none = F.array().cast(ID_PAYLOAD)
    obj = F.when(key % 11 == 0, none).otherwise(F.array(found))
    return landed(table(spark, sf, "part"), {"isrc": tagged("ISRC", key)}, obj, ID_PAYLOAD)


@check("track_crosswalk", """
SELECT isrc, "Acme Track ID", unnest(CASE WHEN p_size % 2 = 0 THEN ['s' || k]
    ELSE ['s' || k, 't' || k] END) AS "Spotify ID"
FROM (SELECT p_partkey AS k, p_size, 'ISRC' || p_partkey AS isrc,
    unnest(CASE p_size % 3 WHEN 0 THEN [NULL] WHEN 1 THEN [p_partkey]
        ELSE [p_partkey, p_partkey + 100000] END) AS "Acme Track ID"
    FROM part WHERE p_partkey % 11 <> 0)""")
def track_crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    return tracks.track_crosswalk(_track_ids(spark, sf).select("obj"), ACME)


@check("track_id_lists", """
SELECT 'ISRC' || p_partkey AS isrc, CASE p_size % 3 WHEN 0 THEN '' WHEN 1 THEN '' || p_partkey
    ELSE p_partkey || ',' || (p_partkey + 100000) END AS "Acme Track ID",
    CASE WHEN p_size % 2 = 0 THEN 's' || p_partkey
        ELSE 's' || p_partkey || ',t' || p_partkey END AS "Spotify ID"
FROM part WHERE p_partkey % 11 <> 0""")
def track_id_lists(spark: SparkSession, sf: str) -> DataFrame:
    rows = tracks.track_id_lists(_track_ids(spark, sf), ACME)
    return rows.select(
        "isrc",
        F.array_join(F.col("Acme Track ID").cast("array<string>"), ",").alias("Acme Track ID"),
        F.array_join("Spotify ID", ",").alias("Spotify ID"),
    )


@check("first_hit", """
SELECT c_name AS query, CASE WHEN c_custkey % 4 > 0 THEN c_custkey * 10 END AS id FROM customer""")
def first_hit(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    hits = F.slice(F.array(*[record(id=key * 10 + i) for i in range(3)]), F.lit(1),
                   (key % 4).cast("int"))
    docs = landed(
        table(spark, sf, "customer"), {"query": F.col("c_name")}, record(artists=hits),
        "struct<artists: array<struct<id: bigint>>>",
    )
    return tracks.first_hit(docs, "artists")


@check("first_hit_track", """
SELECT 'ISRC' || p_partkey AS query, CASE WHEN p_size % 2 = 0 THEN p_partkey + 5 END AS id FROM part""")
def first_hit_track(spark: SparkSession, sf: str) -> DataFrame:
    hits = F.slice(F.array(record(cm_track=F.col("p_partkey") + 5)), F.lit(1), 1 - F.col("p_size") % 2)
    docs = landed(
        table(spark, sf, "part"), {"query": tagged("ISRC", "p_partkey")}, record(tracks=hits),
        "struct<tracks: array<struct<cm_track: bigint>>>",
    )
    return tracks.first_hit(docs, "tracks", "cm_track")


# --- charts -----------------------------------------------------------------------

CHART_PAYLOAD = (
    "struct<length: bigint, data: array<struct<cm_track: bigint, isrc: string, code2: string, "
    "peak_rank: bigint, peak_date: string>>>"
)
CHART_TAGS_SQL = """
JOIN (VALUES ('spotify_top_daily', 'Spotify', 'Daily', 'Top'),
    ('spotify_viral_daily', 'Spotify', 'Daily', 'Viral'),
    ('applemusic_daily', 'Apple Music', 'Daily', 'Top'))
    AS r(chart_id, "Platform", "Chart Frequency", "Chart Type") USING (chart_id)"""
CHART_SQL = f"""
charts AS (
    SELECT {choice_sql("l_linenumber", CHART_IDS)} AS chart_id, l_partkey AS cm_track,
        'ISRC' || l_partkey AS isrc, {choice_sql("l_suppkey", CODES)} AS code2,
        l_linenumber + step AS peak_rank,
        strftime(l_shipdate, '%Y-%m-%d') AS day
    FROM lineitem, range(0, 2) AS r(step)
)"""


def _charts(spark: SparkSession, sf: str) -> DataFrame:
    data = F.array(*[
        record(
            cm_track=F.col("l_partkey"), isrc=tagged("ISRC", "l_partkey"),
            code2=choice(F.col("l_suppkey"), CODES), peak_rank=F.col("l_linenumber") + i,
            peak_date=midnight(F.col("l_shipdate")),
        ) for i in range(2)
    ])
    return landed(
        source(spark, sf, "lineitem"), {"chart_id": choice(F.col("l_linenumber"), CHART_IDS)},
        record(length=F.size(data), data=data), CHART_PAYLOAD,
    )


@check("chart_rows", f"""
WITH {CHART_SQL} SELECT cm_track, isrc, code2, peak_rank, day || 'T00:00:00.000Z' AS peak_date,
    "Platform", "Chart Frequency", "Chart Type" FROM charts {CHART_TAGS_SQL}""")
def chart_rows(spark: SparkSession, sf: str) -> DataFrame:
    return tracks.chart_rows(_charts(spark, sf))


@check("peak_charts", f"""
WITH {CHART_SQL} SELECT cm_track AS "Acme Track ID", isrc, code2 AS "Chart Country",
    peak_rank AS "Track Peak Rank", day AS "Track Peak Date", CAST(NULL AS VARCHAR) AS "Chart City",
    "Platform", "Chart Frequency", "Chart Type" FROM charts {CHART_TAGS_SQL}""")
def peak_charts(spark: SparkSession, sf: str) -> DataFrame:
    return tracks.peak_charts(_charts(spark, sf), ACME)


@check("chart_collection", """
SELECT o_orderkey AS id, o_orderpriority AS name, CAST(NULL AS BIGINT) AS rank FROM orders
UNION ALL SELECT c_custkey, c_name, c_custkey + 1 FROM customer""")
def chart_collection(spark: SparkSession, sf: str) -> DataFrame:
    orders = record(data=F.array(record(id=F.col("o_orderkey"), name=F.col("o_orderpriority"))))
    customers = record(data=F.array(record(
        id=F.col("c_custkey"), name=F.col("c_name"), rank=F.col("c_custkey") + 1
    )))
    return tracks.stacked_charts(
        landed(source(spark, sf, "orders"), {}, orders,
               "struct<data: array<struct<id: bigint, name: string>>>"),
        landed(table(spark, sf, "customer"), {}, customers,
               "struct<data: array<struct<id: bigint, name: string, rank: bigint>>>"),
    )


# --- videos, metadata, statistics ----------------------------------------------------

@check("video_history", """
SELECT event_id AS cm_track_id, user_id + step AS "video.likes", user_id AS "video.comments",
    step AS "video.followers", strftime(ts, '%Y-%m-%d') AS created_at, 'u' || user_id AS username,
    'v' || event_id AS video_id, 't' || event_id AS thumbnail_url, user_id * 2 AS followers,
    event_id AS cm_id, event_type AS sound_id, 'tk' || user_id AS tiktok,
    'tv' || event_id AS tiktok_video, 'l' || event_id AS link
FROM events, range(0, 2) AS r(step) WHERE step < event_id % 3""")
def video_history(spark: SparkSession, sf: str) -> DataFrame:
    user, event = F.col("user_id"), F.col("event_id")
    points = F.slice(
        F.array(*[record(likes=user + i, comments=user, followers=F.lit(i)) for i in range(2)]),
        F.lit(1), (event % 3).cast("int"),
    )
    video = record(
        created_at=day(F.col("ts")), username=tagged("u", user), video_id=tagged("v", event),
        thumbnail_url=tagged("t", event), followers=user * 2, cm_id=event,
        sound_id=F.col("event_type"), tiktok=tagged("tk", user), tiktok_video=tagged("tv", event),
        link=tagged("l", event), tiktokVideoHistoricalStats=points,
    )
    docs = landed(
        source(spark, sf, "events"), {"track_id": event}, F.array(video),
        "array<struct<created_at: string, username: string, video_id: string, "
        "thumbnail_url: string, followers: bigint, cm_id: bigint, sound_id: string, "
        "tiktok: string, tiktok_video: string, link: string, tiktokVideoHistoricalStats: "
        "array<struct<likes: bigint, comments: bigint, followers: bigint>>>>",
    )
    return tracks.video_history(docs)


@check("track_metadata", """
SELECT o_orderkey AS "Acme Track ID", CASE WHEN o_orderkey % 5 > 0 THEN o_custkey END AS "CM.artist.id",
    CASE WHEN o_orderkey % 5 = 0 THEN NULL
        WHEN o_orderkey % 3 = 2 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 10:00'
        ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "CM.primaryArtist.createDt",
    CASE WHEN o_orderkey % 7 > 0 THEN o_orderkey + 1 END AS "CM.album.id"
FROM orders""")
def track_metadata(spark: SparkSession, sf: str) -> DataFrame:
    key, when = F.col("o_orderkey"), day(F.col("o_orderdate"))
    tails = F.array(F.lit("T00:00:00.0000"), F.lit("T00:00:00"), F.lit(" 10:00"))
    created = F.concat(when, F.get(tails, (key % 3).cast("int")))
    artist = record(id=F.col("o_custkey"), name=F.col("o_orderpriority"), created_at=created)
    kind = "array<struct<id: bigint, name: string, created_at: string>>"
    obj = record(
        id=key, name=F.col("o_orderstatus"),
        artists=F.when(key % 5 > 0, F.array(artist)).otherwise(F.array().cast(kind)),
        albums=F.when(key % 7 > 0, F.array(record(id=key + 1), record(id=key + 2))),
    )
    docs = landed(
        source(spark, sf, "orders"), {}, obj,
        f"struct<id: bigint, name: string, artists: {kind}, albums: array<struct<id: bigint>>>",
    )
    return tracks.track_metadata(docs, ACME)


STAT_PAIRS = [
    ("spotify", "streams"), ("spotify", "popularity"), ("youtube", "views"),
    ("shazam", "play_counts"), ("soundcloud", "play_counts"), ("tiktok", "post_counts"),
    ("radio", "spins"),
]
STAT_PAYLOAD = "array<struct<data: array<struct<value: double, timestp: string, diff: double>>>>"


@check("track_stats", f"""
SELECT platform AS "Track Metric Platform", stat AS "Track Metric Name",
    CAST(user_id AS VARCHAR) AS "Acme Track ID", value + step AS "Track Metric Value",
    strftime(ts, '%Y-%m-%d') AS "Track Metric Date",
    CASE WHEN step > 0 THEN CAST(step AS DOUBLE) END AS "Track Metric Difference"
FROM (SELECT *, {choice_sql("event_id", [p for p, _ in STAT_PAIRS])} AS platform,
    {choice_sql("event_id", [s for _, s in STAT_PAIRS])} AS stat FROM events), range(0, 3) AS r(step)
WHERE platform <> 'radio' AND user_id > 10""")
def track_stats(spark: SparkSession, sf: str) -> DataFrame:
    event = F.col("event_id")
    data = F.array(*[
        record(value=F.col("value") + i, timestp=midnight(F.col("ts")),
               diff=F.lit(float(i)) if i else F.lit(None).cast("double"))
        for i in range(3)
    ])
    track = F.when(F.col("user_id") > 10, text("user_id")).when(event % 2 == 0, "")
    docs = landed(
        source(spark, sf, "events"),
        {"track_id": track, "platform": choice(event, [p for p, _ in STAT_PAIRS]),
         "stat": choice(event, [s for _, s in STAT_PAIRS])},
        F.array(record(data=data)), STAT_PAYLOAD,
    )
    return tracks.track_stats(docs, ACME)


# --- playlists --------------------------------------------------------------------------

PLAYLIST_PLATFORMS = list(tracks.PLAYLIST_FIELDS)


def _playlist_frame(spark: SparkSession, sf: str, platform: str) -> DataFrame:
    key = F.col("o_orderkey")
    fields = {f: F.concat(F.lit(f"{f}_"), text(key)) for f in tracks.PLAYLIST_FIELDS[platform]}
    kind = ", ".join(f"{f}: string" for f in fields)
    if platform == tracks.PLAYLIST_DETAILS:
        fields["details"] = F.array(*[
            record(country=F.lit(c), place=F.col("o_custkey") + i) for i, c in enumerate(CODES[:2])
        ])
        kind += ", details: array<struct<country: string, place: bigint>>"
    return landed(
        source(spark, sf, "orders"),
        {"track_id": key, "platform": choice(key, PLAYLIST_PLATFORMS)},
        F.array(record(playlist=F.struct(*[c.alias(n) for n, c in fields.items()]))),
        f"array<struct<playlist: struct<{kind}>>>",
    )


def _playlist_sql() -> str:
    every = [f for p in PLAYLIST_PLATFORMS for f in tracks.PLAYLIST_FIELDS[p]]
    names = list(dict.fromkeys(every))
    parts = []
    for i, platform in enumerate(PLAYLIST_PLATFORMS):
        have = tracks.PLAYLIST_FIELDS[platform]
        columns = ", ".join(
            (f"'{f}_' || o_orderkey" if f in have else "CAST(NULL AS VARCHAR)")
            + f' AS "playlist.{f}"' for f in names
        )
        if platform == tracks.PLAYLIST_DETAILS:
            detail, source = "country, o_custkey + i AS place", (
                f"orders, (VALUES ('{CODES[0]}', 0), ('{CODES[1]}', 1)) AS d(country, i)")
        else:
            detail, source = "CAST(NULL AS VARCHAR) AS country, CAST(NULL AS BIGINT) AS place", "orders"
        parts.append(
            f"SELECT o_orderkey AS \"Acme Track ID\", '{platform}' AS \"playlist.platform\", "
            f"{columns}, {detail} FROM {source} WHERE o_orderkey % {len(PLAYLIST_PLATFORMS)} = {i}"
        )
    return " UNION ALL ".join(parts)


@check("track_playlists", _playlist_sql())
def track_playlists(spark: SparkSession, sf: str) -> DataFrame:
    return tracks.all_track_playlists(
        {p: _playlist_frame(spark, sf, p) for p in PLAYLIST_PLATFORMS}, ACME
    )


@check("playlist_requests", """
SELECT DISTINCT l_partkey AS "Acme Track ID", CASE WHEN l_returnflag = 'A' THEN NULL
    ELSE strftime(l_shipdate, '%Y-%m-%d') END AS release_date FROM lineitem""")
def playlist_requests(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("Acme Track ID"),
        F.when(F.col("l_returnflag") != "A", day(F.col("l_shipdate"))).alias("release_date"),
        "l_quantity",
    )
    return tracks.playlist_requests(rows, ACME)


EVOLUTION_PAYLOAD = (
    "map<string, array<struct<created_at: string, playlist_count: bigint, "
    "ed_playlist_count: bigint, playlist_total_reach: bigint, ed_playlist_total_reach: bigint>>>"
)


def _evolution(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")

    def points(count: int) -> Column:
        return F.array(*[
            record(created_at=day(F.col("o_orderdate")), playlist_count=key + i,
                   ed_playlist_count=F.col("o_custkey"), playlist_total_reach=key * 2,
                   ed_playlist_total_reach=F.lit(i))
            for i in range(count)
        ])

    obj = F.create_map(
        F.lit("spotify"), points(2), F.lit("youtube"), points(1), F.lit("deezer"), points(1)
    )
    return landed(source(spark, sf, "orders"), {"id": key}, obj, EVOLUTION_PAYLOAD)


def _evolution_sql(entity: str, date: str) -> str:
    return f"""
SELECT o_orderkey AS "Acme {entity} ID", platform AS "Platform",
    strftime(o_orderdate, '%Y-%m-%d') AS "{date}", o_orderkey + i AS "{entity} Playlist Count",
    o_custkey AS "{entity} Editorial Playlist Count", o_orderkey * 2 AS "{entity} Playlist Total Reach",
    CAST(i AS BIGINT) AS "{entity} Editorial Playlist Total Reach"
FROM orders, (VALUES ('spotify', 0), ('spotify', 1), ('youtube', 0)) AS p(platform, i)"""


@check("artist_playlist_evolution", _evolution_sql("Artist", "Metric Date"))
def artist_playlist_evolution(spark: SparkSession, sf: str) -> DataFrame:
    return tracks.playlist_evolution(_evolution(spark, sf), "artist", ACME)


@check("track_playlist_evolution", _evolution_sql("Track", "Track Metric Date"))
def track_playlist_evolution(spark: SparkSession, sf: str) -> DataFrame:
    return tracks.playlist_evolution(_evolution(spark, sf), "track", ACME)


# --- airplay and dates --------------------------------------------------------------------

def _airplay(spark: SparkSession, sf: str) -> DataFrame:
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    spins = F.array(record(air_date=ms, spins=F.col("user_id")),
                    record(air_date=ms + 86_400_000, spins=F.col("event_id")))
    return landed(source(spark, sf, "events"), {"id": F.col("event_id")}, spins,
                  "array<struct<air_date: bigint, spins: bigint>>")


def _airplay_sql(entity: str) -> str:
    return f"""
SELECT event_id AS "Acme {entity} ID", strftime(ts + to_days(i), '%Y-%m-%d') AS "Metric Date",
    CASE i WHEN 0 THEN user_id ELSE event_id END AS "cm.{entity.lower()}.numberAirplaySpins"
FROM events, (VALUES (0), (1)) AS r(i)"""


@check("airplay_artist", _airplay_sql("Artist"))
def airplay_artist(spark: SparkSession, sf: str) -> DataFrame:
    return tracks.airplay(_airplay(spark, sf), "artist", ACME)


@check("airplay_track", _airplay_sql("Track"))
def airplay_track(spark: SparkSession, sf: str) -> DataFrame:
    return tracks.airplay(_airplay(spark, sf), "track", ACME)


@check("record_dates", """
SELECT o_orderkey AS "Acme Track ID", strftime(o_orderdate + to_days(CAST(n AS INTEGER)), '%Y-%m-%d')
    AS "Record Date"
FROM orders, range(0, 6) AS r(n) WHERE n <= o_custkey % 7 - 1""")
def record_dates(spark: SparkSession, sf: str) -> DataFrame:
    start = F.col("o_orderdate").cast("date")
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Acme Track ID"), start.cast("string").alias("Album Release Date"),
        F.date_add(start, (F.col("o_custkey") % 7 - 1).cast("int")).cast("string").alias("End Date"),
    )
    return tracks.record_dates(rows, ACME)


# --- audio -----------------------------------------------------------------------------------

def _features() -> dict[str, Column]:
    value = {
        name: F.col("embedding")[i].cast("double") for i, name in enumerate(audio.FEATURES[1:])
    }
    return {"id": tagged("s", "vec_id"), **value}


@check("audio_features", "SELECT 's' || vec_id AS id, " + ", ".join(
    f'CAST(embedding[{i}] AS DOUBLE) AS "{name}"' for i, name in enumerate(audio.FEATURES[1:], start=1)
) + " FROM embeddings UNION ALL SELECT 'p' || p_partkey, " + ", ".join(
    f"p_retailprice + {i}" for i in range(len(audio.FEATURES) - 1)
) + " FROM part")
def audio_features(spark: SparkSession, sf: str) -> DataFrame:
    doubles = ", ".join(f"{n}: double" for n in audio.FEATURES[1:])
    vectors = F.array(record(**_features(), extra=F.col("label")))
    parts = F.array(record(id=tagged("p", "p_partkey"), **{
        n: F.col("p_retailprice") + i for i, n in enumerate(audio.FEATURES[1:])
    }))
    return audio.audio_features(
        landed_bare(table(spark, sf, "embeddings"), {}, vectors,
                    f"array<struct<id: string, {doubles}, extra: int>>"),
        landed_bare(table(spark, sf, "part"), {}, parts, f"array<struct<id: string, {doubles}>>"),
    )


# Part -> how many places its numbers are shifted, so that the parts differ.
ANALYSIS_SHIFTS = {"sections": 3, "segments": 6, "beats": 5, "bars": 4, "tatums": 8}


def _analysis(spark: SparkSession, sf: str) -> DataFrame:
    vector = F.col("embedding").cast("array<double>")

    def parts(shift: int) -> Column:
        return F.transform(
            vector, lambda v, i: F.struct(v.alias("start"), (i + shift).alias("duration"))
        )

    fields = {name: parts(shift) for name, shift in ANALYSIS_SHIFTS.items()}
    obj = record(tempo=vector[0], key=F.col("label"), **fields)
    kinds = ", ".join(f"{n}: array<struct<start: double, duration: bigint>>" for n in fields)
    return landed_bare(table(spark, sf, "embeddings"), {"track_id": tagged("s", "vec_id")}, obj,
                       f"struct<tempo: double, key: bigint, {kinds}>")


@check("audio_analysis", " UNION ALL ".join(
    [f"""SELECT '{name}' AS part, 's' || vec_id AS "Spotify Track ID",
    CAST(embedding[i] AS DOUBLE) AS start, i - 1 + {shift} AS duration, i AS number,
    CAST(NULL AS DOUBLE) AS tempo, CAST(NULL AS BIGINT) AS key
    FROM embeddings, unnest(range(1, len(embedding) + 1)) AS r(i)"""
     for name, shift in ANALYSIS_SHIFTS.items()]
    + ["""SELECT 'track', 's' || vec_id, NULL, NULL, NULL, CAST(embedding[1] AS DOUBLE), label
    FROM embeddings"""]
))
def audio_analysis(spark: SparkSession, sf: str) -> DataFrame:
    tables = audio.audio_analysis(_analysis(spark, sf))
    return stack_outer(*[
        df.withColumnRenamed(audio.PARTS.get(part, ""), "number").withColumn("part", F.lit(part))
        for part, df in tables.items()
    ])


@check("service_tracks", """
SELECT 's' || p_partkey AS id, CAST(p_size AS BIGINT) AS popularity, p_partkey * 1000 AS duration_ms,
    p_size % 2 = 0 AS explicit, p_size % 3 = 0 AS is_local, 'BR,' || p_brand AS available_markets
FROM part""")
def service_tracks(spark: SparkSession, sf: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    track = record(
        id=tagged("s", key), popularity=size, available_markets=F.array(F.lit("BR"), "p_brand"),
        duration_ms=key * 1000, explicit=size % 2 == 0, is_local=size % 3 == 0,
        album=record(id=F.col("p_type")),
    )
    docs = landed_bare(
        table(spark, sf, "part"), {}, record(tracks=F.array(track)),
        "struct<tracks: array<struct<id: string, popularity: bigint, available_markets: "
        "array<string>, duration_ms: bigint, explicit: boolean, is_local: boolean, "
        "album: struct<id: string>>>>",
    )
    return audio.service_tracks(docs).withColumn(
        "available_markets", F.array_join("available_markets", ",")
    )


# --- history and matching ----------------------------------------------------------------------

TRACK_PAYLOAD = "array<struct<id: bigint, name: string, isrc: string, album: struct<name: string>>>"


def _artist_tracks(spark: SparkSession, sf: str) -> DataFrame:
    """Each part is a track, landed under its brand as the seed artist."""
    key = F.col("p_partkey")
    isrc = F.when(F.col("p_size") % 6 > 0, tagged("ISRC", key))
    track = record(id=key, name=F.col("p_name"), isrc=isrc, album=record(name=F.col("p_type")))
    return landed(table(spark, sf, "part"), {"artist": F.col("p_brand")}, F.array(track), TRACK_PAYLOAD)


@check("tracks_of_artists", """
SELECT p_brand AS artist, p_partkey AS id, p_name AS name, p_type AS "album.name",
    CASE WHEN p_size % 6 > 0 THEN 'ISRC' || p_partkey END AS isrc FROM part""")
def tracks_of_artists(spark: SparkSession, sf: str) -> DataFrame:
    return history.tracks_of_artists(_artist_tracks(spark, sf))


@check("matched_tracks", f"""
WITH {PERF_SQL}, own AS (SELECT p_brand AS artist, p_partkey AS id, p_name AS name,
    p_type AS "album.name", CASE WHEN p_size % 6 > 0 THEN 'ISRC' || p_partkey END AS isrc FROM part)
SELECT own.*, comp_id, CASE WHEN comp_id IS NOT NULL THEN 'MATCH' ELSE 'NO MATCH' END AS "Match"
FROM own LEFT JOIN perf ON own.isrc = perf.isrc""")
def matched_tracks(spark: SparkSession, sf: str) -> DataFrame:
    return history.matched_tracks(_artist_tracks(spark, sf), perf(spark, sf))


STAT_PLATFORMS = ["spotify", "youtube", "soundcloud", "shazam", "tiktok", "genius", "radio"]
POINTS_PAYLOAD = "array<struct<data: array<struct<value: double, timestp: string>>>>"
# Four points per line item; the third has no value for returned ones.
POINTS_SQL = f"""
points AS (
    SELECT l.*, i, {choice_sql("l_linenumber", STAT_PLATFORMS)} AS platform,
        strftime(l_shipdate + to_days(i), '%Y-%m-%d') AS day,
        CASE i WHEN 0 THEN l_quantity WHEN 1 THEN l_extendedprice
            WHEN 2 THEN CASE WHEN l_returnflag <> 'R' THEN l_discount END ELSE l_tax END AS value
    FROM (SELECT *, row_number() OVER () AS item FROM lineitem) l, (VALUES (0), (1), (2), (3)) AS r(i)
),
steps AS (
    SELECT *, value - lag(value) OVER (PARTITION BY item ORDER BY i) AS step
    FROM points WHERE value IS NOT NULL AND platform <> 'radio'
)"""


def _point_stats(spark: SparkSession, sf: str) -> DataFrame:
    values = [
        F.col("l_quantity"), F.col("l_extendedprice"),
        F.when(F.col("l_returnflag") != "R", F.col("l_discount")), F.col("l_tax"),
    ]
    data = F.array(*[
        record(value=v, timestp=F.date_format(F.date_add(F.col("l_shipdate").cast("date"), i),
                                              "yyyy-MM-dd'T'10:00:00.000'Z'"))
        for i, v in enumerate(values)
    ])
    return landed(
        source(spark, sf, "lineitem"),
        {"track_id": F.col("l_partkey"), "platform": choice(F.col("l_linenumber"), STAT_PLATFORMS)},
        F.array(record(data=data)), POINTS_PAYLOAD,
    )


@check("history_by_artist", f"""
WITH {POINTS_SQL} SELECT p_brand AS "Artist", p_name AS "Track",
    CASE WHEN p_size % 6 > 0 THEN 'ISRC' || p_partkey END AS "ISRC", platform AS "Platform",
    value AS "Value", day AS "Date", step AS "Value_Diff"
FROM steps JOIN part ON l_partkey = p_partkey""")
def history_by_artist(spark: SparkSession, sf: str) -> DataFrame:
    return history.history_by_artist(_artist_tracks(spark, sf), _point_stats(spark, sf))


@check("history_by_isrc", f"""
WITH {POINTS_SQL} SELECT p_brand AS "Artist", p_name AS "Track", 'ISRC' || p_partkey AS "ISRC",
    platform AS "Platform", value AS "Value", day AS "Date", step AS "Value_Diff"
FROM steps JOIN part ON l_partkey = p_partkey WHERE p_partkey % 11 <> 0 AND p_size % 3 > 0""")
def history_by_isrc(spark: SparkSession, sf: str) -> DataFrame:
    first, second = record(name=F.col("p_brand")), record(name=F.lit("guest"))
    metadata = landed(
        table(spark, sf, "part"), {"track_id": F.col("p_partkey")},
        record(name=F.col("p_name"), artists=F.array(first, second)),
        "struct<name: string, artists: array<struct<name: string>>>",
    )
    return history.history_by_isrc(
        _track_ids(spark, sf), metadata, _point_stats(spark, sf), ACME.member("ids")
    )
