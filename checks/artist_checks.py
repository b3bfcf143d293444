"""Artist jobs on landed responses made from the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.landed import choice, choice_sql, day, landed, midnight, record, source, tagged
from checks.registry import check, table
from staveline.operators.frames import stack_outer
from staveline.plans import artists
from staveline.plans.naming import Provider
from staveline.sources.landed import parse_landed

ACME = Provider("Acme")


# --- profile and ids -------------------------------------------------------------

def _profiles(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    nations = table(spark, sf, "nation")
    rows = table(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    primary = record(id=F.col("n_nationkey"), name=F.col("n_name"), score=F.col("c_acctbal"),
                     link_type=F.lit("x"))
    statistics = record(sp_followers=key, genreRank=record(rank=key, name=F.col("n_name")))
    obj = record(
        id=key, name=F.col("c_name"), description=F.col("c_mktsegment"), cm_artist_rank=key + 1,
        cm_artist_score=F.col("c_acctbal") * 2,
        genres=record(primary=primary, secondary=F.array("n_name", "c_mktsegment"),
                      sub=F.array("c_mktsegment")),
        cm_statistics=statistics,
        artist_stage=record(career_stage=F.lit("mid"), career_growth=F.lit("up")),
        cover_url=F.lit("u"), hometown_city=F.col("n_name"), verified=key % 2 == 0,
    )
    return landed(
        rows, {}, obj,
        "struct<id: bigint, name: string, description: string, cm_artist_rank: bigint, "
        "cm_artist_score: double, genres: struct<primary: struct<id: bigint, name: string, "
        "score: double, link_type: string>, secondary: array<string>, sub: array<string>>, "
        "cm_statistics: struct<sp_followers: bigint, genreRank: struct<rank: bigint, "
        "name: string>>, artist_stage: struct<career_stage: string, career_growth: string>, "
        "cover_url: string, hometown_city: string, verified: boolean>",
    )


@check("artist_metadata", """
SELECT c_custkey AS "Acme Artist ID", c_name AS "Acme Artist Name",
    c_mktsegment AS "Acme Artist Description", c_custkey + 1 AS "Acme Current Artist Rank",
    c_acctbal * 2 AS "Acme Artist Score", n_name AS "cm.artist.primaryGenre",
    c_acctbal AS "Acme Artist Primary Genre Score",
    n_name || ',' || c_mktsegment AS "Acme Artist Secondary Genre",
    c_mktsegment AS "Acme Artist Sub Genre", n_name AS hometown_city, c_custkey % 2 = 0 AS verified
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def artist_metadata(spark: SparkSession, sf: str) -> DataFrame:
    rows = artists.artist_metadata(_profiles(spark, sf), ACME)
    lists = ["Acme Artist Secondary Genre", "Acme Artist Sub Genre"]
    return rows.withColumns({c: F.array_join(c, ",") for c in lists})


@check("artist_crosswalk", """
SELECT c_custkey AS "Acme Artist ID", c_name AS "Artist Name",
    CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 's' || c_custkey
        ELSE 's' || c_custkey || ',t' || c_custkey END AS "Spotify ID",
    CASE WHEN c_custkey % 3 = 1 THEN 's' || c_custkey END AS "Spotify ID (single)",
    'a' || c_nationkey AS "Apple ID", 'a' || c_nationkey AS "Apple ID (single)",
    '' AS "Deezer ID", CAST(NULL AS VARCHAR) AS "Deezer ID (single)",
    CAST(NULL AS VARCHAR) AS "Amazon ID", CAST(NULL AS VARCHAR) AS "Amazon ID (single)"
FROM customer""")
def artist_crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    none = F.array().cast("array<string>")
    found = record(
        acme_id=key, artist_name=F.col("c_name"),
        spotify_artist_ids=F.slice(F.array(tagged("s", key), tagged("t", key)), F.lit(1),
                                   (key % 3).cast("int")),
        itunes_artist_ids=F.array(tagged("a", "c_nationkey")),
        deezer_artist_ids=none, amazon_artist_ids=F.lit(None).cast("array<string>"),
    )
    kinds = ", ".join(f"{c}: array<string>" for c in artists.ARTIST_ID_LISTS)
    docs = landed(table(spark, sf, "customer"), {}, F.array(found),
                  f"array<struct<acme_id: bigint, artist_name: string, {kinds}>>")
    rows = artists.artist_crosswalk(docs, ACME)
    return rows.withColumns({
        c: F.array_join(c, ",") for c in artists.ARTIST_ID_LISTS.values()
    })


# --- metrics ----------------------------------------------------------------------

FAN_PLATFORMS = [*artists.FAN_METRICS, "radio"]


@check("fan_metrics", f"""
SELECT DISTINCT user_id AS "Acme Artist ID", platform AS "Metric Platform", metric AS "Metric Name",
    strftime(ts, '%Y-%m-%d') AS "Artist Metric Date", floor(value / 10) AS "Metric Value",
    CAST(NULL AS DOUBLE) AS "Metric Value Difference"
FROM (SELECT *, {choice_sql("event_id", FAN_PLATFORMS)} AS platform FROM events),
    (VALUES ('followers'), ('likes'), ('views'), ('other')) AS m(metric)
WHERE (platform = 'spotify' AND metric = 'followers') OR (platform = 'facebook' AND metric = 'likes')
    OR (platform = 'twitter' AND metric = 'followers')
    OR (platform = 'youtube_channel' AND metric = 'views')
    OR (platform = 'tiktok' AND metric IN ('followers', 'likes'))""")
def fan_metrics(spark: SparkSession, sf: str) -> DataFrame:
    point = record(
        timestp=midnight(F.col("ts")), value=F.floor(F.col("value") / 10).cast("double"),
        diff=F.lit(None).cast("double"), weekly_diff=F.col("value"),
    )
    pairs = []
    for metric in ("followers", "likes", "views", "other"):
        pairs += [F.lit(metric), F.array(point)]
    docs = landed(
        source(spark, sf, "events"),
        {"artist_id": F.col("user_id"), "platform": choice(F.col("event_id"), FAN_PLATFORMS)},
        F.create_map(*pairs),
        "map<string, array<struct<timestp: string, value: double, diff: double, "
        "weekly_diff: double>>>",
    )
    return artists.fan_metrics(docs, ACME)


REGION_SQL = """n_name AS "Region Name", CAST(c_custkey AS DOUBLE) AS "Region Latitude",
    CAST(c_nationkey AS DOUBLE) AS "Region Longitude", 'CO' AS "Region Country Code",
    CAST(c_nationkey AS BIGINT) AS "Region City ID", 'city' AS "Region Type\""""


@check("three_way_split", f"""
WITH base AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT 'trends' AS part, c_custkey AS "Acme Artist ID", 'YouTube' AS "Platform",
    'Views Insights' AS "Metric Type", 'q' || c_custkey AS "Metric Query ID", '2024-01-01' AS "Current Date",
    {REGION_SQL}, c_custkey * 5 AS "Region Current Max Count", CAST(c_nationkey AS BIGINT) AS "Region Current Rank for Artist",
    '2023-12-0' || i AS "Region Historical Views Timestamp", c_custkey + i AS "Region Historical Views Count",
    CAST(NULL AS BIGINT) AS "Region Current Number of Views", CAST(NULL AS BIGINT) AS "Region Previous Number of Views",
    CAST(NULL AS DOUBLE) AS "Region Views Market Share", CAST(NULL AS BIGINT) AS "Region Leading Acme Artist ID",
    CAST(NULL AS VARCHAR) AS "Region Leading Artist Name", CAST(NULL AS BIGINT) AS "Current Metric Value"
FROM base, range(1, 3) AS r(i)
UNION ALL SELECT 'markets', c_custkey, 'YouTube', 'Views Market Coverage', 'loc' || c_custkey, '2024-06-30',
    {REGION_SQL}, NULL, NULL, NULL, NULL, c_custkey * 3, c_custkey * 2, c_acctbal, c_custkey + 7, c_name, NULL
FROM base
UNION ALL SELECT 'totals', c_custkey, 'YouTube', 'Total Artist Views', NULL, '2024-06-30',
    NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, c_custkey * 100
FROM base WHERE c_custkey % 2 = 0""")
def three_way_split(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    rows = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    region = dict(
        name=F.col("n_name"), lat=key.cast("double"), lng=F.col("c_nationkey").cast("double"),
        code2=F.lit("CO"), city_id=F.col("c_nationkey"), region=F.lit("city"),
    )
    city = record(
        params_id=tagged("q", key), timestp=F.lit("2024-01-01"), **region,
        current_max_count=key * 5, rank=F.col("c_nationkey"),
        trend=F.array(*[record(timestp=F.lit(f"2023-12-0{i}"), monthlyviews=key + i) for i in (1, 2)]),
    )
    market = record(
        youtubeforartist_location=tagged("loc", key), **region, value=key * 3, prev_value=key * 2,
        weight=F.col("c_acctbal"), market_max_cm_artist_id=key + 7,
        market_max_artist_name=F.col("c_name"),
    )
    obj = record(
        insights=record(cities=F.array(city)), marketInsights=record(marketCities=F.array(market)),
        artistTotalViews=F.when(key % 2 == 0, key * 100),
    )
    place = "name: string, lat: double, lng: double, code2: string, city_id: bigint, region: string"
    docs = landed(
        rows, {"artist_id": key}, obj,
        f"struct<insights: struct<cities: array<struct<params_id: string, timestp: string, {place}, "
        "current_max_count: bigint, rank: bigint, trend: array<struct<timestp: string, "
        "monthlyviews: bigint>>>>>, marketInsights: struct<marketCities: array<struct<"
        f"youtubeforartist_location: string, {place}, value: bigint, prev_value: bigint, "
        "weight: double, market_max_cm_artist_id: bigint, market_max_artist_name: string>>>, "
        "artistTotalViews: bigint>",
    )
    parts = artists.video_market(docs, F.lit("2024-06-30").cast("date"), ACME)
    return stack_outer(*[df.withColumn("part", F.lit(name)) for name, df in parts.items()])


AUDIENCES = ["followers", "likes", "commenters"]
AUDIENCE_PLATFORMS = ["instagram", "tiktok", "youtube", "radio"]
KINDS = list(artists.AUDIENCE)


def _audience_sql() -> str:
    parts = []
    for kind, pairs in artists.AUDIENCE.items():
        listed = " OR ".join(f"(platform = '{p}' AND audience = '{a}')" for p, a in pairs)
        parts.append(f"(kind = '{kind}' AND ({listed}))")
    return f"""
SELECT kind, user_id AS "Acme Artist ID", platform AS "Platform",
    upper(audience[1]) || audience[2:] AS "Metric", value AS weight, event_type AS "top.code"
FROM (SELECT *, {choice_sql("event_id", KINDS)} AS kind,
    {choice_sql("event_id // 4", AUDIENCE_PLATFORMS)} AS platform,
    {choice_sql("event_id // 16", AUDIENCES)} AS audience FROM events)
WHERE {" OR ".join(parts)}"""


@check("social_audience", _audience_sql())
def social_audience(spark: SparkSession, sf: str) -> DataFrame:
    event = F.col("event_id")
    docs = landed(
        source(spark, sf, "events"),
        {
            "artist_id": F.col("user_id"), "kind": choice(event, KINDS),
            "platform": choice(F.floor(event / 4), AUDIENCE_PLATFORMS),
            "audience": choice(F.floor(event / 16), AUDIENCES),
        },
        record(weight=F.col("value"), top=record(code=F.col("event_type")),
               avg_likes_per_post=F.col("value")),
        "struct<weight: double, top: struct<code: string>, avg_likes_per_post: double>",
    )
    return stack_outer(*[
        artists.social_audience(docs, kind, ACME).withColumn("kind", F.lit(kind)) for kind in KINDS
    ])


@check("listeners", """
SELECT c_custkey AS "Acme Artist ID", 'Spotify' AS "Platform", region_name AS "Region Name",
    '2024-02-03' AS "Metric Date", 'CO' AS "Metric Country Code", kind AS "Metric Type",
    c_custkey + i AS "Listeners", CAST(c_nationkey AS BIGINT) AS "Artist City Rank", c_custkey * 9 AS "Region Population"
FROM (SELECT *, n_name AS region_name, 'city' AS kind, 0 AS i FROM customer JOIN nation ON c_nationkey = n_nationkey
    UNION ALL SELECT *, c_mktsegment, 'city', 1 FROM customer JOIN nation ON c_nationkey = n_nationkey
    UNION ALL SELECT *, 'Land ' || n_name, 'country', 2 FROM customer JOIN nation ON c_nationkey = n_nationkey)""")
def listeners(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    rows = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )

    def points(kind: str, i: int) -> Column:
        return F.array(record(
            timestp=F.lit("2024-02-03T00:00:00.000Z"), code2=F.lit("CO"), region=F.lit(kind),
            listeners=key + i, artist_city_rank=F.col("c_nationkey"), population=key * 9,
        ))

    obj = record(
        cities=F.create_map(F.col("n_name"), points("city", 0), F.col("c_mktsegment"), points("city", 1)),
        countries=F.create_map(F.concat(F.lit("Land "), "n_name"), points("country", 2)),
    )
    regions = (
        "map<string, array<struct<timestp: string, code2: string, region: string, "
        "listeners: bigint, artist_city_rank: bigint, population: bigint>>>"
    )
    docs = landed(rows, {"artist_id": key}, obj, f"struct<cities: {regions}, countries: {regions}>")
    return artists.listeners(docs, ACME)


# --- playlists and links --------------------------------------------------------------

PLAYLIST_KINDS = {
    "fdiff_month": "bigint", "fdiff_week": "bigint", "followers": "bigint", "num_tracks": "bigint",
    "last_position": "bigint", "peak_position": "bigint", "active_ratio": "double",
    "personalized": "boolean", "official": "boolean", "tags": "array<string>",
}


@check("artist_playlists", """
SELECT o_orderpriority AS artist, 'p' || o_orderkey AS "Playlist ID", 'n' || o_orderkey AS "Playlist Name",
    o_orderkey AS "Monthly Change in Followers", o_orderkey + 1 AS "Weekly Change in Followers",
    o_orderkey + 2 AS "Playlist Latest Followers Count", 'BR' AS "Playlist Country Code",
    'curator' AS "Playlist Curator", o_orderkey % 2 = 0 AS "Personalized Playlist",
    o_orderkey % 3 = 0 AS "Official Playlist", 'x, ' || o_orderstatus AS "Playlist Tags",
    2::BIGINT AS "Playlist Latest Track Count", o_totalprice AS "Playlist Active Ratio",
    o_custkey AS "Last Track Position on Playlist", o_custkey + 1 AS "Peak Track Position on Playlist",
    o_custkey + i AS "Track Peak Position", o_custkey * 2 + i AS "Current Track Position",
    strftime(o_orderdate, '%Y-%m-%d') AS "Playlist Track Addition Date",
    CAST(NULL AS VARCHAR) AS "Playlist Track Removal Date", i AS "Playlist Track Inclusion Period",
    'ISRC' || o_orderkey AS "Track ISRC", 's' || o_orderkey AS "Platform Track ID",
    o_orderkey AS "Acme Track ID", o_custkey AS "Acme Artist ID", 'pop, ' || o_orderstatus AS "Platform Track Genres"
FROM orders, range(0, 2) AS r(i)""")
def artist_playlists(spark: SparkSession, sf: str) -> DataFrame:
    key, customer = F.col("o_orderkey"), F.col("o_custkey")

    def on_list(i: int) -> Column:
        return record(
            peak_position=customer + i, position=customer * 2 + i, added_at=day(F.col("o_orderdate")),
            removed_at=F.lit(None).cast("string"), period=F.lit(i), isrc=tagged("ISRC", key),
            spotify_track_ids=F.array(tagged("s", key)), cm_track=key, cm_artist=customer,
            genres=F.array(F.lit("pop"), "o_orderstatus"),
        )

    playlist = record(
        id=tagged("p", key), name=tagged("n", key), fdiff_month=key, fdiff_week=key + 1,
        followers=key + 2, code2=F.lit("BR"), curator_name=F.lit("curator"),
        personalized=key % 2 == 0, official=key % 3 == 0, tags=F.array(F.lit("x"), "o_orderstatus"),
        num_tracks=F.lit(2), active_ratio=F.col("o_totalprice"), last_position=customer,
        peak_position=customer + 1, tracks=F.array(on_list(0), on_list(1)),
    )
    fields = ", ".join(
        f"{f}: {PLAYLIST_KINDS.get(f, 'string')}"
        for f in artists.PLAYLIST_LABELS.values() if not f.startswith("track.")
    )
    docs = landed(
        source(spark, sf, "orders"), {"artist": F.col("o_orderpriority")}, F.array(playlist),
        f"array<struct<{fields}, tracks: array<struct<peak_position: bigint, position: bigint, "
        "added_at: string, removed_at: string, period: bigint, isrc: string, "
        "spotify_track_ids: array<string>, cm_track: bigint, cm_artist: bigint, "
        "genres: array<string>>>>>",
    )
    return artists.artist_playlists(docs, ACME).withColumn(
        "Platform Track ID", F.array_join("Platform Track ID", ", ")
    )


LINKED_SQL = """
SELECT s_name AS artist, s_suppkey + i AS id, s_name || i AS name, n_name AS "origin.country"
FROM supplier JOIN nation ON s_nationkey = n_nationkey, range(0, 3) AS r(i)"""


def _linked(spark: SparkSession, sf: str, member: str) -> DataFrame:
    rows = table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    found = F.array(*[
        record(id=F.col("s_suppkey") + i, name=F.concat("s_name", F.lit(str(i))),
               origin=record(country=F.col("n_name")))
        for i in range(3)
    ])
    bodies = rows.select(
        F.col("s_name").alias("artist"), F.to_json(F.struct(found.alias(member))).alias("body")
    )
    docs = parse_landed(
        bodies, "body", "array<struct<id: bigint, name: string, origin: struct<country: string>>>",
        member,
    )
    return artists.linked_artists(docs.withColumnRenamed(member, "obj"))


@check("related_artists", LINKED_SQL)
def related_artists(spark: SparkSession, sf: str) -> DataFrame:
    return _linked(spark, sf, "obj")


@check("neighbouring_artists", LINKED_SQL)
def neighbouring_artists(spark: SparkSession, sf: str) -> DataFrame:
    return _linked(spark, sf, "cluster_artists")
