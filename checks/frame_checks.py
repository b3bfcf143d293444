"""Generic operators: frames, dates, nested documents, series, matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.landed import landed, record, source, tagged, text
from checks.registry import check, table
from staveline.functions import dates
from staveline.functions.text import tags_text
from staveline.operators import frames, match, nested, series
from staveline.sources.landed import parse_landed
from staveline.sources.lookups import seed_artists

EVENT_KINDS = [
    {"event_type": "view", "Platform": "web", "Weight": "low"},
    {"event_type": "click", "Platform": "web", "Weight": "mid"},
    {"event_type": "purchase", "Platform": "shop", "Weight": "high"},
]


@check("landed_envelope", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def landed_envelope(spark: SparkSession, sf: str) -> DataFrame:
    bodies = table(spark, sf, "events").select(
        "event_id", F.concat(F.lit('{"obj":'), "props", F.lit("}")).alias("body")
    )
    return parse_landed(bodies, "body", "struct<k: bigint>").select("event_id", "obj.k")


@check("drop_all_null", """
SELECT * FROM (
    SELECT NULLIF(o_orderpriority, '1-URGENT') AS priority, NULLIF(o_orderstatus, 'P') AS status
    FROM orders
) WHERE priority IS NOT NULL OR status IS NOT NULL""")
def drop_all_null(spark: SparkSession, sf: str) -> DataFrame:
    return frames.drop_all_null(table(spark, sf, "orders").select(
        F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("priority"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
    ))


@check("drop_dups", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def drop_dups(spark: SparkSession, sf: str) -> DataFrame:
    return frames.dedupe(table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag"))


@check("stack_outer", """
SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, CAST(NULL AS BIGINT) AS supplier
FROM customer
UNION ALL SELECT s_name, s_acctbal, NULL, s_suppkey FROM supplier""")
def stack_outer(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("supplier"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    return frames.stack_outer(customers, suppliers)


@check("stack_inner", """
SELECT c_name AS name, c_nationkey AS nation FROM customer
UNION ALL SELECT s_name, s_nationkey FROM supplier""")
def stack_inner(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), "c_mktsegment"
    )
    suppliers = table(spark, sf, "supplier").select(
        "s_suppkey", F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
    )
    return frames.stack_inner(customers, suppliers)


@check("normalise_columns", """
SELECT n_nationkey AS "Nation_Key", n_name AS "Nation_Name_Text" FROM nation""")
def normalise_columns(spark: SparkSession, sf: str) -> DataFrame:
    odd = frames.rename(
        table(spark, sf, "nation"),
        {"n_nationkey": "Nation Key", "n_name": "Nation Name.Text", "absent": "x"},
    )
    pruned = frames.drop_columns(odd, ["absent"], ["n_region"])
    return frames.normalise_columns(
        frames.select_attributes(pruned, ["Nation Key", "Nation Name.Text"])
    )


@check("tag_reference", """
SELECT event_id, event_type, user_text, "Platform", "Weight" FROM (
    SELECT event_id, event_type, CASE WHEN user_id % 9 = 0 THEN '' WHEN user_id % 10 = 0 THEN NULL
        ELSE CAST(user_id AS VARCHAR) END AS user_text FROM events
) JOIN (VALUES ('view', 'web', 'low'), ('click', 'web', 'mid'), ('purchase', 'shop', 'high'))
    AS r(event_type, "Platform", "Weight") USING (event_type)
WHERE user_text <> ''""")
def tag_reference(spark: SparkSession, sf: str) -> DataFrame:
    user = F.when(F.col("user_id") % 9 == 0, "").when(F.col("user_id") % 10 > 0, text("user_id"))
    rows = table(spark, sf, "events").select("event_id", "event_type", user.alias("user_text"))
    return frames.tag_with_reference(
        frames.present(rows, "user_text"), EVENT_KINDS, ["event_type"]
    )


@check("seed_filter", """
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def seed_filter(spark: SparkSession, sf: str) -> DataFrame:
    seeds = seed_artists(spark, ["BUILDING", "MACHINERY"], "c_mktsegment")
    return frames.seeded(
        table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), seeds,
        "c_mktsegment",
    )


# --- dates -------------------------------------------------------------------

DATE_SQL = """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d')
    WHEN event_id % 3 = 1 THEN strftime(ts, '%Y-%m-%d') || 'T12:00:00' ELSE NULL END AS day
FROM events"""


def _date_texts(spark: SparkSession, sf: str, tail: str) -> DataFrame:
    """Text the function converts, text it leaves alone, and NULL."""
    number, date = F.col("event_id") % 3, F.date_format("ts", "yyyy-MM-dd")
    value = F.when(number == 0, F.concat(date, F.lit(tail))).when(
        number == 1, F.concat(date, F.lit("T12:00:00"))
    )
    return table(spark, sf, "events").select("event_id", value.alias("written"))


@check("date_text_utc", DATE_SQL)
def date_text_utc(spark: SparkSession, sf: str) -> DataFrame:
    rows = _date_texts(spark, sf, "T00:00:00.000Z")
    return rows.select("event_id", dates.utc_midnight_date(F.col("written")).alias("day"))


@check("date_text_full", DATE_SQL)
def date_text_full(spark: SparkSession, sf: str) -> DataFrame:
    rows = _date_texts(spark, sf, "T00:00:00.00000")
    return rows.select("event_id", dates.full_timestamp_date(F.col("written")).alias("day"))


@check("date_text_partial", DATE_SQL)
def date_text_partial(spark: SparkSession, sf: str) -> DataFrame:
    rows = _date_texts(spark, sf, "T00:00:00")
    return rows.select("event_id", dates.partial_timestamp_date(F.col("written")).alias("day"))


@check("epoch_ms_date", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events")
def epoch_ms_date(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", dates.epoch_ms_date(F.unix_millis(F.col("ts").cast("timestamp"))).alias("day")
    )


@check("any_ts_date", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events")
def any_ts_date(spark: SparkSession, sf: str) -> DataFrame:
    written = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("-05:00"))
    return table(spark, sf, "events").select(
        "event_id", dates.timestamp_text_date(written).alias("day")
    )


@check("trailing_window", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
    o_orderdate >= DATE '2000-06-30' - INTERVAL 6 MONTH AS recent
FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2000-06-30' - 1095 AND DATE '2000-06-30'""")
def trailing_window(spark: SparkSession, sf: str) -> DataFrame:
    as_of = F.lit("2000-06-30").cast("date")
    when = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").where(dates.in_trailing_days(when, as_of)).select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        (when >= dates.months_before(as_of)).alias("recent"),
    )


def _spans(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with an end up to two days before or seven days behind the start."""
    start = F.col("o_orderdate").cast("date")
    end = F.date_add(start, (F.col("o_orderkey") % 10 - 2).cast("int"))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Track ID"), start.cast("string").alias("Album Release Date"),
        end.cast("string").alias("End Date"),
    )


@check("calendar_spine", """
SELECT o_orderkey AS "Track ID", strftime(o_orderdate + to_days(CAST(n AS INTEGER)), '%Y-%m-%d')
    AS "Record Date"
FROM orders, range(0, 8) AS r(n) WHERE n <= o_orderkey % 10 - 2""")
def calendar_spine(spark: SparkSession, sf: str) -> DataFrame:
    return series.record_days(
        _spans(spark, sf), "Album Release Date", "End Date", "Record Date", ["Track ID"]
    )


@check("day_pairs", """
SELECT o_orderkey AS "Track ID", o_orderkey % 10 - 2 AS days,
    strftime(o_orderdate + to_days(CAST(n AS INTEGER) - 1), '%Y-%m-%d') AS since,
    strftime(o_orderdate + to_days(CAST(n AS INTEGER)), '%Y-%m-%d') AS until
FROM orders, range(0, 8) AS r(n) WHERE n < o_orderkey % 10 - 2""")
def day_pairs(spark: SparkSession, sf: str) -> DataFrame:
    spans = _spans(spark, sf)
    count = dates.day_count(
        F.col("Album Release Date").cast("date"), F.col("End Date").cast("date")
    )
    spans = spans.withColumn("days", count.cast("long"))
    return series.day_pairs(spans, "Album Release Date", "End Date", ["Track ID", "days"])


# --- nested documents ---------------------------------------------------------

@check("flatten_struct", """
SELECT c_custkey AS id, n_name AS "home.nation.name", r_name AS "home.nation.region.name",
    c_mktsegment || ',' || n_name AS tags
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def flatten_struct(spark: SparkSession, sf: str) -> DataFrame:
    places = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    rows = table(spark, sf, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    nation = record(name=F.col("n_name"), region=record(name=F.col("r_name")))
    obj = record(
        id=F.col("c_custkey"), home=record(nation=nation), tags=F.array("c_mktsegment", "n_name")
    )
    docs = landed(
        rows, {}, obj,
        "struct<id: bigint, home: struct<nation: struct<name: string, "
        "region: struct<name: string>>>, tags: array<string>>",
    )
    return nested.flatten(docs).withColumn("tags", F.array_join("tags", ","))


@check("record_path", """
SELECT l_orderkey AS order_key, strftime(l_shipdate, '%Y-%m-%d') AS timestp,
    unnest([l_quantity, l_extendedprice, l_quantity + l_extendedprice]) AS value
FROM lineitem""")
def record_path(spark: SparkSession, sf: str) -> DataFrame:
    when = F.date_format("l_shipdate", "yyyy-MM-dd")
    values = [F.col("l_quantity"), F.col("l_extendedprice"),
              F.col("l_quantity") + F.col("l_extendedprice")]
    data = F.array(*[record(value=v, timestp=when) for v in values])
    docs = landed(
        source(spark, sf, "lineitem"), {"order_key": F.col("l_orderkey")},
        F.array(record(data=data)),
        "array<struct<data: array<struct<value: double, timestp: string>>>>",
    )
    return nested.record_path(docs, ["data"], keep=["order_key"])


@check("record_path_meta", """
SELECT o_orderkey AS order_key, o_orderpriority AS priority, o_orderstatus AS "owner.status",
    unnest(range(0, o_orderkey % 4)) AS "item.step"
FROM orders""")
def record_path_meta(spark: SparkSession, sf: str) -> DataFrame:
    steps = F.slice(F.array(*[record(step=F.lit(i)) for i in range(3)]), F.lit(1),
                    (F.col("o_orderkey") % 4).cast("int"))
    obj = record(
        priority=F.col("o_orderpriority"), owner=record(status=F.col("o_orderstatus")), items=steps
    )
    docs = landed(
        source(spark, sf, "orders"), {"order_key": F.col("o_orderkey")}, obj,
        "struct<priority: string, owner: struct<status: string>, items: array<struct<step: bigint>>>",
    )
    return nested.record_path(
        docs, ["items"], meta=[["priority"], ["owner", "status"]], record_prefix="item.",
        keep=["order_key"],
    )


@check("record_path_two_level", """
SELECT c_custkey AS key, c_mktsegment AS "playlist.name", unnest(range(0, 3)) AS position,
    c_name AS track
FROM customer""")
def record_path_two_level(spark: SparkSession, sf: str) -> DataFrame:
    details = F.array(*[record(position=F.lit(i), track=F.col("c_name")) for i in range(3)])
    docs = landed(
        table(spark, sf, "customer"), {"key": F.col("c_custkey")},
        F.array(record(playlist=record(name=F.col("c_mktsegment"), details=details))),
        "array<struct<playlist: struct<name: string, "
        "details: array<struct<position: bigint, track: string>>>>>",
    )
    return nested.record_path(docs, ["playlist", "details"], meta=[["playlist", "name"]], keep=["key"])


@check("map_rows", """
SELECT user_id, event_type AS metric, value, strftime(ts, '%Y-%m-%d') AS timestp FROM events
UNION ALL SELECT user_id, 'doubled', value * 2, strftime(ts, '%Y-%m-%d') FROM events""")
def map_rows(spark: SparkSession, sf: str) -> DataFrame:
    when = F.date_format("ts", "yyyy-MM-dd")
    obj = F.create_map(
        F.col("event_type"), F.array(record(value=F.col("value"), timestp=when)),
        F.lit("doubled"), F.array(record(value=F.col("value") * 2, timestp=when)),
    )
    docs = landed(
        source(spark, sf, "events"), {"user_id": F.col("user_id")}, obj,
        "map<string, array<struct<value: double, timestp: string>>>",
    )
    return nested.map_rows(docs, F.col("obj"), "metric", keep=["user_id"])


@check("path_default", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN user_id END AS first_artist,
    CAST(NULL AS VARCHAR) AS album
FROM events""")
def path_default(spark: SparkSession, sf: str) -> DataFrame:
    artists = F.when(F.col("event_id") % 3 == 0, F.array(record(id=F.col("user_id")))).when(
        F.col("event_id") % 3 == 1, F.array().cast("array<struct<id: bigint>>")
    )
    docs = landed(
        source(spark, sf, "events"), {"event_id": F.col("event_id")},
        record(kind=F.col("event_type"), artists=artists),
        "struct<kind: string, artists: array<struct<id: bigint>>>",
    )
    return docs.select(
        "event_id", nested.path_or_null(docs, "obj", "artists.id").alias("first_artist"),
        nested.path_or_null(docs, "obj", "albums.id").cast("string").alias("album"),
    )


@check("double_explode", """
SELECT o_orderkey, first, unnest(CASE WHEN o_orderkey % 3 = 0 THEN [NULL]
    ELSE ['a' || o_orderkey, 'b' || o_orderkey] END) AS second
FROM (SELECT o_orderkey, unnest(CASE WHEN o_orderkey % 4 = 0 THEN [NULL]
    ELSE [o_custkey, o_custkey + 1] END) AS first FROM orders)""")
def double_explode(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(key % 4 == 0, F.array().cast("array<bigint>")).otherwise(
            F.array(F.col("o_custkey"), F.col("o_custkey") + 1)).alias("first"),
        F.when(key % 3 == 0, F.array().cast("array<string>")).otherwise(
            F.array(tagged("a", "o_orderkey"), tagged("b", "o_orderkey"))).alias("second"),
    )
    return nested.double_explode(rows, "first", "second")


@check("unwrap_single", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN o_custkey END AS only,
    CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN CAST(o_custkey AS VARCHAR)
        ELSE CAST(o_custkey AS VARCHAR) || ',' || CAST(o_orderkey AS VARCHAR) END AS all_ids,
    CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END AS first_id
FROM orders""")
def unwrap_single(spark: SparkSession, sf: str) -> DataFrame:
    ids = F.slice(F.array("o_custkey", "o_orderkey"), F.lit(1), (F.col("o_orderkey") % 3).cast("int"))
    return table(spark, sf, "orders").withColumn("ids", ids).select(
        "o_orderkey", nested.unwrap_single(F.col("ids")).alias("only"),
        F.array_join(F.col("ids").cast("array<string>"), ",").alias("all_ids"),
        nested.first_element(F.col("ids")).alias("first_id"),
    )


@check("number_elements", """
SELECT vec_id, CAST(embedding[i] AS DOUBLE) AS value, i AS number
FROM embeddings, range(1, 65) AS r(i)""")
def number_elements(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding")
    )
    return nested.number_elements(vectors, F.col("embedding"), "number", keep=["vec_id"])


@check("tags_text", """
SELECT doc_id, array_to_string(list_sort(list_distinct(string_split(text, ' '))), ', ') AS tags
FROM documents""")
def tags(spark: SparkSession, sf: str) -> DataFrame:
    words = F.array_sort(F.array_distinct(F.split("text", " ")))
    return table(spark, sf, "documents").select("doc_id", tags_text(words).alias("tags"))


# --- series and matching --------------------------------------------------------

@check("series_diff", """
SELECT event_id, user_id, event_type, v AS value,
    v - lag(v) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS difference
FROM (SELECT *, CASE WHEN event_id % 10 > 0 THEN value END AS v FROM events) WHERE v IS NOT NULL""")
def series_diff(spark: SparkSession, sf: str) -> DataFrame:
    value = F.when(F.col("event_id") % 10 > 0, F.col("value"))
    points = table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "ts", value.alias("value")
    )
    return series.series_diff(
        points, ["user_id", "event_type"], "ts", "value", tie_break=["event_id"]
    ).drop("ts")


@check("series_diff_by_id", """
SELECT event_id, user_id, value,
    value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS difference
FROM events""")
def series_diff_by_id(spark: SparkSession, sf: str) -> DataFrame:
    points = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return series.series_diff(points, ["user_id"], "ts", "value", tie_break=["event_id"]).drop("ts")


@check("window_filter", """
SELECT l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS day
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE CAST(l_shipdate AS DATE) BETWEEN CAST(o_orderdate AS DATE) AND CAST(o_orderdate AS DATE) + 60""")
def window_filter(spark: SparkSession, sf: str) -> DataFrame:
    facts = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"),
    )
    start = F.col("o_orderdate").cast("date")
    windows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), start.cast("string").alias("start"),
        F.date_add(start, 60).cast("string").alias("end"),
    )
    return series.in_own_window(facts, windows, "l_orderkey", "day", "start", "end")


PERF_SQL = """
perf AS (
    SELECT unnest(CASE WHEN p_size % 5 = 0 THEN ['W' || p_partkey, 'V' || p_partkey]
        ELSE ['W' || p_partkey] END) AS comp_id,
        CASE WHEN p_size > 20 THEN 'ISRC' ELSE 'OTHER' END || p_partkey AS isrc
    FROM part
),
tracks AS (
    SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'R' THEN 'ISRC' || l_partkey END AS isrc
    FROM lineitem
)"""


def perf(spark: SparkSession, sf: str) -> DataFrame:
    """A catalogue of all parts, some twice; those up to a size have another ISRC than their track."""
    works = F.when(
        F.col("p_size") % 5 == 0, F.array(tagged("W", "p_partkey"), tagged("V", "p_partkey"))
    ).otherwise(F.array(tagged("W", "p_partkey")))
    prefix = F.when(F.col("p_size") > 20, "ISRC").otherwise("OTHER")
    return table(spark, sf, "part").select(
        F.explode(works).alias("comp_id"), F.concat(prefix, text("p_partkey")).alias("isrc")
    )


def _tracks(spark: SparkSession, sf: str) -> DataFrame:
    isrc = F.when(F.col("l_returnflag") != "R", tagged("ISRC", "l_partkey"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", isrc.alias("isrc"))


@check("catalogue_match", f"""
WITH {PERF_SQL}
SELECT t.*, comp_id, CASE WHEN comp_id IS NOT NULL THEN 'MATCH' ELSE 'NO MATCH' END AS "Match"
FROM tracks t LEFT JOIN perf p ON t.isrc = p.isrc""")
def catalogue_match(spark: SparkSession, sf: str) -> DataFrame:
    return match.catalogue_match(_tracks(spark, sf), perf(spark, sf))


@check("perf_semi", f"""
WITH {PERF_SQL} SELECT * FROM perf WHERE isrc IN (SELECT isrc FROM tracks)""")
def perf_semi(spark: SparkSession, sf: str) -> DataFrame:
    return match.perf_for(_tracks(spark, sf), perf(spark, sf))
