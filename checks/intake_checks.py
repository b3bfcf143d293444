"""Reading and writing files: streaming intake, exports, appended metadata.

All files go below the shared scratch folder; the results read them back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import check, table
from checks.report_checks import FILE_NAMES, RANKED, TOP
from checks.report_checks import _padded as padded
from checks.standins import (
    CLAIMANT,
    EXACT,
    claims,
    merged_sql,
    report_records,
    sales,
    summary_rows,
    with_records,
)
from staveline.operators.frames import rename
from staveline.plans.ranking import export_top, top_residual_artists
from staveline.plans.report import ReportTerms
from staveline.plans.scalars import loaded_scalars, update_scalars
from staveline.session import scratch_folder
from staveline.sinks.tables import (
    BY_PERIOD,
    append_records,
    read_report,
    write_by_key,
    write_replace,
    write_report,
)
from staveline.sources.documents import flatten_documents, payloads, read_documents
from staveline.sources.dsr import check_bad_rows, read_dsr, to_lines, typed_records
from staveline.sources.landed import read_landed
from staveline.sources.lookups import load_artist_metadata, read_seed_artists
from staveline.streaming.changes import ingest_changes, part_records
from staveline.streaming.gate import completed, emit_completed
from staveline.streaming.intake import (
    artist_metadata,
    ingest,
    manifest,
    missing_services,
    quarantine,
    records,
    rejected,
)


# The columns that tell the folder of a line.
FOLDER = ("Quarter", "service")


def _write_lines(records_: DataFrame, code: str, landing: str, together: bool = False) -> None:
    """Records as report files; ``together`` says that those of a folder are so already.

    If they are not, each task leaves a file in each folder.
    """
    if not together:
        records_ = records_.hint("rebalance", *[F.col(c) for c in FOLDER])
    name = F.col("service")
    for short, long in FILE_NAMES.items():
        name = F.when(F.col("service") == short, long).otherwise(name)
    lines = to_lines(records_, code).select("value", "Quarter", name.alias("report"))
    lines.write.mode("append").partitionBy("Quarter", "report").text(landing)


@check("dsr_scan", with_records("""
SELECT service, "Quarter", "BlockId", "SalesTransactionId", "DspResourceId", "Usages", "NetRevenue",
    "ValidityPeriodStart", "DATE_SALE" FROM su"""))
def dsr_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Report files in folders, read as text and typed."""
    landing = scratch_folder(spark, "scan")
    _write_lines(sales(spark, sf), "SU03.02", landing)
    good, _ = check_bad_rows(read_dsr(spark, landing))
    return typed_records(good, "SU03.02").select(
        "service", "Quarter", "BlockId", "SalesTransactionId", "DspResourceId", "Usages",
        "NetRevenue", "ValidityPeriodStart", "DATE_SALE",
    )


@check("stream_ingest", with_records("""
SELECT service, "Quarter", "BlockId", "RightsController", "AllocatedUsages",
    "ParentSalesTransactionId" FROM li"""))
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Files of all services and quarters; the second run finds nothing new."""
    base = scratch_folder(spark, "intake")
    landing, store, state = (f"{base}/{part}" for part in ("landing", "store", "state"))
    _write_lines(claims(spark, sf, FOLDER), "LI01.03", landing, together=True)
    ingest(spark, landing, store, state)
    ingest(spark, landing, store, state)
    return typed_records(records(spark, store), "LI01.03").select(
        "service", "Quarter", "BlockId", "RightsController", "AllocatedUsages",
        "ParentSalesTransactionId",
    )


# --- versions of files ------------------------------------------------------------

SERVICE_SQL = """CASE o_orderkey % 4 WHEN 0 THEN 'ads' WHEN 1 THEN 'hardware'
    WHEN 2 THEN 'subs_music' ELSE 'subs_premium' END"""
USED_SQL = """
SELECT service, block, usages FROM (
    SELECT {service} AS service, CAST(o_orderkey AS VARCHAR) AS block, {usages} AS usages FROM orders
) WHERE usages IS NOT NULL"""


def _put(spark: SparkSession, lines: DataFrame, path: str) -> None:
    """Write lines to one file of a given name, over what is there."""
    folder = scratch_folder(spark, "lines")
    lines.coalesce(1).write.text(folder)
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = files.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = system.globStatus(files.Path(f"{folder}/part-*"))[0].getPath()
    system.mkdirs(place.getParent())
    system.delete(place, False)
    system.rename(part, place)


def _send(spark: SparkSession, sf: str, landing: str, service: str, line: Column) -> None:
    """All orders of a service as one report file; a null line is left out."""
    number = list(FILE_NAMES).index(service)
    orders = table(spark, sf, "orders").where(F.col("o_orderkey") % 4 == number)
    rows = orders.select(line.alias("value")).where("value IS NOT NULL")
    _put(spark, rows, f"{landing}/1998_Q1/{FILE_NAMES[service]}")


def _used(usages: Column) -> Column:
    """An ST01 line of the order; null usages give no line."""
    return F.concat(F.lit("ST01\t"), F.col("o_orderkey"), F.lit("\ts\tS\t"), usages)


def _short() -> Column:
    """An ST01 line of the wrong width."""
    return F.concat(F.lit("ST01\t"), F.col("o_orderkey"))


def _stored(spark: SparkSession, store: str) -> DataFrame:
    rows = typed_records(records(spark, store), "ST01")
    return rows.select("service", F.col("BlockId").alias("block"), F.col("Usages").alias("usages"))


@check("intake_sent_again", USED_SQL.format(service=SERVICE_SQL, usages="""CASE
    WHEN o_orderkey % 4 >= 2 THEN 1 WHEN o_orderkey % 3 = 0 THEN 2 END"""))
def sent_again(spark: SparkSession, sf: str) -> DataFrame:
    """Two of four files come again under their name, with fewer lines and other values."""
    base = scratch_folder(spark, "again")
    landing, store, state = (f"{base}/{part}" for part in ("landing", "store", "state"))
    for service in FILE_NAMES:
        _send(spark, sf, landing, service, _used(F.lit(1)))
    ingest(spark, landing, store, state)
    for service in ("ads", "hardware"):
        _send(spark, sf, landing, service, _used(F.when(F.col("o_orderkey") % 3 == 0, 2)))
    ingest(spark, landing, store, state)
    return _stored(spark, store)


# --- intake by a log of changes ---------------------------------------------------

@check("intake_changes", USED_SQL.format(service=SERVICE_SQL, usages="""CASE
    WHEN o_orderkey % 4 = 2 THEN 3
    WHEN o_orderkey % 4 = 3 OR o_orderkey % 8 >= 4 THEN 1
    WHEN o_orderkey % 3 = 0 THEN 2 END"""))
def changed_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Deliveries in two parts; parts come again under new names, then one delivery as a whole.

    A file that no event names is not taken, nor does a deletion count.
    """
    base = scratch_folder(spark, "changes")
    log, landing, store, state = (f"{base}/{part}" for part in ("log", "landing", "store", "state"))
    orders = table(spark, sf, "orders")

    def send(service: str, mark: str, usages: Column, minute: int, kind: str = "finalized") -> None:
        key, (part, parts) = F.col("o_orderkey"), (int(n) for n in mark.split("of"))
        of_part = (F.floor(key / 4) % parts == part - 1) & (key % 4 == list(FILE_NAMES).index(service))
        name = f"1998_Q1/Report_{FILE_NAMES[service]}_{mark}_19980501T00{minute:02}00.tsv"
        lines = orders.where(of_part).select(_used(usages).alias("value")).where("value IS NOT NULL")
        _put(spark, lines, f"{landing}/{name}")
        event = [F.lit(kind).alias("kind"), F.lit(f"landing/{name}").alias("name")]
        at = F.lit(f"1998-05-01T00:{minute:02}:00Z").alias("at")
        spark.range(1).select(*event, at).write.mode("append").json(log)

    for service in FILE_NAMES:
        for mark in ("1of2", "2of2"):
            send(service, mark, F.lit(1), 1)
    ingest_changes(spark, log, landing, store, state)
    for service in ("ads", "hardware"):
        send(service, "1of2", F.when(F.col("o_orderkey") % 3 == 0, 2), 2)
    send("subs_premium", "1of2", F.lit(9), 2, kind="deleted")
    ingest_changes(spark, log, landing, store, state)
    send("subs_music", "1of1", F.lit(3), 3)
    ingest_changes(spark, log, landing, store, state)
    ingest_changes(spark, log, landing, store, state)
    rows = typed_records(part_records(spark, store), "ST01")
    return rows.select("service", F.col("BlockId").alias("block"), F.col("Usages").alias("usages"))


@check("intake_new_checkpoint", USED_SQL.format(service=SERVICE_SQL, usages="1"))
def new_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    """A second checkpoint on the same store: nothing is lost, nothing counts twice."""
    base = scratch_folder(spark, "checkpoint")
    landing, store = f"{base}/landing", f"{base}/store"
    for state, services in (("one", ("ads", "hardware")), ("two", ("subs_music", "subs_premium"))):
        for service in services:
            _send(spark, sf, landing, service, _used(F.lit(1)))
        ingest(spark, landing, store, f"{base}/{state}")
    return _stored(spark, store)


@check("intake_rejected", """
SELECT status, service, count(*) AS n FROM (
    SELECT *, CASE WHEN service = 'hardware' THEN 'rejected' ELSE 'good' END AS status
    FROM (SELECT """ + SERVICE_SQL + """ AS service FROM orders)
) GROUP BY ALL""")
def rejected_file(spark: SparkSession, sf: str) -> DataFrame:
    """One file of malformed lines beside good ones, and a good file in a later run."""
    base = scratch_folder(spark, "rejected")
    landing, store, state = (f"{base}/{part}" for part in ("landing", "store", "state"))
    _send(spark, sf, landing, "ads", _used(F.lit(1)))
    _send(spark, sf, landing, "hardware", _short())
    _send(spark, sf, landing, "subs_music", _used(F.lit(1)))
    ingest(spark, landing, store, state, max_bad=5)
    _send(spark, sf, landing, "subs_premium", _used(F.lit(1)))
    ingest(spark, landing, store, state, max_bad=5)
    taken = _stored(spark, store).groupBy("service").agg(F.count("*").alias("n"))
    refused = rejected(spark, store).select("service", F.col("bad").alias("n"))
    return taken.withColumn("status", F.lit("good")).unionByName(
        refused.withColumn("status", F.lit("rejected"))
    )


@check("intake_spoilt", """
SELECT place, service, block FROM (
    SELECT """ + SERVICE_SQL + """ AS service, CAST(o_orderkey AS VARCHAR) AS block FROM orders
) JOIN (VALUES ('ads', 'quarantine'), ('hardware', 'stored'), ('subs_music', 'stored'),
    ('subs_premium', 'stored')) AS p(name, place) ON service = name""")
def spoilt_file(spark: SparkSession, sf: str) -> DataFrame:
    """A good file comes again with malformed lines only: its old rows are gone."""
    base = scratch_folder(spark, "spoilt")
    landing, store, state = (f"{base}/{part}" for part in ("landing", "store", "state"))
    for service in FILE_NAMES:
        _send(spark, sf, landing, service, _used(F.lit(1)))
    ingest(spark, landing, store, state, max_bad=5)
    _send(spark, sf, landing, "ads", _short())
    ingest(spark, landing, store, state, max_bad=5)
    aside = quarantine(spark, store).select("service", F.get("f", F.lit(1)).alias("block"))
    return _stored(spark, store).select("service", "block").withColumn(
        "place", F.lit("stored")
    ).unionByName(aside.withColumn("place", F.lit("quarantine")))


@check("stream_metadata", """
SELECT s_name AS "Artist", CAST(s_nationkey AS VARCHAR) AS country, CAST(s_suppkey AS VARCHAR) AS note
FROM supplier""")
def stream_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata files of the ranked artists, with a header, taken in beside a report file."""
    base = scratch_folder(spark, "stream-metadata")
    landing, store, state = (f"{base}/{part}" for part in ("landing", "store", "state"))
    line = F.concat_ws("\t", "s_name", "s_nationkey", "s_suppkey").alias("value")
    header = spark.createDataFrame([("Artist\tcountry\tnote",)], "value string")
    for rest in (0, 1):
        rows = table(spark, sf, "supplier").where(F.col("s_suppkey") % 2 == rest).select(line)
        name = f"{landing}/extra/top_residual_artists_metadata_{rest}.tsv"
        _put(spark, header.unionByName(rows), name)
    _send(spark, sf, landing, "ads", _used(F.lit(1)))
    ingest(spark, landing, store, state)
    return artist_metadata(spark, store, ["Artist", "country", "note"])


@check("stream_gate", """
SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) || '_Q' || CAST(quarter(o_orderdate) AS VARCHAR)
    AS quarter, '' AS missing FROM orders""")
def stream_gate(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_folder(spark, "gate")
    rows = summary_rows(spark, sf).select(
        "service", "Quarter", F.col("SummaryRecordId").alias("BlockId"),
        F.lit("s").alias("ParentSalesTransactionId"), "SummaryRecordId", F.lit(1).alias("Usages"),
    )
    _write_lines(rows, "ST01", f"{base}/landing")
    ingest(spark, f"{base}/landing", f"{base}/store", f"{base}/state")
    return missing_services(manifest(spark, f"{base}/store")).select(
        "quarter", F.array_join("missing", ",").alias("missing")
    )


@check("loaded_scalars", with_records("""
SELECT service, "UsagesTotal", CAST(earned - paid AS DOUBLE) AS "Pool", 2 AS worked_out
FROM (
    SELECT service,
        CAST(sum(CASE WHEN "RightsType" = 'MechanicalRight' THEN CAST("AllocatedUsages" AS DECIMAL(28,4)) END)
            AS DOUBLE) AS "UsagesTotal",
        sum(CAST("AllocatedAmount" AS DECIMAL(28,4))) AS paid
    FROM li WHERE "RightsController" = 'PubA' GROUP BY service
) JOIN (
    SELECT service, sum(CAST("AllocatedRevenue" AS DECIMAL(28,4))) AS earned
    FROM sy WHERE "RightsController" = 'PubA' GROUP BY service
) USING (service)"""))
def all_loaded_scalars(spark: SparkSession, sf: str) -> DataFrame:
    """Scalars over all quarters after two loads; runs that found nothing new work out nothing."""
    base = scratch_folder(spark, "scalars")
    landing, store, state = (f"{base}/{part}" for part in ("landing", "store", "state"))
    terms = ReportTerms(CLAIMANT, "p", "s", "c", money_type=EXACT)
    late, worked = F.substring("Quarter", -1, 1).isin("3", "4"), []
    for part in (~late, late):
        _write_lines(claims(spark, sf, FOLDER).where(part), "LI01.03", landing, together=True)
        _write_lines(padded(summary_rows(spark, sf).where(part), "SY05.03"), "SY05.03", landing)
        ingest(spark, landing, store, state)
        worked += [update_scalars(spark, store, terms), update_scalars(spark, store, terms)]
    runs = sum(bool(w) for w in worked) if not set(worked[0]) & set(worked[2]) else 0
    return loaded_scalars(spark, store, terms).withColumn("worked_out", F.lit(runs))


@check("stream_completed", """
SELECT DISTINCT quarter, CASE WHEN quarter LIKE '%Q3' OR quarter LIKE '%Q4' THEN 1 ELSE 2 END AS run,
    1 AS times, 'ads,hardware,subs_music,subs_premium' AS services
FROM (
    SELECT CAST(year(o_orderdate) AS VARCHAR) || '_Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter
    FROM orders
)""")
def stream_completed(spark: SparkSession, sf: str) -> DataFrame:
    """Hardware files of the first half of each year come late; each quarter is emitted once."""
    base = scratch_folder(spark, "completed")
    landing, store, state, gate = (f"{base}/{part}" for part in ("landing", "store", "state", "gate"))
    rows = summary_rows(spark, sf).select(
        "service", "Quarter", F.col("SummaryRecordId").alias("BlockId"),
        F.lit("s").alias("ParentSalesTransactionId"), "SummaryRecordId", F.lit(1).alias("Usages"),
    )
    late = (F.col("service") == "hardware") & F.substring("Quarter", -1, 1).isin("1", "2")
    runs = []
    # The fourth part sends files of complete quarters again, under new names.
    for part in (rows.where(~late), None, rows.where(late), rows.where("service = 'ads'")):
        if part is not None:
            _write_lines(part, "ST01", landing)
            ingest(spark, landing, store, state)
        runs.append(emit_completed(spark, store, gate))
    run = F.when(F.col("quarter").isin(runs[0] or [""]), 1).when(F.col("quarter").isin(runs[2] or [""]), 2)
    return completed(spark, store).groupBy("quarter").agg(
        F.max(run).alias("run"), F.count("*").cast("int").alias("times"),
        F.max(F.array_join("services", ",")).alias("services"),
    )


@check("export_top", with_records("SELECT * FROM ranked20", merged_sql(), RANKED))
def export_top_check(spark: SparkSession, sf: str) -> DataFrame:
    """Ranking as one CSV file, read back."""
    path = scratch_folder(spark, "export")
    r = report_records(spark, sf)
    top = top_residual_artists(r.as_, r.su, r.li, TOP)
    export_top(top, path)
    return spark.read.option("header", "true").schema(top.schema).csv(path)


@check("report_snapshot", with_records("""
SELECT place, r.* FROM (
    SELECT DISTINCT l.service, l."Quarter" AS quarter, l."BlockId", a."ResourceISRC" AS isrc,
        a."ResourceTitle" AS title, s."Usages" AS usages, l."AllocatedAmount" AS amount,
        l."AllocatedUsages" AS allocated, s."SalesTransactionId" AS txn
    FROM li l
    JOIN su s ON l.service = s.service AND l."BlockId" = s."BlockId"
        AND l."ParentSalesTransactionId" = s."SalesTransactionId" AND l."Quarter" = s."Quarter"
    JOIN as_ a ON l.service = a.service AND l."BlockId" = a."BlockId"
        AND s."DspResourceId" = a."DspResourceId" AND s."Quarter" = a."Quarter"
    WHERE "RightsController" = 'PubA' AND "RightsType" = 'MechanicalRight'
        AND l."Quarter" IN ('1997_Q4', '1998_Q1')
) r JOIN (VALUES ('latest', '1998_Q1'), ('1997Q4', '1997_Q4'), ('1998Q1', '1998_Q1')) AS p(place, q)
    ON r.quarter = p.q"""))
def report_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of two quarters published one after the other: the latest, and the copy of each."""
    path = scratch_folder(spark, "snapshot")
    r = report_records(spark, sf)
    key = ["service", "BlockId", "Quarter"]
    own = r.li.where("RightsController = 'PubA' AND RightsType = 'MechanicalRight'")
    sold = own.join(
        r.su.withColumnRenamed("SalesTransactionId", "ParentSalesTransactionId").drop("SummaryRecordId"),
        [*key, "ParentSalesTransactionId"],
    )
    rows = sold.join(r.as_, [*key, "DspResourceId"]).select(
        "service", F.col("Quarter").alias("quarter"), "BlockId", F.col("ResourceISRC").alias("isrc"),
        F.col("ResourceTitle").alias("title"), F.col("Usages").alias("usages"),
        F.col("AllocatedAmount").alias("amount"), F.col("AllocatedUsages").alias("allocated"),
        F.col("ParentSalesTransactionId").alias("txn"),
    ).distinct()
    for quarter in ("1997_Q4", "1998_Q1"):
        write_report(rows.where(F.col("quarter") == quarter), path, quarter)
    latest = read_report(spark, path).withColumn("place", F.lit("latest"))
    kept = read_report(spark, path, BY_PERIOD).withColumnRenamed("period", "place")
    return latest.unionByName(kept)


@check("append_records", with_records("""
SELECT service, "Quarter", "BlockId", "SalesTransactionId", "DspResourceId", "Usages", "NetRevenue" FROM su"""))
def append_check(spark: SparkSession, sf: str) -> DataFrame:
    """The same records written twice count once."""
    path = scratch_folder(spark, "append")
    rows = sales(spark, sf).select(
        "service", "Quarter", "BlockId", "SalesTransactionId", "DspResourceId", "Usages", "NetRevenue"
    )
    append_records(rows, path)
    append_records(rows, path)
    return spark.read.parquet(path)


@check("write_replace", "SELECT DISTINCT p_brand AS brand FROM part")
def replace_check(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "replace")
    write_replace(table(spark, sf, "supplier").select(F.col("s_name").alias("brand")), path)
    write_replace(table(spark, sf, "part").select(F.col("p_brand").alias("brand")).distinct(), path)
    return spark.read.parquet(path)


@check("write_by_key", """
SELECT p_brand AS artist, replace(p_name, ' ', '_') AS name_folder, CAST(p_partkey AS VARCHAR) AS id
FROM part""")
def by_key(spark: SparkSession, sf: str) -> DataFrame:
    """One CSV folder per name, spaces replaced, read back with the folder as column."""
    path = scratch_folder(spark, "by-key")
    rows = table(spark, sf, "part").select(
        F.col("p_brand").alias("artist"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name")
    )
    write_by_key(rows, "name", path, "tracks", "2020-01-01", "2022-12-31")
    return spark.read.option("header", "true").csv(f"{path}/tracks_2020-01-01_2022-12-31").select(
        "artist", "name_folder", "id"
    )


@check("artist_metadata_append", """
SELECT s_name AS "Artist", CAST(s_nationkey AS VARCHAR) AS country, CAST(s_suppkey AS VARCHAR) AS note
FROM supplier UNION ALL SELECT s_name, CAST(s_nationkey AS VARCHAR), CAST(s_suppkey AS VARCHAR)
FROM supplier""")
def artist_metadata_append(spark: SparkSession, sf: str) -> DataFrame:
    """A metadata file loaded twice: appended as it comes, so its rows are there twice."""
    base = scratch_folder(spark, "metadata")
    rows = table(spark, sf, "supplier").select(
        F.col("s_name").alias("Artist"), F.col("s_nationkey").alias("country"),
        F.col("s_suppkey").alias("note"),
    )
    source, target = f"{base}/top_residual_artists_metadata.tsv", f"{base}/table"
    rows.write.option("sep", "\t").option("header", "true").csv(source)
    schema = "Artist string, country string, note string"
    load_artist_metadata(spark, source, target, schema)
    return load_artist_metadata(spark, source, target, schema)


@check("landed_files", """
SELECT o_orderkey AS track_id, o_orderpriority AS platform, o_totalprice AS value
FROM orders WHERE o_orderkey % 5 > 0""")
def landed_files(spark: SparkSession, sf: str) -> DataFrame:
    """Responses written as JSON files and read back; some have no payload."""
    path = scratch_folder(spark, "landed")
    key = F.col("o_orderkey")
    points = F.array(F.struct(F.col("o_totalprice").alias("value")))
    empty = F.array().cast("array<struct<value: double>>")
    obj = F.when(key % 5 > 0, points).when(key % 10 == 0, empty)
    table(spark, sf, "orders").select(
        key.alias("track_id"), F.col("o_orderpriority").alias("platform"), obj.alias("obj")
    ).write.json(path)
    rows = read_landed(
        spark, path, "array<struct<value: double>>", "track_id bigint, platform string"
    )
    return rows.select("track_id", "platform", F.explode("obj.value").alias("value"))


@check("landed_unknown_shape", """
SELECT track_id, "id", price AS "price.total", currency AS "price.currency", clerk AS "clerk.name",
    tags AS "clerk.tags", mix
FROM (
    SELECT o_orderkey AS track_id, o_custkey AS id,
        CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_totalprice AS DOUBLE) END AS price,
        CASE WHEN o_orderkey % 3 = 2 THEN 'EUR' END AS currency,
        CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority END AS clerk,
        CASE WHEN o_orderkey % 3 = 1 THEN concat(o_orderkey, ',', o_custkey) END AS tags,
        CASE WHEN o_orderkey % 3 = 2 THEN CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR)
            ELSE o_orderstatus END END AS mix
    FROM orders WHERE o_orderkey % 5 > 0)""")
def landed_unknown_shape(spark: SparkSession, sf: str) -> DataFrame:
    """Responses whose fields no schema names, flat; fields differ from row to row, and one in kind."""
    path = scratch_folder(spark, "unknown")
    key = F.col("o_orderkey")
    texts = [F.lit('{"track_id":'), key, F.lit(',"obj":{"id":'), F.col("o_custkey")]
    price = F.concat(F.lit(',"price":{"total":'), F.col("o_totalprice").cast("string"), F.lit("}}}"))
    name = F.to_json(F.struct(F.col("o_orderpriority").alias("name"), F.array(key, F.col("o_custkey")).alias("tags")))
    clerk = F.concat(F.lit(',"clerk":'), name, F.lit("}}"))
    status = F.concat(F.lit('"'), F.col("o_orderstatus"), F.lit('"'))
    mix = F.when(key % 2 == 0, F.col("o_custkey").cast("string")).otherwise(status)
    other = F.concat(F.lit(',"price":{"currency":"EUR"},"mix":'), mix, F.lit("}}"))
    some = F.concat(*texts, F.when(key % 3 == 0, price).when(key % 3 == 1, clerk).otherwise(other))
    none = F.concat(F.lit('{"track_id":'), key, F.when(key % 2 == 0, ',"obj":{}}').otherwise("}"))
    rows = table(spark, sf, "orders").select(F.when(key % 5 > 0, some).otherwise(none).alias("value"))
    rows.write.text(path)
    flat = flatten_documents(payloads(read_documents(spark, path), tags="track_id bigint"))
    tags = F.array_join(F.col("`clerk.tags`").cast("array<string>"), ",")
    return flat.withColumn("clerk.tags", tags)


@check("seed_file", """
SELECT c_custkey, c_name FROM customer WHERE c_name IN (SELECT c_name FROM customer WHERE c_acctbal > 0)""")
def seed_file(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "seeds")
    customers = table(spark, sf, "customer")
    customers.where("c_acctbal > 0").select(F.col("c_name").alias("artist"), "c_custkey").write.option(
        "header", "true"
    ).csv(path)
    seeds = rename(read_seed_artists(spark, path), {"artist": "c_name"})
    return customers.select("c_custkey", "c_name").join(seeds, "c_name", "left_semi")
