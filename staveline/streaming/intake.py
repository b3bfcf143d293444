"""New report files into record tables, and the completeness gate.

Each micro-batch goes to its own ``load=<query id>-<batch id>`` folder, which a
retry of the batch replaces as a whole; another checkpoint has another query id.
The file source takes a path once, so files that were sent again under their old
name are found by their time of modification and loaded after it. The manifest
holds every version of every file with a verdict; readers take the newest version
of each file, if that is a good one. So each file counts once. A file without any
byte is no version.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staveline.session import shuffles_dropped
from staveline.sources.dsr import (
    MAX_BAD_ROWS,
    SERVICES,
    fields,
    is_routed,
    object_name,
    parse_lines,
    well_formed,
)
from staveline.sources.layouts import LAYOUTS
from staveline.sources.lookups import is_artist_metadata

RECORDS, MANIFEST = "records", "manifest"
GOOD, METADATA, BAD_ROUTE, BAD_WIDTH = "good", "metadata", "route", "width"
REJECTED = "rejected"  # a file with too many rows of the wrong width
OTHER = "other"  # folder of rows without a known record code
STORED = (
    "load string, status string, record_type string, service string, quarter string, file string, "
    "modified timestamp, f array<string>"
)
MANIFEST_FIELDS = (
    "load string, status string, service string, quarter string, file string, "
    "modified timestamp, rows long, bad long"
)
VERSION = ["file", "modified", "load"]


def _together(df: DataFrame, *partitions: str) -> DataFrame:
    # Rows of a folder come together before they are written, so that the number
    # of files follows the folders and not the tasks; a large folder is split.
    return df.hint("rebalance", *[F.col(c) for c in partitions])


def _write(df: DataFrame, path: str, *partitions: str) -> None:
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            *partitions
        ).parquet(path)


def load_batch(
    lines: DataFrame, load: str, store: str, max_bad: int = MAX_BAD_ROWS
) -> None:
    """Store one batch of lines (value, file, modified) and the verdict on each file.

    A file with more than ``max_bad`` rows of the wrong width is rejected as a whole;
    the others are not held up by it. The text is read once. The manifest is written last, from the
    stored rows: a batch that failed is in no manifest, so no reader sees its rows.
    """
    spark = lines.sparkSession
    status = (
        F.when(is_artist_metadata(F.col("file")), METADATA)
        .when(~F.coalesce(is_routed(), F.lit(False)), BAD_ROUTE)
        .when(~well_formed(), BAD_WIDTH)
        .otherwise(GOOD)
    )
    rows = parse_lines(lines, keep=["modified", "value"]).withColumn("status", status)
    known = (F.col("status") == GOOD) & F.col("record_type").isin(list(LAYOUTS))
    rows = rows.withColumn("record_type", F.when(known, F.col("record_type")).otherwise(OTHER))
    folder, folders = f"{store}/{RECORDS}/load={load}", ["status", "record_type", "service", "quarter"]
    # The line is sent about as it is and split again: its fields take more room.
    sent = _together(rows.drop("f"), *folders).withColumn("f", fields()).drop("value")
    _write(sent, folder, *folders)

    stored = spark.read.schema(STORED.removeprefix("load string, ")).parquet(folder)
    counts = stored.groupBy("service", "quarter", "file", "modified").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("status") == BAD_WIDTH).alias("bad"),
        F.max(F.when(F.col("status").isin(METADATA, BAD_ROUTE), F.col("status"))).alias("special"),
    )
    verdict = F.coalesce("special", F.when(F.col("bad") > max_bad, REJECTED).otherwise(GOOD))
    files = counts.withColumn("status", verdict).drop("special")
    _write(_together(files, "status"), f"{store}/{MANIFEST}/load={load}", "status")


def _lines(df: DataFrame, landing: str) -> DataFrame:
    modified = F.col("_metadata.file_modification_time").alias("modified")
    return df.select("value", object_name(landing).alias("file"), modified)


def ingest(
    spark: SparkSession, landing: str, store: str, checkpoint: str, max_bad: int = MAX_BAD_ROWS,
    files_per_batch: int | None = None,
) -> list[str]:
    """Take in all files that arrived or changed since the last run, then stop.

    Returns the loads written; ``rejected`` names the files that were turned down.
    """
    loads = []
    reader = spark.readStream.option("recursiveFileLookup", "true").option("lineSep", "\n")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def take(batch: DataFrame, number: int) -> None:
        state = batch.sparkSession.read.text(f"{checkpoint}/metadata")
        query = state.select(F.get_json_object("value", "$.id")).first()[0]
        load_batch(batch, f"{query}-{number}", store, max_bad)
        loads.append(f"{query}-{number}")

    query = (
        _lines(reader.text(landing), landing)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(take)
        .start()
    )
    query.awaitTermination()
    return loads + _take_changed(spark, landing, store, max_bad)


def _take_changed(spark: SparkSession, landing: str, store: str, max_bad: int) -> list[str]:
    """Load the known files that have been modified since; at most one load."""
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{store}/{MANIFEST}")
    if not files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(files):
        return []
    # Only the listing is read here, not the files.
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing)
    found = listing.select(
        object_name(landing).alias("file"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )
    known = newest_files(spark, store).select("file", F.col("modified").alias("taken"))
    changed = found.join(known, "file").where(F.col("modified") > F.col("taken"))
    # As many names as files were sent again since the last run.
    names = changed.select("path", "file", "modified").collect()
    if not names:
        return []
    text = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(landing)
    lines = _lines(text.where(F.col("_metadata.file_path").isin([r.path for r in names])), landing)
    load = f"changed-{uuid.uuid4().hex}"
    load_batch(lines, load, store, max_bad)
    return [load]


def newest_files(spark: SparkSession, store: str) -> DataFrame:
    """The newest version of every file, whatever the verdict on it."""
    rows = spark.read.schema(MANIFEST_FIELDS).parquet(f"{store}/{MANIFEST}")
    newest = rows.groupBy("file").agg(F.max(F.struct("modified", "load")).alias("v"))
    return rows.join(newest.select("file", "v.modified", "v.load"), VERSION, "left_semi")


def manifest(spark: SparkSession, store: str, status: str = GOOD) -> DataFrame:
    """The current report files (or metadata files), each in its newest version."""
    return newest_files(spark, store).where(F.col("status") == status).drop("status")


def rejected(spark: SparkSession, store: str) -> DataFrame:
    """Files whose newest version was turned down, with the number of their bad rows."""
    return manifest(spark, store, REJECTED).select("service", "quarter", "file", "rows", "bad")


def _current(spark: SparkSession, store: str, status: str) -> DataFrame:
    rows = spark.read.schema(STORED).parquet(f"{store}/{RECORDS}").where(F.col("status") == status)
    return rows.join(manifest(spark, store, status).select(*VERSION), VERSION, "left_semi")


def records(spark: SparkSession, store: str) -> DataFrame:
    """All parsed records of the current files.

    ``record_type``, ``service`` and ``quarter`` are folders, so a filter on
    them decides which files are read at all.
    """
    return _current(spark, store, GOOD).select("service", "quarter", "file", "record_type", "f")


def artist_metadata(spark: SparkSession, store: str, columns: Sequence[str]) -> DataFrame:
    """Rows of the ranked-artist files, which come with a header line."""
    rows = _current(spark, store, METADATA).where(F.get("f", F.lit(0)) != columns[0])
    return rows.select(*[F.get("f", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def quarantine(spark: SparkSession, store: str) -> DataFrame:
    """Rows of the newest versions that are not read, with the reason.

    They could not be routed, have the wrong width, or stand in a rejected file.
    """
    rows = spark.read.schema(STORED).parquet(f"{store}/{RECORDS}").withColumnRenamed(
        "status", "reason"
    )
    newest = newest_files(spark, store).select(*VERSION, "status")
    refused = F.when(F.col("reason").isin(BAD_ROUTE, BAD_WIDTH), F.col("reason")).when(
        F.col("status") == REJECTED, REJECTED
    )
    return rows.join(newest, VERSION).withColumn("reason", refused).where(
        F.col("reason").isNotNull()
    ).drop("status")


def missing_services(files: DataFrame, required: Sequence[str] = SERVICES) -> DataFrame:
    """Per quarter the services no file has come for; complete quarters have none."""
    seen = files.groupBy("quarter").agg(F.collect_set("service").alias("seen"))
    missing = F.array_except(F.array(*[F.lit(s) for s in required]), "seen")
    return seen.select("quarter", missing.alias("missing"))


def complete_quarters(files: DataFrame, required: Sequence[str] = SERVICES) -> DataFrame:
    gate = missing_services(files, required)
    return gate.where(F.size("missing") == 0).select("quarter")
