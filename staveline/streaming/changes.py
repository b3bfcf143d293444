"""Report files taken in from a log of changes, and the current version of each part.

The log is a folder of JSON lines, one for each object that was finished, in files
that are only ever added. A run reads the log files that are new since the last one
and the report files they name, and lists no landing folder. What came is merged into
a snapshot: for each part of a delivery its newest version, whatever the name it came
under. The snapshot is written as a new version and made current by one commit, so a
reader needs neither the log nor the manifests of earlier runs.

A store is filled either this way or by ``intake.ingest``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staveline.sinks.tables import _commit, _file_system, _newest_commit
from staveline.sources.dsr import MAX_BAD_ROWS, object_name
from staveline.streaming.intake import (
    GOOD,
    MANIFEST,
    MANIFEST_FIELDS,
    RECORDS,
    STORED,
    VERSION,
    load_batch,
)

PARTS = "parts"
EVENT = "kind string, name string, at timestamp"
FINALIZED = "finalized"
PART_FIELDS = f"{MANIFEST_FIELDS}, series string, part int, parts int"
# Files of one load: the bound on the paths of a scan and on the rows joined to its lines.
FILES_PER_LOAD = 1000
SERIES = ["service", "quarter", "series"]


@dataclass
class Taken:
    """The loads of a run, and announced files that were gone when it came to them."""

    loads: list[str] = field(default_factory=list)
    absent: list[str] = field(default_factory=list)


def numbered_part(file: Column) -> dict[str, Column]:
    """Series, part and parts of a file name such as ``<series>_1of2_<time>.tsv``.

    What stands behind the mark, such as the time the file was made, does not tell
    files apart. A file without a mark is a series of its own, by its whole name.
    """
    base = F.lower(F.substring_index(file, "/", -1))
    mark = r"^(.*?)[_-](\d{1,6})of(\d{1,6})(?:[_.-].*)?$"
    marked = F.regexp_like(base, F.lit(mark))
    number = lambda i: F.when(marked, F.regexp_extract(base, mark, i)).otherwise("0").cast("int")
    return {
        "series": F.when(marked, F.regexp_extract(base, mark, 1)).otherwise(file),
        "part": number(2),
        "parts": number(3),
    }


def ingest_changes(
    spark: SparkSession, log: str, landing: str, store: str, checkpoint: str, max_bad: int = MAX_BAD_ROWS,
    files_per_batch: int | None = None, part: Callable[[Column], dict[str, Column]] = numbered_part,
) -> Taken:
    """Take in the files named by the log since the last run, then stop.

    ``name`` is the path from the last folder of ``landing`` on, as in ``object_name``;
    ``at`` is when the object was finished and decides which version is newer, not the
    file's time of modification. Kinds other than ``finalized`` are passed over; text
    that is no event fails the run. An event that is delivered twice, or a batch that is
    tried again, changes nothing. A file that is gone is named in the result.
    """
    system, folder = _file_system(spark, log)
    system.mkdirs(folder)
    taken = Taken()
    events = spark.readStream.schema(EVENT).option("mode", "FAILFAST")
    if files_per_batch:
        events = events.option("maxFilesPerTrigger", files_per_batch)

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        state = session.read.text(f"{checkpoint}/metadata")
        query = state.select(F.get_json_object("value", "$.id")).first()[0]
        finished = batch.where((F.col("kind") == FINALIZED) & F.col("name").isNotNull() & F.col("at").isNotNull())
        # One name for each file that the new log files announce.
        newest = finished.groupBy("name").agg(F.unix_micros(F.max("at")).alias("at"))
        found = sorted((r.name, r["at"]) for r in newest.collect())
        there = [(name, at) for name, at in found if _is_there(session, landing, name)]
        taken.absent.extend(sorted({name for name, _ in found} - {name for name, _ in there}))
        for i in range(0, len(there), FILES_PER_LOAD):
            load = f"{query}-{number}-{i // FILES_PER_LOAD}"
            load_batch(_announced(session, landing, there[i : i + FILES_PER_LOAD]), load, store, max_bad)
            _merge(session, store, load, part)
            taken.loads.append(load)

    running = (
        events.json(log)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(take)
        .start()
    )
    running.awaitTermination()
    return taken


def _path(landing: str, name: str) -> str:
    folder = landing.rstrip("/")
    return f"{folder[: len(folder) - len(folder.rsplit('/', 1)[-1])]}{name}"


def _is_there(spark: SparkSession, landing: str, name: str) -> bool:
    system, path = _file_system(spark, _path(landing, name))
    return system.exists(path)


def _announced(spark: SparkSession, landing: str, files: list[tuple[str, int]]) -> DataFrame:
    """Lines (value, file, modified) of these files; the time is that of the event."""
    # Signs that stand for other names in a path are meant as they are.
    paths = [re.sub(r"([\\*?\[\]{}])", r"\\\1", _path(landing, name)) for name, _ in files]
    text = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(paths)
    times = spark.createDataFrame([(quote(n, safe="/:@!$&'()*+,;="), at) for n, at in files], "file string, at long")
    lines = text.select("value", object_name(landing).alias("file"))
    # At most FILES_PER_LOAD rows.
    return lines.join(F.broadcast(times), "file").select("value", "file", F.timestamp_micros("at").alias("modified"))


def _merge(spark: SparkSession, store: str, load: str, part: Callable[[Column], dict[str, Column]]) -> None:
    """Bring the files of a load into the snapshot; doing it twice changes nothing."""
    manifests = spark.read.schema(MANIFEST_FIELDS).option("basePath", f"{store}/{MANIFEST}")
    fresh = manifests.parquet(f"{store}/{MANIFEST}/load={load}").withColumns(part(F.col("file")))
    number, content = _newest_commit(spark, f"{store}/{PARTS}")
    every = current_parts(spark, store).unionByName(fresh)
    rest = F.struct(*[c for c in every.columns if c not in (*SERIES, "part", "parts")])
    order = F.struct("modified", "file", "load")
    newest = every.groupBy(*SERIES, "part", "parts").agg(F.max_by(rest, order).alias("v"))
    # A delivery in another number of parts takes the place of the whole one before.
    latest = F.max_by("parts", F.struct("v.modified", "v.file", "v.load")).over(Window.partitionBy(*SERIES))
    kept = newest.withColumn("latest", latest).where("parts = latest").select(*SERIES, "part", "parts", "v.*")
    version = uuid.uuid4().hex
    kept.write.parquet(f"{store}/{PARTS}/{version}")
    _commit(spark, f"{store}/{PARTS}", number + 1, {"version": version, "before": content.get("version")})
    # The snapshot before this one stays for readers that have begun; the one before that goes.
    if content.get("before"):
        system, old = _file_system(spark, f"{store}/{PARTS}/{content['before']}")
        system.delete(old, True)


def current_parts(spark: SparkSession, store: str) -> DataFrame:
    """The newest version of every part, whatever the verdict on it."""
    version = _newest_commit(spark, f"{store}/{PARTS}")[1].get("version")
    if version is None:
        return spark.createDataFrame([], PART_FIELDS)
    return spark.read.schema(PART_FIELDS).parquet(f"{store}/{PARTS}/{version}")


def part_records(spark: SparkSession, store: str) -> DataFrame:
    """All parsed records of the current parts, if their newest version is a good one.

    As with ``intake.records``, filters on record type, service and quarter decide
    which folders are read.
    """
    good = current_parts(spark, store).where(F.col("status") == GOOD).select(*VERSION)
    rows = spark.read.schema(STORED).parquet(f"{store}/{RECORDS}").where(F.col("status") == GOOD)
    return rows.join(good, VERSION, "left_semi").select("service", "quarter", "file", "record_type", "f")
