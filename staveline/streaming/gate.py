"""The completeness gate as a stream: each quarter once, when its last service has come."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from staveline.session import ship_package
from staveline.sources.dsr import SERVICES
from staveline.streaming.intake import GOOD, MANIFEST, MANIFEST_FIELDS

COMPLETED = "completed"
COMPLETED_FIELDS = "load string, quarter string, services array<string>"


def _gate(required: Sequence[str]):
    """State of a quarter: the services seen, and whether it was emitted."""

    def step(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, emitted = (set(state.get[0]), state.get[1]) if state.exists else (set(), False)
        for frame in frames:
            seen.update(s for s in frame["service"] if s is not None)
        complete = seen.issuperset(required)
        state.update((sorted(seen), emitted or complete))
        if complete and not emitted:
            yield pd.DataFrame({"quarter": [key[0]], "services": [sorted(seen)]})

    return step


def _folder(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(place)


def emit_completed(
    spark: SparkSession, store: str, checkpoint: str, required: Sequence[str] = SERVICES
) -> list[str]:
    """Follow the manifest of the store and emit the quarters that became complete; then stop.

    Only manifest files that are new since the last run are read. The services of each
    quarter are kept as state, a few names a quarter, in the checkpoint. A quarter is
    emitted when the first good file of its last service arrives, and never again:
    not for files sent again, not after a restart. The batches are folders of
    ``completed`` that a retry replaces, so a batch that was cut short counts once.
    Returns the quarters of this run.
    """
    ship_package(spark)
    _folder(spark, f"{store}/{MANIFEST}")
    files = spark.readStream.schema(MANIFEST_FIELDS).parquet(f"{store}/{MANIFEST}")
    good = files.where((F.col("status") == GOOD) & F.col("quarter").isNotNull()).select("quarter", "service")
    complete = good.groupBy("quarter").applyInPandasWithState(
        _gate(tuple(required)), "quarter string, services array<string>",
        "services array<string>, emitted boolean", "append", GroupStateTimeout.NoTimeout,
    )
    emitted = []

    def keep(batch: DataFrame, number: int) -> None:
        state = batch.sparkSession.read.text(f"{checkpoint}/metadata")
        query = state.select(F.get_json_object("value", "$.id")).first()[0]
        folder = f"{store}/{COMPLETED}/load={query}-{number}"
        # A few quarters a run; one file.
        batch.coalesce(1).write.mode("overwrite").parquet(folder)
        emitted.append(folder)

    query = (
        complete.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(keep)
        .start()
    )
    query.awaitTermination()
    rows = [spark.read.schema("quarter string").parquet(f).collect() for f in emitted]
    return sorted(r.quarter for part in rows for r in part)


def completed(spark: SparkSession, store: str) -> DataFrame:
    """(load, quarter, services) of every quarter that was emitted."""
    _folder(spark, f"{store}/{COMPLETED}")
    return spark.read.schema(COMPLETED_FIELDS).parquet(f"{store}/{COMPLETED}")
