"""Parquet tables and CSV exports."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staveline.functions.text import path_name
from staveline.operators.frames import quoted
from staveline.session import settled

PARTITIONS = ("service", "Quarter")


def write_replace(df: DataFrame, path: str) -> None:
    """Replace the whole table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def append_records(
    df: DataFrame, path: str, partitions: Sequence[str] = PARTITIONS, replace: bool = True
) -> None:
    """Write the partitions the rows belong to; other partitions stay.

    Writing the same rows again replaces them, so a re-run changes nothing.
    Without ``replace`` they are added, and count twice.
    """
    # Rows of a folder come together, so files do not multiply with tasks.
    together = df.hint("rebalance", *[F.col(quoted(p)) for p in partitions])
    together.write.mode("overwrite" if replace else "append").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*partitions).parquet(path)


def check_schema(df: DataFrame, fields: str) -> DataFrame:
    """The frame in the column order of the field list; fails on a different type."""
    schema = T.StructType.fromDDL(fields)
    ordered = df.select(*[F.col(quoted(n)) for n in schema.names])
    for have, want in zip(ordered.schema.fields, schema.fields):
        if have.dataType != want.dataType:
            raise TypeError(f"{want.name}: {have.dataType.simpleString()}, expected "
                            f"{want.dataType.simpleString()}")
    return ordered


def period_of(quarter: str) -> str:
    """``2024_Q1`` -> ``2024Q1``."""
    year, _, part = quarter.partition("_")
    return f"{year}{part}"


LATEST, BY_PERIOD, COMMITS = "latest", "by_period", "_commits"


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _newest_commit(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and content of the newest commit; the content names the version of each part."""
    system, folder = _file_system(spark, f"{path}/{COMMITS}")
    if not system.exists(folder):
        return 0, {LATEST: {}, BY_PERIOD: {}}
    names = [f.getPath().getName() for f in system.listStatus(folder)]
    number = max((int(n) for n in names if n.isdigit()), default=0)
    if not number:
        return 0, {LATEST: {}, BY_PERIOD: {}}
    text = spark.read.option("wholetext", "true").text(f"{path}/{COMMITS}/{number:010d}").first()[0]
    return number, json.loads(text)


def _commit(spark: SparkSession, path: str, number: int, content: dict) -> None:
    """Make the content current. Fails if another writer has taken the number."""
    system, target = _file_system(spark, f"{path}/{COMMITS}/{number:010d}")
    # Written under another name first: the commit appears whole or not at all.
    _, written = _file_system(spark, f"{path}/{COMMITS}/.{number:010d}-{uuid.uuid4().hex}")
    out = system.create(written)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()
    if system.exists(target) or not system.rename(written, target):
        system.delete(written, False)
        raise RuntimeError(f"{path} was written by another job meanwhile")


def write_report(df: DataFrame, path: str, quarter: str) -> None:
    """The latest report of each service, and a copy kept under its period.

    Both are written as folders of a new version, which no reader sees before the one
    commit that names them: a failure in between leaves the pair as it was. Services
    and periods that have no rows in ``df`` keep their version.
    """
    spark = df.sparkSession
    report = settled(df, "report")
    version, period = uuid.uuid4().hex, period_of(quarter)
    number, content = _newest_commit(spark, path)
    services = [r.service for r in report.select("service").distinct().collect()]
    if not services:
        return
    _write_version(report, f"{path}/{LATEST}/version={version}", "service")
    _write_version(
        report.withColumn("period", F.lit(period)), f"{path}/{BY_PERIOD}/version={version}", "period", "service"
    )
    content[LATEST].update({s: version for s in services})
    content[BY_PERIOD].update({f"{period} {s}": version for s in services})
    _commit(spark, path, number + 1, content)


def _write_version(df: DataFrame, folder: str, *partitions: str) -> None:
    together = df.hint("rebalance", *[F.col(p) for p in partitions])
    together.write.partitionBy(*partitions).parquet(folder)


def read_report(spark: SparkSession, path: str, name: str = LATEST) -> DataFrame:
    """The committed rows of ``latest`` or ``by_period``; folders of other versions are not read."""
    _, content = _newest_commit(spark, path)
    if not content[name]:
        raise ValueError(f"nothing was published in {path}")
    rows = spark.read.parquet(f"{path}/{name}")
    period = F.concat(F.col("period"), F.lit(" ")) if name == BY_PERIOD else F.lit("")
    part = F.concat(period, F.col("service"))
    # One entry for each service (and period).
    current = [f"{version} {key}" for key, version in content[name].items()]
    return rows.where(F.concat(F.col("version"), F.lit(" "), part).isin(current)).drop("version")


def drop_old_versions(spark: SparkSession, path: str) -> list[str]:
    """Remove the folders that the newest commit does not name; no writer may be at work."""
    _, content = _newest_commit(spark, path)
    removed = []
    for name in (LATEST, BY_PERIOD):
        system, folder = _file_system(spark, f"{path}/{name}")
        for status in system.listStatus(folder) if system.exists(folder) else []:
            version = status.getPath().getName().removeprefix("version=")
            if version not in content[name].values():
                system.delete(status.getPath(), True)
                removed.append(f"{name}/{version}")
    return removed


def export_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with header. ``single`` is for results of bounded size, such as a top-k."""
    out = df.coalesce(1) if single else df
    out.write.mode("overwrite").option("header", "true").csv(path)


def write_by_key(
    df: DataFrame, key: str, path: str, label: str, start: str = "", end: str = ""
) -> None:
    """CSV with one folder per key value; label and date range name the table."""
    name = "_".join(part for part in (label, start, end) if part)
    folder = f"{key}_folder"
    rows = df.withColumn(folder, path_name(F.col(quoted(key))))
    # Rows of a key come together, but a key with very many rows is split.
    rows.hint("rebalance", F.col(quoted(folder))).write.mode("overwrite").partitionBy(
        folder
    ).option("header", "true").csv(f"{path}/{name}")
