"""From new report files to reports and, once a quarter is complete, the ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staveline.plans.ranking import (
    RankingTerms,
    export_top,
    top_artist_songs,
    top_residual_artists,
)
from staveline.plans.report import ReportTerms, royalty_report
from staveline.plans.scalars import loaded_scalars, update_scalars
from staveline.session import settled
from staveline.sinks.tables import write_replace, write_report
from staveline.sources.dsr import SERVICES, summaries, typed_records
from staveline.streaming.intake import (
    GOOD,
    MANIFEST,
    MANIFEST_FIELDS,
    REJECTED,
    ingest,
    manifest,
    missing_services,
    records,
)


def quarter_records(spark: SparkSession, store: str, quarter: str) -> dict[str, DataFrame]:
    """Typed records of one quarter; each table reads its own folders only."""
    parsed = records(spark, store).where(F.col("quarter") == quarter)
    return {
        "sy": summaries(parsed).distinct(),
        "li": typed_records(parsed, "LI01.03"),
        "su": typed_records(parsed, "SU03.02"),
        "as_": typed_records(parsed, "AS01.02"),
    }


def publish_report(
    spark: SparkSession, store: str, out: str, quarter: str, terms: ReportTerms
) -> None:
    """Report of all services that have come for the quarter.

    Its scalars cover all loaded quarters, or each quarter by itself, as the terms say;
    they are added up from sums that ``update_scalars`` stores.
    """
    r = quarter_records(spark, store, quarter)
    update_scalars(spark, store, terms)
    scalars = settled(loaded_scalars(spark, store, terms), "scalars")
    write_report(royalty_report(None, r["li"], r["su"], r["as_"], terms, scalars), out, quarter)


def missing_for(spark: SparkSession, store: str, quarter: str) -> list[str]:
    """Services the quarter still waits for; at most one name per service."""
    gate = missing_services(manifest(spark, store).where(F.col("quarter") == quarter)).first()
    return list(gate.missing) if gate else list(SERVICES)


def publish_ranking(
    spark: SparkSession, store: str, out: str, quarter: str, terms: RankingTerms = RankingTerms()
) -> None:
    """Ranked artists as CSV and their songs as a table."""
    r = quarter_records(spark, store, quarter)
    top = settled(top_residual_artists(r["as_"], r["su"], r["li"], terms), "top-artists")
    export_top(top, f"{out}/top_residual_artists")
    write_replace(
        top_artist_songs(top, r["as_"], r["su"], r["li"], terms), f"{out}/top_residual_artists_songs"
    )


def touched_quarters(spark: SparkSession, store: str, loads: Sequence[str]) -> list[str]:
    """Quarters that files of these loads belong to, oldest first; rejected files count as well."""
    rows = spark.read.schema(MANIFEST_FIELDS).parquet(f"{store}/{MANIFEST}")
    report = F.col("status").isin(GOOD, REJECTED) & F.col("load").isin(list(loads))
    found = rows.where(report & F.col("quarter").isNotNull()).select("quarter").distinct()
    return sorted(r.quarter for r in found.collect())


def on_new_files(
    spark: SparkSession, landing: str, store: str, state: str, out: str,
    report: ReportTerms, ranking: RankingTerms = RankingTerms(),
) -> dict[str, list[str]]:
    """Take in what has arrived and publish every quarter it belongs to.

    Returns, for each of these quarters, the services that are missing. The ranking
    is that of the newest complete quarter among them.
    """
    loads = ingest(spark, landing, store, state)
    missing = {}
    for quarter in touched_quarters(spark, store, loads) if loads else []:
        publish_report(spark, store, f"{out}/report", quarter, report)
        missing[quarter] = missing_for(spark, store, quarter)
    complete = [quarter for quarter, services in missing.items() if not services]
    if complete:
        publish_ranking(spark, store, out, complete[-1], ranking)
    return missing
