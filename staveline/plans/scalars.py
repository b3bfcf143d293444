"""The scalars of the report over all loaded quarters, added up from stored sums.

The share denominator and the pool cover every quarter that was loaded. Each service
and quarter has one row of sums, made from its own files. A run works out the rows
whose files have changed and adds up the rest as they are, so old quarters are not
read again; a file that was sent again, or turned down, replaces what it had given.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staveline.functions.numbers import summable
from staveline.operators.royalty import MECHANICAL, claims_of
from staveline.plans.report import ReportTerms
from staveline.sinks.tables import append_records
from staveline.sources.dsr import summaries, typed_records
from staveline.streaming.intake import GOOD, REJECTED, newest_files, records

SCALARS = "scalars"
PAIR = ["service", "quarter"]


def _folder(store: str, terms: ReportTerms) -> str:
    """Claimants and money types have sums of their own."""
    name = hashlib.sha256(f"{terms.claimant}\n{terms.money_type}".encode()).hexdigest()[:16]
    return f"{store}/{SCALARS}/{name}"


def _stored(spark: SparkSession, store: str, terms: ReportTerms) -> DataFrame | None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_folder(store, terms))
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return None
    return spark.read.parquet(_folder(store, terms))


def _sums(parsed: DataFrame, terms: ReportTerms) -> DataFrame:
    """(service, quarter, usages, paid, earned) of the claimant."""
    money = terms.money_type
    claims = claims_of(typed_records(parsed, "LI01.03"), terms.claimant, rights_type=None)
    usages = F.when(F.col("RightsType") == MECHANICAL, summable(F.col("AllocatedUsages"), money))
    paid = claims.groupBy("service", F.col("Quarter").alias("quarter")).agg(
        F.sum(usages).alias("usages"), F.sum(summable(F.col("AllocatedAmount"), money)).alias("paid")
    )
    own = claims_of(summaries(parsed).distinct(), terms.claimant, rights_type=None)
    earned = own.groupBy("service", F.col("Quarter").alias("quarter")).agg(
        F.sum(summable(F.col("AllocatedRevenue"), money)).alias("earned")
    )
    return paid.join(earned, PAIR, "full")


def update_scalars(spark: SparkSession, store: str, terms: ReportTerms) -> list[tuple[str, str]]:
    """Bring the stored sums up to date; returns the (service, quarter) pairs worked out.

    A pair is worked out if its files are not those its sums were made from: their
    names, times and verdicts are kept as one number beside the sums. So a run that was
    cut short is made up for by the next one, and nothing is added twice.
    """
    files = newest_files(spark, store).where(F.col("status").isin(GOOD, REJECTED))
    version = F.bit_xor(F.xxhash64("file", "modified", "load", "status")).alias("version")
    now = files.where("service IS NOT NULL AND quarter IS NOT NULL").groupBy(*PAIR).agg(version)
    known = _stored(spark, store, terms)
    if known is not None:
        before = known.select("service", "quarter", F.col("version").alias("made_from"))
        now = now.join(before, PAIR, "left").where("made_from IS NULL OR made_from <> version").drop("made_from")
    # One row for each service and quarter that has changed.
    stale = now.collect()
    if not stale:
        return []
    chosen = [(F.col("service") == r.service) & (F.col("quarter") == r.quarter) for r in stale]
    parsed = records(spark, store).where(reduce(lambda a, b: a | b, chosen))
    pairs = spark.createDataFrame(stale, "service string, quarter string, version long")
    # Pairs without good files keep a row without sums.
    append_records(pairs.join(_sums(parsed, terms), PAIR, "left"), _folder(store, terms), PAIR)
    return sorted((r.service, r.quarter) for r in stale)


def loaded_scalars(spark: SparkSession, store: str, terms: ReportTerms) -> DataFrame:
    """UsagesTotal and Pool of the claimant in the scope of the terms, over all loaded quarters.

    A pool is null where no summary or no claim has come in its scope.
    """
    known = _stored(spark, store, terms)
    if known is None:
        raise ValueError("no sums are stored yet; call update_scalars first")
    return known.withColumnRenamed("quarter", "Quarter").groupBy(*terms.scope).agg(
        F.sum("usages").cast("double").alias("UsagesTotal"),
        (F.sum("earned") - F.sum("paid")).cast("double").alias("Pool"),
    )
