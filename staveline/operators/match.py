"""Matching tracks against a catalogue by ISRC."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def perf_for(tracks: DataFrame, perf: DataFrame) -> DataFrame:
    """Catalogue rows for the ISRCs of the tracks."""
    wanted = tracks.select("isrc").where(F.col("isrc").isNotNull()).distinct()
    return perf.select("comp_id", "isrc").join(wanted, "isrc", "left_semi")


def catalogue_match(tracks: DataFrame, perf: DataFrame) -> DataFrame:
    """Every track with its ``comp_id`` and MATCH or NO MATCH.

    An ISRC with several works repeats the track. Tracks without ISRC match
    nothing and stay out of the join, where they would all meet in one task.
    """
    works = perf.select("comp_id", "isrc")
    coded = tracks.where(F.col("isrc").isNotNull()).join(works, "isrc", "left")
    uncoded = tracks.where(F.col("isrc").isNull()).withColumn(
        "comp_id", F.lit(None).cast(works.schema["comp_id"].dataType)
    )
    flag = F.when(F.col("comp_id").isNotNull(), "MATCH").otherwise("NO MATCH")
    return coded.unionByName(uncoded).withColumn("Match", flag)
