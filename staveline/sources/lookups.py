"""Small inputs: ranked-artist metadata, seed names, the catalogue."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

METADATA_MARKER = "top_residual_artists_metadata"


def is_artist_metadata(name: Column) -> Column:
    return F.contains(name, F.lit(METADATA_MARKER))


def read_artist_metadata(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Tab-separated, unquoted, with a header row; a bad row fails the load."""
    reader = (
        spark.read.option("sep", "\t").option("quote", "").option("header", "true")
        .option("mode", "FAILFAST")
    )
    return (reader.schema(schema) if schema else reader.option("inferSchema", "true")).csv(path)


def load_artist_metadata(
    spark: SparkSession, path: str, table: str, schema: str | None = None
) -> DataFrame:
    """Append the file to the metadata table and return the whole table."""
    read_artist_metadata(spark, path, schema).write.mode("append").parquet(table)
    return spark.read.parquet(table)


def seed_artists(spark: SparkSession, names: Iterable[str], column: str = "artist") -> DataFrame:
    return spark.createDataFrame([(name,) for name in names], f"`{column}` string")


def read_seed_artists(spark: SparkSession, path: str, column: str = "artist") -> DataFrame:
    return spark.read.option("header", "true").csv(path).select(column)


def read_catalogue(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Catalogue (comp_id, isrc) from any JDBC database; options as Spark takes them."""
    return spark.read.format("jdbc").options(**options).load().select("comp_id", "isrc")
