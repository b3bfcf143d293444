"""Landed responses made from rows of the driver tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import table
from staveline.sources.landed import parse_bare, parse_landed


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as the input of a job on documents."""
    return table(spark, sf_dir, name)


def landed(df: DataFrame, tags: dict[str, Column], obj: Column, payload: str) -> DataFrame:
    """Write ``obj`` as envelope text next to the tags and read it back typed."""
    body = F.to_json(F.struct(obj.alias("obj")))
    rows = df.select(*[c.alias(n) for n, c in tags.items()], body.alias("body"))
    return parse_landed(rows, "body", payload)


def landed_bare(df: DataFrame, tags: dict[str, Column], obj: Column, payload: str) -> DataFrame:
    rows = df.select(*[c.alias(n) for n, c in tags.items()], F.to_json(obj).alias("body"))
    return parse_bare(rows, "body", payload)


def record(**fields: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def text(value: str | Column) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def tagged(prefix: str, value: str | Column) -> Column:
    return F.concat(F.lit(prefix), text(value))


def choice(number: Column, values: Sequence[str]) -> Column:
    """One of the values, by remainder."""
    return F.get(F.array(*[F.lit(v) for v in values]), (number % len(values)).cast("int"))


def choice_sql(number: str, values: Sequence[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE ({number}) % {len(values)} {whens} END"


def midnight(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd'T00:00:00.000Z'")


def day(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")
