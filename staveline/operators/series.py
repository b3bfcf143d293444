"""Differences along series, and calendar rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from staveline.functions.dates import days_between
from staveline.operators.frames import quoted
from staveline.session import settled

def item_points(data: Column, value: str = "value") -> Column:
    """Points of one response item that have a value, each with ``difference``.

    A series lies within one list, so the step to the previous point is taken
    inside the row and needs no shuffle.
    """
    points = F.filter(data, lambda p: p.getField(value).isNotNull())
    before = F.concat(F.array(F.lit(None)), F.transform(points, lambda p: p.getField(value)))
    paired = F.zip_with(
        points,
        before,
        lambda p, v: F.struct(p.alias("point"), (p.getField(value) - v).alias("difference")),
    )
    # The list of previous values is one longer than the list of points.
    return F.filter(paired, lambda x: x.getField("point").isNotNull())


def series_diff(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    tie_break: Sequence[str] = (),
    out: str = "difference",
    slices: int | None = None,
) -> DataFrame:
    """Value minus the previous value of the same series, for long tables.

    Points without a value are dropped first, and the first point has no
    difference. ``order`` is a number, date or timestamp; ``tie_break`` makes
    the order total.

    One series may hold a large part of the table, so rows are dealt by range of keys
    and position: a range holds about 1/slices of all rows, whatever the keys, more
    only where one series repeats one position that often. There are as many ranges as
    the session has shuffle partitions, unless given. The last value of a series in
    each range is carried, as one extra row, to its next range. The dealt rows are
    stored when this is called, so the input is read for the sample of the ranges and
    once more.
    """
    names = [quoted(k) for k in keys]
    position = [F.col(order), *[F.col(t) for t in tie_break]]
    points = df.where(F.col(value).isNotNull())
    sliced = settled(cut(points, keys, order, tie_break, slices), "series")
    ends = sliced.groupBy(*names, "__slice").agg(F.max_by(value, F.struct(*position)).alias(value))
    following = F.lead("__slice").over(Window.partitionBy(*names).orderBy("__slice"))
    carried = (
        ends.withColumn("__slice", following)
        .where(F.col("__slice").isNotNull())
        .withColumn("__carried", F.lit(True))
    )
    rows = sliced.withColumn("__carried", F.lit(False)).unionByName(
        carried, allowMissingColumns=True
    )
    along = Window.partitionBy(*names, "__slice").orderBy(F.col("__carried").desc(), *position)
    steps = _step(rows, value, out, along)
    return steps.where(~F.col("__carried")).drop("__carried", "__slice")


def _step(rows: DataFrame, value: str, out: str, along: WindowSpec) -> DataFrame:
    return rows.withColumn(out, F.col(value) - F.lag(value).over(along))


def cut(
    df: DataFrame, keys: Sequence[str], order: str, tie_break: Sequence[str] = (), slices: int | None = None
) -> DataFrame:
    """Number the rows by range of keys and position; rows that agree in them stay together."""
    slices = slices or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    along = [F.col(quoted(c)) for c in (*keys, order, *tie_break)]
    return df.repartitionByRange(slices, *along).withColumn("__slice", F.spark_partition_id())


def record_days(df: DataFrame, start: str, end: str, day: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per day from start to end, both included, as text."""
    days = days_between(F.col(quoted(start)).cast("date"), F.col(quoted(end)).cast("date"))
    rows = df.select(*[F.col(quoted(k)) for k in keep], F.explode(days).alias(day))
    return rows.withColumn(day, F.col(quoted(day)).cast("string"))


def day_pairs(df: DataFrame, start: str, end: str, keep: Sequence[str] = ()) -> DataFrame:
    """(day before, day) for every day from start up to but without end."""
    first, last = F.col(quoted(start)).cast("date"), F.date_sub(F.col(quoted(end)).cast("date"), 1)
    rows = df.select(*[F.col(quoted(k)) for k in keep], F.explode(days_between(first, last)).alias("day"))
    return rows.select(
        *[F.col(quoted(k)) for k in keep],
        F.date_sub("day", 1).cast("string").alias("since"),
        F.col("day").cast("string").alias("until"),
    )


def in_own_window(
    facts: DataFrame, windows: DataFrame, on: str, day: str, start: str, end: str
) -> DataFrame:
    """Facts dated within the window of their entity, both ends included."""
    rows = facts.join(windows.select(on, start, end), on, "inner")
    return rows.where(F.col(day).between(F.col(start), F.col(end))).drop(start, end)
