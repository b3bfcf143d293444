"""Column and row housekeeping: rename, drop, stack, dedupe, tag."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name that may hold dots or spaces, safe for ``F.col``."""
    return "`" + name.replace("`", "``") + "`"


def present(df: DataFrame, column: str) -> DataFrame:
    """Rows whose id is neither NULL nor empty."""
    value = F.col(quoted(column))
    return df.where(value.isNotNull() & (value.cast("string") != ""))


def dedupe(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(subset)) if subset else df.distinct()


def drop_all_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows in which every (listed) column is NULL."""
    columns = [F.col(quoted(c)) for c in (subset or df.columns)]
    return df.where(F.coalesce(*[F.when(c.isNotNull(), F.lit(True)) for c in columns]))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename; names that are not there are ignored."""
    return df.withColumnsRenamed(dict(names))


def drop_columns(
    df: DataFrame, names: Iterable[str] = (), prefixes: Iterable[str] = ()
) -> DataFrame:
    """Drop by name and by name prefix; names that are not there are ignored."""
    listed, starts = set(names), tuple(prefixes)
    kept = [c for c in df.columns if c not in listed and not (starts and c.startswith(starts))]
    return df.select(*[F.col(quoted(c)) for c in kept])


def select_attributes(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exactly these columns; a missing one is an error."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")
    return df.select(*[F.col(quoted(n)) for n in names])


def normalise_columns(df: DataFrame) -> DataFrame:
    """Spaces and dots of column names become underscores."""
    return df.toDF(*[re.sub(r"[ .]", "_", c) for c in df.columns])


def stack_outer(*frames: DataFrame) -> DataFrame:
    """Union by name; a column a frame lacks is NULL in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stack_inner(*frames: DataFrame, attributes: Sequence[str] | None = None) -> DataFrame:
    """Union by name of the columns all frames share (of those listed)."""
    wanted = list(attributes) if attributes else frames[0].columns
    common = [c for c in wanted if all(c in f.columns for f in frames)]
    return reduce(DataFrame.unionByName, [select_attributes(f, common) for f in frames])


def reference_frame(df: DataFrame, rows: Sequence[Mapping[str, str]]) -> DataFrame:
    """A short constant list of dicts as a frame of strings."""
    entries = [F.struct(*[F.lit(v).alias(n) for n, v in r.items()]) for r in rows]
    return df.sparkSession.range(0, 1, 1, 1).select(F.inline(F.array(*entries)))


def tag_with_reference(
    df: DataFrame, rows: Sequence[Mapping[str, str]], on: Sequence[str]
) -> DataFrame:
    """Keep rows named in the reference list and add its other columns.

    The list is written out in code, so broadcasting it is safe at any scale.
    """
    return df.join(F.broadcast(reference_frame(df, rows)), list(on), "inner")


def seeded(df: DataFrame, seeds: DataFrame, on: str) -> DataFrame:
    """Rows whose key is among the seeds."""
    return df.join(seeds.select(on), on, "left_semi")
