"""Nested documents to flat rows, driven by the schema and never by the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staveline.operators.frames import quoted


def _leaves(column: Column, kind: T.StructType, prefix: str) -> list[Column]:
    out = []
    for field in kind.fields:
        value, name = column.getField(field.name), f"{prefix}{field.name}"
        if isinstance(field.dataType, T.StructType):
            out += _leaves(value, field.dataType, f"{name}.")
        else:
            out.append(value.alias(name))
    return out


def flatten(df: DataFrame, column: str = "obj", keep: Sequence[str] = ()) -> DataFrame:
    """Struct (or list of structs) -> columns with dotted names.

    Lists inside the struct stay whole. A list of structs gives one row each.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.ArrayType):
        df = df.select(*[F.col(quoted(k)) for k in keep], F.explode(quoted(column)).alias(column))
        kind = kind.elementType
    return df.select(
        *[F.col(quoted(k)) for k in keep], *_leaves(F.col(quoted(column)), kind, "")
    )


def path_or_null(df: DataFrame, column: str, path: str) -> Column:
    """Value at a dotted path; NULL when the schema has no such path.

    A list on the way stands for its first element.
    """
    value, kind = F.col(quoted(column)), df.schema[column].dataType
    for part in path.split("."):
        if isinstance(kind, T.ArrayType):
            value, kind = F.get(value, F.lit(0)), kind.elementType
        if not isinstance(kind, T.StructType) or part not in kind.names:
            return F.lit(None)
        value, kind = value.getField(part), kind[part].dataType
    return value


def record_path(
    df: DataFrame,
    path: Sequence[str],
    column: str = "obj",
    meta: Sequence[Sequence[str]] = (),
    record_prefix: str = "",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per record of the list at ``path``, with fields of its parents.

    ``column`` is a struct or a list of structs. ``meta`` names parent fields
    by path; they become dotted columns. ``keep`` names columns outside the
    payload. Lists that are empty or missing give no rows.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.ArrayType):
        df = df.withColumn(column, F.explode(quoted(column)))
    root = F.col(quoted(column))

    def at(parts: Sequence[str]) -> Column:
        value = root
        for part in parts:
            value = value.getField(part)
        return value

    rows = df.select(
        *[F.col(quoted(k)) for k in keep],
        *[at(m).alias(".".join(m)) for m in meta],
        F.explode(at(path)).alias("__record"),
    )
    outer = [F.col(quoted(c)) for c in rows.columns if c != "__record"]
    record = rows.schema["__record"].dataType
    return rows.select(*outer, *_leaves(F.col("__record"), record, record_prefix))


def map_rows(
    df: DataFrame, column: Column, key: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Map of key -> list of records: one row per record, the key as a column."""
    entries = df.select(
        *[F.col(quoted(k)) for k in keep], F.explode(column).alias("__key", "__records")
    )
    rows = entries.select(
        *[F.col(quoted(k)) for k in keep],
        F.col("__key").alias(key),
        F.explode("__records").alias("__record"),
    )
    outer = [F.col(quoted(c)) for c in rows.columns if c != "__record"]
    return rows.select(
        *outer, *_leaves(F.col("__record"), rows.schema["__record"].dataType, "")
    )


def number_elements(
    df: DataFrame, column: Column, number: str, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per list element with its 1-based position."""
    rows = df.select(
        *[F.col(quoted(k)) for k in keep], F.posexplode(column).alias("__pos", "__record")
    )
    kind = rows.schema["__record"].dataType
    record = F.col("__record")
    values = (
        _leaves(record, kind, "") if isinstance(kind, T.StructType) else [record.alias("value")]
    )
    return rows.select(
        *[F.col(quoted(k)) for k in keep], *values, (F.col("__pos") + 1).cast("long").alias(number)
    )


def double_explode(df: DataFrame, first: str, second: str) -> DataFrame:
    """Every pairing of two id lists of the same row; an empty list counts as NULL."""
    once = df.withColumn(first, F.explode_outer(quoted(first)))
    return once.withColumn(second, F.explode_outer(quoted(second)))


def first_element(values: Column) -> Column:
    return F.get(values, F.lit(0))


def unwrap_single(values: Column) -> Column:
    """The only element of a one-element list; NULL for all other lists."""
    return F.when(F.size(values) == 1, first_element(values))


def renamed_fields(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Select the named columns under their new names, in the given order."""
    return df.select(*[F.col(quoted(old)).alias(new) for old, new in names.items()])
