"""JSON responses that were landed as files or text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staveline.operators.frames import quoted


def has_payload(obj: Column, kind: T.DataType) -> Column:
    """The payload is there and, for lists and maps, not empty."""
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return obj.isNotNull() & (F.size(obj) > 0)
    if isinstance(kind, T.StructType):
        # ``{}`` reads as a struct of NULLs.
        some = F.lit(False)
        for name in kind.names:
            some = some | obj.getField(name).isNotNull()
        return obj.isNotNull() & some
    return obj.isNotNull()


def _schema(payload: str | T.DataType) -> T.DataType:
    return T.DataType.fromDDL(payload) if isinstance(payload, str) else payload


def read_landed(
    spark: SparkSession, path: str, payload: str | T.DataType, tags: str = "", member: str = "obj",
    multi_line: bool = False,
) -> DataFrame:
    """Landed files with the tag columns of the request and the typed payload.

    The schema is given, never inferred: with data-dependent keys inference
    would make one column per key.
    """
    kind = _schema(payload)
    schema = T.StructType(list(T.StructType.fromDDL(tags)) if tags else []).add(member, kind)
    rows = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return rows.where(has_payload(F.col(member), kind))


def _parsed(df: DataFrame, column: str, payload: Column, member: str, kind: T.DataType) -> DataFrame:
    """Replace the text column by the payload and keep rows that have one.

    The payload goes through a one-element list: a filter on a plain column
    would be pushed below it, and parse the text again for each test.
    """
    kept = [F.col(quoted(c)) for c in df.columns if c != column]
    rows = df.select(*kept, F.explode_outer(F.array(payload)).alias(member))
    return rows.where(has_payload(F.col(member), kind))


def parse_landed(
    df: DataFrame, column: str, payload: str | T.DataType, member: str = "obj"
) -> DataFrame:
    """Replace a column of envelope text by its typed payload."""
    kind = _schema(payload)
    envelope = T.StructType().add(member, kind)
    value = F.from_json(F.col(quoted(column)), envelope).getField(member)
    return _parsed(df, column, value, member, kind)


def parse_bare(df: DataFrame, column: str, payload: str | T.DataType) -> DataFrame:
    """The same for responses that come without an envelope."""
    kind = _schema(payload)
    return _parsed(df, column, F.from_json(F.col(quoted(column)), kind), "obj", kind)
