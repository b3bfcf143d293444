"""JSON documents whose shape nobody has written down.

A document is read as a variant, which keeps every field it has. The schema of all
documents together is gathered by one aggregation, merged on the way, and comes to the
driver as one line; the variant is then turned into a struct of that schema, for which
``operators.nested`` has the rest.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staveline.operators.frames import quoted
from staveline.operators.nested import flatten

# More fields than this are keys that depend on the data, and not a shape.
MAX_FIELDS = 5000
QUOTED = re.compile(r"(`(?:[^`]|``)*`)")


def read_documents(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """One variant column ``doc``: each line of the files, or each file as a whole.

    Text that is no JSON fails the job.
    """
    reader = spark.read.format("json").option("singleVariantColumn", "doc").option("mode", "FAILFAST")
    return reader.option("multiLine", multi_line).load(path)


def parse_documents(df: DataFrame, column: str, doc: str = "doc") -> DataFrame:
    """Replace a column of JSON text by a variant; text that is no JSON fails the job."""
    kept = [F.col(quoted(c)) for c in df.columns if c != column]
    return df.select(*kept, F.parse_json(F.col(quoted(column))).alias(doc))


def _has_payload(value: Column) -> Column:
    """The value is there, not a JSON null, and no empty list or object."""
    shape = F.schema_of_variant(value)
    some = F.when(shape.startswith("ARRAY<"), F.variant_get(value, "$[0]", "variant").isNotNull())
    return value.isNotNull() & ~shape.isin("VOID", "OBJECT<>") & some.otherwise(F.lit(True))


def payloads(df: DataFrame, doc: str = "doc", member: str = "obj", tags: str = "") -> DataFrame:
    """The payloads of landed responses as a variant column, with the tags beside them.

    ``tags`` lists the named members of the envelope with their types, as in
    ``landed.read_landed``; other columns stay. Responses without a payload are left out.
    """
    envelope = F.col(quoted(doc))

    def at(name: str, kind: str) -> Column:
        return F.variant_get(envelope, f"$['{name}']", kind)

    known = T.StructType.fromDDL(tags) if tags else T.StructType()
    named = [at(f.name, f.dataType.simpleString()).alias(f.name) for f in known.fields]
    kept = [F.col(quoted(c)) for c in df.columns if c != doc]
    rows = df.select(*kept, *named, at(member, "variant").alias(member))
    return rows.where(_has_payload(F.col(quoted(member))))


def _shape(text: str) -> T.DataType:
    """The type behind a variant schema, in which objects are called OBJECT."""
    pieces = QUOTED.split(text)
    pieces[::2] = [re.sub(r"\bOBJECT<", "STRUCT<", piece) for piece in pieces[::2]]
    return T.DataType.fromDDL("".join(pieces))


def _settable(kind: T.DataType) -> T.DataType | None:
    """The type that values are read as; None for objects that never have a field."""
    if isinstance(kind, T.StructType):
        fields = [(f.name, _settable(f.dataType)) for f in kind.fields]
        fields = [T.StructField(name, inner) for name, inner in fields if inner is not None]
        return T.StructType(fields) if fields else None
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_settable(kind.elementType) or T.StringType())
    if isinstance(kind, T.DecimalType) and kind.scale:
        return T.DoubleType()
    return T.StringType() if isinstance(kind, (T.NullType, T.VariantType)) else kind


def _fields(kind: T.DataType) -> int:
    if isinstance(kind, T.ArrayType):
        return _fields(kind.elementType)
    return sum(1 + _fields(f.dataType) for f in kind.fields) if isinstance(kind, T.StructType) else 0


def gathered_type(df: DataFrame, column: str = "obj", max_fields: int = MAX_FIELDS) -> T.DataType:
    """The type that holds every document: all fields of all rows.

    Whole numbers are bigint, or a decimal if they are longer; other numbers are
    doubles. A field that is of one kind here and of another kind there is text, with
    lists and objects as JSON; so is one that is null everywhere. Objects that are empty
    everywhere have no field. Fields are in the order of their names. More than
    ``max_fields`` fields are an error: such keys are data, to be read as a map.
    """
    text = df.agg(F.schema_of_variant_agg(F.col(quoted(column)))).first()[0]
    kind = _shape(text)
    if isinstance(kind, T.NullType):
        return T.StructType()
    if _fields(kind) > max_fields:
        raise ValueError(f"{column} has {_fields(kind)} fields; read it with a map type")
    inner = kind.elementType if isinstance(kind, T.ArrayType) else kind
    if not isinstance(inner, T.StructType):
        raise ValueError(f"{column} holds no objects, or objects beside other values: {text[:200]}")
    return _settable(kind) or T.StructType()


def shaped(df: DataFrame, column: str = "obj", kind: T.DataType | None = None) -> DataFrame:
    """The variant column as a struct, or list of structs, of the gathered type.

    A type that was gathered before can be given; fields it does not have are left out.
    """
    kind = gathered_type(df, column) if kind is None else kind
    if kind == T.StructType():
        return df.withColumn(column, F.struct())
    return df.withColumn(column, F.col(quoted(column)).cast(kind))


def flatten_documents(df: DataFrame, column: str = "obj") -> DataFrame:
    """Every field of every document as a column with a dotted name, beside the other columns.

    Lists stay whole; a list of objects as the document gives one row each. Keys that
    differ in upper and lower case only need ``spark.sql.caseSensitive``.
    """
    return flatten(shaped(df, column), column, keep=[c for c in df.columns if c != column])
