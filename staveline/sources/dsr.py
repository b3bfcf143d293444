"""Report files: routing by name, parsing lines, typed records, bad rows."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staveline.operators.frames import stack_outer
from staveline.session import settled
from staveline.sources.layouts import LAYOUTS, SUMMARY_NARROW, SUMMARY_WIDE

# File name part -> service, tried in this order.
SERVICE_OF_NAME = {
    "ads": "ads",
    "hardware": "hardware",
    "subscriptionpremium": "subs_premium",
    "subscriptionmusic": "subs_music",
}
SERVICES = tuple(SERVICE_OF_NAME.values())

MAX_BAD_ROWS = 1000


class BadRowsError(ValueError):
    """More malformed rows than the load allows."""


def _service_in(lowered: Column) -> Column:
    """First service whose marker is contained in the text; '' when none is."""
    chosen = F.lit("")
    for marker, service in reversed(SERVICE_OF_NAME.items()):
        chosen = F.when(F.contains(lowered, F.lit(marker)), F.lit(service)).otherwise(chosen)
    return chosen


def _name_parts(name: Column) -> tuple[Column, Column]:
    """Quarter, and what stands behind it in lower case.

    Runs on every line, so plain string functions only.
    """
    upto_quarter = F.substring_index(name, "/", 2)
    nested = F.length(upto_quarter) < F.length(name)
    folder = F.substring_index(upto_quarter, "/", -1)
    quarter = F.when(nested, F.substring_index(folder, "=", -1))
    rest = F.when(nested, F.substr(name, F.length(upto_quarter) + 2)).otherwise(name)
    return quarter, F.lower(rest)


def route(name: Column) -> dict[str, Column]:
    """Service and quarter of an object name ``<folder>/<quarter>/<file>``.

    The service is looked for behind the quarter only, so a folder such as
    ``uploads`` does not count as ``ads``. A ``key=`` in front of the quarter,
    as Spark writes it, is dropped. No second folder gives a NULL quarter.
    """
    quarter, rest = _name_parts(name)
    return {"service": _service_in(rest), "quarter": quarter}


def is_routed() -> Column:
    return (F.col("service") != "") & F.col("quarter").isNotNull()


def split_routed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a service and a quarter, and the rest for quarantine."""
    known = F.coalesce(is_routed(), F.lit(False))
    return df.where(known), df.where(~known)


def _text(line: str) -> Column:
    return F.rtrim(F.col(line), F.lit("\r"))


def fields(line: str = "value") -> Column:
    """The fields of a line, its record type first."""
    return F.split(_text(line), "\t", -1)


def parse_lines(
    lines: DataFrame, line: str = "value", name: str = "file", keep: Sequence[str] = ()
) -> DataFrame:
    """Lines of text -> (service, quarter, file, record_type, f), and columns to keep.

    Lines are split, not read as CSV: record types of different width share a
    file, and quotes have no meaning in it.
    """
    quarter, rest = _name_parts(F.col(name))
    parts = F.struct(quarter.alias("quarter"), rest.alias("rest"), fields(line).alias("f"))
    # The one-element list keeps filters and later columns from splitting the
    # line again. The record type is not taken from it, so that a filter on the
    # type comes before the split.
    rows = lines.select(
        *keep,
        F.col(name).alias("file"),
        F.substring_index(_text(line), "\t", 1).alias("record_type"),
        F.explode_outer(F.array(parts)).alias("line"),
    )
    return rows.select(
        _service_in(F.col("line.rest")).alias("service"), "line.quarter", "file", "record_type",
        "line.f", *keep,
    )


def object_name(root: str) -> Column:
    """Path of the file being read, starting with the last folder of ``root``."""
    folder = quote(root.rstrip("/"), safe="/:@!$&'()*+,;=")
    parent = len(folder) - len(folder.rsplit("/", 1)[-1])
    path = F.col("_metadata.file_path")
    at = F.instr(path, folder)
    return F.when(at > 0, F.substr(path, at + parent)).otherwise(path)


def read_dsr(spark: SparkSession, root: str) -> DataFrame:
    """All report files below a folder, parsed but not yet typed."""
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .option("lineSep", "\n")
        .text(root)
        .select("value", object_name(root).alias("file"))
    )
    return parse_lines(lines)


def _field_value(position: int, kind: str, strict: bool, lenient: bool) -> Column:
    raw = F.get(F.col("f"), F.lit(position))
    if kind == "string":
        return raw
    text = raw if strict else F.nullif(raw, F.lit(""))
    return text.try_cast(kind) if lenient else text.cast(kind)


def typed_records(
    parsed: DataFrame, code: str, strict: bool = False, lenient: bool = False
) -> DataFrame:
    """Records of one code with named and typed fields.

    An empty typed field is NULL; ``strict`` makes it an error. Other bad text
    always fails the job unless ``lenient`` turns it into NULL.
    """
    fields = [
        _field_value(i, field.type, strict, lenient).alias(field.name)
        for i, field in enumerate(LAYOUTS[code], start=1)
    ]
    return parsed.where(F.col("record_type") == code).select(
        "service", *fields, F.col("quarter").alias("Quarter")
    )


def demux(parsed: DataFrame, **casting) -> dict[str, DataFrame]:
    """One typed frame per record code."""
    return {code: typed_records(parsed, code, **casting) for code in LAYOUTS}


def summaries(parsed: DataFrame, **casting) -> DataFrame:
    """Summary records of both variants, columns matched by name.

    A (service, quarter) that holds any wide record is read as wide only.
    """
    pair = ["service", "quarter"]
    with_wide = parsed.where(F.col("record_type") == SUMMARY_WIDE).select(*pair).distinct()
    narrow = parsed.where(F.col("record_type") == SUMMARY_NARROW).join(
        with_wide, pair, "left_anti"
    )
    return stack_outer(
        typed_records(parsed, SUMMARY_WIDE, **casting),
        typed_records(narrow, SUMMARY_NARROW, **casting),
    )


def well_formed() -> Column:
    """Width test per record code.

    Empty fields behind the last named one are padding. Records of codes
    without a layout are not read, so they cannot be malformed.
    """
    def fits(width: int) -> Column:
        extra = F.slice(F.col("f"), F.lit(width + 2), F.size("f"))
        padded = (F.size("f") > width) & ~F.exists(extra, lambda x: x != "")
        return (F.size("f") == width + 1) | padded

    test = F.when(F.col("f").isNull(), F.lit(False))
    for width in sorted({len(fields) for fields in LAYOUTS.values()}):
        codes = [code for code, fields in LAYOUTS.items() if len(fields) == width]
        test = test.when(F.col("record_type").isin(codes), fits(width))
    return test.otherwise(F.lit(True))


def split_bad_rows(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    ok = well_formed()
    return parsed.where(ok), parsed.where(~ok)


def check_bad_rows(parsed: DataFrame, max_bad: int = MAX_BAD_ROWS) -> tuple[DataFrame, DataFrame]:
    """Good rows and quarantine; fails when a file has more bad rows than allowed.

    The parsed rows are stored first, so the text is read once.
    """
    good, bad = split_bad_rows(settled(parsed, "parsed"))
    fail_above(bad, max_bad)
    return good, bad


def fail_above(bad: DataFrame, max_bad: int) -> None:
    worst = bad.groupBy("file").count().where(F.col("count") > max_bad).first()
    if worst is not None:
        raise BadRowsError(f"{worst['file']}: {worst['count']} malformed rows, {max_bad} allowed")


def record_counts(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("service", "quarter", "record_type").agg(F.count("*").alias("records"))


def to_lines(records: DataFrame, code: str) -> DataFrame:
    """Typed records written back as tab-separated text; the inverse of parsing."""
    fields = [F.coalesce(F.col(f.name).cast("string"), F.lit("")) for f in LAYOUTS[code]]
    return records.select("service", "Quarter", F.concat_ws("\t", F.lit(code), *fields).alias("value"))
