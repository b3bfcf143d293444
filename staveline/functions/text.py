"""Text functions of the royalty report and the artist ranking."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Our own choice of separators between artist names; callers may pass others.
ARTIST_MARKS = (",", ";", "/", "|", "&", "+")
ARTIST_WORDS = ("feat.", "ft.", "featuring", "vs.")


def country_of_sale(transaction_id: Column, strict: bool = False) -> Column:
    """Second part of a ``:``-separated id; strict mode fails when it is absent."""
    parts = F.split(transaction_id, ":")
    return parts[1] if strict else F.get(parts, F.lit(1))


def distribution_description(service: Column, quarter: Column, label: str = "YOUTUBE") -> Column:
    return F.concat(F.lit(f"{label} "), F.upper(service), F.lit(" "), quarter)


def clean_song_code(code: Column, strict_prefix: bool = False) -> Column:
    """Take ``C_`` out of codes LIKE 'C_%'.

    The underscore of the pattern is a wildcard and every occurrence goes, so
    ``CAC_1`` becomes ``CA1``. ``strict_prefix`` only strips a leading ``C_``.
    """
    if strict_prefix:
        return F.regexp_replace(code, "^C_", "")
    return F.when(code.like("C_%"), F.replace(code, F.lit("C_"), F.lit(""))).otherwise(code)


def artist_separator(
    marks: Sequence[str] = ARTIST_MARKS, words: Sequence[str] = ARTIST_WORDS
) -> str:
    """Regular expression for the given single marks and whole words."""
    choices = []
    if marks:
        choices.append("[" + "".join(re.escape(m) for m in marks) + "]")
    if words:
        choices.append(r"\s(?:" + "|".join(re.escape(w) for w in words) + r")\s")
    return "|".join(choices)


def split_artists(
    name: Column, marks: Sequence[str] = ARTIST_MARKS, words: Sequence[str] = ARTIST_WORDS
) -> Column:
    """Lower-cased parts of a display name, not yet trimmed."""
    return F.split(F.lower(name), artist_separator(marks, words))


def tags_text(tags: Column) -> Column:
    return F.array_join(tags, ", ")


def path_name(name: Column) -> Column:
    return F.replace(name, F.lit(" "), F.lit("_"))
