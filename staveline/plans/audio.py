"""Jobs on audio descriptions of tracks; these responses have no envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staveline.operators.frames import drop_columns, select_attributes, stack_inner
from staveline.operators.nested import flatten, number_elements, record_path

# Attributes that are kept.
FEATURES = [
    "id", "acousticness", "danceability", "duration_ms", "energy", "instrumentalness", "key",
    "liveness", "loudness", "mode", "speechiness", "tempo", "time_signature", "valence",
]
TRACK_ATTRIBUTES = [
    "id", "popularity", "available_markets", "duration_ms", "explicit", "is_local",
]
PARTS = {
    "sections": "Section Number",
    "segments": "Segment Number",
    "beats": "Beat Number",
    "bars": "Bar Number",
    "tatums": "Tatum Number",
}
TRACK_ID = "Spotify Track ID"


def audio_features(*responses: DataFrame) -> DataFrame:
    """The listed features of all responses."""
    return stack_inner(*[flatten(r) for r in responses], attributes=FEATURES)


def audio_analysis(df: DataFrame) -> dict[str, DataFrame]:
    """Track figures, and one table per kind of part with numbered rows."""
    named = df.withColumnRenamed("track_id", TRACK_ID)
    tables = {"track": drop_columns(flatten(named, keep=[TRACK_ID]), list(PARTS))}
    for part, number in PARTS.items():
        tables[part] = number_elements(named, F.col(f"obj.{part}"), number, keep=[TRACK_ID])
    return tables


def service_tracks(df: DataFrame) -> DataFrame:
    return select_attributes(record_path(df, ["tracks"]), TRACK_ATTRIBUTES)
