"""One nested record per file to a clean, imputed, scaled table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from trackloom.operators import clean, dedupe, scale
from trackloom.session import materialize

# Accepted durations in seconds and the columns to impute and scale.
DURATION_S = (30.0, 900.0)
RECORD_NUMBERS = [
    "duration",
    "tempo",
    "loudness",
    "artist_familiarity",
    "artist_hotttnesss",
    "song_hotttnesss",
]


def clean_records(records: DataFrame) -> DataFrame:
    """Identified rows, one per track id, one per (name, artist), tidy names, sane durations.

    Of rows with one id the one with the smallest values stays.
    """
    identity = ["track_id", "track_name", "artist_name"]
    rows = clean.drop_incomplete(records, identity)
    rows = dedupe.dedupe(rows, ["track_id"], [c for c in rows.columns if c != "track_id"])
    rows = dedupe.dedupe(rows, ["track_name", "artist_name"], ["track_id"])
    return clean.in_range(clean.normalize_names(rows), "duration", *DURATION_S)


def build_records(records: DataFrame, flags: bool = False) -> DataFrame:
    """Clean, impute and scale. ``flags`` keeps what was missing as ``*_was_null`` columns."""
    cleaned = materialize(clean_records(records), "records")
    imputed = scale.impute_mean(cleaned, RECORD_NUMBERS, flags)
    return scale.scale_minmax(imputed, RECORD_NUMBERS)
