"""Raw playlist rows to encoded interactions and their split."""

from __future__ import annotations

from pyspark.sql import DataFrame

from trackloom.operators import clean, interactions, report, sampling
from trackloom.session import materialize

RAW_KEYS = ["user_id", "trackname", "artistname"]


def build_interactions(raw: DataFrame) -> DataFrame:
    """user_id, song_id, interaction and the original names from one row per playlist entry.

    The counts are stored: both id numberings and the final join read them.
    """
    complete = clean.drop_incomplete(raw.select(*RAW_KEYS), RAW_KEYS)
    counts = materialize(interactions.count_interactions(complete, RAW_KEYS), "counts")
    return interactions.encode_ids(counts)


def split_interactions(encoded: DataFrame, seed: int = sampling.SEED) -> DataFrame:
    """The interactions with a ``split`` column; write it partitioned by that column."""
    return sampling.train_test_validation(encoded, ["user_id", "song_id"], seed)


def interaction_report(raw: DataFrame, split: DataFrame) -> DataFrame:
    """Rows of every stage: raw, complete, interactions, users, songs and the three parts.

    ``split`` is the stored result of :func:`split_interactions` on ``raw``.
    """
    stages = {
        "rows": raw,
        "complete": clean.drop_incomplete(raw.select(*RAW_KEYS), RAW_KEYS),
        "interactions": split,
        "users": interactions.distinct_ids(split, "user_id"),
        "songs": interactions.distinct_ids(split, "song_id"),
        **{name: split.filter(split["split"] == name) for name in ("train", "test", "validation")},
    }
    return report.stage_report(stages, {"complete": "rows", "interactions": "complete"})
