"""Raw catalogues of differing columns to one clean, scaled catalogue."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from trackloom.operators import clean, conform, dedupe, report, scale
from trackloom.operators.conform import AUDIO_FEATURES
from trackloom.session import materialize

# Accepted durations in milliseconds (30 s to 15 min).
DURATION_MS = (30_000.0, 900_000.0)
SCALED_COLUMNS = ["duration", *AUDIO_FEATURES]


@dataclass(frozen=True)
class Source:
    """A raw catalogue and where its columns go: target name -> source name."""

    rows: DataFrame
    mapping: dict[str, str]


def conform_sources(sources: list[Source]) -> DataFrame:
    return conform.stack_sources([conform.conform(s.rows, s.mapping) for s in sources])


def merge_sources(sources: list[Source]) -> DataFrame:
    """One row per track id over all sources. Rows without an id count as one track."""
    return dedupe.best_record(conform_sources(sources))


def cleaning_steps(merged: DataFrame, normalize_first: bool = False) -> dict[str, DataFrame]:
    """Complete rows, then one per (name, artist), then tidy names and sane durations, by step.

    As ids are unique after the merge, one grouping is left. Names are compared as
    written unless ``normalize_first``.
    """
    complete = clean.drop_incomplete(merged, AUDIO_FEATURES)
    rows = clean.normalize_names(complete) if normalize_first else complete
    unique = dedupe.dedupe(rows, ["track_name", "artist_name"], ["track_id"])
    named = clean.normalize_names(clean.fill_unknown_artist(unique))
    cleaned = clean.in_range(named, "duration_ms", *DURATION_MS).withColumnRenamed("duration_ms", "duration")
    return {"complete": complete, "unique_names": unique, "cleaned": cleaned}


def clean_catalog(merged: DataFrame, normalize_first: bool = False) -> DataFrame:
    """The last of :func:`cleaning_steps`; not yet scaled."""
    return cleaning_steps(merged, normalize_first)["cleaned"]


def build_catalog(sources: list[Source]) -> tuple[DataFrame, DataFrame]:
    """The scaled catalogue and its stage report.

    The merged and the cleaned rows are stored once each: the counts, the scaling
    bounds and the scaled rows are read from there.
    """
    merged = materialize(merge_sources(sources), "merged")
    cleaned = materialize(clean_catalog(merged), "cleaned")
    counts = report.stage_report({"merged": merged, "cleaned": cleaned})
    return scale.scale_minmax(cleaned, SCALED_COLUMNS), counts


def catalog_report(sources: list[Source]) -> DataFrame:
    """The report of every stage: each source, all of them, merged, and each cleaning step."""
    merged = materialize(merge_sources(sources), "merged")
    each = {f"source_{i}": conform.conform(s.rows, s.mapping) for i, s in enumerate(sources, 1)}
    chain = {"sources": conform_sources(sources), "merged": merged, **cleaning_steps(merged)}
    follows = dict(zip(list(chain)[1:], chain))
    return report.stage_report(each | chain, follows)
