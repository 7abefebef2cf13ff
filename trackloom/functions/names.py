"""Column expressions for names and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separator of a song key and the label of a missing artist.
KEY_SEPARATOR = "||"
UNKNOWN_ARTIST = "Unknown Artist"


def normalized(name: Column) -> Column:
    return F.lower(F.trim(name))


def stripped(text: Column) -> Column:
    """Without white space of any kind at either end; the catalogue trims blanks only."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def blank_to_null(text: Column) -> Column:
    """Stripped text; NULL when nothing is left."""
    return F.nullif(stripped(text), F.lit(""))


def or_unknown(artist: Column) -> Column:
    return F.when(artist.isNull() | (F.trim(artist) == ""), F.lit(UNKNOWN_ARTIST)).otherwise(artist)


def song_key(track: Column, artist: Column) -> Column:
    return F.concat_ws(KEY_SEPARATOR, track, artist)


def decoded(raw: Column) -> Column:
    """UTF-8 text of a binary column, undecodable bytes replaced, blank as NULL."""
    return blank_to_null(F.make_valid_utf8(raw.cast("string")))
