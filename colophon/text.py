"""Text cleaning and comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim(col: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def fold(col: Column, match: str = "ci_ai") -> Column:
    """The key that texts are compared by: as they are (exact), without case (ci), or without case, accents and trailing spaces (ci_ai)."""
    if match == "exact":
        return col
    if match == "ci":
        return F.lower(col)
    if match == "ci_ai":
        return F.collate(F.rtrim(col), "UNICODE_CI_AI")
    raise ValueError(f"unknown match: {match}")


_CLEAN = {
    "trim": trim,
    "merge_space": lambda c: F.regexp_replace(c, r"(?U)\s+", " "),
    "trim_punctuation": lambda c: F.regexp_replace(c, r"^[\s\p{P}]+|[\s\p{P}]+$", ""),
    "lowercase": F.lower,
    "uppercase": F.upper,
    "ucfirst": lambda c: F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30)),
    "ucwords": lambda c: F.initcap(F.lower(c)),
    "apostrophe": lambda c: F.translate(c, "'", "’"),
    "single_quote": lambda c: F.translate(c, "’", "'"),
}


def clean_string(col: Column, ops: list[str]) -> Column:
    """The named operations, in order."""
    for op in ops:
        col = _CLEAN[op](col)
    return col


def split_keywords(col: Column) -> Column:
    """Pieces between commas, semicolons and line ends, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(col, "[,;\n]"), trim), lambda x: x != "")


def split_uri_label(col: Column) -> tuple[Column, Column]:
    """(uri, label): what stands before and after the first space; without a space all is the uri."""
    return F.substring_index(col, " ", 1), F.when(F.locate(" ", col) > 0, F.trim(F.regexp_replace(col, "^[^ ]* ", "")))
