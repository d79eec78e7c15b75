"""Participant id parsing (STR1-3, STR13, quirk Q9)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinfold.functions.casting import col_of, safe_int

# The study's id patterns.
FAMILY_PATTERN = "[0-9]+"                   # first digit run anywhere in the id
POSITION_PATTERN = "^[^_]+_\\d+_(\\d+)"     # family position: third underscore-separated field
AFFECTED_PATTERN = "_v$"                    # id suffix marking an affected participant
# Look-around variants (unused by the study code, accepted as parameters).
POSITION_PATTERN_SUFFIXED = "\\d+(?=_v)|\\d+$"


def prefixed_family_pattern(prefix: str) -> str:
    """Family number right after ``<prefix>_`` (look-behind variant of FAMILY_PATTERN)."""
    return f"(?<={prefix}_)\\d+"


def first_match_int(c: Column | str, pattern: str = FAMILY_PATTERN) -> Column:
    """Whole first match of ``pattern`` as int; NULL when there is no match (STR1)."""
    return safe_int(F.regexp_substr(col_of(c), F.lit(pattern)))


def group_int(c: Column | str, pattern: str = POSITION_PATTERN, group: int = 1) -> Column:
    """Capture group ``group`` of ``pattern`` as int; NULL on no match (STR2).

    ``regexp_extract`` returns '' for a miss, so the empty string is mapped to NULL first.
    """
    return safe_int(F.nullif(F.regexp_extract(col_of(c), pattern, group), F.lit("")))


def suffix_label(c: Column | str, pattern: str = AFFECTED_PATTERN, hit: str = "vitiligo",
                 miss: str = "healthy") -> Column:
    """``hit`` when the id matches ``pattern``; ``miss`` otherwise, including NULL ids (STR3)."""
    return F.when(col_of(c).rlike(pattern), F.lit(hit)).otherwise(F.lit(miss))
