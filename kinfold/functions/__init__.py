"""Column -> Column expressions. All are built-in Spark functions: no Python UDF anywhere."""

from kinfold.functions.answers import (ALL_ANSWERS, FIRST_ANSWER, LIKERT_LEVELS, REVERSE_ITEMS, SCORED_CHOICES,
                                       clean_answer, extract_answers, leading_number_in, level_score,
                                       reverse_scored, strip_quotes, yes_no)
from kinfold.functions.casting import col_of, round_half_away, safe_divide, safe_double, safe_int
from kinfold.functions.ids import (AFFECTED_PATTERN, FAMILY_PATTERN, POSITION_PATTERN, first_match_int, group_int,
                                   suffix_label)
from kinfold.functions.statfns import kolmogorov_p_sql, p_text, signed_text, stars, two_sided_normal_p_sql
from kinfold.functions.timecols import (STUDY_TZ, floor_month, floor_time, format_refresh, last_refresh, local_date,
                                        local_wallclock, months_since, phase_label, text_to_instant, to_instant)

__all__ = [
    "ALL_ANSWERS", "FIRST_ANSWER", "LIKERT_LEVELS", "REVERSE_ITEMS", "SCORED_CHOICES", "clean_answer",
    "extract_answers", "leading_number_in", "level_score", "reverse_scored", "strip_quotes", "yes_no",
    "col_of", "round_half_away", "safe_divide", "safe_double", "safe_int",
    "AFFECTED_PATTERN", "FAMILY_PATTERN", "POSITION_PATTERN", "first_match_int", "group_int", "suffix_label",
    "p_text", "signed_text", "stars", "two_sided_normal_p_sql",
    "STUDY_TZ", "floor_month", "floor_time", "format_refresh", "last_refresh", "local_date", "local_wallclock",
    "months_since", "phase_label", "text_to_instant", "to_instant",
]
