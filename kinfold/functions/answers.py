"""Survey answer text (STR4-9, CND6, quirks Q4-Q5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinfold.functions.casting import col_of

# Answer-extraction patterns.
# Default: lazy, keeps only the first quoted answer with its quotes (quirk Q4).
FIRST_ANSWER = '"(.*?)"'
# Preset: greedy text of any length and over line breaks between the first and last quote, then split on '","' (quirk Q5).
ALL_ANSWERS = '(?s)(?<=").+(?=")'
ANSWER_SEPARATOR = '","'

# The five-point frequency scale, scored 0..4 in this order.
LIKERT_LEVELS = ("never", "almost never", "sometimes", "fairly often", "very often")
# Items scored in reverse (4 - score), by their leading question number.
REVERSE_ITEMS = (4, 5, 7, 8)
# Text shown as the possible answers of a scored item.
SCORED_CHOICES = "0, 1, 2, 3, 4"


def extract_answers(c: Column | str, pattern: str = FIRST_ANSWER) -> Column:
    """answers text -> array<string>: first regex match, lower-cased, split on '","' (STR4-6).

    A NULL or non-matching value gives a NULL array; ``explode_outer`` then keeps the row.
    """
    found = F.regexp_substr(col_of(c), F.lit(pattern))
    return F.split(F.lower(found), ANSWER_SEPARATOR)


def strip_quotes(c: Column | str) -> Column:
    """Remove one leading and one trailing double quote (STR7)."""
    return F.regexp_replace(col_of(c), '^"|"$', "")


def yes_no(c: Column | str) -> Column:
    """'true' -> 'Yes', 'false' -> 'No', anything else unchanged (STR8)."""
    x = col_of(c)
    return F.when(x == "true", F.lit("Yes")).when(x == "false", F.lit("No")).otherwise(x)


def clean_answer(c: Column | str) -> Column:
    return yes_no(strip_quotes(c))


def leading_number_in(c: Column | str, numbers=REVERSE_ITEMS) -> Column:
    """True when the text starts with one of ``numbers``; False otherwise, NULL text included (STR9)."""
    lead = F.regexp_substr(col_of(c), F.lit("^\\d+"))
    return F.coalesce(lead.isin([str(n) for n in numbers]), F.lit(False))


def level_score(c: Column | str, levels=LIKERT_LEVELS) -> Column:
    """Position (0-based) of the text among ``levels``; other text -> NULL (CND6)."""
    pairs = []
    for i, level in enumerate(levels):
        pairs += [F.lit(level), F.lit(i)]
    return F.try_element_at(F.create_map(*pairs), col_of(c))


def reverse_scored(score: Column, question: Column | str, numbers=REVERSE_ITEMS,
                   top: int | None = None, levels=LIKERT_LEVELS) -> Column:
    """``top - score`` for reverse-keyed items, the score otherwise (CND7)."""
    top = len(levels) - 1 if top is None else top
    return F.when(leading_number_in(question, numbers), F.lit(top) - score).otherwise(score)
