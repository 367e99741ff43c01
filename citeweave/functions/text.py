"""Title and abstract text: null handling, joining, cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode white space on which Python's str.split() breaks.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        "
    "        　"
)
# Bracket characters turned into spaces.
BRACKETS = "()[]{}"


def _spaces_for(text: Column, characters: str) -> Column:
    """Runs of the characters as one space, none at either end."""
    # Translating first leaves the pattern nothing to do at single spaces.
    spaced = F.translate(text, characters, " " * len(characters))
    return F.trim(F.regexp_replace(spaced, " {2,}", " "))


def collapse_whitespace(text: Column) -> Column:
    return _spaces_for(text, WHITESPACE)


def clean_text(text: Column) -> Column:
    """Lower case, brackets to spaces, white space collapsed; digits and punctuation stay."""
    return _spaces_for(F.lower(text), WHITESPACE + BRACKETS)


def null_to_empty(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def blank_to_null(text: Column) -> Column:
    """Null for text of white space only, any other text unchanged."""
    return F.when(text.rlike(f"[^{WHITESPACE}]"), text)


def title_abstract(title: Column, abstract: Column) -> Column:
    """Title, one space, abstract; null when both are blank."""
    return blank_to_null(F.concat(null_to_empty(title), F.lit(" "), null_to_empty(abstract)))
