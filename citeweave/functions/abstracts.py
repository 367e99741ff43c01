"""Abstracts stored as an inverted index: word -> positions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def deinvert_abstract(index: Column) -> Column:
    """Text of an inverted index, without leaving the row.

    Positions no word claims are empty words, so they show as extra spaces.  Of
    two words at one position the later map entry stays.  An empty or null
    index gives null.
    """
    occurrences = F.flatten(F.transform(
        F.map_entries(index),
        lambda entry, rank: F.transform(
            entry["value"],
            lambda at: F.struct(at.alias("at"), rank.alias("rank"), entry["key"].alias("word")),
        ),
    ))

    def last_per_position(words: Column) -> Column:
        def is_last(word: Column, i: Column) -> Column:
            following = F.get(words, i + 1)["at"]
            return following.isNull() | (following != word["at"])

        return F.filter(words, is_last)

    def spaced(words: Column) -> Column:
        def with_gap(word: Column, i: Column) -> Column:
            before = F.coalesce(F.get(words, i - 1)["at"], F.lit(0))
            return F.concat(F.repeat(F.lit(" "), word["at"] - before), word["word"])

        return F.when(F.size(words) > 0, F.array_join(F.transform(words, with_gap), ""))

    def text(words: Column) -> Column:
        # One word at every position, as nearly always: no need to look at neighbours.
        places = words["at"]
        dense = ((F.size(F.array_distinct(places)) == F.size(words))
                 & (F.try_element_at(places, F.lit(-1)) == F.size(words) - 1))
        return F.when(dense, F.array_join(words["word"], " ")).otherwise(
            bind(last_per_position(words), spaced))

    return bind(F.sort_array(occurrences), text)


def invert_text(text: Column) -> Column:
    """Inverted index of a text split at single spaces (the inverse of the above)."""
    occurrences = F.sort_array(F.transform(
        F.split(text, " ", -1),
        lambda word, at: F.struct(word.alias("word"), at.alias("at")),
    ))

    def grouped(words: Column) -> Column:
        firsts = F.filter(
            F.transform(words, lambda w, i: F.when(
                (i == 0) | (F.get(words, i - 1)["word"] != w["word"]), i)),
            lambda i: i.isNotNull(),
        )

        def entries(starts: Column) -> Column:
            def entry(start: Column, k: Column) -> Column:
                end = F.coalesce(F.get(starts, k + 1), F.size(words))
                return F.struct(
                    F.get(words, start)["word"].alias("key"),
                    F.transform(F.slice(words, start + 1, end - start),
                                lambda w: w["at"]).alias("value"),
                )

            return F.map_from_entries(F.transform(starts, entry))

        return bind(firsts, entries)

    return bind(occurrences, grouped)
