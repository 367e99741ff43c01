"""Fill-in-middle transformation by repeated-capture matching.

A text is a sequence of units: words with the blanks before them, and blanks at the end.
One full match of ``(unit)*`` keeps the end of every repetition of the group, so the list of
ends gives the number of units and the offsets of both cuts without a loop over the text.
The two cuts and the form follow from a hash of the document's id alone, so a rerun, another
partitioning or a lost executor changes nothing.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import named, prepare

# The unit, the marks and the seed of the contract.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "42"
# Of a hundred documents so many are transformed, and of a hundred of these so many put the suffix first.
TRANSFORMED, SUFFIX_FIRST = 50, 80

_OUT = "struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>"
_OUT_ARROW = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                        ("middle_chars", pa.int64()), ("output", pa.string())])


@functools.cache
def _units() -> regex.Pattern:
    return regex.compile(f"({UNIT})*")


def unit_ends(text: str) -> list[int]:
    """The offset at which each unit ends, all from one match."""
    return _units().fullmatch(text).ends(1)


def drawn(doc_id: int | None, seed: str = SEED) -> tuple[int, ...]:
    """Four numbers below 2**32 from the id; a missing id is written as nothing."""
    written = f"{seed}:{'' if doc_id is None else doc_id}"
    digits = hashlib.sha256(written.encode()).hexdigest()
    return tuple(int(digits[i:i + 8], 16) for i in range(0, 32, 8))


def transformed(doc_id: int | None, text: str, seed: str = SEED, share: int = TRANSFORMED,
                suffix_first: int = SUFFIX_FIRST) -> tuple[int, str, int | None, int | None, str]:
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    ends = unit_ends(text)
    h1, h2, h3, h4 = drawn(doc_id, seed)
    if not text or h3 % 100 >= share or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return len(ends), "plain", None, None, text
    offsets = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
    first, second = (ends[cut - 1] if cut else 0 for cut in offsets)
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if h4 % 100 < suffix_first:
        return len(ends), "spm", first, second - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return len(ends), "psm", first, second - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def _transform(seed: str, share: int, suffix_first: int):
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ids, texts in batches:
            rows = [transformed(doc_id.as_py(), text.as_py(), seed, share, suffix_first)
                    for doc_id, text in zip(ids, texts, strict=True)]
            columns = zip(*rows, strict=True) if rows else [[] for _ in _OUT_ARROW]
            yield pa.StructArray.from_arrays(
                [pa.array(values, type=field.type) for values, field in zip(columns, _OUT_ARROW, strict=True)],
                fields=list(_OUT_ARROW))

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, _OUT)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = SEED,
                   share: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``, one row per row of ``docs``.

    ``n`` counts the units.  ``form`` is ``psm`` (prefix, suffix, middle), ``spm`` (suffix,
    prefix, middle) or ``plain``, for which ``output`` is the text and the lengths are null.
    Plain are empty texts, texts that contain a mark, and all but ``share`` of a hundred
    others, by a hash of the id; of the rest ``suffix_first`` of a hundred are ``spm``.  Both
    cuts are drawn the same way and fall between units; where they are equal the middle is
    empty, and so may the prefix or the suffix be.

    A null text counts as empty.  Rows without an id draw the numbers of an empty id; rows
    with the same id draw the same numbers, so repeated rows give equal rows.  An empty table
    gives an empty table.  Columns other than the two are not looked at, whatever their
    names.  Nothing is shuffled.  A text is held whole, with some 50 bytes for each of its
    characters while it is matched: every repetition is kept, which is what the method asks.
    """
    prepare(docs.sparkSession)
    rows = docs.select(named(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(named(text_col), F.lit("")).alias("text"))
    run = _transform(seed, share, suffix_first)
    return rows.select("doc_id", run("doc_id", "text").alias("made")).select("doc_id", "made.*")


def restored(output: Column, form: Column) -> Column:
    """The text behind an output and its form.

    A transformed text contains no mark, and no two marks can overlap, so the first
    occurrence of each mark is the one that was put there.
    """
    def parts(head: str, inner: str) -> tuple[Column, Column, Column]:
        body = F.substr(output, F.lit(len(head) + 1))
        one = F.substring_index(body, inner, 1)
        rest = F.substr(body, F.length(one) + len(inner) + 1)
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substr(rest, F.length(two) + len(MIDDLE) + 1)

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    late_suffix, late_prefix, late_middle = parts(SUFFIX, PREFIX)
    return (F.when(form == "psm", F.concat(prefix, middle, suffix))
            .when(form == "spm", F.concat(late_prefix, late_middle, late_suffix))
            .otherwise(output))
