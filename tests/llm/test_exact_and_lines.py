from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from citeweave.llm.exact_dedup import PatriciaTrie, deduplicated, exact_duplicates, normalised
from citeweave.llm.line_dedup import without_repeated_lines

from .cases import EXTRA, no_docs, odd_docs, rows


def low(text):
    return (text or "").encode().lower()


def test_trie_against_a_dictionary():
    rng = random.Random(3)
    trie, expected = PatriciaTrie(), {}
    for number in range(3000):
        key = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9)))
        trie.add(key, (number, number, 1))
        first, _, n = expected.get(key, (number, number, 0))
        expected[key] = (first, number, n + 1)
    assert dict(trie.take_all()) == expected
    assert trie.held == 0 and not list(trie.take_all())


def test_trie_spills_its_largest_subtree():
    trie = PatriciaTrie()
    for key in (b"a" * 50, b"a" * 49 + b"c", b"b", b""):
        trie.add(key, (1, 1, 1))
    assert {key for key, _ in trie.take_largest()} == {b"a" * 50, b"a" * 49 + b"c"}
    assert {key for key, _ in trie.take_all()} == {b"b", b""}


@pytest.mark.parametrize("trie_bytes", [64 << 20, 1_000])
def test_exact_duplicates_of_odd_documents(spark, trie_bytes):
    groups = defaultdict(list)
    for row in rows():
        groups[low(row[1])].append(row[0])
    found = exact_duplicates(odd_docs(spark), trie_bytes=trie_bytes).collect()
    assert len(found) == len(rows())
    by_id = defaultdict(set)
    for row in rows():
        by_id[row[0]].add(hashlib.sha256(low(row[1])).hexdigest())
    members = {hashlib.sha256(key).hexdigest(): ids for key, ids in groups.items()}
    for row in found:
        ids = members[row.text_sha256]
        assert row.text_sha256 in by_id[row.doc_id]
        keep = max((i for i in ids if i is not None), default=None)
        assert (row.keep_id, row.group_size, row.kept) == (keep, len(ids), row.doc_id == keep)


def test_smallest_id_can_stay(spark):
    docs = spark.createDataFrame([(5, "A"), (3, "a"), (9, "ä"), (8, "Ä")], "doc_id bigint, text string")
    found = {row.doc_id: (row.keep_id, row.kept) for row in exact_duplicates(docs, keep="smallest").collect()}
    assert found == {5: (3, False), 3: (3, True), 9: (9, True), 8: (8, True)}
    with pytest.raises(ValueError):
        exact_duplicates(docs, keep="first")


def test_deduplicated_keeps_one_row_and_all_columns(spark):
    kept = deduplicated(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    texts = [low(row.text) for row in kept.collect()]
    assert sorted(texts) == sorted({low(row[1]) for row in rows()})
    assert normalised("ÀB") == "Àb".encode()


def test_no_documents(spark):
    assert exact_duplicates(no_docs(spark)).count() == 0
    assert deduplicated(no_docs(spark)).count() == 0
    assert without_repeated_lines(no_docs(spark)).count() == 0


def brute_lines(docs, least=3):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").encode().lower().decode()

    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = [line for line in lines
                if len(holders[key(line)]) < least or doc_id == max(i for i in holders[key(line)] if i is not None)]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("bits", [1 << 26, 1 << 10])
def test_lines_against_brute_force(spark, bits):
    """A filter far too small gives the same result."""
    docs = [(row[0], row[1]) for row in rows()]
    found = without_repeated_lines(odd_docs(spark), filter_bits=bits)
    assert found.columns == [*odd_docs(spark).columns, "_lines"]
    got = [(row.doc_id, row._lines.n_lines, row._lines.n_dropped, row._lines.text) for row in found.collect()]
    order = str
    assert sorted(got, key=order) == sorted(brute_lines(docs), key=order)
    for row in found.collect():
        assert row._lines.kept_sha256 == hashlib.sha256(row._lines.text.encode()).hexdigest()
        assert [row[name] for name in EXTRA] == EXTRA


def test_many_documents_share_lines(spark):
    rng = random.Random(5)
    pool = [f"line number {i:03d} of the common pool" for i in range(60)]
    docs = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.7 else f"own line {i} {rng.random()}"
                          for _ in range(rng.randint(0, 12)))) for i in range(400)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(13)
    got = [(r.doc_id, r._lines.n_lines, r._lines.n_dropped, r._lines.text)
           for r in without_repeated_lines(frame, filter_bits=1 << 16).collect()]
    assert sorted(got) == sorted(brute_lines(docs))
