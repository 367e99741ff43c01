from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from citeweave.llm import fingerprints as fp
from citeweave.llm.minhash_dedup import components, estimate, hyperminhash, near_duplicates, one_of_each, shingle_hashes

from .cases import no_docs, odd_docs, rows


def prefix(text):
    return fp.PrefixHashes(fp.code_points(text))


def test_spans_are_equal_wherever_they_stand():
    a, b = prefix("xxabcabcyy"), prefix("abcabd")
    assert a.span(2, 5) == a.span(5, 8) == b.span(0, 3)
    assert a.span(2, 6) != b.span(1, 5)
    assert a.extension(2, b, 0) == 5 and a.extension(0, b, 0) == 0 and a.extension(10, b, 6) == 0


def test_window_hashes_agree_with_spans():
    text = "".join(random.Random(1).choice("abcd é\U0001f600") for _ in range(300))
    one = prefix(text)
    assert [one.span(i, i + 12)[0] for i in range(289)] == one.spans(12).tolist()
    assert len(prefix("abc").spans(12)) == 1 and len(prefix("").spans(12)) == 0


def test_likeness():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(900)]
    a, b = " ".join(words), " ".join(words[:450] + words[:450][::-1])
    mark = fp.fingerprint(prefix(a))
    assert fp.likeness(mark, mark) == 1.0
    assert 0.15 < fp.likeness(mark, fp.fingerprint(prefix(b))) < 0.55
    assert fp.likeness(mark, fp.fingerprint(prefix("q" * 500))) < 0.1
    assert fp.likeness(fp.fingerprint(prefix("")), mark) == 0.0
    assert fp.likeness(fp.fingerprint(prefix("")), fp.fingerprint(prefix(""))) == 1.0


@pytest.mark.parametrize("bucket_bytes", [64 << 20, 3_000])
def test_fingerprints_against_brute_force(spark, bucket_bytes):
    found = fp.fingerprints(odd_docs(spark), bucket_bytes=bucket_bytes).collect()
    ordered = sorted(((r[0], r[1] or "") for r in rows()), key=lambda r: (r[0] is None, r[0] or 0, r[1].encode()))
    expected = []
    for (doc_id, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        edited = fp.edited_text(text, following)
        expected.append((str(doc_id), len(text), hashlib.sha256(edited.encode()).hexdigest(),
                         fp.fingerprint(prefix(text)), fp.fingerprint(prefix(edited))))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint)
                  for r in found) == sorted(expected)
    for row in found:
        assert row.near_edited == fp.likeness(row.fingerprint, row.edited_fingerprint)
        assert 0 <= row.near_next <= 1 and row.common_edited >= row.n_chars - row.n_chars // 2


def test_fingerprints_of_nothing_and_of_one(spark):
    assert fp.fingerprints(no_docs(spark)).count() == 0
    one = spark.createDataFrame([(1, "abc")], "doc_id bigint, text string")
    row = fp.fingerprints(one).first()
    assert row.edited_sha256 == hashlib.sha256(b"aba").hexdigest() and row.near_next == 1.0
    assert fp.fingerprints(spark.createDataFrame([(None, "ab"), (None, "b")], one.schema)).count() == 2


def brute_components(docs, width, percent):
    sets = {}
    for doc_id, text in docs:
        words = (text or "").encode().lower().split()
        n = min(width, len(words))
        sets[doc_id] = {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                one, two = find(a), find(b)
                parent[max(one, two)] = min(one, two)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates_of_odd_documents(spark, width, percent):
    found = near_duplicates(odd_docs(spark), width=width, percent=percent).collect()
    assert len(found) == len(rows())
    expected = brute_components([(r[0], r[1]) for r in rows() if r[0] is not None], width, percent)
    for row in found:
        if row.doc_id is None:
            assert row.component_id is None and row.kept
        else:
            assert (row.n_shingles, row.component_id) == expected[row.doc_id]
            assert row.kept == (row.component_id == row.doc_id)


def test_groups_chains_and_short_texts(spark):
    """Chains of edits, a large group, texts of few words: no link may be lost."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    docs: list[tuple[int, str]] = []
    for _ in range(6):  # chains: each a small edit of the one before
        text = [rng.choice(words) for _ in range(60)]
        for _ in range(12):
            docs.append((len(docs), " ".join(text)))
            text = text[:]
            text[rng.randrange(len(text))] = rng.choice(words)
    base = [rng.choice(words) for _ in range(120)]
    for _ in range(150):  # a large group, each with edits of its own
        text = base[:]
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = rng.choice(words)
        docs.append((len(docs), " ".join(text)))
    passage = " ".join(rng.choice(words) for _ in range(50))
    for _ in range(60):  # a passage that many share, among own words
        docs.append((len(docs), passage + " " + " ".join(rng.choice(words) for _ in range(rng.randint(3, 60)))))
    for _ in range(60):
        docs.append((len(docs), " ".join(rng.choice(words[:4]) for _ in range(rng.randint(1, 5)))))
    rng.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(frame, width=3, percent=85).collect()}
    assert found == brute_components(docs, 3, 85)


def test_estimates_are_close():
    rng = np.random.default_rng(4)
    for share in (0.2, 0.5, 0.9):
        a = rng.integers(0, 1 << 63, 2_000).astype(np.uint64)
        b = np.concatenate([a[:int(2_000 * share)], rng.integers(0, 1 << 63, 2_000 - int(2_000 * share)).astype(np.uint64)])
        true = share / (2 - share)
        value, margin = estimate(hyperminhash(np.unique(a)), hyperminhash(np.unique(b)))
        assert abs(value - true) < margin
    assert len(shingle_hashes([b"a", b"b"], 5)) == 1 and not len(shingle_hashes([], 5))


def test_one_of_each_keeps_columns(spark):
    kept = one_of_each(odd_docs(spark), width=3, percent=85)
    assert kept.columns == odd_docs(spark).columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and 2 not in ids and 3 not in ids and ids[7] == ids[8] == 1
    assert one_of_each(no_docs(spark)).count() == 0
    assert near_duplicates(no_docs(spark)).count() == 0


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1001), (1001, 1005), (1005, 1000)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    groups = defaultdict(set)
    for row in found:
        groups[row.label].add(row.node)
    assert dict(groups) == {0: set(range(301)), 1000: {1000, 1001, 1005}}
