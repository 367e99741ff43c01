from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from citeweave.llm.bpe import WordSplitter, _tokenizer
from citeweave.llm.centroids import Codebook, cluster
from citeweave.llm.fill_middle import fill_in_middle, restored, unit_ends
from citeweave.llm.queries import QUERIES
from citeweave.llm.token_files import Sequences, documents_in, write_token_files

from .cases import no_docs, odd_docs, rows

PATH = public_tokenizers.path("word_bpe_49k.json")


# --- fill in the middle

def plain_fim(doc_id, text):
    """One token after another, by a scanner of its own."""
    text = text or ""
    units, at = [], 0
    while at < len(text):
        end = at
        while end < len(text) and text[end] in " \t\n\x0b\x0c\r":
            end += 1
        while end < len(text) and text[end] not in " \t\n\x0b\x0c\r":
            end += 1
        units.append(text[at:end])
        at = end
    digest = hashlib.sha256(b"42:" + ("" if doc_id is None else str(doc_id)).encode()).digest()
    h1, h2, h3, h4 = (int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if text == "" or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def key(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


def test_fill_middle_against_plain_code(spark):
    texts = [row[:2] for row in rows()]
    texts += [(i, f"word{i}  <M> a") for i in range(100, 120)] + [(i, "<P <S <M a< <") for i in range(120, 160)]
    texts += [(i, "\n   x \U0001f600é\t " * (i % 7)) for i in range(200, 300)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").withColumns(
        {name: F.lit(1) for name in ("n", "form", "output", "made", "_text")})
    made = fill_in_middle(docs)
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    back = made.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    assert sorted((tuple(row)[:-1] for row in back), key=key) == sorted((plain_fim(*t) for t in texts), key=key)
    assert sorted(row["back"] for row in back) == sorted(text or "" for _, text in texts)
    assert {row["form"] for row in back} == {"plain", "psm", "spm"}
    assert fill_in_middle(no_docs(spark)).count() == 0


def test_fill_middle_shares(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c d e f").alias("text"))
    counts = {row["form"]: row["count"] for row in fill_in_middle(docs).groupBy("form").count().collect()}
    assert abs(counts["plain"] / 4000 - 0.5) < 0.04 and abs(counts["spm"] / (4000 - counts["plain"]) - 0.8) < 0.04
    assert {row["form"] for row in fill_in_middle(docs, share=100, suffix_first=0).select("form").distinct().collect()} == {"psm"}


def test_unit_ends_of_long_texts():
    text = " a\n" * 200_000
    ends = unit_ends(text)
    assert len(ends) == 200_001 and ends[0] == 2 and ends[-2] == 3 * 200_000 - 1 and ends[-1] == len(text)
    assert unit_ends("") == [] and unit_ends("   ") == [3] and unit_ends("x" * 100_000) == [100_000]


# --- token files

def plain_files(texts):
    """``doc_id, start, n_tokens, ids_crc32`` by the tokenizer itself; ids must differ."""
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    out, start = [], 0
    for doc_id, text in sorted(texts, key=lambda row: key(row[:1])):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_against_the_tokenizer(spark):
    texts = [row[:2] for row in rows() if row[:2] != (None, None)]
    texts = list(dict(texts).items())  # one row for each id, null among them
    texts += [(i, f"Some more words, number {i}! ƏLƏT kƐ <|endoftext|>") for i in range(100, 300)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").withColumns(
        {name: F.lit("x") for name in ("_tie", "_row", "shard", "n_tokens", "start")}).repartition(5)
    manifest = write_token_files(docs, PATH, length=16, shard_bytes=4_000)
    found = documents_in(manifest)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, found.collect()), key=key) == plain_files(texts)
    shards = manifest.orderBy("shard").collect()
    assert len(shards) > 3 and sum(s["n_docs"] for s in shards) == len(texts)
    assert [s["first_token"] for s in shards] == list(np.cumsum([0] + [s["n_tokens"] for s in shards])[:-1])


def test_query_of_token_files(spark, sf_dir):
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op12_token_files"](spark, sf_dir).collect())) == plain_files(texts)


def test_token_files_with_repeated_ids(spark):
    texts = [(1, "one"), (1, "one"), (1, "two words"), (0, None), (None, "z"), (None, "z")] + [(7, f"text {i}") for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    again = [sorted(map(tuple, documents_in(write_token_files(part, PATH, length=8, shard_bytes=500)).collect()), key=key)
             for part in (docs, docs.repartition(4))]
    assert again[0] == again[1] and len(again[0]) == len(texts)
    ends = sorted((start, start + n) for _, start, n, _ in again[0])
    assert [a for a, _ in ends][1:] == [b for _, b in ends][:-1] and ends[0][0] == 0
    assert [r[0] for r in sorted(again[0], key=lambda r: r[1])] == sorted((t[0] for t in texts), key=lambda v: (v is not None, v or 0))


def test_no_documents_give_no_files(spark):
    manifest = write_token_files(no_docs(spark), PATH)
    assert manifest.count() == 0 and documents_in(manifest).count() == 0


def test_sequences_are_views_of_the_file(spark):
    docs = spark.createDataFrame([(i, f"text number {i} of several, with words of its own") for i in range(700)],
                                 "doc_id bigint, text string")
    shard = write_token_files(docs, PATH, length=32).first()
    before = pa.total_allocated_bytes()
    sequences = Sequences(shard["ids_path"])
    assert len(sequences) == shard["n_sequences"] > 128  # more than one batch
    all_ids = np.concatenate([sequences[i][0] for i in range(len(sequences))])
    tokenizer = Tokenizer.from_file(PATH)
    expected = [i for n in range(700) for i in
                [*tokenizer.encode(f"text number {n} of several, with words of its own", add_special_tokens=False).ids, 2]]
    assert all_ids[:len(expected)].tolist() == expected and not all_ids[len(expected):].any()
    ids, mask = sequences[len(sequences) - 1]
    used = len(expected) - 32 * (len(sequences) - 1)
    assert len(ids) == len(mask) == 32 and mask.to_pylist() == [True] * used + [False] * (32 - used)
    assert not ids.flags.owndata and ids.dtype == np.dtype("<u2")
    assert pa.total_allocated_bytes() == before  # pages of the mapped file, no memory of Arrow's own
    with pytest.raises(IndexError):
        sequences[len(sequences)]


def test_words_of_every_plain_character():
    """Characters between letters: a capital may have a small letter beyond U+024F."""
    with open(PATH, encoding="utf-8") as file:
        data = file.read()
    tokenizer, split = _tokenizer(data), WordSplitter(data)
    for code in [*range(1, 0x600), 0x1E9E, 0x212A, 0x212B, 0x2C62, 0xA7AE]:
        text = f"k{chr(code)}z {chr(code)}Ə"
        ids = [i for word in split(text) for i in tokenizer.encode(word, add_special_tokens=False).ids]
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, hex(code)


# --- centroids

def plain_clusters(vectors, clusters=8, rounds=10, dimensions=64):
    """All distances measured, in Python's whole numbers where sums are divided."""
    kept = [(vec_id, [int(np.floor(1024 * float(x))) for x in v]) for vec_id, v in vectors
            if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)]
    if not kept:
        return []
    order = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centroids = [v for _, v in order[:clusters]]
    points = np.array([v for _, v in kept], dtype=np.int64)

    def assign():
        d = ((points[:, None, :] - np.array(centroids, dtype=np.int64)[None]) ** 2).sum(axis=2)
        return d.argmin(axis=1), d.min(axis=1)  # the first of equal ones

    for _ in range(rounds):
        number, _ = assign()
        for k in range(len(centroids)):
            own = points[number == k]
            if len(own):
                centroids[k] = [int(t) // len(own) for t in own.sum(axis=0)]
    number, distance = assign()
    return [(vec_id, int(k), int(d), int(distance[number == k].sum()), int(distance.sum()),
             hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest())
            for (vec_id, _), k, d in zip(kept, number, distance)]


def found_clusters(spark, vectors, **options):
    frame = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>").withColumns(
        {name: F.lit("x") for name in ("vector", "cluster", "n", "total", "label")})
    return sorted(map(tuple, cluster(frame, **options).collect()), key=key)


def test_clusters_against_all_distances(spark):
    draw = np.random.default_rng(5)
    near = draw.normal(draw.integers(-3, 3, (400, 1)), 0.5, (400, 64))
    vectors = [(i, v.tolist()) for i, v in enumerate(near)]
    vectors += [(3, near[3].tolist()), (3, near[4].tolist()), (None, near[5].tolist()), (None, None), (900, None), (901, []),
                (902, [0.5] * 63), (903, [float("nan")] + [0.0] * 63), (904, [float("inf")] * 64), (905, [None] + [0.0] * 63),
                (906, [1e-320] * 64), (907, [-1e-320] * 64)]
    assert found_clusters(spark, vectors) == sorted(plain_clusters(vectors), key=key)


def test_clusters_of_equal_and_few_vectors(spark):
    same = [(i, [0.25] * 4) for i in range(30)]
    few = [(1, [1.0, 0.0, 0.0, 0.0]), (2, [0.0, 0.0, 0.0, 1.0])]
    corners = [(i, [float(b) for b in f"{i:04b}"]) for i in range(16)] * 3  # many ties
    for vectors in (same, few, corners):
        assert found_clusters(spark, vectors, dimensions=4) == sorted(plain_clusters(vectors, dimensions=4), key=key)
    assert found_clusters(spark, [(1, None)]) == []
    assert cluster(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


def test_clusters_of_components_beyond_64_bits(spark):
    with pytest.raises(Exception, match="do not fit 64 bits"):
        found_clusters(spark, [(1, [1e30] * 64)])


def test_search_finds_the_nearest_with_few_distances():
    draw = np.random.default_rng(9)
    for spread, width in ((5, 4), (2000, 64), ((1 << 27) - 1, 16)):
        centroids = draw.integers(-spread, spread + 1, (200, width))
        centroids[100:] += draw.integers(-spread, spread + 1, (100, 1))
        centroids = np.clip(centroids, -(1 << 27) + 1, (1 << 27) - 1)
        centroids[7], centroids[9] = centroids[150], centroids[3]
        vectors = np.concatenate([np.clip(centroids[draw.integers(0, 200, 300)] + draw.integers(-2, 3, (300, width)),
                                          -(1 << 27) + 1, (1 << 27) - 1), centroids])
        number, distance, measured = Codebook(centroids).nearest(vectors)
        every = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
        assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
        assert spread == 5 or measured < every.size / 4
