from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from citeweave.llm import language_id as li
from citeweave.llm.bpe import WordSplitter, decode, encode_documents, ids_of_text
from citeweave.llm.lm_scoring import score_documents
from citeweave.llm.mixing import hypergeometric, mix, mixed_rows, shard_quotas, water_filled

from . import cases
from .cases import no_docs, odd_docs, rows

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weights = dict(zip(names, [5, 2, 1] * len(names), strict=False))
    total, fixed = sum(sizes.values()), set()
    while True:
        free = sum(weights[s] for s in names if s not in fixed)
        level = (total - sum(3 * sizes[s] for s in fixed)) / free if free else 0
        more = {s for s in names if s not in fixed and level * weights[s] > 3 * sizes[s]}
        if not more:
            return {s: 3 * sizes[s] if s in fixed else level * weights[s] for s in names}
        fixed |= more


def test_targets(spark):
    for sizes in ({"a": 10, "b": 1000, "é": 40, None: 7, "": 300, "z": 0}, {"a": 5}, {None: 0, "x": 0}):
        frame = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()],
                                      "source string, source_size bigint, n_docs bigint")
        got = {r.source: r.target for r in water_filled(frame).collect()}
        assert got == pytest.approx(brute_targets(sizes))


def test_mix_of_odd_documents(spark):
    docs = odd_docs(spark)
    found = mix(docs, shard_words=500, block_docs=2).collect()
    again = mix(docs.repartition(5), shard_words=500, block_docs=2).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    sizes = Counter()
    for row in rows():
        sizes[row[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", row[1] or ""))
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows())
    targets = brute_targets(sizes)
    taken = Counter()
    for row in found:
        assert row.source_size == sizes[row.source] and row.target == pytest.approx(targets[row.source])
        assert row.taken == row.size * row.copies and row.copies <= 3 and len(row.shards) == len(row.places) == row.copies
        taken[row.source] += row.taken
    largest = {s: max([r.size for r in found if r.source == s]) for s in sizes}
    assert all(abs(taken[s] - targets[s]) <= largest[s] for s in sizes)
    assert mix(no_docs(spark)).count() == 0


def test_mixed_rows_are_the_copies(spark):
    docs = odd_docs(spark)
    copies = Counter()
    for row in mix(docs).collect():
        copies[row.doc_id] += row.copies
    got = mixed_rows(docs)
    assert got.columns == [*docs.columns, "_shard", "_place"]
    counted = Counter(r.doc_id for r in got.collect())
    assert counted == Counter({k: v for k, v in copies.items() if v})
    assert mixed_rows(no_docs(spark)).count() == 0


def test_many_documents_come_near_their_targets(spark):
    rng = random.Random(8)
    docs = [(i, "w " * rng.choice([1, 5, 60, 900]), f"s{min(9, int(rng.expovariate(0.5)))}") for i in range(4000)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    found = mix(frame, shard_words=50_000).collect()
    taken, target, shards = Counter(), {}, Counter()
    for row in found:
        taken[row.source] += row.taken
        target[row.source] = row.target
        for shard in row.shards:
            shards[shard] += row.size
    assert all(abs(taken[s] - target[s]) <= 2 + 0.01 * target[s] for s in target)
    assert len(shards) > 8 and max(shards.values()) < 4 * sum(shards.values()) / len(shards)


def test_hypergeometric_distribution(spark):
    draws, good, total = 30, 40, 100
    frame = spark.range(20_000).select(hypergeometric(
        F.lit(draws), F.lit(good), F.lit(total), (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    ).alias("x"))
    seen = Counter(r.x for r in frame.collect())
    for x in range(8, 17):
        p = math.comb(good, x) * math.comb(total - good, draws - x) / math.comb(total, draws)
        assert abs(seen[x] / 20_000 - p) < 5 * (p * (1 - p) / 20_000) ** 0.5
    edge = spark.range(1).select(*[hypergeometric(*map(F.lit, a), F.lit(0.5)).alias(str(i)) for i, a in enumerate(
        [(0, 5, 10), (10, 5, 10), (3, 0, 10), (3, 10, 10)])]).first()
    assert list(edge) == [0, 5, 0, 3]


def test_shards_get_disjoint_runs_that_cover_the_quotas(spark):
    quotas = {"a": 1000, "b": 7, None: 50, "zero": 0}
    runs = shard_quotas(spark.createDataFrame(list(quotas.items()), "source string, blocks bigint"), 3).collect()
    for source, blocks in quotas.items():
        own = sorted((r.first, r.quota) for r in runs if r.source == source)
        covered = [first + i for first, quota in own for i in range(quota)]
        assert covered == list(range(blocks))
    sizes = Counter()
    for r in runs:
        sizes[r.shard] += r.quota
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 3


def test_words_of_the_tokenizer():
    with open(PATH, encoding="utf-8") as file:
        split = WordSplitter(file.read())
    for text in [r[1] or "" for r in rows()] + ["it's we'll ''S 12³½ a_b ßẞ ǰ ſ", "<|startoftext|><|endoftext|> <|x|>"]:
        joined = [i for word in split(text) for i in ids_of_text(PATH, word)]
        assert joined == ids_of_text(PATH, text).tolist()


@pytest.mark.parametrize("block_bytes", [32 << 20, 500])
def test_encoding_of_odd_documents(spark, block_bytes):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    found = encode_documents(odd_docs(spark), PATH, block_bytes=block_bytes).collect()
    expected = []
    for row in rows():
        ids = tokenizer.encode(row[1] or "", add_special_tokens=False).ids
        expected.append((str(row[0]), ids, tokenizer.decode(ids, skip_special_tokens=False)))
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in found) == sorted(expected)
    assert encode_documents(no_docs(spark), PATH).count() == 0


def test_decoding_by_join(spark):
    encoded = encode_documents(odd_docs(spark).where("doc_id < 15"), PATH)
    again = {r.doc_id: r.decoded for r in decode(encoded, PATH).collect()}
    assert again == {r.doc_id: r.decoded for r in encoded.collect()}


def test_scores_against_brute_force(spark):
    rng = random.Random(9)
    words = [f"w{int(rng.paretovariate(0.8)) % 500}" for _ in range(3000)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 200)))) for i in range(150)]
    docs += [(r[0], r[1]) for r in rows() if r[0] is None or r[0] > 15]
    docs = [(None if i is None else i + 1000 * (n >= 150), t) for n, (i, t) in enumerate(docs)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    counts = Counter()
    for doc_id, text in docs:
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 != 1:
            counts.update([*(text or "").encode().lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    expected = {}
    for doc_id, text in docs:
        tokens = [*(text or "").encode().lower().split(), None]
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        expected[doc_id, len(tokens)] = (sum(counts[t] > 0 for t in tokens), n, base)
    found = score_documents(frame).collect()
    assert len(found) == len(docs)
    for row in found:
        known, total, base = expected[row.doc_id, row.n_tokens]
        assert (row.n_known, row.train_tokens) == (known, total) and row.base_score == pytest.approx(base)
        assert row.score < 0 and row.bits_per_byte >= 0
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert score_documents(no_docs(spark)).count() == 0
    alone = score_documents(spark.createDataFrame([(None, "a b")], frame.schema)).first()
    assert alone.train_tokens == 0 and alone.n_known == 0


def varied(n=60, seed=5):
    """Documents of words that seldom meet twice, and copies of some of them."""
    rng = random.Random(seed)
    docs = [(i, " ".join(f"v{rng.randrange(4000)}" for _ in range(rng.randint(40, 120)))) for i in range(n)]
    return docs, [(1000 + i, text) for i, text in docs[:20]]


def test_documents_that_occur_again_are_scored_apart(spark):
    def learned(i):
        return zlib.crc32(str(i).encode()) % 5 != 1

    docs, copies = varied()
    frame = spark.createDataFrame(docs + copies, "doc_id bigint, text string")
    bits = {r.doc_id: r.bits_per_byte for r in score_documents(frame).collect()}
    twin = {i: i + 1000 if i < 20 else i - 1000 for i in [*range(20), *range(1000, 1020)]}
    again = {i for i, other in twin.items() if learned(other)}
    assert len(again) > 20 and any(not learned(i) for i in again) and any(learned(i) for i in again)
    assert max(bits[i] for i in again) < 0.5 * min(bits[i] for i in bits if i not in again)
    # Documents and their blocks may lie in any order.
    other = {r.doc_id: r.bits_per_byte for r in score_documents(
        spark.createDataFrame((copies + docs)[::-1], frame.schema).repartition(3), block_bytes=3_000).collect()}
    assert other == pytest.approx(bits, rel=1e-4)
    # A document that occurs once owes nothing to itself: the same as if it had not been learned from.
    alone = score_documents(spark.createDataFrame(docs[20:], frame.schema)).collect()
    assert min(r.bits_per_byte for r in alone) > 0.5


def test_texts_without_words_have_scores(spark):
    frame = spark.createDataFrame([(1, ""), (2, None), (None, " "), (7, "")], "doc_id bigint, text string")
    found = score_documents(frame, block_bytes=1).collect()
    assert len(found) == 4 and all(r.n_tokens == 1 and math.isfinite(r.score) for r in found)


def test_counts_of_word_contexts():
    import pyarrow as pa

    from citeweave.llm import word_contexts as wc

    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 6, rng.integers(0, 30)).tolist() for _ in range(50)]
    docs += [docs[3], docs[3], [0] * 300]
    learns = rng.random(len(docs)) < 0.7
    hashes = rng.integers(0, 1 << 48, 6).astype(np.uint64)
    cut, bits, piece_bits = 20, *wc.sizes(10_000)
    blocks = [wc.Tokens(np.array([len(d) for d in docs[part]]), np.concatenate([np.array(d, dtype=np.int32) for d in docs[part]]),
                        hashes, learns[part]) for part in (slice(0, cut), slice(cut, None))]
    pieces = pa.Table.from_batches([batch for i, block in enumerate(blocks)
                                    for batch in wc.pieces_of(i, block, bits, piece_bits)])
    keys = pieces.column("piece").to_numpy()
    sums = pa.concat_tables([wc.sum_piece(bits - piece_bits)((key,), pieces.take(np.flatnonzero(keys == key)))
                             for key in np.unique(keys)])

    def grams(words, order):
        ended = ["end"] * 2 + words + ["end"]
        return [tuple(ended[i - order:i + 1]) for i in range(2, len(ended))]

    documents = int(learns.sum())
    words = Counter(w for d, known in zip(docs, learns, strict=True) if known for w in d)
    of = {order: Counter(g for d, known in zip(docs, learns, strict=True) if known for g in grams(d, order))
          for order in (0, 1, 2)}
    for i, (block, part) in enumerate(zip(blocks, (docs[:cut], docs[cut:]), strict=True)):
        own = sums.take(np.flatnonzero(sums.column("block").to_numpy() == i))
        found = list(wc.counts_of_others(block, own, np.array([words[w] for w in range(6)]), documents, bits, piece_bits))
        for order, (context, follow) in zip(wc.ORDERS, found, strict=True):
            expected = []
            for d, known in zip(part, learns[:cut] if i == 0 else learns[cut:], strict=True):
                mine = {k: Counter(grams(d, k)) if known else Counter() for k in of}
                for at, gram in enumerate(grams(d, order)):
                    before = of[order - 1][gram[:-1]] - mine[order - 1][gram[:-1]]
                    if at == 0:  # nothing stands before the first word
                        before = documents - bool(known) if order == 1 else 0
                    expected.append((before, min(before, of[order][gram] - mine[order][gram])))
            assert list(zip(context.tolist(), follow.tolist(), strict=True)) == expected


def test_numbers_and_word_hashes_come_back():
    from citeweave.llm import word_contexts as wc

    for values in ([], [0], [255, 256, 0, 1 << 40], [(1 << 56) + 7, 3]):
        assert wc.unpack(wc.pack(np.array(values, dtype=np.int64))).tolist() == values
    assert wc.unpack_words(wc.pack_words(np.array([-1, 5], dtype=np.int64))).tolist() == [(1 << 48) - 1, 5]
    keys = np.array([5, 1, 5, 0, 1, 5], dtype=np.uint64)
    for bits in (3, 62):  # sorted together with the position, and apart from it
        order, first, distinct = wc.grouped(keys, bits)
        assert (order.tolist(), first.tolist(), distinct.tolist()) == ([3, 1, 4, 0, 2, 5], [0, 1, 3], [0, 1, 5])


def test_gates_against_plain_loops():
    from citeweave.llm import lm_scoring as lm

    rng = np.random.default_rng(8)
    n, step = 3 * lm.CHUNK, lm.CHUNK
    low = np.log(rng.random(n) * 0.01 + 1e-6)
    contexts = [rng.choice([0, 1, 3, 9, 100, 5000], n) for _ in range(2)]
    counts = [(c, (c * rng.random(n) * (rng.random(n) < 0.6)).astype(np.int64)) for c in contexts]
    followed = lm._Followed(counts, np.array([0]))
    gates = lm._Gates(1)
    found = np.concatenate([gates.refined(low[s:s + step], np.zeros(step, dtype=np.int64), [x[s:s + step] for x in followed.share],
                                          [x[s:s + step] for x in followed.gate]) for s in range(0, n, step)])
    weights, shared = lm.START_GATES.astype(float), np.zeros(2)
    expected = []
    for s in range(0, n, step):
        change, change_shared = np.zeros_like(weights), np.zeros(2)
        for t in range(s, s + step):
            p, used = math.exp(low[t]), []
            for k, (context, follow) in enumerate(counts):
                if not context[t]:
                    continue
                size = sum(context[t] >= least for least in lm.GATE_COUNTS)
                gate = 3 * size + sum(t - back >= 0 and follow[t - back] > 0 for back in (1, 2))
                belief = 1 / (1 + math.exp(-(weights[k, gate] + shared[k])))
                inner = belief * follow[t] / context[t]
                p = inner + (1 - belief) * p
                used.append((k, gate, belief, inner / p))
            left = 1.0
            for k, gate, belief, due in reversed(used):
                change[k, gate] += lm.GATE_RATE * left * (due - belief)
                change_shared[k] += lm.GATE_RATE * left * (due - belief)
                left *= 1 - due
            expected.append(math.log(p))
        weights, shared = weights + change, shared + change_shared
    assert found.tolist() == pytest.approx(expected, rel=1e-4)


def test_refined_probabilities_sum_to_one():
    from citeweave.llm.lm_scoring import START_GATES, _Gates

    rng = np.random.default_rng(2)
    low, *shares = (x / x.sum() for x in rng.random((3, 500)))
    for gate in range(START_GATES.shape[1]):
        own = np.full(500, gate, dtype=np.int8)
        done = _Gates(500).refined(np.log(low), np.arange(500), shares, [own, own])
        assert np.exp(done).sum() == pytest.approx(1, abs=1e-5)


def test_words_and_codes_from_one_reading(spark):
    from citeweave.llm import blocks
    from citeweave.llm.common import id_and_text
    from citeweave.llm.lm_scoring import learned, words_of

    texts = id_and_text(odd_docs(spark))
    both = blocks.coded_with_words(texts, words_of, learned, 2_000)
    assert sorted(map(str, both.where("codes is not null").select("block", "doc_ids", "n_words", "n_bytes", "codes").collect())) == \
        sorted(map(str, blocks.coded(texts, words_of, 2_000).collect()))
    assert sorted(map(str, both.where("word is not null").select("block", "pos", "word", "n_learned").collect())) == \
        sorted(map(str, blocks.dictionaries(texts, words_of, learned, 2_000).drop("n").collect()))


def test_symbol_probabilities_sum_to_one():
    from citeweave.llm.lm_scoring import _CELLS, MixingModel

    rng = np.random.default_rng(1)
    model = MixingModel(rng.integers(0, 50, _CELLS), np.ones(256, dtype=np.int64), 1, 10, 5, 2)
    symbols = np.arange(256)
    zeros = np.zeros(256, dtype=np.int64)
    starts, lengths = np.arange(256), np.ones(256, dtype=np.int64)
    assert np.exp(model._group(symbols, zeros, zeros, starts, lengths)).sum() == pytest.approx(1, abs=1e-3)


def test_character_models_sum_to_one():
    model = li.fit(Counter({"abba": 3, "ab": 5, "ba": 1, "cab": 2}))
    letters = "abc "
    for context in ("a", "ab", "b", "c"):
        # The next character after a word's beginning: all continuations plus the unseen ones.
        total = 0.0
        for letter in letters:
            word = context + letter
            scores = li.word_scores(model, [word.strip()]) if letter == " " else None
            if scores is not None:
                prefix_score = 0.0
            else:
                scores = li.word_scores(model, [word])
                prefix_score = 0.0
            assert np.isfinite(scores[0]) and prefix_score == 0.0
            total += math.exp(scores[0])
        assert total < 1


def labelled(spark, n=120):
    from .cases import FRENCH, PROSE

    rng = random.Random(11)
    docs = []
    for i in range(n):
        words = (PROSE if i % 2 else FRENCH).split()
        docs.append((i, " ".join(rng.choice(words) for _ in range(40)), "en" if i % 2 else "fr"))
    return docs


def test_language_of_held_out_documents(spark):
    docs = labelled(spark)
    extra = [(1000, None, None), (1001, "123 !?", "en"), (1002, "", "fr"), (None, docs[0][1], "fr"),
             (1003, "qzx kkwq xjjq zzvq wqk " * 20, None)]
    frame = spark.createDataFrame(docs + extra, "doc_id bigint, text string, lang string")
    found = li.identify(frame).collect()
    truth = {i: lang for i, _, lang in docs}
    for row in found:
        assert 0 <= row.score <= 1
        if row.doc_id in truth:
            assert row.lang_pred == truth[row.doc_id] and row.accepted
            assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
        elif row.doc_id in (1000, 1001, 1002):
            assert (row.lang_pred, row.score, row.accepted) == ("und", 0.0, False)
        elif row.doc_id == 1003:
            assert row.lang_pred in ("en", "fr") and not row.accepted
        else:
            assert row.lang_pred == "fr" and not row.held_out
    kept = {r.doc_id for r in li.of_known_language(frame).collect()}
    assert kept == set(truth) | {None}


def test_language_without_labels_or_rows(spark):
    assert li.identify(no_docs(spark)).count() == 0
    frame = spark.createDataFrame([(1, "abc", None)], "doc_id bigint, text string, lang string")
    assert li.identify(frame).first().lang_pred == "und"
    assert li.identify(odd_docs(spark)).count() == len(rows())
    assert li.of_known_language(odd_docs(spark)).columns == odd_docs(spark).columns


def test_language_learned_from_one_text_keeps_its_texts(spark, recwarn):
    """One labelled text tells nothing about distances: what is nearest to it is accepted."""
    english = [(i, f"{cases.PROSE} number {i}", "en") for i in range(100)]
    labelled = next(i for i in range(200, 300) if zlib.crc32(str(i).encode()) % 3 != 1)
    french = [(i, f"{cases.FRENCH} encore {i}", "fr" if i == labelled else None) for i in range(200, 300)]
    docs = spark.createDataFrame(english + french, "doc_id bigint, text string, lang string")
    found = {r.doc_id: (r.lang_pred, r.accepted) for r in li.identify(docs).collect()}
    assert all(found[i] == ("fr", True) for i in range(200, 300))
    assert li.of_known_language(docs).count() == 200
    assert not [w for w in recwarn if "invalid value" in str(w.message)]
