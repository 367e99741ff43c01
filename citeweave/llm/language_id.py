"""Language identification with interpolated Kneser-Ney character models.

Each language has one character model of order four, fitted on a bounded sample of
labelled documents and kept as sorted arrays of n-gram hashes with their probabilities.
A word is scored with blanks at both ends, so the score of a text is the sum over its
words, and a task scores a word once for as long as it remembers it.  The language with
the lowest cross-entropy per character is chosen; a text is rejected if even that one lies
far above what texts of the language show, by a bound calibrated on the training sample.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from citeweave.llm.common import give_back, giving_back, named, prepare
from citeweave.sources.tables import staged

ORDER = 4
# The classifier is fitted on so many labelled documents of each language, by hash of the id.
SAMPLE_DOCS = 1_000
DISCOUNT = 0.75
# Rejected: texts whose cross-entropy lies beyond this share of the way from the language's own texts
# to words of the nearest other language, and so many deviations above its mean.
REJECT_SHARE = 0.75
REJECT_DEVIATIONS = 8.0
PROFILE_WORDS = 2_000
SHORT_CHARS = 60  # the bound widens for texts of fewer characters
SCORE_CHARS = 40  # evidence that a score counts, in characters
# A task remembers the scores of words until it holds so many numbers, and then starts anew.
KNOWN_SCORES = 1_000_000
UNDETERMINED = "und"

_LETTER_RUNS = re.compile(r"[^\W\d_]+")


def letter_words(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    return _LETTER_RUNS.findall(text.lower())


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, each with blanks at both ends, and the start of each word."""
    joined = " " + "  ".join(words) + " "
    codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    return codes, np.cumsum(lengths) - lengths


def _grams(codes: np.ndarray, order: int) -> np.ndarray:
    """For each position the last ``order`` code points as one 64-bit number (16 bits each)."""
    total = np.zeros(len(codes), dtype=np.uint64)
    low = np.where(codes > 0xFFFF, np.uint64(0xFFFF), codes)
    for back in range(order):
        total[back:] |= low[:len(codes) - back] << np.uint64(16 * back)
    return total


class Model(NamedTuple):
    """Sorted n-gram numbers of each order with log probabilities, and log weights of contexts."""

    grams: list[np.ndarray]  # per order 1..ORDER
    probabilities: list[np.ndarray]
    contexts: list[np.ndarray]  # per order 1..ORDER-1
    weights: list[np.ndarray]
    floor: float  # log probability of a character never seen
    mean: float = 0.0  # cross-entropy of texts of the language, per character
    deviation: float = 0.0
    profile: tuple[str, ...] = ()  # words by which other languages' models are calibrated


def fit(counts: Counter[str]) -> Model:
    """The interpolated Kneser-Ney model of words with their counts."""
    words = list(counts)
    codes, starts = _codes(words)
    weights = np.repeat(np.fromiter(counts.values(), dtype=np.int64, count=len(words)),
                        np.diff(np.append(starts, len(codes))))
    depth = np.arange(len(codes)) - np.repeat(starts, np.diff(np.append(starts, len(codes))))  # place in the word
    tables: list[tuple[np.ndarray, np.ndarray]] = []
    for order in range(1, ORDER + 1):
        usable = depth >= max(order - 1, 1)
        grams, inverse = np.unique(_grams(codes, order)[usable], return_inverse=True)
        if order == ORDER:
            number = np.bincount(inverse, weights=weights[usable])
        else:  # in how many contexts one longer the n-gram occurs; at a word's start, how often
            wider = _grams(codes, order + 1)[usable]
            open_ = depth[usable] == order - 1
            own = np.unique(wider[~open_]) & np.uint64((1 << (16 * order)) - 1)
            number = np.bincount(np.searchsorted(grams, own), minlength=len(grams)).astype(float)
            number += np.bincount(inverse[open_], weights=weights[usable][open_], minlength=len(grams))
        tables.append((grams, number))
    alphabet = len(tables[0][0]) + 1
    floor = -np.log(alphabet)
    grams_1, number_1 = tables[0]
    total = number_1.sum()
    kept = np.maximum(number_1 - DISCOUNT, 0) / total
    left = 1 - kept.sum()
    probability = kept + left / alphabet
    model_grams, model_log = [grams_1], [np.log(probability)]
    contexts, context_weights = [], []
    unseen = np.log(left / alphabet) if left > 0 else floor
    for order in range(2, ORDER + 1):
        grams, number = tables[order - 1]
        context = grams >> np.uint64(16)
        keys, inverse = np.unique(context, return_inverse=True)
        totals = np.bincount(inverse, weights=number)
        shorter = np.uint64((1 << (16 * (order - 1))) - 1)
        lower = np.exp(model_log[-1][np.searchsorted(model_grams[-1], grams & shorter)])
        discounted = np.maximum(number - DISCOUNT, 0) / totals[inverse]
        taken = np.bincount(inverse, weights=np.minimum(number, DISCOUNT))
        weight = taken / totals
        model_grams.append(grams)
        model_log.append(np.log(discounted + weight[inverse] * lower))
        contexts.append(keys)
        context_weights.append(np.log(weight))
    return Model(model_grams, model_log, contexts, context_weights, float(unseen))


def _found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def word_scores(model: Model, words: list[str]) -> np.ndarray:
    """Log probability of each word, its closing blank included."""
    codes, starts = _codes(words)
    lengths = np.diff(np.append(starts, len(codes)))
    depth = np.arange(len(codes)) - np.repeat(starts, lengths)
    at, known = _found(model.grams[0], _grams(codes, 1))
    score = np.where(known, model.probabilities[0][at], model.floor)
    for order in range(2, ORDER + 1):
        grams = _grams(codes, order)
        usable = depth >= order - 1
        at, known = _found(model.grams[order - 1], grams)
        context_at, context_known = _found(model.contexts[order - 2], grams >> np.uint64(16))
        backed = score + np.where(context_known, model.weights[order - 2][context_at], 0.0)
        score = np.where(usable, np.where(known, model.probabilities[order - 1][at], backed), score)
    score[starts] = 0.0
    return np.add.reduceat(score, starts) if len(starts) else np.zeros(0)


class _Numbers(dict):
    """Word -> number, in order of first sight."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class KnownWords:
    """Words met so far with their log probability in each language; bounded between batches."""

    def __init__(self, models: list[Model]):
        self.models = models
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.sizes = np.zeros(0, dtype=np.int64)
        self.scores = np.zeros((0, len(self.models)))

    def coded(self, texts: Iterable[list[str]]) -> list[np.ndarray]:
        """The numbers of the words of each text; ``sizes`` and ``scores`` then hold all of them."""
        if self.scores.size > KNOWN_SCORES:
            self._forget()
        codes = [np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)) for words in texts]
        fresh = list(itertools.islice(self.numbers, len(self.sizes), None))
        if fresh:
            sizes = np.fromiter(map(len, fresh), np.int64, len(fresh)) + 1
            self.sizes = np.concatenate([self.sizes, sizes])
            self.scores = np.concatenate([self.scores, np.stack([word_scores(m, fresh) for m in self.models], axis=1)])
        return codes


class Identifier:
    """The models of all languages; picklable, of bounded size."""

    def __init__(self, models: dict[str, Model]):
        self.languages = sorted(models)
        self.models = [models[language] for language in self.languages]
        self.bounds = [self._bound(i) for i in range(len(self.models))]

    def _bound(self, own: int) -> float:
        """The highest cross-entropy at which a text passes as one of this language."""
        model = self.models[own]
        if not np.isfinite(model.mean):  # one text was learned from: nothing tells how far others may lie
            return float("inf")
        spread = model.mean + REJECT_DEVIATIONS * model.deviation
        foreign = [-word_scores(model, list(other.profile)).sum() / sum(len(w) + 1 for w in other.profile)
                   for i, other in enumerate(self.models) if i != own and other.profile]
        return max([spread, *([model.mean + REJECT_SHARE * (min(foreign) - model.mean)] if foreign else [])])

    def predict(self, texts: list[str | None], known: KnownWords | None = None) -> tuple[
            list[str], list[float], list[bool], list[float]]:
        """Language, score, acceptance and cross-entropy of each text of a batch."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts), [False] * len(texts), [0.0] * len(texts)
        known = known or KnownWords(self.models)
        coded = known.coded(letter_words(text) if text else [] for text in texts)
        sizes, table = known.sizes, known.scores
        labels, scores, accepted, entropies = [], [], [], []
        for own in coded:
            if not len(own):
                for values, value in zip((labels, scores, accepted, entropies), (UNDETERMINED, 0.0, False, 0.0),
                                         strict=True):
                    values.append(value)
                continue
            n = int(sizes[own].sum())
            entropy = -table[own].sum(axis=0) / n
            best = int(entropy.argmin())
            share = np.exp(-(entropy - entropy[best]) * min(n, SCORE_CHARS))
            model = self.models[best]
            bound = self.bounds[best]
            if np.isfinite(bound):
                bound = model.mean + (bound - model.mean) * max(1.0, (SHORT_CHARS / n) ** 0.5)
            labels.append(self.languages[best])
            scores.append(float(1 / share.sum()))
            accepted.append(bool(entropy[best] <= bound))
            entropies.append(float(entropy[best]))
        return labels, scores, accepted, entropies


def _remainder(doc_id: Column, divisor: int) -> Column:
    """As :func:`citeweave.llm.common.remainder`; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % divisor, F.lit(-1))


def _sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("language", pa.string()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
    for batch in batches:
        rows: list[tuple] = []
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            counts = Counter(letter_words(text.as_py()))
            if counts:
                rows.append((language, list(counts), list(counts.values())))
        for row in rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([value], type=field.type) for value, field in zip(row, schema, strict=True)], schema=schema)


def _fit_language(key: tuple, rows: pa.Table) -> pa.Table:
    """The model of one language, as bytes, with its calibration on halves of the sample."""
    import pickle

    words_of, counts_of = (rows.column(name) for name in ("words", "counts"))

    def counted(part: list[int]) -> Counter[str]:
        total: Counter[str] = Counter()
        for i in part:  # one text at a time is made into Python objects
            total.update(dict(zip(words_of[i].as_py(), counts_of[i].as_py(), strict=True)))
        return total

    docs = sorted(range(rows.num_rows),
                  key=lambda i: xxhash.xxh3_64_intdigest(" ".join(sorted(words_of[i].as_py())).encode()))
    halves = docs[::2], docs[1::2]
    entropies: list[float] = []
    lengths: list[int] = []
    for learn, test in (halves, halves[::-1]):
        if learn and test:
            model = fit(counted(learn))
            for i in test:
                words, counts = words_of[i].as_py(), np.array(counts_of[i].as_py())
                n = int((np.fromiter(map(len, words), np.int64) + 1) @ counts)
                entropies.append(float(-(word_scores(model, words) @ counts) / n))
                lengths.append(n)
    total = counted(docs)
    model = fit(total)
    # Robust: a mislabelled text in the sample does not widen the bound.
    middle = float(np.median(entropies)) if entropies else float("inf")
    scaled = np.abs(np.array(entropies) - middle) * np.sqrt(np.minimum(np.array(lengths), 1000) / 1000)
    deviation = float(1.4826 * np.median(scaled)) if entropies else 0.0
    model = model._replace(mean=middle, deviation=max(deviation, 0.02),
                           profile=tuple(sorted(total, key=xxhash.xxh3_64_intdigest)[:PROFILE_WORDS]))
    give_back()
    return pa.table({"language": pa.array([key[0].as_py()], pa.string()),
                     "model": pa.array([pickle.dumps(model)], pa.binary())})


def fit_identifier(labelled: DataFrame, text_col: str, lang_col: str, order_col: str,
                   sample_docs: int = SAMPLE_DOCS) -> Identifier:
    """Models from ``sample_docs`` labelled documents of each language, first by hash of ``order_col``.

    What comes to the driver are the models: their size follows from the bounds of the
    sample and the number of languages.
    """
    import pickle

    rows = labelled.select(named(lang_col).cast("string").alias("language"), named(text_col).alias("text"),
                           named(order_col).alias("_order")).where("language is not null and text is not null")
    keyed = rows.withColumns({"_place": F.xxhash64(F.lit(7), "_order")})
    # About three times the sample by place, so that only this much is sent anywhere and ranked: the
    # bounds are a written table of one row for each language, small enough to be sent to the rows.
    near = F.lit(float(-(1 << 63))) + F.lit(float(1 << 64)) * F.least(F.lit(1.0), F.lit(3.0 * sample_docs + 100) / F.col("n"))
    bounds = staged(keyed.groupBy("language").agg(F.count(F.lit(1)).alias("n")).select("language", near.alias("_near")), "bounds")
    first = keyed.select("language", "_place", "_order").join(bounds, "language").where("_place <= _near")
    nth = F.row_number().over(W.partitionBy("language").orderBy("_place", "_order"))
    chosen = staged(first.withColumn("nth", nth).where(F.col("nth") <= sample_docs)
                    .select("language", "_place", "_order").distinct(), "language-sample")
    sample = keyed.join(chosen, ["language", "_place", "_order"], "left_semi").select("language", "text")
    counted = sample.mapInArrow(giving_back(_sample_counts), "language string, words array<string>, counts array<bigint>")
    fitted = counted.groupBy("language").applyInArrow(_fit_language, "language string, model binary")
    return Identifier({row["language"]: pickle.loads(row["model"]) for row in fitted.toLocalIterator()})


_PREDICTION = "struct<lang_pred:string,score:double,accepted:boolean,entropy:double>"
_PREDICTION_ARROW = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("accepted", pa.bool_()),
                               ("entropy", pa.float64())])


def predicted(text: Column, identifier: Identifier, spark) -> Column:
    """A struct column ``lang_pred, score, accepted, entropy`` of a text column."""
    model = spark.sparkContext.broadcast(identifier)

    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = KnownWords(model.value.models)
        for part in texts:
            columns = model.value.predict(part.to_pylist(), known)
            yield pa.StructArray.from_arrays(
                [pa.array(values, type=field.type) for values, field in zip(columns, _PREDICTION_ARROW, strict=True)],
                fields=list(_PREDICTION_ARROW))

    predict.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    predict = giving_back(predict)
    return F.arrow_udf(predict, _PREDICTION)(text)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """The language of every text, learned from documents whose id has not remainder 1 modulo 3.

    Returns ``doc_id, held_out, lang_pred, score, accepted, entropy``, one row per row.
    Null texts and texts without a letter are ``und`` with score 0 and not accepted, and so
    is everything if no label was learned.  Of equal cross-entropies the first language by
    name counts.  A language learned from one text accepts whatever is nearest to it, as
    nothing tells how far its texts may lie.  Texts are scored whole; a very long one is held
    whole with its words.  An empty table gives an empty table.  Rows without an id are neither learned from nor
    held out.  Labels are used for learning only; other columns are not looked at.
    """
    prepare(docs.sparkSession)
    fold = _remainder(named(id_col).cast("bigint"), 3)
    learned = docs.select(named(id_col).alias("_id"), named(text_col).alias("_text"), named(lang_col).alias("_lang"),
                          fold.alias("_fold")).where("_fold in (0, 2)")
    identifier = fit_identifier(learned, "_text", "_lang", "_id", sample_docs)
    rows = docs.select(named(id_col).cast("bigint").alias("doc_id"), named(text_col).alias("text"),
                       (fold == 1).alias("held_out"))
    return rows.withColumn("found", predicted(F.col("text"), identifier, docs.sparkSession)).select(
        "doc_id", "held_out", "found.*")


def of_known_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``docs`` without the rows whose language is undetermined or rejected; all columns stay, whatever their names.

    Null texts and texts without a letter go; copies and repeated rows share their fate.
    """
    prepare(docs.sparkSession)
    fold = _remainder(named(id_col).cast("bigint"), 3)
    learned = docs.select(named(id_col).alias("_id"), named(text_col).alias("_text"), named(lang_col).alias("_lang"),
                          fold.alias("_fold")).where("_fold in (0, 2)")
    identifier = fit_identifier(learned, "_text", "_lang", "_id", sample_docs)
    found = predicted(named(text_col), identifier, docs.sparkSession)
    free = "_li" + "_" * max(map(len, docs.columns), default=0)  # longer than any of its columns
    return docs.withColumn(free, found).where(f"{free}.accepted").drop(free)

