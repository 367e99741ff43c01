"""Language model scores by online logistic context mixing.

A text is a sequence of tokens, its lower-cased words and one end.  Every token has a
symbol of eight bits: the end, one of the most frequent words, a class of less frequent
words that share their last letters, a word seen once, or an unknown word.  The bits of a
symbol are predicted from hashed contexts: none, the symbol before, the two symbols
before, and the text so far.  The predictions are combined in the logistic domain with
weights that a gate selects; weights and the counts of the text so far start anew in each
text and are refined as it is read.  A word within its class is predicted by its count.

That prediction is refined by the words themselves: by the words that follow the word before,
and then by those that follow the two words before, in all other learning documents (see
:mod:`citeweave.llm.word_contexts`).  How far a context is believed is a logistic gate.  Its
weights are selected by how frequent the context is and by whether the same order was right
at the last tokens; they too start anew in each text and are refined as it is read.

The probabilities of all known words and one unknown word sum to one, as those of the base
model do.  Counts of all contexts and words are gathered from all learning documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm import word_contexts as wc
from citeweave.llm.blocks import coded_with_words, unpacked
from citeweave.llm.common import arrow_batches, give_back, giving_back, id_and_text, remainder
from citeweave.sources.tables import discard, staged

FOLDS = 5
HEAD_WORDS = 127  # frequent words with a symbol of their own
END, TAIL, TAIL_CLASSES, ONCE, UNKNOWN = 0, 128, 126, 254, 255
BITS = 8
PAIR_CONTEXTS = 1 << 10  # hashed contexts of two symbols
SCORED_BYTES = 16 << 20  # text of a block, or one document if that is longer
FOUND_ROWS = 300_000  # dictionary entries packed at once
PART_TOKENS = 400_000  # tokens that the counts of symbols hold at once
CHUNK = 32  # tokens read between two refinements
GROUP = 2_048  # documents read side by side
RATE = 0.02
START_WEIGHTS = (0.05, 0.35, 0.3, 0.35, 0.0)
GATE_RATE = 0.05
# A gate's weights go by the context's count (1, 2-3, 4-15, 16-255, more) and by how many of the last two
# tokens were known after their contexts; by that number the log odds at the start, for each order.
GATE_COUNTS = (2, 4, 16, 256)
START_GATES = np.tile(np.array([[-3.0, -2.5, -1.5], [-2.0, -0.5, 2.0]], dtype=np.float32), len(GATE_COUNTS) + 1)

_RESOLVED = "block bigint, doc_ids array<bigint>, n_words array<int>, n_bytes array<bigint>, codes binary, counts binary, symbols binary, hashes binary"
_RESOLVED_ARROW = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int32())),
                             ("n_bytes", pa.list_(pa.int64())), ("codes", pa.binary()), ("counts", pa.binary()),
                             ("symbols", pa.binary()), ("hashes", pa.binary())])
_FOUND = "block bigint, pos binary, c binary, symbol binary, hash binary"
_FOUND_ARROW = pa.schema([("block", pa.int64()), *((name, pa.binary()) for name in ("pos", "c", "symbol", "hash"))])
_CELLS_ARROW = pa.schema([("cell", pa.int32()), ("n", pa.int64())])
_SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
           "base_score double, score double, bits_per_byte double")
_SCORES_ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                           ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
                           ("score", pa.float64()), ("bits_per_byte", pa.float64())])
# Cells of the context counts: order 0, order 1, hashed order 2.
_ORDERS = (0, 256, 256 + 256 * 256)
_CELLS = _ORDERS[2] + PAIR_CONTEXTS * 256


def words_of(text: str) -> list[bytes]:
    """Words with A-Z lower-cased."""
    return text.encode("utf-8").lower().split()


def learned(doc_id: int | None) -> bool:
    return remainder(doc_id, FOLDS) not in (1, -1)


def _packed_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The dictionary entries of each block that a task holds, some :data:`FOUND_ROWS` at a time, in one row."""
    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        block, pos, c, symbol, hashes = (column.to_numpy() for column in pa.Table.from_batches(held).columns)
        order = np.lexsort((pos, block))
        rows = []
        for at in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
            rows.append((int(block[at[0]]), wc.pack(np.diff(pos[at], prepend=0)), wc.pack(c[at]),
                         symbol[at].astype(np.uint8).tobytes(), wc.pack_words(hashes[at])))
        return pa.RecordBatch.from_arrays([pa.array(column, type=field.type) for column, field in zip(
            zip(*rows, strict=True), _FOUND_ARROW, strict=True)], schema=_FOUND_ARROW)

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= FOUND_ROWS:
            yield packed(held)
            held, size = [], 0
    if held:
        yield packed(held)


def _resolve(key: tuple, blocks: pa.Table, entries: pa.Table) -> pa.Table:
    """A block with the counts, symbols and hashes of its dictionary in order of number."""
    if blocks.num_rows != 1:
        raise ValueError("two blocks have the same key")
    cells = {name: [cell.as_buffer() for cell in entries.column(name)] for name in _FOUND_ARROW.names[1:]}
    none = np.zeros(0, dtype=np.uint64)
    position = np.concatenate([none, *(np.cumsum(wc.unpack(cell)) for cell in cells["pos"])]).astype(np.int64)
    counts, hashes = np.zeros((2, len(position)), dtype=np.uint64)
    symbols = np.zeros(len(position), dtype=np.uint8)
    counts[position] = np.concatenate([none, *map(wc.unpack, cells["c"])])
    hashes[position] = np.concatenate([none, *map(wc.unpack_words, cells["hash"])])
    symbols[position] = np.frombuffer(b"".join(cells["symbol"]), dtype=np.uint8)
    kept = {name: blocks.column(name) for name in ("block", "doc_ids", "n_words", "n_bytes", "codes")}
    made = {"counts": wc.pack(counts), "symbols": symbols.tobytes(), "hashes": wc.pack_words(hashes)}
    return pa.table({**kept, **{name: pa.array([value], pa.binary()) for name, value in made.items()}},
                    schema=_RESOLVED_ARROW)


class _Sequence:
    """All tokens of some documents, one after another, each document closed by its end."""

    def __init__(self, doc_ids: list, n_bytes: list, n_words: np.ndarray, codes: np.ndarray, counts: np.ndarray,
                 symbols: np.ndarray):
        self.doc_ids, self.n_bytes = doc_ids, n_bytes
        self.lengths = n_words + 1
        self.starts = np.cumsum(self.lengths) - self.lengths
        total = int(self.lengths.sum())
        is_word = np.ones(total, dtype=bool)
        is_word[self.starts + n_words] = False
        self.is_word = is_word
        self.counts = np.full(total, -1, dtype=np.int64)
        self.counts[is_word] = counts[codes]
        self.symbols = np.zeros(total, dtype=np.int64)
        self.symbols[is_word] = symbols[codes]

    def contexts(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol before each token and the hashed pair before it; ends before the first."""
        one = np.zeros_like(symbols)
        one[1:] = symbols[:-1]
        one[self.starts] = END
        two = np.zeros_like(symbols)
        two[1:] = one[:-1]
        two[self.starts] = END
        pair = ((two * 256 + one) * 2_654_435_761 >> 7) % PAIR_CONTEXTS
        return one, pair


class _Resolved:
    """A row of :data:`_RESOLVED`."""

    def __init__(self, rows: pa.RecordBatch | pa.Table, row: int):
        cell = {name: rows.column(name)[row] for name in _RESOLVED_ARROW.names}
        self.block, self.doc_ids, self.n_bytes = (cell[name].as_py() for name in ("block", "doc_ids", "n_bytes"))
        self.n_words = np.array(cell["n_words"].as_py(), dtype=np.int64)
        self.codes = unpacked(cell["codes"].as_buffer())
        self.counts = wc.unpack(cell["counts"].as_buffer()).astype(np.int64)
        self.symbols = np.frombuffer(cell["symbols"].as_buffer(), dtype=np.uint8)
        self.hashes = cell["hashes"].as_buffer()

    def tokens(self) -> wc.Tokens:
        return wc.Tokens(self.n_words, self.codes, wc.unpack_words(self.hashes),
                         np.array([learned(doc_id) for doc_id in self.doc_ids], dtype=bool))

    def sequences(self) -> Iterator[tuple[_Sequence, slice]]:
        """The documents in parts of about :data:`PART_TOKENS`, or one document if that is longer, and their tokens."""
        ends = np.cumsum(self.n_words)
        first = 0
        while first < len(ends):
            before = int(ends[first] - self.n_words[first])
            last = max(first + 1, int(np.searchsorted(ends + np.arange(len(ends)), before + first + PART_TOKENS)))
            own = slice(first, last)
            yield (_Sequence(self.doc_ids[own], self.n_bytes[own], self.n_words[own],
                             self.codes[before:int(ends[last - 1])], self.counts, self.symbols),
                   slice(before + first, int(ends[last - 1]) + last))
            first = last


def _resolved_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[_Resolved]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield _Resolved(batch, row)


def _context_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of symbols by context in the learning documents of a task.

    A word seen once would be unknown had its document been left out, and one seen twice
    would be a word seen once; they count as such, so that unknown words get their share.
    """
    cells = np.zeros(_CELLS, dtype=np.int64)
    for block in (part for row in _resolved_rows(batches) for part, _ in row.sequences()):
        mask = np.repeat([learned(doc_id) for doc_id in block.doc_ids], block.lengths).astype(bool)
        symbols = np.where(block.counts == 1, UNKNOWN, np.where(block.counts == 2, ONCE, block.symbols))
        one, pair = block.contexts(block.symbols)
        symbols, one, pair = symbols[mask], one[mask], pair[mask]
        for start, context in zip(_ORDERS, (np.zeros_like(one), one, pair), strict=True):
            size = 256 if start == 0 else 256 * 256 if start == 256 else PAIR_CONTEXTS * 256
            cells[start:start + size] += np.bincount(context * 256 + symbols, minlength=size)
    used = np.flatnonzero(cells)
    for start in range(0, len(used), 200_000):
        part = used[start:start + 200_000]
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(cells[part])], schema=_CELLS_ARROW)


def _context_pieces(bits: int, piece_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _resolved_rows(batches):
            yield from wc.pieces_of(row.block, row.tokens(), bits, piece_bits)
            give_back()

    return giving_back(run)


class _Followed:
    """What contexts of words say of a document's tokens, by order.

    ``share`` is the share of a token among those that follow its context, ``gate`` the
    number of the gate's weights, or -1 without the context.
    """

    def __init__(self, counts: Iterable[tuple[np.ndarray, np.ndarray]], starts: np.ndarray):
        self.share, self.gate = [], []
        for context, follow in counts:
            share = np.zeros(len(context), dtype=np.float32)
            self.share.append(np.divide(follow, context, out=share, where=context > 0, casting="unsafe"))
            gate = np.zeros(len(context), dtype=np.int8)
            for least in GATE_COUNTS:
                gate += (context >= least).view(np.int8)
            gate *= START_GATES.shape[1] // (len(GATE_COUNTS) + 1)
            seen = (follow > 0).view(np.int8)
            for _ in range(2):  # the token before, and the one before that
                seen[1:] = seen[:-1].copy()
                seen[starts] = 0
                gate += seen
            gate[context <= 0] = -1
            self.gate.append(gate)


def _stretched(cells: np.ndarray, contexts: int) -> np.ndarray:
    """Log odds of a one at each inner node of each context's tree of symbols."""
    tree = np.zeros((contexts, 512))
    tree[:, 256:] = cells.reshape(contexts, 256)
    for node in range(255, 0, -1):
        tree[:, node] = tree[:, 2 * node] + tree[:, 2 * node + 1]
    ones, zeros = tree[:, 3::2], tree[:, 2::2]
    odds = np.zeros((contexts, 256), dtype=np.float32)
    odds[:, 1:] = np.log((ones + 0.2) / (zeros + 0.2))
    return odds


class MixingModel:
    """Counts gathered from the corpus, of fixed size, and what a text is scored with."""

    def __init__(self, cells: np.ndarray, class_mass: np.ndarray, once: int, tokens: int, distinct: int,
                 documents: int):
        zero, one, two = np.split(cells, _ORDERS[1:])
        self.odds = [_stretched(zero, 1), _stretched(one, 256), _stretched(two, PAIR_CONTEXTS)]
        # Contexts with few counts are gated to weights of their own.
        self.sure = two.reshape(PAIR_CONTEXTS, 256).sum(axis=1) > 1_000
        self.class_log = np.log(np.maximum(class_mass, 1).astype(float))
        self.once_log = math.log(max(once, 1))
        self.tokens, self.distinct, self.documents = tokens, distinct, documents

    def base_logs(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def within_class(self, symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Log probability of each word given its symbol."""
        tail = (symbols >= TAIL) & (symbols < ONCE)
        logs = np.zeros(len(symbols))
        logs[tail] = np.log(counts[tail]) - self.class_log[symbols[tail]]
        logs[symbols == ONCE] = -self.once_log
        return logs

    def text_logs(self, starts: np.ndarray, lengths: np.ndarray, symbols: np.ndarray, one: np.ndarray,
                  pair: np.ndarray, words: tuple) -> np.ndarray:
        """Log probability of each document of a block, documents read side by side.

        ``words`` has for each token the log probability within its symbol, and by order what :class:`_Followed` has.
        """
        result = np.zeros(len(lengths))
        order = np.argsort(-lengths, kind="stable")  # alike lengths side by side
        for first in range(0, len(order), GROUP):
            docs = order[first:first + GROUP]
            result[docs] = self._group(symbols, one, pair, starts[docs], lengths[docs], words)
        return result

    def _group(self, symbols, one, pair, starts, lengths, words=None) -> np.ndarray:
        logs = np.zeros(len(starts))
        gates = _Gates(len(starts))
        # Weights by input, document and gate; all tables are flat, which is how numpy looks up fastest.
        weights = np.repeat(np.array(START_WEIGHTS, dtype=np.float32), len(starts) * 2 * BITS).reshape(
            len(START_WEIGHTS), -1)
        by_document = weights.reshape(len(START_WEIGHTS), -1, 2 * BITS)
        seen = np.full(len(starts) * 512, 0.4, dtype=np.float32)
        odds = [table.reshape(-1) for table in self.odds]
        done = 0
        while len(starts):
            active = int(np.searchsorted(-lengths, -done, side="left"))  # lengths fall
            if not active:
                break
            size = np.minimum(lengths[:active] - done, CHUNK)
            bounds = np.cumsum(size) - size
            doc = np.repeat(np.arange(active), size)
            at = np.repeat(starts[:active] + done - bounds, size) + np.arange(int(size.sum()))
            own, before, context = (x[at].astype(np.int64) for x in (symbols, one, pair))
            own += 256
            before *= 256
            gate = self.sure[context].astype(np.int64)
            context *= 256
            side, slot, counter = 2 * doc + gate, 2 * BITS * doc + gate, 512 * doc
            change = np.empty((len(START_WEIGHTS), active, 2 * BITS), dtype=np.float32)
            total = np.zeros(len(at), dtype=np.float32)
            inputs = np.empty((len(START_WEIGHTS), len(at)), dtype=np.float32)
            inputs[4] = 0.3
            for depth in range(BITS):
                node = own >> (BITS - depth)
                bit = (own >> (BITS - 1 - depth) & 1).astype(np.float32)
                np.take(odds[0], node, out=inputs[0], mode="clip")
                np.take(odds[1], before + node, out=inputs[1], mode="clip")
                np.take(odds[2], context + node, out=inputs[2], mode="clip")
                zeros = counter + 2 * node
                np.log(seen.take(zeros + 1) / seen.take(zeros), out=inputs[3])
                chosen = slot + 2 * depth
                z = weights[0].take(chosen) * inputs[0]
                for weight, value in zip(weights[1:], inputs[1:], strict=True):
                    z += weight.take(chosen) * value
                np.clip(z, -14, 14, out=z)
                p = 1 / (1 + np.exp(-z))
                total += np.log(np.where(bit > 0, p, 1 - p))
                wrong = bit - p
                for i, value in enumerate(inputs):
                    change[i, :, 2 * depth:2 * depth + 2] = np.bincount(
                        side, wrong * value, 2 * active).reshape(active, 2)
            total = total.astype(float)
            if words is not None:
                inside, share, follows = words
                total = gates.refined(total + inside[at], doc, [x[at] for x in share], [x[at] for x in follows])
            logs[:active] += np.add.reduceat(total, bounds)
            change *= np.float32(RATE)
            by_document[:, :active] += change
            for depth in range(1, BITS + 1):
                np.add.at(seen, counter + (own >> (BITS - depth)), np.float32(1))
            done += CHUNK
        return logs


class _Gates:
    """How far each document believes its contexts of words: weights of a context's gate and of its order."""

    def __init__(self, documents: int):
        self.documents = documents
        self.weights = [np.tile(start, documents) for start in START_GATES]
        self.shared = [np.zeros(documents, dtype=np.float32) for _ in START_GATES]

    def refined(self, logs: np.ndarray, doc: np.ndarray, shares: list, gates: list) -> np.ndarray:
        """Log probabilities of tokens after the gates, whose weights are then refined."""
        low = np.exp(logs)
        steps = []
        for k, (share, gate) in enumerate(zip(shares, gates, strict=True)):
            at = np.flatnonzero(gate >= 0)
            own = doc[at]
            place = own * START_GATES.shape[1] + gate[at]
            belief = 1 / (1 + np.exp(-np.clip(self.weights[k][place] + self.shared[k][own], -14, 14)))
            inner = belief * share[at]
            mixed = inner + (1 - belief) * low[at]
            steps.append((at, own, place, belief, inner / mixed))
            low[at] = mixed
        # What a later order left over is all that an earlier one is judged by.
        left = np.ones(len(low), dtype=np.float32)
        for k, (at, own, place, belief, due) in reversed([*enumerate(steps)]):
            wrong = left[at] * (due - belief) * GATE_RATE
            left[at] *= 1 - due
            self.weights[k] += np.bincount(place, wrong, len(self.weights[k])).astype(np.float32)
            self.shared[k] += np.bincount(own, wrong, self.documents).astype(np.float32)
        return np.log(low)


def _score(model, bits: int, piece_bits: int):
    def score(key: tuple, blocks: pa.Table, pieces: pa.Table) -> pa.Table:
        if blocks.num_rows != 1:
            raise ValueError("two blocks have the same key")
        own, row = model.value, _Resolved(blocks, 0)
        tokens = row.tokens()
        followed = _Followed(wc.counts_of_others(tokens, pieces, row.counts, own.documents, bits, piece_bits),
                             tokens.starts)
        starts, lengths = tokens.starts, row.n_words + 1
        del tokens
        give_back()
        symbols, one, pair = (np.zeros(int(lengths.sum()), dtype=kind) for kind in (np.uint8, np.uint8, np.int16))
        inside = np.zeros(len(symbols), dtype=np.float32)
        base, known = np.zeros(len(lengths)), np.zeros(len(lengths), dtype=np.int64)
        first = 0
        for part, at in row.sequences():
            counts = np.where(part.is_word, part.counts, own.documents)
            docs = slice(first, first := first + len(part.lengths))
            base[docs] = np.add.reduceat(own.base_logs(counts), part.starts)
            known[docs] = np.add.reduceat((counts > 0).astype(np.int64), part.starts)
            inside[at] = own.within_class(part.symbols, part.counts)
            symbols[at] = part.symbols
            one[at], pair[at] = part.contexts(part.symbols)
        scores = own.text_logs(starts, lengths, symbols, one, pair, (inside, followed.share, followed.gate)) / math.log(10)

        def rows() -> Iterator[tuple]:
            for i, (doc_id, n_bytes) in enumerate(zip(row.doc_ids, row.n_bytes, strict=True)):
                bits_per_byte = -scores[i] * math.log2(10) / n_bytes if n_bytes else 0.0
                yield (doc_id, remainder(doc_id, FOLDS) == 1, int(lengths[i]), int(known[i]), own.tokens,
                       float(base[i]), float(scores[i]), float(bits_per_byte))

        done = pa.Table.from_batches(list(arrow_batches(rows(), _SCORES_ARROW, lambda row: 80)), schema=_SCORES_ARROW)
        give_back()
        return done

    return score


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", written: bool = False,
                    block_bytes: int = SCORED_BYTES) -> DataFrame:
    """Log10 probabilities of each text under the base model and under the mixing model.

    Learned from documents whose CRC-32 of the id has not remainder 1 modulo 5.  What a document
    itself adds to the contexts of words does not count in its own score, so one that occurs
    nowhere else is scored as if it were new, and one that occurs again is not.  Returns
    ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte``, one row per row.  Null texts count as empty and have one token, the
    end; with no bytes their bits per byte are 0.  Rows without an id are neither
    learned from nor held out.  With nothing learned every word is unknown.  Other columns
    are not looked at.

    Texts are read twice, the second time for their number and size.  Set ``written`` if ``docs`` is read straight from files; otherwise
    they are written to the shared folder first.
    """
    spark = docs.sparkSession
    texts = id_and_text(docs, id_col, text_col)
    texts = texts if written else staged(texts, "texts")
    both = staged(coded_with_words(texts, words_of, learned, block_bytes), "blocks", tidy=True)
    entries = both.where("word IS NOT NULL").select("block", "pos", "word", "n_learned")
    blocks = both.where("codes IS NOT NULL").select("block", "doc_ids", "n_words", "n_bytes", "codes")
    is_learned = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS, F.lit(1)) != 1
    documents, n_bytes = texts.agg(F.count_if(is_learned), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    bits, piece_bits = wc.sizes(n_bytes)
    counts = staged(entries.where("n_learned > 0").groupBy("word").agg(
        F.sum("n_learned").cast("bigint").alias("c")), "word-counts", tidy=True)
    # Ties at the border fall by word, so that reruns agree.
    head = counts.where("c > 2").orderBy(F.desc("c"), "word").limit(HEAD_WORDS).collect()
    head_map = F.create_map(*[F.lit(x) for i, row in enumerate(head) for x in (bytes(row["word"]), 1 + i)]) if head else None
    tail = F.lit(TAIL) + F.crc32(F.substring("word", -3, 3)) % TAIL_CLASSES
    symbol = F.when(F.col("c").isNull(), F.lit(UNKNOWN)).when(F.col("c") == 1, F.lit(ONCE)).otherwise(tail).cast("int")
    if head_map is not None:
        symbol = F.when(F.col("c") >= head[-1]["c"], F.coalesce(F.element_at(head_map, F.col("word")), symbol)).otherwise(symbol)
    symbols = counts.withColumn("symbol", symbol)
    totals = symbols.groupBy("symbol").agg(F.sum("c").alias("mass"), F.count(F.lit(1)).alias("n")).collect()  # 256 rows
    mass = np.zeros(256, dtype=np.int64)
    for row in totals:
        mass[row["symbol"]] = row["mass"]
    once = sum(row["n"] for row in totals if row["symbol"] == ONCE)
    tokens = int(mass.sum()) + documents
    distinct = sum(row["n"] for row in totals) + (documents > 0)

    found = entries.select("block", "pos", "word").join(counts, "word", "left").withColumn("symbol", symbol).select(
        "block", "pos", F.coalesce("c", F.lit(0)).cast("bigint").alias("c"), "symbol", F.xxhash64("word").alias("hash"))
    found = found.mapInArrow(giving_back(_packed_entries), _FOUND)
    resolved = staged(blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_resolve, _RESOLVED),
                      "resolved", tidy=True)
    discard(both)
    cells = np.zeros(_CELLS, dtype=np.int64)
    gathered = resolved.mapInArrow(_context_counts, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    table = gathered.toArrow()  # at most _CELLS rows
    cells[table.column("cell").to_numpy()] = table.column("n").to_numpy()
    model = MixingModel(cells, mass, once, tokens, distinct, documents)
    sums = resolved.mapInArrow(_context_pieces(bits, piece_bits), wc.PIECES).groupBy("piece").applyInArrow(
        wc.sum_piece(bits - piece_bits), wc.SUMS)
    score = _score(spark.sparkContext.broadcast(model), bits, piece_bits)
    return resolved.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(score, _SCORES)
