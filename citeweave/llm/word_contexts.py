"""How often a token follows the words before it, counted over the whole corpus.

A context is the word before a token, or the two words before it.  What is counted is the
context together with the token, known by a hash whose width follows the size of the
corpus.  The counts of a block of documents travel in pieces, each a range of hashes:
every piece of all blocks is summed in one task, and the sums go back to the blocks in the
order in which the block sent its hashes, so that no hash travels twice.  There are pieces
in proportion to the corpus, and a frequent pair of words is one entry of each block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

ORDERS = (1, 2)  # words before a token
PIECE_BYTES = 8 << 20  # text whose hashes fill a piece
LEAST_PIECES = 64
WORD_BYTES = 6  # of a word's hash

PIECES = "piece int, block bigint, hashes binary, counts binary"
_PIECES_ARROW = pa.schema([("piece", pa.int32()), ("block", pa.int64()), ("hashes", pa.binary()),
                           ("counts", pa.binary())])
SUMS = "block bigint, piece int, sums binary"
_SUMS_ARROW = pa.schema([("block", pa.int64()), ("piece", pa.int32()), ("sums", pa.binary())])

_END = 0x6A09E667F3BCC909  # in place of a word's hash
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
_STIR = np.uint64(0x94D049BB133111EB)
_STRETCH = 1 << 18  # tokens hashed at once
_RANGE_TOKENS = 1 << 18  # tokens sorted at once, about


def sizes(n_bytes: int) -> tuple[int, int]:
    """Bits of a hash and bits of the number of pieces for a corpus of so many bytes of text.

    There are more than a thousand times as many hashes as tokens, so few contexts share one.
    """
    pieces = max(LEAST_PIECES, -(-n_bytes // PIECE_BYTES))
    return min(56, 8 + max(24, int(n_bytes).bit_length())), (pieces - 1).bit_length()


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as planes of bytes, as many as the largest needs; their number first."""
    n = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].T)
    return bytes([n]) + zstandard.compress(planes.tobytes(), 1)


def unpack(data) -> np.ndarray:
    held = memoryview(data)
    planes = np.frombuffer(zstandard.decompress(held[1:]), dtype=np.uint8).reshape(held[0], -1)
    values = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    values[:, :held[0]] = planes.T
    return values.view("<u8").reshape(-1)


def pack_words(hashes: np.ndarray) -> bytes:
    """The low :data:`WORD_BYTES` of 64-bit hashes."""
    return hashes.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES].tobytes()


def unpack_words(data) -> np.ndarray:
    low = np.frombuffer(data, dtype=np.uint8).reshape(-1, WORD_BYTES)
    values = np.zeros((len(low), 8), dtype=np.uint8)
    values[:, :WORD_BYTES] = low
    return values.view("<u8").reshape(-1)


class Tokens:
    """The words and ends of a block's documents, and which documents are learned from."""

    def __init__(self, n_words: np.ndarray, codes: np.ndarray, word_hashes: np.ndarray, learned: np.ndarray):
        lengths = n_words + 1
        self.starts = np.cumsum(lengths) - lengths
        self.size = int(lengths.sum())
        self.doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        self.learned = learned
        self.end = len(word_hashes)  # the number of an end, as those of words
        # Two ends stand before the first document.
        self.numbers = np.full(self.size + 2, self.end, dtype=np.int32)
        is_word = np.ones(self.size, dtype=bool)
        is_word[self.starts + n_words] = False
        self.numbers[2:][is_word] = codes
        self._hashes = np.append(word_hashes, np.uint64(_END))

    def scattered(self) -> np.ndarray:
        """The numbers of words and ends, dealt out over 32 bits: no two have the same."""
        result = self.numbers[2:].astype(np.uint64)
        result *= np.uint64(2_654_435_761)
        result &= np.uint64((1 << 32) - 1)
        return result

    def hashes(self, order: int, bits: int) -> np.ndarray:
        """A hash of each token and the ``order`` words before it; ends stand before the first word."""
        tables = [self._hashes * factor for factor in _FACTORS[:order + 1]]
        result = np.empty(self.size, dtype=np.uint64)
        for low in range(0, self.size, _STRETCH):
            high = min(low + _STRETCH, self.size)
            made = result[low:high]
            made[:] = 0
            for back, table in enumerate(tables):
                numbers = self.numbers[low + 2 - back:high + 2 - back]
                if back == 2:  # the end of the document before is one word back
                    numbers = numbers.copy()
                    numbers[self.starts[slice(*np.searchsorted(self.starts, (low, high)))] - low] = self.end
                made += table.take(numbers)
            made ^= made >> np.uint64(32)
            made *= _STIR
            made ^= made >> np.uint64(29)
            made *= _FACTORS[0]
            made >>= np.uint64(64 - bits)
        return result

    def ranges(self, hashes: np.ndarray, bits: int, piece_bits: int) -> Iterator[tuple[slice, np.ndarray]]:
        """Positions by ranges of hashes, each of whole pieces and of about :data:`_RANGE_TOKENS`, and the pieces."""
        split = min(piece_bits, (self.size // _RANGE_TOKENS).bit_length())
        kind = np.int32 if self.size < 1 << 31 else np.int64
        for i in range(1 << split):
            inside = hashes >= np.uint64(i << (bits - split))
            inside &= hashes < np.uint64(i + 1 << (bits - split))
            yield slice(i << (piece_bits - split), i + 1 << (piece_bits - split)), np.flatnonzero(inside).astype(kind)


def grouped(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions in order of key, those of one key in their order; where each key begins; the keys."""
    n = len(keys)
    place = max(1, (n - 1).bit_length())
    if bits + place <= 64:  # one sort of key and position together
        both = keys << np.uint64(place)
        both |= np.arange(n, dtype=np.uint64)
        both.sort()
        order = (both & np.uint64((1 << place) - 1)).astype(np.int32 if place < 32 else np.int64)
        both >>= np.uint64(place)
    else:
        order = np.argsort(keys, kind="stable")
        both = keys[order]
    begins = np.ones(n, dtype=bool)
    np.not_equal(both[1:], both[:-1], out=begins[1:])
    first = np.flatnonzero(begins)
    return order, first, both[first]


def _summed(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, first) if len(first) else np.zeros(0, dtype=values.dtype)


def pieces_of(block: int, tokens: Tokens, bits: int, piece_bits: int) -> Iterator[pa.RecordBatch]:
    """A block's hashes in ascending order with what its learning documents count, in pieces."""
    for order in ORDERS:
        hashes = tokens.hashes(order, bits)
        for pieces, places in tokens.ranges(hashes, bits, piece_bits):
            at, first, keys = grouped(hashes[places], bits)
            counts = _summed(tokens.learned[tokens.doc[places[at]]].astype(np.int64), first)
            edges = np.arange(pieces.start, pieces.stop + 1, dtype=np.uint64) << np.uint64(bits - piece_bits)
            cuts = np.searchsorted(keys, edges)
            rows = []
            for i in np.flatnonzero(cuts[1:] > cuts[:-1]):
                part = slice(cuts[i], cuts[i + 1])
                rows.append((order << piece_bits | pieces.start + int(i), block,
                             pack(np.diff(keys[part], prepend=edges[i])), pack(counts[part])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(column, type=field.type) for column, field in zip(
                    zip(*rows, strict=True), _PIECES_ARROW, strict=True)], schema=_PIECES_ARROW)


def sum_piece(bits: int):
    """The counts of equal hashes of all blocks, summed; ``bits`` of a hash vary within a piece."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        hashes = [np.cumsum(unpack(cell.as_buffer())) for cell in rows.column("hashes")]
        counts = np.concatenate([unpack(cell.as_buffer()) for cell in rows.column("counts")]).astype(np.int64)
        ends = np.cumsum([len(part) for part in hashes])
        at, first, _ = grouped(np.concatenate(hashes), bits)
        sums = np.empty(len(at), dtype=np.int64)
        sums[at] = np.repeat(_summed(counts[at], first), np.diff(first, append=len(at)))
        return pa.table([rows.column("block").combine_chunks(), rows.column("piece").combine_chunks(),
                         pa.array(map(pack, np.split(sums, ends[:-1])), pa.binary())], schema=_SUMS_ARROW)

    return run


def _of_others(tokens: Tokens, hashes: np.ndarray, bits: int, piece_bits: int, kind: type, sums) -> np.ndarray:
    """For each token how often its hash occurs in other documents that are learned from.

    ``sums`` gives the counts of all documents: of the hashes in some pieces, in ascending
    order, of which it is told the number of a token of each.
    """
    result = np.empty(tokens.size, dtype=kind)
    for pieces, places in tokens.ranges(hashes, bits, piece_bits):
        at, first, _ = grouped(hashes[places], bits)
        at = places[at]
        doc = tokens.doc[at]
        begins = np.zeros(len(at), dtype=bool)
        begins[first] = True
        entry = np.cumsum(begins, dtype=np.int32)
        begins[1:] |= doc[1:] != doc[:-1]
        runs = np.flatnonzero(begins)
        lengths = np.diff(runs, append=len(at))
        found = sums(pieces, tokens.numbers[2 + at[first]])
        if len(found) != len(first):
            raise ValueError("the counts of a block's contexts do not fit the block")
        result[at] = np.repeat(found[entry[runs] - 1] - lengths * tokens.learned[doc[runs]], lengths)
    return result


def counts_of_others(tokens: Tokens, pieces: pa.Table, counts: np.ndarray, documents: int, bits: int,
                     piece_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order and token: how often other learning documents have its context, and the token after it.

    ``counts`` are those of the block's words, ``documents`` the number of learning documents.
    """
    row_of = {piece: row for row, piece in enumerate(pieces.column("piece").to_pylist())}
    counts = np.append(counts, documents)
    kind = np.int32 if counts.max() < 1 << 30 else np.int64
    follow = _of_others(tokens, tokens.scattered(), 32, LEAST_PIECES.bit_length(), kind, lambda _, numbers: counts[numbers])
    for order in ORDERS:
        def sums(some: slice, numbers: np.ndarray, order: int = order) -> np.ndarray:
            rows = [row_of.get(order << piece_bits | i) for i in range(some.start, some.stop)]
            return np.concatenate([np.zeros(0, dtype=np.int64), *(
                unpack(pieces.column("sums")[row].as_buffer()).astype(np.int64) for row in rows if row is not None)])

        # A context is as frequent as it is at the token before; what stands before a text is the end of another.
        context = np.empty_like(follow)
        context[1:] = follow[:-1]
        context[tokens.starts] = documents - tokens.learned if order == 1 else 0
        del follow
        follow = _of_others(tokens, tokens.hashes(order, bits), bits, piece_bits, kind, sums)
        np.minimum(follow, context, out=follow)  # two hashes may agree
        yield context, follow
