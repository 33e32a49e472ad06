"""Texts as flat arrays: words and windows of many documents at once, in numpy.

Everything works on blocks of a bounded number of bytes (a longer text is a block of its
own), so a task holds a few arrays of block length whatever the table's size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once.
BLOCK_BYTES = 2 << 20

_U = np.uint64
_BASES = (_U(0x9E3779B97F4A7C15), _U(0xD1342543DE82EF95))  # odd, so they have an inverse modulo 2**64
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def byte_set(inside) -> np.ndarray:
    """A table of 256 flags from a function of the byte's value."""
    return np.array([inside(b) for b in range(256)])


#: ``[^\\x20\\x09-\\x0D]``: what white space separates.
SPACED_WORD = byte_set(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` of text with A-Z lowered, so A-Z count as well.
LETTER_WORD = byte_set(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n at least."""
    have = _powers.get(which)
    if have is None or len(have[0]) <= n:
        size = 1 << max(16, int(n).bit_length())
        base = int(_BASES[which])
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.ones(size, _U)
            p[1:] = _U(b)
            pair.append(np.multiply.accumulate(p))
        have = _powers[which] = tuple(pair)
    return have


class Sums:
    """Hashes of any run of a sequence from one prefix sum."""

    def __init__(self, values: np.ndarray, which: int = 0):
        n = len(values)
        self.up, self.down = powers(n, which)
        self.sums = np.zeros(n + 1, _U)
        np.cumsum((values.astype(_U) + _U(1)) * self.up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hash of values[start:end], which depends on the values alone."""
        return (self.sums[end] - self.sums[start]) * self.down[start]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES, rows: int = 1 << 30):
    """(first row, bytes, offsets) of runs of rows, by bytes and number; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, at, data = column.buffers()
    ends = np.frombuffer(at, np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        after = int(np.searchsorted(ends, ends[row] + limit, "right")) - 1
        after = min(max(after, row + 1), row + rows, len(column))
        yield row, data[ends[row]: ends[after]], ends[row: after + 1] - ends[row]
        row = after


class Words:
    """The words of a block: byte starts and ends, and for each document its first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
        n = len(data)
        word = inside[data]
        edge = np.zeros(n + 1, bool)  # a document begins or the block ends
        edge[offsets] = True
        before = np.zeros(n, bool)
        before[1:] = word[:-1]
        before &= ~edge[:n]
        self.start = np.flatnonzero(word & ~before)
        behind = np.zeros(n, bool)
        behind[:-1] = word[1:]
        behind &= ~edge[1:]
        self.end = np.flatnonzero(word & ~behind) + 1
        self.first = np.searchsorted(self.start, offsets)  # one more entry than documents

    def __len__(self):
        return len(self.start)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        return mix(Sums(data).of(self.start, self.end))

    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def run_ends(first: np.ndarray) -> np.ndarray:
    """For each item the end of its document, from the documents' first items."""
    return np.repeat(first[1:], np.diff(first))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """min(values[i:i + width]) for every i that has as many."""
    have, out = 1, values
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[: len(out) - (width - have)], out[width - have:])
    return out


def spans_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs that are set."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Flags of n positions: those in any of the half-open spans."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:-1]) > 0


def kept_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """data without the spans, which are sorted and disjoint."""
    keep = np.ones(len(data), bool)
    for s, e in zip(starts.tolist(), ends.tolist()):
        keep[s:e] = False
    return data[keep]


def joined_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words one after the other, a space behind each, and where each begins (one more entry)."""
    size = end - start + 1
    upto = np.zeros(len(start) + 1, np.int64)
    np.cumsum(size, out=upto[1:])
    if not len(start):
        return np.zeros(0, np.uint8), upto
    at = np.repeat(start - upto[:-1], size)
    at += np.arange(upto[-1])
    np.minimum(at, len(data) - 1, out=at)
    out = data[at]
    out[upto[1:] - 1] = 0x20
    return out, upto
