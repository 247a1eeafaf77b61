"""Words, lines and shingles of whole texts as numpy arrays.

The Arrow text column of a batch is one byte buffer; every helper works on a
slice of that buffer (``Slab``) that holds whole texts.  All classes used by
the operators (white space, ASCII letters, everything above 0x7F) can be told
from single UTF-8 bytes, so no text is decoded and no Python loop runs over
characters or words.  Hashes are 64-bit polynomial hashes, mixed at the end;
two different words, lines or shingles agree with probability about 2**-60.

Memory: a slab holds at most ``SLAB_BYTES`` of text, or one text if that is
longer; the arrays over it take about 40 bytes a byte of text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLAB_BYTES = 2 << 20

_U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C13
_INVERSE = pow(_BASE, -1, 1 << 64)

# byte classes; bytes above 0x7F are parts of non-ASCII characters
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def byte_set(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode("ascii"))] = True
    return out


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, SLAB_BYTES + 1)
            with np.errstate(over="ignore"):
                self.up = np.multiply.accumulate(np.r_[_U(1), np.full(size, _BASE, np.uint64)])
                self.down = np.multiply.accumulate(np.r_[_U(1), np.full(size, _INVERSE, np.uint64)])
        return self.up, self.down


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of a sequence of hashes (order matters)."""
    with np.errstate(over="ignore"):
        acc = np.full(len(parts[0]), len(parts), np.uint64)
        for p in parts:
            acc = mix(acc * _U(0xD6E8FEB86659FD93) + p)
    return acc


@dataclass
class Slab:
    """Bytes of some whole texts; text i is data[offsets[i]:offsets[i + 1]],
    row ``first + i`` of the batch."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def lowered(self) -> Slab:
        return Slab(LOWER[self.data], self.offsets, self.first)

    def prefix_hash(self) -> np.ndarray:
        """h with hash of data[s:e] = (h[e] - h[s]) * inverse**s."""
        up, _ = _POWERS.upto(len(self.data))
        with np.errstate(over="ignore"):
            h = np.empty(len(self.data) + 1, np.uint64)
            h[0] = 0
            np.cumsum(_BYTE[self.data] * up[: len(self.data)], out=h[1:])
        return h

    def hashes(self, h: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        _, down = _POWERS.upto(len(self.data))
        with np.errstate(over="ignore"):
            return mix((h[e] - h[s]) * down[s] + (e - s).astype(np.uint64))

    def spans(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of bytes of a class that stay within a text:
        starts, ends and, per text, the index of its first run (n + 1)."""
        m = members[self.data]
        cut = np.zeros(len(m) + 1, bool)
        cut[self.offsets] = True
        before = np.empty(len(m), bool)
        before[:1] = True
        before[1:] = ~m[:-1]
        starts = np.flatnonzero(m & (before | cut[:-1]))
        after = np.empty(len(m), bool)
        after[-1:] = True
        after[:-1] = ~m[1:]
        ends = np.flatnonzero(m & (after | cut[1:])) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lines between newlines, at least one a text: starts, ends and, per
        text, the index of its first line (n + 1)."""
        nl = np.flatnonzero(self.data == 10)
        starts = np.concatenate([self.offsets[:-1], nl + 1])
        ends = np.concatenate([nl, self.offsets[1:]])
        at = np.searchsorted(nl, self.offsets)
        text = np.searchsorted(self.offsets[1:], nl, side="right")
        order = np.lexsort((starts, np.concatenate([np.arange(self.n), text])))
        order_e = np.lexsort((ends, np.concatenate([text, np.arange(self.n)])))
        return starts[order], ends[order_e], at + np.arange(self.n + 1)


def slabs(texts: pa.Array, limit: int = SLAB_BYTES) -> Iterator[Slab]:
    """Cut a text column into slabs of whole texts; null texts are empty."""
    texts = texts.cast(pa.large_string()).fill_null("") if len(texts) else texts.cast(pa.large_string())
    if not len(texts):
        return
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64)[texts.offset: texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i, n = 0, len(texts)
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield Slab(raw[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i], i)
        i = j


def owners(first: np.ndarray) -> np.ndarray:
    """Text number of every run, from the per-text first indices."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def windows(values: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where k consecutive values of one text begin, and their
    combined hashes."""
    if len(values) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ends = np.repeat(first[1:], np.diff(first))
    pos = np.flatnonzero(np.arange(len(values)) + k <= ends)
    return pos, combine([values[pos + i] for i in range(k)])


def covered(n: int, pos: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Mask over n values of those within any [pos, pos + length)."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, pos, 1)
    np.add.at(d, pos + length, -1)
    return np.cumsum(d[:-1]) > 0


def per_text(mask_or_counts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of a value per run over the runs of each text."""
    c = np.zeros(len(mask_or_counts) + 1, np.int64)
    np.cumsum(mask_or_counts, out=c[1:])
    return c[first[1:]] - c[first[:-1]]
