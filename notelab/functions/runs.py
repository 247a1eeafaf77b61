"""Hashes of runs of words, as numpy over Arrow lists of word hashes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from notelab.functions.bloom import Members

_K1, _K2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _K1
    h = (h ^ (h >> np.uint64(27))) * _K2
    return h ^ (h >> np.uint64(31))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The elements of all lists and where each list ends; null lists are empty."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _runs(words: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """Number of words n and the hash of the n words from each place on, as if all
    lists were one."""
    h = _mix(words)
    for n in range(1, min(longest, len(words)) + 1):
        if n > 1:
            h = _mix(h[:-1] * _K2 + words[n - 1:])
        yield n, h


def whole_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each list of word hashes (the only column) as one run: ``h``."""
    for batch in batches:
        flat, ends = _lists(batch.column(0))
        sizes, out = np.diff(ends), np.zeros(batch.num_rows, np.uint64)
        for n, h in _runs(flat, int(sizes.max(initial=0))):
            own = np.flatnonzero(sizes == n)
            out[own] = h[ends[own]]
        yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64))], names=["h"])


def likely_runs(members: Members, sizes: Sequence[int]):
    """From rows ``note, words (array<struct<start, m>>), hashes`` the runs, of a number
    of words in ``sizes``, that ``members`` may have: ``_note, s, e, _folded``."""
    wanted = frozenset(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, ends = _lists(batch.column(2))
            owner = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            left = ends[1:][owner] - np.arange(len(flat))
            words = batch.column(1).flatten()
            start, m = words.field("start").to_numpy(zero_copy_only=False), words.field("m")
            for n, h in _runs(flat, max(wanted)):
                if n not in wanted:
                    continue
                at = np.flatnonzero(left[: len(h)] >= n)
                at = at[members.may_have(h[at].view(np.int64))]
                last = at + n - 1
                size = pc.binary_length(m.take(pa.array(last))).to_numpy(zero_copy_only=False)
                own = m.take(pa.array((at[:, None] + np.arange(n)).ravel()))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * n), own)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner[at])), pa.array(start[at].astype(np.int32)),
                     pa.array((start[last] + size).astype(np.int32)), pc.binary_join(lists, " ")], names=["_note", "s", "e", "_folded"])

    return run
