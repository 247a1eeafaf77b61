"""Bloom filters over 64-bit hashes, dealt to segments of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENT_BITS = 1 << 23
KEY_BITS = 16
PROBES = 4


class Bloom:
    """Bits addressed by ``PROBES`` positions taken from a 64-bit hash."""

    def __init__(self, bits: int, words: bytes | None = None) -> None:
        self.bits = np.uint64(bits)
        self.words = np.zeros(bits // 8, np.uint8) if words is None else np.frombuffer(words, np.uint8)

    def _at(self, h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        with np.errstate(over="ignore"):
            u = h.astype(np.uint64)
            step = (u * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20) | np.uint64(1)
            for i in range(PROBES):
                p = ((u >> np.uint64(7)) + np.uint64(i) * step) % self.bits
                yield (p >> np.uint64(3)).astype(np.int64), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8)

    def add(self, h: np.ndarray) -> None:
        for byte, bit in self._at(h):
            np.bitwise_or.at(self.words, byte, bit)

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for byte, bit in self._at(h):
            out &= (self.words[byte] & bit) != 0
        return out


def segments_for(keys: int, filter_bytes: int) -> tuple[int, int]:
    """Number of segments and bits of each; all together at most ``filter_bytes``."""
    segments = max(1, -(-keys * KEY_BITS // SEGMENT_BITS))
    return segments, max(8, min(SEGMENT_BITS, filter_bytes * 8 // segments) // 8 * 8)


def _build(segments: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, Bloom] = {}
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False)
            for s in np.unique(h % segments).tolist():
                filters.setdefault(s, Bloom(bits)).add(h[h % segments == s])
        for s, f in filters.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([f.words.tobytes()], pa.binary())],
                                             names=["segment", "bits"])

    return run


class Members:
    """A filter of a DataFrame's values, broadcast.  ``may_have`` is true for
    every member and, while the bound allows, for few others."""

    def __init__(self, values: DataFrame, count: int, filter_bytes: int = 32 << 20, hashed: bool = False) -> None:
        """values: one column of distinct longs; hashed: they are hashes already,
        and ``may_have`` takes them as they are."""
        self.segments, self.bits = segments_for(count, filter_bytes)
        h = F.col(values.columns[0]) if hashed else Members.hash(values.columns[0])
        blocks = values.select(h.alias("h")).repartition(F.pmod("h", F.lit(self.segments))).mapInArrow(
            _build(self.segments, self.bits), "segment long, bits binary")
        self.sent: Broadcast = values.sparkSession.sparkContext.broadcast(
            {r.segment: bytes(r.bits) for r in blocks.toLocalIterator()})

    @staticmethod
    def hash(column):
        return F.xxhash64(F.lit(11), column)

    def may_have(self, h: np.ndarray) -> np.ndarray:
        """h: values of ``hash``."""
        out = np.zeros(len(h), bool)
        segment = h % self.segments
        for s in np.unique(segment).tolist():
            if s in self.sent.value:
                own = np.flatnonzero(segment == s)
                out[own] = Bloom(self.bits, self.sent.value[s]).has(h[own])
        return out
