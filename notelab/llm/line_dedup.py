"""Line deduplication with two Bloom filters.

Every line has a key: the line without leading and trailing white space
(``[\\x20\\x09-\\x0D]``), A-Z lower-cased.  Keys of at least ``min_chars`` code
points that occur in at least ``min_docs`` documents lose all their lines
except in the document with the largest id.

1. One Arrow pass turns each document into the 128-bit digests of its distinct
   eligible keys; this narrow table is written to the shared folder.
2. The 64-bit halves, made distinct per batch, are dealt to segments.  Each
   segment streams them through its pair of filters: a hash already in
   ``once`` enters ``twice``.  ``once`` never leaves its task.
3. ``twice`` is broadcast.  Its size is set by the number of keys and bounded
   by ``filter_bytes``; beyond that only more unique lines are suspected.
4. Digests that hit ``twice`` - and no others - shuffle for the exact count of
   documents and the choice of the document that keeps the line.  Counting is
   partial before the shuffle; the join back splits under skew (AQE).

No step collects lines; a key held by a third of all documents arrives at its
segment once per batch.

Edge cases: a null text is one empty line; documents with the same id count
once; a null id never keeps a line and does not count as a document; if only
null ids hold a key, nothing is dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notelab.llm.bloom import KEY_BITS, SEGMENT_BITS, Bloom
from notelab.llm.common import fresh_name, written

BLANK = b" \t\n\x0b\x0c\r"


def line_digest(line: bytes, min_chars: int) -> bytes | None:
    """Digest of a line's key, None if the key is too short."""
    key = line.strip(BLANK).lower()  # bytes.lower() changes A-Z only
    if len(key) < min_chars or (not key.isascii() and len(key.decode()) < min_chars):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def _keys_per_document(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, found = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                if not text:
                    continue
                own = {line_digest(x, min_chars) for x in text.encode().split(b"\n")} - {None}
                if own:
                    ids.append(doc_id)
                    sizes.append(len(own))
                    found += own
            halves = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
            offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(halves[:, 0].copy())),
                 pa.ListArray.from_arrays(offsets, pa.array(halves[:, 1].copy()))],
                names=["doc_id", "lo", "hi"])

    return run


def _distinct_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes once per batch, with a mark for those of several documents."""
    for batch in batches:
        h, n = np.unique(batch.column(0).flatten().to_numpy(zero_copy_only=False), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n > 1)], names=["h", "again"])


def _twice_seen(segments: int, twice_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, tuple[Bloom, Bloom]] = {}
        for batch in batches:
            h, again = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            segment = h % segments
            for s in np.unique(segment).tolist():
                once, twice = filters.setdefault(s, (Bloom(SEGMENT_BITS), Bloom(twice_bits)))
                own = segment == s
                u, at, n = np.unique(h[own], return_inverse=True, return_counts=True)
                marked = np.zeros(len(u), bool)
                np.logical_or.at(marked, at, again[own])
                twice.add(u[marked | (n > 1) | once.has(u)])
                once.add(u)
        for s, (_, twice) in filters.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int64()), pa.array([twice.words.tobytes()], pa.binary())], names=["segment", "bits"])

    return run


def _suspects(broadcast, segments: int, twice_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = {s: Bloom(twice_bits, b) for s, b in broadcast.value.items()}
        for batch in batches:
            lo, hi = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (1, 2))
            owner = np.repeat(np.arange(batch.num_rows), batch.column(1).value_lengths().to_numpy(zero_copy_only=False))
            hit = np.zeros(len(lo), bool)
            segment = lo % segments
            for s in np.unique(segment).tolist():
                if s in twice:
                    own = np.flatnonzero(segment == s)
                    hit[own] = twice[s].has(lo[own])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner[hit])), pa.array(lo[hit]), pa.array(hi[hit])],
                names=["doc_id", "lo", "hi"])

    return run


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
                   min_docs: int = 5, filter_bytes: int = 64 << 20) -> DataFrame:
    """One row per document that loses lines: doc_id and ``lost``, the digests
    (lo, hi) of the keys it loses."""
    spark = docs.sparkSession
    keys = written(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        .mapInArrow(_keys_per_document(min_chars), "doc_id long, lo array<long>, hi array<long>"), "line-keys")
    n_keys = keys.agg(F.sum(F.size("lo"))).first()[0] or 0
    segments = max(1, -(-n_keys * KEY_BITS // SEGMENT_BITS))
    twice_bits = max(8, min(SEGMENT_BITS, filter_bytes * 8 // segments) // 8 * 8)
    filters = (
        keys.select("lo").mapInArrow(_distinct_hashes, "h long, again boolean")
        .repartition(F.pmod("h", F.lit(segments)))
        .mapInArrow(_twice_seen(segments, twice_bits), "segment long, bits binary"))
    # at most filter_bytes (or one byte a segment) in all
    twice = spark.sparkContext.broadcast({r.segment: bytes(r.bits) for r in filters.toLocalIterator()})
    suspects = written(keys.mapInArrow(_suspects(twice, segments, twice_bits), "doc_id long, lo long, hi long"),
                       "line-suspects")
    # written, so that the join deals both sides anew and can split a hot key
    confirmed = written(
        suspects.groupBy("lo", "hi").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("keeper"))
        .filter(F.col("n") >= min_docs), "line-confirmed")
    return (
        suspects.join(confirmed, ["lo", "hi"]).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id").agg(F.collect_set(F.struct("lo", "hi")).alias("lost")))


def _drop_lines(text_at: int, lost_at: int, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, lost in zip(batch.column(text_at), batch.column(lost_at), strict=True):
                text, lost = text.as_py(), lost.as_py()
                lines = (text or "").split("\n")
                kept = lines
                if lost:
                    gone = {np.array([x["lo"], x["hi"]], np.int64).tobytes() for x in lost}
                    kept = [x for x in lines if line_digest(x.encode(), min_chars) not in gone]
                texts.append(text if len(kept) == len(lines) else "\n".join(kept))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            columns = [c for i, c in enumerate(batch.columns) if i not in (text_at, lost_at)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                names=[f"c{i}" for i in range(len(columns) + 3)])

    return run


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
                min_docs: int = 5, filter_bytes: int = 64 << 20, counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text_col``; the other
    columns as they are.  ``counts`` names two columns to add: lines before,
    lines dropped.  A null text stays null."""
    lost = repeated_lines(docs, id_col, text_col, min_chars, min_docs, filter_bytes)
    key, gone = fresh_name(docs, "lost_id"), fresh_name(docs, "lost")
    lost = lost.select(F.col("doc_id").alias(key), F.col("lost").alias(gone))
    rest = [c for c in docs.columns if c != text_col]
    joined = docs.join(lost, F.col(id_col).cast("long").eqNullSafe(F.col(key)), "left").select(*rest, text_col, gone)
    types = dict(docs.dtypes)
    schema = ", ".join([*(f"c{i} {types[c]}" for i, c in enumerate(rest)),
                        f"c{len(rest)} string, c{len(rest) + 1} long, c{len(rest) + 2} long"])
    out = joined.mapInArrow(_drop_lines(len(rest), len(rest) + 1, min_chars), schema)
    n_lines, n_dropped = counts or ("n_lines", "n_dropped")
    out = out.toDF(*rest, text_col, *([n_lines, n_dropped] if counts else ["#lines", "#dropped"]))
    return out.select(*docs.columns, *(counts or ()))
