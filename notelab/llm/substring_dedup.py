"""Substring deduplication by content-defined chunking.

A gear hash rolls over the bytes of a text (h = 2 h + G[byte], of which the
tested bits depend on the last ``WINDOW`` bytes).  By ``local`` cuts (``local_cuts``) the hash begins
anew with every word, and a chunk ends after the word of the least hash (the last
of equals) of any ``MAX_WORDS`` words in a row.  Such a cut depends on the words
around it only, so an insertion moves no cut beyond its neighbourhood, and a
passage is cut alike wherever it stands.

Without ``local`` a chunk ends at a word's end where ``CUT_BITS`` bits of the hash
are zero, unless another such place lies less than ``MIN_WORDS`` words before, and
after ``MAX_WORDS`` words in any case; these forced cuts depend on the text before,
so that the head of a passage, and now and then a whole one, is cut otherwise in
another document.

Chunks are compared by digest over the whole table.  Every occurrence but the
first (least doc_id, then place) is a repeat, and runs of consecutive repeats of
at least ``min_words`` words are taken out; shorter ones stay, since a few words
in a row are no passage.  By local cuts a passage of w words has at least
w - 2 MAX_WORDS + 1 words in whole chunks (the first and the last window inside it
hold cuts, and what windows across its ends add lies outside of these two), so
passages of 47 words or more are found wherever they stand.

Distributed: chunk digests (8 bytes each) are written to the shared folder and
counted with a partial aggregate.  Those found twice or more go into a Bloom
filter of bounded size; only what it lets through shuffles again, for the exact
choice of the first occurrence.  A digest that a third of all chunks share is
one row a task in the aggregates; the join back splits under skew (AQE).  Texts
shuffle once, to meet the repeats they lose.

Edge cases: null and empty texts have no chunks and stay as they are; ids are
taken as unique (rows that share an id share their first occurrences); rows
without an id count as one document before all others; repeats within one text
are taken out like those across texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notelab.llm import bytewords as bw
from notelab.llm.bloom import Members
from notelab.llm.common import fresh_name, written

WINDOW = 16
CUT_BITS = 3
MIN_WORDS = 4
MAX_WORDS = 16
GEAR = np.random.default_rng(16).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear_hash(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The rolling hash at every byte, over the last WINDOW bytes of the same
    text: sums over 1, 2, 4, ... bytes, each from two of the half length."""
    inside = np.arange(len(data), dtype=np.int64) - np.repeat(offsets[:-1], np.diff(offsets))
    h = GEAR[data]
    k = 1
    while k < WINDOW:
        more = np.zeros_like(h)
        more[k:] = h[:-k] << np.uint32(k)
        more[inside < k] = 0
        h = h + more
        k *= 2
    return h


def local_cuts(slab: bw.Slab, s: np.ndarray, e: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mask of the words that are the least, by hash, of MAX_WORDS words in a row
    of their text; of equal ones the last."""
    h = gear_hash(slab.data, np.concatenate([[0], s, [len(slab.data)]]))[e - 1]
    least = (h.astype(np.uint64) << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(len(s), dtype=np.uint64))
    k = 1
    while k < MAX_WORDS:
        step = min(k, MAX_WORDS - k)
        least = np.minimum(least[:-step], least[step:])  # of 2, 4, ... words
        k += step
    inside = np.arange(len(least)) + MAX_WORDS <= np.repeat(first[1:], np.diff(first))[: len(least)]
    cut = np.zeros(len(s), bool)
    cut[(np.uint64(0xFFFFFFFF) - (least[inside] & np.uint64(0xFFFFFFFF))).astype(np.int64)] = True
    return cut


def chunk_spans(slab: bw.Slab, local: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Chunks of the texts of a slab: first byte, end, number of words and, per
    text, the index of its first chunk (n + 1)."""
    s, e, first = slab.spans(bw.NOT_SPACE)
    if not len(s):
        return s, e, s, np.zeros(slab.n + 1, np.int64)
    if local:
        cut = local_cuts(slab, s, e, first)
    else:
        h = gear_hash(slab.data, slab.offsets)
        zero = (h[e - 1] >> np.uint32(WINDOW - CUT_BITS)) & np.uint32((1 << CUT_BITS) - 1) == 0
        near = np.zeros(len(s), bool)
        text = bw.owners(first)
        for k in range(1, MIN_WORDS):
            near[k:] |= zero[:-k] & (text[k:] == text[:-k])
        cut = zero & ~near
    cut[first[1:][np.diff(first) > 0] - 1] = True  # a text's last word ends a chunk
    if not local:
        begins = np.concatenate([[0], np.flatnonzero(cut)[:-1] + 1])
        place = np.arange(len(s)) - np.repeat(begins, np.diff(np.append(begins, len(s))))
        cut |= place % MAX_WORDS == MAX_WORDS - 1
    last = np.flatnonzero(cut)
    begins = np.concatenate([[0], last[:-1] + 1])
    return s[begins], e[last], last - begins + 1, np.searchsorted(begins, first)


def _chunks(local: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in bw.slabs(batch.column(1)):
                s, e, n, first = chunk_spans(slab, local)
                digest = slab.hashes(slab.prefix_hash(), s, e)
                at = pa.array(first.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(slab.first, slab.n),
                     pa.ListArray.from_arrays(at, pa.array(digest.view(np.int64))),
                     pa.ListArray.from_arrays(at, pa.array(n.astype(np.int16)))], names=["doc_id", "digests", "words"])

    return run


def _occurrences(members: Members):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, length = batch.column(1).flatten(), batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], np.cumsum(length)])
            owner = np.repeat(np.arange(batch.num_rows), length)
            hit = np.flatnonzero(members.may_have(h.to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner[hit])), pa.array((hit - first[owner[hit]]).astype(np.int32)),
                 batch.column(2).flatten().take(pa.array(hit)), h.take(pa.array(hit))], names=["doc_id", "i", "words", "h"])

    return run


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bytes: int = 64 << 20,
            local: bool = False) -> DataFrame:
    """Per document with repeated chunks: doc_id and ``later``, the (i, words)
    of its chunks that are not the first occurrence, by i."""
    chunks = written(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        .mapInArrow(_chunks(local), "doc_id long, digests array<long>, words array<short>"), "chunks")
    twice = written(chunks.select(F.explode("digests").alias("h")).groupBy("h").agg(F.count("*").alias("n"))
                    .filter(F.col("n") > 1).select("h"), "twice")
    members = Members(twice, twice.count(), filter_bytes, hashed=True)
    found = written(chunks.mapInArrow(_occurrences(members), "doc_id long, i int, words short, h long"), "occurrences")
    firsts = written(
        found.groupBy("h").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "i")).alias("first"))
        .filter(F.col("n") > 1).select("h", F.col("first.doc_id").alias("first_id"), F.col("first.i").alias("first_i")), "firsts")
    later = found.join(firsts, "h").filter(
        ~(F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("i") == F.col("first_i"))))
    return later.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("i", "words"))).alias("later"))


def runs(later: list[tuple[int, int]], min_words: int) -> list[tuple[int, int]]:
    """First and last chunk of the runs of ``min_words`` words or more."""
    out: list[tuple[int, int]] = []
    begin, last, total = 0, -2, 0
    for i, words in [*later, (-9, 0)]:
        if i != last + 1:
            if total >= min_words:
                out.append((begin, last))
            begin, total = i, 0
        last, total = i, total + words
    return out


def _cut_out(text_at: int, later_at: int, min_words: int, local: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, later = batch.column(text_at), batch.column(later_at)
            texts, spans = [], []
            for i in range(batch.num_rows):
                found = runs([(x["i"], x["words"]) for x in later[i].as_py() or []], min_words)
                if not found:
                    texts.append(column[i].as_py())
                    spans.append([])
                    continue
                slab = next(bw.slabs(column.slice(i, 1)))
                s, e, n, _ = chunk_spans(slab, local)
                keep = np.ones(len(slab.data), bool)
                before = np.cumsum(np.concatenate([[0], (slab.data & 0xC0) != 0x80]))  # code points
                own = []
                for a, b in found:
                    # up to where the next word begins, so that words stay apart
                    keep[s[a]: s[b + 1] if b + 1 < len(s) else e[b]] = False
                    own.append({"start": int(before[s[a]]), "end": int(before[e[b]]), "words": int(n[a: b + 1].sum())})
                texts.append(slab.data[keep].tobytes().decode())
                spans.append(own)
            rest = [c for k, c in enumerate(batch.columns) if k not in (text_at, later_at)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.string()), pa.array(spans, SPANS)],
                                             names=[f"c{k}" for k in range(len(rest) + 2)])

    return run


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("words", pa.int64())]))


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 16,
                   spans: str | None = None, filter_bytes: int = 64 << 20, local: bool = False) -> DataFrame:
    """``docs`` without repeated passages in ``text_col``; the other columns as
    they are.  ``spans`` names a column to add: start, end (code points of the
    text before) and words of what was taken out.  ``local`` takes local cuts."""
    later = repeats(docs, id_col, text_col, filter_bytes, local)
    key, gone = fresh_name(docs, "repeat_id"), fresh_name(docs, "later")
    later = later.select(F.col("doc_id").alias(key), F.col("later").alias(gone))
    rest = [c for c in docs.columns if c != text_col]
    joined = docs.join(later, F.col(id_col).cast("long").eqNullSafe(F.col(key)), "left").select(*rest, text_col, gone)
    types = dict(docs.dtypes)
    schema = ", ".join([*(f"c{i} {types[c]}" for i, c in enumerate(rest)), f"c{len(rest)} string",
                        f"c{len(rest) + 1} array<struct<start: long, end: long, words: long>>"])
    out = joined.mapInArrow(_cut_out(len(rest), len(rest) + 1, min_words, local), schema)
    out = out.toDF(*rest, text_col, spans or "#spans")
    return out.select(*docs.columns, *([spans] if spans else []))
