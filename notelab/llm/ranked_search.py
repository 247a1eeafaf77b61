"""Ranked lexical search with geometric blocks per posting list.

A stated set of items (queries) is ranked against all documents.  A document's
impact of a term is its saturated frequency, an integer; its score for an item
is the sum of weight times impact over the item's terms.

Documents are indexed in shards.  In a shard every term has a posting list, and
each list is cut into blocks of documents that resemble one another: a list of n
documents takes about n / ``BLOCK`` of them as centres, and each goes to the
centre nearest in direction, by a random projection of the impact vectors.  A
block stores its summary, the coordinatewise maximum of its documents' impacts.
An item's product with a summary bounds the score of each document in the block
from above; a block is skipped only if that bound is below the item's tenth best
score so far.  All others are scored in full, so the ranking is exact.  Lists
whose terms cannot reach the tenth score together, by the shard's maxima, need
no blocks for that item: whoever beats it is in another of its lists.  Summaries
hold the coordinates of the items that use the list.

Distributed: texts are read once and never shuffle.  A forward index (per
document the terms of the items with their frequencies) is written, the numbers
of documents per term are counted from it, and shards are built from its
partitions, each bounded by ``SHARD_CELLS`` cells (terms x documents).  A first
pass over at most about ``seed_docs`` documents gives every item a tenth score
to start from; it changes what is skipped, never the result.  A task returns at
most ``top`` documents per item, and these are ranked in two steps, so that no
task takes all.  Items are sent in blocks of ``block_bytes`` of text; each block
is one pass.

Edge cases: null and empty texts have no terms, count in no statistic and are
never returned; an item without terms, or without a document of positive score,
gives no row; equal scores rank by id, null ids last; rows that share an id are
documents of their own; an empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from notelab.llm import bytewords as bw
from notelab.llm.common import written

BLOCK = 32
SKETCH = 16
SHARD_CELLS = 1 << 24
SHARD_DOCS = 4096
UNIT = 1_000_000_000
SALTS = 64
FORWARD = "doc_id long, n long, terms array<int>, tf array<int>"
FOUND = "item long, doc_id long, score long"


def slab_terms(slab: bw.Slab) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of a slab's texts and, per text, the index of its
    first term."""
    low = slab.lowered()
    s, e, first = low.spans(bw.ALNUM)
    return low.hashes(low.prefix_hash(), s, e), first


@dataclass
class Items:
    """A block of items: the distinct terms (sorted hashes) and, per item, its
    terms (indices) and how often it has them."""

    vocabulary: np.ndarray
    terms: list[np.ndarray]
    repeats: list[np.ndarray]

    @classmethod
    def of(cls, texts: list[str]) -> Items:
        each = []
        for slab in bw.slabs(pa.array(texts, pa.large_string())):
            h, first = slab_terms(slab)
            each += [np.unique(h[a:b], return_counts=True) for a, b in zip(first[:-1], first[1:], strict=True)]
        vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *(h for h, _ in each)]))
        return cls(vocabulary, [np.searchsorted(vocabulary, h) for h, _ in each], [n.astype(np.int64) for _, n in each])


@dataclass
class Model:
    """Items with the statistics of the corpus."""

    items: Items
    weight: np.ndarray  # per term
    n_docs: int
    n_terms: int
    least: np.ndarray  # per item, the score to reach
    top: int
    factors: list[np.ndarray] = field(default_factory=list)  # per item and term, repeats x weight

    def __post_init__(self) -> None:
        self.factors = [r * self.weight[t] for t, r in zip(self.items.terms, self.items.repeats, strict=True)]

    def impact(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        if len(n) and 75 * int(n.max()) * self.n_docs >= 1 << 63:
            length = np.array([75 * int(x) * self.n_docs // self.n_terms for x in n], np.int64)
        else:
            length = 75 * n * self.n_docs // self.n_terms
        return UNIT * tf // (1000 * tf + 8 * (25 + length))


def _forward(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value.vocabulary
        size = np.int64(max(len(vocabulary), 1))
        for batch in batches:
            for slab in bw.slabs(batch.column(1)):
                h, first = slab_terms(slab)
                at = np.minimum(np.searchsorted(vocabulary, h), size - 1)
                own = np.flatnonzero(vocabulary[at] == h) if len(vocabulary) else np.zeros(0, np.int64)
                cells, tf = np.unique(bw.owners(first)[own] * size + at[own], return_counts=True)
                offsets = pa.array(np.searchsorted(cells // size, np.arange(slab.n + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(slab.first, slab.n), pa.array(np.diff(first).astype(np.int64)),
                     pa.ListArray.from_arrays(offsets, pa.array((cells % size).astype(np.int32))),
                     pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int32)))], names=["doc_id", "n", "terms", "tf"])

    return run


@dataclass
class Blocks:
    """A posting list in blocks: its documents block by block, where the blocks
    begin, and per coordinate (a term) and block the largest impact."""

    docs: np.ndarray
    starts: np.ndarray
    coordinates: np.ndarray
    summary: np.ndarray


class Shard:
    """Impacts of some documents (terms x documents) and their blocks."""

    def __init__(self, impacts: np.ndarray) -> None:
        self.impacts = impacts
        self.most = impacts.max(axis=1, initial=0)
        direction = np.random.default_rng(SKETCH).standard_normal((SKETCH, len(impacts)), np.float32) @ impacts
        self.sketch = (direction / np.maximum(np.linalg.norm(direction, axis=0), 1e-6)).T

    def blocks(self, term: int, coordinates: np.ndarray) -> Blocks:
        docs = np.flatnonzero(self.impacts[term])
        centres = docs[:: BLOCK]
        nearest = (self.sketch[docs] @ self.sketch[centres].T).argmax(axis=1)
        docs = docs[np.argsort(nearest, kind="stable")]
        starts = np.searchsorted(np.sort(nearest), np.unique(nearest))
        rows = self.impacts[np.ix_(coordinates, docs)]
        return Blocks(docs, starts, coordinates, np.maximum.reduceat(rows, starts, axis=1))


class Best:
    """The best documents so far of every item of a model."""

    def __init__(self, model: Model) -> None:
        self.model = model
        n = len(model.items.terms)
        self.least = model.least.copy()
        self.score = [np.zeros(0, np.int64)] * n
        self.doc = [np.zeros(0, np.int64)] * n
        self.null = [np.zeros(0, bool)] * n

    def offer(self, item: int, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        good = score >= self.least[item]
        score, doc, null = (np.concatenate([a[item], b[good]]) for a, b in ((self.score, score), (self.doc, doc), (self.null, null)))
        order = np.lexsort((doc, null, -score))[: self.model.top]
        self.score[item], self.doc[item], self.null[item] = score[order], doc[order], null[order]
        if len(order) == self.model.top:
            self.least[item] = max(self.least[item], score[order[-1]])

    def batch(self) -> pa.RecordBatch:
        size = [len(x) for x in self.score]
        item = np.repeat(np.arange(len(size)), size)
        none = np.zeros(0, np.int64)
        doc = pa.array(np.concatenate([none, *self.doc]), mask=np.concatenate([none.astype(bool), *self.null]))
        return pa.RecordBatch.from_arrays([pa.array(item), doc, pa.array(np.concatenate([none, *self.score]))],
                                          names=["item", "doc_id", "score"])


def search_shard(shard: Shard, best: Best, doc: np.ndarray, null: np.ndarray) -> int:
    """Rank the documents of a shard; the number of blocks that were skipped."""
    model, skipped = best.model, 0
    users: dict[int, list[int]] = {}
    for item, (terms, factor) in enumerate(zip(model.items.terms, model.factors, strict=True)):
        most = factor * shard.most[terms].astype(np.int64)
        order = np.argsort(most, kind="stable")
        for t in terms[order[np.cumsum(most[order]) >= best.least[item]]].tolist():
            if shard.most[t]:
                users.setdefault(t, []).append(item)
    candidates: dict[int, list[np.ndarray]] = {}
    place = np.zeros(len(shard.impacts), np.int64)
    for t, items in users.items():
        coordinates = np.unique(np.concatenate([model.items.terms[i] for i in items]))
        blocks = shard.blocks(t, coordinates)
        place[coordinates] = np.arange(len(coordinates))
        factors = np.zeros((len(items), len(coordinates)))
        for row, i in enumerate(items):
            factors[row, place[model.items.terms[i]]] = model.factors[i]
        # a little more than the bound, for the rounding of doubles
        bounds = (factors @ blocks.summary.astype(np.float64)) * (1 + 1e-9)
        ends = np.append(blocks.starts[1:], len(blocks.docs))
        for row, i in enumerate(items):
            open_ = bounds[row] >= best.least[i]
            skipped += len(open_) - int(open_.sum())
            if open_.any():
                mask = np.repeat(open_, ends - blocks.starts)
                candidates.setdefault(i, []).append(blocks.docs[mask])
    for i, found in candidates.items():
        docs = np.unique(np.concatenate(found))
        impacts = shard.impacts[np.ix_(model.items.terms[i], docs)].astype(np.int64)
        best.offer(i, (model.factors[i][:, None] * impacts).sum(axis=0), doc[docs], null[docs])
    return skipped


def _search(sent):
    def shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
        """The rows in tables of ``most`` documents at most."""
        held, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                if n and n + part.num_rows > most:
                    yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    held, n = [], 0
                held.append(part)
                n += part.num_rows
        if n:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        size = len(model.items.vocabulary)
        best = Best(model)
        for batch in shards(batches, max(1, min(SHARD_DOCS, SHARD_CELLS // max(size, 1)))):
            length = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            terms, tf = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in (2, 3))
            owner = np.repeat(np.arange(batch.num_rows), length)
            impacts = np.zeros((size, batch.num_rows), np.float32)  # whole numbers up to 1,000,000
            impacts[terms, owner] = model.impact(tf.astype(np.int64), batch.column(1).to_numpy()[owner])
            ids = batch.column(0)
            search_shard(Shard(impacts), best, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))
        yield best.batch()

    return run


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[tuple[list[int], list[str]]]:
    """items: item, text.  Their rows in blocks of bounded size."""
    block: tuple[list[int], list[str]] = ([], [])
    size = 0
    for item, text in items.toLocalIterator():
        if block[0] and size + len(text.encode()) > block_bytes:
            yield block
            block, size = ([], []), 0
        block[0].append(item)
        block[1].append(text)
        size += len(text.encode())
    if block[0]:
        yield block


def _best(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` best rows per item with their rank; in two steps, the first
    over parts of an item's rows."""
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    part = Window.partitionBy("item", "salt").orderBy(*order)
    found = (found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
             .withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= top).drop("salt", "rank"))
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= top)


def _ranked(spark: SparkSession, docs: DataFrame, texts: list[str], top: int, seed_docs: int) -> DataFrame:
    """item (index in ``texts``), doc_id, score, rank."""
    items = Items.of(texts)
    sent = spark.sparkContext.broadcast(items)
    forward = written(docs.mapInArrow(_forward(sent), FORWARD).filter("n > 0"), "forward")
    n_docs, n_terms = forward.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = forward.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
    df = np.zeros(len(items.vocabulary), np.int64)  # bounded by the block's terms
    df[held["term"].to_numpy()] = held["df"].to_numpy()
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    model = Model(items, weight, n_docs, max(n_terms, 1), np.ones(len(texts), np.int64), top)
    forward = forward.filter(F.size("terms") > 0)
    share = max(8, -(-n_docs // max(seed_docs, 1)))
    seeds = forward.filter(F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(share)) == 0)
    seeds = _best(seeds.mapInArrow(_search(spark.sparkContext.broadcast(model)), FOUND), top)
    for row in seeds.filter(F.col("rank") == top).select("item", "score").toLocalIterator():  # one row an item
        model.least[row.item] = max(model.least[row.item], row.score)
    return _best(forward.mapInArrow(_search(spark.sparkContext.broadcast(model)), FOUND), top)


def search(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", top: int = 10, block_bytes: int = 256 << 10, seed_docs: int = 8192) -> DataFrame:
    """The ``top`` documents of each row of ``queries`` with a score above 0:
    item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    named = written(queries.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").cast("string").alias("text"))
                    .filter(F.col("text").isNotNull()).withColumn("item", F.monotonically_increasing_id()), "items")
    out = None
    for numbers, texts in _blocks(named.select("item", "text"), block_bytes):
        # the block's items, in the order of their index
        index = spark.createDataFrame(list(enumerate(numbers)), "at long, number long")
        found = _ranked(spark, docs, texts, top, seed_docs)
        found = found.join(index, found["item"] == index["at"]).select(F.col("number").alias("item"), "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], "item long, rank int, doc_id long, score long")
    return out.join(named.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
