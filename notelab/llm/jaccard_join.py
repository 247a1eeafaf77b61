"""N-gram Jaccard join by T-occurrence search with DivideSkip.

A document's set holds its distinct word shingles as 64-bit hashes.  Two sets
of n and m shingles with Jaccard similarity of at least p per cent share
T = ceil(p (n + m) / (100 + p)) or more.  DivideSkip splits the inverted lists
of a document's shingles: the short ones are merged, candidates are counted,
and only what reaches the threshold that is left is probed in the long ones.

* All sets use one order of shingles, frequent ones last.  Frequent ones come
  from a bounded summary (the shingles found most often twice or more within a
  slab); a summary that misses some makes lists longer, never results wrong.
* The short lists of a document are those of its first n - ceil(p n / 100) + l
  shingles, l = 1 + n // 50.  Only these are indexed.  Two similar sets share
  at least min(l) of them, so candidates below that are dropped; all other
  lists are long and skipped by the merge.
* A shingle of a short list at place i of one set and j of the other bounds
  the overlap: what is shared before it lies in lists that hold other
  documents too (a and b such places), what comes after is at most the
  shorter rest: 1 + min(a, b) + min(n - i - 1, m - j - 1).  Pairs whose bound
  is below T never leave the join.  Near copies that differ too much to link
  have shingles of their own, come first in the order, and fail here.
* Candidates are verified by binary-probing: the shingles of one set, those of
  the skipped lists included, are looked up in the sorted set of the other.

Exact copies (equal sets) collapse to one representative first.  Then links
are found in two rounds, because a group of k near copies has k**2 / 2 links
but needs k - 1: first each document of a list against one head, the one with
the fewest shingles of its own; after connected components, all pairs of a
list that lie in different components.  Pairs inside a component cannot change the result and are the
only ones left out.

Texts never shuffle: sets are hashed again for the documents that candidates
name, found by a Bloom filter of bounded size.  Hot lists are split by AQE,
as every join's sides are dealt for that join alone.

Edge cases: null, empty and blank texts have no shingles and link to nothing;
a text of fewer words than a shingle is one shingle; ids are taken as unique
(rows that share an id share a component); rows without an id link only
through an equal set that has one, else their component is null.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notelab.llm import bytewords as bw
from notelab.llm.bloom import Members
from notelab.llm.common import fresh_name, written
from notelab.llm.components import connected_components

HOT_PER_SLAB = 1024
HOT_LEAST = 6
HOT_MOST = 300_000
HOT_BITS = 22
SLACK = 50
MERGE_PARTS = 256


def slab_sets(slab: bw.Slab, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the texts of a slab, sorted by text and
    hash, and the offsets of the texts."""
    low = slab.lowered()
    s, e, first = low.spans(bw.NOT_SPACE)
    words = low.hashes(low.prefix_hash(), s, e)
    pos, h = bw.windows(words, first, k)
    owner = [bw.owners(first)[pos]]
    hashes = [h]
    n = np.diff(first)
    for short in range(1, k):
        own = np.flatnonzero(n == short)
        hashes.append(bw.combine([words[first[own] + i] for i in range(short)]) if len(own) else np.zeros(0, np.uint64))
        owner.append(own)
    h, owner = np.concatenate(hashes), np.concatenate(owner)
    order = np.argsort(h)
    narrow = owner[order].astype(np.uint16 if slab.n < 1 << 16 else np.int64)
    order = order[np.argsort(narrow, kind="stable")]
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], np.searchsorted(owner[new], np.arange(slab.n + 1))


def _frequent(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in bw.slabs(batch.column(0)):
                h, n = np.unique(slab_sets(slab, k)[0], return_counts=True)
                many = np.flatnonzero(n > 1)
                many = many[np.argsort(-n[many], kind="stable")[:HOT_PER_SLAB]]
                yield pa.RecordBatch.from_arrays([pa.array(h[many].view(np.int64)), pa.array(n[many].astype(np.int64))],
                                                 names=["token", "n"])

    return run


def frequent_shingles(docs: DataFrame, text_col: str, k: int) -> np.ndarray:
    """At most HOT_MOST frequent shingles, the most frequent last."""
    rows = (docs.select(F.col(text_col).cast("string")).mapInArrow(_frequent(k), "token long, n long")
            .groupBy("token").agg(F.sum("n").alias("n")).filter(F.col("n") >= HOT_LEAST)
            .orderBy(F.desc("n"), "token").limit(HOT_MOST).select("token").toArrow())
    return rows["token"].to_numpy()[::-1].copy().view(np.uint64)


class Order:
    """Rank of frequent shingles; all others have rank 0."""

    def __init__(self, frequent: np.ndarray) -> None:
        order = np.argsort(frequent)
        self.tokens, self.ranks = frequent[order], order + 1
        self.seen = np.zeros(1 << HOT_BITS, bool)
        self.seen[frequent >> np.uint64(64 - HOT_BITS)] = True

    def rank(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), np.int64)
        maybe = np.flatnonzero(self.seen[h >> np.uint64(64 - HOT_BITS)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.tokens, h[maybe]), len(self.tokens) - 1)
            out[maybe] = np.where(self.tokens[at] == h[maybe], self.ranks[at], 0)
        return out


def slack(n):
    return 1 + n // SLACK


def short_lists(h: np.ndarray, offsets: np.ndarray, order: Order, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of each set in the order, and their offsets."""
    n = np.diff(offsets)
    want = np.minimum(n, n - -(-percent * n // 100) + slack(n))
    owner = np.repeat(np.arange(len(n)), n)
    rank = order.rank(h)
    rare = rank == 0
    before = np.concatenate([[0], np.cumsum(rare)])
    place = before[:-1] - before[offsets[owner]]
    n_rare = before[offsets[1:]] - before[offsets[:-1]]
    hot = np.flatnonzero(~rare)
    hot = hot[np.lexsort((rank[hot], owner[hot]))]
    hot_first = np.searchsorted(owner[hot], np.arange(len(n) + 1))
    place[hot] = n_rare[owner[hot]] + np.arange(len(hot)) - hot_first[owner[hot]]
    chosen = np.flatnonzero(place < want[owner])
    chosen = chosen[np.lexsort((place[chosen], owner[chosen]))]
    return h[chosen], np.concatenate([[0], np.cumsum(np.where(n > 0, want, 0))])


def _sets(sent, k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Order(sent.value)
        for batch in batches:
            for slab in bw.slabs(batch.column(1)):
                h, offsets = slab_sets(slab, k)
                digest = []
                with np.errstate(over="ignore"):
                    for salt in (np.uint64(0x51ED270B), np.uint64(0xB5297A4D12345679)):
                        c = np.concatenate([np.zeros(1, np.uint64), np.cumsum(bw.mix(h ^ salt) * salt)])
                        digest.append(pa.array((c[offsets[1:]] - c[offsets[:-1]]).view(np.int64)))
                tokens, at = short_lists(h, offsets, order, percent)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(slab.first, slab.n), pa.array(np.diff(offsets)), *digest,
                     pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(tokens.view(np.int64)))],
                    names=["doc_id", "n", "lo", "hi", "tokens"])

    return run


def _full_sets(members: Members, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.array(members.may_have(batch.column(1).to_numpy(zero_copy_only=False)))
            batch = batch.filter(own)
            for slab in bw.slabs(batch.column(2)):
                h, offsets = slab_sets(slab, k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(slab.first, slab.n),
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(h.view(np.int64)))],
                    names=["doc_id", "shingles"])

    return run


def needed(n, m, percent: int):
    """Least overlap of similar sets of n and m shingles."""
    return -(-percent * (n + m) // (100 + percent))


def _probe(percent: int):
    """Count the shingles of a that binary search finds in b."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = np.zeros(batch.num_rows, bool)
            columns = []
            for c in (batch.column(2), batch.column(3)):
                offsets = np.concatenate([[0], np.cumsum(c.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
                columns.append((c.flatten().to_numpy(zero_copy_only=False).view(np.uint64), offsets))
            (a, a_at), (b, b_at) = columns
            for i in range(batch.num_rows):
                x, y = a[a_at[i]: a_at[i + 1]], b[b_at[i]: b_at[i + 1]]
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                linked[i] = len(x) > 0 and int((y[at] == x).sum()) >= needed(len(x), len(y), percent)
            keep = pa.array(linked)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return run


def verified(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar.  docs: doc_id, text."""
    pairs = written(pairs, "candidates")
    named = written(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), "named")
    members = Members(named, named.count())
    sets = written(
        docs.select("doc_id", Members.hash("doc_id").alias("h"), "text").filter(F.col("doc_id").isNotNull())
        .mapInArrow(_full_sets(members, k), "doc_id long, shingles array<long>"), "sets")
    joined = (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
              .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y"))
    return joined.mapInArrow(_probe(percent), "a long, b long")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Heap-merge the short lists of each document a: rows (a, token, b, least)
    sorted by a and token, b rising within a token, all rows of a pair in one
    partition.  Candidates that occur in ``least`` lists or more."""
    def rows():
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    out: tuple[list[int], list[int]] = ([], [])
    for a, own in groupby(rows(), key=lambda r: r[0]):
        lists = [[(b, least) for _, _, b, least in x] for _, x in groupby(own, key=lambda r: r[1])]
        for (b, least), hits in groupby(heapq.merge(*lists)):
            if sum(1 for _ in hits) >= least:
                out[0].append(a)
                out[1].append(b)
        if len(out[0]) > 10000:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["a", "b"])
            out = ([], [])
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["a", "b"])


def _slack(n: Column) -> Column:
    return F.floor(n / SLACK).cast("long") + 1


def _may_reach(percent: int) -> Column:
    """Whether the sizes, and the bound by the places of a shared shingle,
    allow the overlap that similarity takes."""
    n, i, a = (F.col(f"x_{c}") for c in ("n", "i", "a"))
    m, j, b = (F.col(f"y_{c}") for c in ("n", "i", "a"))
    most = 1 + F.least(a, b) + F.least(n - i - 1, m - j - 1)
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * most >= percent * (n + m))


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 90) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (least id it reaches)."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    frequent = spark.sparkContext.broadcast(frequent_shingles(docs, "text", k))
    sets = written(docs.mapInArrow(_sets(frequent, k, percent), "doc_id long, n long, lo long, hi long, tokens array<long>"),
                   "short-lists")
    classes = written(sets.filter(F.col("n") > 0).groupBy("lo", "hi", "n").agg(F.min("doc_id").alias("rep")), "classes")
    reps = sets.join(classes.select(F.col("rep").alias("doc_id"), "lo", "hi", "n"), ["doc_id", "lo", "hi", "n"], "left_semi")
    postings = reps.select("doc_id", F.col("n").cast("int").alias("n"), F.posexplode("tokens").alias("i", "token"))
    lists = written(postings.groupBy("token").agg(F.count("*").alias("df")).filter(F.col("df") > 1).select("token"), "lists")
    # a: places before i whose lists hold other documents (a document's rows
    # are a tenth of its shingles, so the window is bounded)
    earlier = Window.partitionBy("doc_id").orderBy("i")
    postings = written(postings.join(lists, "token").withColumn("a", F.row_number().over(earlier) - 1), "postings")

    # round 1: each document of a list against its head, where they share enough
    heads = written(
        postings.groupBy("token").agg(F.min(F.struct((F.col("i") - F.col("a")).alias("own"), "doc_id", "n", "i", "a")).alias("h"))
        .select("token", *(F.col(f"h.{c}").alias(f"y_{c}") for c in ("doc_id", "n", "i", "a"))), "heads")
    x = postings.select("token", *(F.col(c).alias(f"x_{c}") for c in ("doc_id", "n", "i", "a")))
    star = (x.join(heads, "token").filter((F.col("x_doc_id") != F.col("y_doc_id")) & _may_reach(percent))
            .groupBy(F.col("x_doc_id").alias("a"), F.col("y_doc_id").alias("b"))
            .agg(F.count("*").alias("shared"), F.first(F.least("x_n", "y_n")).alias("least"))
            .filter(F.col("shared") >= _slack(F.col("least"))).select("a", "b"))
    edges = written(verified(docs, star, k, percent), "links")
    found = connected_components(edges)

    # round 2: pairs of a list in different components; x is outside the
    # largest component of the list, so lists within one component cost nothing
    place = written(postings.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
                    .select("token", "doc_id", "n", "i", "a", F.coalesce("component", "doc_id").alias("c")), "placed")
    mixed = written(
        place.groupBy("token", "c").agg(F.count("*").alias("df"))
        .groupBy("token").agg(F.count("*").alias("parts"), F.max_by("c", F.struct("df", "c")).alias("main"))
        .filter(F.col("parts") > 1).select("token", "main"), "mixed")
    place = written(place.join(mixed, "token"), "placed")
    x = place.filter(F.col("c") != F.col("main")).select("token", *(F.col(v).alias(f"x_{v}") for v in ("doc_id", "n", "i", "a", "c")))
    y = place.select("token", "main", *(F.col(v).alias(f"y_{v}") for v in ("doc_id", "n", "i", "a", "c")))
    across = x.join(y, "token").filter(
        (F.col("x_c") != F.col("y_c")) & ((F.col("y_c") == F.col("main")) | (F.col("x_doc_id") < F.col("y_doc_id")))
        & _may_reach(percent))
    across = across.select(
        F.least("x_doc_id", "y_doc_id").alias("a"), "token", F.greatest("x_doc_id", "y_doc_id").alias("b"),
        _slack(F.least("x_n", "y_n")).alias("least"))
    # a pair's rows meet in one task; the candidates of one document spread over many
    merged = (across.repartition(F.col("a"), F.pmod(F.xxhash64("b"), F.lit(MERGE_PARTS)))
              .sortWithinPartitions("a", "token", "b").mapInArrow(_merge, "a long, b long"))
    edges = edges.unionByName(verified(docs, merged, k, percent))
    found = connected_components(edges)

    classes = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "lo", "hi", "n", F.coalesce("component", "rep").alias("component_id"))
    out = sets.select("doc_id", "n", "lo", "hi").join(written(classes, "class-components"), ["lo", "hi", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 90) -> DataFrame:
    """One document of each component, that with the least id; columns as given."""
    found = components(docs, id_col, text_col, k, percent)
    key = fresh_name(docs, "removed_id")
    gone = found.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(key)).distinct()
    return docs.join(gone, F.col(id_col).cast("long") == F.col(key), "left_anti")
