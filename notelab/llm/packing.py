"""Best-fit packing with a grouping genetic algorithm.

Documents become token ids plus a closing id 0; those longer than a sequence
are cut into pieces of full length, of which the first may be shorter.  The
narrow table of pieces (no ids) is written to the shared folder.  Full pieces
fill a sequence each.  The others are dealt at random to blocks of about
``block_pieces``; a block is one packing problem of bounded size, at any scale.

Each block is solved on several islands, rows of a DataFrame that Spark spreads
over tasks.  A member of an island's population is a list of bins.  Crossover
injects whole well-filled bins of one parent into the other, drops the bins
there that hold the same pieces, and puts the displaced pieces back by best
fit, longest first; mutation dissolves the emptiest bins likewise.  After every
epoch the best member of each island moves on to the next island of its block
(a join on block and island), and after the last the best of all islands wins.

Randomness is seeded per block, island and epoch, so lost tasks give the same
result again.  Open sequences at the end: at most one a block beyond what the
bins need, so the loss from blocks is about ``max_tokens`` in ``block_pieces``
pieces.

Edge cases: a null or empty text is the single id 0; repeated rows are packed
each for itself; an empty table gives no pieces.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notelab.llm import bytewords as bw
from notelab.llm.bpe import Encoder
from notelab.llm.common import written

END_ID = 0


def cut(n: int, max_tokens: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of n tokens."""
    pieces = -(-n // max_tokens)
    head = n - (pieces - 1) * max_tokens
    return [(0, head)] + [(head + i * max_tokens, max_tokens) for i in range(pieces - 1)]


def _pieces(json_path: str, ranks_path: str | None, max_tokens: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(json_path, ranks_path)
        for batch in batches:
            for slab in bw.slabs(batch.column(1)):
                ids, offsets = encoder.slab_ids(slab)
                rows, out = [], []
                for i in range(slab.n):
                    own = np.append(ids[offsets[i]: offsets[i + 1]], np.uint32(END_ID)).astype("<u4")
                    for k, (start, length) in enumerate(cut(len(own), max_tokens)):
                        part = own[start: start + length]
                        rows.append((slab.first + i, k, start, length, zlib.crc32(part.tobytes())))
                        if with_ids:
                            out.append(part.astype(np.int32))
                row, piece, start, length, crc = (pa.array(x, pa.int64()) for x in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), piece, start, length, crc, *([pa.array(out, pa.list_(pa.int32()))] if with_ids else [])],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])])

    return run


def token_pieces(docs: DataFrame, json_path: str, ranks_path: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", max_tokens: int = 2048, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 and, if asked, ids."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = f"doc_id {dict(narrow.dtypes)['doc_id']}, piece long, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return narrow.mapInArrow(_pieces(json_path, ranks_path, max_tokens, with_ids), schema)


Bins = list[list[int]]


def best_fit(bins: Bins, items: list[int], size: list[int], room: int) -> Bins:
    """Put items, in the order given, into the fullest bin that takes them."""
    bins = [list(b) for b in bins]
    free = sorted((room - sum(size[i] for i in b), k) for k, b in enumerate(bins))
    for i in items:
        at = bisect_left(free, (size[i], -1))
        if at < len(free):
            left, k = free.pop(at)
            bins[k].append(i)
        else:
            left, k = room, len(bins)
            bins.append([i])
        if left > size[i]:
            insort(free, (left - size[i], k))
    return bins


def fitness(bins: Bins, size: list[int], room: int) -> tuple[int, float]:
    """Smaller is better: number of bins, then bins as uneven as can be."""
    return len(bins), -sum((sum(size[i] for i in b) / room) ** 2 for b in bins)


def crossover(mother: Bins, father: Bins, size: list[int], room: int, rng: random.Random) -> Bins:
    """Whole well-filled bins of the mother into the father."""
    full = sorted(mother, key=lambda b: sum(size[i] for i in b), reverse=True)
    share = full[: max(1, int(len(full) * rng.uniform(0.3, 0.9)))]
    injected = [b for b in share if rng.random() < 0.8] or share[:1]
    taken = {i for b in injected for i in b}
    kept, displaced = [], []
    for b in father:
        if taken.isdisjoint(b):
            kept.append(b)
        else:
            displaced += [i for i in b if i not in taken]
    displaced.sort(key=lambda i: -size[i])
    return best_fit(injected + kept, displaced, size, room)


def mutate(bins: Bins, size: list[int], room: int, rng: random.Random) -> Bins:
    """Dissolve the emptiest bins and a few others."""
    order = sorted(bins, key=lambda b: sum(size[i] for i in b))
    n = max(1, len(order) // 20)
    gone = set(range(n)) | {rng.randrange(len(order)) for _ in range(n)}
    loose = [i for k in gone for i in order[k]]
    loose.sort(key=lambda i: -size[i] * rng.uniform(0.9, 1.0))
    return best_fit([b for k, b in enumerate(order) if k not in gone], loose, size, room)


def evolve(size: list[int], room: int, seeds: list[Bins], members: int, children: int, rng: random.Random) -> Bins:
    """One epoch of an island; seeds: members that came from other epochs."""
    least = -(-sum(size) // room)
    order = sorted(range(len(size)), key=lambda i: -size[i])
    people = list(seeds) or [best_fit([], order, size, room)]
    while len(people) < members:
        people.append(best_fit([], sorted(order, key=lambda i: -size[i] * rng.uniform(0.8, 1.0)), size, room))
    scored = sorted(((fitness(b, size, room), b) for b in people), key=lambda x: x[0])
    for _ in range(children):
        if scored[0][0][0] <= least:
            break
        a, b = sorted(rng.sample(range(len(scored)), 2))
        child = mutate(crossover(scored[a][1], scored[b][1], size, room, rng), size, room, rng)
        score = fitness(child, size, room)
        if score < scored[-1][0] and all(score != s for s, _ in scored):
            scored[-1] = (score, child)
            scored.sort(key=lambda x: x[0])
    return scored[0][1]


def _epoch(epoch: int, room: int, members: int, children: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                size = row["lengths"]
                seeds = []
                for label in (row["best"], row["guest"]):
                    if label:
                        bins: Bins = [[] for _ in range(max(label) + 1)]
                        for i, k in enumerate(label):
                            bins[k].append(i)
                        seeds.append(bins)
                rng = random.Random(f"{row['block']} {row['island']} {epoch}")
                bins = evolve(size, room, seeds, members, children, rng)
                label = np.zeros(len(size), np.int32)
                for k, b in enumerate(bins):
                    label[b] = k
                n, uneven = fitness(bins, size, room)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]], pa.int64()), pa.array([row["island"]], pa.int32()),
                     pa.array([size], pa.list_(pa.int32())), pa.array([label], pa.list_(pa.int32())),
                     pa.array([n], pa.int32()), pa.array([uneven], pa.float64())],
                    names=["block", "island", "lengths", "best", "n_bins", "uneven"])

    return run


ISLAND = "block long, island int, lengths array<int>, best array<int>, n_bins int, uneven double"


def _place(room: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pieces, best in zip(*batch.columns, strict=True):
                pieces = pieces.values
                label = best.values.to_numpy(zero_copy_only=False)
                length = pieces.field("length").to_numpy(zero_copy_only=False)
                order = np.argsort(label, kind="stable")
                before = np.cumsum(length[order]) - length[order]
                begin = np.searchsorted(label[order], label[order])
                offset = np.empty(len(label), np.int64)
                offset[order] = before - before[begin]
                yield pa.RecordBatch.from_arrays(
                    [*(pieces.field(c) for c in PIECE), pa.array((block.as_py() << 32) + label.astype(np.int64)), pa.array(offset)],
                    names=[*PIECE, "sequence_id", "offset"])

    return run


PIECE = ["doc_id", "piece", "start", "length", "ids_crc32"]


def pack(pieces: DataFrame, max_tokens: int = 2048, block_pieces: int = 4096, islands: int = 3, epochs: int = 2,
         members: int = 4, children: int = 8) -> DataFrame:
    """``pieces`` (as ``token_pieces`` gives them) with sequence_id and offset."""
    spark = pieces.sparkSession
    types = dict(pieces.dtypes)
    table = written(pieces.select(*PIECE), "pieces").withColumn("row", F.monotonically_increasing_id())
    full, rest = table.filter(F.col("length") == max_tokens), table.filter(F.col("length") < max_tokens)
    n = rest.count()
    blocks = max(1, -(-n // block_pieces))
    # row numbers spread evenly whatever the ids are, so a block is bounded
    members_of = (
        rest.groupBy(F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"))
        .agg(F.array_sort(F.collect_list(F.struct("row", *PIECE))).alias("pieces"))
        .select("block", F.transform("pieces", lambda p: F.struct(*[p[c].alias(c) for c in PIECE])).alias("pieces")))
    members_of = written(members_of, "pack-blocks")
    state = members_of.select(
        "block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
        F.transform("pieces", lambda p: p["length"].cast("int")).alias("lengths"),
        F.lit(None).cast("array<int>").alias("best"))
    guests = None
    for epoch in range(epochs):
        if guests is None:
            state = state.withColumn("guest", F.lit(None).cast("array<int>"))
        else:
            state = state.join(guests, ["block", "island"])
        tasks = max(1, min(blocks * islands, 4 * spark.sparkContext.defaultParallelism))
        state = (state.select("block", "island", "lengths", "best", "guest").repartition(tasks, "block", "island")
                 .mapInArrow(_epoch(epoch, max_tokens, members, children), ISLAND))
        state = written(state, f"pack-epoch{epoch}")
        # the elite of an island visits the next one
        guests = state.select("block", F.pmod(F.col("island") + 1, F.lit(islands)).cast("int").alias("island"),
                              F.col("best").alias("guest"))
    winner = state.groupBy("block").agg(F.min_by("best", F.struct("n_bins", "uneven", "island")).alias("best"))
    schema = f"doc_id {types['doc_id']}, piece long, start long, length long, ids_crc32 long, sequence_id long, offset long"
    packed = members_of.join(winner, "block").select("block", "pieces", "best").mapInArrow(_place(max_tokens), schema)
    alone = full.select(*PIECE, (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone)
