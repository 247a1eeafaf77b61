"""Benchmark decontamination with suffix arrays over the training words.

A document word is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are
lower-cased.  Every slab of training texts (about 2 MB, whole texts) is a
shard with its own suffix array: the positions of its words, sorted by the
words that follow.  Each suffix of each benchmark item is looked up by binary
search, one word deeper at a time; the range that is left after ``window``
words holds all places of that window, and following the words on from there
gives the longest verbatim match.

A suffix whose first words occur nowhere at the start of a test suffix has an
empty range at every test suffix, so such positions are left out before the
sort (a lookup table over the hash of up to four words).  Nothing else is
pruned.  Documents never leave their shard: there is no shuffle.

The benchmark goes to the tasks in blocks of at most ``block_bytes`` of text;
with several blocks the documents pass them one after the other, written to
the shared folder between them, and carry the hits found so far.

Edge cases: null and empty texts have no words and are never contaminated;
items without words match nothing; an item of fewer than ``window`` words is
one window; repeated documents or items are judged one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notelab.llm import bytewords as bw
from notelab.llm.common import fresh_name, written

PRUNE_WORDS = 4
PRUNE_BITS = 22


class TestSuffixes:
    """The suffixes of a block of items that begin a window, by length."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        self.window = window
        self.names = [name for name, _ in items]
        words, first = [], [0]
        for slab in bw.slabs(pa.array([text for _, text in items], pa.string())):
            w, f = item_words(slab)
            words.append(w)
            first += (f[1:] + first[-1]).tolist()
        self.words = np.concatenate([*words, np.zeros(0, np.uint64)])
        first = np.array(first)
        n = np.diff(first)
        begins, length = [], []
        for i in range(len(n)):
            if n[i]:
                k = min(window, int(n[i]))
                begins += range(int(first[i]), int(first[i] + n[i]) - k + 1)
                length += [k] * int(n[i] - k + 1)
        self.begins, self.length = np.array(begins, np.int64), np.array(length, np.int64)
        self.item = np.searchsorted(first, self.begins, side="right") - 1
        self.first_words = {}
        for k in np.unique(np.minimum(self.length, PRUNE_WORDS)).tolist():
            at = self.begins[np.minimum(self.length, PRUNE_WORDS) == k]
            self.first_words[k] = np.zeros(1 << PRUNE_BITS, bool)
            self.first_words[k][_slot(bw.combine([self.words[at + i] for i in range(k)]))] = True


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - PRUNE_BITS)).astype(np.int64)


def item_words(slab: bw.Slab) -> tuple[np.ndarray, np.ndarray]:
    low = slab.lowered()
    s, e, first = low.spans(bw.ALNUM)
    return low.hashes(low.prefix_hash(), s, e), first


def suffix_array(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The positions ``at`` sorted by the ``depth`` words from each on."""
    pad = np.concatenate([words, np.zeros(depth, np.uint64)])
    return at[np.lexsort([pad[at + d] for d in range(depth - 1, -1, -1)])]


def find_suffixes(words: np.ndarray, suffixes: np.ndarray, pattern: np.ndarray, begins: np.ndarray,
                  depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of the patterns pattern[begins:begins + depth] in a suffix
    array: the range of places of each."""
    pad = np.concatenate([words, np.zeros(depth, np.uint64)])
    lo, hi = np.zeros(len(begins), np.int64), np.full(len(begins), len(suffixes), np.int64)
    for d in range(depth):
        column, want = pad[suffixes + d], pattern[begins + d]
        lo, hi = _bisect(column, want, lo, hi, False), _bisect(column, want, lo, hi, True)
    return lo, hi


def _bisect(column: np.ndarray, want: np.ndarray, lo: np.ndarray, hi: np.ndarray, after: bool) -> np.ndarray:
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        value = column[np.minimum(mid, len(column) - 1)]
        right = open_ & ((value <= want) if after else (value < want))
        lo = np.where(right, mid + 1, lo)
        hi = np.where(open_ & ~right, mid, hi)
    return lo


def matches(words: np.ndarray, first: np.ndarray, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All places of all windows: word position, test suffix, window length."""
    found = [(np.zeros(0, np.int64),) * 3]
    ends = np.repeat(first[1:], np.diff(first))
    for length in np.unique(tests.length).tolist():
        k = min(length, PRUNE_WORDS)
        pos, h = bw.windows(words, first, k)
        at = pos[tests.first_words[k][_slot(h)]]
        at = at[at + length <= ends[at]]
        own = np.flatnonzero(tests.length == length)
        if not len(at):
            continue
        suffixes = suffix_array(words, at, length)
        lo, hi = find_suffixes(words, suffixes, tests.words, tests.begins[own], length)
        n = hi - lo
        place = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        found.append((suffixes[place], np.repeat(own, n), np.full(len(place), length)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def longest(words: np.ndarray, first: np.ndarray, tests: TestSuffixes, pos: np.ndarray,
            test: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal verbatim matches: word position, test suffix and length of those
    places that cannot be extended to the left, each followed to its end."""
    keys = pos * (len(tests.begins) + 1) + test
    left = (test > 0) & (tests.item[test] == tests.item[np.maximum(test - 1, 0)])
    inner = left & np.isin((pos - 1) * (len(tests.begins) + 1) + test - 1, keys)
    pos, test = pos[~inner], test[~inner]
    stop = np.repeat(first[1:], np.diff(first))[pos] if len(pos) else pos
    item_end = np.searchsorted(tests.item, tests.item[test], side="right") - 1
    item_stop = tests.begins[item_end] + tests.length[item_end]
    length = tests.length[test].copy()
    active = np.arange(len(pos))
    while len(active):
        a, b = pos[active] + length[active], tests.begins[test[active]] + length[active]
        go = (a < stop[active]) & (b < item_stop[active])
        active, a, b = active[go], a[go], b[go]
        active = active[words[a] == tests.words[b]]
        length[active] += 1
    return pos, test, length


def _scan(block, window: int, text_at: int, state_at: int | None, spans_out: bool):
    """state: merged hit ranges [start, end, ...] and names of items so far."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = TestSuffixes(block.value, window)
        for batch in batches:
            n_words, hits, items, places = [], [], [], []
            for slab in bw.slabs(batch.column(text_at)):
                words, first = item_words(slab)
                pos, test, length = matches(words, first, tests)
                hit = bw.covered(len(words), pos, length)
                if spans_out:
                    l_pos, l_test, l_len = longest(words, first, tests, pos, test)
                    l_text = np.searchsorted(first, l_pos, side="right") - 1
                text = np.searchsorted(first, pos, side="right") - 1
                pairs = np.unique(np.stack([text, tests.item[test]]), axis=1) if len(pos) else np.zeros((2, 0), int)
                edge = np.searchsorted(pairs[0], np.arange(slab.n + 1))
                for i in range(slab.n):
                    own = hit[first[i]: first[i + 1]]
                    n_words.append(len(own))
                    hits.append(_ranges(own) if edge[i] < edge[i + 1] else [])
                    items.append([tests.names[j] for j in pairs[1, edge[i]: edge[i + 1]]])
                    if spans_out:
                        m = np.flatnonzero(l_text == i)
                        places.append([{"item_id": tests.names[tests.item[l_test[x]]], "start": int(l_pos[x] - first[i]),
                                        "length": int(l_len[x])} for x in m])
            if state_at is not None:
                for i in range(batch.num_rows):
                    state = batch.column(state_at)[i].as_py()
                    mask = np.zeros(n_words[i], bool)
                    for own in (state["hits"], hits[i]):
                        for s, e in zip(own[::2], own[1::2], strict=True):
                            mask[s:e] = True
                    hits[i] = _ranges(mask)
                    items[i] = sorted({*state["items"], *items[i]})
                    if spans_out:
                        places[i] = state["places"] + places[i]
            state = pa.StructArray.from_arrays(
                [pa.array(n_words, pa.int64()), pa.array(hits, pa.list_(pa.int64())),
                 pa.array([sorted(set(x)) for x in items], pa.list_(pa.string())),
                 pa.array(places if spans_out else [[]] * len(items), pa.list_(PLACE))],
                names=["n_words", "hits", "items", "places"])
            columns = [c for i, c in enumerate(batch.columns) if i != state_at]
            yield pa.RecordBatch.from_arrays([*columns, state], names=[f"c{i}" for i in range(len(columns) + 1)])

    return run


PLACE = pa.struct([("item_id", pa.string()), ("start", pa.int64()), ("length", pa.int64())])
STATE = "struct<n_words: long, hits: array<long>, items: array<string>, places: array<struct<item_id: string, start: long, length: long>>>"


def _ranges(mask: np.ndarray) -> list[int]:
    d = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.stack([np.flatnonzero(d == 1), np.flatnonzero(d == -1)], axis=1).ravel().tolist()


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    block, size = [], 0
    items = benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string"))
    for name, text in items.filter(F.col(text_col).isNotNull()).toLocalIterator():
        if block and size + len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((name or "", text))
        size += len(text)
    yield block


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", window: int = 10, block_bytes: int = 8 << 20,
         places: bool = False) -> tuple[DataFrame, str]:
    """``docs`` with one more column, whose name is returned too: a struct of
    n_words, hits (start and end word of every hit run), items (names of the
    items with a window in the text) and, if asked for, places (longest
    verbatim matches: item_id, start word, length)."""
    spark = docs.sparkSession
    state = fresh_name(docs, "leak")
    out, types = docs, dict(docs.dtypes)
    schema = ", ".join([*(f"c{i} {types[c]}" for i, c in enumerate(docs.columns)), f"c{len(docs.columns)} {STATE}"])
    at = docs.columns.index(text_col)
    for i, block in enumerate(_blocks(benchmark, item_col, item_text_col, block_bytes)):
        if i:
            out = written(out, "leaks")
        sent = spark.sparkContext.broadcast(block)
        out = out.mapInArrow(_scan(sent, window, at, len(docs.columns) if i else None, places), schema)
        out = out.toDF(*docs.columns, state)
    return out, state


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents without any hit word."""
    out, state = scan(docs, benchmark, text_col, **options)
    return out.filter(F.size(F.col(state)["hits"]) == 0).drop(state)


def items_digest(names: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256 (of the item
    ids sorted as strings, comma-joined), contaminated, longest_match."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out, state = scan(narrow, benchmark, places=True, **options)
    s = F.col(state)
    n_hit = F.aggregate(F.sequence(F.lit(0), F.size(s["hits"]) - 2, F.lit(2)), F.lit(0).cast("long"),
                        lambda acc, i: acc + F.get(s["hits"], i + 1) - F.get(s["hits"], i))
    n_hit = F.when(F.size(s["hits"]) > 0, n_hit).otherwise(F.lit(0).cast("long"))
    return out.select(
        "doc_id", s["n_words"].alias("n_words"), n_hit.alias("n_hit"),
        F.size(s["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(s["items"])), 256).alias("items_sha256"),
        (F.size(s["hits"]) > 0).alias("contaminated"),
        F.coalesce(F.array_max(F.transform(s["places"], lambda p: p["length"])), F.lit(0)).cast("long").alias("longest_match"))
