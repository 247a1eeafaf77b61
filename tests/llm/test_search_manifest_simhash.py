"""Ranked search, Merkle manifest and SimHash against plain Python."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from notelab.llm import merkle, ranked_search, simhash

import plain

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, top=10):
    bags = [(d, collections.Counter(TERM.findall(plain.lower(t)))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    total, df = sum(n for _, _, n in bags), collections.Counter(t for _, b, _ in bags for t in b)
    out = []
    for name, text in items:
        scored = []
        for d, bag, n in bags:
            m = 100 - 75 + (75 * n * len(bags)) // total
            score = sum(k * math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m))
                        for t, k in collections.Counter(TERM.findall(plain.lower(text))).items() if bag[t])
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(name, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored)[:top])]
    return out


def library(n=400, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "naïve", "Über9"]
    texts = [None, "", " .,- ", "W1 w1 W1", "w2-w3_w4", "x" * 5000]
    topics = [rng.sample(vocabulary, 25) for _ in range(12)]
    for _ in range(n):
        topic = rng.choice(topics)
        texts.append(" ".join(rng.choice(topic if rng.random() < 0.7 else vocabulary) for _ in range(rng.randrange(1, 120))))
    texts += [texts[40]] * 30 + [" ".join(rng.choice(vocabulary) for _ in range(30_000))]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    docs = list(zip(ids, texts, strict=True)) + [(None, texts[40]), (ids[50], texts[60])]
    items = [(i, " ".join(rng.choice(rng.choice(topics)) for _ in range(rng.randrange(1, 60)))) for i in range(40)]
    items += [(100, None), (101, "... "), (102, "unheard"), (103, texts[40]), (103, "w1 w1 w1 W2"), (None, "w5 É")]
    return docs, items


@pytest.mark.parametrize("options", [{}, {"block_bytes": 300, "seed_docs": 40}, {"top": 3}])
def test_ranked_search_equals_full_scoring(spark, options):
    docs, items = library()
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("item", F.lit(1)).repartition(3)
    queries = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(0))
    got = [tuple(r) for r in ranked_search.search(table, queries, **options).select("item_id", "rank", "doc_id", "score").collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    wanted = ranked(docs, [x for x in items if x[1] is not None], options.get("top", 10))
    assert sorted(got, key=key) == sorted(wanted, key=key)


def test_ranked_search_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked_search.search(none, some).count() == 0
    assert ranked_search.search(some.withColumnRenamed("item_id", "doc_id"), some.filter("false")).count() == 0


def test_blocks_bound_their_documents_and_are_skipped():
    rng = np.random.default_rng(2)
    n, size = 1500, 60
    impacts = np.where(rng.random((size, n)) < 0.2, rng.integers(1, 1_000_000, (size, n)), 0).astype(np.float32)
    for topic in range(6):  # documents of a topic share their strong terms
        impacts[topic * 10: topic * 10 + 10, topic::6] = rng.integers(600_000, 900_000, (10, len(range(topic, n, 6))))
    shard = ranked_search.Shard(impacts)
    coordinates = np.arange(0, size, 2)
    for term in range(size):
        blocks = shard.blocks(term, coordinates)
        assert sorted(blocks.docs) == np.flatnonzero(impacts[term]).tolist()
        for b, (lo, hi) in enumerate(zip(blocks.starts, [*blocks.starts[1:], len(blocks.docs)], strict=True)):
            assert (blocks.summary[:, b] == impacts[np.ix_(coordinates, blocks.docs[lo:hi])].max(axis=1)).all()
    items = ranked_search.Items(np.arange(size, dtype=np.uint64), [np.arange(t * 10, t * 10 + 10) for t in range(6)],
                                [np.ones(10, np.int64)] * 6)
    model = ranked_search.Model(items, np.full(size, 1000), n, n * 12, np.ones(6, np.int64), 10)
    whole = np.stack([(model.factors[i][:, None] * impacts[items.terms[i]].astype(np.int64)).sum(axis=0) for i in range(6)])
    model.least = np.sort(whole, axis=1)[:, -10]
    best = ranked_search.Best(model)
    skipped = ranked_search.search_shard(shard, best, np.arange(n), np.zeros(n, bool))
    assert skipped > 0
    for i in range(6):
        assert best.doc[i].tolist() == np.lexsort((np.arange(n), -whole[i]))[:10].tolist()


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest(rows):
    """rows: doc_id, source, lang, n_chars, text."""
    def leaf(row):
        return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def tree(level):
        """Root, and per leaf its siblings (before, after) from the leaf up."""
        paths, place = [[] for _ in level], list(range(len(level)))
        while len(level) > 1:
            for k, at in enumerate(place):
                run = at - at % 8
                paths[k].append((level[run:at], level[at + 1: run + 8]))
                place[k] = at // 8
            level = [digest(*level[i: i + 8]) for i in range(0, len(level), 8)]
        return level[0] if level else None, paths

    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted(groups[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = own, *tree([leaf(r) for r in own])
    root, tops = tree([trees[x][1] for x in langs])
    out = []
    for lang, top in zip(langs, tops, strict=True):
        own, subroot, paths = trees[lang]
        for row, path in zip(own, paths, strict=True):
            path = path + top
            change = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None
            fold = leaf((*row[:4], plain.lower(row[4]))) if change else leaf(row)
            for before, after in path:
                fold = digest(*before, fold, *after)
            out.append((row[0], leaf(row), subroot, root, digest(*(x for b, a in path for x in b + a)), fold, fold == root))
    return out


def corpus(sizes, seed=1):
    rng = random.Random(seed)
    rows = []
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append((rng.randrange(1 << 40), rng.choice(["a", "b", None]), lang, rng.choice([None, 5, 70]),
                         rng.choice([None, "", "Some Text", "naïve Ünder", "lower", f"Row {rng.random()}"])))
    return rows


@pytest.mark.parametrize("sizes", [
    {"en": 1300, None: 65, "fr": 513, "é": 64, "": 3, "de": 8, "es": 1}, {f"l{i}": 1 + i % 3 for i in range(20)}, {}])
def test_manifest_equals_plain_trees(spark, sizes):
    rows = corpus(sizes)
    if sizes:
        rows += [(None, "s", "en", 1, "No Id"), (None, None, None, None, None), *[(7, "s", "en", 3, "Same")] * 12, (7, "s", "en", 3, "Other"),
                 (8, "s", "en", 40_000, "Long " * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    docs = docs.withColumn("leaf", F.lit("x")).withColumn("g", F.lit(1)).withColumn("i", F.lit(2)).repartition(5)
    out = merkle.manifest(docs, check=merkle.lowered_leaf())
    got = [tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")), "folded",
                                        F.col("folded") == F.col("root")).collect()]
    assert collections.Counter(got) == collections.Counter(manifest(rows))
    if len(rows) > 100:
        assert len({x[-1] for x in got}) == 2


def fingerprint(text):
    w = plain.words(plain.lower(text))
    s = [" ".join(w[i: i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(values):
    """Least value that steps of at most two bits reach, by all pairs."""
    values, out = sorted(set(values)), {}
    v = np.array(values, np.uint64)
    for start in values:
        if start not in out:
            reach, todo = {start}, [start]
            while todo:
                near = v[np.bitwise_count(v ^ np.uint64(todo.pop())) <= 2].tolist()
                todo += [x for x in near if x not in reach]
                reach |= set(near)
            out |= dict.fromkeys(reach, min(reach))
    return out


def test_fingerprints_and_components_equal_brute_force(spark):
    rng = random.Random(4)
    word = lambda: rng.choice(["Straße", "a", "bb", "ccc", "É"]) + str(rng.randrange(3000))
    texts = [None, "", " \t\n", "one", "One", "two\x0bwords", "two  WORDS", "a b c"]
    for n in (2, 3, 10, 80, 300):
        base = [word() for _ in range(n)]
        for _ in range(25):
            copy = list(base)
            copy[rng.randrange(n)] = word()
            texts += [" ".join(copy), "\n ".join(copy)]
    texts.append(" ".join(word() for _ in range(70_000)))
    docs = list(enumerate(texts)) + [(None, texts[20]), (None, "nobody else"), (9, "same id")]
    rng.shuffle(docs)
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("fp", F.lit("x")).withColumn("key", F.lit(1)).repartition(4)
    prints = [(d, fingerprint(t)) for d, t in docs]
    root = linked(p for _, p in prints)
    least = {}
    for d, p in prints:
        if d is not None:
            least[root[p]] = min(d, least.get(root[p], d))
    wanted = collections.Counter((d, f"{p:016x}", least.get(root[p])) for d, p in prints)
    for small in (64, 2):
        got = simhash.components(table, small=small)
        assert collections.Counter(tuple(r) for r in got.select("doc_id", "fingerprint", "component_id").collect()) == wanted
    kept = simhash.keep_one(table)
    ids = {d for d, p in prints if d is not None and least[root[p]] == d}
    assert kept.columns == table.columns and kept.count() == sum(d is None or d in ids for d, _ in prints)
    assert simhash.components(table.filter("false")).count() == 0


@pytest.mark.parametrize("small", [2, 5, 64])
def test_links_lose_no_pair_in_crowded_variants(spark, small):
    rng = random.Random(small)
    values = {0, (1 << 64) - 1}
    for _ in range(4):  # many fingerprints around few centres, some in one segment only
        centre = rng.getrandbits(64)
        for low, high, n in ((0, 64, 60), (0, 32, 60), (32, 64, 60)):
            for _ in range(n):
                x = centre
                for _ in range(rng.randrange(5)):
                    x ^= 1 << rng.randrange(low, high)
                values.add(x)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in values]
    found = simhash.links(spark.createDataFrame(signed, "fp long"), small=small).collect()
    parent = {x: x for x in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in found:
        a, b = r.a % (1 << 64), r.b % (1 << 64)
        assert (a ^ b).bit_count() <= 2
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    assert {x: root(x) for x in values} == linked(values)


def test_all_operators_are_registered():
    import __spark_entry__

    names = {q.split("_")[0] for q in __spark_entry__.queries()}
    assert {f"op{i}" for i in range(1, 14)} | {"pipeline"} <= names
    assert {"op9_line_dedup", "op11_ranked_search", "op12_merkle_manifest"} <= set(__spark_entry__.oracle_sql())
