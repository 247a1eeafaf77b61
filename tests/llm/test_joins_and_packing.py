"""Joins, components, sharding, packing and toxicity on small tables."""

import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from notelab.llm import bpe, jaccard_join, packing, sharding, toxicity, url_filter
from notelab.llm import bytewords as bw
from notelab.llm.common import shared_folder
from notelab.llm.components import connected_components

import plain

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def near_copies(seed=5):
    """Groups of near copies around the threshold, exact copies, chains, a
    passage that a third of all texts share, short and empty texts."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(100_000)}"
    passage = [word() for _ in range(60)]
    texts = [None, "", " \n", "one", "One", "two words", "two  WORDS", "two words more"]
    for n in (30, 64, 200, 500):
        for _ in range(3):
            base = [word() for _ in range(n)]
            for k in range(6):
                copy = list(base)
                for _ in range(k * n // 120):
                    copy[rng.randrange(n)] = word()
                texts.append(" ".join(copy))
            for step in range(1, 5):  # a chain: only neighbours are similar
                base = base[n // 40:] + [word() for _ in range(n // 40)]
                texts.append(" ".join(base))
    for _ in range(40):
        texts.append(" ".join([word() for _ in range(rng.randrange(5, 90))] + passage))
    big = [word() for _ in range(150)]
    for _ in range(40):  # a large group of near copies
        copy = list(big)
        copy[rng.randrange(150)] = word()
        texts.append(" ".join(copy))
    texts += texts[20:30] * 3
    texts.append(" ".join(word() for _ in range(30_000)))
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts, strict=True))


def test_jaccard_join_equals_all_pairs(spark):
    docs = near_copies()
    expected = plain.similarity_components(docs)
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit("x")).withColumn("token", F.lit(1))
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.components(table.repartition(4)).collect()}
    assert len({c for _, c in expected.values()}) < len(docs) - 60
    assert out == expected
    kept = jaccard_join.keep_one(table)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {c for _, c in expected.values()}


def test_jaccard_join_without_frequent_summary_finds_the_same(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HOT_MOST", 1)
    docs = near_copies(6)
    out = jaccard_join.components(spark.createDataFrame(docs, "doc_id long, text string"), percent=80).collect()
    expected = plain.similarity_components(docs, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == expected


def test_jaccard_join_empty_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.components(empty).count() == 0
    table = spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (3, "a b c d"), (None, "q r s t u")], "doc_id long, text string")
    out = sorted((r.doc_id or -1, r.component_id or -1) for r in jaccard_join.components(table).collect())
    assert out == [(-1, -1), (-1, 3), (3, 3), (4, 3)]


@pytest.mark.parametrize("text", [False, True])
def test_connected_components(spark, text):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 80)] + [(7, 7), (300, 200), (200, 300), (None, 5)]
    edges += [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    expected = {n: root(n) for n in parent if root(n) != n}
    table = spark.createDataFrame(edges, "a long, b long")
    if text:  # any ordered type can be a node
        table = table.select(F.format_string("%05d", "a").alias("a"), F.format_string("%05d", "b").alias("b")).filter("a != ' null'")
    out = {int(r.node): int(r.component) for r in connected_components(table.filter("a is not null")).collect()}
    assert out == expected


def test_url_filter(spark):
    rules = [url_filter.rule(*x) for x in (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))]
    link = '<head><link href="{}" rel="canonical"></head>'
    pages = [
        (1, "http://a.Example.NET/en/x?y", None, "a.example.net", "/en/x", "example.net/en/", "allow"),
        (2, "https://example.net#z", "", "example.net", "", None, "allow"),
        (3, "https://badexample.com/de/1", "", "badexample.com", "/de/1", None, "allow"),
        (4, "https://example.com/de/1", "", "example.com", "/de/1", "example.com/de/", "block"),
        (5, None, "", "", "", None, "allow"),
        (6, "no scheme/net/", "", "", "", None, "allow"),
        (7, "https://alias.info/1", link.format("https://example.com/de/9"), "alias.info", "/1", None, "block"),
        (8, "http://m.alias.info/1/?utm_source=x", "", "m.alias.info", "/1/", None, "block"),
        (9, "https://both.info/", link.format("https://x.org/fr/1") + '<meta http-equiv="refresh" content="0; url=https://q.net/">', "both.info", "/", None, "allow"),
        (10, "https://far.info/1?a=b://c", "", "far.info", "/1", None, "block"),
        (11, "https://sub.x.org/fr/1", "", "sub.x.org", "/fr/1", "org/fr/", "allow"),
        (12, "https://q.net/", link.format("/home"), "q.net", "/", "net/", "block"),
        (1, "http://a.Example.NET/en/x?y", None, "a.example.net", "/en/x", "example.net/en/", "allow"),
    ]
    table = spark.createDataFrame([(*p[:3], "clash") for p in pages], "page_id long, url string, html string, verdict string")
    redirects = spark.createDataFrame([("https://far.info/1?a=b://c", "https://mid.info/"), ("https://mid.info/", "https://z.net/"), (None, "https://z.net/")], "source string, target string")
    out = url_filter.judge(table, rules, redirects=redirects).collect()
    assert sorted(tuple(r[:5]) for r in out) == sorted((p[0], *p[3:]) for p in pages)
    assert url_filter.judge(table.limit(0), rules).count() == 0


def test_shard_map_places_and_edits(spark):
    rng = random.Random(2)
    docs = [(i, "x" * rng.randrange(200)) for i in range(500)] + [(None, None), (None, None), (3, "é" * 50)]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("shard", F.lit("clash"))
    path = shared_folder(spark, "slot-map-test")
    out = sharding.shard(table, path, 7, slots=256).collect()
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in out) == sorted((d or -1, len((t or "").encode()) + 1, plain.crc(t)) for d, t in docs)
    places, load = collections.defaultdict(list), collections.Counter()
    for r in out:
        places[r.shard].append(r.slot)
        load[r.shard] += r.size
    assert all(sorted(x) == list(range(len(x))) for x in places.values())
    assert max(load.values()) - min(load.values()) <= 200
    old = {r.virtual_slot: r.shard for r in sharding.read_map(spark, path).collect()}
    sizes = {r.virtual_slot: r["bytes"] for r in sharding.read_map(spark, path).collect()}
    grown = sharding.edit_map(old, sizes, 8)
    moved = [s for s in old if grown[s] != old[s]]
    assert moved and len(moved) < len(old) / 4 and set(grown.values()) == set(range(8))
    shrunk = sharding.edit_map(grown, sizes, 5)
    assert set(shrunk.values()) == set(range(5))
    assert sum(shrunk[s] != grown[s] for s in old if grown[s] < 5) < len(old) / 4
    sharding.write_map(spark, path, 2, grown, {k: (v, 0) for k, v in sizes.items()})
    assert {r.virtual_slot: r.shard for r in sharding.read_map(spark, path).collect()} == grown
    assert {r.virtual_slot: r.shard for r in sharding.read_map(spark, path, 1).collect()} == old
    assert sharding.shard(table.limit(0), shared_folder(spark, "slot-map-test"), 4).count() == 0


def test_token_ids_equal_the_tokenizer():
    encoder = bpe.Encoder(JSON, RANKS)
    rng = random.Random(1)
    alphabet = " \n\t\u0085\u00a0aéZß09²½!?<|. Āɏ日-'"
    texts = ["", "a  b\n c\n\nd \n", "it's don't ''s", "<|endoftext|> x", "\x1c x\r\n", None]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(800)]
    for with_ranks in (encoder, bpe.Encoder(JSON)):
        for slab in bw.slabs(pa.array(texts), 4000):
            ids, offsets = with_ranks.slab_ids(slab)
            for i in range(slab.n):
                assert ids[offsets[i]: offsets[i + 1]].tolist() == encoder.tokenizer.encode(texts[slab.first + i] or "", add_special_tokens=False).ids


def check_packed(rows, docs, room):
    tokenizer = bpe.Encoder(JSON).tokenizer
    expected = []
    for d, t in docs:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        for k, (start, length) in enumerate(packing.cut(len(ids), room)):
            expected.append((d, k, start, length, zlib.crc32(ids[start: start + length].tobytes())))
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted((tuple(r[:5]) for r in rows), key=key) == sorted(expected, key=key)
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= room
    return len(sequences)


def test_packing_round_trip(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice(["the", "Ünder", "日本", "it's", "\n"]) for _ in range(rng.randrange(80)))) for i in range(300)]
    docs += [(None, None), (None, ""), (5, docs[5][1]), (1000, "long " * 5000)]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("piece", F.lit("clash"))
    pieces = packing.token_pieces(table, JSON, RANKS, max_tokens=64, with_ids=True)
    out = packing.pack(pieces, 64, block_pieces=100).collect()
    n = check_packed(out, docs, 64)
    assert n <= 1.06 * -(-sum(r.length for r in out) // 64)
    assert packing.pack(packing.token_pieces(table.limit(0), JSON)).count() == 0


def test_genetic_packing_beats_best_fit():
    rng = random.Random(0)
    size = [x for _ in range(60) for x in (lambda a, b: (a, b, 100 - a - b))(rng.randrange(20, 40), rng.randrange(20, 40))]
    order = sorted(range(len(size)), key=lambda i: -size[i])
    plain_fit = packing.best_fit([], order, size, 100)
    evolved = packing.evolve(size, 100, [], 6, 80, random.Random(1))
    assert sorted(i for b in evolved for i in b) == list(range(len(size)))
    assert all(sum(size[i] for i in b) <= 100 for b in evolved)
    assert packing.fitness(evolved, size, 100) < packing.fitness(plain_fit, size, 100)


def test_toxicity_learns_and_scores(spark):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(400):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(20, 200))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(len(words) // 20 + 2):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "Scum!", f"vequ{rng.randrange(40)}x"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs += [(900, None), (901, ""), (None, "idiot"), (3, docs[3][1])]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("clash"))
    truth = spark.createDataFrame(labels + [(7, None), (None, 1)], "doc_id long, toxic int")
    out = toxicity.judge(table, truth).collect()
    assert len(out) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    for r in out:
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0)
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 400]
    wrong = [r for r in held if r.predicted != int(r.doc_id % 4 == 0)]
    assert len(wrong) <= 0.03 * len(held)
    none = toxicity.judge(table, truth.filter("toxic = 0")).collect()
    assert all(r.predicted == 0 for r in none)
    assert toxicity.judge(table.limit(0), truth).count() == 0


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(5000)}"
    line = "a notice that stands in many of the documents of this table"
    docs = []
    for i in range(40):
        docs.append((i, "\n".join([" ".join(word() for _ in range(60)), line + f" {i % 4}"]), "en"))
    docs += [(100, docs[0][1].replace("w1", "v1", 1), "en"), (101, "too short", "en"), (102, "again and " * 60, "en"),
             (103, None, None), (104, docs[1][1] + " " + " ".join(f"item{k}" for k in range(15)), "en")]
    benchmark = [(1, " ".join(f"item{k}" for k in range(15)))]
    for name, data, schema in (("documents", docs, "doc_id long, text string, lang string"), ("benchmark", benchmark, "item_id long, text string"),
                               ("labels", [(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")):
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = [table]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], str(tmp_path)))
        assert kept[-1].columns == table.columns
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in kept]
    assert ids[1] == ids[0] - {101, 102, 103} and ids[2] == ids[1]
    texts = [(r.doc_id, r.text) for r in kept[1].select("doc_id", "text").collect()]
    lines = plain.kept_lines(texts)
    assert {r.doc_id: r.text for r in kept[2].collect()} == {d: x[2] for d, x in lines.items()}
    groups = plain.similarity_components([(d, x[2]) for d, x in lines.items()])
    assert ids[3] == {c for _, c in groups.values()}
    assert ids[4] == ids[3] - {104}
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    check_packed(final, [(d, lines[d][2]) for d in ids[4]], 2048)
