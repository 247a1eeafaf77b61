"""Operators whose results must not depend on the size of the table."""

import collections
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from notelab.llm import bytewords as bw
from notelab.llm import substring_dedup, toxicity, url_filter
from notelab.llm.catalog import QUERIES

import plain


def toxic_corpus():
    """Rare toxic words, each in a few documents, among frequent neutral ones."""
    rng = random.Random(21)
    docs, labels = [], []
    for i in range(600):
        words = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(20, 60))]
        if i % 4 == 0:
            words[rng.randrange(len(words))] = f"vile{i // 4 % 10}word"
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    return docs + [(5, docs[5][1]), (None, "vile3word"), (None, "vile3word"), (901, None)], labels


def test_toxicity_model_grows_beyond_a_block(spark):
    docs, labels = toxic_corpus()
    table = spark.createDataFrame(docs, "doc_id long, text string")
    truth = spark.createDataFrame(labels, "doc_id long, toxic int")
    key = lambda r: (r.doc_id is None, r.doc_id or 0)
    whole, blocks = (sorted(toxicity.judge(table, truth, **o).collect(), key=key) for o in ({}, {"block_grams": 8}))
    assert [r.doc_id for r in whole] == [r.doc_id for r in blocks] == sorted((d for d, _ in docs), key=lambda d: (d is None, d or 0))
    assert np.allclose([r.evidence for r in whole], [r.evidence for r in blocks], rtol=1e-9, atol=1e-12)
    assert np.allclose([r.score for r in whole], [r.score for r in blocks], rtol=1e-9)
    held = [r for r in blocks if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert all(r.predicted == int(r.doc_id % 4 == 0) for r in held)


def test_toxicity_against_plain_models(spark):
    rng = random.Random(5)
    docs, labels = toxic_corpus()
    # an expression of one class only, ones of a single text, a context that no toxic text goes on from
    docs = [(i, None if t is None else t + (" kindly yours" if i is not None and i % 4 and rng.random() < 0.6 else "")
             + (f" once{i}here" if i is not None and i % 9 == 0 else "")) for i, t in docs]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    truth = spark.createDataFrame(labels, "doc_id long, toxic int")
    fold = {r.doc_id: r for r in truth.select("doc_id", toxicity.fold(F.col("doc_id")).alias("f"), (
        F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(8)) == 0).alias("c")).collect()}
    train = [(t, int(i % 4 == 0)) for i, t in docs if i in fold and fold[i].f != 0 and not fold[i].c]
    texts = [t for _, t in docs] + ["kindly yours", "once0here"]
    more = table.unionAll(spark.createDataFrame([(1001, texts[-2]), (1002, texts[-1])], table.schema))
    for bound in (-1.0, 12.0):
        got = sorted((r.text or "", r.evidence) for r in toxicity.score(
            more.select("text", F.col("text").alias("words")), toxicity.learn(table, truth, min_keyness=bound), "words").collect())
        plainly = sorted(zip([t or "" for t in texts], plain.kneser_ney_evidence(train, texts, bound), strict=True))
        assert [t for t, _ in got] == [t for t, _ in plainly]
        assert np.allclose([x for _, x in got], [x for _, x in plainly], rtol=1e-9, atol=1e-12)
        assert dict(got)["kindly yours"] < -0.5


def test_toxicity_counts_of_both_classes(spark):
    docs = [(i, "plain common words" if i % 2 else "plain rare words") for i in range(40)] + [(40, "rare rare rare")]
    rows = spark.createDataFrame([(t, int(i % 2 == 0)) for i, t in docs], "text string, toxic int")
    _, known, total = toxicity._class_counts(rows, 2, [20, 21])
    assert total == [60, 63]
    out = {(r.kind, r.ordinary, r.toxic, r.ordinary_docs, r.toxic_docs) for r in known.filter(f"kind = {toxicity.WORD}").collect()}
    assert out == {(toxicity.WORD, 20, 20, 20, 20), (toxicity.WORD, 0, 23, 0, 21)}


def test_pipeline_drops_near_copies_between_the_thresholds(spark):
    rng = random.Random(31)
    word = lambda: f"u{rng.randrange(100_000)}"
    docs = []
    for i in range(12):
        text = [word() for _ in range(100)]
        docs.append((2 * i, " ".join(text)))
        for at in (30, 70)[: 2 if i < 8 else 1]:
            text[at] = "changed"
        docs.append((2 * i + 1, " ".join(text)))
    far = [word() for _ in range(100)]  # 5 changes: 71/121 < 0.8
    docs += [(100, " ".join(far)), (101, " ".join("changed" if k % 20 == 10 else w for k, w in enumerate(far)))]
    strict, groups = plain.similarity_components(docs), collections.defaultdict(set)
    sets = {d: plain.shingles(t, 5) for d, t in docs}
    for a in sets:
        for b in sets:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                groups[a].add(b)
    expected = {min(g) for g in groups.values()}  # pairs only: no chains
    assert len({c for _, c in strict.values()}) == len(expected) + 8
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, table, "").collect()} == expected


def placed_passages(n=400, words=51):
    rng = random.Random(51)
    word = lambda: rng.choice("abcdefghijklmnopq") * rng.randrange(1, 4) + str(rng.randrange(2000))
    out = []
    for _ in range(n):
        passage = [word() for _ in range(words)]
        out.append([" ".join([word() for _ in range(rng.randrange(60))] + passage + [word() for _ in range(rng.randrange(60))]) for _ in range(2)])
    return out


def test_local_cuts_share_chunks_of_every_passage(spark):
    for a, b in placed_passages():
        chunks = []
        for slab in bw.slabs(pa.array([a, b])):
            s, e, n, first = substring_dedup.chunk_spans(slab, local=True)
            assert n.max() <= substring_dedup.MAX_WORDS and n.sum() == len(a.split()) + len(b.split())
            chunks += [[(slab.data[s[k]: e[k]].tobytes(), int(n[k])) for k in range(first[i], first[i + 1])] for i in range(slab.n)]
        known = {c for c, _ in chunks[0]}
        run = best = 0
        for c, n in chunks[1]:
            run = run + n if c in known else 0
            best = max(best, run)
        assert best >= 51 - 2 * substring_dedup.MAX_WORDS + 1


def test_local_cuts_equal_plain_windows():
    rng = random.Random(7)
    texts = ["", "one", "the " * 40, " ".join(rng.choice("abc") for _ in range(200))] + [x for p in placed_passages(5) for x in p]
    for slab in bw.slabs(pa.array(texts), 3000):
        s, e, n, first = substring_dedup.chunk_spans(slab, local=True)
        for i in range(slab.n):
            words, cuts = [w.encode() for w in plain.words(texts[slab.first + i])], set()
            h = [sum(int(substring_dedup.GEAR[b]) << j for j, b in enumerate(w[::-1][:16])) & 0xFFFFFFFF for w in words]
            for k in range(len(words) - 15):
                cuts.add(min(range(k, k + 16), key=lambda j: (h[j], -j)))
            cuts |= {len(words) - 1} if words else set()
            assert n[first[i]: first[i + 1]].cumsum().tolist() == [c + 1 for c in sorted(cuts)]


def test_op3_finds_every_placed_passage(spark, tmp_path):
    docs = [(i, t) for i, t in enumerate(x for p in placed_passages() for x in p)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r.n_dropped_words for r in QUERIES["op3_substring_dedup"](spark, str(tmp_path)).collect()}
    assert all(out[i] >= 20 if i % 2 else out[i] == 0 for i in out) and len(out) == len(docs)


def test_relative_targets_and_ties(spark):
    link, refresh = '<link rel="canonical" href="{}">', '<meta http-equiv="refresh" content="0; url={}">'
    pages = [(1, "http://a.b/c/d?x=1", link.format("page.html")), (2, "http://a.b/c/d/", link.format("../x/./y")),
             (3, "http://a.b/c/d?x=1#f", link.format("?id=1")), (4, "http://a.b", link.format("p?u=../q")),
             (5, "http://a.b/c/d", link.format("../../../e/..")), (6, "http://a.b/c", link.format("mailto:x@y")),
             (7, "http://a.b/c/d", refresh.format("e/")), (8, "http://a.b/c", link.format("http://z.y/../k"))]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    out = {r.page_id: r.t for r in table.select("page_id", url_filter._targets(F.col("url"), F.col("html")).alias("t")).collect()}
    assert out == {1: ["http://a.b/c/page.html"], 2: ["http://a.b/c/x/y"], 3: ["http://a.b/c/d?id=1"], 4: ["http://a.b/p?u=../q"],
                   5: ["http://a.b/"], 6: [], 7: ["http://a.b/c/e/"], 8: ["http://z.y/../k"]}
    for order in (1, -1):
        rules = [url_filter.rule("allow", "x.com/a"), url_filter.rule("block", "x.com/a")][::order]
        table = spark.createDataFrame([(1, "https://x.com/a")], "page_id long, url string")
        assert url_filter.judge(table, rules, html_col=None).first().verdict == "allow"
    table = spark.createDataFrame([(1, "https://k.info/f/a", link.format("../bad/1")), (2, "https://k.info/g/", None)], "page_id long, url string, html string")
    out = url_filter.judge(table, [url_filter.rule("block", "k.info/bad/")]).collect()
    assert {r.page_id: r.verdict for r in out} == {1: "block", 2: "allow"}
