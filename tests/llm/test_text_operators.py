"""The text operators against plain Python on small, nasty tables."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from notelab.llm import bytewords as bw
from notelab.llm import decontaminate, line_dedup, quality_rules, secret_scan, substring_dedup

import plain

LINE = "this line is long enough to be looked at by the operator"


def rows():
    rng = random.Random(3)
    vocabulary = ["the", "of", "Ünder", "日本", "x", "AKIA" + "A1" * 9, "#|", "a b", "deadbeef" * 4, "Token='s3cr3t_value'"]
    texts = [None, "", " \t\n ", "one", "two words", "a\x00b \x1c c", LINE, LINE.upper() + "\r\n  " + LINE, "\n" * 5]
    for _ in range(60):
        n = rng.choice([3, 20, 90])
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "\n", "  "]) for _ in range(n))
        texts.append(text + rng.choice(["", "\n" + LINE, "\n\t" + LINE.title() + " "]))
    texts += texts[9:20]
    texts.append(" ".join(rng.choice(vocabulary) for _ in range(100_000)))  # a very long text
    texts.append("the of x " * 2000)
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string")
    for c in ("n_words", "kept", "spans", "leak", "counts", "lost", "lo"):
        df = df.withColumn(c, F.lit("clash"))
    return df.repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.mark.parametrize("limit", [1, 40, 1 << 20])
def test_words_lines_and_hashes(limit):
    texts = [t for _, t in rows()][:40]
    word_of = {}
    for slab in bw.slabs(pa.array(texts), limit):
        s, e, first = slab.spans(bw.NOT_SPACE)
        hashes = slab.hashes(slab.prefix_hash(), s, e)
        ls, le, l_first = slab.lines()
        for i in range(slab.n):
            text = texts[slab.first + i] or ""
            found = [slab.data[s[k]: e[k]].tobytes().decode() for k in range(first[i], first[i + 1])]
            assert found == plain.words(text)
            assert [slab.data[ls[k]: le[k]].tobytes().decode() for k in range(l_first[i], l_first[i + 1])] == text.split("\n")
            for w, h in zip(found, hashes[first[i]: first[i + 1]], strict=True):
                assert word_of.setdefault(int(h), w) == w


def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 0, 0), (5, None, 1), (7, 0, 0)], "doc_id long, quality int, toxic int")


def test_quality_counts(spark, docs):
    out = quality_rules.judge(docs, labels(spark)).collect()
    expected = {d: plain.base_counts(t) for d, t in rows()}
    assert len(out) == len(expected)
    for r in out:
        n, _, _, _, repeats = expected[r.doc_id]
        assert tuple(r[:6][1:]) == expected[r.doc_id]
        assert r.base_failed == (n < 20 or 100 * repeats > 30 * n)
        assert not (r.base_failed and r.kept)


def test_quality_rules_learn_a_threshold_and_keep_columns(spark):
    good = [(i, " ".join(f"w{i + 100}x{k}abc" for k in range(30)), "a") for i in range(60)]
    bad = [(100 + i, " ".join(f"v{i + 100}x{k}###" for k in range(30)), "b") for i in range(60)]
    table = spark.createDataFrame(good + bad, "doc_id long, text string, kept string")
    truth = spark.createDataFrame([(i, 1) for i, _, _ in good] + [(i, 0) for i, _, _ in bad], "doc_id long, quality int")
    rules = quality_rules.fit(table, truth)
    assert rules and "symbol_share" in str(rules[0][0])
    out = quality_rules.keep_good(table, truth)
    assert out.columns == table.columns and {r.doc_id for r in out.collect()} == {i for i, _, _ in good}


def test_quality_without_labels_or_rows(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.fit(docs, none) == []
    out = quality_rules.judge(docs, none)
    assert out.filter("kept = base_failed").count() == 0
    assert quality_rules.judge(empty, labels(spark)).count() == 0


def test_decontamination(spark, docs):
    texts = dict(rows())
    long_ = texts[len(texts) - 1].split()
    items = [(3, " ".join(texts[30].split()[:40])), (11, "One"), (2, "no such words in any text at all, none of them occurs here"),
             (7, None), (8, "..."), (5, " ".join(long_[:12])), (5, "two WORDS")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = plain.leaks(rows(), items)
    for block in (8 << 20, 30):  # one block, and one block per item
        out = decontaminate.contamination(docs, benchmark, block_bytes=block).collect()
        assert {r.doc_id: tuple(r[1:6]) for r in out} == expected
    clean = decontaminate.decontaminate(docs, benchmark)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.select("doc_id").collect()} == {d for d, x in expected.items() if not x[4]}


def test_decontamination_longest_match_and_empty_tables(spark, empty):
    words = [f"w{i}" for i in range(60)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    table = spark.createDataFrame([(1, "a b " + " ".join(words[5:40]) + " c " + " ".join(words[:12]))], "doc_id long, text string")
    out, state = decontaminate.scan(table, items, places=True)
    found = {(p["start"], p["length"]) for p in out.first()[state]["places"]}
    assert found == {(2, 35), (38, 12)}
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(table, none).first().n_hit == 0
    assert decontaminate.contamination(empty, items).count() == 0


def test_line_dedup(spark, docs):
    expected = plain.kept_lines(rows())
    assert any(n for _, n, _ in expected.values())
    for filter_bytes in (64 << 20, 1):  # a saturated filter only suspects more lines
        out = line_dedup.dedup_lines(docs, counts=("before", "gone"), filter_bytes=filter_bytes)
        assert out.columns == [*docs.columns, "before", "gone"]
        assert {r.doc_id: (r.before, r.gone, r.text or "") for r in out.collect()} == expected


def test_line_dedup_null_ids_repeated_ids_and_empty(spark, empty):
    table = spark.createDataFrame([(None, LINE)] * 6 + [(1, LINE)] * 6, "doc_id long, text string")
    assert line_dedup.dedup_lines(table).filter(F.col("text") == LINE).count() == 12  # one document at most
    table = spark.createDataFrame([(None, LINE)] + [(i, LINE + "\nx\n" + LINE) for i in range(5)], "doc_id long, text string")
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(table).collect()}
    assert out == {None: "", 0: "x", 1: "x", 2: "x", 3: "x", 4: LINE + "\nx\n" + LINE}
    assert line_dedup.dedup_lines(empty).count() == 0


def test_secret_scan(spark, docs, empty):
    out, spans = secret_scan.find_secrets(docs, rules=secret_scan.BASE_RULES)
    assert spans == "spans_" and "text" not in out.columns
    assert {r.doc_id: [tuple(x) for x in r[spans]] for r in out.collect()} == {d: plain.secrets(t) for d, t in rows()}
    assert secret_scan.find_secrets(empty)[0].count() == 0


def test_trigram_queries():
    q = secret_scan.trigram_query
    assert q("AKIA[A-Z0-9]+") == frozenset([frozenset([b"aki", b"kia"])])
    assert q("[0-9a-f]{24,}") is None and q("ab|cdef") is None
    assert q("(abc|xyz)d") == frozenset([frozenset([b"abc", b"bcd"]), frozenset([b"xyz", b"yzd"])])
    assert q("(?:abcd.*)+x") == frozenset([frozenset([b"abc", b"bcd"])])


def test_trigram_index_is_a_filter_only(spark):
    texts = ["my PassWd : hunter22 ok", "pass wd=hunter22", "api_key=abcdef apikey=\"ghijkl\"", "ſecret=abcdefg", "tok\nen=abcdefg"]
    out, spans = secret_scan.find_secrets(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    assert {r.doc_id: [tuple(x) for x in r[spans]] for r in out.collect()} == {i: plain.secrets(t) for i, t in enumerate(texts)}
    assert np.unique([len(plain.secrets(t)) for t in texts]).tolist() == [0, 1, 2]


def passages():
    """Texts that share passages of 51 to 80 words at other places, texts with
    insertions, and clean ones."""
    rng = random.Random(11)
    word = lambda: f"{rng.choice('abcdefgéß')}{rng.randrange(10_000)}"
    shared = [[word() for _ in range(n)] for n in (51, 60, 80)]
    docs = [[word() for _ in range(rng.randrange(30, 120))] for _ in range(20)]  # clean
    for i in range(24):
        text = [word() for _ in range(rng.randrange(5, 80))]
        at = rng.randrange(len(text))
        docs.append(text[:at] + shared[i % 3] + text[at:])
    edited = list(docs[30])
    edited.insert(len(edited) // 2, "inserted")
    docs.append(edited)
    return [(i, " ".join(x)) for i, x in enumerate(docs)]


def test_gear_hash_and_chunks():
    texts = [t for _, t in rows()[:60]] + [t for _, t in passages()[:10]]
    for limit in (1, 5000):
        for slab in bw.slabs(pa.array(texts), limit):
            s, e, n, first = substring_dedup.chunk_spans(slab)
            for i in range(slab.n):
                own = slice(first[i], first[i + 1])
                begin = slab.offsets[i]
                got = list(zip((s[own] - begin).tolist(), (e[own] - begin).tolist(), n[own].tolist(), strict=True))
                assert got == plain.gear_chunks(texts[slab.first + i])


@pytest.mark.parametrize("filter_bytes", [64 << 20, 1])
def test_substring_dedup(spark, filter_bytes):
    data = passages() + [(1000 + i, t) for i, t in rows()[:70]]
    table = spark.createDataFrame(data, "doc_id long, text string").withColumn("later", F.lit("clash")).withColumn("h", F.lit(1))
    out = substring_dedup.dedup_passages(table.repartition(3), spans="cut", filter_bytes=filter_bytes)
    assert out.columns == [*table.columns, "cut"]
    out = {r.doc_id: r for r in out.collect()}
    expected = plain.without_passages(data)
    assert {d: (sum(x.words for x in r.cut), r.text or "") for d, r in out.items()} == expected
    texts = dict(data)
    for i in range(20):
        assert out[i].text == texts[i]  # clean texts stay
    for i in range(23, 44):
        assert expected[i][0] >= 19  # a repeated passage of 51 words or more is caught
    assert len(out[44].text.split()) <= 40  # all but the surroundings of the insertion


def test_substring_dedup_empty_and_null_ids(spark, empty):
    assert substring_dedup.dedup_passages(empty).count() == 0
    text = " ".join(f"w{i}" for i in range(100))
    table = spark.createDataFrame([(None, text), (1, text), (2, None), (3, "")], "doc_id long, text string")
    out = {r.doc_id: r.text for r in substring_dedup.dedup_passages(table).collect()}
    assert out[None] == text and out[1] == "" and out[2] is None and out[3] == ""
