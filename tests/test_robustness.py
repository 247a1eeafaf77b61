"""Values that must not abort a job or be misread, and outcomes that must
not be vacuous."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE

from notelab.functions import text as tx
from notelab.operators import corpus as cp
from notelab.operators import evaluation as ev
from notelab.operators import measures as ms
from notelab.operators import prescriptions as rx
from notelab.plans.catalog import QUERIES


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def test_number_text_is_pythons(spark):
    rng = random.Random(1)
    values = [0.0, 5.0, -13.7, 4e-7, 0.0001, 0.00012345, 1e7, 12345678.5, 123456789012345678.0, 1e16, 9999999999999998.0,
              1e22, -2.5e-10, 1e300, 0.1 + 0.2]
    values += [round(rng.uniform(-1, 1) * 10 ** rng.randrange(-3, 12), rng.randrange(6)) for _ in range(100)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r.x for r in df.select(tx.number_text(F.col("v")).alias("x")).collect()] == [repr(v) for v in values]


def test_long_and_tiny_numbers_do_not_abort(spark):
    df = texts(spark, ["glucose 123456789012345678 mg", "0,0000004 g", "glucose 5 mg"])
    out = df.select(F.transform(ms.extract_measures(F.col("t")), ms.format_measure).alias("m")).collect()
    assert [r.m for r in out] == [["= 1.2345678901234568e+17 mg"], ["= 4e-07 g"], ["= 5.0 mg"]]


def test_dates_are_no_values(spark):
    df = texts(spark, ["le 12/03/2020 g", "le 12/03/2020 poids 3 g/l", "1/2/2021 5 mg"])
    out = df.select(F.transform(ms.extract_measures(F.col("t")), ms.format_measure).alias("m")).collect()
    assert [r.m for r in out] == [[], ["= 3.0 g_per_l"], ["= 5.0 mg"]]


def test_zero_divisors_are_dropped(spark):
    df = texts(spark, ["tous les 0 jours", "tous les 2 jours"])
    out = df.select(F.transform(rx.frequencies(F.col("t")), lambda x: x["value"]).alias("v")).collect()
    assert [r.v for r in out] == [[], [0.5]]


def test_full_classification_pools_golds(spark):
    gold = spark.createDataFrame([("a", 1, 0, 10, "C1_= 3.0 g_per_l"), ("a", 2, 8, 20, "C2_= 4.0 g_per_l"), ("a", 3, 50, 60, "C3_= 1.0 g"),
                                  ("a", 4, 70, 80, "p:C3")], "source string, k int, s int, e int, annotation string")
    pred = spark.createDataFrame([
        ("a", 1, 1, 5, ["C1"], ["= 3000.0 mg_per_l"]),      # one gold, same measure in another unit
        ("a", 2, 8, 10, ["C1"], ["= 3.0 g_per_l"]),         # two golds, one of two measures
        ("a", 3, 8, 10, ["C2"], ["= 4.0 g_per_l", "= 3.0 g_per_l"]),
        ("a", 4, 30, 40, ["C1"], ["= 3.0 g_per_l"]),        # no gold
        ("b", 1, 0, 10, ["C1"], ["= 3.0 g_per_l"])],
        "source string, k int, s int, e int, codes array<string>, found array<string>")

    def equal(found, gold_):
        return ms.measures_equal(F.transform(found, ms.parse_measure), F.transform(gold_, ms.parse_measure))

    out = {(r.source, r.side, r.k): r.outcome for r in ev.classify_full(gold, pred, equal).collect()}
    assert out == {("a", "pred", 1): "TP", ("a", "pred", 2): "FP", ("a", "pred", 3): "TP", ("a", "pred", 4): "FP",
                   ("b", "pred", 1): "FP", ("a", "gold", 3): "FN"}


def test_evaluation_queries_are_not_vacuous(spark):
    r = QUERIES["E04_prf"](spark, SMOKE).first()
    assert r.tp > 0 and r.fp > 0 and r.fn > 0
    assert all(0 < r[c] < 1 for c in ("precision", "recall", "f1"))
    assert QUERIES["E03_any_measure_match"](spark, SMOKE).first().n_tp > 0
    assert {x.equal for x in QUERIES["X18_measures_equal"](spark, SMOKE).select("equal").distinct().collect()} == {True, False}


def test_bootstrap_does_not_depend_on_batches(spark):
    outcomes = spark.createDataFrame([("TP",)] * 60 + [("FP",)] * 30 + [("FN",)] * 10, "outcome string")
    first = sorted(map(tuple, ev.bootstrap_multinomial(outcomes, 3000, slices=2).collect()))
    assert first == sorted(map(tuple, ev.bootstrap_multinomial(outcomes, 3000, slices=7).collect()))
    exact = {r.metric: r.mean for r in ev.bootstrap_exact(outcomes, 300).collect()}
    assert all(abs(exact[m] - v) < 0.02 for m, v, *_ in first)


def reference_chunks(text, max_len):
    """Buffers of whole sentences; a sentence over the limit is cut, alone."""
    import re
    out, buffer = [], []
    for m in re.finditer(r"[^.!?\n]+[.!?]*", text):
        words = m[0].split()
        if len(words) > max_len:
            out += [buffer] if buffer else []
            buffer = []
            out += [words[i: i + max_len] for i in range(0, len(words), max_len)]
        elif buffer and len(buffer) + len(words) > max_len:
            out, buffer = [*out, buffer], words
        else:
            buffer = buffer + words
    return [*out, buffer] if buffer else out


@pytest.mark.parametrize("max_len", [1, 5, 8])
def test_chunks_cut_long_sentences(spark, max_len):
    rng = random.Random(2)
    values = [" ".join(f"w{i}" for i in range(20)), "", "a b. c d e f g h i j k l. m n"]
    values += ["".join(rng.choice(["a ", "bb ", "c. ", "d!\n", "\n", "e? "]) for _ in range(60)) for _ in range(20)]
    out = texts(spark, values).select("t", cp.chunk_bounds(F.col("t"), max_len).alias("c")).collect()
    for r in out:
        assert [w for w in (r.t[c.start: c.end].split() for c in r.c) if w] == reference_chunks(r.t, max_len)


def test_overlaps_resolved_in_islands(spark):
    rng = random.Random(3)
    rows = [("hot" if i < 300 else f"n{i % 7}", i, s, s + rng.randrange(1, 30), "L") for i in range(400) for s in [rng.randrange(900)]]
    kept = {}
    for note in {r[0] for r in rows}:
        own = []
        for r in sorted((r for r in rows if r[0] == note), key=lambda r: (r[2] - r[3], r[2], r[3], r[1])):
            if all(min(r[3], o[3]) <= max(r[2], o[2]) for o in own):
                own.append(r)
        kept[note] = {r[1] for r in own}
    out = cp.resolve_overlaps(spark.createDataFrame(rows, "source string, k int, s int, e int, label string")).collect()
    assert {n: {r.k for r in out if r.source == n} for n in kept} == kept


def test_positional_split_is_exact(spark):
    out = cp.positional_split(spark.range(1237).withColumnRenamed("id", "doc_id"), "doc_id")
    counts = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert counts == {"train": 989, "test": 124, "val": 124}
