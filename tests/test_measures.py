import re

from pyspark.sql import functions as F

from notelab.operators import measures as ms
from notelab.plans import lab_results


def _measures(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(F.explode(ms.all_measures(F.col("t"))).alias("m")).select("m.*").collect()


def _fmt(rows):
    return [(r["value_range"], r["value"], r["unit"]) for r in rows]


def test_simple_measures(spark):
    assert _fmt(_measures(spark, "Hb 13.7 g/dl")) == [("=", 13.7, "g_per_dl")]
    assert _fmt(_measures(spark, "CRP < 5 mg/l")) == [("<", 5.0, "mg_per_l")]
    assert _fmt(_measures(spark, "créatinine inférieure à 80 µmol/l")) == [("<", 80.0, "umol_per_l")]


def test_offsets_are_original(spark):
    text = "Hémoglobine : 13,7 g/dl le 12/03/2020"
    r = _measures(spark, text)
    assert len(r) == 1 and text[r[0]["start"]:r[0]["end"]] == "13,7 g/dl" == r[0]["lexical_variant"]


def test_unitless(spark):
    assert _fmt(_measures(spark, "poids 72")) == [("=", 72.0, "kg")]
    assert _fmt(_measures(spark, "poids 2500")) == [("=", 2500.0, "g")]
    assert _fmt(_measures(spark, "taille 1,75")) == [("=", 1.75, "m")]
    assert _fmt(_measures(spark, "taille 175")) == [("=", 175.0, "cm")]
    assert _fmt(_measures(spark, "imc 24")) == [("=", 24.0, "kg_per_m2")]
    # a number that already has a unit is not read again as unit-less
    assert _fmt(_measures(spark, "poids 72 kg")) == [("=", 72.0, "kg")]


def test_valueless(spark):
    assert _fmt(_measures(spark, "anti-Sm negatif")) == [("=", 0.0, "bool")]
    assert _fmt(_measures(spark, "anticorps pos")) == [("=", 1.0, "bool")]
    assert _fmt(_measures(spark, " +")) == [("=", 1.0, "bool")]
    assert _fmt(_measures(spark, "normal")) == [("=", 0.5, "bool")]


def test_dates_are_not_measures(spark):
    df = spark.createDataFrame([("n", "vu le 12/03/2020 et le 31/02/2020")], "k string, t string")
    d = ms.detect_dates(df, ["k"], F.col("t")).collect()
    assert [str(r["date"]) for r in d] == ["2020-03-12"]
    assert _measures(spark, "vu le 12/03/2020") == []


def test_tables(spark):
    note = "titre\nHb | 13,7 | g/dl\nCRP | 5 | mg/l\nfin"
    df = spark.createDataFrame([("n", note)], "source string, note_text string")
    t = ms.extract_table_measures(df).select("m.*").collect()
    assert [(r["value"], r["unit"], note[r["start"]:r["end"]]) for r in t] == [
        (13.7, "g_per_dl", "13,7 | g/dl"), (5.0, "mg_per_l", "5 | mg/l")]
    assert ms.detect_tables(df).collect()[0]["n_table_lines"] == 2


def _spoken(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(F.explode(ms.extract_measures(F.col("t"), spoken=True)).alias("m"))
    return [(r["value_range"], r["value"], r["unit"], r["lexical_variant"]) for r in df.select("m.*").collect()]


def test_number_words_and_ranges(spark):
    assert _spoken(spark, "trois g de sucre") == [("=", 3.0, "g", "trois g")]
    assert _spoken(spark, "5 à 7 mmol/l") == [(">=", 5.0, "mmol_per_l", "5 à 7 mmol/l"), ("<=", 7.0, "mmol_per_l", "5 à 7 mmol/l")]
    assert _spoken(spark, "vingt et un g") == [("=", 21.0, "g", "vingt et un g")]
    assert _spoken(spark, "quatre-vingt-dix-sept mg") == [("=", 97.0, "mg", "quatre-vingt-dix-sept mg")]
    assert [x[:2] for x in _spoken(spark, "entre deux et trois cents mg")] == [(">=", 2.0), ("<=", 300.0)]
    assert [x[:2] for x in _spoken(spark, "1,5-2 g")] == [(">=", 1.5), ("<=", 2.0)]
    assert [x[:2] for x in _spoken(spark, "9 a 7 g, inférieur à 2 a 3 g, le 12/03/2020 4 g")] == [("=", 7.0), ("<", 3.0), ("=", 4.0)]
    assert _spoken(spark, "") == [] and _spoken(spark, "un deux trois") == []


def test_spoken_reads_what_the_plain_grammar_reads(spark):
    text = "Hb 13,7 g/dl ; CRP < 5 mg/l, ASAT 12345678901234567890 UI"
    df = spark.createDataFrame([(text,), (None,)], "t string")
    for r in df.select(ms.extract_measures(F.col("t")).alias("a"), ms.extract_measures(F.col("t"), spoken=True).alias("b")).collect():
        assert r["a"] == r["b"]


def test_encoded_terms_against_plain_counts(spark):
    """Unit vectors of hashed gram counts, zeros for null; counted by batch, not by a fold of
    ``dim`` steps a gram."""
    import hashlib
    import math
    from notelab.operators import similarity as sim
    rows = [(0, "glycemie"), (1, None), (2, ""), (3, "aaaaaaaa"), (4, "œdème"), (5, None), (6, "un deux trois quatre")]
    encoded = spark.createDataFrame(rows, "id int, t string").select("id", sim.encode_terms(F.col("t")).alias("v"))
    assert "aggregate(" not in encoded._jdf.queryExecution().analyzed().toString()
    for r in encoded.collect():
        t = rows[r.id][1]
        if t is None:
            assert r.v == [0.0] * 64
            continue
        p = f"##{t}##"
        counts = [0.0] * 64
        for g in {p[i:i + 3] for i in range(len(p) - 2)}:
            counts[int(hashlib.md5(g.encode()).hexdigest()[:8], 16) % 64] += 1
        norm = max(math.sqrt(sum(c * c for c in counts)), 1e-12)
        assert r.v == [c / norm for c in counts]


def test_all_measures_is_the_three_readers_together(spark):
    texts = ["", "+", "p", " - ", "poids 70", "poids 70 kg", "Glucose 5 mg/dl", "négatif", "+  3 g", "é 3 µg/l, 4 g", "pos 3 g neg 4 mg taille 2",
             "taille 170 12/03/2020 3 g par l", "a < 3,5 g/l", "inférieur à 3 mmol", "3 g 4 g 5 g 6 g", "IMC : 22 normal", "PoS", "3 mg | 4 %", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    t = F.col("t")
    apart = F.array_sort(F.concat(ms.merge_unitless(ms.extract_measures(t), ms.unitless_candidates(t)), ms.valueless_measures(t)),
                         lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["end"] - b["end"]))
    for row in df.select("t", ms.all_measures(t).alias("once"), apart.alias("apart")).collect():
        assert row.once == row.apart, row.t
    got = {r.t: r.m for r in df.select("t", F.transform(ms.all_measures(t), ms.format_measure).alias("m")).collect()}
    assert got["pos 3 g neg 4 mg taille 2"] == ["= 1.0 bool", "= 3.0 g", "= 0.0 bool", "= 4.0 mg", "= 2.0 m"]
    assert got["é 3 µg/l, 4 g"] == ["= 3.0 ug_per_l", "= 4.0 g"] and got["a < 3,5 g/l"] == ["< 3.5 g_per_l"]
    assert got["+"] == ["= 1.0 bool"] and got[""] == [] and got[None] is None


def test_offsets_of_one_two_and_more_matches(spark):
    df = spark.createDataFrame([("",), ("x",), ("ab1",), ("a1bc22d",), ("1é22x333y",), ("1" * 5,)], "t string")
    for groups in ((), (1,)):
        for r in df.select("t", ms.find_all(F.col("t"), "(1+|2+|3+)", groups).alias("m")).collect():
            assert [(x.start, x.m) for x in r.m] == [(m.start(), m[0]) for m in re.finditer("1+|2+|3+", r.t)]


def test_lab_results_crop_the_texts_once(spark):
    mentions = spark.createDataFrame([("n", 2, 0, 14, "BIO_comp", "sodium 5 mg/dl"), ("n", 3, 0, 6, "BIO", "sodium"),
                                      ("n", 4, 15, 28, "BIO_comp", "a | 3 mg | 4"), ("n", 6, 29, 41, "BIO_comp", "b | 5 mg | 6"),
                                      ("n", 8, 42, 45, "BIO_comp", "xyz")],
                                     "source string, k bigint, s bigint, e bigint, label string, term string")
    notes = spark.createDataFrame([("n", "sodium 5 mg/dl\na | 3 mg | 4 \nb | 5 mg | 6\nxyz")], "source string, note_text string")
    out = lab_results.extract_lab_results(mentions, notes)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("collect_list(_crop") == 1
    assert {r.k: (r.terms_linked_to_measurement, r.found) for r in out.collect()} == {
        2: (["sodium"], ["= 5.0 mg_per_dl"]), 4: (["a |  | 4"], ["= 3.0 mg"]), 6: (["b |  | 6"], ["= 5.0 mg"])}
    only = lab_results.extract_lab_results(mentions, notes, only_tables=True)
    assert sorted(r.k for r in only.collect()) == [4, 6]
