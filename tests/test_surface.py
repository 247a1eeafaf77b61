"""Row expressions, the table function, the registry, parallel map."""

import pytest
from pyspark.errors import AnalysisException

from notelab.functions import table_functions as tf
from notelab.operators import sections as sc
from notelab.plans import normalize


def notes(spark):
    return spark.createDataFrame([(1, "vu le 3/1/2020, 2,5 mg"), (2, ""), (3, None), (4, "x" * 50_000 + " 7")], "id int, text string")


def test_table_function_returns_chosen_groups_and_extensions(spark):
    out = tf.note_spans(notes(spark), "text", ["dates", "numbers"], ["norm"])
    assert out.columns == ["id", "text", "group", "start", "end", "lexical_variant", "norm"]
    rows = sorted((r["id"], r["group"], r["start"], r["lexical_variant"], r["norm"]) for r in out.collect())
    assert rows == [(1, "dates", 6, "3/1/2020", "2020-01-03"), (1, "numbers", 6, "3", None), (1, "numbers", 8, "1", None),
                    (1, "numbers", 10, "2020", None), (1, "numbers", 16, "2,5", None), (4, "numbers", 50_001, "7", None)]


def test_table_function_in_sql(spark):
    notes(spark).createOrReplaceTempView("surface_notes")
    spark.udtf.register("note_spans", tf.span_function(tf.TAGGERS, tf.EXTENSIONS))
    rows = spark.sql("select n.id, x.value from surface_notes n, lateral note_spans(n.text, 'numbers', 'value') x where n.id = 4").collect()
    assert [tuple(r) for r in rows] == [(4, 7.0)]
    with pytest.raises(AnalysisException, match="unknown span group: nothing"):
        spark.sql("select * from surface_notes n, lateral note_spans(n.text, 'nothing', '') x").collect()


def test_own_tagger_plugs_in(spark):
    out = sc.tag_with(notes(spark), "text", {"drug": tf.regex_tagger(r"\bmg\b")}, ["drug"])
    assert [(r["id"], r["start"], r["end"]) for r in out.collect()] == [(1, 20, 22)]


def test_registry_composes_components(spark):
    synonyms = spark.createDataFrame([("doliprane", "N02BE01")], "synonym string, code string")
    lines = spark.createDataFrame([(1, "dolipranes", "5 mg 1-0-1"), (2, "autre", None)], "id int, drug string, text string")
    run = normalize.pipeline([("doses", {}), ("frequencies", {}), ("drugs_normalizer", {"text": "drug", "synonyms": synonyms})])
    rows = {r["id"]: r for r in run(lines).collect()}
    assert (rows[1]["drug_code"], rows[1]["doses"][0]["value"], rows[1]["frequencies"][0]["value"]) == ("N02BE01", 5.0, 2.0)
    assert rows[2]["drug_code"] is None
    assert set(normalize.COMPONENTS) >= {"doses", "frequencies", "clean-entities", "drugs_normalizer"}


def test_rows(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, None)], "id int, xs array<int>")
    out = tf.row_expressions(df, {"twice": "transform(xs, x -> 2 * x)", "n": "size(twice)"})
    out = tf.parallel_map(out, lambda i, xs: i + len(xs) if xs is not None else None, ["id", "xs"], "sum", "int")
    assert [(r["twice"], r["sum"]) for r in out.orderBy("id").collect()] == [([2, 4], 3), (None, None)]


def test_concat_lists_keep_order_and_nulls(spark):
    from notelab.operators.evaluation import concat_lists

    rows = [("n", "t", 3, "c", ["z"]), ("n", "t", 1, None, ["x", "y"]), ("n", "t", 2, "b", None), ("n", None, 1, "d", [])]
    df = spark.createDataFrame(rows, "source string, term string, k int, des string, found array<string>").repartition(3)
    got = {r["term"]: tuple(r)[2:] for r in concat_lists(df, ["source", "term"], "k", ["k"], ["des"], ["found"]).collect()}
    assert got == {"t": (1, [None, "b", "c"], ["x", "y", "z"]), None: (1, ["d"], [])}
    assert concat_lists(df.filter("false"), ["source"], "k", ["k"], ["des"], ["found"]).count() == 0
