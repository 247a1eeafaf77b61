import os
import tempfile

from pyspark.sql import functions as F

from notelab.sources import io
from notelab.sources import standoff as so


def _write(d, name, text):
    with open(os.path.join(d, name), "w") as f:
        f.write(text)


def test_standoff_fixture(spark):
    d = tempfile.mkdtemp(prefix="notelab-standoff-")
    _write(d, "n1.txt", "12345\nHb 13,7 g/dl\nnext line")
    _write(d, "n1.ann", "T1\tBIO_comp 6 15;16 20\tHb 13,7 g/dl\n#1\tAnnotatorNotes T1\tC001_= 13.7 g_per_dl\n"
                        "A1\tNegation T1 neg\nR1\tlink Arg1:T1 Arg2:T2\n\nT2\tBIO 6 8\tHb\n")
    _write(d, "n2.txt", "77\nrien")
    _write(d, "n2.ann", "")
    rows = sorted(tuple(r) for r in so.read_standoff(spark, d).collect())
    assert rows == [("#1", "C001_= 13.7 g_per_dl", "AnnotatorNotes", "n1.ann", "T1"),
                    ("T1", "Hb 13,7 g/dl", "BIO_comp", "n1.ann", "6 15;16 20"),
                    ("T2", "Hb", "BIO", "n1.ann", "6 8")]
    notes = {r["note_id"]: r for r in so.read_notes(spark, d).collect()}
    assert set(notes) == {"n1.ann", "n2.ann"} and notes["n1.ann"]["header"] == "12345"
    assert notes["n2.ann"]["note_text"] == "77\nrien"
    attrs = so.read_attributes(spark, d).collect()
    assert [(r["ann_id"], dict(r["attributes"])) for r in attrs] == [("T1", {"Negation": "neg"})]
    assert so.check_pairs(spark, d, d).count() == 0


def test_write_then_read_round_trip(spark):
    d = tempfile.mkdtemp(prefix="notelab-rt-")
    m = spark.createDataFrame([("a.ann", 1, 0, 5, "BIO", "ab\ncd", "C1_x"), ("a.ann", 2, 7, 9, "DISO", "zz", None),
                               ("b.ann", 1, 3, 4, "BIO", "q", "")],
                              "source string, k long, s long, e long, label string, term string, annotation string")
    so.write_standoff(so.standoff_lines(m, annotation="annotation"), d + "/ann")
    back = sorted(tuple(r) for r in so.read_standoff(spark, d + "/ann", glob="part-*").collect())
    # a mention text with a line break spans two file lines; the line reader
    # keeps the first part (the span keeps both fragments)
    assert back == [("#1", "C1_x", "AnnotatorNotes", "a.ann", "T1"), ("T1", "ab", "BIO", "a.ann", "0 2;3 5"),
                    ("T1", "q", "BIO", "b.ann", "3 4"), ("T2", "zz", "DISO", "a.ann", "7 9")]
    so.write_notes(spark.createDataFrame([("a.ann", "x\ny")], "source string, note_text string"), d + "/txt")
    n = so.read_notes(spark, d + "/txt", glob="part-*").collect()
    assert n[0]["note_id"] == "a.ann" and n[0]["note_text"] == "x\ny\n"


def test_jsonl_defaults(spark):
    d = tempfile.mkdtemp(prefix="notelab-jsonl-")
    _write(d, "notes.jsonl", '{"note_text": "abc", "note_id": "1"}\n'
                             '{"note_text": "de", "note_id": "2", "entities": [{"start": 0, "end": 1, "label": "X"}],'
                             ' "context": {"k": "v"}, "split": "train"}\n')
    r = {x["note_id"]: x for x in io.read_notes_jsonl(spark, d).collect()}
    assert r["1"]["entities"] == [] and r["1"]["context"] == {} and r["1"]["split"] is None
    assert r["2"]["entities"][0]["label"] == "X"


def test_metrics_keys(spark):
    out = io.metrics_row(spark, {"Overall F1/Score": 0.5, "Macro Recall": 1})
    assert sorted(out.columns) == ["macro_recall", "overall_f1_score"]
