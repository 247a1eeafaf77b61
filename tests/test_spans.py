from pyspark.sql import functions as F

from notelab.operators import spans


def _mentions(spark, rows):
    return spark.createDataFrame(rows, "source string, k long, s long, e long, label string, term string")


def test_crop_cases(spark):
    text = "abcdefghijklmnopqrstuvwxyz"
    rows = [
        # key 1: no inner mention
        ("n1", 1, 0, 10, "BIO_comp", text[0:10]),
        # key 2 [10, 20): two unsorted, one nested, one touching at the end
        ("n1", 2, 10, 20, "BIO_comp", text[10:20]),
        ("n1", 10, 16, 18, "BIO", text[16:18]),
        ("n1", 11, 11, 13, "BIO", text[11:13]),
        ("n1", 12, 11, 12, "BIO", text[11:12]),
        ("n1", 13, 20, 24, "BIO", text[20:24]),
        ("n1", 14, 12, 14, "DISO", text[12:14]),
        # key 3: the (0, 0) sentinel: a zero-length key at 0 touching an inner mention at 0
        ("n2", 3, 0, 0, "BIO_comp", ""),
        ("n2", 20, 0, 3, "BIO", "abc"),
    ]
    out = {r["k"]: r for r in spans.remove_inner_labels(_mentions(spark, rows)).collect()}
    assert out[1]["term_labels_removed"] == text[0:10]
    assert out[1]["terms_linked_to_measurement"] == []
    # crops [11,13) and [16,18) removed, touching [20,20) removes nothing
    assert out[2]["term_labels_removed"] == "k" + "nop" + "st"
    assert out[2]["terms_linked_to_measurement"] == ["qr", "lm", "l", "uvwx"]
    assert out[3]["terms_linked_to_measurement"] == []


def test_merge_segments(spark):
    df = spark.createDataFrame([([(10, 15), (2, 5), (4, 7), (20, 21), (7, 8)],)], "seg array<struct<cs:bigint,ce:bigint>>")
    got = df.select(spans.merge_segments(F.col("seg")).alias("m")).collect()[0]["m"]
    assert [(x["cs"], x["ce"]) for x in got] == [(2, 8), (10, 15), (20, 21)]


def test_binned_join_equals_plain_join(spark):
    rows_l = [("a", i, i * 7 % 300, i * 7 % 300 + (i % 40)) for i in range(200)]
    rows_r = [("a", j, j * 11 % 300, j * 11 % 300 + (j % 25)) for j in range(150)]
    left = spark.createDataFrame(rows_l, "source string, k long, s long, e long")
    right = spark.createDataFrame(rows_r, "source string, k2 long, s2 long, e2 long")
    for closed in (True, False):
        for b in (8, 64, 1000):
            got = spans.overlap_join(left, right, ["source"], ("s", "e"), ("s2", "e2"), closed, bin_size=b)
            got = sorted((r["k"], r["k2"]) for r in got.collect())
            want = sorted((l[1], r[1]) for l in rows_l for r in rows_r
                          if (min(l[3], r[3]) >= max(l[2], r[2]) if closed else min(l[3], r[3]) > max(l[2], r[2])))
            assert got == want


def test_halfopen_subset_of_closed(spark):
    rows = [("a", i, i * 3, i * 3 + 6) for i in range(50)]   # spans i and i+2 touch
    l = spark.createDataFrame(rows, "source string, k long, s long, e long")
    r = spark.createDataFrame(rows, "source string, k2 long, s2 long, e2 long")
    c = {(x["k"], x["k2"]) for x in spans.overlap_join(l, r, ["source"], ("s", "e"), ("s2", "e2"), True).collect()}
    h = {(x["k"], x["k2"]) for x in spans.overlap_join(l, r, ["source"], ("s", "e"), ("s2", "e2"), False).collect()}
    assert h <= c and c != h
    assert {(b, a) for a, b in c} == c   # symmetric
