"""The phrase matcher against plain Python, and its edge cases."""

import random
import re
import unicodedata

from notelab.operators import sections as sc
from notelab.operators.corpus import resolve_overlaps


def fold(text):
    return "".join(unicodedata.normalize("NFKD", c)[0] for c in text.lower())


def plain_matches(text, terms):
    words = [(m.start(), m.end(), m[0]) for m in re.finditer("[a-z0-9]+", fold(text))]
    folded = {tuple(re.findall("[a-z0-9]+", fold(t))) for t in terms if t} - {()}
    return {(words[i][0], words[i + n - 1][1], " ".join(x[2] for x in words[i:i + n]))
            for i in range(len(words)) for n in {len(f) for f in folded} if i + n <= len(words)
            and tuple(x[2] for x in words[i:i + n]) in folded}


def greedy(found):
    kept = []
    for s, e, folded in sorted(found, key=lambda x: (x[0] - x[1], x[0])):
        if all(min(e, b) <= max(s, a) for a, b, _ in kept):
            kept.append((s, e, folded))
    return set(kept)


def test_random_texts_equal_plain_search(spark):
    rng = random.Random(7)
    words = ["a", "b", "é", "c1", "D"]
    terms = [" ".join(rng.choice(words) for _ in range(n)) for n in (1, 2, 2, 3, 4, 5, 6, 7)]
    notes = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 60)))) for i in range(40)]
    df = spark.createDataFrame(notes, "id int, text string")
    table = spark.createDataFrame([(t, f"C{i}") for i, t in enumerate(terms)], "term string, code string")
    every, kept = sc.phrase_matches(df, table, ["id"], "text"), sc.tag_mentions(df, table, ["id"], "text")
    got, got_kept = {}, {}
    for r in every.collect():
        got.setdefault(r["_note"]["id"], set()).add((r["s"], r["e"], fold(r["term"])))
    for r in kept.collect():
        got_kept.setdefault(r["id"], set()).add((r["s"], r["e"], fold(r["term"])))
    for i, text in notes:
        assert got.get(i, set()) == plain_matches(text, terms)
        assert got_kept.get(i, set()) == greedy(plain_matches(text, terms))


def test_nulls_empty_repeated_terms_and_a_long_note(spark):
    notes = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "rien", "x"), (4, "mot " * 20_000 + "Acide-urique bas", "x")],
                                  "id int, text string, term string")
    table = spark.createDataFrame([("acide urique", "B"), ("ACIDE  URIQUE", "A"), (None, "N"), ("--", "P")], "term string, code string")
    rows = sc.tag_mentions(notes, table, ["id"], "text").collect()
    assert [(r["id"], r["s"], r["e"], r["term"], r["code"]) for r in rows] == [(4, 80_000, 80_012, "ACIDE  URIQUE", "A")]
    assert sc.tag_mentions(notes, table.where("false"), ["id"], "text").count() == 0
    assert sc.tag_mentions(notes.where("false"), table, ["id"], "text").count() == 0


def test_resolution_keeps_other_columns(spark):
    rows = [("n", 1, 0, 4, {"a": "1"}), ("n", 2, 3, 9, {"b": "2"}), ("n", 3, 9, 10, None), ("n", 4, None, None, None),
            (None, 5, 0, 1, {})]
    df = spark.createDataFrame(rows, "source string, k int, s int, e int, attributes map<string,string>")
    out = resolve_overlaps(df)
    assert out.columns == df.columns
    assert sorted(r["k"] for r in out.collect()) == [2, 3, 4, 5]
    assert {r["k"]: r["attributes"] for r in out.collect()}[2] == {"b": "2"}


def test_only_likely_runs_leave_their_task(spark):
    # a word that begins a term is no reason to send what follows it
    notes = spark.createDataFrame([(i, "acide bas " * 400 + f"acide urique {i}") for i in range(20)], "id int, text string")
    table = spark.createDataFrame([("acide urique", "A"), ("bas debit renal", "B")], "term string, code string")
    found = sc.phrase_matches(notes, table, ["id"], "text")
    assert found.count() == 20
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "_ahead" not in plan


def test_run_hashes_and_filter_agree():
    import numpy as np
    import pyarrow as pa
    from notelab.functions.runs import likely_runs, whole_hashes

    class Exactly:
        def __init__(self, h):
            self.h = h

        def may_have(self, h):
            return np.isin(h, self.h)

    terms = pa.RecordBatch.from_arrays([pa.array([[5, 6], [7], [], [6, 5, 7]], pa.list_(pa.int64()))], ["_h"])
    h = next(whole_hashes(iter([terms]))).column(0).to_numpy()
    assert len(set(h.tolist())) == 4
    letters = {5: "e", 6: "f", 7: "g"}
    notes = [[5, 6, 5, 7], None, [], [6], [5, 6]]
    words = [None if n is None else [{"start": 2 * i, "m": letters[x]} for i, x in enumerate(n)] for n in notes]
    batch = pa.RecordBatch.from_arrays([pa.array(list(range(5))), pa.array(words, pa.list_(pa.struct([("start", pa.int32()), ("m", pa.string())]))),
                                        pa.array(notes, pa.list_(pa.int64()))], ["n", "w", "h"])
    out = [tuple(r.values()) for b in likely_runs(Exactly(h), [1, 2, 3])(iter([batch])) for r in b.to_pylist()]
    assert sorted(out) == [(0, 0, 3, "e f"), (0, 2, 7, "f e g"), (0, 6, 7, "g"), (4, 0, 3, "e f")]


def test_resolution_moves_each_column_once(spark):
    df = spark.createDataFrame([("n", 1, 0, 4, "x"), ("n", 2, 3, 9, "y"), ("m", 1, 0, 1, "z")], "source string, k int, s int, e int, term string")
    out = resolve_overlaps(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "named_struct(source" not in plan
    assert sorted(map(tuple, out.collect())) == [("m", 1, 0, 1, "z"), ("n", 2, 3, 9, "y")]
