"""Sections by a heading table, nested knowledge and cohorts."""

from notelab.operators import knowledge as kn
from notelab.operators import sections as sc

NOTE = ("Patient 12\nMOTIF D’HOSPITALISATION : fièvre\nAntécédents\n  lupus.\nexamens  complémentaires:\nconclusion du jour\n"
        "Conclusion: retour\nRemarque : rien")


def sections(spark, rows, headings=None):
    notes = spark.createDataFrame(rows, "note string, text string")
    out = sc.detect_sections(notes, "note", "text", headings or sc.section_headings(spark))
    return sorted(tuple(r) for r in out.select("note", "start", "end", "section").collect())


def test_headings_by_table(spark):
    found = sections(spark, [("a", NOTE), ("b", "no heading"), ("c", None), ("d", "")])
    starts = [NOTE.index(x) for x in ("MOTIF", "Antéc", "examens", "Conclusion:")] + [len(NOTE)]
    labels = ["SECTION_motif", "SECTION_antecedent", "SECTION_examen_complementaire", "SECTION_conclusion"]
    assert found == [("a", starts[i], starts[i + 1], label) for i, label in enumerate(labels)]


def test_own_headings_equal_ones_take_the_least_label(spark):
    table = spark.createDataFrame([("Remarque", "SECTION_b"), ("REMARQUE", "SECTION_a"), (None, "SECTION_x")],
                                  "heading string, section string")
    assert sections(spark, [("a", NOTE)], table) == [("a", NOTE.index("Remarque"), len(NOTE), "SECTION_a")]
    assert sections(spark, [("a", NOTE)], table.limit(0)) == []


BODY = """{"CIM10": ["M1", "M2", null, "M1"], "labs": {"CRP": ["L1"], "DFG": []},
 "concepts": {"all": {"CRP": ["C1", "C2"]}, "Examens complementaires": {"DFG": ["C3"]}, "autre chose": {"DFG": [7]}}}"""


def knowledge(spark, rows):
    entries = spark.createDataFrame(rows, "disease string, body string")
    return kn.knowledge_rows(entries, sc.section_headings(spark))


def test_nested_knowledge(spark):
    rows = knowledge(spark, [("lupus", BODY), ("sapl", None), ("sapl", "{"), ("sapl", "{}"), ("sapl", "[]"), ("sapl", '["M9"]'), ("sapl", "7"),
                             ("sapl", '{"CIM10": []}'), ("sapl", '{"CIM10": ["D6"]}')]).collect()
    assert {tuple(r) for r in rows} == {
        ("lupus", "CIM10", None, None, "M1"), ("lupus", "CIM10", None, None, "M2"), ("lupus", "labs", None, "CRP", "L1"),
        ("lupus", "concepts", None, "CRP", "C1"), ("lupus", "concepts", None, "CRP", "C2"),
        ("lupus", "concepts", "SECTION_examen_complementaire", "DFG", "C3"),
        ("lupus", "concepts", "autre chose", "DFG", "7"), ("sapl", "CIM10", None, None, "D6")}
    assert len(rows) == 8


def test_codes_of_one_section_count_there_only(spark):
    kb = knowledge(spark, [("lupus", BODY)])
    text = "Antécédents\ndfg crp\nExamens complémentaires\ndfg et crp"
    notes = spark.createDataFrame([("a", text)], "note string, text string")
    terms = spark.createDataFrame([("DFG", "C3"), ("CRP", "C1")], "term string, code string")
    mentions = sc.tag_mentions(notes, terms, ["note"], "text").selectExpr("note", "s", "e", "term", "array(code, 'C2', code) codes")
    secs = sc.detect_sections(notes, "note", "text", sc.section_headings(spark))
    stats = sc.section_stats(mentions, secs, kn.concepts(kb, "concepts"), "note")
    assert sorted((r.section, r.analyte, r.terms) for r in stats.collect()) == [
        ("SECTION_antecedent", "CRP", ["CRP", "DFG"]), ("SECTION_examen_complementaire", "CRP", ["CRP", "DFG"]),
        ("SECTION_examen_complementaire", "DFG", ["DFG"])]


def test_cohorts(spark):
    kb = knowledge(spark, [("lupus", BODY), ("sapl", '{"CIM10": ["M2"]}')])
    evidence = spark.createDataFrame(
        [("a", "CIM10", None, "M2"), ("a", "labs", None, "L1"), ("a", "labs", None, "L1"), ("b", "concepts", None, "C3"),
         ("c", "concepts", "SECTION_examen_complementaire", "C3"), ("d", "labs", None, "C1"), ("e", None, None, None)],
        "note string, kind string, section string, code string")
    found = kn.cohort_by_disease(evidence, kb, "note").collect()
    assert sorted((r.disease, r.note, r.kinds) for r in found) == [
        ("lupus", "a", ["CIM10", "labs"]), ("lupus", "c", ["concepts"]), ("sapl", "a", ["CIM10"])]
    assert kn.cohort_by_disease(evidence.limit(0), kb, "note").count() == 0
