"""Derived tables used by the registered queries.

The given parquet tables are generic (documents, lineitem, part, ...); the
operators work on clinical shapes (mentions with spans, warehouse rows,
terminology tables).  Every derived table below is computed by Spark from
the given tables, so its size grows with theirs.  ``ORACLE_CTES`` holds the
same definitions as DuckDB SQL for the oracle side.

Mention layout (over the whole of every text that is not empty):

* ``d_keys``: one ``BIO_comp`` key mention of up to 30 characters every 50
  characters, ``k = 0 .. (length - 1) div 50``; the last may be shorter.
* ``d_inner``: three inner mentions per key position ``j = 0, 1, 2`` with
  id ``3k + j``: a 6-char and an 8-char mention inside the key, and a
  26-char mention that starts at offset 27..31 (so it overlaps, touches
  or misses the key) and reaches into the next key; all end with the text.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from notelab.session import ensure_checkpoint_dir

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _src(doc_id: Column) -> Column:
    return F.concat(doc_id.cast("string"), F.lit(".ann"))


def _positions(documents: DataFrame) -> DataFrame:
    """One row per 50 characters: the piece of text from there on that its
    mentions can reach (two pieces), not the whole text."""
    cut = documents.where(F.length("text") > 0).select(
        "doc_id", F.regexp_extract_all("text", F.lit("(?s).{1,50}"), F.lit(0)).alias("c"))
    pairs = F.arrays_zip(F.col("c").alias("piece"), F.concat(F.expr("slice(c, 2, size(c))"), F.array(F.lit(""))).alias("after"))
    return cut.select("doc_id", F.posexplode(pairs).alias("k", "x")).select(
        "doc_id", F.col("k").cast("bigint").alias("k"), F.col("x")["piece"].alias("piece"), F.col("x")["after"].alias("after"))


def d_keys(documents: DataFrame) -> DataFrame:
    p = _positions(documents)
    return p.select(
        _src(F.col("doc_id")).alias("source"), "doc_id", "k",
        (F.col("k") * 50).alias("s"), (F.col("k") * 50 + F.least(F.lit(30), F.length("piece"))).alias("e"),
        F.lit("BIO_comp").alias("label"),
        F.substring("piece", 1, 30).alias("term"),
    )


def d_inner(documents: DataFrame) -> DataFrame:
    p = _positions(documents).select(
        "doc_id", F.concat("piece", "after").alias("near"), "k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("j"))
    s = (F.when(F.col("j") == 0, F.col("k") * 50 + (F.col("doc_id") + F.col("k")) % 37)
          .when(F.col("j") == 1, F.col("k") * 50 + (F.col("doc_id") + 3 * F.col("k")) % 41)
          .otherwise(F.col("k") * 50 + 27 + (F.col("doc_id") + F.col("k")) % 5))
    ln = F.when(F.col("j") == 0, 6).when(F.col("j") == 1, 8).otherwise(26)
    lab = (F.when((F.col("doc_id") + 2 * F.col("k") + F.col("j")) % 3 == 0, "BIO")
             .when((F.col("doc_id") + 2 * F.col("k") + F.col("j")) % 3 == 1, "DISO")
             .otherwise("Chemical_and_drugs"))
    term = F.substring(F.col("near"), (s - F.col("k") * 50 + 1).cast("int"), ln)
    q = p.select("doc_id", (3 * F.col("k") + F.col("j")).alias("k"), s.alias("s"), lab.alias("label"), term.alias("term"))
    return q.where(F.length("term") > 0).select(
        _src(F.col("doc_id")).alias("source"), "doc_id", "k", "s",
        (F.col("s") + F.length("term")).alias("e"), "label", "term")


def d_mentions(documents: DataFrame) -> DataFrame:
    """Keys and inner mentions in one mention table (M3 layout)."""
    cols = ["source", "doc_id", "k", "s", "e", "label", "term"]
    keys = d_keys(documents).select(*cols)
    inner = d_inner(documents).select(*cols)
    return keys.unionByName(inner)



# --------------------------------------------------------------------------
# Warehouse, terminology, crosswalk, prescriptions, predictions
# --------------------------------------------------------------------------

def d_docs(orders: DataFrame) -> DataFrame:
    """Warehouse documents: one note per encounter."""
    return orders.select(
        F.col("o_orderkey").alias("encounter_num"), F.col("o_orderdate").alias("start_date_doc"),
        F.col("o_orderpriority").alias("concept_cd"),
        F.concat(F.lit("Patient "), F.col("o_custkey").cast("string"), F.lit(" status "),
                 F.col("o_orderstatus")).alias("observation_blob"))


def d_labs(lineitem: DataFrame) -> DataFrame:
    """Warehouse lab rows (value, unit, date) per encounter."""
    return lineitem.select(
        F.col("l_orderkey").alias("encounter_num"), F.col("l_partkey").alias("concept_cd"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("double")).otherwise(F.col("l_quantity")).alias("nval_num"),
        F.when(F.col("l_returnflag") == "A", "mg").when(F.col("l_returnflag") == "N", "g").alias("units_cd"),
        F.col("l_shipdate").alias("start_date_lab"))


def d_onto(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("c_basecode"),
                       F.concat(F.col("p_type"), F.lit(":"), F.col("p_name"), F.lit("_"),
                                F.col("p_brand")).alias("c_name"))


def _cui(partkey: Column) -> Column:
    return F.concat(F.lit("C"), F.lpad((partkey % 97).cast("string"), 7, "0"))


def d_mrconso(part: DataFrame) -> DataFrame:
    """Terminology strings (CUI, language, source, code, string)."""
    lat = F.when(F.col("p_partkey") % 5 == 0, "FRE").when(F.col("p_partkey") % 5 == 1, "SPA").otherwise("ENG")
    return part.select(_cui(F.col("p_partkey")).alias("CUI"), lat.alias("LAT"), F.col("p_brand").alias("SAB"),
                       F.col("p_partkey").cast("string").alias("CODE"),
                       F.concat(F.col("p_name"), F.lit(" "), F.lower(F.col("p_type"))).alias("STR"))


def d_mrsty(part: DataFrame) -> DataFrame:
    """Semantic type per concept, with the type name."""
    tui = F.concat(F.lit("T"), F.lpad(((F.col("p_partkey") % 97) % 7 + 56).cast("string"), 3, "0"))
    return part.select(_cui(F.col("p_partkey")).alias("CUI"), tui.alias("TUI")).distinct().select(
        "CUI", "TUI", F.concat(F.lit("semantic type "), F.col("TUI")).alias("STY"))


def d_concept(part: DataFrame, supplier: DataFrame) -> DataFrame:
    loinc = part.select(F.col("p_partkey").alias("concept_id"), F.col("p_name").alias("concept_name"),
                        F.col("p_partkey").cast("string").alias("concept_code"),
                        F.lit("Lab Test").alias("concept_class_id"), F.lit("LOINC").alias("vocabulary_id"))
    snomed = supplier.select((F.col("s_suppkey") + 1000000).alias("concept_id"), F.col("s_name").alias("concept_name"),
                             F.col("s_suppkey").cast("string").alias("concept_code"),
                             F.lit("Procedure").alias("concept_class_id"), F.lit("SNOMED").alias("vocabulary_id"))
    return loinc.unionByName(snomed)


def d_rel(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(F.col("l_partkey").alias("concept_id_1"),
                           (F.col("l_suppkey") + 1000000).alias("concept_id_2")).distinct()


def d_rx(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Prescription sentences: drug name, dose with unit, daily frequency."""
    unit = (F.when(F.col("l_linenumber") % 3 == 0, "mg").when(F.col("l_linenumber") % 3 == 1, "g")
             .otherwise("comprimes"))
    txt = F.concat(F.col("p_name"), F.lit(" "), F.col("l_quantity").cast("int").cast("string"), F.lit(" "), unit,
                   F.lit(" "), F.col("l_linenumber").cast("string"), F.lit(" fois par jour"))
    return lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", txt.alias("txt"))


# How often a drug is taken, by the forms of the rules; {n} is the line number,
# {m} the next one.  Of each form the items that a reader finds in it: kind, words,
# then intakes per day, the same for the upper end, and the normalised form, in SQL
# with n for the line number.
INTAKE_FORMS = (
    ("{n} fois par jour", [("count", "{n} fois par jour", "n", "null", "n || ' per_day'")]),
    ("{n} à {m} fois par jour", [("count", "{n} à {m} fois par jour", "n", "n + 1", "n || '-' || n + 1 || ' per_day'")]),
    ("deux fois par jour", [("count", "deux fois par jour", "2", "null", "'2 per_day'")]),
    ("Tous les {n} jours", [("every", "Tous les {n} jours", "1.0::double / n", "null",
                             "regexp_replace(cast(1.0::double / n as varchar), '\\.0$', '') || ' per_day'")]),
    ("toutes les {m} heures", [("every", "toutes les {m} heures", "1.0::double / (n + 1) / (1 / 24::double)", "null",
                                "regexp_replace(cast(1.0::double / (n + 1) as varchar), '\\.0$', '') || ' per_hour'")]),
    ("{n} jours sur 7", [("share", "{n} jours sur 7", "n / 7::double", "null",
                          "regexp_replace(cast(n / 7::double as varchar), '\\.0$', '') || ' per_day'")]),
    ("par jour", [("each", "par jour", "1", "null", "'1 per_day'")]),
    ("matin, midi et soir", [("time_of_day", "matin, midi et soir", "3", "null", "'3 per_day'")]),
    ("1-0-{n}", [("time_of_day", "1-0-{n}", "n + 1", "null", "n + 1 || ' per_day'")]),
    ("1 {n} 1", [("time_of_day", "1 {n} 1", "n + 2", "null", "n + 2 || ' per_day'")]),
    ("1.{n}.0", [("time_of_day", "1.{n}.0", "n + 1", "null", "n + 1 || ' per_day'")]),
    ("le lundi et le jeudi", [("day_of_week", "le lundi et le jeudi", "1 / 7::double + 1 / 7::double", "null", "'2 per_week'")]),
    ("J{n}-J{m}", [("day_of_month", "J{n}-J{m}", "null", "null", "''")]),
    ("quotidien", [("rate", "quotidien", "1", "null", "'1 per_day'")]),
    ("{n} fois par semaine", [("count", "{n} fois par semaine", "n / 7::double", "null", "n || ' per_week'")]),
    ("avant les repas", [("time_of_day", "avant les repas", "3", "null", "'3 per_day'")]),
    ("4 fois par heure", []),
    ("tous les jours pairs", [("each", "tous les jours pairs", "0.5", "null", "'1 per_two_days'")]),
    ("{n} le matin et {m} le soir", [("count", "{n} le matin", "n", "null", "n || ' per_day'"),
                                     ("count", "{m} le soir", "n + 1", "null", "n + 1 || ' per_day'")]),
    ("{n} jours par semaine", [("rate", "{n} jours par semaine", "n / 7::double", "null", "n || ' per_week'")]),
    ("vingt et un mensuels", [("rate", "vingt et un mensuels", "21 / 30.4167::double", "null", "'21 per_month'")]),
    ("ce matin", []),
)


def _filled(template: str) -> Column:
    n = F.col("n").cast("string")
    return F.replace(F.replace(F.lit(template), F.lit("{n}"), n), F.lit("{m}"), (F.col("n") + 1).cast("string"))


def d_intakes(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Prescription lines that name two drugs, each with a dose and a form of
    ``INTAKE_FORMS``, and where the drugs stand."""
    keys = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    line = F.concat_ws("#", *keys, F.col("l_quantity").cast("int").cast("string"))
    size = len(INTAKE_FORMS)
    rows = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        line.alias("line"), F.col("l_linenumber").cast("int").alias("n"), F.col("l_quantity").cast("int").alias("q"),
        F.col("p_name").alias("first"), F.lower("p_type").alias("second"),
        *(((F.col("l_orderkey") * step + F.col("l_linenumber")) % size).cast("int").alias(f"form{i}") for i, step in ((1, 1), (2, 5))))
    forms = [F.coalesce(*(F.when(F.col(f"form{i}") == k, _filled(x)) for k, (x, _) in enumerate(INTAKE_FORMS))) for i in (1, 2)]
    rows = rows.withColumns({"words1": forms[0], "words2": forms[1]})
    days = F.when(F.col("n") % 2 == 0, F.concat(F.lit(" pendant "), F.col("n").cast("string"), F.lit(" jours"))).otherwise("")
    one = F.concat(F.lit("début "), "first", F.lit(" "), F.col("q").cast("string"), F.lit(" mg "), "words1", days, F.lit(" ; "))
    two = F.concat("second", F.lit(" "), (F.col("q") + 1).cast("string"), F.lit(" comprimés "), "words2")
    stop = F.when(F.col("q") % 3 == 0, "arrêt ").otherwise("")
    rows = rows.withColumns({"one": F.concat(one, stop), "two": two})
    return rows.select("line", "n", "q", "first", "second", "form1", "form2", "words1", "words2",
                       F.concat("one", "two").alias("txt"), F.length("one").alias("second_start"))


def d_terms(part: DataFrame) -> DataFrame:
    return part.where(F.col("p_partkey") % 2 == 0).select(
        F.col("p_size").alias("source"), F.col("p_partkey").alias("id"), F.col("p_name").alias("term"))


def d_gold_terms(part: DataFrame) -> DataFrame:
    return part.where(F.col("p_partkey") % 2 == 1).select(
        F.col("p_size").alias("source"), F.col("p_partkey").alias("gid"),
        F.concat(F.col("p_name"), F.lit(" "), F.lower(F.col("p_type"))).alias("gold_term"))


def d_gold(documents: DataFrame) -> DataFrame:
    """Gold BIO mentions with annotator notes ``CODE_measure`` (some with a
    ``path:CODE`` form, some without annotation)."""
    g = d_inner(documents).where(F.col("label") == "BIO")
    code = F.concat(F.lit("C"), ((F.col("doc_id") + F.col("k")) % 13).cast("string"))
    meas = F.concat(F.lit("= "), ((F.col("k") % 20) * 0.5).cast("string"), F.lit(" g_per_l"))
    ann = (F.when(F.col("k") % 11 == 0, F.lit(None).cast("string"))
            .when(F.col("k") % 7 == 0, F.concat(F.lit("path:"), code))
            .otherwise(F.concat(code, F.lit("_"), meas)))
    return g.select("source", "doc_id", "k", "s", "e", "label", "term", ann.alias("annotation"))


def d_pred(documents: DataFrame) -> DataFrame:
    """Predictions against ``d_gold``: shifted, thinned, with a code list."""
    g = d_inner(documents).where((F.col("label") == "BIO") & (F.col("k") % 5 != 0))
    shift = (F.col("doc_id") + F.col("k")) % 4
    codes = F.array(F.concat(F.lit("C"), ((F.col("doc_id") + F.col("k") + F.col("k") % 3) % 13).cast("string")),
                     F.concat(F.lit("C"), ((F.col("doc_id") + 2 * F.col("k")) % 13).cast("string")))
    found = F.array(F.concat(F.lit("= "), ((F.col("k") % 20) * 0.5 + (F.col("k") % 4 == 0).cast("int")).cast("string"),
                             F.lit(" g_per_l")))
    return g.select("source", "doc_id", "k", (F.col("s") + shift).alias("s"), (F.col("e") + shift).alias("e"),
                    "label", "term", F.array_sort(F.array_distinct(codes)).alias("codes"), found.alias("found"))


# --------------------------------------------------------------------------
# Lab notes: one note per order; line 0 is a header with the patient and a
# date, then one line per lineitem with a measure in one of several forms;
# lines 5..7 form a text table.  Key mentions (BIO_comp) are the item lines,
# inner BIO mentions the analyte names at their start.
# --------------------------------------------------------------------------

def d_lab_lines(orders: DataFrame, lineitem: DataFrame, part: DataFrame) -> DataFrame:
    li = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
    ln = F.col("l_linenumber")
    qty = F.col("l_quantity").cast("int").cast("string")
    disc = F.floor(F.col("l_discount") * 100 + 0.5).cast("int").cast("string")
    tax = F.floor(F.col("l_tax") * 100 + 0.5).cast("int").cast("string")
    word = (F.when(F.col("l_returnflag") == "R", "positif").when(F.col("l_returnflag") == "A", "negatif")
             .otherwise("normal"))
    trig = F.when(F.col("l_orderkey") % 2 == 0, "poids ").otherwise("taille ")
    line = (F.when(ln >= 5, F.concat(F.col("p_name"), F.lit(" | "), qty, F.lit(" | mg | "), tax, F.lit(" %")))
             .when(ln % 4 == 1, F.concat(F.col("p_name"), F.lit(" "), qty, F.lit(" mg/dl")))
             .when(ln % 4 == 2, F.concat(F.col("p_name"), F.lit(" < "), disc, F.lit(",5 g/l")))
             .when(ln % 4 == 3, F.concat(F.col("p_name"), F.lit(" "), word))
             .otherwise(F.concat(trig, qty)))
    name = F.when((ln < 5) & (ln % 4 == 0), F.lit(None).cast("string")).otherwise(F.col("p_name"))
    # (order, linenumber) is not unique in the data: number lines per order
    # (a bounded group) with a full tie-break so both engines agree.  Header and
    # items meet in one window by note, so what groups by note needs no shuffle.
    none = F.lit(None)
    items = li.select(_src(F.col("l_orderkey")).alias("source"), "l_orderkey", F.lit(1).alias("_item"), "l_linenumber", "l_partkey",
                      "l_suppkey", line.alias("line"), name.alias("analyte"))
    header = orders.select(
        _src(F.col("o_orderkey")).alias("source"), F.col("o_orderkey").alias("l_orderkey"), F.lit(0).alias("_item"),
        *(none.cast(items.schema[c].dataType).alias(c) for c in ("l_linenumber", "l_partkey", "l_suppkey")),
        F.concat(F.lit("patient "), F.col("o_custkey").cast("string"), F.lit(" le "),
                 F.date_format(F.col("o_orderdate"), "dd/MM/yyyy")).alias("line"),
        none.cast("string").alias("analyte"))
    order = Window.partitionBy("source").orderBy("_item", "l_linenumber", "l_partkey", "l_suppkey")
    upto, before = (order.rowsBetween(Window.unboundedPreceding, end) for end in (Window.currentRow, -1))
    return header.unionByName(items).select(
        "source", "l_orderkey", F.sum("_item").over(upto).cast("int").alias("ln"), "line", "analyte",
        F.coalesce(F.sum(F.length("line") + 1).over(before), F.lit(0)).cast("bigint").alias("start"))


def d_lab_notes(lines: DataFrame) -> DataFrame:
    # the source follows from the order's key
    return lines.groupBy("source").agg(F.first("l_orderkey").alias("l_orderkey"), F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("ln", "line"))), lambda x: x["line"]), "\n").alias("note_text"))


def d_lab_mentions(lines: DataFrame) -> DataFrame:
    """The key mention of a line and, where it names an analyte, the inner one: both
    from one reading of the lines."""
    def mention(k: int, label: str, term: str) -> Column:
        return F.struct((2 * F.col("ln") + k).cast("bigint").alias("k"), F.col("start").alias("s"),
                        (F.col("start") + F.length(term)).alias("e"), F.lit(label).alias("label"), F.col(term).alias("term"))

    both = F.array(mention(0, "BIO_comp", "line"), mention(1, "BIO", "analyte"))
    rows = lines.where(F.col("ln") > 0).select("source", F.explode(both).alias("m")).select("source", "m.*")
    return rows.where((F.col("label") == "BIO_comp") | F.col("term").isNotNull())


def d_conv_notes(conversations: DataFrame) -> DataFrame:
    """One note per conversation: every turn opens with a heading line
    ``<role>:`` (a section heading)."""
    chunk = F.concat(F.col("role"), F.lit(":\n"), F.col("text"))
    return conversations.groupBy("conv_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("turn", chunk.alias("c")))), lambda x: x["c"]), "\n").alias("note_text"))

# Lines that open a turn: a heading before a colon or alone on its line, in several
# spellings; the last one is no heading.
HEADING_LINES = ("Motif d'hospitalisation :", "ANTÉCÉDENTS", "Antécédents familiaux: ", "mode de vie:", "Histoire  de la maladie",
                 "  Examen clinique :", "EXAMENS COMPLÉMENTAIRES:", "Traitement à l\u2019entrée :", "Évolution", "Conclusion :",
                 "Remarque :")


def d_section_notes(conversations: DataFrame) -> DataFrame:
    """One note per conversation: every turn opens with a heading line, and with text
    on that line in every third turn."""
    line = F.element_at(F.array(*[F.lit(h) for h in HEADING_LINES]), ((F.col("conv_id") + F.col("turn")) % len(HEADING_LINES) + 1).cast("int"))
    chunk = F.concat(line, F.when(F.col("turn") % 3 == 2, F.lit(" ")).otherwise(F.lit("\n")), F.col("text"))
    return conversations.groupBy("conv_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("turn", chunk.alias("c")))), lambda x: x["c"]), "\n").alias("note_text"))


def d_section_terms(conversations: DataFrame) -> DataFrame:
    """Terminology of two to four words from inside the turns: ``term, code``."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    term = F.array_join(F.slice(words, F.lit(4), (F.col("turn") % 3 + 2).cast("int")), "-")
    return conversations.select(term.alias("term"), F.concat(F.lit("C"), (F.col("conv_id") * 8 + F.col("turn")).cast(
        "string")).alias("code")).where("term != ''")


def d_knowledge(conversations: DataFrame) -> DataFrame:
    """Knowledge entries ``disease, body`` (nested JSON) over the codes of
    ``d_section_terms``, at most 64 conversations an entry."""
    from notelab.operators.sections import DISEASES
    c = F.col("conv_id") * 8 + F.col("turn")
    # every seventh code belongs to two diseases
    numbers = F.when(c % 7 == 0, F.array(c % 4, (c + 1) % 4)).otherwise(F.array(c % 4))
    rows = conversations.select("conv_id", "turn", c.alias("c"), F.explode(numbers).alias("d")).select(
        F.element_at(F.array(*[F.lit(d) for d in DISEASES]), (F.col("d") + 1).cast("int")).alias("disease"),
        F.floor(F.col("conv_id") / 64).alias("part"), "conv_id", "turn",
        F.concat(F.lit("analyte_"), (F.col("c") % 3).cast("string")).alias("analyte"), F.col("c").cast("string").alias("c"),
        F.when(F.col("c") % 5 == 0, "examens complémentaires").when(F.col("c") % 5 == 1, "Antécédents").otherwise("all").alias("section"))

    def as_map(df, key, value):
        return df.agg(F.map_from_entries(F.collect_list(F.struct(F.col(key), F.col(value)))).alias("m"))

    key = ["disease", "part"]
    cim = rows.groupBy(*key).agg(F.collect_set(F.when(F.col("turn") == 0, F.concat(F.lit("M"), F.col("conv_id").cast("string")))).alias("CIM10"))
    per = rows.groupBy(*key, "section", "analyte").agg(F.collect_list(F.concat(F.lit("C"), "c")).alias("codes"))
    cui = as_map(as_map(per.groupBy(*key, "section"), "analyte", "codes").groupBy(*key), "section", "m").withColumnRenamed("m", "CUI_per_section")
    lab = as_map(rows.groupBy(*key, "analyte").agg(F.collect_list(F.concat(F.lit("L"), "c")).alias("codes")).groupBy(*key),
                 "analyte", "codes").withColumnRenamed("m", "ANABIO_codes")
    return cim.join(lab, key).join(cui, key).select(
        "disease", F.to_json(F.struct("CIM10", "ANABIO_codes", "CUI_per_section")).alias("body"))


@dataclass
class Tables:
    spark: SparkSession
    sf_dir: str

    def t(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.t(name)
        raise AttributeError(name)


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """A derived table written once into the shared checkpoint folder, for queries that
    read it several times; dealt ``by`` a column, so that what groups by it needs no shuffle."""
    spark, run = df.sparkSession, uuid.uuid4().hex
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/notelab-tables/{name}-{run}"
    if by:
        table = f"notelab_{name.replace('-', '_')}_{run}"
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        df.write.format("parquet").bucketBy(parts, by).option("path", path).saveAsTable(table)
        return spark.table(table)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


# ---------------------------------------------------------------------------
# DuckDB definitions of the same derived tables (oracle side).
# ---------------------------------------------------------------------------

_POS = ("(select doc_id, text, unnest(generate_series(0, (length(text) - 1) // 50)) k "
        "from documents where length(text) > 0)")

ORACLE_CTES: dict[str, str] = {
    "d_keys": f"""
select concat(cast(doc_id as varchar), '.ann') source, doc_id, k, 50 * k s, 50 * k + least(30, length(text) - 50 * k) e,
       'BIO_comp' label, substring(text, cast(50 * k + 1 as integer), 30) term
from {_POS} p""",
    "d_inner": f"""
select source, doc_id, 3 * k + j k, s, least(s + ln, length(text)) e, label,
       substring(text, cast(s + 1 as integer), cast(ln as integer)) term
from (
  select concat(cast(doc_id as varchar), '.ann') source, doc_id, text, k, j,
         case j when 0 then 50 * k + (doc_id + k) % 37
                when 1 then 50 * k + (doc_id + 3 * k) % 41
                else 50 * k + 27 + (doc_id + k) % 5 end s,
         case j when 0 then 6 when 1 then 8 else 26 end ln,
         case (doc_id + 2 * k + j) % 3 when 0 then 'BIO' when 1 then 'DISO'
              else 'Chemical_and_drugs' end label
  from {_POS} p, (values (0), (1), (2)) v(j)
) q where s < length(text)""",
    "d_mentions": """
select source, doc_id, k, s, e, label, term from d_keys
union all
select source, doc_id, k, s, e, label, term from d_inner""",
    "d_docs": """
select o_orderkey encounter_num, o_orderdate start_date_doc, o_orderpriority concept_cd,
       concat('Patient ', cast(o_custkey as varchar), ' status ', o_orderstatus) observation_blob
from orders""",
    "d_labs": """
select l_orderkey encounter_num, l_partkey concept_cd,
       case when l_linenumber = 7 then null else l_quantity end nval_num,
       case l_returnflag when 'A' then 'mg' when 'N' then 'g' else null end units_cd,
       l_shipdate start_date_lab
from lineitem""",
    "d_onto": """
select p_partkey c_basecode, concat(p_type, ':', p_name, '_', p_brand) c_name from part""",
    "d_mrconso": """
select concat('C', lpad(cast(p_partkey % 97 as varchar), 7, '0')) CUI,
       case p_partkey % 5 when 0 then 'FRE' when 1 then 'SPA' else 'ENG' end LAT,
       p_brand SAB, cast(p_partkey as varchar) CODE, concat(p_name, ' ', lower(p_type)) STR
from part""",
    "d_mrsty": """
select CUI, TUI, concat('semantic type ', TUI) STY from (
  select distinct concat('C', lpad(cast(p_partkey % 97 as varchar), 7, '0')) CUI,
         concat('T', lpad(cast((p_partkey % 97) % 7 + 56 as varchar), 3, '0')) TUI
  from part) t""",
    "d_concept": """
select p_partkey concept_id, p_name concept_name, cast(p_partkey as varchar) concept_code,
       'Lab Test' concept_class_id, 'LOINC' vocabulary_id from part
union all
select 1000000 + s_suppkey, s_name, cast(s_suppkey as varchar), 'Procedure', 'SNOMED' from supplier""",
    "d_rel": """
select distinct l_partkey concept_id_1, 1000000 + l_suppkey concept_id_2 from lineitem""",
    "d_rx": """
select l_orderkey, l_linenumber,
       concat(p_name, ' ', cast(cast(l_quantity as integer) as varchar), ' ',
              case l_linenumber % 3 when 0 then 'mg' when 1 then 'g' else 'comprimes' end, ' ',
              cast(l_linenumber as varchar), ' fois par jour') txt
from lineitem join part on l_partkey = p_partkey""",
    "d_intakes": f"""
select *, one || two txt, cast(length(one) as int) second_start from (
  select *, 'début ' || first || ' ' || q || ' mg ' || words1 || case when n % 2 = 0 then ' pendant ' || n || ' jours' else '' end || ' ; '
            || case when q % 3 = 0 then 'arrêt ' else '' end one,
         second || ' ' || (q + 1) || ' comprimés ' || words2 two
  from (
    select r.*, replace(replace(f1.words, '{{n}}', cast(n as varchar)), '{{m}}', cast(n + 1 as varchar)) words1,
           replace(replace(f2.words, '{{n}}', cast(n as varchar)), '{{m}}', cast(n + 1 as varchar)) words2
    from (
      select concat_ws('#', cast(l_orderkey as varchar), cast(l_linenumber as varchar), cast(l_partkey as varchar), cast(l_suppkey as varchar),
                       cast(cast(l_quantity as int) as varchar)) line,
             cast(l_linenumber as int) n, cast(l_quantity as int) q, p_name as first, lower(p_type) as second,
             cast((l_orderkey + l_linenumber) % {len(INTAKE_FORMS)} as int) form1,
             cast((l_orderkey * 5 + l_linenumber) % {len(INTAKE_FORMS)} as int) form2
      from lineitem join part on l_partkey = p_partkey) r
    join ({" union all ".join(f"select {k} form, '{x}' words" for k, (x, _) in enumerate(INTAKE_FORMS))}) f1 on f1.form = form1
    join ({" union all ".join(f"select {k} form, '{x}' words" for k, (x, _) in enumerate(INTAKE_FORMS))}) f2 on f2.form = form2)
)""",
    "d_terms": """
select p_size source, p_partkey id, p_name term from part where p_partkey % 2 = 0""",
    "d_gold_terms": """
select p_size source, p_partkey gid, concat(p_name, ' ', lower(p_type)) gold_term from part where p_partkey % 2 = 1""",
    "d_gold": """
select source, doc_id, k, s, e, label, term,
       case when k % 11 = 0 then null
            when k % 7 = 0 then concat('path:', 'C', cast((doc_id + k) % 13 as varchar))
            else concat('C', cast((doc_id + k) % 13 as varchar), '_= ',
                        cast((k % 20) * 0.5 as varchar), ' g_per_l') end annotation
from d_inner where label = 'BIO'""",
    "d_pred": """
select source, doc_id, k, s + (doc_id + k) % 4 s, e + (doc_id + k) % 4 e, label, term,
       list_sort(list_distinct([concat('C', cast((doc_id + k + k % 3) % 13 as varchar)),
                                concat('C', cast((doc_id + 2 * k) % 13 as varchar))])) codes,
       [concat('= ', cast((k % 20) * 0.5 + cast(k % 4 = 0 as integer) as varchar), ' g_per_l')] found
from d_inner where label = 'BIO' and k % 5 <> 0""",
    "d_lab_lines": """
select concat(cast(l_orderkey as varchar), '.ann') source, l_orderkey, ln, line, analyte,
       cast(coalesce(sum(length(line) + 1) over (partition by l_orderkey order by ln
            rows between unbounded preceding and 1 preceding), 0) as bigint) start
from (
  select l_orderkey, cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey)
                         as integer) ln,
         case when l_linenumber >= 5 then concat(p_name, ' | ', cast(cast(l_quantity as integer) as varchar),
                                                 ' | mg | ', cast(cast(floor(l_tax * 100 + 0.5) as integer) as varchar), ' %')
              when l_linenumber % 4 = 1 then concat(p_name, ' ', cast(cast(l_quantity as integer) as varchar), ' mg/dl')
              when l_linenumber % 4 = 2 then concat(p_name, ' < ',
                                                    cast(cast(floor(l_discount * 100 + 0.5) as integer) as varchar), ',5 g/l')
              when l_linenumber % 4 = 3 then concat(p_name, ' ', case l_returnflag when 'R' then 'positif'
                                                                   when 'A' then 'negatif' else 'normal' end)
              else concat(case when l_orderkey % 2 = 0 then 'poids ' else 'taille ' end,
                          cast(cast(l_quantity as integer) as varchar)) end line,
         case when l_linenumber < 5 and l_linenumber % 4 = 0 then null else p_name end analyte
  from lineitem join part on l_partkey = p_partkey
  union all
  select o_orderkey, 0, concat('patient ', cast(o_custkey as varchar), ' le ', strftime(o_orderdate, '%d/%m/%Y')), null
  from orders
) t""",
    "d_conv_notes": """
select conv_id, string_agg(concat(role, ':', chr(10), text), chr(10) order by turn) note_text
from conversations group by conv_id""",
    "d_section_notes": f"""
select conv_id, string_agg(concat([{', '.join("'" + h.replace("'", "''") + "'" for h in HEADING_LINES)}][(conv_id + turn) % {len(HEADING_LINES)} + 1],
                                  case when turn % 3 = 2 then ' ' else chr(10) end, text), chr(10) order by turn) note_text
from conversations group by conv_id""",
    "d_section_terms": """
select * from (select array_to_string(regexp_extract_all(lower(text), '[a-z]+')[4:5 + turn % 3], '-') term,
                      'C' || (conv_id * 8 + turn) code from conversations) t where term <> ''""",
    "d_lab_notes": """
select source, l_orderkey, string_agg(line, chr(10) order by ln) note_text from d_lab_lines group by source, l_orderkey""",
    "d_lab_mentions": """
select source, cast(2 * ln as bigint) k, start s, start + length(line) e, 'BIO_comp' label, line term
from d_lab_lines where ln > 0
union all
select source, cast(2 * ln + 1 as bigint) k, start s, start + length(analyte) e, 'BIO' label, analyte term
from d_lab_lines where ln > 0 and analyte is not null""",
}


def with_ctes(sql: str, *names: str, extra: str = "") -> str:
    """Prefix ``sql`` with the named derived tables (and those they use),
    followed by the additional CTE definitions in ``extra``."""
    order = list(ORACLE_CTES)
    need: set[str] = set()

    def add(n: str) -> None:
        if n in need:
            return
        need.add(n)
        for other in order:
            if other != n and other in ORACLE_CTES[n]:
                add(other)

    for n in names:
        add(n)
    parts = [f"{n} as materialized ({ORACLE_CTES[n]}\n)" for n in order if n in need]
    if extra.strip():
        parts.append(extra.strip())
    return "with " + ",\n".join(parts) + "\n" + sql
