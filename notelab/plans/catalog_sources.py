"""Registered queries: sources and sinks (S01-S18) and standoff repair.

Each query writes Spark-derived data with the sink under test into a fresh
folder below the session's checkpoint directory (the shared folder on a
cluster) and reads it back with the matching source; the results hold the
values, not counts.  Standoff corpora use the packed layout (many notes per
file); the one-file-per-note writer exports a sample (S15)."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from notelab.operators import corpus as cp
from notelab.operators import evaluation as ev
from notelab.session import ensure_checkpoint_dir
from notelab.sources import io
from notelab.sources import standoff as so
from notelab.sources import standoff_source as ss
from notelab.plans import testbed as tb
from notelab.plans.registry import query

W = tb.with_ctes
PART = "part-*"


def scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/notelab-io/{name}-{uuid.uuid4().hex}"


def _lab(spark, sf_dir):
    t = tb.tables(spark, sf_dir)
    lines = tb.d_lab_lines(t.orders, t.lineitem, t.part)
    return tb.d_lab_mentions(lines), tb.d_lab_notes(lines)


def _drug_mentions_with_attributes(spark, sf_dir):
    inner = tb.d_inner(tb.tables(spark, sf_dir).documents).where(F.col("label") == "Chemical_and_drugs")
    attrs = F.map_filter(F.create_map(
        F.lit("Negation"), F.when(F.col("k") % 13 == 0, F.lit("")).when(F.col("k") % 7 == 0, F.lit("neg")),
        F.lit("Tech"), F.when(F.col("k") % 17 == 0, F.lit("Dosage"))), lambda k, v: v.isNotNull())
    return inner.withColumn("attributes", attrs)


def _packed(spark, name, table):
    path = scratch(spark, name)
    so.write_packed(table, path)
    return spark.read.parquet(path)


_T = "row_number() over (partition by source order by s, k)"


@query("S01_read_standoff", W(f"""
select 'T' || {_T} ann_id, term, label, source, s || ' ' || e span from d_lab_mentions""", "d_lab_mentions"))
def s01(spark, sf_dir):
    mentions, _ = _lab(spark, sf_dir)
    return so.parse_mentions(_packed(spark, "lines", so.pack_lines(so.standoff_lines(mentions))))


@query("S02_read_notes", W("""
select source note_id, note_text, split_part(note_text, chr(10), 1) header from d_lab_notes""", "d_lab_notes"))
def s02(spark, sf_dir):
    _, notes = _lab(spark, sf_dir)
    return so.with_header(_packed(spark, "notes", notes.select("source", "note_text")))


@query("S03_note_header", W("""
select source note_id, regexp_extract(split_part(note_text, chr(10), 1), '^patient ([0-9]+)', 1) patient
from d_lab_notes""", "d_lab_notes"))
def s03(spark, sf_dir):
    _, notes = _lab(spark, sf_dir)
    n = so.with_header(notes.select("source", "note_text"))
    return n.select("note_id", F.regexp_extract("header", "^patient ([0-9]+)", 1).alias("patient"))


@query("S04_check_pairs", W("""
select distinct source from d_lab_mentions
where source not in (select source from d_lab_notes where contains(note_text, '|'))""", "d_lab_mentions", "d_lab_notes"))
def s04(spark, sf_dir):
    mentions, notes = _lab(spark, sf_dir)
    return so.missing_notes(mentions, notes.where(F.col("note_text").contains("|")))


_ATTRS = f"""
select source, k, n, name, value, row_number() over (partition by source order by n, j) a from (
  select source, k, {_T} n, 0 j, 'Negation' name, case when k % 13 = 0 then '' when k % 7 = 0 then 'neg' end value
  from d_inner where label = 'Chemical_and_drugs'
  union all
  select source, k, {_T} n, 1 j, 'Tech', case when k % 17 = 0 then 'Dosage' end
  from d_inner where label = 'Chemical_and_drugs') t
where value is not null"""


@query("S05_read_attributes", W(f"""
select source, 'T' || n ann_id,
       string_agg(name || '=' || value, ';' order by name) attributes
from (select source, n, case when name = 'Tech' then 'technique' else name end name, value from ({_ATTRS}) a) b
group by source, n""", "d_inner"))
def s05(spark, sf_dir):
    m = _drug_mentions_with_attributes(spark, sf_dir)
    lines = _packed(spark, "attrs", so.pack_lines(so.standoff_lines(m, attributes="attributes")))
    a = so.parse_attributes(lines, names={"Tech": "technique"})
    pairs = F.transform(F.array_sort(F.map_entries("attributes")), lambda x: F.concat(x["key"], F.lit("="), x["value"]))
    return a.select("source", "ann_id", F.array_join(pairs, ";").alias("attributes"))


_ENTITIES = W("""
select source note_id, string_agg(s || '-' || e || ':' || label, ';' order by s, e, label) entities
from d_lab_mentions group by source""", "d_lab_mentions")


def _entities_text(notes):
    text = F.transform(F.array_sort("entities"), lambda x: F.concat(
        x["start"].cast("string"), F.lit("-"), x["end"].cast("string"), F.lit(":"), x["label"]))
    return notes.select("note_id", F.array_join(text, ";").alias("entities"))


def _notes_with_entities(spark, sf_dir):
    mentions, notes = _lab(spark, sf_dir)
    ents = mentions.groupBy("source").agg(F.collect_list(F.struct(
        F.col("s").cast("int").alias("start"), F.col("e").cast("int").alias("end"), "label")).alias("entities"))
    return notes.join(ents, "source").select("note_text", F.col("source").alias("note_id"), "entities")


@query("S06_read_notes_jsonl", _ENTITIES)
def s06(spark, sf_dir):
    path = scratch(spark, "jsonl")
    io.write_notes_jsonl(_notes_with_entities(spark, sf_dir).withColumn("note_class_source_value", F.lit("CR-LAB")), path)
    return _entities_text(io.read_corpus(spark, path, "jsonl"))


@query("S07_read_corpus", W("""
select n.source note_id, n.note_text, coalesce(string_agg(m.s || '-' || m.e || ':' || m.label, ';' order by m.s, m.e, m.label), '') entities
from d_lab_notes n left join d_lab_mentions m on m.source = n.source group by n.source, n.note_text""",
                            "d_lab_mentions", "d_lab_notes"))
def s07(spark, sf_dir):
    mentions, notes = _lab(spark, sf_dir)
    path = scratch(spark, "corpus")
    so.write_packed(so.pack_lines(so.standoff_lines(mentions)), f"{path}/lines")
    so.write_packed(notes.select("source", "note_text"), f"{path}/notes")
    corpus = io.read_corpus(spark, path, "standoff")
    plain = corpus.withColumn("entities", F.transform("entities", lambda x: F.struct(x["start"], x["end"], x["label"])))
    return plain.select("note_id", "note_text").join(_entities_text(plain), "note_id")


@query("S08_read_frame_json", W("""
select cast(row_number() over (order by CUI, TUI) as varchar) idx, CUI, TUI, STY from d_mrsty""", "d_mrsty"))
def s08(spark, sf_dir):
    # one row per concept: a small result frame, which the sink checks
    sty = tb.d_mrsty(tb.tables(spark, sf_dir).part).withColumn("idx", F.row_number().over(Window.orderBy("CUI", "TUI")))
    path = scratch(spark, "frame")
    io.write_frame_json(sty, path, "idx")
    return io.read_frame_json(spark, path)


@query("S09_read_delimited", W("select CUI, LAT, SAB, CODE, STR from d_mrconso", "d_mrconso"))
def s09(spark, sf_dir):
    m = tb.d_mrconso(tb.tables(spark, sf_dir).part)
    path = scratch(spark, "mrconso")
    m.write.option("sep", "|").option("header", "false").csv(path)
    return io.read_delimited(spark, path, "|", names=["CUI", "LAT", "SAB", "CODE", "STR"])


@query("S10_catalog_scan", """
select o_orderkey, o_totalprice from orders where o_orderstatus = 'F' and o_totalprice > 100000""")
def s10(spark, sf_dir):
    name = "orders_" + uuid.uuid4().hex[:8]
    tb.tables(spark, sf_dir).orders.createOrReplaceTempView(name)
    return io.catalog_scan(spark, name, ["o_orderkey", "o_totalprice"],
                           "o_orderstatus = 'F' and o_totalprice > 100000")


@query("S11_write_result", W("select encounter_num, concept_cd, nval_num from d_labs", "d_labs"))
def s11(spark, sf_dir):
    labs = tb.d_labs(tb.tables(spark, sf_dir).lineitem).select("encounter_num", "concept_cd", "nval_num")
    path = scratch(spark, "result")
    io.write_result(labs, path, "parquet")
    return spark.read.parquet(path)


_LINES = f"""
select source, row_number() over (partition by source order by n, kind) ln, line from (
  select source, n, 0 kind, 'T' || n || chr(9) || label || ' ' || s || ' ' || e || chr(9) || term line
  from (select *, {_T} n from d_lab_mentions) a
  union all
  select source, n, 1, '#' || row_number() over (partition by source order by n) || chr(9) || 'AnnotatorNotes T' || n
                       || chr(9) || 'C' || k
  from (select *, {_T} n from d_lab_mentions) b where label = 'BIO') t"""


@query("S12_write_standoff", W(_LINES, "d_lab_mentions"))
def s12(spark, sf_dir):
    mentions, _ = _lab(spark, sf_dir)
    m = mentions.withColumn("note", F.when(F.col("label") == "BIO", F.concat(F.lit("C"), F.col("k").cast("string"))))
    return _packed(spark, "standoff", so.pack_lines(so.standoff_lines(m, annotation="note")))


@query("S13_publish_notes", W(f"""
select n.source, md5(n.note_text) text_md5, coalesce(b.body, '') body
from d_lab_notes n left join (
  select source, string_agg('T' || n || chr(9) || label || ' ' || s || ' ' || e || chr(9) || term, chr(10) order by n) body
  from (select *, {_T} n from d_lab_mentions where label = 'BIO') a group by source) b on b.source = n.source
where b.source is not null
   or n.source in (select source from d_lab_notes order by md5('42_' || source), source limit 50)""",
                              "d_lab_mentions", "d_lab_notes"))
def s13(spark, sf_dir):
    mentions, notes = _lab(spark, sf_dir)
    lines = so.standoff_lines(mentions.where(F.col("label") == "BIO"))
    sampled = cp.random_limit(notes.select("source"), "source", 50)
    out = _packed(spark, "published", so.publish_notes(notes, lines, sampled))
    return out.select("source", F.md5("note_text").alias("text_md5"), "body")


@query("S14_write_mentions_with_attributes", W(f"""
select source, 'A' || a || chr(9) || name || ' T' || n || ' ' || value line from ({_ATTRS}) t""", "d_inner"))
def s14(spark, sf_dir):
    m = _drug_mentions_with_attributes(spark, sf_dir)
    lines = _packed(spark, "attributes", so.pack_lines(so.standoff_lines(m, attributes="attributes")))
    return lines.where(F.col("line").startswith("A")).select("source", "line")


@query("S15_write_note_per_file", W("""
select source note_id, note_text from d_lab_notes order by md5('42_' || source), source limit 20""", "d_lab_notes"))
def s15(spark, sf_dir):
    """A file per note for a sample of 20 notes."""
    _, notes = _lab(spark, sf_dir)
    path = scratch(spark, "per-note")
    so.write_notes(cp.random_limit(notes, "source", 20).select("source", "note_text"), path)
    back = so.read_notes(spark, path, glob=PART)
    return back.select("note_id", F.regexp_replace("note_text", "\n$", "").alias("note_text"))


@query("S15_standoff_source", W(f"""
select n.source note_id, n.note_text, coalesce(b.body, '') body from d_lab_notes n left join (
  select source, string_agg('T' || n || chr(9) || label || ' ' || s || ' ' || e || chr(9) || term, chr(10) order by n) body
  from (select *, {_T} n from d_lab_mentions) m group by source) b on b.source = n.source""", "d_lab_notes", "d_lab_mentions"))
def s15_all(spark, sf_dir):
    """A pair of files for every note, written and read by the data source."""
    mentions, notes = _lab(spark, sf_dir)
    pairs = so.publish_notes(notes, so.standoff_lines(mentions), notes)
    ss.register(spark)
    path = scratch(spark, "pairs")
    pairs.write.format("standoff").mode("append").save(path)
    back = spark.read.format("standoff").load(path)
    return back.select(F.col("source").alias("note_id"), "note_text", "body")


@query("S16_note_store", _ENTITIES)
def s16(spark, sf_dir):
    m2 = _notes_with_entities(spark, sf_dir).select(
        "note_text", "note_id", "entities", F.create_map().cast("map<string,string>").alias("context"),
        F.lit("train").alias("split"))
    path = scratch(spark, "store")
    io.write_note_store(m2, path)
    return _entities_text(io.read_note_store(spark, path))


@query("S17_vector_store", """
select vec_id, list_transform(embedding, lambda x: round(cast(x as double), 6)) vec from embeddings""")
def s17(spark, sf_dir):
    e = tb.tables(spark, sf_dir).embeddings
    path = scratch(spark, "vectors")
    io.write_vectors(e, path, "vec_id", "embedding")
    return spark.read.parquet(path).select(
        "vec_id", F.transform("embedding", lambda x: F.round(x.cast("double"), 6)).alias("vec"))


@query("S18_write_metrics", W("""
select round(tp / (tp + fp), 5) overall_precision, round(tp / (tp + fn), 5) overall_recall,
       round(2.0 * tp / (2 * tp + fp + fn), 5) overall_f1_score
from (select sum(case when g.s is not null and p.s is not null then 1 else 0 end) tp,
             sum(case when g.s is null then 1 else 0 end) fp, sum(case when p.s is null then 1 else 0 end) fn
      from (select distinct source, s, e, label from d_inner) g
      full outer join (select distinct source, s, e, label from d_inner where k % 5 <> 0) p
        on p.source = g.source and p.s = g.s and p.e = g.e and p.label = g.label) t""", "d_inner"))
def s18(spark, sf_dir):
    docs = tb.tables(spark, sf_dir).documents
    inner = tb.d_inner(docs)
    pred = inner.where(F.col("k") % 5 != 0).select("source", "s", "e", "label")
    m = ev.entity_prf_per_type(inner, pred).where(F.col("label") == "ALL").select(
        F.col("precision").alias("Overall Precision"), F.col("recall").alias("Overall Recall"),
        F.col("f1").alias("Overall F1/Score"))
    path = scratch(spark, "metrics")
    io.metrics_from(m).coalesce(1).write.json(path)  # one row
    return spark.read.json(path)


# a technique stands right after its own mention where no negation comes between
_BARE = "not (k % 13 = 0 or k % 7 = 0)"
_D20_SQL = f"""
select source, cast(ln as integer) ln, line from (
  select *, row_number() over (partition by source order by n, kind, j) ln from (
    select source, n, 0 kind, 0 j, true keeps, regexp_replace(concat('T', n, chr(9),
             case when k % 17 = 0 and {_BARE} then 'Dosage' else label end, ' ',
             array_to_string(list_transform(range(1, len(nl) + 2), lambda i: concat(
               s + case when i = 1 then 0 else nl[i - 1] + 1 end, ' ', s + case when i > len(nl) then length(term) else nl[i] end)), ';'),
             chr(9), term), '\\s+$', '') line
    from (select *, {_T} n, list_transform(list_filter(range(1, length(term) + 1), lambda i: substring(term, i, 1) = chr(10)),
                                           lambda i: i - 1) nl from d_inner where label = 'Chemical_and_drugs') m
    union all
    select source, n, 2, case when name = 'Tech' then 1 else 0 end, name <> 'Tech' or not ({_BARE}),
           concat('A', a, chr(9), name, ' T', n, ' ', case when value = '' then 'neg' else value end)
    from ({_ATTRS}) t) u) v
where keeps"""


@query("D20_repair_attributes", W(_D20_SQL, "d_inner"))
def d20(spark, sf_dir):
    m = _drug_mentions_with_attributes(spark, sf_dir)
    lines = so.standoff_lines(m, attributes="attributes")
    w = Window.partitionBy("source").orderBy("_n", "_kind", "_j")
    raw = lines.select("source", F.row_number().over(w).alias("ln"), F.regexp_replace("line", r"\s+$", "").alias("line"))
    return so.repair_attributes(raw)
