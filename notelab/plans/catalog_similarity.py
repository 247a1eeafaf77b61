"""Registered queries: dictionary building and terminology joins (A01, A05,
A07, J10-J13), similarity joins and vector operators (J14-J16, V01-V06,
X19, D09)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from notelab.functions import text as tx
from notelab.operators import dictionary as dc
from notelab.operators import similarity as sim
from notelab.plans import testbed as tb
from notelab.plans.registry import query

W = tb.with_ctes
_NORM_DICT = tx.normalize_term_sql("STR", cased=True, rm_stopwords=True, rm_special=True)


@query("A01_build_dictionary", W(f"""
select str, list_sort(list_distinct(list(code))) codes
from (select {_NORM_DICT} str, CUI code from d_mrconso) t
where not (str = '' or regexp_matches(str, '^[0-9]+$')) group by str""", "d_mrconso"))
def a01(spark, sf_dir):
    return dc.build_dictionary(tb.d_mrconso(tb.tables(spark, sf_dir).part))


@query("A05_strings_per_concept", W("""
select CUI, list_sort(list_distinct(list(STR))) strs, list_sort(list_distinct(list(SAB))) sabs,
       list_sort(list_distinct(list(CODE))) codes
from d_mrconso group by CUI""", "d_mrconso"))
def a05(spark, sf_dir):
    return dc.strings_per_concept(tb.d_mrconso(tb.tables(spark, sf_dir).part))


@query("A07_distinct_counts", W("""
select count(*) n_rows, count(distinct CUI) n_cui, count(distinct STR) n_str, count(distinct SAB) n_sab
from d_mrconso""", "d_mrconso"))
def a07(spark, sf_dir):
    return dc.distinct_counts(tb.d_mrconso(tb.tables(spark, sf_dir).part), ["CUI", "STR", "SAB"])


_J10 = dict(type_name="semantic type T059", sources=("Brand#1", "Brand#2", "Brand#3"), languages=("ENG", "FRE"))


@query("J10_concepts_of_semantic_type", W("""
select distinct CUI, STR from d_mrconso
where LAT in ('ENG', 'FRE')
  and CUI in (select CUI from d_mrsty where STY = 'semantic type T059')
  and CUI in (select CUI from d_mrconso where SAB in ('Brand#1', 'Brand#2', 'Brand#3'))""",
                                          "d_mrconso", "d_mrsty"))
def j10(spark, sf_dir):
    part = tb.tables(spark, sf_dir).part
    return dc.concepts_of_semantic_type(tb.d_mrconso(part), tb.d_mrsty(part), **_J10)


_J11_SQL = """
select s.concept_code source_code, s.concept_name source_name, t.concept_code target_code, t.concept_name target_name
from d_rel r join d_concept s on s.concept_id = r.concept_id_1 and s.vocabulary_id = 'LOINC'
join d_concept t on t.concept_id = r.concept_id_2 and t.vocabulary_id = 'SNOMED'"""


def _crosswalk(t):
    return dc.vocabulary_crosswalk(tb.d_concept(t.part, t.supplier), tb.d_rel(t.lineitem))


@query("J11_vocabulary_crosswalk", W(_J11_SQL, "d_rel", "d_concept"))
def j11(spark, sf_dir):
    return _crosswalk(tb.tables(spark, sf_dir))


@query("J12_map_codes_to_crosswalk", W("""
select c.CUI, list_sort(list_distinct(list(x.target_code))) target_codes,
       list_sort(list_distinct(list(x.target_name))) target_names
from (select distinct CUI, CODE from d_mrconso) c join xw x on x.source_code = c.CODE group by c.CUI""",
                                       "d_rel", "d_concept", "d_mrconso", extra=f"xw as ({_J11_SQL})"))
def j12(spark, sf_dir):
    t = tb.tables(spark, sf_dir)
    return dc.map_codes_to_crosswalk(tb.d_mrconso(t.part), _crosswalk(t))


@query("J13_shared_code_neighbours", W("""
select p.CUI, p.target_code, h.n_concepts
from pairs p join (select target_code, count(*) n_concepts from pairs group by target_code having count(*) > 1) h
  on h.target_code = p.target_code""", "d_rel", "d_concept", "d_mrconso", extra=f"""
xw as ({_J11_SQL}),
pairs as (select distinct c.CUI, x.target_code from d_mrconso c join xw x on x.source_code = c.CODE)"""))
def j13(spark, sf_dir):
    t = tb.tables(spark, sf_dir)
    codes = tb.d_mrconso(t.part).select("CUI", F.col("CODE").alias("source_code")).join(_crosswalk(t), "source_code")
    return dc.shared_code_neighbours(codes)


# -- vectors ------------------------------------------------------------------

def _seq_sum(lst: str) -> str:
    """Left-to-right sum (matches Spark's ``aggregate`` bit for bit)."""
    return f"list_reduce(list_prepend(0.0::double, {lst}), lambda acc, x: acc + x)"


def _norm_sql(v: str) -> str:
    return (f"list_transform(cast({v} as double[]), lambda x: x / greatest(sqrt({_seq_sum(f'list_transform(cast({v} as double[]), lambda y: y * y)')}), 1e-12))")


def _dot_sql(a: str, b: str) -> str:
    return _seq_sum(f"list_transform(range(1, len({a}) + 1), lambda i: {a}[i] * {b}[i])")


@query("X19_l2_normalize", f"""
select vec_id, list_transform({_norm_sql('embedding')}, lambda x: round(x, 6)) unit_vec from embeddings""")
def x19(spark, sf_dir):
    e = tb.tables(spark, sf_dir).embeddings
    return e.select("vec_id", F.transform(sim.l2_normalize(F.col("embedding")), lambda x: F.round(x, 6)).alias("unit_vec"))


# Unit vectors once; DuckDB's own dot product (both sides round its result).
_UNIT_SQL = f"unit as materialized (select vec_id, label, {_norm_sql('embedding')} v from embeddings)"
_J14_SQL = f"""
with {_UNIT_SQL}
select vec_id, best_id, round(s, 6) sim, best_label from (
  select *, row_number() over (partition by vec_id order by round(s, 9) desc, best_id) rn
  from (select q.vec_id, d.vec_id best_id, d.label best_label, list_dot_product(q.v, d.v) s
        from unit q, unit d where q.vec_id % 10 <> 0 and d.vec_id % 10 = 0) p) t
where rn = 1"""


def _rounded_dot(qcol, ccol):
    """Cosine of unit vectors rounded to 9 places, so float noise between
    engines cannot reorder near-ties (ties then go to the smallest id)."""
    return _rounded(sim.dot_scores(qcol, ccol))


def _rounded(score):
    return lambda q, c: np.round(score(q, c), 9)


@query("J14_nearest_concept", _J14_SQL)
def j14(spark, sf_dir):
    e = tb.tables(spark, sf_dir).embeddings.select("vec_id", "label", sim.l2_normalize(F.col("embedding")).alias("v"))
    q = e.where(F.col("vec_id") % 10 != 0).select("vec_id", "v")
    d = e.where(F.col("vec_id") % 10 == 0).select(F.col("vec_id").alias("best_id"), F.col("v").alias("dv"),
                                                  F.col("label").alias("best_label"))
    best = sim.tiled_best_match(q, d.select("best_id", "dv"), "vec_id", "best_id", _rounded_dot("v", "dv"))
    # the score is rounded to 9 places for ranking; report the exact cosine rounded to 6
    out = best.join(q, "vec_id").join(d, "best_id")
    return out.select("vec_id", "best_id", F.round(sim.dot(F.col("v"), F.col("dv")), 6).alias("sim"), "best_label")


_GRAMS3 = ("list_distinct(list_transform(range(1, greatest(length('##' || {x} || '##') - 2, 1) + 1), "
           "lambda i: substring('##' || {x} || '##', i, 3)))")


def _encoded(src: str, ids: str, x: str) -> str:
    """Relation: ids and v, the unit vector of hashed gram counts of ``x``;
    buckets, counts and norm are each computed once."""
    return f"""(
  select {ids}, list_transform(c, lambda x: x / greatest(nrm, 1e-12)) v
  from (select *, sqrt(list_sum(list_transform(c, lambda y: y * y))) nrm
        from (select {ids}, list_transform(range(64), lambda i: cast(len(list_filter(bk, lambda z: z = i)) as double)) c
              from (select {ids}, list_transform({_GRAMS3.format(x=x)},
                           lambda g: cast(('0x' || substring(md5(g), 1, 8)) as bigint) % 64) bk from {src}) a) b) n)"""


@query("V01_encode_terms", W(f"""
select id, list_transform(v, lambda x: round(x, 6)) vec from {_encoded('d_terms', 'id', 'term')} t""", "d_terms"))
def v01(spark, sf_dir):
    t = tb.d_terms(tb.tables(spark, sf_dir).part)
    return t.select("id", F.transform(sim.encode_terms(F.col("term")), lambda x: F.round(x, 6)).alias("vec"))


_CENTROIDS_SQL = """
centroids as (
  select label, list(m order by i) centroid from (
    select label, i, avg(x) m from (
      select label, unnest(cast(embedding as double[])) x, unnest(range(1, len(embedding) + 1)) i from embeddings) a
    group by label, i) b
  group by label)"""


@query("V02_mean_pool", W("select label, list_transform(centroid, lambda x: round(x, 6)) centroid from centroids",
                          extra=_CENTROIDS_SQL))
def v02(spark, sf_dir):
    e = tb.tables(spark, sf_dir).embeddings
    c = sim.mean_pool(e, ["label"], "embedding")
    return c.select("label", F.transform("centroid", lambda x: F.round(x, 6)).alias("centroid"))


@query("V03_class_centroid_cosine", W(f"""
select vec_id, label, pred_label, round(s, 6) sim from (
  select e.vec_id, e.label, c.label pred_label,
         {_dot_sql(_norm_sql('e.embedding'), _norm_sql('c.centroid'))} s,
         row_number() over (partition by e.vec_id order by round({_dot_sql(_norm_sql('e.embedding'), _norm_sql('c.centroid'))}, 9) desc, c.label) rn
  from embeddings e, centroids c) t where rn = 1""", extra=_CENTROIDS_SQL))
def v03(spark, sf_dir):
    e = tb.tables(spark, sf_dir).embeddings
    cent = sim.mean_pool(e, ["label"], "embedding").select(
        F.col("label").alias("pred_label"), sim.l2_normalize(F.col("centroid")).alias("cv"))
    q = e.select("vec_id", "label", sim.l2_normalize(F.col("embedding")).alias("v"))
    best = sim.tiled_best_match(q.select("vec_id", "v"), cent, "vec_id", "pred_label", _rounded_dot("v", "cv"))
    out = best.join(q, "vec_id").join(cent, "pred_label")
    return out.select("vec_id", "label", "pred_label", F.round(sim.dot(F.col("v"), F.col("cv")), 6).alias("sim"))


_BATCH = 32
_V04_SQL = f"""
{_UNIT_SQL},
pairs as (
  select a.vec_id // {_BATCH} batch, a.vec_id a, b.vec_id b, a.label = b.label pos, list_dot_product(a.v, b.v) sim
  from unit a join unit b on a.vec_id // {_BATCH} = b.vec_id // {_BATCH} and a.vec_id <> b.vec_id),
marked as (
  select *, (pos and sim < 1 - 1e-5 and sim - 0.1 < max(case when not pos then sim end) over w)
            or (not pos and sim + 0.1 > min(case when pos and sim < 1 - 1e-5 then sim end) over w) hard
  from pairs window w as (partition by batch, a))"""


def _hard_pairs(spark, sf_dir):
    e = tb.tables(spark, sf_dir).embeddings
    e = e.select("vec_id", "label", sim.l2_normalize(F.col("embedding")).alias("v"),
                 F.expr(f"vec_id div {_BATCH}").alias("batch"))
    return e, sim.hard_pairs(e, "batch", "vec_id", "label", "v")


@query("V04_mine_hard_pairs", W("select batch, a, b, pos, round(sim, 6) sim from marked where hard",
                                extra=_V04_SQL))
def v04(spark, sf_dir):
    _, p = _hard_pairs(spark, sf_dir)
    return p.where("hard").select("batch", "a", "b", "pos", F.round("sim", 6).alias("sim"))


@query("V05_multi_similarity_score", W("""
select n.batch, round(coalesce(t.total, 0) / n.n, 6) score
from (select vec_id // 32 batch, count(*) n from embeddings group by 1) n
left join (select batch, sum(coalesce(ln(1 + sp) / 2.0, 0) + coalesce(ln(1 + sn) / 50.0, 0)) total
           from (select batch, a, sum(case when pos then exp(-2.0 * (sim - 0.5)) end) sp,
                        sum(case when not pos then exp(50.0 * (sim - 0.5)) end) sn
                 from marked where hard group by batch, a) x group by batch) t on t.batch = n.batch""",
                                       extra=_V04_SQL))
def v05(spark, sf_dir):
    e, p = _hard_pairs(spark, sf_dir)
    size = e.groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
    s = sim.multi_similarity_score(p, "batch", size)
    return s.select("batch", F.round("score", 6).alias("score"))


@query("V06_triple_margin_score", """
select round(avg(greatest(0.0, 1.0 + sqrt(list_sum(list_transform(range(1, len(h) + 1),
             lambda i: pow(h[i] + r[i] - t[i], 2))))
         - sqrt(list_sum(list_transform(range(1, len(h) + 1), lambda i: pow(h[i] + r[i] - n[i], 2)))))), 6) score,
       count(*) n_triples
from (select cast(a.embedding as double[]) h, cast(b.embedding as double[]) r, cast(c.embedding as double[]) t,
             cast(d.embedding as double[]) n
      from embeddings a join embeddings b on b.vec_id = a.vec_id + 1 join embeddings c on c.vec_id = a.vec_id + 2
      join embeddings d on d.vec_id = a.vec_id + 3 where a.vec_id % 4 = 0) x""")
def v06(spark, sf_dir):
    e = tb.tables(spark, sf_dir).embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    h = e.where(F.col("vec_id") % 4 == 0).select("vec_id", F.col("v").alias("h"))
    tri = (h.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("r")), "vec_id")
            .join(e.select((F.col("vec_id") - 2).alias("vec_id"), F.col("v").alias("t")), "vec_id")
            .join(e.select((F.col("vec_id") - 3).alias("vec_id"), F.col("v").alias("n")), "vec_id"))
    s = sim.triple_margin_score(tri, "h", "r", "t", "n")
    return s.select(F.round("score", 6).alias("score"), "n_triples")


# -- blocked matching ---------------------------------------------------------

@query("J15_nearest_in_block", W(f"""
select source, k, gold_k, round(s, 6) sim from (
  select *, row_number() over (partition by source, k order by round(s, 9) desc, gold_k) rn
  from (select p.source, p.k, g.k gold_k, list_dot_product(p.v, g.v) s from pv p join gv g on g.source = p.source) x) t
where rn = 1""", "d_pred", "d_gold", extra=f"""
pv as materialized (select * from {_encoded('d_pred', 'source, k', 'term')} a),
gv as materialized (select * from {_encoded('d_gold', 'source, k', 'term')} b)"""))
def j15(spark, sf_dir):
    docs = tb.tables(spark, sf_dir).documents
    p = tb.d_pred(docs).select("source", "k", "term")
    g = tb.d_gold(docs).select("source", F.col("k").alias("gold_k"), "term")

    def encoded(name):
        return lambda rows: rows.withColumn(name, sim.term_codes(F.col("term"))).drop("term")

    out = sim.tiled_best_match(p, g, "k", "gold_k", _rounded(sim.code_dot_scores("pv", "gv")), block=["source"], carry=("pv", "gv"),
                               prepare=(encoded("pv"), encoded("gv")))
    return out.select("source", "k", "gold_k", F.round(sim.code_dot(F.col("pv"), F.col("gv")), 6).alias("sim"))


_GRAMS4 = ("list_distinct(list_transform(range(1, greatest(length('###' || {x} || '###') - 3, 1) + 1), "
           "lambda i: substring('###' || {x} || '###', i, 4)))")


@query("J16_best_string_match", W(f"""
select id, gid, sc / 100.0 score from (
  select t.id, g.gid, (200 * len(list_intersect(a, b)) + len(a) + len(b)) // (2 * (len(a) + len(b))) sc,
         row_number() over (partition by t.id order by
           (200 * len(list_intersect(a, b)) + len(a) + len(b)) // (2 * (len(a) + len(b))) desc, g.gid) rn
  from (select source, id, {_GRAMS4.format(x='term')} a from d_terms) t
  join (select source, gid, {_GRAMS4.format(x='gold_term')} b from d_gold_terms) g on g.source = t.source) x
where rn = 1""", "d_terms", "d_gold_terms"))
def j16(spark, sf_dir):
    part = tb.tables(spark, sf_dir).part
    t = tb.d_terms(part).select("source", "id", tx.ngram_set(F.col("term"), 4).alias("a"))
    g = tb.d_gold_terms(part).select("source", "gid", tx.ngram_set(F.col("gold_term"), 4).alias("b"))
    best = sim.tiled_best_match(t, g, "id", "gid", sim.dice_scores("a", "b"), block=["source"])
    return best.select("id", "gid", (F.col("score") / 100.0).alias("score"))


# -- D09 ----------------------------------------------------------------------

@query("D09_normalize_terms", W(f"""
select t.id, t.term, b.label, b.des from d_terms t join (
  select term, label, des from (
    select q.term, d.codes label, d.str des,
           row_number() over (partition by q.term order by round(list_dot_product(q.v, d.v), 9) desc, d.str) rn
    from qv q, dv d) x
  where rn = 1) b on b.term = t.term""", "d_terms", "d_mrconso", extra=f"""
dict as (select str, list_sort(list_distinct(list(code))) codes
         from (select {_NORM_DICT} str, CUI code from d_mrconso) t
         where not (str = '' or regexp_matches(str, '^[0-9]+$')) group by str),
qv as materialized (select * from {_encoded(f"(select distinct term, {tx.normalize_term_sql('term')} norm from d_terms) a", 'term', 'norm')} b),
dv as materialized (select * from {_encoded('dict', 'str, codes', 'str')} c)"""))
def d09(spark, sf_dir):
    from notelab.plans.normalize import normalize_terms
    part = tb.tables(spark, sf_dir).part
    return normalize_terms(tb.d_terms(part), "term", "id", tb.d_mrconso(part))
