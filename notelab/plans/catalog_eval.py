"""Registered queries: evaluation (E01-E07, A09, A10), evaluation joins
(J05-J07, J18-J21) and the warehouse comparison (J08, J09, A03, A04, O02)."""

from __future__ import annotations

from pyspark.sql import functions as F

from notelab.functions import text as tx
from notelab.operators import evaluation as ev
from notelab.operators import measures as ms
from notelab.plans import sql_measures as sm
from notelab.plans import testbed as tb
from notelab.plans.registry import query

W = tb.with_ctes


def _gp(spark, sf_dir):
    docs = tb.tables(spark, sf_dir).documents
    return tb.d_gold(docs), tb.d_pred(docs)


_GOLD_LABEL = ("case when contains(annotation, '_') then split_part(annotation, '_', 1) "
               "when contains(annotation, ':') then split_part(annotation, ':', 2) else annotation end")

_E01_CTE = f"""
g as (select source, k, s, e, {_GOLD_LABEL} gold_label from d_gold where annotation is not null),
pr as (select g.source, g.k, p.codes from g join d_pred p on p.source = g.source and least(g.e, p.e) > greatest(g.s, p.s)),
e01 as (
  select g.source, g.k, g.gold_label,
         coalesce(list_sort(list_distinct(flatten(list(pr.codes) filter (where pr.codes is not null)))),
                  cast([] as varchar[])) detected,
         count(pr.codes) n_pred
  from g left join pr on pr.source = g.source and pr.k = g.k group by g.source, g.k, g.gold_label),
e01o as (
  select source, k, gold_label, detected,
         case when n_pred = 0 then 'not_pred' when len(detected) = 0 then 'FN'
              when list_contains(detected, gold_label) then 'TP' else 'FP' end outcome from e01)"""


def _e01(spark, sf_dir):
    g, p = _gp(spark, sf_dir)
    return ev.classify_detection(g, p)


@query("E01_classify_detection", W("select * from e01o", "d_gold", "d_pred", extra=_E01_CTE))
def e01(spark, sf_dir):
    return _e01(spark, sf_dir)


@query("A09_outcome_shares", W("""
select outcome, count(*) n, count(*) / sum(count(*)) over () share from e01o group by outcome""",
                               "d_gold", "d_pred", extra=_E01_CTE))
def a09(spark, sf_dir):
    return ev.outcome_shares(_e01(spark, sf_dir))


# Predictions overlapping gold with a measure; X18 equality on parsed measures.
_E02_CTE = sm.unit_ctes() + """,
gm as (select source, k gk, s gs, e ge, left(annotation, instr(annotation, '_') - 1) gcode,
              string_split(substring(annotation, instr(annotation, '_') + 1), ' ') gp
       from d_gold where contains(annotation, '_')),
pp as (select source, k, s, e, codes, found from d_pred),
golds as (select p.source, p.k, g.gcode, g.gp[1] gr, u.dim gdim, try_cast(g.gp[2] as double) * u.scale gbv
          from pp p join gm g on g.source = p.source and least(p.e, g.ge) > greatest(p.s, g.gs)
          left join unit_all u on u.unit = g.gp[3]),
founds as (select f.source, f.k, f.fp[1] fr, u.dim fdim, try_cast(f.fp[2] as double) * u.scale fbv
           from (select source, k, string_split(unnest(found), ' ') fp from pp) f
           left join unit_all u on u.unit = f.fp[3]),
unequal as (select distinct source, k from founds f where not exists (
              select 1 from golds g where g.source = f.source and g.k = f.k and g.gr = f.fr and g.gdim = f.fdim
              and abs(g.gbv - f.fbv) <= 1e-9 * greatest(abs(g.gbv), abs(f.fbv), 1.0))),
pool as (select source, k, list(gcode) gcodes, count(*) n from golds group by source, k),
e02 as (
  select p.source, p.k, 'pred' side,
         case when l.n = len(p.found) and list_has_any(p.codes, l.gcodes) and u.k is null then 'TP' else 'FP' end outcome
  from pp p left join pool l on l.source = p.source and l.k = p.k left join unequal u on u.source = p.source and u.k = p.k
  union all
  select source, gk, 'gold', 'FN' from gm g
  where not exists (select 1 from pp p where p.source = g.source and least(p.e, g.ge) > greatest(p.s, g.gs)))"""


def _e02(spark, sf_dir):
    g, p = _gp(spark, sf_dir)

    def equal(found, gold):
        return ms.measures_equal(F.transform(found, ms.parse_measure), F.transform(gold, ms.parse_measure))

    return ev.classify_full(g, p, equal)


@query("E02_classify_full", W("select * from e02", "d_gold", "d_pred", extra=_E02_CTE))
def e02(spark, sf_dir):
    return _e02(spark, sf_dir)


@query("E04_prf", W("""
select tp, fp, fn, p "precision", r recall, f f1 from (
  select *, case when tp + fp = 0 or tp + fn = 0 or (tp / (tp + fp) + tp / (tp + fn)) = 0 then -1.0
                 else 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)) end f,
            case when tp + fp = 0 or tp + fn = 0 or tp = 0 then -1.0 else tp / (tp + fp) end p,
            case when tp + fp = 0 or tp + fn = 0 or tp = 0 then -1.0 else tp / (tp + fn) end r
  from (select cast(sum(case when outcome = 'TP' then 1 else 0 end) as bigint) tp,
               cast(sum(case when outcome = 'FP' then 1 else 0 end) as bigint) fp,
               cast(sum(case when outcome = 'FN' then 1 else 0 end) as bigint) fn from e02) a) b""",
                    "d_gold", "d_pred", extra=_E02_CTE))
def e04(spark, sf_dir):
    return ev.prf_table(_e02(spark, sf_dir))


@query("E03_any_measure_match", W("""
select count(*) n, cast(sum(hit) as bigint) n_tp, sum(hit) / count(*) "precision" from (
  select p.source, p.k, max(case when list_contains(p.found, substring(g.annotation, instr(g.annotation, '_') + 1)) then 1 else 0 end) hit
  from d_pred p join d_gold g on g.source = p.source and g.k = p.k where contains(g.annotation, '_')
  group by p.source, p.k) t""", "d_pred", "d_gold"))
def e03(spark, sf_dir):
    g, p = _gp(spark, sf_dir)
    j = p.join(g.where(F.col("annotation").contains("_")).select("source", "k", "annotation"), ["source", "k"])
    hit = F.exists("found", lambda f: f == F.split(F.col("annotation"), "_", 2)[1]).cast("int")
    per = j.groupBy("source", "k").agg(F.max(hit).alias("hit"))
    return per.agg(F.count(F.lit(1)).alias("n"), F.sum("hit").cast("bigint").alias("n_tp"),
                   (F.sum("hit") / F.count(F.lit(1))).alias("precision"))


@query("E05_text_set_prf", W("""
select source, tp, fp, fn,
       case when tp + fp = 0 or tp + fn = 0 or tp = 0 then -1.0 else tp / (tp + fp) end "precision",
       case when tp + fp = 0 or tp + fn = 0 or tp = 0 then -1.0 else tp / (tp + fn) end recall,
       case when tp + fp = 0 or tp + fn = 0 or tp = 0 then -1.0
            else 2.0 * tp / (tp + fp) * tp / (tp + fn) / (tp / (tp + fp) + tp / (tp + fn)) end f1
from (select coalesce(g.source, p.source) source,
             cast(sum(case when g.term is not null and p.term is not null then 1 else 0 end) as bigint) tp,
             cast(sum(case when g.term is null then 1 else 0 end) as bigint) fp,
             cast(sum(case when p.term is null then 1 else 0 end) as bigint) fn
      from (select distinct source, term from d_gold) g
      full outer join (select distinct source, term from d_pred where k % 3 <> 0) p
        on p.source = g.source and p.term = g.term
      group by coalesce(g.source, p.source)) t""", "d_gold", "d_pred"))
def e05(spark, sf_dir):
    g, p = _gp(spark, sf_dir)
    return ev.text_set_prf(g, p.where(F.col("k") % 3 != 0))


_E06_PRED = """
select source, case when k % 4 = 0 then s + 1 else s end s, e, label from d_inner where k % 5 <> 0"""


@query("E06_entity_prf_per_type", W(f"""
select coalesce(label, 'ALL') label, tp, fp, fn,
       round(case when tp + fp = 0 or tp + fn = 0 or tp = 0 then -1.0 else tp / (tp + fp) end, 5) "precision",
       round(case when tp + fp = 0 or tp + fn = 0 or tp = 0 then -1.0 else tp / (tp + fn) end, 5) recall,
       round(case when tp + fp = 0 or tp + fn = 0 or tp = 0 then -1.0
                  else 2.0 * tp / (tp + fp) * tp / (tp + fn) / (tp / (tp + fp) + tp / (tp + fn)) end, 5) f1
from (select coalesce(g.label, p.label) label,
             cast(sum(case when g.s is not null and p.s is not null then 1 else 0 end) as bigint) tp,
             cast(sum(case when g.s is null then 1 else 0 end) as bigint) fp,
             cast(sum(case when p.s is null then 1 else 0 end) as bigint) fn
      from (select distinct source, s, e, label from d_inner) g
      full outer join (select distinct * from ({_E06_PRED}) x) p
        on p.source = g.source and p.s = g.s and p.e = g.e and p.label = g.label
      group by rollup (coalesce(g.label, p.label))) t""", "d_inner"))
def e06(spark, sf_dir):
    inner = tb.d_inner(tb.tables(spark, sf_dir).documents)
    pred = inner.where(F.col("k") % 5 != 0).select(
        "source", F.when(F.col("k") % 4 == 0, F.col("s") + 1).otherwise(F.col("s")).alias("s"), "e", "label")
    return ev.entity_prf_per_type(inner, pred)


_E07_COUNTS = """
cnt as (select cast(sum(case when outcome = 'TP' then 1 else 0 end) as bigint) tp,
               cast(sum(case when outcome = 'FP' then 1 else 0 end) as bigint) fp,
               cast(sum(case when outcome = 'FN' then 1 else 0 end) as bigint) fn from e02),
slots as (select b, i, tp, fp, fn, tp + fp + fn n,
                 cast(('0x' || substring(md5(concat('42_', cast(b as varchar), '_', cast(i as varchar))), 1, 8))
                      as bigint) % (tp + fp + fn) idx
          from cnt, range(200) r(b), range(tp + fp + fn) s(i)),
per as (select b, sum(case when idx < tp then 1 else 0 end) tp,
               sum(case when idx >= tp and idx < tp + fp then 1 else 0 end) fp,
               sum(case when idx >= tp + fp then 1 else 0 end) fn from slots group by b),
m as (select case when tp + fp = 0 or tp + fn = 0 or tp = 0 then -1.0 else tp / (tp + fp) end "precision",
             case when tp + fp = 0 or tp + fn = 0 or tp = 0 then -1.0 else tp / (tp + fn) end recall,
             case when tp + fp = 0 or tp + fn = 0 or tp = 0 then -1.0
                  else 2.0 * tp / (tp + fp) * tp / (tp + fn) / (tp / (tp + fp) + tp / (tp + fn)) end f1 from per)"""


@query("E07_bootstrap_exact", W("""
select metric, round(avg(v), 6) mean, round(quantile_cont(v, 0.025), 6) p025, round(quantile_cont(v, 0.975), 6) p975
from (select 'precision' metric, "precision" v from m union all select 'recall', recall from m
      union all select 'f1', f1 from m) x group by metric""", "d_gold", "d_pred",
                                extra=_E02_CTE + "," + _E07_COUNTS))
def e07(spark, sf_dir):
    return ev.bootstrap_exact(_e02(spark, sf_dir), draws=200)


@query("E07_bootstrap_multinomial")
def e07m(spark, sf_dir):
    return ev.bootstrap_multinomial(_e02(spark, sf_dir), draws=100000)


@query("A10_histogram", W("""
select bin, count(*) n, min(lo) lo, min(hi) hi from (
  select case when hi = lo then 1 else least(30, cast(floor((nval_num - lo) / (hi - lo) * 30) as integer) + 1) end bin,
         lo, hi
  from d_labs, (select min(nval_num) lo, max(nval_num) hi from d_labs) b where nval_num is not null) t
group by bin""", "d_labs"))
def a10(spark, sf_dir):
    labs = tb.d_labs(tb.tables(spark, sf_dir).lineitem).where(F.col("nval_num").isNotNull())
    return ev.histogram(labs, "nval_num", 30)


# -- evaluation joins ---------------------------------------------------------

@query("J06_join_annotator_notes", W("""
select m.source, m.k, m.term, a.annotation from d_inner m
left join (select source, k, annotation from d_gold) a on a.source = m.source and a.k = m.k
where m.label = 'BIO' and a.annotation is not null""", "d_inner", "d_gold"))
def j06(spark, sf_dir):
    docs = tb.tables(spark, sf_dir).documents
    m = tb.d_inner(docs).where(F.col("label") == "BIO").select("source", "k", "term")
    notes = tb.d_gold(docs).select("source", "k", "annotation")
    return ev.join_annotator_notes(m, notes)


@query("J07_gold_vs_detected", W("""
select coalesce(g.source, p.source) source, coalesce(g.key, p.key) span_key, g.k gold_k, p.k pred_k,
       coalesce(p.label, g.label) label
from (select source, concat(cast(s as varchar), '_', cast(e as varchar)) key, k, label from d_gold) g
full outer join (select source, concat(cast(s as varchar), '_', cast(e as varchar)) key, k, 'BIO_pred' label
                 from d_pred) p on p.source = g.source and p.key = g.key""", "d_gold", "d_pred"))
def j07(spark, sf_dir):
    g, p = _gp(spark, sf_dir)
    key = F.concat_ws("_", F.col("s").cast("string"), F.col("e").cast("string"))
    gg = g.select("source", key.alias("span_key"), F.col("k").alias("gold_k"), F.col("label").alias("glabel"))
    pp = p.select("source", key.alias("span_key"), F.col("k").alias("pred_k"), F.lit("BIO_pred").alias("plabel"))
    j = gg.join(pp, ["source", "span_key"], "full_outer")
    return j.select("source", "span_key", "gold_k", "pred_k", F.coalesce("plabel", "glabel").alias("label"))


@query("J18_notes_without_detection", W(f"""
select distinct source from d_lab_lines where source not in (
  select source from {sm.valueless('d_lab_lines', 'source, ln', 'line')} x where value = 1.0)""",
                                        "d_lab_lines", extra=sm.unit_ctes()))
def j18(spark, sf_dir):
    t = tb.tables(spark, sf_dir)
    lines = tb.d_lab_lines(t.orders, t.lineitem, t.part)
    pos = lines.select("source", F.explode(ms.valueless_measures(F.col("line"))).alias("m")).where(
        F.col("m.value") == 1.0).select("source")
    return lines.select("source").distinct().join(pos, "source", "left_anti")


@query("J19_restrict_to_known_notes", W("""
select encounter_num, concept_cd, nval_num from d_labs
where encounter_num in (select encounter_num from d_docs where concept_cd = '1-URGENT')""", "d_labs", "d_docs"))
def j19(spark, sf_dir):
    t = tb.tables(spark, sf_dir)
    docs = tb.d_docs(t.orders).where(F.col("concept_cd") == "1-URGENT")
    return tb.d_labs(t.lineitem).join(docs.select("encounter_num"), "encounter_num", "left_semi").select(
        "encounter_num", "concept_cd", "nval_num")


@query("J20_unmapped_gold", W("""
select g.source, g.k from d_gold g where not exists (
  select 1 from d_pred p where p.source = g.source and least(p.e, g.e) > greatest(p.s, g.s))""", "d_gold", "d_pred"))
def j20(spark, sf_dir):
    g, p = _gp(spark, sf_dir)
    return ev.unmapped_gold(g, p).select("source", "k")


@query("J21_explode_and_rejoin", W("""
select source, k, unnest(codes) code, term from d_pred""", "d_pred"))
def j21(spark, sf_dir):
    _, p = _gp(spark, sf_dir)
    return p.select("source", "k", F.explode("codes").alias("code"), "term")


@query("J05_join_by_row_id", W(f"""
select m.source, m.k, count(*) n_measures from d_lab_mentions m
join {sm.measures('d_lab_mentions', 'source, k', 'term')} x on x.source = m.source and x.k = m.k
where m.label = 'BIO_comp' group by m.source, m.k""", "d_lab_mentions", extra=sm.unit_ctes()))
def j05(spark, sf_dir):
    t = tb.tables(spark, sf_dir)
    keys = tb.d_lab_mentions(tb.d_lab_lines(t.orders, t.lineitem, t.part)).where(F.col("label") == "BIO_comp")
    m = keys.select("source", "k", F.explode(ms.extract_measures(F.col("term"))).alias("m"))
    per = m.groupBy("source", "k").agg(F.count(F.lit(1)).alias("n_measures"))
    return keys.select("source", "k").join(per, ["source", "k"], "inner")


# -- warehouse ----------------------------------------------------------------

def _warehouse(t, days: int | None = None):
    docs = tb.d_docs(t.orders).where(F.col("concept_cd") == "1-URGENT").select(
        "encounter_num", "start_date_doc", "observation_blob")
    wanted = t.lineitem.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("encounter_num"))
    docs = docs.join(wanted, "encounter_num", "left_semi")
    labs = tb.d_labs(t.lineitem)
    onto = tb.d_onto(t.part)
    cond = [docs.encounter_num == labs.encounter_num]
    if days is not None:
        cond.append(F.abs(F.datediff(labs.start_date_lab.cast("date"), docs.start_date_doc.cast("date"))) < days)
    j = docs.join(labs, cond).drop(labs.encounter_num).join(onto, labs.concept_cd == onto.c_basecode)
    return j.select("encounter_num", "start_date_doc", "concept_cd", "nval_num", "units_cd", "start_date_lab", "c_name")


_J08_SQL = """
select d.encounter_num, d.start_date_doc, l.concept_cd, l.nval_num, l.units_cd, l.start_date_lab, o.c_name
from d_docs d join d_labs l on l.encounter_num = d.encounter_num {extra}
join d_onto o on o.c_basecode = l.concept_cd
where d.concept_cd = '1-URGENT' and d.encounter_num in (select l_orderkey from lineitem where l_returnflag = 'R')"""


@query("J08_warehouse_join", W(_J08_SQL.format(extra=""), "d_docs", "d_labs", "d_onto"))
def j08(spark, sf_dir):
    return _warehouse(tb.tables(spark, sf_dir))


@query("J09_date_proximity", W(_J08_SQL.format(
    extra="and abs(date_diff('day', cast(d.start_date_doc as date), cast(l.start_date_lab as date))) < 30"),
    "d_docs", "d_labs", "d_onto"))
def j09(spark, sf_dir):
    return _warehouse(tb.tables(spark, sf_dir), days=30)


@query("A04_gold_lists", W(f"""
select encounter_num, term, list_sort(list(c_name)) c_names, list_sort(list(value_text)) gold
from (select encounter_num, c_name,
             regexp_replace(split_part(substring(c_name, instr(c_name, ':') + 1), '_', 1), '^\\s+|\\s+$', '', 'g') term,
             concat_ws(' ', {tx.number_text_sql('nval_num')}, coalesce(units_cd, 'nounit')) value_text
      from j where nval_num is not null) t
group by encounter_num, term""", "d_docs", "d_labs", "d_onto", extra=f"j as ({_J08_SQL.format(extra='')})"))
def a04(spark, sf_dir):
    j = _warehouse(tb.tables(spark, sf_dir)).where(F.col("nval_num").isNotNull())
    j = j.select("encounter_num", "c_name", tx.term_from_path(F.col("c_name")).alias("term"),
                 tx.value_unit_text(F.col("nval_num"), F.coalesce(F.col("units_cd"), F.lit("nounit"))).alias("value_text"))
    return j.groupBy("encounter_num", "term").agg(F.array_sort(F.collect_list("c_name")).alias("c_names"),
                                                  F.array_sort(F.collect_list("value_text")).alias("gold"))


@query("A03_concat_lists", W("""
select source, term, min(k) first_k, list(label order by k) terms, list(concat(label, ' ', s, '-', e) order by k) des,
       flatten(list(codes order by k)) codes, flatten(list(found order by k)) found
from d_pred group by source, term""", "d_pred"))
def a03(spark, sf_dir):
    _, p = _gp(spark, sf_dir)
    # the label plays the part of the mention's own text, its place that of the description
    p = p.select("source", "term", "k", F.col("label").alias("terms"), "codes", "found",
                 F.concat("label", F.lit(" "), F.col("s").cast("string"), F.lit("-"), F.col("e").cast("string")).alias("des"))
    return ev.concat_lists(p, ["source", "term"], "k", ["k"], ["terms", "des"], ["codes", "found"])


@query("O02_random_limit", W("""
select encounter_num from d_docs order by md5(concat('42_', cast(encounter_num as varchar))) limit 500""", "d_docs"))
def o02(spark, sf_dir):
    from notelab.operators import corpus
    d = tb.d_docs(tb.tables(spark, sf_dir).orders)
    return corpus.random_limit(d, "encounter_num", 500).select("encounter_num")
