"""Registered queries: sampling and splits (O03-O07), label statistics (A08),
mention clean-up, overlap resolution and chunking (D17-D19)."""

from __future__ import annotations

from pyspark.sql import functions as F

from notelab.operators import corpus as cp
from notelab.plans import testbed as tb
from notelab.plans.registry import query

W = tb.with_ctes
_HK = "md5(concat('42_', cast({x} as varchar)))"
_HF = "cast(('0x' || substring(md5(concat('42_', {x})), 1, 8)) as bigint) / 4294967296.0"


@query("O03_seeded_shuffle_limit", f"""
select doc_id from documents order by {_HK.format(x='doc_id')}, doc_id limit 100""")
def o03(spark, sf_dir):
    d = tb.tables(spark, sf_dir).documents
    return cp.seeded_shuffle_limit(d, "doc_id", 100).select("doc_id")


@query("O04_sample_n", W(f"""
select uid, label from (
  select *, row_number() over (partition by label order by {_HK.format(x='uid')}, uid) r
  from (select concat(source, '#', cast(k as varchar)) uid, label from d_inner) a) t
where r <= 10""", "d_inner"))
def o04(spark, sf_dir):
    i = tb.d_inner(tb.tables(spark, sf_dir).documents).select(
        F.concat("source", F.lit("#"), F.col("k").cast("string")).alias("uid"), "label")
    return cp.sample_n(i, ["label"], "uid", 10)


@query("O06_positional_split", f"""
select doc_id, case when p < floor(0.8 * n) then 'train' when p < floor(0.9 * n) then 'test' else 'val' end split
from (select doc_id, row_number() over (order by {_HK.format(x='doc_id')}, doc_id) - 1 p, count(*) over () n
      from documents) t""")
def o06(spark, sf_dir):
    d = tb.tables(spark, sf_dir).documents.select("doc_id")
    return cp.positional_split(d, "doc_id")


_O07_CTES = f"""
with_draws as (
  select doc_id, draw, case when f < 0.1 then 'test' when f < 0.2 then 'val' else 'train' end split
  from (select doc_id, draw, {_HF.format(x="concat(cast(draw as varchar), '_', cast(doc_id as varchar))")} f
        from (select distinct doc_id from documents) n, range(1, 21) r(draw)) a),
per_note as (select doc_id, label, count(*) n from d_inner group by doc_id, label),
per_attr as (select draw, label, round(sum(case when split = 'test' then n else 0 end) / sum(n), 2) share
             from with_draws w join per_note p on p.doc_id = w.doc_id group by draw, label),
per_draw as (select draw, sum(share) total from per_attr group by draw),
best as (select arg_min(draw, {{'d': pow(total - 0.2 * (select count(distinct label) from d_inner), 2), 'w': draw}})
         draw from per_draw)"""


@query("O07_balanced_split", W("""
select w.doc_id, w.draw, w.split from with_draws w join best b on b.draw = w.draw""", "d_inner", extra=_O07_CTES))
def o07(spark, sf_dir):
    docs = tb.tables(spark, sf_dir).documents
    return cp.balanced_split(docs.select("doc_id"), tb.d_inner(docs), "doc_id", "label", draws=20)


def _with_attributes(inner):
    attrs = F.map_filter(F.create_map(F.lit("Negation"), F.when(F.col("k") % 7 == 0, F.lit("neg")),
                                      F.lit("Family"), F.when(F.col("k") % 11 == 0, F.lit("fam"))),
                         lambda k, v: v.isNotNull())
    return inner.withColumn("attributes", attrs)


@query("A08_label_distribution", W("""
select kind, name, value, count(*) n from (
  select 'label' kind, label name, null value from d_inner
  union all select 'attribute', 'Negation', null from d_inner where k % 7 = 0
  union all select 'attribute', 'Family', null from d_inner where k % 11 = 0
  union all select 'attribute_value', 'Negation', 'neg' from d_inner where k % 7 = 0
  union all select 'attribute_value', 'Family', 'fam' from d_inner where k % 11 = 0) t
group by kind, name, value""", "d_inner"))
def a08(spark, sf_dir):
    return cp.label_distribution(_with_attributes(tb.d_inner(tb.tables(spark, sf_dir).documents)))


@query("D17_clean_mentions", W("""
select source, k, s, e, term from (
  select source, k, s + length(term) - length(regexp_replace(term, '^\\s+', '')) s,
         e - (length(term) - length(regexp_replace(term, '\\s+$', ''))) e,
         regexp_replace(term, '^\\s+|\\s+$', '', 'g') term
  from d_inner) t
where length(term) > 0 and not regexp_matches(term, '^[!-/:-@\\[-`{-~]+$')""", "d_inner"))
def d17(spark, sf_dir):
    i = tb.d_inner(tb.tables(spark, sf_dir).documents).select("source", "k", "s", "e", "term")
    return cp.clean_mentions(i)


# greedy in order of length: one mention a step, against those kept so far
_D18_SQL = "with recursive " + W("""
select source, own.k, own.s, own.e, own.label from greedy where own is not null""",
                                 "d_mentions", extra="""
ranked as materialized (
  select source, s, e, {'k': k, 's': s, 'e': e, 'label': label} own,
         row_number() over (partition by source order by e - s desc, s, e, k, label) r from d_mentions),
greedy as (
  select distinct source, cast(0 as bigint) r, cast([] as struct(s bigint, e bigint)[]) kept, if(r < 0, own, null) own
  from ranked where r = 1
  union all
  select x.source, x.r, case when clash then kept else list_append(kept, {'s': x.s, 'e': x.e}) end, case when clash then null else x.own end
  from (select y.*, g.kept, len(list_filter(g.kept, lambda z: least(z.e, y.e) > greatest(z.s, y.s))) > 0 clash
        from greedy g join ranked y on y.source = g.source and y.r = g.r + 1) x)""")[len("with "):]


@query("D18_resolve_overlaps", _D18_SQL)
def d18(spark, sf_dir):
    # a key and an inner mention may have the same number
    m = tb.d_mentions(tb.tables(spark, sf_dir).documents).select("source", "s", "e", F.struct("k", "label").alias("mid"))
    return cp.resolve_overlaps(m, mid="mid").select("source", "mid.k", "s", "e", "mid.label")


@query("D19_chunk_notes")
def d19(spark, sf_dir):
    docs = tb.tables(spark, sf_dir).documents
    _, rebased = cp.chunk_notes(docs, tb.d_inner(docs), max_len=128)
    return rebased
