"""Registered queries: span joins and the crop/link step (J01-J05, A11, X05,
D02, E08)."""

from __future__ import annotations

from pyspark.sql import functions as F

from notelab.operators import spans
from notelab.plans import testbed as tb
from notelab.plans.registry import query

# Oracle building blocks ------------------------------------------------------

_PAIRS_CLOSED = """
select k.source, k.k, i.k ik, greatest(k.s, i.s) cs, least(k.e, i.e) ce, i.label ilabel, i.term iterm
from d_keys k join d_inner i on k.source = i.source and least(k.e, i.e) >= greatest(k.s, i.s)
where not (greatest(k.s, i.s) = 0 and least(k.e, i.e) = 0)"""


def _crop_sql(labels: tuple[str, ...]) -> str:
    """DuckDB: key text minus the merged crops of the given inner labels."""
    lab = ", ".join(f"'{x}'" for x in labels)
    return f"""
pairs as ({_PAIRS_CLOSED}),
crops as (select source, k, ik, cs, ce from pairs where ilabel in ({lab})),
ordered as (
  select *, max(ce) over (partition by source, k order by cs, ce, ik
                          rows between unbounded preceding and 1 preceding) prev_max
  from crops),
isl as (
  select *, sum(case when prev_max is null or cs > prev_max then 1 else 0 end)
            over (partition by source, k order by cs, ce, ik rows unbounded preceding) g
  from ordered),
merged as (select source, k, g, min(cs) ms, max(ce) me from isl group by source, k, g),
pieces as (
  select m.source, m.k, m.g, m.ms, m.me, ks.s, ks.e, ks.term,
         coalesce(lag(m.me) over (partition by m.source, m.k order by m.g), ks.s) prev_end,
         max(m.me) over (partition by m.source, m.k) last_end
  from merged m join d_keys ks on ks.source = m.source and ks.k = m.k),
cropped as (
  select source, k,
         string_agg(case when ms - prev_end > 0
                         then substring(term, cast(prev_end - s + 1 as integer), cast(ms - prev_end as integer))
                         else '' end, '' order by g)
         || max(case when e - last_end > 0
                     then substring(term, cast(last_end - s + 1 as integer), cast(e - last_end as integer))
                     else '' end) txt
  from pieces group by source, k)"""


D02_SQL = tb.with_ctes(
    """
select ks.source, ks.k, ks.s, ks.e, ks.term,
       coalesce(c.txt, ks.term) term_labels_removed,
       coalesce(l.linked, cast([] as varchar[])) terms_linked_to_measurement
from d_keys ks left join cropped c on c.source = ks.source and c.k = ks.k
left join linked l on l.source = ks.source and l.k = ks.k""", "d_keys", "d_inner",
    extra=_crop_sql(("BIO",)) + """,
linked as (select source, k, list(iterm order by ik) linked from pairs
           where ilabel in ('BIO') group by source, k)""")


@query("D02_remove_inner_labels", D02_SQL)
def d02(spark, sf_dir):
    docs = tb.tables(spark, sf_dir).documents
    return spans.remove_inner_labels(tb.d_mentions(docs))


@query("J01_overlap_closed", tb.with_ctes("""
select k.source, k.k, i.k k2, greatest(k.s, i.s) cs, least(k.e, i.e) ce
from d_keys k join d_inner i on k.source = i.source and least(k.e, i.e) >= greatest(k.s, i.s)""",
                                          "d_keys", "d_inner"))
def j01(spark, sf_dir):
    docs = tb.tables(spark, sf_dir).documents
    keys = tb.d_keys(docs).select("source", "k", "s", "e")
    inner = tb.d_inner(docs).select("source", F.col("k").alias("k2"), F.col("s").alias("s2"),
                                    F.col("e").alias("e2"))
    j = spans.overlap_join(keys, inner, ["source"], ("s", "e"), ("s2", "e2"), closed=True)
    return j.select("source", "k", "k2", F.greatest("s", "s2").alias("cs"), F.least("e", "e2").alias("ce"))


@query("J02_overlap_halfopen", tb.with_ctes("""
select k.source, k.k, i.k k2
from d_keys k join d_inner i on k.source = i.source and least(k.e, i.e) > greatest(k.s, i.s)""",
                                            "d_keys", "d_inner"))
def j02(spark, sf_dir):
    docs = tb.tables(spark, sf_dir).documents
    keys = tb.d_keys(docs).select("source", "k", "s", "e")
    inner = tb.d_inner(docs).select("source", F.col("k").alias("k2"), F.col("s").alias("s2"),
                                    F.col("e").alias("e2"))
    j = spans.overlap_join(keys, inner, ["source"], ("s", "e"), ("s2", "e2"), closed=False)
    return j.select("source", "k", "k2")


_ALL = ("BIO", "DISO", "Chemical_and_drugs")


@query("A11_merge_intervals", tb.with_ctes("select source, k, ms cs, me ce from merged",
                                           "d_keys", "d_inner", extra=_crop_sql(_ALL)))
def a11(spark, sf_dir):
    docs = tb.tables(spark, sf_dir).documents
    keys = tb.d_keys(docs).select("source", "k", "s", "e")
    inner = tb.d_inner(docs).select("source", F.col("s").alias("s2"), F.col("e").alias("e2"))
    j = spans.overlap_join(keys, inner, ["source"], ("s", "e"), ("s2", "e2"), closed=True)
    cs, ce = F.greatest("s", "s2"), F.least("e", "e2")
    segs = j.where(~((cs == 0) & (ce == 0))).groupBy("source", "k").agg(
        F.collect_list(F.struct(cs.cast("bigint").alias("cs"), ce.cast("bigint").alias("ce"))).alias("seg"))
    return segs.select("source", "k", F.explode(spans.merge_segments(F.col("seg"))).alias("m")).select(
        "source", "k", F.col("m.cs").alias("cs"), F.col("m.ce").alias("ce"))


@query("X05_crop_spans", tb.with_ctes("""
select ks.source, ks.k, coalesce(c.txt, ks.term) cropped
from d_keys ks left join cropped c on c.source = ks.source and c.k = ks.k""",
                                      "d_keys", "d_inner", extra=_crop_sql(_ALL)))
def x05(spark, sf_dir):
    docs = tb.tables(spark, sf_dir).documents
    out = spans.remove_inner_labels(tb.d_mentions(docs),
                                    labels_to_remove=("BIO", "DISO", "Chemical_and_drugs"),
                                    labels_linkable=())
    return out.select("source", "k", F.col("term_labels_removed").alias("cropped"))


# Inner DISO mentions play the part of table measurements.
_J03_SQL = """
select m.source, m.k, m.s, m.e, m.term from d_inner m
where m.label = 'DISO' and not exists (
  select 1 from d_inner b where b.source = m.source and b.label = 'BIO'
    and least(m.e, b.e) >= greatest(m.s, b.s)
    and not (greatest(m.s, b.s) = 0 and least(m.e, b.e) = 0))"""


def _table_measures(docs):
    inner = tb.d_inner(docs)
    measures = inner.where(F.col("label") == "DISO").select("source", "k", "s", "e", "term")
    discr = inner.where(F.col("label") == "BIO").select("source", F.col("s").alias("bs"), F.col("e").alias("be"))
    return spans.drop_discriminated(measures, discr)


@query("J03_drop_discriminated", tb.with_ctes(_J03_SQL, "d_inner"))
def j03(spark, sf_dir):
    return _table_measures(tb.tables(spark, sf_dir).documents)


@query("J04_attach_table_measures", tb.with_ctes("""
select ks.source, ks.k, coalesce(a.table_measures, cast([] as varchar[])) table_measures
from d_keys ks left join att a on a.source = ks.source and a.k = ks.k""", "d_keys", "d_inner", extra=f"""
surv as ({_J03_SQL}),
att as (
  select k.source, k.k, list(m.term order by m.s, m.k) table_measures
  from d_keys k join surv m on k.source = m.source and least(k.e, m.e) >= greatest(k.s, m.s)
  where not (greatest(k.s, m.s) = 0 and least(k.e, m.e) = 0)
  group by k.source, k.k)"""))
def j04(spark, sf_dir):
    docs = tb.tables(spark, sf_dir).documents
    keys = tb.d_keys(docs).select("source", "k", "s", "e")
    return spans.attach_measures(keys, _table_measures(docs), ["source", "k"], value_col="term",
                                  order_by=("s", "k"))


@query("E08_overlap_coverage", tb.with_ctes("""
select count(*) n_keys, cast(sum(u) as bigint) n_uncovered, sum(u) / count(*) share_uncovered
from (select case when exists (select 1 from d_inner b where b.source = k.source and b.label = 'BIO'
                                and least(k.e, b.e) >= greatest(k.s, b.s)) then 0 else 1 end u
      from d_keys k) t""", "d_keys", "d_inner"))
def e08(spark, sf_dir):
    docs = tb.tables(spark, sf_dir).documents
    keys = tb.d_keys(docs).select("source", "k", "s", "e")
    bio = tb.d_inner(docs).where(F.col("label") == "BIO").select(
        "source", F.col("s").alias("bs"), F.col("e").alias("be"))
    return spans.overlap_coverage(keys, bio, ["source"], ["k"])
