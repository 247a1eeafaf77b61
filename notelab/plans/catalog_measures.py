"""Registered queries: measures (D03-D08, D10, D21, D22) and measure values
(X13, X14, X17, X18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from notelab.functions import text as tx
from notelab.functions import units as un
from notelab.operators import measures as ms
from notelab.plans import lab_results
from notelab.plans import sql_measures as sm
from notelab.plans import testbed as tb
from notelab.plans.registry import query

W = tb.with_ctes
MCOLS = ["value_range", "value", "unit", "dim", "base_value", "start", "end", "lexical_variant"]
MSEL = 'value_range, value, unit, dim, base_value, start, "end", lexical_variant'


def _lab_lines(spark, sf_dir):
    t = tb.tables(spark, sf_dir)
    return tb.d_lab_lines(t.orders, t.lineitem, t.part)


def _explode(df, ids, arr):
    return df.select(*ids, F.explode(arr).alias("m")).select(*ids, *[F.col(f"m.{c}").alias(c) for c in MCOLS])


@query("D03_extract_measures", W(f"select l_orderkey, l_linenumber, {MSEL} from "
                                 f"{sm.measures('d_rx', 'l_orderkey, l_linenumber', 'txt')} x",
                                 "d_rx", extra=sm.unit_ctes()))
def d03(spark, sf_dir):
    t = tb.tables(spark, sf_dir)
    rx = tb.d_rx(t.lineitem, t.part)
    return _explode(rx, ["l_orderkey", "l_linenumber"], ms.extract_measures(F.col("txt")))


# French words of the numbers below 17 and of the tens.
_UNITS = ("zero un deux trois quatre cinq six sept huit neuf dix onze douze treize quatorze quinze seize").split()
_TENS = {20: "vingt", 30: "trente", 40: "quarante", 50: "cinquante"}


def _spell(n: int) -> str:
    if n < 17:
        return _UNITS[n]
    if n < 20:
        return "dix-" + _UNITS[n - 10]
    ten, one = n - n % 10, n % 10
    return _TENS[ten] + ("" if one == 0 else " et un" if one == 1 else "-" + _UNITS[one])


_SPELLED = [_spell(n) for n in range(1, 60)]
# {w} and {v} stand for the words of a quantity and of a larger one, {d} and {c} for
# the digits of both
_SPOKEN_FORMS = ("prise de {w} g de sucre", "glycémie {d} à {c} mmol/l à jeun", "entre {w} et {v} mg par l", "CRP {d}-{c} mg/l",
                 "de {w} à {v} UI", "inférieur à {w} g/l", "Cent {w} mg", "{c} à {d} g, deux cents mg")


def d_spoken(lineitem):
    """Sentences with spelled quantities and ranges: ``l_orderkey, l_linenumber, txt``."""
    n = F.col("l_quantity").cast("int")
    m = n + 1 + F.col("l_linenumber").cast("int")
    spelled = F.array(*[F.lit(w) for w in _SPELLED])
    forms = F.array(*[F.lit(f) for f in _SPOKEN_FORMS])
    txt = forms[F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(len(_SPOKEN_FORMS))).cast("int")]
    for mark, value in (("{w}", spelled[n - 1]), ("{v}", spelled[m - 1]), ("{d}", n.cast("string")), ("{c}", m.cast("string"))):
        txt = F.replace(txt, F.lit(mark), value)
    return lineitem.select("l_orderkey", "l_linenumber", txt.alias("txt"))


def _list_sql(values):
    return "[" + ", ".join(sm.q(v) for v in values) + "]"


_D_SPOKEN = f"""
d_spoken as materialized (
  select l_orderkey, l_linenumber, replace(replace(replace(replace(f, '{{w}}', {_list_sql(_SPELLED)}[n]), '{{v}}', {_list_sql(_SPELLED)}[m]),
         '{{d}}', cast(n as varchar)), '{{c}}', cast(m as varchar)) txt
  from (select l_orderkey, l_linenumber, cast(l_quantity as integer) n, cast(l_quantity as integer) + 1 + cast(l_linenumber as integer) m,
               {_list_sql(_SPOKEN_FORMS)}[(l_orderkey + l_linenumber) % {len(_SPOKEN_FORMS)} + 1] f from lineitem) x),"""


@query("D03_spoken_measures", "with " + _D_SPOKEN.strip() + f"""
{sm.unit_ctes()}
select l_orderkey, l_linenumber, {MSEL} from {sm.spoken_measures('d_spoken', 'l_orderkey, l_linenumber', 'txt')} x""")
def d03_spoken(spark, sf_dir):
    said = d_spoken(tb.tables(spark, sf_dir).lineitem)
    return _explode(said, ["l_orderkey", "l_linenumber"], ms.extract_measures(F.col("txt"), spoken=True))


@query("D04_valueless_measures", W(f"select source, ln, {MSEL} from "
                                   f"{sm.valueless('d_lab_lines', 'source, ln', 'line')} x",
                                   "d_lab_lines", extra=sm.unit_ctes()))
def d04(spark, sf_dir):
    lines = _lab_lines(spark, sf_dir)
    return _explode(lines, ["source", "ln"], ms.valueless_measures(F.col("line")))


@query("D05_unitless_measures", W(f"select source, ln, {MSEL} from "
                                  f"{sm.unitless('d_lab_lines', 'source, ln', 'line', 'm3')} x",
                                  "d_lab_lines", extra=sm.unit_ctes() + ",\nm3 as (select * from "
                                  + sm.measures("d_lab_lines", "source, ln", "line") + " y)"))
def d05(spark, sf_dir):
    lines = _lab_lines(spark, sf_dir)
    d03 = ms.extract_measures(F.col("line"))
    return _explode(lines, ["source", "ln"], ms.unitless_measures(F.col("line"), d03))


_DATE = r"\b([0-3]?[0-9])/([01]?[0-9])/([0-9]{4})\b"


@query("D21_detect_dates", W(f"""
select source, ln, start, cast(start + length(m) as integer) "end",
       make_date(cast(g3 as integer), cast(g2 as integer), cast(g1 as integer)) date
from {sm.find_all('d_lab_lines', 'source, ln', 'line', _DATE, (1, 2, 3))} x""", "d_lab_lines"))
def d21(spark, sf_dir):
    lines = _lab_lines(spark, sf_dir)
    return ms.detect_dates(lines, ["source", "ln"], F.col("line"))


_LINES_SQL = """
lines as (
  select source, i, parts[i] line,
         cast(coalesce(list_sum(list_transform(parts[1:i - 1], lambda x: length(x) + 1)), 0) as integer) lstart,
         length(parts[i]) - length(replace(parts[i], '|', '')) cnt
  from (select source, parts, unnest(range(1, len(parts) + 1)) i
        from (select source, string_split(note_text, chr(10)) parts from d_lab_notes) a) b),
tlines as (
  select * from (select *, lag(cnt) over (partition by source order by i) pc,
                           lead(cnt) over (partition by source order by i) nc from lines) c
  where cnt >= 1 and (pc = cnt or nc = cnt))"""


@query("D22_detect_tables", W("""
select n.source, cast(count(t.i) as integer) n_table_lines, count(t.i) > 0 has_table
from d_lab_notes n left join tlines t on t.source = n.source group by n.source""",
                              "d_lab_notes", extra=_LINES_SQL))
def d22(spark, sf_dir):
    notes = tb.d_lab_notes(_lab_lines(spark, sf_dir))
    return ms.detect_tables(notes)


_TM_SQL = f"""
tm as (select source, value_range, value, unit, dim, base_value, cast(start + lstart as integer) start,
              cast("end" + lstart as integer) "end", lexical_variant
       from {sm.measures('tlines', 'source, i, lstart', 'line', table_mode=True)} x)"""


@query("D06_extract_table_measures", W(f"select source, {MSEL} from tm", "d_lab_notes",
                                       extra=sm.unit_ctes() + "," + _LINES_SQL + "," + _TM_SQL))
def d06(spark, sf_dir):
    notes = tb.d_lab_notes(_lab_lines(spark, sf_dir))
    t = ms.extract_table_measures(notes)
    return t.select("source", *[F.col(f"m.{c}").alias(c) for c in MCOLS])


def _crop_ctes(keys: str, inner: str, labels: tuple[str, ...]) -> str:
    lab = ", ".join(f"'{x}'" for x in labels)
    return f"""
pairs as (
  select k.source, k.k, i.k ik, greatest(k.s, i.s) cs, least(k.e, i.e) ce, i.label ilabel, i.term iterm
  from {keys} k join {inner} i on k.source = i.source and least(k.e, i.e) >= greatest(k.s, i.s)
  where not (greatest(k.s, i.s) = 0 and least(k.e, i.e) = 0)),
crops as (select source, k, cs, ce from pairs where ilabel in ({lab})),
ordered as (
  select *, max(ce) over (partition by source, k order by cs, ce
                          rows between unbounded preceding and 1 preceding) prev_max from crops),
isl as (
  select *, sum(case when prev_max is null or cs > prev_max then 1 else 0 end)
            over (partition by source, k order by cs, ce rows unbounded preceding) g from ordered),
merged as (select source, k, g, min(cs) ms, max(ce) me from isl group by source, k, g),
pieces as (
  select m.source, m.k, m.g, m.ms, m.me, ks.s, ks.e, ks.term,
         coalesce(lag(m.me) over (partition by m.source, m.k order by m.g), ks.s) prev_end,
         max(m.me) over (partition by m.source, m.k) last_end
  from merged m join {keys} ks on ks.source = m.source and ks.k = m.k),
cropped as (
  select source, k,
         string_agg(case when ms - prev_end > 0
                         then substring(term, cast(prev_end - s + 1 as integer), cast(ms - prev_end as integer))
                         else '' end, '' order by g)
         || max(case when e - last_end > 0
                     then substring(term, cast(last_end - s + 1 as integer), cast(e - last_end as integer))
                     else '' end) txt
  from pieces group by source, k),
linked as (select source, k, list(iterm order by ik) linked from pairs where ilabel in ({lab}) group by source, k)"""


_VARIANT_RX = ("'(?i)\\b(?:' || array_to_string(list_transform(list_sort(list_transform(list_distinct(variants), "
               "lambda x: {'l': -length(x), 's': x})), lambda y: '\\Q' || y.s || '\\E'), '|') || ')\\b'")


def _d10_sql(only_tables: bool) -> str:
    extra = (sm.unit_ctes() + ",\n"
             "lkeys as (select * from d_lab_mentions where label = 'BIO_comp'),\n"
             "linner as (select * from d_lab_mentions where label in ('BIO')),"
             + _crop_ctes("lkeys", "linner", ("BIO",)) + """,
kc as (select ks.source, ks.k, ks.s, ks.e, ks.term, coalesce(c.txt, ks.term) ctext,
              coalesce(l.linked, cast([] as varchar[])) linked
       from lkeys ks left join cropped c on c.source = ks.source and c.k = ks.k
       left join linked l on l.source = ks.source and l.k = ks.k),
m3 as (select * from """ + sm.measures("kc", "source, k", "ctext") + """ x),
allm as (
  select source, k, value_range, value, unit, start, "end", lexical_variant from m3
  union all select source, k, value_range, value, unit, start, "end", lexical_variant from """
             + sm.unitless("kc", "source, k", "ctext", "m3") + """ y
  union all select source, k, value_range, value, unit, start, "end", lexical_variant from """
             + sm.valueless("kc", "source, k", "ctext") + """ z),
fnd as (select source, k, list(""" + sm.format_measure() + """ order by start, "end") found,
               list(lexical_variant order by start, "end") variants from allm group by source, k),
kf as (select kc.*, f.found, f.variants from kc join fnd f on f.source = kc.source and f.k = kc.k),"""
             + _LINES_SQL + "," + _TM_SQL + """,
tmk as (select * from tm t where not exists (
          select 1 from linner b where b.source = t.source and least(t."end", b.e) >= greatest(t.start, b.s)
            and not (greatest(t.start, b.s) = 0 and least(t."end", b.e) = 0))),
att as (select k.source, k.k, list(""" + sm.format_measure("t") + """ order by t.start, t."end") table_found
        from kf k join tmk t on k.source = t.source and least(k.e, t."end") >= greatest(k.s, t.start)
        where not (greatest(k.s, t.start) = 0 and least(k.e, t."end") = 0)
        group by k.source, k.k)""")
    if only_tables:
        found, where = "a.table_found", "where a.table_found is not null"
    else:
        found, where = "case when len(a.table_found) > 0 then a.table_found else kf.found end", ""
    return W(f"""
select kf.source, kf.k, kf.s, kf.e, kf.term,
       case when len(kf.linked) = 0 then [regexp_replace(kf.term, {_VARIANT_RX}, '', 'g')] else kf.linked end
         terms_linked_to_measurement,
       {found} found
from kf left join att a on a.source = kf.source and a.k = kf.k {where}""",
             "d_lab_mentions", "d_lab_notes", extra=extra)


def _d10(spark, sf_dir, only_tables=False):
    lines = tb.stored(_lab_lines(spark, sf_dir), "lab-lines", "source")  # read four times
    return lab_results.extract_lab_results(tb.d_lab_mentions(lines), tb.d_lab_notes(lines),
                                           only_tables=only_tables)


@query("D10_extract_lab_results", _d10_sql(False))
def d10(spark, sf_dir):
    return _d10(spark, sf_dir)


@query("D07_override_only_tables", _d10_sql(True))
def d07(spark, sf_dir):
    return _d10(spark, sf_dir, only_tables=True)


# -- X13, X14, X17, X18 -------------------------------------------------------

@query("X13_format_measure", W(f"select l_orderkey, l_linenumber, {sm.format_measure()} measure from "
                               f"{sm.measures('d_rx', 'l_orderkey, l_linenumber', 'txt')} x",
                               "d_rx", extra=sm.unit_ctes()))
def x13(spark, sf_dir):
    t = tb.tables(spark, sf_dir)
    rx = tb.d_rx(t.lineitem, t.part)
    m = rx.select("l_orderkey", "l_linenumber", F.explode(ms.extract_measures(F.col("txt"))).alias("m"))
    return m.select("l_orderkey", "l_linenumber", ms.format_measure(F.col("m")).alias("measure"))


_X13P_SQL = """
select source, k, vr value_range, try_cast(v as double) value, u unit, i.dim,
       try_cast(v as double) * i.scale base_value
from (select source, k, p, case when len(p) >= 3 then p[1] else '=' end vr,
             case when len(p) >= 3 then p[2] else p[1] end v, case when len(p) >= 3 then p[3] else p[2] end u
      from (select source, k, regexp_split_to_array(trim(substring(annotation, instr(annotation, '_') + 1)), ' +') p
            from d_gold where contains(annotation, '_')) a) b
left join unit_all i on i.unit = b.u"""


@query("X13_parse_measure", W(_X13P_SQL, "d_gold", extra=sm.unit_ctes()))
def x13p(spark, sf_dir):
    g = tb.d_gold(tb.tables(spark, sf_dir).documents).where(F.col("annotation").contains("_"))
    m = ms.parse_measure(F.split(F.col("annotation"), "_", 2)[1])
    return g.select("source", "k", *[m[c].alias(c) for c in ("value_range", "value", "unit", "dim", "base_value")])


_TOKENS_SQL = """
select source, ln, unnest(regexp_extract_all(translate(lower(line), '{f}', '{t}'), '[a-z]+', 0)) token
from d_lab_lines""".format(f=tx.FOLD_FROM.replace("'", "''"), t=tx.FOLD_TO.replace("'", "''"))


@query("X14_abbreviation_match", W(f"""
select t.source, t.ln, t.token, b.v value from ({_TOKENS_SQL}) t join bool_terms b on b.term = t.token""",
                                   "d_lab_lines", extra=sm.unit_ctes()))
def x14(spark, sf_dir):
    lines = _lab_lines(spark, sf_dir)
    toks = lines.select("source", "ln", F.explode(F.regexp_extract_all(
        ms.normalize_for_matching(F.col("line")), F.lit("[a-z]+"), 0)).alias("token"))
    return ms.abbreviation_match(toks, "token")


@query("X17_convert_unit", W("""
select encounter_num, concept_cd, nval_num * i.scale / j.scale value_g
from d_labs l join unit_info i on i.unit = l.units_cd join unit_info j on j.unit = 'g'
where i.dim = j.dim""", "d_labs", extra=sm.unit_ctes()))
def x17(spark, sf_dir):
    labs = tb.d_labs(tb.tables(spark, sf_dir).lineitem)
    v = un.convert_unit(F.col("nval_num"), F.col("units_cd"), F.lit("g"))
    return labs.where(un.unit_dim(F.col("units_cd")) == "mass").select("encounter_num", "concept_cd",
                                                                      v.alias("value_g"))


_X18_SQL = """
with_gold as (
  select p.source, p.k, p.found, g.annotation from d_pred p join d_gold g on g.source = p.source and g.k = p.k
  where contains(g.annotation, '_')),
pf as (select source, k, regexp_split_to_array(unnest(found), ' ') p from with_gold),
gf as (select source, k, regexp_split_to_array(substring(annotation, instr(annotation, '_') + 1), ' ') p from with_gold),
pm as (select source, k, p[1] vr, i.dim, try_cast(p[2] as double) * i.scale bv from pf
       left join unit_all i on i.unit = p[3]),
gm as (select source, k, p[1] vr, i.dim, try_cast(p[2] as double) * i.scale bv from gf
       left join unit_all i on i.unit = p[3]),
per_found as (
  select pm.source, pm.k, bool_or(coalesce(pm.dim = gm.dim and abs(pm.bv - gm.bv) <= 1e-9 * greatest(abs(pm.bv),
         abs(gm.bv), 1.0) and pm.vr = gm.vr, false)) ok
  from pm left join gm on gm.source = pm.source and gm.k = pm.k group by pm.source, pm.k)"""


@query("X18_measures_equal", W("""
select w.source, w.k, len(w.found) = 1 and coalesce(bool_and(f.ok), true) equal
from with_gold w left join per_found f on f.source = w.source and f.k = w.k group by w.source, w.k, w.found""",
                               "d_pred", "d_gold", extra=sm.unit_ctes() + "," + _X18_SQL))
def x18(spark, sf_dir):
    docs = tb.tables(spark, sf_dir).documents
    p = tb.d_pred(docs)
    g = tb.d_gold(docs).where(F.col("annotation").contains("_")).select("source", "k", "annotation")
    j = p.join(g, ["source", "k"])
    found = F.transform("found", ms.parse_measure)
    gold = F.array(ms.parse_measure(F.split(F.col("annotation"), "_", 2)[1]))
    return j.select("source", "k", ms.measures_equal(found, gold).alias("equal"))
