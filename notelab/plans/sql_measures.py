"""DuckDB text of the measurement grammar, for the oracle side only.

The grammar's fixed values (unit terms, patterns) are shared with the Spark
operators; the extraction logic is written again in SQL (list functions
instead of array folds) so the two sides check each other.
"""

from __future__ import annotations

from notelab.functions import numbers as nb
from notelab.functions import text as tx
from notelab.functions import units as un
from notelab.operators import measures as ms


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def unit_ctes(units: tuple = ()) -> str:
    terms = un.term_table(tuple(units) or tuple(u for u in un.UNITS))
    tt = ", ".join(f"({q(t)}, {q(u)})" for t, u in terms.items())
    ui = ", ".join(f"({q(u.name)}, {q(u.dim)}, {float(u.scale)!r}::double)" for u in un.UNITS)
    rt = ", ".join(f"({q(t)}, {q(v)})" for t, v in un.RANGE_TERMS)
    bt = ", ".join(f"({q(t)}, {v!r}::double)" for t, v in ms.valueless_table().items())
    return (f"unit_terms(term, unit) as (values {tt}),\n"
            f"unit_info(unit, dim, scale) as (values {ui}, ('bool', 'bool', 1.0::double)),\n"
            "unit_all(unit, dim, scale) as (select unit, dim, scale from unit_info union all "
            "select a.unit || '_per_' || b.unit, a.dim || '_per_' || b.dim, a.scale / b.scale "
            "from unit_info a, unit_info b where a.unit <> 'bool' and b.unit <> 'bool'),\n"
            f"range_terms(term, vr) as (values {rt}),\n"
            f"bool_terms(term, v) as (values {bt})")


def norm(x: str) -> str:
    f = tx.FOLD_FROM.replace("'", "''")
    t = tx.FOLD_TO.replace("'", "''")
    return f"translate(lower({x}), '{f}', '{t}')"


def find_all(src: str, ids: str, text: str, pattern: str, groups: tuple[int, ...]) -> str:
    """One row per match: ids, _txt, start (0-based), m, g<k>."""
    p = q(pattern)
    gl = "".join(f", regexp_extract_all(_norm, {p}, {g}) _g{g}" for g in groups)
    gs = "".join(f", coalesce(_g{g}[_mi], '') g{g}" for g in groups)
    return f"""(
  select {ids}, _txt, ms[_mi] m, cast(
           coalesce(list_sum(list_transform(ps[1:_mi], lambda x: length(x))), 0)
         + coalesce(list_sum(list_transform(ms[1:_mi - 1], lambda x: length(x))), 0) as integer) start{gs}
  from (select *, unnest(range(1, len(ms) + 1)) _mi
        from (select {ids}, _txt, regexp_extract_all(_norm, {p}, 0) ms,
                     regexp_split_to_array(_norm, {p}) ps{gl}
              from (select {ids}, {text} _txt, {norm(text)} _norm from {src}) a) b) c)"""


def measures(src: str, ids: str, text: str, table_mode: bool = False, units: tuple = ()) -> str:
    """D03 rows: ids, value_range, value, unit, dim, base_value, start, end,
    lexical_variant."""
    pat = ms.measure_pattern(units, table_mode=table_mode)
    f = find_all(src, ids, text, pat, (1, 2, 3, 4))
    idc = ", ".join(f"f.{c.strip()}" for c in ids.split(","))
    return f"""(
  select {idc}, coalesce(r.vr, '=') value_range, v value,
         case when f.g4 = '' then t1.unit else t1.unit || '_per_' || t2.unit end unit,
         case when f.g4 = '' then i1.dim else i1.dim || '_per_' || i2.dim end dim,
         v * case when f.g4 = '' then i1.scale else i1.scale / i2.scale end base_value,
         f.start, cast(f.start + length(f.m) as integer) "end",
         substring(f._txt, f.start + 1, length(f.m)) lexical_variant
  from (select *, cast(replace(g2, ',', '.') as double) v from {f} where g2 <> '') f
  left join range_terms r on r.term = f.g1
  left join unit_terms t1 on t1.term = f.g3
  left join unit_terms t2 on t2.term = f.g4
  left join unit_info i1 on i1.unit = t1.unit
  left join unit_info i2 on i2.unit = t2.unit)"""


def number(x: str) -> str:
    """The value of digits or French number words, null if ``x`` is empty."""
    words = ", ".join(f"{q(w)}: {v!r}::double" for w, v in nb.NUMBER_WORDS.items())
    values = (f"list_transform(list_filter(regexp_split_to_array({x}, '[\\s-]+'), lambda w: w not in ('', 'et')), "
              f"lambda w: {{'total': 0::double, 'hand': 0::double, 'v': map {{{words}}}[w]}})")
    spoken = f"""list_reduce(list_prepend({{'total': 0::double, 'hand': 0::double, 'v': 0::double}}, {values}), lambda a, b: {{
      'total': a.total + case when b.v = 1000 then greatest(a.hand, 1) * 1000 else 0 end,
      'hand': case when b.v = 1000 then 0 when b.v = 100 then greatest(a.hand, 1) * 100
                   when b.v = 20 and a.hand % 10 = 4 then a.hand + 76 else a.hand + b.v end, 'v': b.v}})"""
    return f"""case when regexp_matches({x}, '^[0-9]') then try_cast(replace({x}, ',', '.') as double)
                    when {x} <> '' then (select r.total + r.hand from (select {spoken} r) z) end"""


def spoken_measures(src: str, ids: str, text: str) -> str:
    """D03 rows with number words; a range gives a row for its low and one for its high."""
    f = find_all(src, ids, text, ms.spoken_pattern(), tuple(range(1, 8)))
    idc = ", ".join(f"f.{c.strip()}" for c in ids.split(","))
    return f"""(
  select {idc}, x.vr value_range, x.v value, case when f.g7 = '' then t1.unit else t1.unit || '_per_' || t2.unit end unit,
         case when f.g7 = '' then i1.dim else i1.dim || '_per_' || i2.dim end dim,
         x.v * case when f.g7 = '' then i1.scale else i1.scale / i2.scale end base_value,
         f.start, cast(f.start + length(f.m) as integer) "end", substring(f._txt, f.start + 1, length(f.m)) lexical_variant
  from (select v.*, unnest(case when g1 = '' and low <= high then [{{'vr': '>=', 'v': low}}, {{'vr': '<=', 'v': high}}]
                                else [{{'vr': coalesce(r.vr, '='), 'v': high}}] end) x
        from (select *, {number('g5')} high, {number('concat(g2, g3, g4)')} low from {f} w where g5 <> '') v
        left join range_terms r on r.term = v.g1) f
  left join unit_terms t1 on t1.term = f.g6
  left join unit_terms t2 on t2.term = f.g7
  left join unit_info i1 on i1.unit = t1.unit
  left join unit_info i2 on i2.unit = t2.unit)"""


def valueless(src: str, ids: str, text: str) -> str:
    f = find_all(src, ids, text, ms.valueless_pattern(), (1,))
    idc = ", ".join(f"f.{c.strip()}" for c in ids.split(","))
    pos = q(ms.symbol_pattern(ms.POSITIVE_SYMBOLS))
    neg = q(ms.symbol_pattern(ms.NEGATIVE_SYMBOLS))
    return f"""(
  select {idc}, '=' value_range, b.v value, 'bool' unit, 'bool' dim, b.v base_value, f.start,
         cast(f.start + length(f.m) as integer) "end", substring(f._txt, f.start + 1, length(f.m)) lexical_variant
  from {f} f join bool_terms b on b.term = f.g1
  union all
  select {ids}, '=', v, 'bool', 'bool', v, 0, cast(length(_txt) as integer), _txt
  from (select {ids}, {text} _txt,
               case when regexp_matches({norm(text)}, {pos}) then 1.0
                    when regexp_matches({norm(text)}, {neg}) then 0.0 end v from {src}) s
  where v is not null)"""


def _unitless_unit(trig: str, v: str) -> str:
    parts = []
    for words, ranges in ms.UNITLESS_RULES:
        w = ", ".join(q(x) for x in words)
        for lo, hi, unit in ranges:
            cond = f"{trig} in ({w})"
            if lo is not None:
                cond += f" and {v} >= {lo}"
            if hi is not None:
                cond += f" and {v} < {hi}"
            parts.append(f"when {cond} then {q(unit)}")
    return "case " + " ".join(parts) + " end"


def unitless(src: str, ids: str, text: str, d03: str) -> str:
    """D05 rows; ``d03`` is the name of a relation holding the D03 rows of
    the same texts (numbers inside them are skipped)."""
    f = find_all(src, ids, text, ms.unitless_pattern(), (1, 2))
    idl = [c.strip() for c in ids.split(",")]
    idc = ", ".join(f"f.{c}" for c in idl)
    same = " and ".join(f"d.{c} = u.{c}" for c in idl)
    return f"""(
  select u.*, i.dim, u.value * i.scale base_value from (
    select {idc}, '=' value_range, cast(replace(f.g2, ',', '.') as double) value,
           {_unitless_unit('f.g1', "cast(replace(f.g2, ',', '.') as double)")} unit,
           cast(f.start + length(f.m) - length(f.g2) as integer) start,
           cast(f.start + length(f.m) as integer) "end", f.g2 lexical_variant
    from {f} f) u
  left join unit_info i on i.unit = u.unit
  where not exists (select 1 from {d03} d where {same} and d.start <= u.start and u.start < d."end"))"""


def format_measure(alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return f"concat_ws(' ', {a}value_range, {tx.number_text_sql(a + 'value')}, {a}unit)"
