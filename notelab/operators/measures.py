"""Measurement extraction (D03-D08, D21, D22) and measure values.

Our grammar (the reference only configures an external matcher):

* number ``[0-9]+([.,][0-9]+)?`` not glued to a letter or digit on its left;
* opt-in (``spoken``): French number words, and ranges ``low a high unit`` (also
  ``low-high unit`` with a low in digits, and ``entre low et high unit``), which
  give two measures, ``>=`` low and ``<=`` high, with the offsets of the whole;
* optional comparison word before it (``<``, ``>=``, ``inferieur a`` …);
* a unit from the registry right after it, optionally ``/`` or ``par`` and
  a second unit → ``a_per_b``.  Units are tried longest first; a unit ending
  in a letter must end on a word boundary.

Extraction works on text lower-cased and accent-folded with a one-to-one
character map, so offsets stay those of the original text.  All matching
is built-in regex functions over whole texts: ``regexp_extract_all`` gives
the matches and their groups, ``split`` on the same pattern gives the text
between them, and a fold over both gives each match's offset.  The
patterns avoid look-around so that Java and RE2 (the SQL oracle) agree.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelab.functions import text as tx
from notelab.functions import units as un
from notelab.functions import numbers as nb
from notelab.functions.numbers import apply_sql, literal_map
from notelab.functions.text import remove_variants

NUMBER = r"[0-9]+(?:[.,][0-9]+)?"
DATE = r"[0-3]?[0-9]/[01]?[0-9]/[0-9]{4}"

MEASURE_TYPE = ("struct<value_range:string,value:double,unit:string,dim:string,base_value:double,"
                "start:int,end:int,lexical_variant:string>")


_META = set(".^$*+?()[]{}|\\/")


def rx_escape(t: str) -> str:
    """Escape regex metacharacters only (same text for Java and RE2)."""
    return "".join("\\" + c if c in _META else c for c in t)


def begins_with(firsts: str) -> str:
    """A look-ahead at one of the characters: fails at once where a long pattern
    cannot begin.  For Java only (RE2 has no look-around)."""
    return "(?=[" + "".join(sorted(set(firsts))) + "])"


def _firsts(terms: Sequence[str]) -> str:
    return "".join(t[0] for t in terms)


def _alt(terms: Sequence[str]) -> str:
    out = []
    for t in sorted(set(terms), key=lambda x: (-len(x), x)):
        e = rx_escape(t)
        out.append(e + r"\b" if re.match(r"\w", t[-1], re.ASCII) else e)
    return "|".join(out)


def measure_pattern(units: Sequence[un.Unit] = (), table_mode: bool = False, java: bool = False) -> str:
    """Regex with groups 1 range word, 2 number, 3 unit, 4 divisor unit; all
    are empty for a date.  With ``java`` the same with look-aheads, which only
    make it fail earlier."""
    terms = un.term_table(tuple(units) or tuple(u for u in un.UNITS if u.dim != "time"))
    unit_alt = (begins_with(_firsts(list(terms))) if java else "") + (f"(?:{_alt(list(terms))})" if java else _alt(list(terms)))
    range_alt = _alt([t for t, _ in un.RANGE_TERMS])
    gap = r"[\s|]*" if table_mode else r"\s*"
    div = "|".join(rx_escape(d) + (r"\b" if d[-1].isalnum() else "") for d in un.UNIT_DIVISORS)
    # a date is matched first, as a whole and without groups, so that none of
    # its numbers is read as a value
    found = (rf"\b{DATE}\b|(?:({range_alt})\s*)?\b({NUMBER}){gap}({unit_alt})"
             rf"(?:\s*(?:{div})\s*({unit_alt}))?")
    return begins_with("0123456789" + _firsts([t for t, _ in un.RANGE_TERMS])) + f"(?:{found})" if java else found


def spoken_pattern(units: Sequence[un.Unit] = ()) -> str:
    """Regex with groups 1 comparison word, 2 to 4 low of a range (after ``entre``;
    before ``a``; before a hyphen), 5 number, 6 unit, 7 divisor unit; all are empty
    for a date."""
    unit_alt = _alt(list(un.term_table(tuple(units) or tuple(u for u in un.UNITS if u.dim != "time"))))
    range_alt = _alt([t for t, _ in un.RANGE_TERMS])
    div = "|".join(rx_escape(d) + (r"\b" if d[-1].isalnum() else "") for d in un.UNIT_DIVISORS)
    number = rf"(?:{NUMBER}|{nb.WORDS}\b)"
    low = rf"(?:entre\s+({number})\s+et\s+|({number})\s+a\s+|({NUMBER})\s*-\s*)?"
    return (rf"\b{DATE}\b|(?:({range_alt})\s*)?\b{low}({number})\s*({unit_alt})"
            rf"(?:\s*(?:{div})\s*({unit_alt}))?")


def normalize_for_matching(c: Column) -> Column:
    """Lower-case and fold accents/quotes one-to-one (offsets preserved)."""
    return tx.fold_ascii_length_preserving(F.lower(c))


# Private-use characters: MARK delimits matches and SEP their groups; any of
# them already in a text is first mapped to MARK_SUB (one-to-one, so offsets do
# not move).
MARK, MARK_SUB, SEP = "\ue000", "\ue001", "\ue002"


def prepared(text: Column) -> Column:
    """``normalize_for_matching`` without marks, for several ``find_all`` calls with
    ``marks=False``.  ASCII text has nothing to fold and no marks."""
    return _with(F.lower(text), lambda x: F.when(F.octet_length(x) == F.length(x), x).otherwise(folded_without_marks(x)))


def _with(c: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a column that is evaluated once however often ``fn`` reads it."""
    return F.transform(F.array(c), fn)[0]


def find_all(text: Column, pattern: str, groups: Sequence[int] = (), marks: bool = True) -> Column:
    """All matches of ``pattern`` in ``text`` as an array of
    ``struct(start, m, g1, g2, …)`` (0-based start, match text, groups).

    One regex pass: ``regexp_replace`` wraps every match, followed by its
    groups, in MARK; a single-character ``split`` (no regex) cuts the text into
    alternating gaps and matches, their lengths are summed to offsets, and
    another split of each match gives the groups.  The sums run over blocks of
    ``OFFSET_BLOCK`` parts and then over the blocks, since a fold copies the
    array it grows at each step: n parts cost n (b + n / b) copies with blocks of
    b, not n squared.  The lambdas only touch their own arguments, so nothing is
    re-evaluated per element.  Without ``marks`` the text went through
    ``without_marks`` before."""
    parts = F.split(_marked(text if not marks else without_marks(text), pattern, groups), MARK, -1)
    return apply_sql(parts, "p", matches_sql("p", groups))


#: Parts per block of the offset sums; even, so that a block begins with a gap.
OFFSET_BLOCK = 128


def without_marks(text: Column) -> Column:
    return F.translate(text, MARK + SEP, MARK_SUB * 2)


def folded_without_marks(text: Column) -> Column:
    """``without_marks`` of the folded text, in one pass."""
    return F.translate(text, tx.FOLD_FROM + MARK + SEP, tx.FOLD_TO + MARK_SUB * 2)


def _marked(text: Column, pattern: str, groups: Sequence[int]) -> Column:
    inner = "$0" + "".join(f"{SEP}${g}" for g in groups)
    return F.regexp_replace(text, pattern, MARK + inner + MARK)


def matches_sql(p: str, groups: Sequence[int]) -> str:
    """The matches among the parts ``p`` (a lambda variable) as SQL text."""
    if not groups:
        return _offsets_sql(p, False)
    named = ", ".join(f"'g{g}', x.p[{i + 1}]" for i, g in enumerate(groups))
    return f"transform({split_matches_sql(p)}, x -> named_struct('start', x.start, 'm', x.p[0], {named}))"


def split_matches_sql(p: str) -> str:
    """The matches among the parts ``p`` as SQL text: ``start``, and as array ``p`` the
    match and its groups."""
    return f"transform({_offsets_sql(p, True)}, x -> named_struct('start', x.start, 'p', split(x.m, '{SEP}', -1)))"


def _offsets_sql(p: str, groups: bool) -> str:
    """Start and text of the matches, the text with its groups."""
    def own(x: str) -> str:
        return f"substring_index({x}, '{SEP}', 1)" if groups else x

    found = f"""aggregate(
      transform(sequence(0, (size({p}) - 1) div {OFFSET_BLOCK}), b -> aggregate(
        slice({p}, cast(b * {OFFSET_BLOCK} + 1 as int), {OFFSET_BLOCK}),
        named_struct('i', 0, 'pos', 0, 'out', cast(array() as array<struct<start: int, m: string>>)),
        (acc, x) -> named_struct('i', acc.i + 1, 'pos', acc.pos + length({own('x')}),
          'out', if(acc.i % 2 = 1, concat(acc.out, array(named_struct('start', acc.pos, 'm', x))), acc.out)))),
      named_struct('pos', 0, 'out', cast(array() as array<array<struct<start: int, m: string>>>)),
      (acc, x) -> named_struct('pos', acc.pos + x.pos, 'out', concat(acc.out, array(
        transform(x.out, y -> named_struct('start', acc.pos + y.start, 'm', y.m))))),
      acc -> flatten(acc.out))"""
    first = f"named_struct('start', length({p}[0]), 'm', {p}[1])"
    second = f"named_struct('start', length({p}[0]) + length({own(p + '[1]')}) + length({p}[2]), 'm', {p}[3])"
    # most texts have no match, one or two: nothing to fold
    return f"""case when size({p}) = 1 then cast(array() as array<struct<start: int, m: string>>) when size({p}) = 3 then array({first})
      when size({p}) = 5 then array({first}, {second}) when {p} is not null then {found} end"""


def find_all_sql(text: str, pattern: str, groups: Sequence[int] = (), marks: bool = True) -> str:
    """``find_all`` as SQL text over the expression ``text``; without ``marks`` the
    text went through ``without_marks`` before."""
    plain = f"translate({text}, '{MARK}{SEP}', '{MARK_SUB * 2}')" if marks else text
    return f"transform(array({parts_sql(plain, pattern, groups)}), p -> {matches_sql('p', groups)})[0]"


def parts_sql(text: str, pattern: str, groups: Sequence[int] = ()) -> str:
    """The text, without marks, cut into gaps and matches with their groups."""
    inner = "$0" + "".join(f"{SEP}${g}" for g in groups)
    return f"split(regexp_replace({text}, r'{pattern}', '{MARK}{inner}{MARK}'), '{MARK}', -1)"


def _unit_of(term: Column, table: dict[str, str]) -> Column:
    return F.element_at(literal_map(table), term)


def extract_measures(text: Column, table_mode: bool = False, units: Sequence[un.Unit] = (), spoken: bool = False) -> Column:
    """Measures (``MEASURE_TYPE`` array) found in ``text``; with ``spoken`` also
    number words and ranges (of running text, so not in table mode).  A comparison
    word before a range, or a low above its high, leaves the high alone.  A null
    text has no result, an empty one no measures."""
    if spoken and table_mode:
        raise ValueError("number words and ranges are read in running text only")
    unit_set = tuple(units) or tuple(u for u in un.UNITS if u.dim != "time")
    if not spoken:
        return _with(F.struct(text.alias("text"), prepared(text).alias("norm")),
                     lambda x: written_measures(x["text"], x["norm"], unit_set, table_mode))
    terms = un.term_table(unit_set)
    ranges = dict(un.RANGE_TERMS)
    found = F.filter(find_all(normalize_for_matching(text), spoken_pattern(unit_set), range(1, 8)), lambda x: x["g5"] != "")

    # the unit is read in a step of its own: it is used many times
    u1, u2 = f"element_at({nb.map_sql(terms)}, x.g6)", f"element_at({nb.map_sql(terms)}, x.g7)"
    unit_sql = f"if(x.g7 = '', {u1}, concat({u1}, '_per_', {u2}))"

    def measure(x: Column, rng: Column, value: Column) -> Column:
        unit = x["unit"]
        return F.struct(rng.alias("value_range"), value.alias("value"), unit.alias("unit"),
                        un.unit_dim(unit).alias("dim"), (value * un.unit_scale(unit)).alias("base_value"),
                        x["start"].alias("start"), (x["start"] + F.length(x["m"])).cast("int").alias("end"),
                        F.call_function("substring", text, x["start"] + 1, F.length(x["m"])).alias(
                            "lexical_variant"))

    def comparison(x: Column) -> Column:
        return F.when(x["g1"] == "", F.lit("=")).otherwise(_unit_of(x["g1"], ranges))

    named = "x -> named_struct('start', x.start, 'm', x.m, 'g1', x.g1, 'unit', {}, 'high', {}, 'low', {})".format(
        unit_sql, nb.number_sql("x.g5"), nb.number_sql("concat(x.g2, x.g3, x.g4)"))
    valued = apply_sql(found, "f", f"transform(f, {named})")

    def one_or_two(x: Column) -> Column:
        pair = F.array(measure(x, F.lit(">="), x["low"]), measure(x, F.lit("<="), x["high"]))
        return F.when((x["g1"] == "") & (x["low"] <= x["high"]), pair).otherwise(F.array(measure(x, comparison(x), x["high"])))

    return F.flatten(F.transform(valued, one_or_two))


def written_measures(text: Column, norm: Column, units: tuple[un.Unit, ...], table_mode: bool = False) -> Column:
    """D03 in digits, over ``text`` and its ``prepared`` form.  A unit's name,
    dimension and scale come from one look-up."""
    found = apply_sql(measure_parts(norm, units, table_mode), "p", f"filter({split_matches_sql('p')}, x -> x.p[2] != '')")
    read = apply_sql(found, "f", f"transform(f, x -> {read_measure_sql('x', units)})")
    return F.transform(read, lambda x: F.struct(*measure_columns(x, F.call_function("substring", text, x["start"] + 1, x["length"]))))


def measure_parts(norm: Column, units: tuple[un.Unit, ...], table_mode: bool = False) -> Column:
    """The text cut at its measures and dates (the latter without groups)."""
    return F.split(_marked(norm, measure_pattern(units, table_mode, java=True), range(1, 5)), MARK, -1)


def read_measure_sql(x: str, units: tuple[un.Unit, ...]) -> str:
    """What a match ``x`` (start, and match and groups as ``p``) says, as SQL text."""
    info = un.info_sql(un.term_table(units))
    return f"""named_struct('start', {x}.start, 'length', length(get({x}.p, 0)), 'g1', get({x}.p, 1),
      'value', try_cast(replace(get({x}.p, 2), ',', '.') as double), 'u', element_at({info}, get({x}.p, 3)),
      'per', if(get({x}.p, 4) = '', null, element_at({info}, get({x}.p, 4))))"""


def measure_columns(x: Column, lexical_variant: Column) -> list[Column]:
    """The fields of ``MEASURE_TYPE`` of what was read of a match."""
    def of(name: str) -> Column:
        return F.when(x["per"].isNull(), x["u"][name]).otherwise(F.concat(x["u"][name], F.lit("_per_"), x["per"][name]))

    scale = F.when(x["per"].isNull(), x["u"]["scale"]).otherwise(x["u"]["scale"] / x["per"]["scale"])
    return [
        F.when(x["g1"] == "", F.lit("=")).otherwise(_unit_of(x["g1"], dict(un.RANGE_TERMS))).alias("value_range"),
        x["value"].alias("value"), of("name").alias("unit"), of("dim").alias("dim"), (x["value"] * scale).alias("base_value"),
        x["start"].alias("start"), (x["start"] + x["length"]).cast("int").alias("end"), lexical_variant.alias("lexical_variant")]


# --------------------------------------------------------------------------
# D04 valueless, D05 unitless
# --------------------------------------------------------------------------

# Words whose abbreviations (prefixes of two letters or more)
# mark a positive / negative / normal result, and symbol patterns.
POSITIVE_WORDS = ("positifs", "positives", "positivites")
NEGATIVE_WORDS = ("negatifs", "negatives", "negativites", "absences", "absents")
NORMAL_WORDS = ("normales", "normaux", "normalisations", "normalites")
POSITIVE_SYMBOLS = (r"\+", "p")
NEGATIVE_SYMBOLS = (r"\-", "n")


def abbreviations(words: Sequence[str]) -> list[str]:
    """Every prefix of length >= 2 of every word."""
    return sorted({w[:i] for w in words for i in range(2, len(w) + 1)})


def valueless_table() -> dict[str, float]:
    out: dict[str, float] = {}
    for words, v in ((POSITIVE_WORDS, 1.0), (NEGATIVE_WORDS, 0.0), (NORMAL_WORDS, 0.5)):
        for t in abbreviations(words):
            out.setdefault(t, v)
    return out


def valueless_pattern() -> str:
    return r"\b(" + "|".join(sorted(valueless_table(), key=lambda x: (-len(x), x))) + r")\b"


def symbol_pattern(symbols: Sequence[str]) -> str:
    return r"^[^a-zA-Z0-9]*(?:" + "|".join(symbols) + r")[^a-zA-Z0-9]*$"


def _bool_measure(v: Column, start: Column, end: Column, lex: Column) -> Column:
    return F.struct(F.lit("=").alias("value_range"), v.cast("double").alias("value"), F.lit("bool").alias("unit"),
                    F.lit("bool").alias("dim"), v.cast("double").alias("base_value"),
                    start.cast("int").alias("start"), end.cast("int").alias("end"), lex.alias("lexical_variant"))


def valueless_measures(text: Column) -> Column:
    """Boolean results from positive/negative/normal words (and their
    abbreviations) or from a text made only of a ``+``/``p`` or ``-``/``n``
    symbol.  value 1 / 0 / 0.5, unit ``bool``."""
    return _with(F.struct(text.alias("text"), prepared(text).alias("norm")), lambda x: _valueless(x["text"], x["norm"]))


def _valueless(text: Column, norm: Column) -> Column:
    table = valueless_table()
    items = []
    for k, v in table.items():
        items += [F.lit(k), F.lit(v)]
    lookup = F.create_map(*items)
    words = F.transform(find_all(norm, valueless_pattern(), [1], marks=False), lambda x: _bool_measure(
        F.element_at(lookup, x["g1"]), x["start"], x["start"] + F.length(x["m"]),
        F.call_function("substring", text, x["start"] + 1, F.length(x["m"]))))
    sym = (F.when(norm.rlike(symbol_pattern(POSITIVE_SYMBOLS)), F.lit(1.0))
            .when(norm.rlike(symbol_pattern(NEGATIVE_SYMBOLS)), F.lit(0.0)))
    sym_m = F.when(sym.isNotNull(), F.array(_bool_measure(sym, F.lit(0), F.length(text), text))).otherwise(
        F.array().cast(f"array<{MEASURE_TYPE}>"))
    return F.concat(words, sym_m)


# Trigger words of unit-less measures and the unit chosen by
# the value's interval [min, max).
UNITLESS_RULES = (
    (("poids", "poid", "pese", "pesant", "pesait", "pesent"), ((0, 200, "kg"), (200, None, "g"))),
    (("mesure", "taille", "mesurant", "mesurent", "mesurait", "mesuree", "hauteur", "largeur", "longueur"),
     ((0, 3, "m"), (3, None, "cm"))),
    (("imc", "bmi"), ((None, None, "kg_per_m2"),)),
)


def unitless_pattern() -> str:
    trig = sorted({t for ws, _ in UNITLESS_RULES for t in ws}, key=lambda x: (-len(x), x))
    return r"\b(" + "|".join(trig) + r")\b[^0-9a-z]{0,5}\b(" + NUMBER + r")"


def _unitless_unit(trigger: Column, value: Column) -> Column:
    expr = None
    for words, ranges in UNITLESS_RULES:
        for lo, hi, unit in ranges:
            cond = trigger.isin(*words)
            if lo is not None:
                cond = cond & (value >= lo)
            if hi is not None:
                cond = cond & (value < hi)
            expr = F.when(cond, F.lit(unit)) if expr is None else expr.when(cond, F.lit(unit))
    return expr


def unitless_candidates(text: Column) -> Column:
    """D05 candidates: trigger word then a bare number; the unit comes from
    the trigger's value ranges."""
    return _with(prepared(text), _unitless)


def _unitless(norm: Column) -> Column:
    found = find_all(norm, unitless_pattern(), [1, 2], marks=False)

    def to_measure(x: Column) -> Column:
        num_start = x["start"] + F.length(x["m"]) - F.length(x["g2"])
        value = F.regexp_replace(x["g2"], ",", ".").cast("double")
        unit = _unitless_unit(x["g1"], value)
        return F.struct(F.lit("=").alias("value_range"), value.alias("value"), unit.alias("unit"),
                        un.unit_dim(unit).alias("dim"), (value * un.unit_scale(unit)).alias("base_value"),
                        num_start.cast("int").alias("start"), (num_start + F.length(x["g2"])).cast("int").alias("end"),
                        x["g2"].alias("lexical_variant"))

    return F.transform(found, to_measure)


def _by_start(a: Column, b: Column) -> Column:
    return (F.when(a["start"] != b["start"], a["start"] - b["start"])
             .when(a["kind"] != b["kind"], a["kind"] - b["kind"])
             .otherwise(a["end"] - b["end"]))


def merge_unitless(with_unit: Column, unitless: Column, keep_with_unit: bool = True) -> Column:
    """Drop unit-less candidates whose number lies inside a measure with a
    unit.  Both lists are merged by offset and folded once, tracking the
    furthest end of the measures with a unit seen so far."""
    tag = lambda arr, k: F.transform(arr, lambda m: F.struct(F.lit(k).alias("kind"), m.alias("m"),
                                                             m["start"].alias("start"), m["end"].alias("end")))
    merged = F.array_sort(F.concat(tag(with_unit, 0), tag(unitless, 1)), _by_start)

    def step(acc: Column, x: Column) -> Column:
        drop = (x["kind"] == 1) & (x["start"] < acc["maxend"])
        keep = ~drop & ((x["kind"] == 1) | F.lit(keep_with_unit))
        out = F.when(keep, F.concat(acc["out"], F.array(x["m"]))).otherwise(acc["out"])
        maxend = F.when(x["kind"] == 0, F.greatest(acc["maxend"], x["end"])).otherwise(acc["maxend"])
        return F.struct(maxend.alias("maxend"), out.alias("out"))

    init = F.struct(F.lit(-1).alias("maxend"), F.array().cast(f"array<{MEASURE_TYPE}>").alias("out"))
    return F.aggregate(merged, init, step, lambda acc: acc["out"])


def unitless_measures(text: Column, with_unit: Column) -> Column:
    """Unit-less measures of ``text``; numbers already inside a measure
    of ``with_unit`` are skipped."""
    return merge_unitless(with_unit, unitless_candidates(text), keep_with_unit=False)


def measures_per_mention(rows: DataFrame, ids: Sequence[str], measure: str) -> DataFrame:
    """The measures of each mention, as texts in order of their offsets."""
    m = F.col(measure)
    item = F.struct(m["start"].alias("start"), m["end"].alias("end"), format_measure(m).alias("text"))
    return rows.groupBy(*ids).agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["text"]).alias("found"))


def all_measures(text: Column) -> Column:
    """D03 + D05 + D04, ordered by offset.  A text without a trigger or a result word is
    read for D03 only; its measures are in order as they are found."""
    units = tuple(u for u in un.UNITS if u.dim != "time")
    triggers = begins_with(_firsts([t for ws, _ in UNITLESS_RULES for t in ws])) + unitless_pattern()
    results = "|".join([begins_with(_firsts(list(valueless_table()))) + valueless_pattern(),
                        symbol_pattern(POSITIVE_SYMBOLS), symbol_pattern(NEGATIVE_SYMBOLS)])

    def parts(x: Column) -> Column:
        return F.struct(written_measures(x["text"], x["norm"], units).alias("found"),
                        F.when(x["norm"].rlike(triggers), _unitless(x["norm"])).alias("bare"),
                        F.when(x["norm"].rlike(results), _valueless(x["text"], x["norm"])).alias("results"))

    def by_offset(numeric: Column, results: Column) -> Column:
        return F.array_sort(F.concat(numeric, results), lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"])
                            .otherwise(a["end"] - b["end"]))

    def joined(x: Column) -> Column:
        numeric = F.when(x["bare"].isNull(), x["found"]).otherwise(merge_unitless(x["found"], x["bare"]))
        return F.when(x["results"].isNull(), numeric).otherwise(by_offset(numeric, x["results"]))

    return _with(_with(F.struct(text.alias("text"), prepared(text).alias("norm")), parts), joined)


# --------------------------------------------------------------------------
# X13, X18
# --------------------------------------------------------------------------

def format_measure(m: Column) -> Column:
    """``"<range> <value> <unit>"`` with Python float text."""
    return F.concat_ws(" ", m["value_range"], tx.number_text(m["value"]), m["unit"])


def parse_measure(s: Column) -> Column:
    """X13 inverse (of one measure); accepts ``"range value unit"`` and the older
    ``"value unit"`` form."""
    parts = F.split(F.trim(s), " +")
    three = F.size(parts) >= 3
    rng = F.when(three, parts[0]).otherwise(F.lit("="))
    val = F.when(three, parts[1]).otherwise(parts[0])
    unit = F.when(three, parts[2]).otherwise(parts[1])
    v = val.try_cast("double")
    return F.struct(rng.alias("value_range"), v.alias("value"), unit.alias("unit"),
                    un.unit_dim(unit).alias("dim"), (v * un.unit_scale(unit)).alias("base_value"))


def measures_equal(found: Column, gold: Column) -> Column:
    """Same number of measures and every found one equals some gold one
    (same dimension and base value); incompatible units are not equal."""
    def eq(a: Column, b: Column) -> Column:
        return (a["dim"] == b["dim"]) & (F.abs(a["base_value"] - b["base_value"]) <= 1e-9 * F.greatest(
            F.abs(a["base_value"]), F.abs(b["base_value"]), F.lit(1.0))) & (a["value_range"] == b["value_range"])

    # both lists are read in a step of their own: parsing them is most of the work
    return _with(F.struct(found.alias("found"), gold.alias("gold")), lambda x: (F.size(x["found"]) == F.size(x["gold"])) & F.forall(
        x["found"], lambda f: F.exists(x["gold"], lambda g: F.coalesce(eq(f, g), F.lit(False)))))


# --------------------------------------------------------------------------
# D22 table detection, D06 table measures, D07 override, D08 preparation
# --------------------------------------------------------------------------

LINE_TYPE = "struct<ln:int,start:int,line:string,cells:int,is_table:boolean>"


def note_lines(text: Column, delimiter: str = "|") -> Column:
    """Lines of a note with their offsets, delimiter count and whether they
    belong to a text table: at least two consecutive lines with the same
    number (>= 1) of delimiters (D22).  One fold over the lines; when a line
    repeats the previous line's count both are marked."""
    def step(acc: Column, x: Column) -> Column:
        c = F.length(x) - F.length(F.replace(x, F.lit(delimiter), F.lit("")))
        same = (c >= 1) & (acc["prevc"] == c)
        out, last = acc["out"], F.element_at(acc["out"], -1)
        marked = F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(
            last["ln"].alias("ln"), last["start"].alias("start"), last["line"].alias("line"),
            last["cells"].alias("cells"), F.lit(True).alias("is_table"))))
        out = F.when(same, marked).otherwise(out)
        item = F.struct(acc["ln"].alias("ln"), acc["pos"].alias("start"), x.alias("line"), c.cast("int").alias("cells"),
                        same.alias("is_table"))
        return F.struct((acc["pos"] + F.length(x) + 1).cast("int").alias("pos"), (acc["ln"] + 1).alias("ln"),
                        c.cast("int").alias("prevc"), F.concat(out, F.array(item)).alias("out"))

    init = F.struct(F.lit(0).alias("pos"), F.lit(0).alias("ln"), F.lit(-1).alias("prevc"),
                    F.array().cast(f"array<{LINE_TYPE}>").alias("out"))
    return F.aggregate(F.split(text, "\n", -1), init, step, lambda acc: acc["out"])


def detect_tables(notes: DataFrame, note: str = "source", text: str = "note_text") -> DataFrame:
    """Per note, the number of table lines and whether it has a table."""
    lines = note_lines(F.col(text))
    n_tab = F.size(F.filter(lines, lambda x: x["is_table"]))
    return notes.select(note, n_tab.alias("n_table_lines"), (n_tab > 0).alias("has_table"))


def extract_table_measures(notes: DataFrame, note: str = "source", text: str = "note_text") -> DataFrame:
    """Measures read inside text tables only (cells may separate the
    number and its unit), one row per measure with note offsets."""
    lines = notes.select(note, F.explode(F.filter(note_lines(F.col(text)), lambda x: x["is_table"])).alias("l"))
    ms = lines.select(note, F.col("l.start").alias("_ls"),
                      F.explode(extract_measures(F.col("l.line"), table_mode=True)).alias("m"))
    return ms.select(note, F.struct(
        *[F.col(f"m.{c}") for c in ("value_range", "value", "unit", "dim", "base_value")],
        (F.col("m.start") + F.col("_ls")).cast("int").alias("start"),
        (F.col("m.end") + F.col("_ls")).cast("int").alias("end"),
        F.col("m.lexical_variant")).alias("m")).select(note, "m", F.col("m.start").alias("s"),
                                                        F.col("m.end").alias("e"))


def override_with_table(found: Column, table_found: Column) -> Column:
    """Table measures, when there are any, replace in-text ones."""
    return F.when(F.coalesce(F.size(table_found), F.lit(0)) > 0, table_found).otherwise(found)


def prepare_for_normalization(linked: Column, term: Column, found: Column,
                              variants: Column) -> tuple[Column, Column]:
    """An empty linked-term list becomes the mention text minus the
    measures' lexical variants; measures become ``"range value unit"``."""
    filled = F.when(F.size(linked) == 0, F.array(remove_variants(term, variants))).otherwise(linked)
    return filled, F.transform(found, format_measure)


# --------------------------------------------------------------------------
# D21 dates, X14 abbreviations
# --------------------------------------------------------------------------

DATE_PATTERN = r"\b([0-3]?[0-9])/([01]?[0-9])/([0-9]{4})\b"


def detect_dates(df: DataFrame, ids: Sequence[str], text: Column) -> DataFrame:
    """``dd/mm/yyyy`` dates with offsets; invalid calendar dates are
    skipped.  The measure grammar steps over dates (``DATE``)."""
    found = find_all(text, DATE_PATTERN, [1, 2, 3])
    rows = df.select(*ids, F.explode(found).alias("x"))
    d, m, y = (F.col(f"x.g{i}").cast("int") for i in (1, 2, 3))
    valid = (m >= 1) & (m <= 12) & (d >= 1) & (d <= F.dayofmonth(F.last_day(
        F.make_date(y, F.when((m >= 1) & (m <= 12), m).otherwise(1), F.lit(1)))))
    return rows.where(valid).select(*ids, F.col("x.start").alias("start"),
                                    (F.col("x.start") + F.length("x.m")).cast("int").alias("end"),
                                    F.make_date(y, m, d).alias("date"))


def abbreviation_match(tokens: DataFrame, token: str) -> DataFrame:
    """Tokens that abbreviate (prefix of length >= 2) a result word,
    with the boolean value of that word.  The prefix table is a small fixed
    literal map, so the lookup stays inside the generated code."""
    table = valueless_table()
    items = []
    for k, v in table.items():
        items += [F.lit(k), F.lit(v)]
    value = F.element_at(F.create_map(*items), F.col(token))
    return tokens.withColumn("value", value).where(F.col("value").isNotNull())
