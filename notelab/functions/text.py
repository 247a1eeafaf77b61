"""Scalar text functions (X01-X12, X16) as Spark Column expressions.

All but ``fold_ascii_all`` compile to built-in expressions (whole-stage codegen).  Where an oracle needs the same fixed table (the ASCII folding
map), the table is built once here and exported.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# --------------------------------------------------------------------------
# X02 ASCII folding
# --------------------------------------------------------------------------

# Letters that transliterate to more than one ASCII letter or
# do not decompose under NFKD, and the text they fold to.
MULTI_CHAR_FOLDS = [
    ("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"),
    ("þ", "th"), ("Þ", "Th"), ("ŋ", "ng"), ("Ŋ", "NG"), ("ĳ", "ij"), ("Ĳ", "IJ"),
]
SINGLE_CHAR_EXTRA = [
    ("ø", "o"), ("Ø", "O"), ("đ", "d"), ("Đ", "D"), ("ð", "d"), ("Ð", "D"),
    ("ł", "l"), ("Ł", "L"), ("ı", "i"), ("ħ", "h"), ("Ħ", "H"), ("ŀ", "l"), ("Ŀ", "L"),
    ("ſ", "s"), ("ĸ", "q"),
    (" ", " "), ("«", '"'), ("»", '"'), ("’", "'"), ("‘", "'"),
    ("“", '"'), ("”", '"'), ("–", "-"), ("—", "-"),
]


def _fold_table() -> tuple[str, str]:
    """Single-character fold map by rule: every letter of U+00C0..U+024F whose
    NFKD form is one ASCII letter plus combining marks maps to that letter."""
    src, dst = [], []
    for cp in range(0x00C0, 0x0250):
        ch = chr(cp)
        dec = unicodedata.normalize("NFKD", ch)
        if len(dec) > 1 and dec[0].isascii() and dec[0].isalpha() and all(
                unicodedata.combining(c) for c in dec[1:]):
            src.append(ch)
            dst.append(dec[0])
    for a, b in SINGLE_CHAR_EXTRA:
        if a not in src:
            src.append(a)
            dst.append(b)
    return "".join(src), "".join(dst)


FOLD_FROM, FOLD_TO = _fold_table()


def fold_ascii(c: Column) -> Column:
    """Transliterate Latin letters to ASCII (``é→e``, ``ß→ss``, ``œ→oe``)."""
    for a, b in MULTI_CHAR_FOLDS:
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.translate(c, FOLD_FROM, FOLD_TO)


def _latin_bases(x: pa.Array) -> pa.Array:
    """NFKD, the marks on Latin letters taken off, all else composed again."""
    bare = pc.replace_substring_regex(pc.utf8_normalize(x, "NFKD"), r"(\p{Latin})\p{Mn}+", r"\1")
    if pc.all(pc.string_is_ascii(bare), min_count=0).as_py():
        return bare
    return pa.array([s if s is None else unicodedata.normalize("NFC", s) for s in bare.to_pylist()], pa.string())


def fold_ascii_all(c: Column) -> Column:
    """X02 for every code point that has an ASCII form by Unicode's own tables, not only
    the letters of the fold table: ``ệ→e``, ``ﬁ→fi``, ``Ａ→A``, ``①→1``.  Opt-in, since
    the decomposition runs as an Arrow function, by kernels on whole batches; a batch
    that is not ASCII after it is composed again value by value.  Letters of other
    scripts keep their marks; null stays null."""
    return fold_ascii(F.arrow_udf(_latin_bases, "string")(c))


def fold_ascii_length_preserving(c: Column) -> Column:
    """Fold only the one-to-one part so character offsets stay valid."""
    return F.translate(c, FOLD_FROM, FOLD_TO)


def fold_ascii_sql(x: str) -> str:
    """The same folding as SQL text (for oracles)."""
    for a, b in MULTI_CHAR_FOLDS:
        x = f"replace({x}, '{a}', '{b}')"
    f = FOLD_FROM.replace("'", "''")
    t = FOLD_TO.replace("'", "''")
    return f"translate({x}, '{f}', '{t}')"


# --------------------------------------------------------------------------
# X01, X03, X04
# --------------------------------------------------------------------------

# Stop-words removed from dictionary strings before encoding.
DEFAULT_STOPWORDS = [
    "for", "assay", "by", "tests", "minute", "exam", "with", "human", "moyenne", "in",
    "to", "from", "analyse", "test", "level", "fluid", "laboratory", "determination",
    "examination", "releasing", "quantitative", "screening", "and", "exploration",
    "factor", "method", "analysis", "laboratoire", "specimen", "or", "typing", "of",
    "concentration", "measurement", "detection", "procedure", "identification",
    "numeration", "hour", "retired", "technique", "count",
]

# Abbreviation expansions, applied as plain substring
# replacements in this order (lower-case, then capitalised when cased).
ABBREVIATIONS = [("ag ", "antigene "), ("ac ", "anticorps "), ("antigenes ", "antigene ")]
ABBREVIATIONS_CASED = [("Ag ", "Antigene "), ("Ac ", "Anticorps "), ("Antigenes ", "Antigene ")]


def stopword_pattern(words: Sequence[str]) -> str:
    return r"(?i)\b(?:" + "|".join(words) + r")\b"


def remove_stopwords(c: Column, words: Sequence[str] = DEFAULT_STOPWORDS) -> Column:
    """Delete whole-word stop-words, ignoring case."""
    return F.regexp_replace(c, stopword_pattern(words), "")


def remove_special(c: Column) -> Column:
    """Every character other than ASCII letters, digits and white
    space becomes a space."""
    return F.regexp_replace(c, r"[^a-zA-Z0-9\s]", " ")


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()``: trim all leading/trailing white space."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def normalize_term(c: Column, cased: bool = True, rm_stopwords: bool = False,
                   rm_special: bool = False, stopwords: Sequence[str] = DEFAULT_STOPWORDS) -> Column:
    """Term normalisation before dictionary matching.

    Order: (lower when uncased) → ``-`` to space → abbreviation expansions
    (plain substrings) → ASCII folding → stop-words → specials → collapse
    runs of spaces → strip."""
    if not cased:
        c = F.lower(c)
    c = F.replace(c, F.lit("-"), F.lit(" "))
    for a, b in ABBREVIATIONS + (ABBREVIATIONS_CASED if cased else []):
        c = F.replace(c, F.lit(a), F.lit(b))
    c = fold_ascii(c)
    if rm_stopwords:
        c = remove_stopwords(c, stopwords)
    if rm_special:
        c = remove_special(c)
    return strip_ws(F.regexp_replace(c, " +", " "))


def normalize_term_sql(x: str, cased: bool = True, rm_stopwords: bool = False,
                       rm_special: bool = False, stopwords: Sequence[str] = DEFAULT_STOPWORDS) -> str:
    """DuckDB text of :func:`normalize_term` (oracle side)."""
    if not cased:
        x = f"lower({x})"
    x = f"replace({x}, '-', ' ')"
    for a, b in ABBREVIATIONS + (ABBREVIATIONS_CASED if cased else []):
        x = f"replace({x}, '{a}', '{b}')"
    x = fold_ascii_sql(x)
    if rm_stopwords:
        x = f"regexp_replace({x}, '{stopword_pattern(stopwords)}', '', 'g')"
    if rm_special:
        x = f"regexp_replace({x}, '[^a-zA-Z0-9\\s]', ' ', 'g')"
    x = f"regexp_replace({x}, ' +', ' ', 'g')"
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


# --------------------------------------------------------------------------
# X06 .. X10, X16
# --------------------------------------------------------------------------

def variants_pattern(variants: Column) -> Column:
    """``\\b(?:v1|v2|…)\\b`` ignoring case, each variant quoted literally,
    longest first (so a variant is never cut by a shorter prefix)."""
    def longest_first(a: Column, b: Column) -> Column:
        return (F.when(F.length(a) != F.length(b), F.length(b) - F.length(a))
                 .when(a < b, -1).when(a > b, 1).otherwise(0))

    by_len = F.array_sort(F.array_distinct(variants), longest_first)
    quoted = F.transform(by_len, lambda v: F.concat(F.lit("\\Q"), v, F.lit("\\E")))
    return F.concat(F.lit("(?i)\\b(?:"), F.array_join(quoted, "|"), F.lit(")\\b"))


def remove_variants(term: Column, variants: Column) -> Column:
    """Delete the matched lexical variants (whole words) from the term;
    term unchanged when there is no variant."""
    return F.when(F.size(variants) > 0,
                  F.regexp_replace(term, variants_pattern(variants), F.lit(""))).otherwise(term)


def find_subspan(base: Column, term: Column, sub: Column) -> tuple[Column, Column]:
    """(start, end) of ``sub`` inside ``term`` whose start is ``base``.
    Absent → start = base - 1 (Python ``find`` gives -1)."""
    start = base + F.instr(term, sub) - 1
    return start, start + F.length(sub)


def term_from_path(c: Column) -> Column:
    """Text after the first ``:`` up to the first ``_``, stripped.
    Null when there is no ``:``."""
    after = F.when(F.instr(c, ":") > 0, F.call_function("substr", c, F.instr(c, ":") + 1))
    return strip_ws(F.substring_index(after, "_", 1))


def split_annotation(c: Column) -> tuple[Column, Column]:
    """``CODE_measure`` → ([CODE], [measure]), cut at the first underscore;
    null → ([], [])."""
    parts = F.split(c, "_", 2)
    code = F.when(c.isNull(), F.array().cast("array<string>")).otherwise(F.array(parts[0]))
    meas = F.when(c.isNull() | (F.size(parts) < 2), F.array().cast("array<string>")).otherwise(
        F.array(parts[1]))
    return code, meas


def build_annotation(labels: Column, found: Column) -> Column:
    """``"/".join(labels) + "_" + "/".join(found)`` without spaces in
    the measure part."""
    return F.concat(F.array_join(labels, "/"), F.lit("_"),
                    F.replace(F.array_join(found, "/"), F.lit(" "), F.lit("")))


def conditional_code(annotation: Column) -> Column:
    """Gold code from an annotation: a ``_`` takes precedence (part
    before the first ``_`` of the original), else a ``:`` (part after it)."""
    return (F.when(F.instr(annotation, "_") > 0, F.split(annotation, "_")[0])
             .when(F.instr(annotation, ":") > 0, F.split(annotation, ":")[1])
             .otherwise(annotation))


def number_text(v: Column) -> Column:
    """Number as text the way Python prints a float: ``13.7``, ``5.0``,
    ``12345678.5``, and with an exponent from 1e16 on or below 1e-4
    (``1e+16``, ``4e-07``).  All digits are kept and no value aborts."""
    d = v.cast("double")
    t, size = d.cast("string"), F.abs(d)
    mantissa = F.regexp_replace(F.substring_index(t, "E", 1), "[.]0$", "")
    power = F.substring_index(t, "E", -1).try_cast("int")
    exponent = F.concat(mantissa, F.lit("e"), F.when(power < 0, "-").otherwise("+"),
                        F.when(F.abs(power) < 10, "0").otherwise(""), F.abs(power).cast("string"))
    plain = F.regexp_replace(F.regexp_replace(t.try_cast("decimal(38,20)").cast("string"), "0+$", ""), "[.]$", ".0")
    return F.when(~t.contains("E"), t).when((size >= 1e16) | (size < 1e-4), exponent).otherwise(plain)


def number_text_sql(x: str) -> str:
    return f"cast(cast({x} as double) as varchar)"


def value_unit_text(value: Column, unit: Column) -> Column:
    """``str(value) + " " + unit``."""
    return F.concat_ws(" ", number_text(value), unit)


# --------------------------------------------------------------------------
# X11, X12
# --------------------------------------------------------------------------

def ngram_set(c: Column, n: int) -> Column:
    """X11: set of character n-grams of ``c`` padded with ``#`` × (n-1)."""
    pad = "#" * (n - 1)
    p = F.concat(F.lit(pad), c, F.lit(pad))
    idx = F.sequence(F.lit(1), F.greatest(F.length(p) - n + 1, F.lit(1)))
    return F.array_distinct(F.transform(idx, lambda i: F.call_function("substring", p, i, F.lit(n))))


def dice(a: Column, b: Column) -> Column:
    """Sørensen–Dice coefficient of two sets."""
    inter = F.size(F.array_intersect(a, b))
    return F.try_divide(2 * inter, F.size(a) + F.size(b))
