"""Numbers in text: digits and French number words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Number words (folded).
NUMBER_WORDS = {
    "zero": 0.0, "demi": 0.5, "un": 1.0, "une": 1.0, "deux": 2.0, "trois": 3.0, "quatre": 4.0, "cinq": 5.0, "six": 6.0, "sept": 7.0,
    "huit": 8.0, "neuf": 9.0, "dix": 10.0, "onze": 11.0, "douze": 12.0, "treize": 13.0, "quatorze": 14.0, "quinze": 15.0,
    "seize": 16.0, "vingt": 20.0, "vingts": 20.0, "trente": 30.0, "quarante": 40.0, "cinquante": 50.0, "soixante": 60.0,
    "cent": 100.0, "cents": 100.0, "mille": 1000.0,
}

DIGITS = r"[0-9]+(?:[.,][0-9]+)?"
_WORD = "(?:" + "|".join(sorted(NUMBER_WORDS, key=lambda x: (-len(x), x))) + ")"
#: One word or more, joined by white space, a hyphen or ``et``.
WORDS = rf"{_WORD}(?:(?:-|\s)(?:et(?:-|\s))?{_WORD}\b)*"


def map_sql(d: dict) -> str:
    """A constant map as SQL text."""
    if any("'" in x or "\\" in x for kv in d.items() for x in kv if isinstance(x, str)):
        raise ValueError("quotes or backslashes in a constant map")
    return "map(" + ", ".join(f"'{x}'" if isinstance(x, str) else f"{x!r}D" for kv in d.items() for x in kv) + ")"


def literal_map(d: dict) -> Column:
    """A constant map, parsed once (an entry each as a column of its own makes
    plans slow to build)."""
    return F.expr(map_sql(d))


def apply_sql(c: Column, name: str, body: str) -> Column:
    """The SQL expression ``body`` over ``name``, which stands for the column's
    value; the column is evaluated once."""
    return F.call_function("transform", F.array(c), F.expr(f"{name} -> {body}"))[0]


def number_sql(c: str) -> str:
    """``number_value`` as SQL text over the expression ``c``."""
    return f"""case when {c} rlike r'^\\s*[0-9]' then try_cast(replace({c}, ',', '.') as double)
      when trim({c}) != '' then {_spoken_sql(c)} end"""


def matched_number_sql(c: str) -> str:
    """``number_sql`` of a match of ``DIGITS`` or ``WORDS``, or of an empty group: its first
    character tells which."""
    return f"case when {c} = '' then null when {c} < ':' then try_cast(replace({c}, ',', '.') as double) else {_spoken_sql(c)} end"


def _spoken_sql(c: str) -> str:
    words = f"filter(split(trim({c}), r'[\\s-]+'), w -> w != 'et' and w != '')"
    value = f"element_at({map_sql(NUMBER_WORDS)}, w)"
    return f"""aggregate(transform({words}, w -> {value}), named_struct('total', 0D, 'hand', 0D, 'known', true),
      (acc, v) -> named_struct(
        'total', acc.total + if(v = 1000, greatest(acc.hand, 1D) * 1000, 0D),
        'hand', case when v = 100 then greatest(acc.hand, 1D) * 100 when v = 20 and acc.hand % 10 = 4 then acc.hand - 4 + 80
                     when v = 1000 then 0D else acc.hand + coalesce(v, 0D) end,
        'known', acc.known and v is not null),
      acc -> if(acc.known, acc.total + acc.hand, null))"""


def number_value(c: Column) -> Column:
    """Digits (comma or point) as a double, else the value of the number words:
    a word adds to what stands before it (``soixante et onze``), ``cent`` and a
    ``vingt`` after ``quatre`` multiply the hundred in hand, ``mille`` closes the
    thousands.  Null if it is neither."""
    return apply_sql(c, "c", number_sql("c"))
