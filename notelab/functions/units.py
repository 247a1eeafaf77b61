"""Unit registry (M11) and unit arithmetic.

The registry is a small fixed table; it becomes literal maps inside
expressions (no join, stays in codegen).  Composite units ``a_per_b`` are
derived from two registry entries: dimension ``dimA_per_dimB`` and scale
``scaleA / scaleB`` relative to the base units of each dimension.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from notelab.functions.numbers import literal_map


@dataclass(frozen=True)
class Unit:
    name: str
    dim: str
    scale: float
    terms: tuple[str, ...] = field(default_factory=tuple)


# Pill-like dose units (surface forms), as used for doses.
PILL_TERMS = (
    "cpm", "comprimé", "comprimés", "cp", "cpr", "sachet", "sachets", "tube", "tubes",
    "dose", "doses", "unité", "unités", "ampoule", "ampoules", "injection", "injections",
    "mesure", "mesures", "gélule", "gélules", "bouffée", "bouffées", "prise", "prises",
)

# The unit registry of our measurement grammar (name, dimension,
# scale to the base unit of the dimension, surface terms after lower-casing
# and accent folding).
UNITS: tuple[Unit, ...] = (
    Unit("kg", "mass", 1000.0, ("kg", "kgs", "kilo", "kilos", "kilogramme", "kilogrammes")),
    Unit("g", "mass", 1.0, ("g", "gr", "gramme", "grammes")),
    Unit("mg", "mass", 1e-3, ("mg", "milligramme", "milligrammes")),
    Unit("ug", "mass", 1e-6, ("ug", "µg", "mcg", "microgramme", "microgrammes")),
    Unit("ng", "mass", 1e-9, ("ng", "nanogramme", "nanogrammes")),
    Unit("l", "volume", 1.0, ("l", "litre", "litres")),
    Unit("dl", "volume", 0.1, ("dl", "decilitre", "decilitres")),
    Unit("cl", "volume", 0.01, ("cl",)),
    Unit("ml", "volume", 1e-3, ("ml", "millilitre", "millilitres", "cc")),
    Unit("ul", "volume", 1e-6, ("ul", "µl")),
    Unit("m3", "volume", 1000.0, ("m3", "m³")),
    Unit("m", "length", 1.0, ("m", "metre", "metres")),
    Unit("cm", "length", 0.01, ("cm", "centimetre", "centimetres")),
    Unit("mm", "length", 1e-3, ("mm", "millimetre", "millimetres")),
    Unit("m2", "area", 1.0, ("m2", "m²")),
    Unit("mol", "amount", 1.0, ("mol", "mole", "moles")),
    Unit("mmol", "amount", 1e-3, ("mmol",)),
    Unit("umol", "amount", 1e-6, ("umol", "µmol")),
    Unit("ui", "ui", 1.0, ("ui", "u")),
    Unit("mui", "ui", 1e-3, ("mui",)),
    Unit("kui", "ui", 1e3, ("kui",)),
    Unit("percent", "percent", 1.0, ("%", "pourcent")),
    Unit("pill", "pill", 1.0, PILL_TERMS),
    Unit("s", "time", 1.0, ("s", "sec", "seconde", "secondes")),
    Unit("min", "time", 60.0, ("min", "minute", "minutes")),
    Unit("hour", "time", 3600.0, ("h", "heure", "heures")),
    Unit("day", "time", 86400.0, ("j", "jour", "jours")),
    Unit("week", "time", 604800.0, ("semaine", "semaines", "sem")),
    Unit("month", "time", 2628000.0, ("mois",)),
)

UNIT_BY_NAME = {u.name: u for u in UNITS}

# Comparison words → value_range.
RANGE_TERMS = (
    ("<=", "<="), (">=", ">="), ("<", "<"), (">", ">"), ("=", "="),
    ("inferieur a", "<"), ("inferieure a", "<"), ("superieur a", ">"), ("superieure a", ">"),
)

# Divisor words between two units ("g/l", "g par litre").
UNIT_DIVISORS = ("/", "par")


def _fold(term: str) -> str:
    from notelab.functions.text import FOLD_FROM, FOLD_TO
    return term.lower().translate(str.maketrans(FOLD_FROM, FOLD_TO))


def term_table(units: tuple[Unit, ...] = UNITS, with_x: bool = False) -> dict[str, str]:
    """Surface term (folded) → unit name.  ``with_x`` adds the ``term + "x"``
    plural variant for terms that are not already a term (dose rule)."""
    out: dict[str, str] = {}
    for u in units:
        for t in u.terms:
            out.setdefault(_fold(t), u.name)
    if with_x:
        for t, name in list(out.items()):
            out.setdefault(t + "x", name)
    return out


def info_sql(terms: dict[str, str]) -> str:
    """Surface term to ``struct(name, dim, scale)`` of its unit as a constant map in SQL
    text; a unit that the registry lacks has neither dimension nor scale."""
    def info(name: str) -> str:
        u = UNIT_BY_NAME.get(name)
        dim, scale = (f"'{u.dim}'", f"{float(u.scale)!r}D") if u else ("cast(null as string)", "cast(null as double)")
        return f"named_struct('name', '{name}', 'dim', {dim}, 'scale', {scale})"

    return "map(" + ", ".join(f"'{t}', {info(name)}" for t, name in terms.items()) + ")"


def unit_dim(unit: Column, units: tuple[Unit, ...] = UNITS) -> Column:
    """Dimension of a unit name, composite ``a_per_b`` included."""
    dims = literal_map({u.name: u.dim for u in units})
    parts = F.split(unit, "_per_")
    simple = F.element_at(dims, unit)
    comp = F.concat(F.element_at(dims, parts[0]), F.lit("_per_"), F.element_at(dims, parts[1]))
    return (F.when(unit == "bool", F.lit("bool")).when(~unit.contains("_per_"), simple)
             .when(F.size(parts) == 2, comp).otherwise(simple))


def unit_scale(unit: Column, units: tuple[Unit, ...] = UNITS) -> Column:
    scales = literal_map({u.name: float(u.scale) for u in units})
    parts = F.split(unit, "_per_")
    comp = F.element_at(scales, parts[0]) / F.element_at(scales, parts[1])
    simple = F.element_at(scales, unit)
    return (F.when(unit == "bool", F.lit(1.0)).when(~unit.contains("_per_"), simple)
             .when(F.size(parts) == 2, comp).otherwise(simple))


def convert_unit(value: Column, from_unit: Column, to_unit: Column) -> Column:
    """Value in ``from_unit`` expressed in ``to_unit``; null when the
    dimensions differ."""
    same = unit_dim(from_unit) == unit_dim(to_unit)
    return F.when(same, value * unit_scale(from_unit) / unit_scale(to_unit))
