"""Row filters and projections (P01-P14) and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# First and last number of a standoff span "10 15;16 20" (fragments
# collapse to their hull).
SPAN_PATTERN = r"^(\d+).*\s(\d+)$"


def parse_span(span: Column) -> tuple[Column, Column]:
    """(start, end) as integers from a standoff span string."""
    return (F.regexp_extract(span, SPAN_PATTERN, 1).cast("int"),
            F.regexp_extract(span, SPAN_PATTERN, 2).cast("int"))


def keep_labels(df: DataFrame, labels: Sequence[str], col: str = "label") -> DataFrame:
    """Label in the given set (pushed down to the scan when possible)."""
    return df.where(F.col(col).isin(list(labels)))


def rename(df: DataFrame, mapping: dict[str, str], drop: Sequence[str] = ()) -> DataFrame:
    """Column pruning and renaming between stages."""
    out = df.drop(*drop)
    for a, b in mapping.items():
        out = out.withColumnRenamed(a, b)
    return out


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    """P04."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def fill_default(c: Column, default) -> Column:
    """Null → default (``nounit``, ``[]``)."""
    return F.coalesce(c, F.lit(default) if not isinstance(default, Column) else default)


def any_code_of_interest(codes: Column, wanted: Sequence[str]) -> Column:
    """The code list meets the code set."""
    return F.arrays_overlap(codes, F.array(*[F.lit(x) for x in wanted]))


def not_only_boolean(found: Column) -> Column:
    """Some measurement string is not a boolean one (empty → False)."""
    return F.coalesce(F.exists(found, lambda x: ~x.contains("bool")), F.lit(False))


def numeric_or_empty(c: Column) -> Column:
    """P09 predicate: empty or only ASCII digits (dictionary strings dropped)."""
    return (c == "") | c.rlike("^[0-9]+$")


def non_empty(c: Column) -> Column:
    """P10."""
    return F.coalesce(F.size(c) > 0, F.lit(False))


def label_combo(labels: Column, must: Sequence[str], must_not: Sequence[str]) -> Column:
    """The label set holds all of ``must`` and none of ``must_not``."""
    cond = F.lit(True)
    for m in must:
        cond = cond & F.array_contains(labels, m)
    for m in must_not:
        cond = cond & ~F.array_contains(labels, m)
    return cond


def groups_with_labels(df: DataFrame, group: Sequence[str], label: str, must: Sequence[str],
                       must_not: Sequence[str]) -> DataFrame:
    """P11 over rows: the groups whose labels hold all of ``must`` and none of
    ``must_not``, by booleans that are aggregated before the shuffle."""
    has = {x: F.bool_or(F.col(label) == x) for x in [*must, *must_not]}
    flags = df.groupBy(*group).agg(*[v.alias(f"_{i}") for i, v in enumerate(has.values())])
    cond = F.lit(True)
    for i in range(len(has)):
        cond = cond & (F.col(f"_{i}") if i < len(must) else ~F.col(f"_{i}"))
    return flags.where(cond).select(*group)


def any_substring(values: Column, needle: str) -> Column:
    """Some element contains ``needle``."""
    return F.exists(values, lambda x: x.contains(needle))


def any_row_contains(value: Column, needle: str) -> Column:
    """P12 as an aggregate over the rows of a group."""
    return F.bool_or(value.contains(needle))


def filter_expr(df: DataFrame, expr: str | None, text_col: str = "note_text",
                entities_col: str | None = None) -> DataFrame:
    """Caller-supplied predicate; empty notes (and optionally notes
    without entities) are dropped."""
    out = df.where(F.length(F.col(text_col)) > 0)
    if entities_col:
        out = out.where(F.size(F.col(entities_col)) > 0)
    return out.where(F.expr(expr)) if expr else out


def drug_mentions(mentions: DataFrame, note: str = "source", order: str = "k",
                  label: str = "Chemical_and_drugs") -> DataFrame:
    """Per note, number of drug mentions and their texts in order."""
    d = mentions.where(F.col("label") == label)
    return d.groupBy(note).agg(
        F.count(F.lit(1)).alias("n_drugs"),
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(order), F.col("term")))),
                    lambda x: x["term"]).alias("drugs"))


# --------------------------------------------------------------------------
# U01-U04
# --------------------------------------------------------------------------

def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack per-part results (by column name)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def union_sets(df: DataFrame, group: Sequence[str], col: str, out: str) -> DataFrame:
    """Per group, the sorted union of the set column; repeats go before
    the shuffle."""
    code = df.select(*group, F.explode_outer(col).alias("_x"))
    return code.groupBy(*group).agg(F.array_sort(F.collect_set("_x")).alias(out))


def sets_meet(a: Column, b: Column) -> Column:
    """Two sets intersect."""
    return F.arrays_overlap(a, b)


def set_difference(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other``."""
    return df.join(other.select(*on), list(on), "left_anti")
