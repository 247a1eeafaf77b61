"""Span operators: overlap joins, interval merge, crop and link.

Two overlap semantics exist and are never mixed:

* ``closed``  (J01): spans ``[s, e]`` overlap when ``least(e) >= greatest(s)``;
  touching spans count.  Used by the lab-result pipeline.
* ``halfopen`` (J02): ``least(e) > greatest(s)``; touching does not count.
  Used by evaluation and section jobs.

Spark has no interval join.  Equi-joining on the note alone turns every
note into a nested loop and puts a hot note (one note may hold a third of
all mentions) in a single task, so both sides are exploded into fixed-width
position bins and joined on ``(note, bin)``.  A pair is emitted only in the
bin of ``greatest(s)``, which both spans contain, so each pair appears once
and no de-duplication shuffle is needed.  A hot note is split over as many
join keys as it has bins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BIN = 256


def overlap_condition(ls: Column, le: Column, rs: Column, re_: Column, closed: bool) -> Column:
    lo, hi = F.greatest(ls, rs), F.least(le, re_)
    return hi >= lo if closed else hi > lo


def _binned(df: DataFrame, s: str, e: str, bin_size: int, name: str) -> DataFrame:
    first = F.floor(F.col(s) / bin_size).cast("bigint")
    last = F.floor(F.greatest(F.col(e), F.col(s)) / bin_size).cast("bigint")
    return df.withColumn(name, F.explode(F.sequence(first, last)))


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                 left_span: tuple[str, str], right_span: tuple[str, str],
                 closed: bool = True, bin_size: int = DEFAULT_BIN) -> DataFrame:
    """Inner overlap join.  Column names of the two sides must be disjoint
    except for ``keys``; spans are given by column names on each side."""
    ls, le = left_span
    rs, re_ = right_span
    lb = _binned(left, ls, le, bin_size, "_ov_bin")
    rb = _binned(right, rs, re_, bin_size, "_ov_bin")
    cond = overlap_condition(F.col(ls), F.col(le), F.col(rs), F.col(re_), closed)
    first_common = F.col("_ov_bin") == F.floor(F.greatest(F.col(ls), F.col(rs)) / bin_size).cast("bigint")
    return lb.join(rb, list(keys) + ["_ov_bin"]).where(cond & first_common).drop("_ov_bin")


def overlap_in_note(ls: Column, le: Column, rs: Column, re_: Column, bin_size: int = DEFAULT_BIN) -> Column:
    """Whether two spans of a note are a pair of the closed ``overlap_join`` (a span without
    an end stands in the bin of its start only) and not cropped to ``(0, 0)``."""
    lo, hi = F.greatest(ls, rs), F.least(le, re_)
    bins = lambda s, e: e.isNotNull() | (F.floor(lo / bin_size) == F.floor(s / bin_size))
    return F.coalesce(ls.isNotNull() & rs.isNotNull() & (hi >= lo) & bins(ls, le) & bins(rs, re_) & ~((lo == 0) & (hi == 0)), F.lit(False))


def overlap_semi(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: Sequence[str],
                 left_span: tuple[str, str], right_span: tuple[str, str],
                 closed: bool = True, anti: bool = False, bin_size: int = DEFAULT_BIN) -> DataFrame:
    """Left rows that overlap (``anti=False``) / overlap nothing (``anti=True``)
    on the right.  ``left_id`` must identify a left row."""
    ids = list(dict.fromkeys(list(keys) + list(left_id)))
    rcols = list(keys) + [F.col(c).alias(f"_r_{c}") for c in right_span]
    r = right.select(*rcols)
    hits = overlap_join(left.select(*ids, *left_span), r, keys, left_span,
                        tuple(f"_r_{c}" for c in right_span), closed, bin_size)
    hits = hits.select(*ids).distinct()
    return left.join(hits, ids, "left_anti" if anti else "left_semi")


# --------------------------------------------------------------------------
# Array folds used by D02 (A11 merge, X05 crop)
# --------------------------------------------------------------------------

_SEG = "struct<cs:bigint,ce:bigint>"


def merge_segments(segments: Column) -> Column:
    """Union of segments ``struct(cs, ce)``; segments that overlap or
    touch (closed) are merged.  Input order does not matter (sorted first)."""
    def step(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        merged = F.concat(
            F.slice(acc, 1, F.size(acc) - 1),
            F.array(F.struct(last["cs"].alias("cs"), F.greatest(last["ce"], x["ce"]).alias("ce"))))
        return F.when((F.size(acc) > 0) & (x["cs"] <= last["ce"]), merged).otherwise(
            F.concat(acc, F.array(F.struct(x["cs"].alias("cs"), x["ce"].alias("ce")))))

    empty = F.array().cast(f"array<{_SEG}>")
    return F.aggregate(F.array_sort(segments), empty, step)


def slice_text(text: Column, pos: Column, length: Column) -> Column:
    """``text[pos-1 : pos-1+length]`` with Python slice semantics (empty when
    ``length <= 0``); ``pos`` is 1-based."""
    return F.when(length > 0, F.call_function("substring", text, pos.cast("int"), length.cast("int"))
                  ).otherwise(F.lit(""))


def crop_text(text: Column, base: Column, end: Column, merged: Column) -> Column:
    """``text`` (covering ``[base, end)``) minus the sorted, disjoint
    segments ``merged`` (absolute offsets)."""
    init = F.struct(base.cast("bigint").alias("pos"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        piece = slice_text(text, acc["pos"] - base + 1, x["cs"] - acc["pos"])
        return F.struct(x["ce"].alias("pos"), F.concat(acc["out"], piece).alias("out"))

    def finish(acc: Column) -> Column:
        return F.concat(acc["out"], slice_text(text, acc["pos"] - base + 1, end - acc["pos"]))

    return F.aggregate(merged, init, step, finish)


# --------------------------------------------------------------------------
# D02
# --------------------------------------------------------------------------

def remove_inner_labels(mentions: DataFrame, key_label: str = "BIO_comp",
                        labels_to_remove: Sequence[str] = ("BIO",),
                        labels_linkable: Sequence[str] = ("BIO",),
                        note: str = "source", mention_id: str = "k",
                        bin_size: int = DEFAULT_BIN) -> DataFrame:
    """For every key mention, (a) its text with the overlapping
    (closed) to-remove mentions cropped out and (b) the list of overlapping
    linkable mention texts, in mention-id order.

    Mentions need ``note, mention_id, s, e, label, term``.  Output: the key
    rows with ``term_labels_removed`` and ``terms_linked_to_measurement``.
    A crop equal to ``(0, 0)`` counts as no overlap, as in the reference.
    """
    remove, link = list(labels_to_remove), list(labels_linkable)
    keys = mentions.where(F.col("label") == key_label).select(note, mention_id, "s", "e", "term")
    inner = mentions.where(F.col("label").isin(remove + link)).select(
        note, F.col(mention_id).alias("_iid"), F.col("s").alias("_is"), F.col("e").alias("_ie"),
        F.col("label").alias("_ilabel"), F.col("term").alias("_iterm"))
    pairs = overlap_join(keys.select(note, mention_id, "s", "e"), inner, [note], ("s", "e"),
                         ("_is", "_ie"), closed=True, bin_size=bin_size)
    cs, ce = F.greatest("s", "_is"), F.least("e", "_ie")
    pairs = pairs.where(~((cs == 0) & (ce == 0))).select(
        note, mention_id,
        F.lit(None).cast("bigint").alias("s"), F.lit(None).cast("bigint").alias("e"),
        F.lit(None).cast("string").alias("term"),
        F.when(F.col("_ilabel").isin(remove), F.struct(cs.cast("bigint").alias("cs"),
                                                       ce.cast("bigint").alias("ce"))).alias("_crop"),
        F.when(F.col("_ilabel").isin(link), F.struct(F.col("_iid").cast("bigint").alias("_iid"),
                                                     F.col("_iterm"))).alias("_link"),
    )
    base = keys.select(
        note, mention_id, F.col("s").cast("bigint").alias("s"), F.col("e").cast("bigint").alias("e"), "term",
        F.lit(None).cast(_SEG).alias("_crop"),
        F.lit(None).cast("struct<_iid:bigint,_iterm:string>").alias("_link"))
    # One shuffle: key rows and pair rows meet in the same group.
    g = base.unionByName(pairs.select(*base.columns)).groupBy(note, mention_id).agg(
        F.max("s").alias("s"), F.max("e").alias("e"), F.first("term", ignorenulls=True).alias("term"),
        F.collect_list("_crop").alias("_crops"), F.collect_list("_link").alias("_links"))
    merged = merge_segments(F.col("_crops"))
    return g.select(
        note, mention_id, "s", "e", "term",
        crop_text(F.col("term"), F.col("s"), F.col("e"), merged).alias("term_labels_removed"),
        F.transform(F.array_sort("_links"), lambda x: x["_iterm"]).alias("terms_linked_to_measurement"),
    )


# --------------------------------------------------------------------------
# J03, J04, E08
# --------------------------------------------------------------------------

def _no_zero_crop(ls: Column, le: Column, rs: Column, re_: Column) -> Column:
    return ~((F.greatest(ls, rs) == 0) & (F.least(le, re_) == 0))


def drop_discriminated(measures: DataFrame, discriminants: DataFrame, note: str = "source",
                       measure_id: Sequence[str] = ("k",), span: tuple[str, str] = ("s", "e"),
                       discr_span: tuple[str, str] = ("bs", "be"), bin_size: int = DEFAULT_BIN) -> DataFrame:
    """Measures overlapping (closed) any discriminant span of their note
    are dropped."""
    ids = [note, *measure_id]
    d = discriminants.select(note, *discr_span)
    hits = overlap_join(measures.select(*ids, *span), d, [note], span, discr_span, True, bin_size)
    hits = hits.where(_no_zero_crop(F.col(span[0]), F.col(span[1]), F.col(discr_span[0]),
                                    F.col(discr_span[1]))).select(*ids).distinct()
    return measures.join(hits, ids, "left_anti")


def attach_measures(keys: DataFrame, measures: DataFrame, key_id: Sequence[str],
                    value_col: str, note: str = "source", span: tuple[str, str] = ("s", "e"),
                    order_by: Sequence[str] = ("s",), out: str = "table_measures",
                    carry: Sequence[str] = (), bin_size: int = DEFAULT_BIN, key_spans: DataFrame | None = None) -> DataFrame:
    """Every measure attaches to every key mention it overlaps (closed);
    per key the attached values ordered by ``order_by``.  Keys without a
    measure get an empty list.  ``carry`` key columns ride along (no join
    back needed).  ``key_spans`` has the ids and spans of the same keys where these
    are cheaper to come by than ``keys``, which is then computed once."""
    key_id = list(key_id)
    carry = [c for c in carry if c not in key_id]
    item = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)],
                    F.col(value_col).alias("_v"))
    m = measures.select(note, F.col(span[0]).alias("_ms"), F.col(span[1]).alias("_me"), item.alias("_m"))
    pairs = overlap_join((keys if key_spans is None else key_spans).select(*key_id, *span), m, [note], span, ("_ms", "_me"), True, bin_size)
    pairs = pairs.where(_no_zero_crop(F.col(span[0]), F.col(span[1]), F.col("_ms"), F.col("_me")))
    # Key rows and pair rows meet in one shuffle; keys without pairs keep [].
    kt = keys.select(*key_id, *carry, F.lit(None).cast(m.schema["_m"].dataType).alias("_m"))
    pt = pairs.select(*key_id, *[F.lit(None).cast(kt.schema[c].dataType).alias(c) for c in carry], "_m")
    return kt.unionByName(pt).groupBy(*key_id).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in carry],
        F.transform(F.array_sort(F.collect_list("_m")), lambda x: x["_v"]).alias(out))


def overlap_coverage(keys: DataFrame, inner: DataFrame, note_cols: Sequence[str], key_id: Sequence[str],
                     span: tuple[str, str] = ("s", "e"), inner_span: tuple[str, str] = ("bs", "be"),
                     bin_size: int = DEFAULT_BIN) -> DataFrame:
    """Number of key mentions, number overlapping (closed) no inner
    mention, and their share."""
    ids = list(dict.fromkeys([*note_cols, *key_id]))
    hits = overlap_join(keys.select(*ids, *span), inner.select(*note_cols, *inner_span), note_cols,
                        span, inner_span, True, bin_size).select(*ids).distinct().withColumn("_hit", F.lit(1))
    flagged = keys.select(*ids).join(hits, ids, "left")
    unc = F.sum(F.when(F.col("_hit").isNull(), 1).otherwise(0))
    return flagged.agg(F.count(F.lit(1)).alias("n_keys"), unc.cast("bigint").alias("n_uncovered"),
                       (unc / F.count(F.lit(1))).alias("share_uncovered"))
