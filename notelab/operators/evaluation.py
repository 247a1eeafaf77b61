"""Evaluation against gold annotations (E01-E07, A09, A10, X20) and the
evaluation joins (J06, J07, J18-J21).

Gold rows and predictions are matched with the half-open overlap (J02) on
the binned range join; per gold (or per prediction) results are folded with
one group-by.  The bootstrap collapses outcomes to their class counts, so a
resample is a draw over ``n`` slots whose class follows from a hashed index:
``B × n`` slots in independent blocks (fully parallel), or
one multinomial draw per resample in an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelab.functions import md5
from notelab.functions.text import conditional_code
from notelab.operators import spans


def safe_prf(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    """Precision, recall, F1; -1 for all three when a division by
    zero occurs."""
    p = F.try_divide(tp.cast("double"), tp + fp)
    r = F.try_divide(tp.cast("double"), tp + fn)
    f = F.try_divide(2 * p * r, p + r)
    bad = p.isNull() | r.isNull() | f.isNull()
    return (F.when(bad, -1.0).otherwise(p), F.when(bad, -1.0).otherwise(r), F.when(bad, -1.0).otherwise(f))


def join_annotator_notes(mentions: DataFrame, notes: DataFrame, keys: Sequence[str] = ("source", "k")) -> DataFrame:
    """Mention ⟕ annotator note on (note, mention id), rows without an
    annotation dropped."""
    return mentions.join(notes, list(keys), "left").where(F.col("annotation").isNotNull())


def classify_detection(gold: DataFrame, pred: DataFrame, note: str = "source") -> DataFrame:
    """One row per annotated gold mention with the union of the codes of
    the predictions overlapping it (half-open) and its outcome: ``TP`` gold
    code among them, ``FP`` predictions but not the code, ``FN`` overlapping
    predictions without any code, ``not_pred`` no overlapping prediction."""
    g = gold.where(F.col("annotation").isNotNull()).select(
        note, "k", "s", "e", conditional_code(F.col("annotation")).alias("gold_label"))
    p = pred.select(note, F.col("s").alias("ps"), F.col("e").alias("pe"), F.col("codes").alias("pcodes"))
    pairs = spans.overlap_join(g.select(note, "k", "s", "e"), p, [note], ("s", "e"), ("ps", "pe"), closed=False)
    codes = pairs.select(note, "k", F.lit(None).cast("string").alias("gold_label"),
                         F.lit(1).alias("pred"), F.explode_outer("pcodes").alias("code"))
    rows = g.select(note, "k", "gold_label", F.lit(0).alias("pred"), F.lit(None).cast("string").alias("code"))
    agg = rows.unionByName(codes).groupBy(note, "k").agg(
        F.first("gold_label", ignorenulls=True).alias("gold_label"),
        F.max("pred").alias("n_pred"), F.array_sort(F.collect_set("code")).alias("detected"))
    outcome = (F.when(F.col("n_pred") == 0, "not_pred")
                .when(F.size("detected") == 0, "FN")
                .when(F.array_contains("detected", F.col("gold_label")), "TP").otherwise("FP"))
    return agg.select(note, "k", "gold_label", "detected", outcome.alias("outcome"))


def outcome_shares(outcomes: DataFrame, col: str = "outcome") -> DataFrame:
    """Count and share of every outcome."""
    from pyspark.sql import Window
    c = outcomes.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def unmapped_gold(gold: DataFrame, pred: DataFrame, note: str = "source") -> DataFrame:
    """Gold rows overlapped (half-open) by no prediction."""
    return spans.overlap_semi(gold, pred.select(note, F.col("s").alias("ps"), F.col("e").alias("pe")),
                              [note], ["k"], ("s", "e"), ("ps", "pe"), closed=False, anti=True)


def classify_full(gold: DataFrame, pred: DataFrame, equal_measures, note: str = "source") -> DataFrame:
    """Per prediction the codes and measures of all gold rows that it
    overlaps (half-open) are pooled: ``TP`` when the code sets meet and the
    measures are equal (X18), else ``FP``, also without any gold; gold rows
    overlapped by no prediction are ``FN`` (J20).  The annotation's measure is
    what follows its first ``_``."""
    g = gold.where(F.col("annotation").contains("_")).select(
        note, F.col("k").alias("gk"), F.col("s").alias("gs"), F.col("e").alias("ge"),
        F.split("annotation", "_", 2)[0].alias("gcode"), F.split("annotation", "_", 2)[1].alias("gmeasure"))
    p = pred.select(note, "k", "s", "e", "codes", "found")
    pairs = spans.overlap_join(p.select(note, "k", "s", "e"), g, [note], ("s", "e"), ("gs", "ge"), closed=False)
    # one group per prediction, made of its own row and its overlapping golds
    rows = p.select(note, "k", "codes", "found").unionByName(pairs.select(note, "k", "gcode", "gmeasure"), True)
    pooled = rows.groupBy(note, "k").agg(
        F.first("codes", ignorenulls=True).alias("codes"), F.first("found", ignorenulls=True).alias("found"),
        F.collect_set("gcode").alias("gcodes"), F.collect_list("gmeasure").alias("gfound"))
    ok = F.arrays_overlap("codes", "gcodes") & equal_measures(F.col("found"), F.col("gfound"))
    tp_fp = pooled.select(note, "k", F.lit("pred").alias("side"),
                          F.when(F.coalesce(ok, F.lit(False)), "TP").otherwise("FP").alias("outcome"))
    fn = unmapped_gold(g.select(note, F.col("gk").alias("k"), F.col("gs").alias("s"), F.col("ge").alias("e")),
                       p, note).select(note, "k", F.lit("gold").alias("side"), F.lit("FN").alias("outcome"))
    return tp_fp.unionByName(fn)


def prf_table(outcomes: DataFrame, col: str = "outcome") -> DataFrame:
    """E04 over an outcome table: counts and P/R/F."""
    c = outcomes.agg(*[F.sum((F.col(col) == o).cast("long")).alias(o.lower()) for o in ("TP", "FP", "FN")])
    p, r, f = safe_prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return c.select("tp", "fp", "fn", p.alias("precision"), r.alias("recall"), f.alias("f1"))


def text_set_prf(gold: DataFrame, pred: DataFrame, note: str = "source", text: str = "term") -> DataFrame:
    """Per note, distinct gold texts against distinct predicted texts."""
    g = gold.select(note, text).distinct().withColumn("_g", F.lit(1))
    p = pred.select(note, text).distinct().withColumn("_p", F.lit(1))
    j = g.join(p, [note, text], "full_outer")
    c = j.groupBy(note).agg(
        F.sum(F.when(F.col("_g").isNotNull() & F.col("_p").isNotNull(), 1).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("_g").isNull(), 1).otherwise(0)).alias("fp"),
        F.sum(F.when(F.col("_p").isNull(), 1).otherwise(0)).alias("fn"))
    pr, rc, f1 = safe_prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return c.select(note, F.col("tp").cast("long").alias("tp"), F.col("fp").cast("long").alias("fp"),
                    F.col("fn").cast("long").alias("fn"), pr.alias("precision"), rc.alias("recall"), f1.alias("f1"))


def entity_prf_per_type(gold: DataFrame, pred: DataFrame, key: Sequence[str] = ("source", "s", "e", "label"),
                        label: str = "label", digits: int = 5) -> DataFrame:
    """Exact-match entity scores per label and overall (micro), via
    ``rollup``; the overall row has label ``ALL``."""
    g = gold.select(*key).distinct().withColumn("_g", F.lit(1))
    p = pred.select(*key).distinct().withColumn("_p", F.lit(1))
    j = g.join(p, list(key), "full_outer")
    c = j.rollup(label).agg(
        F.sum(F.when(F.col("_g").isNotNull() & F.col("_p").isNotNull(), 1).otherwise(0)).cast("long").alias("tp"),
        F.sum(F.when(F.col("_g").isNull(), 1).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when(F.col("_p").isNull(), 1).otherwise(0)).cast("long").alias("fn"))
    pr, rc, f1 = safe_prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return c.select(F.coalesce(F.col(label), F.lit("ALL")).alias(label), "tp", "fp", "fn",
                    F.round(pr, digits).alias("precision"), F.round(rc, digits).alias("recall"),
                    F.round(f1, digits).alias("f1"))


def histogram(df: DataFrame, col: str, bins: int = 30, group: Sequence[str] = ()) -> DataFrame:
    """A10: equal-width histogram between min and max (per group)."""
    group = list(group)
    bounds = df.groupBy(*group).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi")) if group else \
        df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi")).withColumn("_one", F.lit(1))
    keys = group or ["_one"]
    d = df if group else df.withColumn("_one", F.lit(1))
    j = d.join(bounds, keys)
    b = F.when(F.col("_hi") == F.col("_lo"), 1).otherwise(
        F.least(F.lit(bins), F.width_bucket(F.col(col), F.col("_lo"), F.col("_hi"), F.lit(bins))))
    out = j.groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.first("_lo").alias("lo"),
                                               F.first("_hi").alias("hi"))
    return out.drop("_one")


# --------------------------------------------------------------------------
# E07 bootstrap
# --------------------------------------------------------------------------

#: Slots of a resample that one row of the exact bootstrap stands for.
SLOTS = 8192


def _class_counts(outcomes: DataFrame, col: str) -> DataFrame:
    return outcomes.agg(*[F.sum((F.col(col) == o).cast("long")).alias(o.lower()) for o in ("TP", "FP", "FN")])


def _summarise(draws: DataFrame) -> DataFrame:
    p, r, f = safe_prf(F.col("tp"), F.col("fp"), F.col("fn"))
    m = draws.select(p.alias("precision"), r.alias("recall"), f.alias("f1"))
    stacked = m.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("v"))
                                           for c in ("precision", "recall", "f1")])).alias("x")).select("x.*")
    return stacked.groupBy("metric").agg(
        F.round(F.avg("v"), 6).alias("mean"),
        F.round(F.percentile("v", F.lit(0.025)), 6).alias("p025"),
        F.round(F.percentile("v", F.lit(0.975)), 6).alias("p975"))


def bootstrap_exact(outcomes: DataFrame, draws: int, col: str = "outcome", seed: int = 42) -> DataFrame:
    """E07 (deterministic): resample b, slot i picks the outcome of index
    ``md5(b_i) mod n`` in class order TP, FP, FN; same indices as the SQL
    oracle.  A row of ``spark.range`` and its blocks of ``SLOTS`` slots each."""
    spark = outcomes.sparkSession
    # the class counts are one row: joined to every resample id on a constant key
    counts = (_class_counts(outcomes, col).withColumn("n", F.col("tp") + F.col("fp") + F.col("fn"))
              .withColumn("_one", F.lit(0)))
    # a row a block of slots; the hashes of a block are columns in a task
    blocks = (spark.range(draws).select(F.col("id").alias("b"), F.lit(0).alias("_one"))
              .join(F.broadcast(counts), "_one").where(F.col("n") > 0)
              .select("b", "tp", "fp", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {SLOTS}")))))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for b, tp, fp, n, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                idx = md5.numbered(f"{seed}_{b}_".encode(), block * SLOTS, min((block + 1) * SLOTS, n) - 1) % n
                first, second = int((idx < tp).sum()), int((idx < tp + fp).sum())
                out.append((b, first, second - first, len(idx) - second))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 4)],
                                             names=["b", "tp", "fp", "fn"])

    per = blocks.mapInArrow(draw, "b long, tp long, fp long, fn long").groupBy("b").agg(
        *[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    return _summarise(per)


def bootstrap_multinomial(outcomes: DataFrame, draws: int, col: str = "outcome", seed: int = 42,
                          slices: int = 64) -> DataFrame:
    """E07 (fast): each resample is one multinomial draw over the class
    counts, seeded by the resample's id (per 1,024 ids), so that the result does
    not depend on how rows are batched."""
    spark = outcomes.sparkSession
    counts = _class_counts(outcomes, col).withColumn("_one", F.lit(0))
    ids = (spark.range(0, draws, 1, numPartitions=slices).withColumn("_one", F.lit(0))
           .join(F.broadcast(counts), "_one").drop("_one"))

    def draw(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            tp, fp, fn = (int(pdf[c].iloc[0]) for c in ("tp", "fp", "fn"))
            n = tp + fp + fn
            x = np.zeros((len(pdf), 3), int)
            ids = pdf["id"].to_numpy()
            for block in np.unique(ids // 1024) if n else []:
                drawn = np.random.default_rng([seed, block]).multinomial(n, [tp / n, fp / n, fn / n], size=1024)
                own = ids // 1024 == block
                x[own] = drawn[ids[own] % 1024]
            yield pd.DataFrame({"tp": x[:, 0], "fp": x[:, 1], "fn": x[:, 2]})

    per = ids.mapInPandas(draw, "tp long, fp long, fn long")
    return _summarise(per)


def concat_lists(df: DataFrame, by: Sequence[str], order: str, first: Sequence[str] = (), collected: Sequence[str] = (),
                 concatenated: Sequence[str] = ()) -> DataFrame:
    """Per group, in the order of ``order`` (unique within a group): the first
    value of the columns ``first`` (named ``first_<column>``), the list of the values of
    ``collected`` (nulls kept) and the concatenation of the arrays ``concatenated`` (a
    null array adds nothing).  A list is as long as its group: for groups within a note."""
    used = list(dict.fromkeys([order, *first, *collected, *concatenated]))
    rows = df.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*used))).alias("_l"))
    return rows.select(
        *by, *(F.col("_l")[0][c].alias(f"first_{c}") for c in first),
        *(F.col(f"_l.{c}").alias(c) for c in collected),
        *(F.flatten(F.filter(F.col(f"_l.{c}"), lambda v: v.isNotNull())).alias(c) for c in concatenated))
