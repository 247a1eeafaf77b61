"""Corpus preparation: sampling and splits (O02-O07), label statistics
(A08), mention clean-up and overlap resolution (D17, D18) and note chunking
(D19).

Every random choice comes from ``md5(seed_id)`` so results are reproducible
and identical in SQL.  Sampling never ranks the whole table in one task:
``orderBy(...).limit(n)`` is a per-partition top-n merge, and per-stratum
samples take the top-n of salted sub-groups first (exact, skew-safe).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_key(seed, id_col: Column) -> Column:
    """md5 of ``seed_id`` (string order = random order)."""
    return F.md5(F.concat(F.lit(f"{seed}_"), id_col.cast("string")))


def hash_fraction(seed, id_col: Column) -> Column:
    """Uniform value in [0, 1) from the first 8 hex digits of the md5."""
    return F.conv(F.substring(hash_key(seed, id_col), 1, 8), 16, 10).cast("bigint") / float(16 ** 8)


def random_limit(df: DataFrame, id_col: str, n: int, seed=42) -> DataFrame:
    """``ORDER BY RAND() LIMIT n`` made deterministic."""
    return df.orderBy(hash_key(seed, F.col(id_col)), F.col(id_col)).limit(n)


def seeded_shuffle_limit(df: DataFrame, id_col: str, n: int | None, seed=42, shuffle: bool = True) -> DataFrame:
    """Shuffle with a seed then limit; the limit is ignored when not
    shuffling (as in the reference reader)."""
    if not shuffle:
        return df
    out = df.orderBy(hash_key(seed, F.col(id_col)), F.col(id_col))
    return out.limit(n) if n is not None else out


def sample_n(df: DataFrame, strata: Sequence[str], id_col: str, n: int, seed=42) -> DataFrame:
    """``n`` rows per stratum without replacement, those with the
    smallest hashes.  Spark keeps the first n of each stratum per partition
    before it shuffles (WindowGroupLimit), so a hot stratum is no burden."""
    w = Window.partitionBy(*strata).orderBy("_h", id_col)
    d = df.withColumn("_h", hash_key(seed, F.col(id_col)))
    return d.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_h", "_r")


def sort_rows(df: DataFrame, keys: Sequence[tuple[str, bool]]) -> DataFrame:
    """Total order by (column, ascending) keys: range partitions by
    sampled bounds, each sorted on its own."""
    return df.orderBy(*[F.col(c).asc() if up else F.col(c).desc() for c, up in keys])


def top1(df: DataFrame, group: Sequence[str], rank: Column, carry: Sequence[str]) -> DataFrame:
    """Per group the row with the least ``rank``; an aggregate, so only
    one row a group and task is shuffled."""
    best = df.groupBy(*group).agg(F.min_by(F.struct(*carry), rank).alias("_b"))
    return best.select(*group, *[F.col("_b")[c].alias(c) for c in carry])


def positional_split(df: DataFrame, id_col: str, seed=42, train: float = 0.8, test: float = 0.1) -> DataFrame:
    """The first 80 % of the rows for training, the next 10 % for test,
    the last 10 % for validation, by exact position in the seeded order.

    The order is that of a uniform hash, so its first four hex digits cut the
    rows into 65,536 even buckets: rows are counted per bucket, the (bounded)
    list of counts is summed up, and a row's position is the rows in earlier
    buckets plus its rank in its own.  No task sees more than a bucket."""
    key = hash_key(seed, F.col(id_col))
    d = df.withColumn("_h", key).withColumn("_b", F.substring(key, 1, 4))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = d.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")).select(
        "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(F.lit(0))).alias("_all"))
    d = d.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy("_h", id_col)))
    d = d.join(F.broadcast(counts), "_b")  # at most 65,536 rows
    p = F.col("_before") + F.col("_r") - 1
    split = (F.when(p < F.floor(F.col("_all") * train), "train")
              .when(p < F.floor(F.col("_all") * (train + test)), "test").otherwise("val"))
    return d.withColumn("split", split).drop("_h", "_b", "_before", "_all", "_r")


def balanced_split(notes: DataFrame, mentions: DataFrame, note: str, attr: str, draws: int,
                   held_out: float = 0.2, target: float = 0.2, seed=42) -> DataFrame:
    """Draw ``draws`` random held-out sets (half test, half val); per
    draw the share of each attribute's mentions that falls in test, rounded
    to 2; keep the draw whose summed share is nearest ``target × n_attr``.
    Returns one row per note with its split in the chosen draw.

    A split is a function of (draw, note), so the counts per note are expanded
    by draw and summed before any shuffle: no join, and the plan runs no job."""
    f = hash_fraction(seed, F.concat(F.col("draw").cast("string"), F.lit("_"), F.col(note).cast("string")))
    split = F.when(f < held_out / 2, "test").when(f < held_out, "val").otherwise("train")
    per_note = mentions.groupBy(note, attr).agg(F.count(F.lit(1)).alias("n"))
    per_attr = per_note.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws)))).groupBy("draw", attr).agg(
        F.round(F.sum(F.when(split == "test", F.col("n")).otherwise(0)) / F.sum("n"), 2).alias("share"))
    per_draw = per_attr.groupBy("draw").agg(F.sum("share").alias("total"), F.count(F.lit(1)).alias("n_attr"))
    best = per_draw.agg(F.min_by("draw", F.struct(F.pow(F.col("total") - target * F.col("n_attr"), 2), F.col("draw")))
                        .alias("draw"))
    chosen = notes.select(note).distinct().join(F.broadcast(best.where(F.col("draw").isNotNull())))  # one row
    return chosen.select(note, "draw", split.alias("split"))


def label_distribution(mentions: DataFrame, label: str = "label", attributes: str = "attributes") -> DataFrame:
    """Counts per entity label, per attribute name and per attribute
    value, as rows ``(kind, name, value, n)``."""
    labels = mentions.select(F.lit("label").alias("kind"), F.col(label).alias("name"),
                             F.lit(None).cast("string").alias("value"))
    attrs = mentions.select(F.explode(attributes).alias("name", "value"))
    names = attrs.select(F.lit("attribute").alias("kind"), "name", F.lit(None).cast("string").alias("value"))
    values = attrs.select(F.lit("attribute_value").alias("kind"), "name", "value")
    return labels.unionByName(names).unionByName(values).groupBy("kind", "name", "value").agg(
        F.count(F.lit(1)).alias("n"))


def clean_mentions(mentions: DataFrame, term: str = "term") -> DataFrame:
    """Drop mentions made only of ASCII punctuation, trim white space
    (shifting the offsets), drop mentions left empty."""
    t = F.col(term)
    lead = F.length(t) - F.length(F.regexp_replace(t, r"^\s+", ""))
    trail = F.length(t) - F.length(F.regexp_replace(t, r"\s+$", ""))
    stripped = F.regexp_replace(t, r"^\s+|\s+$", "")
    out = mentions.withColumn("s", F.col("s") + lead).withColumn("e", F.col("e") - trail).withColumn(term, stripped)
    return out.where((F.length(term) > 0) & ~F.col(term).rlike(r"^[!-/:-@\[-`{-~]+$"))


def resolve_overlaps(mentions: DataFrame, note: str = "source", mid: str = "k") -> DataFrame:
    """Greedy overlap resolution per note: longest span first, earlier
    start on ties; a span overlapping (half-open) a kept one is dropped.

    Spans decide about each other only within a run of overlapping spans, so a
    note is first cut into such islands (a span that starts at or after all
    earlier ends opens one), and only an island is folded.  The rows travel with
    their spans, so the mentions are computed and shuffled once.  ``mid`` is unique
    within a note; of rows that share it with equal offsets one is kept.  A mention
    without offsets overlaps nothing and stays."""
    earlier = Window.partitionBy(note).orderBy("s", "e", mid).rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce(F.col("s") >= F.max("e").over(earlier), F.lit(True)).cast("int")
    # each column travels once: what the span and the keys say is not in the row again
    rest = [c for c in mentions.columns if c not in (note, mid, "s", "e")]
    row = (F.struct(*(F.col(f"`{c}`") for c in rest)) if rest else F.lit(True)).alias("row")
    cut = mentions.select(F.col(note).alias("_note"), F.col(mid).alias("_id"), "s", "e", row, opens.alias("_o"))
    so_far = Window.partitionBy("_note").orderBy("s", "e", "_id").rowsBetween(Window.unboundedPreceding, 0)
    g = cut.withColumn("_island", F.sum("_o").over(so_far)).groupBy("_note", "_island").agg(
        F.collect_list(F.struct("s", "e", F.col("_id").alias("id"), "row")).alias("_rows"))
    # the order is sorted apart from the rows, which may hold maps
    g = g.select("_note", "_rows", F.array_sort(F.transform("_rows", lambda x, i: F.struct(
        (x["s"] - x["e"]).alias("neg_len"), x["s"].alias("s"), x["e"].alias("e"), x["id"].alias("id"), i.alias("i")))).alias("_m"))

    def step(kept: Column, x: Column) -> Column:
        clash = F.exists(kept, lambda y: F.least(y["e"], x["e"]) > F.greatest(y["s"], x["s"]))
        return F.when(F.coalesce(clash, F.lit(False)), kept).otherwise(F.concat(kept, F.array(x)))

    empty = F.array().cast(g.schema["_m"].dataType)
    kept = g.select("_note", "_rows", F.explode(F.aggregate("_m", empty, step)).alias("x"))
    kept = kept.select("_note", F.col("_rows")[F.col("x.i")].alias("x"))
    own = {mid: F.col("x.id"), "s": F.col("x.s"), "e": F.col("x.e"), note: F.col("_note")}
    return kept.select(*((F.col("x.row")[c] if c in rest else own[c]).alias(c) for c in mentions.columns))


SENTENCE = r"[^.!?\n]+[.!?]*"


def chunk_bounds(text: Column, max_len: int) -> Column:
    """D19 (chunks): sentences (runs ended by . ! ? or a line break) packed
    greedily into chunks of at most ``max_len`` words; a longer sentence is
    cut every ``max_len`` words, into chunks of its own.  Returns
    ``array<struct<start,end>>``."""
    from notelab.operators.measures import find_all
    piece = rf"\S+(?:\s+\S+){{0,{max_len - 1}}}"

    def words(m: Column) -> Column:
        return F.size(F.filter(F.split(m, r"\s+"), lambda w: w != ""))

    def cut(x: Column) -> Column:
        def whole(start: Column, m: Column, n: Column) -> Column:
            return F.struct(start.cast("int").alias("start"), m.alias("m"), n.cast("int").alias("n"))

        parts = F.transform(find_all(x["m"], piece), lambda y: whole(x["start"] + y["start"], y["m"], F.lit(max_len)))
        return F.when(words(x["m"]) > max_len, parts).otherwise(F.array(whole(x["start"], x["m"], words(x["m"]))))

    sents = F.flatten(F.transform(find_all(text, SENTENCE), cut))

    def step(acc: Column, x: Column) -> Column:
        n = x["n"]
        start, end = x["start"], x["start"] + F.length(x["m"])
        fits = (acc["n"] + n <= max_len) & (acc["n"] > 0)
        closed = F.when(acc["n"] > 0, F.concat(acc["out"], F.array(F.struct(acc["cs"].alias("start"),
                                                                             acc["ce"].alias("end")))))
        new_out = F.when(fits, acc["out"]).otherwise(F.coalesce(closed, acc["out"]))
        return F.struct(F.when(fits, acc["cs"]).otherwise(start).alias("cs"), end.alias("ce"),
                        F.when(fits, acc["n"] + n).otherwise(n).alias("n"), new_out.alias("out"))

    init = F.struct(F.lit(0).alias("cs"), F.lit(0).alias("ce"), F.lit(0).alias("n"),
                    F.array().cast("array<struct<start:int,end:int>>").alias("out"))
    return F.aggregate(sents, init, step, lambda acc: F.when(acc["n"] > 0, F.concat(acc["out"], F.array(
        F.struct(acc["cs"].alias("start"), acc["ce"].alias("end"))))).otherwise(acc["out"]))


def chunk_notes(notes: DataFrame, mentions: DataFrame, max_len: int, note: str = "doc_id",
                text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Chunks of each note and the mentions re-based into them
    (``max(0, s-start)``, ``min(end, e)-start``, kept if ``e > start`` and
    ``s < end``).  Chunks are row-local; mentions meet chunks on the binned
    overlap join."""
    from notelab.operators import spans
    ch = notes.select(note, F.posexplode(chunk_bounds(F.col(text), max_len)).alias("chunk", "b")).select(
        note, "chunk", F.col("b.start").alias("cstart"), F.col("b.end").alias("cend"))
    m = mentions.select(note, "k", "s", "e", "label")
    j = spans.overlap_join(m, ch, [note], ("s", "e"), ("cstart", "cend"), closed=False)
    rebased = j.select(note, "chunk", "k", "label", F.greatest(F.lit(0), F.col("s") - F.col("cstart")).alias("s"),
                       (F.least(F.col("cend"), F.col("e")) - F.col("cstart")).alias("e"))
    return ch, rebased
