"""Sections and disease cohorts.

Sections open at lines that equal a heading of a table; mentions meet sections
on the binned half-open overlap join (J02); the disease knowledge
(``operators/knowledge.py``) is a long dimension table joined on code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notelab.functions.bloom import Members
from notelab.functions.runs import likely_runs, whole_hashes
from notelab.operators import measures as ms
from notelab.operators import spans
from notelab.session import written

# Headings of clinical notes and their section labels.
SECTION_HEADINGS = (
    ("motif", "SECTION_motif"), ("motif d'hospitalisation", "SECTION_motif"),
    ("antécédents", "SECTION_antecedent"), ("antécédents familiaux", "SECTION_antecedent_familiaux"),
    ("mode de vie", "SECTION_mode_de_vie"), ("histoire de la maladie", "SECTION_histoire"),
    ("examen clinique", "SECTION_examen_clinique"), ("examens complémentaires", "SECTION_examen_complementaire"),
    ("traitement", "SECTION_traitement"), ("traitement à l'entrée", "SECTION_traitement_entree"),
    ("traitement de sortie", "SECTION_traitement_sortie"), ("évolution", "SECTION_evolution"),
    ("conclusion", "SECTION_conclusion"), ("autre", "SECTION_autre"),
)
# The four diseases of the cohort study.
DISEASES = ("lupus", "takayasu", "sclerodermie", "sapl")

#: A line that may open a section (group 1 its words): words alone on the line, or
#: up to a colon.  Lines end at a line feed only.
HEADING_LINE = r"(?md)^[ \t]*([a-z][a-z' ]*?)[ \t]*(?::|$)"


def section_headings(spark: SparkSession) -> DataFrame:
    """The built-in heading table ``heading, section``."""
    return spark.createDataFrame(list(SECTION_HEADINGS), "heading string, section string")


def heading_key(c: Column) -> Column:
    """What headings are compared by: lower case, accents folded, apostrophes and
    runs of blanks as one space."""
    return F.trim(F.regexp_replace(ms.normalize_for_matching(c), "[' ]+", " "))


def detect_sections(notes: DataFrame, note: str, text: str, headings: DataFrame) -> DataFrame:
    """``(note, start, end, section)``: a line that begins with a heading of the
    table ``heading, section`` (alone on its line or before a colon, in any case, with
    or without accents) opens a section, which ends where the next one starts or with
    the note.  What stands before the first heading is in no section.  Headings are
    met by an equi-join; equal headings take the least label; notes without text or
    heading have no row.  ``note`` is taken as unique."""
    found = ms.find_all(ms.normalize_for_matching(F.col(text)), HEADING_LINE, [1])
    lines = notes.select(note, F.length(F.col(text)).cast("int").alias("_len"), F.explode(found).alias("_x")).select(
        note, "_len", F.col("_x.start").alias("start"), heading_key(F.col("_x.g1")).alias("_key"))
    table = headings.select(heading_key(F.col("heading")).alias("_key"), "section").groupBy("_key").agg(
        F.min("section").alias("section"))
    opened = lines.join(table, "_key")
    end = F.lead("start").over(Window.partitionBy(note).orderBy("start"))
    return opened.select(note, "start", F.coalesce(end, F.col("_len")).alias("end"), "section")


def folded_words(c: Column) -> Column:
    """The lower-cased, accent-folded words of a text, joined by a space."""
    return F.array_join(F.regexp_extract_all(ms.normalize_for_matching(c), F.lit("[a-z0-9]+"), F.lit(0)), " ")


def phrase_matches(notes: DataFrame, terminology: DataFrame, note: Sequence[str], text: str, term: str = "term",
                   code: str = "code") -> DataFrame:
    """Every run of words of a note that equals a folded term, overlapping ones
    included: ``_note (struct), s, e, term, code`` (least term and code of equal ones).

    A term is known by the hash of its words.  Where a run of as many words as some
    term has may be a term by a Bloom filter of these hashes (of bounded size and
    broadcast), the run goes on to the equi-join with the terms, which makes the
    result exact; no other word of a note leaves its task.  Past the filter's size
    more runs are joined than match.  Notes without text and terms without a word
    match nothing."""
    folded = terminology.select(folded_words(F.col(term)).alias("_folded"), F.col(term).alias("term"),
                                F.col(code).alias("code")).where(F.col("_folded") != "")
    terms = written(folded.groupBy("_folded").agg(F.min("term").alias("term"), F.min("code").alias("code")), "terms")
    words = F.split("_folded", " ")
    sizes = [r[0] for r in terms.select(F.size(words)).distinct().collect()]  # a number per length
    if not sizes:
        sizes = [1]
    own = terms.select(F.transform(words, lambda w: F.xxhash64(w)).alias("_h")).mapInArrow(whole_hashes, "h long")
    members = Members(own, terms.count(), hashed=True)
    found = ms.find_all(ms.normalize_for_matching(F.col(text)), "[a-z0-9]+")
    read = notes.select(F.struct(*note).alias("_note"), found.alias("_words"))
    read = read.withColumn("_h", F.transform("_words", lambda x: F.xxhash64(x["m"])))
    types = T.StructType([read.schema["_note"], *(T.StructField(c, t) for c, t in (
        ("s", T.IntegerType()), ("e", T.IntegerType()), ("_folded", T.StringType())))])
    runs = read.mapInArrow(likely_runs(members, sizes), types)
    return runs.join(terms, "_folded").select("_note", "s", "e", "term", "code")


def tag_mentions(notes: DataFrame, terminology: DataFrame, note: Sequence[str], text: str, term: str = "term",
                 code: str = "code") -> DataFrame:
    """D01 as a gazetteer: the runs of words that equal a folded term (any number
    of words), longest first where they overlap, then the earlier one:
    ``note…, s, e, term, code`` (the least term and code of equal folded terms).
    Trained taggers plug in with :func:`tag_with`."""
    from notelab.operators.corpus import resolve_overlaps
    found = phrase_matches(notes, terminology, note, text, term, code)
    # runs that begin at one word differ in length: the offsets alone tell them apart
    kept = resolve_overlaps(found, note="_note", mid="s")
    return kept.select("_note.*", "s", "e", "term", "code")


def tag_with(notes: DataFrame, text: str, taggers: dict, groups: Sequence[str], extensions: Sequence[str] = (),
             types: dict | None = None) -> DataFrame:
    """Any tagger (a function from a note to spans with values) as a table
    function joined laterally to the notes; one row a span of the chosen groups,
    with the chosen extensions."""
    from notelab.functions.table_functions import note_spans
    return note_spans(notes, text, groups, extensions, taggers, types)


def dictionary_lookup(mentions: DataFrame, kb: DataFrame, mention_id: Sequence[str], within: str | None = None) -> DataFrame:
    """The (disease, analyte) pairs a mention's codes point to; a mention
    counts once per analyte however many of its codes match.  With ``within`` (the
    mention's section, one of ``mention_id``) a code that ``kb`` holds for one section
    (``only_in``) counts there only."""
    ex = mentions.select(*mention_id, F.explode(F.array_distinct("codes")).alias("code"))
    met = ex.join(kb, "code")
    if within:
        met = met.where(F.col("only_in").isNull() | (F.col("only_in") == F.col(within)))
    return met.select(*mention_id, "disease", "analyte").distinct()


def place_mentions(mentions: DataFrame, sections: DataFrame, note: str) -> DataFrame:
    """Mentions with the section they lie in (half-open overlap; one that reaches into
    two sections is in both, one outside all of them has no row)."""
    s = sections.select(note, F.col("start").alias("ss"), F.col("end").alias("se"), "section")
    return spans.overlap_join(mentions, s, [note], ("s", "e"), ("ss", "se"), closed=False)


def section_stats(mentions: DataFrame, sections: DataFrame, kb: DataFrame, note: str) -> DataFrame:
    """Mentions placed in sections, mapped to disease/analyte (codes that belong
    to one section count there only), terms listed per (note, section, disease,
    analyte)."""
    placed = place_mentions(mentions, sections, note)
    da = dictionary_lookup(placed, kb, [note, "s", "e", "term", "section"], within="section")
    return da.groupBy(note, "section", "disease", "analyte").agg(F.array_sort(F.collect_list("term")).alias("terms"))


def _by_key(a: Column, b: Column) -> Column:
    return F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)


def section_summary(stats: DataFrame, note: str) -> DataFrame:
    """Per (note, section) the nested map disease → analyte → terms
    (analytes without terms never appear); entries in key order."""
    per_dis = stats.groupBy(note, "section", "disease").agg(F.map_from_entries(F.array_sort(
        F.collect_list(F.struct(F.col("analyte").alias("key"), F.col("terms").alias("value"))), _by_key)).alias(
        "analytes"))
    return per_dis.groupBy(note, "section").agg(F.map_from_entries(F.array_sort(
        F.collect_list(F.struct(F.col("disease").alias("key"), F.col("analytes").alias("value"))), _by_key)).alias(
        "summary"))


#: Buckets of a bracket in one round of :func:`exact_quantiles`.
BUCKETS = 1024


def _signed_log(v: Column) -> Column:
    """Rises with ``v``; 745 is above minus the logarithm of the least double."""
    return F.signum(v) * F.coalesce(F.log(F.abs(v)) + 745, F.lit(0.0))


def _bucket(v: Column, lo: Column, hi: Column, by_log: bool) -> Column:
    """The bucket of a value of ``[lo, hi]``, rising with the value; the ends fall
    into different ones, also where the width overflows or underflows."""
    x, first, last = (_signed_log(c) if by_log else c / 2 for c in (v, lo, hi))
    share = F.try_divide(x - first, last - first)
    inner = F.when(F.coalesce(F.isnan(share), F.lit(True)), F.lit(1)).otherwise(F.floor(share * BUCKETS))
    inside = F.least(F.greatest(inner, F.lit(0)), F.lit(BUCKETS - 1))
    return F.when(v == lo, 0).when(v == hi, BUCKETS - 1).otherwise(inside).cast("int")


def exact_quantiles(values: DataFrame, group: Sequence[str], value: str, shares: Sequence[float]) -> DataFrame:
    """``group…, quantiles`` (array, one per share): exact interpolated quantiles by
    distributed selection; nulls and NaN are left out, groups without values have no row.

    Values are counted once per (group, value), a shuffle that spreads a hot group
    over its values.  Every rank looked for has a bracket ``[lo, hi]``; a round counts
    the bracket's values in ``BUCKETS`` buckets of equal width (on a logarithmic scale
    in every other round, for values of many magnitudes; combined before the shuffle), adds up at most that many rows, and narrows the bracket to the least and
    greatest value of the bucket with the rank, until both are equal.  No task ever
    sees the values of a group together; the driver only learns whether a bracket is
    still open."""
    from notelab.session import cut_lineage
    if not shares:
        raise ValueError("no shares")
    v = F.col(f"`{value}`").cast("double")
    counts = cut_lineage(values.where(v.isNotNull() & ~F.isnan(v)).groupBy(
        F.struct(*(F.col(f"`{c}`") for c in group)).alias("_g"), v.alias("_v")).agg(F.count(F.lit(1)).alias("_n")))
    totals = counts.groupBy("_g").agg(F.sum("_n").alias("_total"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    place = [(F.col("_total") - 1) * F.lit(float(q)) for q in shares]
    ranks = F.array_distinct(F.array(*[f(x).cast("bigint") for x in place for f in (F.floor, F.ceil)]))
    open_ = cut_lineage(totals.select("_g", "_lo", "_hi", F.lit(0).cast("bigint").alias("_below"), F.explode(ranks).alias("_rank")))
    found = open_.where("_lo = _hi")
    by_log = False
    while open_.where("_lo < _hi").limit(1).count():
        by_log = not by_log
        open_ = open_.where("_lo < _hi")
        brackets = open_.select("_g", "_lo", "_hi", "_below").distinct()
        bucketed = counts.join(brackets, "_g").where("_v between _lo and _hi").groupBy(
            "_g", "_lo", "_hi", "_below", _bucket(F.col("_v"), F.col("_lo"), F.col("_hi"), by_log).alias("_b")).agg(
            F.sum("_n").alias("_in"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
        so_far = Window.partitionBy("_g", "_lo", "_hi", "_below").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
        ends = bucketed.withColumn("_to", F.col("_below") + F.sum("_in").over(so_far))
        holds = (F.col("_rank") < F.col("_to")) & (F.col("_rank") >= F.col("_to") - F.col("_in"))
        open_ = cut_lineage(open_.join(ends, ["_g", "_lo", "_hi", "_below"]).where(holds).select(
            "_g", F.col("_least").alias("_lo"), F.col("_most").alias("_hi"), (F.col("_to") - F.col("_in")).alias("_below"), "_rank"))
        found = found.unionByName(open_.where("_lo = _hi"))
    at = found.groupBy("_g").agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_lo"))).alias("_at"))

    def between(x: Column) -> Column:
        low, high = F.floor(x).cast("bigint"), F.ceil(x).cast("bigint")
        a, b = F.col("_at")[low], F.col("_at")[high]
        return F.when(a == b, a).otherwise((high - x) * a + (x - low) * b)

    return totals.join(at, "_g").select("_g.*", F.array(*[between(x) for x in place]).alias("quantiles"))


def measurement_stats(measures: DataFrame, group: Sequence[str], note: str, value: str = "base_value") -> DataFrame:
    """Per group, notes, mentions, mentions per note and the exact value
    quartiles.  Mentions are counted per note first, so a hot group is spread over
    its notes; a null note counts as a mention but not as a note, and a group without
    values has null quartiles."""
    g = F.struct(*(F.col(f"`{c}`") for c in group)).alias("_g")
    per_note = measures.groupBy(g, F.col(note).alias("_note")).agg(F.count(F.lit(1)).alias("_n"))
    counts = per_note.groupBy("_g").agg(F.count("_note").alias("n_notes"), F.sum("_n").alias("n_mentions"))
    q = exact_quantiles(measures, group, value, (0.25, 0.5, 0.75)).select(F.struct(*group).alias("_g"), "quantiles")
    return counts.join(q, "_g", "left").select(
        "_g.*", "n_notes", "n_mentions", F.try_divide(F.col("n_mentions"), F.col("n_notes")).alias("per_note"),
        *[F.col("quantiles")[i].alias(p) for i, p in enumerate(("p25", "p50", "p75"))])
