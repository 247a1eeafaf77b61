"""Disease knowledge from nested JSON (D23's dimension).

One entry names a disease and holds, per kind of code (diagnoses, laboratory
codes, concepts), a list of codes, a list per analyte, or a list per section and
analyte.  Entries are read as VARIANT and exploded level by level, so a kind, a
section or an analyte that nobody foresaw needs no schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Section name of codes that count in every section.
EVERYWHERE = "all"


def knowledge_rows(entries: DataFrame, headings: DataFrame, disease: str = "disease", body: str = "body") -> DataFrame:
    """``disease, kind, only_in, analyte, code``, without repeats.

    ``only_in`` is the section label of the heading table that the entry's section
    name folds to, the name itself if the table has none, and null for codes that
    count everywhere.  Analytes are null for plain lists.  Null and broken JSON,
    empty lists, null codes and codes
    without a kind give no row; what lies deeper than section and
    analyte is not read."""
    from notelab.operators.sections import heading_key
    spark = entries.sparkSession
    rows = entries.select(F.col(disease).alias("disease"), F.try_parse_json(F.col(body).cast("string")).alias("_v0"))
    for level in range(1, 5):
        inner = F.col(f"_v{level - 1}").outer()
        explode = spark.tvf.variant_explode if level == 1 else spark.tvf.variant_explode_outer
        below = explode(inner).select(F.col("key").alias(f"_k{level}"), F.col("value").alias(f"_v{level}"))
        rows = rows.lateralJoin(below)
    # keys of the objects on the way; a list's elements have none
    keys = F.filter(F.array(*(F.col(f"_k{i}") for i in range(1, 5))), lambda k: k.isNotNull())
    leaf = F.coalesce(*(F.col(f"_v{i}") for i in (4, 3, 2)))
    rows = rows.select("disease", keys.alias("_keys"), F.try_variant_get(leaf, "$", "string").alias("code"),
                       F.schema_of_variant(leaf).alias("_type"))
    rows = rows.where(F.col("code").isNotNull() & ~F.col("_type").rlike("^(ARRAY|OBJECT)"))
    n = F.size("_keys")
    rows = rows.where(n > 0).select("disease", F.get("_keys", F.lit(0)).alias("kind"), F.when(n > 2, F.get("_keys", F.lit(1))).alias("_name"),
                       F.when(n > 1, F.element_at("_keys", -1)).alias("analyte"), "code")
    labels = headings.select(heading_key(F.col("heading")).alias("_key"), "section").groupBy("_key").agg(
        F.min("section").alias("_label"))
    rows = rows.withColumn("_key", heading_key(F.col("_name"))).join(labels, "_key", "left")
    only_in = F.when(F.col("_key") != EVERYWHERE, F.coalesce("_label", "_name"))
    return rows.select("disease", "kind", only_in.alias("only_in"), "analyte", "code").distinct()


def concepts(kb: DataFrame, kind: str) -> DataFrame:
    """``disease, analyte, code, only_in`` of one kind."""
    return kb.where(F.col("kind") == kind).select("disease", "analyte", "code", "only_in")


def cohort_by_disease(evidence: DataFrame, kb: DataFrame, note: str) -> DataFrame:
    """``disease, note, kinds``: the notes with a code of the disease, and the
    kinds of code that speak for it.  ``evidence`` has ``note, kind, section, code``;
    a code that counts in one section only needs that section (a null section never
    has it).  Codes are reduced to distinct rows before the join, which AQE plans by
    size: a code that a third of all notes carry is split there."""
    distinct = evidence.select(note, "kind", "section", "code").distinct()
    meets = distinct.join(kb.select("disease", "kind", "only_in", "code").distinct(), ["kind", "code"])
    meets = meets.where(F.col("only_in").isNull() | (F.col("only_in") == F.col("section")))
    return meets.groupBy("disease", note).agg(F.array_sort(F.collect_set("kind")).alias("kinds"))
