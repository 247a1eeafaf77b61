"""Other sources and sinks (S06-S11, S16-S18): JSON lines notes, pandas
``to_json`` frames, delimited terminology files, catalog scans, result
writers, the annotated-note store, the vector store and metrics.

Paths are whatever the caller passes (shared storage on a cluster); nothing
here touches the driver's local disk.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# M2: the rich note (entities, context, split).
NOTE_SCHEMA = T.StructType([
    T.StructField("note_text", T.StringType()),
    T.StructField("note_id", T.StringType()),
    T.StructField("note_class_source_value", T.StringType()),
    T.StructField("note_datetime", T.TimestampType()),
    T.StructField("entities", T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
        T.StructField("label", T.StringType())]))),
    T.StructField("context", T.MapType(T.StringType(), T.StringType())),
    T.StructField("split", T.StringType()),
])


def read_notes_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines → M2 with defaults ``[]``, ``{}`` and null split."""
    d = spark.read.schema(NOTE_SCHEMA).json(path)
    return d.select("note_text", "note_id", "note_class_source_value", "note_datetime",
                    F.coalesce("entities", F.array().cast(NOTE_SCHEMA["entities"].dataType)).alias("entities"),
                    F.coalesce("context", F.create_map().cast(NOTE_SCHEMA["context"].dataType)).alias("context"),
                    "split")


def write_notes_jsonl(notes: DataFrame, path: str) -> None:
    notes.write.mode("overwrite").json(path)


def read_corpus(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """One facade, each giving notes with text and entities: a ``standoff``
    corpus (packed tables ``lines`` and ``notes`` below ``path``), ``jsonl``
    file(s) or the parquet note store."""
    if fmt == "standoff":
        return standoff_corpus(spark.read.parquet(f"{path}/lines"), spark.read.parquet(f"{path}/notes"))
    if fmt == "jsonl":
        return read_notes_jsonl(spark, path)
    if fmt == "parquet":
        return read_note_store(spark, path)
    raise ValueError(f"unknown corpus format {fmt!r}")


def standoff_corpus(lines: DataFrame, notes: DataFrame) -> DataFrame:
    """Notes ``(source, note_text)`` with the mentions and attributes of their
    standoff lines ``(source, line)``."""
    from notelab.operators.filters import parse_span
    from notelab.sources import standoff
    m = standoff.parse_mentions(lines).where(F.col("label") != "AnnotatorNotes")
    m = m.join(standoff.parse_attributes(lines), ["source", "ann_id"], "left")
    span = parse_span(F.col("span"))
    entities = m.groupBy("source").agg(F.array_sort(F.collect_list(F.struct(
        span[0].cast("int").alias("start"), span[1].cast("int").alias("end"), "label",
        F.map_entries("attributes").alias("attributes")))).alias("entities"))
    none = F.array().cast(entities.schema["entities"].dataType)
    return notes.join(entities, "source", "left").select(
        F.col("source").alias("note_id"), "note_text", F.coalesce("entities", none).alias("entities"))


def write_frame_json(df: DataFrame, path: str, index: str, max_rows: int = 100_000) -> None:
    """S08 sink, for small result frames: the layout is one object per column,
    so a frame is one row of one file.  Raises beyond ``max_rows``."""
    if df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"frame of more than {max_rows} rows: write it as parquet")
    cols = [c for c in df.columns if c != index]
    key = F.col(index).cast("string")
    frame = df.agg(*[F.map_from_entries(F.collect_list(F.struct(key, c))).alias(c) for c in cols])
    frame.select(F.to_json(F.struct(*cols)).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def read_frame_json(spark: SparkSession, path: str) -> DataFrame:
    """A pandas ``to_json`` file ``{column: {index: value}}`` back to
    rows (values as JSON text), one row per index."""
    raw = spark.read.option("wholetext", "true").text(path)
    cells = raw.select(F.explode(F.from_json("value", "map<string,map<string,string>>")).alias("col", "cells"))
    cells = cells.select("col", F.explode("cells").alias("idx", "val"))
    return cells.groupBy("idx").pivot("col").agg(F.first("val"))


def read_delimited(spark: SparkSession, path: str, sep: str, names: Sequence[str] | None = None,
                   header: bool = False) -> DataFrame:
    """Tab / pipe / comma files; ``names`` gives an all-string schema."""
    r = spark.read.option("sep", sep).option("header", str(header).lower())
    if names:
        r = r.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    return r.csv(path)


def catalog_scan(spark: SparkSession, table: str, cols: Sequence[str], where: str | None = None) -> DataFrame:
    """``SELECT cols FROM table WHERE ..`` (pruning and pushdown by
    Catalyst)."""
    d = spark.table(table).select(*cols)
    return d.where(where) if where else d


def write_result(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a result frame as parquet, JSON lines or CSV."""
    w = df.write.mode("overwrite")
    {"parquet": w.parquet, "json": w.json, "csv": lambda p: w.option("header", "true").csv(p)}[fmt](path)


def write_note_store(notes: DataFrame, path: str) -> None:
    """Annotated notes as nested parquet; user data pruned to
    ``note_id``, ``context`` and ``split``."""
    notes.select("note_id", "note_text", "entities", "context", "split").write.mode("overwrite").parquet(path)


def read_note_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_vectors(vectors: DataFrame, path: str, key: str, vec: str) -> None:
    """Embeddings as ``array<float>`` parquet (reused instead of
    recomputed)."""
    vectors.select(key, F.col(vec).cast("array<float>").alias(vec)).write.mode("overwrite").parquet(path)


def metrics_row(spark: SparkSession, metrics: dict) -> DataFrame:
    """A metrics dict as a one-row frame; keys lower-cased with spaces
    and slashes turned to ``_``."""
    clean = {re.sub(r"[ /]", "_", k.lower()): float(v) for k, v in metrics.items()}
    return spark.createDataFrame([clean])


def metrics_from(df: DataFrame) -> DataFrame:
    """S18 for metrics computed by Spark: rename the columns the same way."""
    return df.select(*[F.col(f"`{c}`").alias(re.sub(r"[ /]", "_", c.lower())) for c in df.columns])
