"""Structured Streaming entry point for the stateless note operators.

D03-D08, D13-D17 and D21 work note by note with no state, so a streaming
DataFrame of notes goes through the same expressions as a batch one.  This
module wires a file stream of notes to a sink with ``foreachBatch`` (each
micro-batch is written idempotently per batch id; the checkpoint makes the
query restartable after executor or driver loss).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notelab.operators import measures as ms
from notelab.operators import prescriptions as rx

NOTE_STREAM_SCHEMA = T.StructType([T.StructField("note_id", T.StringType()), T.StructField("note_text", T.StringType())])


def measures_stream(notes: DataFrame, text: str = "note_text", key: str = "note_id") -> DataFrame:
    """Streaming-safe projection: one row per measure and per prescription
    item of every incoming note."""
    t = F.col(text)
    m = notes.select(key, F.explode(ms.all_measures(t)).alias("m")).select(
        key, F.lit("measure").alias("kind"), "m.value", "m.unit", "m.start", "m.end")
    f = notes.select(key, F.explode(rx.frequencies(t)).alias("f")).select(
        key, F.lit("frequency").alias("kind"), "f.value", "f.unit", "f.start", "f.end")
    return m.unionByName(f)


def start(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str, trigger_seconds: int = 30):
    """Watch ``source_dir`` for parquet notes; write extracted rows to
    ``sink_dir`` (parquet, partitioned by batch and kind).  A batch that is
    replayed after a failure replaces its own folder."""
    notes = spark.readStream.schema(NOTE_STREAM_SCHEMA).parquet(source_dir)
    out = measures_stream(notes)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("kind").parquet(f"{sink_dir}/batch_id={batch_id}")

    return (out.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(processingTime=f"{trigger_seconds} seconds").start())
