import tempfile

from notelab.streaming import notes_stream as ns


def test_stream_matches_batch(spark):
    d = tempfile.mkdtemp(prefix="notelab-stream-")
    notes = spark.createDataFrame([("n1", "Hb 13,7 g/dl 3 fois par jour"), ("n2", "poids 72")],
                                  "note_id string, note_text string")
    notes.write.parquet(d + "/in")
    q = (ns.measures_stream(spark.readStream.schema(ns.NOTE_STREAM_SCHEMA).parquet(d + "/in"))
         .writeStream.format("memory").queryName("notelab_stream_test").outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = sorted(tuple(r) for r in spark.sql("select * from notelab_stream_test").collect())
    want = sorted(tuple(r) for r in ns.measures_stream(notes).collect())
    assert got == want and len(got) == 3
