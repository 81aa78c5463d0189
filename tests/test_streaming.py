import tempfile

from pyspark.sql import functions as F

from shapeloom.streaming.descriptions import clean_descriptions


def test_stream_cleaning_matches_batch(spark):
    src = tempfile.mkdtemp(prefix="sl-stream-", dir="/tmp")
    rows = [("u1", "c", "  Modern, RED chair!! ", "2024-01-01 00:00:00"),
            ("u1", "c", "later copy", "2024-01-01 00:00:05"), ("u2", "c", "!!!", "2024-01-01 00:00:01")]
    df = spark.createDataFrame(rows, "uid string, category string, description_raw string, ts string")
    df.withColumn("ts", F.to_timestamp("ts")).write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    q = (clean_descriptions(stream, event_time="ts").writeStream.format("memory")
         .queryName("clean_stream").outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = {(r.uid, r.description) for r in spark.table("clean_stream").collect()}
    assert got == {("u1", "modern red chair")}
