"""Runs of one document in a stream: too close ones are marked, over restarts too."""

import datetime

from docintake.streaming.suppression import mark_recent

START = datetime.datetime(2024, 5, 1, 12, 0, 0)


def write(spark, folder, runs):
    rows = [(d, n, START + datetime.timedelta(seconds=s)) for d, n, s in runs]
    spark.createDataFrame(rows, "doc_id string, seq long, ts timestamp").coalesce(1).write.mode(
        "append").parquet(f"{folder}/in")


def run(spark, folder):
    stream = spark.readStream.schema("doc_id string, seq long, ts timestamp").parquet(f"{folder}/in")
    query = (
        mark_recent(stream, 10).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True)
        .start(f"{folder}/out")
    )
    query.awaitTermination()
    return {r.seq: r.too_recent for r in spark.read.parquet(f"{folder}/out").collect()}


def test_marks_and_restarts(spark, tmp_path):
    folder = f"file:{tmp_path}"
    write(spark, folder, [("a", 1, 0), ("a", 2, 9.9), ("b", 3, 5), ("c", 4, 0), ("c", 5, 10), (None, 6, 1)])
    assert run(spark, folder) == {1: False, 2: True, 3: False, 4: False, 5: False, 6: False}
    # the query starts again from its checkpoint and knows the last starts
    write(spark, folder, [("a", 7, 9.99), ("a", 8, 10), ("a", 9, 19.9), ("b", 10, 16), (None, 11, 2),
                          ("c", 12, 5), ("c", 13, -30), ("d", 14, 0), ("d", 15, 0)])
    assert run(spark, folder) == {
        1: False, 2: True, 3: False, 4: False, 5: False, 6: False, 7: True, 8: False, 9: True,
        10: False, 11: True, 12: True, 13: False, 14: False, 15: True,
    }
