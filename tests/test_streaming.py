from claimlake.sources import jsonlines
from claimlake.streaming import windows

SCHEMA = "event_id long, ts timestamp, event_type string, value double"


def test_stream_gives_what_the_table_gives(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "event_type", "value").limit(400)
    path = str(tmp_path / "in")
    events.coalesce(1).selectExpr("to_json(struct(*)) AS value").write.text(path)
    spark.createDataFrame([("",), ("[1, 2]",), ('{"event_id": 5, "ts"',), ("7",)], "value string").coalesce(1).write.mode("append").text(path)
    table = jsonlines.scan(spark, path, SCHEMA)
    assert table.count() == events.count()
    stream = windows.tumbling(jsonlines.tail(spark, path, SCHEMA), "ts", ["event_type"], "1 hour", "value")
    run = stream.writeStream.format("memory").queryName("hours").outputMode("complete").option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
    run.awaitTermination(100)
    want = windows.tumbling(table, "ts", ["event_type"], "1 hour", "value")
    assert sorted(map(str, spark.table("hours").collect())) == sorted(map(str, want.collect()))


def test_repeated_events_count_once(spark, tmp_path):
    path = str(tmp_path / "in")
    line = '{"event_id": %d, "ts": "2024-01-01T00:00:0%d", "event_type": "view", "value": 1.0}'
    spark.createDataFrame([(line % (i % 3, i),) for i in range(9)], "value string").coalesce(1).write.text(path)
    assert windows.once_each(jsonlines.scan(spark, path, SCHEMA), "ts", "event_id").count() == 3
    run = windows.once_each(jsonlines.tail(spark, path, SCHEMA), "ts", "event_id").writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
    run.awaitTermination(100)
    assert spark.table("once").count() == 3
