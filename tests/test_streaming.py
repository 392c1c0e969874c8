"""A stream over landed files gives what the batch gives."""

import json
import uuid

from pyspark.sql import functions as F

from delayloom.operators.cleaning import add_time_features
from delayloom.sources import readers
from delayloom.streaming import feeds


def land(folder, name, stamp, *entities):
    folder.mkdir(exist_ok=True)
    body = [{"id": i, "trip_update": {"timestamp": t, "delay": d, "trip": {"route_id": r, "trip_id": i}}} for i, t, d, r in entities]
    (folder / name).write_text(json.dumps({"collection_time_utc": stamp, "response": {"entity": body}}))


def run(stream, tmp_path):
    out = str(tmp_path / uuid.uuid4().hex)
    query = (stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", out + "-state")
             .trigger(availableNow=True).start(out))
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def test_append_by_day_equals_batch_and_resumes(spark, tmp_path):
    src = tmp_path / "in"
    land(src, "a.json", "2026-05-11T23:50:00Z", ("1", 1, 60.0, "r"), ("2", 1, 0.0, "r"))
    path, state = str(tmp_path / "out"), str(tmp_path / "state")
    for name, stamp in (("b.json", "2026-05-12T00:00:00Z"), ("c.json", "2026-05-12T00:10:00Z")):
        land(src, name, stamp, ("1", 1, 60.0, "r"))
        feeds.append_by_day(feeds.stream_snapshots(spark, str(src)), path, state).awaitTermination()
    batch = readers.read_snapshots(spark, str(src))
    stored = spark.read.parquet(path)
    assert stored.count() == batch.count() == 4
    assert {str(r[0]) for r in stored.select("collection_date").distinct().collect()} == {"2026-05-11", "2026-05-12"}
    assert stored.select(batch.columns).exceptAll(batch).count() == 0


def test_deduplication_is_opt_in(spark, tmp_path):
    src = tmp_path / "in"
    land(src, "a.json", "2026-05-11T08:00:00Z", ("1", 7, 60.0, "r"), ("2", 7, 60.0, "r"))
    land(src, "b.json", "2026-05-11T08:10:00Z", ("1", 7, 60.0, "r"), ("2", 8, 60.0, "r"))
    stream = feeds.stream_snapshots(spark, str(src))
    assert run(stream, tmp_path).count() == 4
    assert run(feeds.deduplicate(stream), tmp_path).count() == 3


def test_hourly_delay_emits_closed_hours(spark, tmp_path):
    src = tmp_path / "in"
    land(src, "a.json", "2026-05-11T08:00:00Z", ("1", 1, 60.0, "r"), ("2", 1, 120.0, "r"), ("3", 1, 0.0, "q"))
    land(src, "b.json", "2026-05-11T11:30:00Z", ("1", 2, 60.0, "r"))
    out = {(r.route_id, r.records, r.avg_delay_minutes, r.max_delay_seconds) for r in
           run(feeds.hourly_delay(feeds.stream_snapshots(spark, str(src))), tmp_path).collect()}
    assert out == {("r", 2, 1.5, 120), ("q", 1, 0.0, 0)}


def test_labels_join_the_static_weather(spark, tmp_path):
    src = tmp_path / "in"
    land(src, "a.json", "2026-05-11T08:20:00Z", ("1", 1, 1200.0, "r"))
    weather = spark.createDataFrame([("2026-05-11 08:00:00", 1.0, 2.0, 3.0, 4.0, 5.0)], "t string, temperature_2m double, precipitation double, rain double, relative_humidity_2m double, wind_speed_10m double"
                                    ).withColumn("weather_hour", F.col("t").cast("timestamp"))
    row = run(feeds.label_stream(feeds.stream_snapshots(spark, str(src)), weather), tmp_path).first()
    assert (row.delay_risk, row.recommended_action, row.rain, row.trip_hour) == ("High", "Adjust service headway", 3.0, 8)
    batch = add_time_features(readers.read_snapshots(spark, str(src)))
    assert batch.first().trip_hour == row.trip_hour


def test_micro_batches_reach_the_sink(spark, tmp_path):
    src, seen = tmp_path / "in", []
    land(src, "a.json", "2026-05-11T08:20:00Z", ("1", 1, 1200.0, "r"))
    feeds.write_stream(feeds.stream_snapshots(spark, str(src)), str(tmp_path / "s"), lambda df, n: seen.append(df.count())).awaitTermination()
    assert sum(seen) == 1


def hourly_rows(df):
    return {(str(r.hour), r.route_id, r.records, r.avg_delay_minutes, r.max_delay_seconds) for r in df.collect()}


def test_hours_are_upserted_and_state_is_dropped(spark, tmp_path):
    src, table, state = tmp_path / "in", str(tmp_path / "hours"), str(tmp_path / "state")
    sizes = []
    for hour in range(8):
        entities = [(str(k), 1, 60.0 * k, None if k == 3 else f"r{k}") for k in range(4)]
        land(src, f"{hour}a.json", f"2026-05-11T{hour:02}:10:00Z", *entities)
        query = feeds.keep_hourly_delay(feeds.stream_snapshots(spark, str(src)), table, state)
        query.awaitTermination()
        land(src, f"{hour}b.json", f"2026-05-11T{hour:02}:40:00Z", ("9", 1, 600.0, "r1"))  # changes one row of the hour
        query = feeds.keep_hourly_delay(feeds.stream_snapshots(spark, str(src)), table, state)
        query.awaitTermination()
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        batch = readers.read_snapshots(spark, str(src))
        rows = feeds.hourly_delay(batch)
        assert hourly_rows(feeds.read_hours(spark, table, rows.schema)) == hourly_rows(rows)
    assert len(hourly_rows(rows)) == 32 and max(sizes) <= 12  # hours behind the watermark are in the table only


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    table = str(tmp_path / "hours")
    ddl = "hour timestamp, route_id string, records long, avg_delay_minutes double, max_delay_seconds double"
    row = lambda hour, route, records: spark.createDataFrame([(f"2026-05-11 {hour}:00:00", route, records)], "t string, route_id string, records long").select(
        F.col("t").cast("timestamp").alias("hour"), "route_id", "records", F.lit(1.0).alias("avg_delay_minutes"), F.lit(2.0).alias("max_delay_seconds"))
    schema = spark.createDataFrame([], ddl).schema
    sink = feeds.upsert_hours(spark, table, schema)
    sink(row("08", "a", 1).union(row("08", None, 1)).union(row("09", "a", 5)), 0)
    for _ in range(2):  # the second time as after a failure
        sink(row("08", "a", 2).union(row("08", None, 3)), 1)
    found = {(r.hour.hour, r.route_id, r.records) for r in feeds.read_hours(spark, table, schema).collect()}
    assert found == {(8, "a", 2), (8, None, 3), (9, "a", 5)} and feeds.read_hours(spark, table, schema).count() == 3
