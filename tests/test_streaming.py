"""Streams over files: each file once, late repeats dropped, windows closed by the watermark."""

from __future__ import annotations

from datetime import datetime, timedelta

from quern.streaming import ingest


def rows(spark, first, n):
    start = datetime(2025, 1, 1)
    return spark.createDataFrame([(k, f"a\t{k}", start + timedelta(minutes=k)) for k in range(first, first + n)], "id bigint, text string, at timestamp")


def test_files_are_taken_once(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "check"))
    rows(spark, 0, 10).write.parquet(source)

    def run():
        stream = ingest.ingest(ingest.read_new_files(spark, source, rows(spark, 0, 1).schema), "at", ["id"])
        ingest.append_available(stream, out, checkpoint).awaitTermination()
        return sorted((r.id, r.text) for r in spark.read.parquet(out).collect())

    assert run() == [(k, f"a {k}") for k in range(10)]
    assert len(run()) == 10
    rows(spark, 5, 10).write.mode("append").parquet(source)
    assert [k for k, _ in run()] == list(range(15))


def test_windows(spark, tmp_path):
    start = datetime(2025, 1, 1)
    events = spark.createDataFrame([(k, start + timedelta(hours=k), k % 3, "ab"[k % 2], 1.5) for k in range(72)], "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double")
    events.write.parquet(str(tmp_path / "e"))
    stream = ingest.windowed_counts(ingest.read_new_files(spark, str(tmp_path / "e"), events.schema))
    query = stream.writeStream.outputMode("append").format("memory").queryName("windows").trigger(availableNow=True).start()
    query.awaitTermination()
    closed = spark.sql("SELECT * FROM windows").collect()
    assert len(closed) == 4 and {(r.n, r.value) for r in closed} == {(12, 18.0)}
    assert ingest.windowed_counts(events).count() == 6
    assert ingest.sessions(events).count() == 72
