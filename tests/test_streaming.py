from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.streaming import ingest, throttle, traffic

TRACE = [(100, 1), (130, 1), (161, 2), (221, 2), (222, 3), (250, -1), (300, 1)]


def run(df, path, mode="append"):
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", str(path / "progress")).trigger(availableNow=True)
    writer.format("parquet").option("path", str(path / "out")).start().awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(str(path / "out"))


def test_step_by_hand():
    state, counts = throttle.START, []
    for at, _ in TRACE:
        state = throttle.step(state, at, at == 250)
        counts.append(state[1])
    assert counts == [n for _, n in TRACE]
    state = throttle.START
    for i in range(30):
        state = throttle.step(state, 1000 + 61 * i, False)
    assert state[1] == 10


@pytest.mark.parametrize("files", [1, 3, 7])
def test_trace_in_one_or_many_batches(spark, tmp_path, files):
    events = [("g", at, at == 250) for at, _ in TRACE] + [("g", 100, False)] * 5 + [("h", 400, False)]
    size = -(-len(TRACE) // files)
    parts = [events[i:i + size] for i in range(0, len(TRACE), size)]
    parts[0] = parts[0] + events[len(TRACE):-1]
    parts[-1] = parts[-1] + events[-1:]
    schema = "k string, ts timestamp, reset boolean"
    for i, part in enumerate(parts):
        spark.createDataFrame(part, "k string, s long, reset boolean").select(
            "k", F.timestamp_seconds("s").alias("ts"), "reset").coalesce(1).write.parquet(str(tmp_path / "in" / f"{i:03d}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    out = run(throttle.throttle(stream, "k", "ts", F.col("reset")), tmp_path)
    got = {(r["key"], r["at_second"]): r["batch_number"] for r in out.collect()}
    assert got == {("g", at): n for at, n in TRACE} | {("h", 400): 1}
    assert out.filter("advanced").count() == 5


def test_ingest_equals_the_batches(spark, tmp_path):
    for i in range(4):
        doc = {"group_number": 1, "batch_number": i, "data": [[str(i), str(j)] for j in range(3)]}
        path = tmp_path / "in" / f"{i}.json"
        path.parent.mkdir(exist_ok=True)
        path.write_text(json.dumps(doc))
    target = str(tmp_path / "out")
    for _ in range(2):  # a restart adds nothing
        ingest.ingest(spark, str(tmp_path / "in"), target, str(tmp_path / "p"), ["a", "b"], {"a": "int"}, 1).awaitTermination()
    assert rows(spark.read.parquet(target).select("a", "b", "batch_number")) == sorted(
        ((i, str(j), i) for i in range(4) for j in range(3)), key=repr)


def test_late_rows_are_dropped_and_windows_close(spark, tmp_path):
    for i, seconds in enumerate([[5, 8, 12], [7300], [7301], [6], [15000]]):  # 6 comes after the watermark passed it
        spark.createDataFrame([(s,) for s in seconds], "s long").select(F.timestamp_seconds("s").alias("ts")).coalesce(1).write.parquet(
            str(tmp_path / "in" / f"{i}"))
    stream = spark.readStream.schema("ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    out = run(traffic.request_rate(stream, "ts"), tmp_path)
    assert rows(out.select(F.unix_timestamp("window_start"), "n_requests", "rate")) == [(0, 2, 0.2), (10, 1, 0.1), (7300, 2, 0.2)]


def test_histogram_is_cumulative(spark):
    df = spark.createDataFrame([(0.005,), (0.006,), (2.0,), (99.0,), (None,)], "v double")
    wide = traffic.latency_histogram(df, "v")
    long = {r["le"]: r["n"] for r in traffic.histogram_long(wide, []).collect()}
    assert (long["0.005"], long["0.01"], long["1"], long["2.5"], long["10"], long["+Inf"]) == (1, 2, 2, 3, 3, 4)
    assert wide.first()["total"] == pytest.approx(101.011) and len(long) == 15


def test_outcomes(spark, monkeypatch):
    monkeypatch.setattr(traffic, "STATUSES_PER_PASS", 1)
    df = spark.createDataFrame([("200", 1.0), ("200", 3.0), ("500", 9.0), (None, 2.0)], "status string, d double")
    got = {r["status"]: tuple(r)[1:] for r in traffic.outcome_summary(df, "status", "d").collect()}
    assert got == {"200": (2, 2.0, 3.0, pytest.approx(2.9)), "500": (1, 9.0, 9.0, 9.0), None: (1, 2.0, 2.0, 2.0)}
