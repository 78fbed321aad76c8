from __future__ import annotations

import threading
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from plumbline.operators import model
from plumbline.sources import files, messages
from plumbline.streaming import runs

FIELDS = {"id": ("bigint", 0), "x": ("double", 0.0)}


@pytest.fixture(scope="module")
def fitted(spark):
    rows = spark.range(60).selectExpr("id", "CAST(id % 7 AS DOUBLE) AS x", "CAST(id % 7 > 3 AS DOUBLE) AS y")
    return model.fit_directly(rows, model.decision_tree(maxDepth=2), ["x"], "y", "id")[0]


def send(spark, inbox, ids):
    """Messages with the given ids: every fifth is no JSON, every seventh has no number."""
    rows = spark.createDataFrame([(i,) for i in ids], "id long").withColumn("x", F.when(F.col("id") % 7 != 0, (F.col("id") % 7).cast("double")))
    sent = messages.encode_envelope(rows, "id")
    broken = F.when(F.col("key").cast("int") % 5 == 0, F.concat(F.lit("bad "), "key")).otherwise(F.col("value"))
    messages.write_messages(sent.withColumn("value", broken).coalesce(1), inbox)


class Paths:
    def __init__(self, tmp_path):
        self.inbox, self.scored, self.rejected, self.commits, self.position = (str(tmp_path / n) for n in ("in", "ok", "no", "commits", "cp"))

    def run(self, spark, fitted, **more):
        source = messages.file_stream(spark, self.inbox, "key string, value string", max_files=1)
        return runs.run_sinks(source, fitted, self.scored, self.rejected, self.commits, self.position, "id", ["no", "yes"], FIELDS, ["x"], **more)

    def results(self, spark):
        ok = [int(r.customer_id) for r in runs.committed(spark, self.scored, self.commits).collect()]
        bad = [(r.value, r.status) for r in runs.committed(spark, self.rejected, self.commits).collect()]
        return sorted(ok), sorted(s for _, s in bad), [tuple(r) for r in runs.batch_records(spark, self.commits).select("total", "scored", "rejected").collect()]


def expected(ids):
    ok = [i for i in ids if i % 5 and i % 7]
    return ok, sorted("malformed" if i % 5 == 0 else "invalid" for i in ids if i not in ok)


def test_a_crash_between_the_sinks_loses_and_repeats_nothing(spark, fitted, tmp_path, monkeypatch):
    paths = Paths(tmp_path)
    send(spark, paths.inbox, range(1, 40))
    write, calls = runs.sink, []

    def failing(rows, path, batch_id):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("lost between the sinks")
        return write(rows, path, batch_id)

    monkeypatch.setattr(runs, "sink", failing)
    with pytest.raises(StreamingQueryException):
        paths.run(spark, fitted)
    assert calls == [paths.scored, paths.rejected]
    assert spark.read.parquet(paths.scored).count() > 0
    paths.run(spark, fitted)
    send(spark, paths.inbox, range(40, 50))
    paths.run(spark, fitted)
    ok, bad, records = paths.results(spark)
    assert (ok, bad) == expected(range(1, 50))
    assert sum(r[0] for r in records) == 49 and sum(r[1] for r in records) == len(ok) and len(records) == 2


def test_batches_without_a_record_are_not_read(spark, fitted, tmp_path):
    paths = Paths(tmp_path)
    send(spark, paths.inbox, [1, 2, 5])
    paths.run(spark, fitted)
    spark.createDataFrame([("9",)], "customer_id string").write.parquet(f"{paths.scored}/batch_id=77")
    assert [r.customer_id for r in runs.committed(spark, paths.scored, paths.commits).orderBy("customer_id").collect()] == ["1", "2"]


def test_runs_end_at_their_bounds_and_go_on_from_there(spark, fitted, tmp_path):
    paths = Paths(tmp_path)
    for k in range(4):
        send(spark, paths.inbox, range(10 * k + 1, 10 * k + 11))
    assert paths.run(spark, fitted, bounds=runs.Bounds(messages=15)).seen == 20
    assert paths.run(spark, fitted, bounds=runs.Bounds(seconds=0)).seen == 0
    began = time.monotonic()
    assert paths.run(spark, fitted, bounds=runs.Bounds(seconds=6), continuous=True).seen == 20
    assert 6 <= time.monotonic() - began < 30
    assert paths.results(spark)[:2] == expected(range(1, 41))
    with pytest.raises(ValueError):
        paths.run(spark, fitted, continuous=True)


def test_start_positions(spark, tmp_path):
    inbox, schema = str(tmp_path / "in"), "id long"
    spark.range(5).coalesce(1).write.parquet(inbox)
    time.sleep(0.05)
    later = spark.sql("SELECT CAST(current_timestamp() AS STRING)").first()[0]
    time.sleep(0.05)
    latest = str(tmp_path / "latest")
    runs.position_of(spark, inbox, "latest", latest, "*.parquet")
    spark.range(5, 9).coalesce(1).write.mode("append").parquet(inbox)

    def read(start, place):
        out = str(tmp_path / f"out-{len(list(tmp_path.iterdir()))}")
        stream = runs.file_stream_from(spark, inbox, schema, place, start, pathGlobFilter="*.parquet")
        runs.drain(stream, out, out + "-cp")
        return sorted(r.id for r in spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(out).collect())

    assert read("earliest", str(tmp_path / "first")) == list(range(9))
    assert read("latest", latest) == [5, 6, 7, 8]
    assert read(later, str(tmp_path / "at")) == [5, 6, 7, 8]
    # a position that is known is kept, whatever the start says later
    assert read("earliest", latest) == [5, 6, 7, 8]


def test_progress_of_every_batch_becomes_a_table(spark, tmp_path):
    inbox, table = str(tmp_path / "in"), str(tmp_path / "progress")
    listener = runs.ProgressTable(spark, table)
    spark.streams.addListener(listener)
    try:
        for k in range(2):
            spark.range(10 * k, 10 * k + 10).coalesce(1).write.mode("append").parquet(inbox)
            runs.drain(messages.file_stream(spark, inbox, "id long"), str(tmp_path / "out"), str(tmp_path / "cp"))
        for _ in range(100):
            try:
                rows = spark.read.parquet(table).collect()
            except Exception:
                rows = []
            if len(rows) == 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert sorted((r.batch_id, r.input_rows) for r in rows) == [(0, 10), (1, 10)]
    assert len({r.run_id for r in rows}) == 2 and all(r.seconds > 0 for r in rows)


def test_of_two_builds_at_once_one_stays_and_both_read_it(spark, tmp_path):
    path, start, found = str(tmp_path / "table"), threading.Barrier(2), []

    def build(n):
        def frame():
            start.wait(30)
            return spark.range(n)
        found.append(files.materialize(spark, path, frame).count())

    threads = [threading.Thread(target=build, args=(n,)) for n in (10, 20)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert found[0] == found[1] and found[0] in (10, 20)
    assert [p.name for p in tmp_path.iterdir()] == ["table"]


def test_an_interrupted_build_is_replaced(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(3).write.parquet(path)
    (tmp_path / "table" / "_SUCCESS").unlink()
    assert files.materialize(spark, path, lambda: spark.range(7)).count() == 7
    assert files.materialize(spark, path, lambda: spark.range(9)).count() == 7


def test_saved_in_the_wanted_number_of_files(spark, tmp_path):
    assert files.save_sized(spark.range(1000), str(tmp_path / "t"), per_partition=300) == 3
    assert len(list((tmp_path / "t").glob("part-*"))) == 3
