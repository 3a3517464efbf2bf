import datetime as dt

from pyspark.sql import functions as F

from layerkit.operators import checks as C
from layerkit.streaming.ingest import ingest_csv
from layerkit.streaming.quality import check_stream, repeated_keys
from layerkit.streaming.windows import append_closed_windows, tumbling_counts, tumbling_counts_stream

SCHEMA = "id int, name string"


def test_ingest_adds_only_new_files(spark, tmp_path):
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL(SCHEMA)
    drop, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('id,name\n1,\n2,""\n')
    ingest_csv(spark, drop, schema, out, state).awaitTermination()
    (tmp_path / "in" / "b.csv").write_text("id,name\n3,x\n")
    for _ in range(2):
        ingest_csv(spark, drop, schema, out, state).awaitTermination()
    got = sorted(tuple(r) for r in spark.read.schema(schema).parquet(out).collect())
    assert got == [(1, None), (2, ""), (3, "x")]


def write_events(spark, path, rows):
    spark.createDataFrame(rows, "ts timestamp_ntz, kind string").coalesce(1).write.mode("append").parquet(path)


def test_windows_close_once_and_late_events_are_dropped(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    day = [dt.datetime(2024, 1, 1, h, 30) for h in range(24)]
    write_events(spark, source, [(t, "a") for t in day[:12]])

    def run():
        stream = spark.readStream.schema("ts timestamp_ntz, kind string").parquet(source)
        counts = tumbling_counts_stream(stream, "ts", ["kind"], "1 hour", "30 minutes")
        append_closed_windows(counts, out, state).awaitTermination()
        return spark.read.schema(counts.schema).parquet(out)

    assert run().count() == 11  # 11:30 is the newest event, so 11:00-12:00 is still open
    write_events(spark, source, [(day[2], "a"), (day[14], "a")])
    got = run()
    assert got.agg(F.sum("n")).first()[0] == 12
    batch = tumbling_counts(spark.read.parquet(source).where("ts < '2024-01-01 12:00'"), "ts", ["kind"], "1 hour")
    late = batch.where(F.col("n") > 1)
    assert late.count() == 1 and got.count() == batch.count()


def test_check_metrics_per_batch_are_not_repeated(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    group = [C.missing("kind", name="kind", table="events"), C.DuplicateCheck(name="dup", table="events", keys=["ts"])]

    def run():
        stream = spark.readStream.schema("ts timestamp_ntz, kind string").parquet(source)
        check_stream(stream, group, out, state, C.strict()).awaitTermination()
        rows = spark.read.parquet(out).orderBy("batch_id", "check_pos").collect()
        return [(r.batch_id, r.check_name, r.total_records, r.issues_found, r.status) for r in rows]

    at = dt.datetime(2024, 1, 1)
    write_events(spark, source, [(at, "a"), (at, None)])
    first = run()
    assert first == [(0, "kind", 2, 1, "FAIL"), (0, "dup", 2, 1, "FAIL")]
    assert run() == first
    write_events(spark, source, [(at, "b")])
    second = first + [(1, "kind", 1, 0, "PASS"), (1, "dup", 1, 1, "FAIL")]
    assert run() == second
    write_events(spark, source, [(at + dt.timedelta(days=1), "b")])
    assert run() == second + [(2, "kind", 1, 0, "PASS"), (2, "dup", 1, 0, "PASS")]
    assert [tuple(r) for r in repeated_keys(spark, group[1], out).collect()] == [(at, 3)]


def test_a_later_batch_reads_no_more_than_an_early_one(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    check = C.DuplicateCheck(name="dup", table="t", keys=["k", "l"], count_as="n")
    batches = 12
    for i in range(batches):
        # every batch has 50 new keys, one key of all batches, and a NULL one
        rows = [(i * 50 + j, "x") for j in range(50)] + [(-1, "y"), (None, None)]
        spark.createDataFrame(rows, "k long, l string").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("k long, l string").option("maxFilesPerTrigger", 1).parquet(source)
    queries = check_stream(stream, [check], out, state)
    queries.awaitTermination()
    progress = [p for p in queries.queries[0].recentProgress if p["numInputRows"]]
    assert [p["numInputRows"] for p in progress] == [52] * batches
    assert [p["stateOperators"][0]["numRowsUpdated"] for p in progress] == [53] * batches
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] == 50 * batches + 3
    assert sorted(map(tuple, repeated_keys(spark, check, out).collect()), key=repr) == [(-1, "y", batches), (None, None, batches)]
    got = spark.read.parquet(out).orderBy("batch_id").collect()
    assert [(r.total_records, r.issues_found) for r in got] == [(52, 0)] + [(52, 2)] * (batches - 1)
