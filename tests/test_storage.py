import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from logsentry import session
from logsentry.functions.rules import score_logs
from logsentry.operators.order import block_rows, global_index
from logsentry.sources import files
from logsentry.sources.network_logs import from_events, network_logs
from logsentry.sources.schemas import RAW_LOG
from logsentry.streaming import scoring as streams
from tests.conftest import SF


def test_csv(spark, three_logs, tmp_path):
    path = str(tmp_path / "csv")
    files.write_csv(three_logs, path)
    back = files.read_csv(spark, path)
    assert back.schema == RAW_LOG
    assert sorted(back.collect()) == sorted(three_logs.collect())


def test_csv_header_must_match(spark, three_logs, tmp_path):
    path = str(tmp_path / "csv")
    files.write_csv(three_logs.withColumnRenamed("Port", "Prt"), path)
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, path).collect()


def test_csv_folder(spark, three_logs, tmp_path):
    path = str(tmp_path / "parts")
    for _ in range(2):
        files.write_csv(three_logs, path, mode="append")
    assert files.read_csv_folder(spark, path, n_columns=11, required=["Status"]).count() == 6
    with pytest.raises(ValueError):
        files.read_csv_folder(spark, path, n_columns=16)
    with pytest.raises(ValueError):
        files.read_csv_folder(spark, path, required=["purchased"])


def test_json(spark, tmp_path):
    df = spark.createDataFrame([(1.5, [[1, 2], [3, 4]])], "accuracy double, confusion_matrix array<array<bigint>>")
    files.write_json(df, str(tmp_path / "j"))
    assert files.read_json(spark, str(tmp_path / "j"), df.schema).collect() == df.collect()


def test_versions(spark, tmp_path):
    path = str(tmp_path / "v")
    first = files.save_version(spark.range(1), path)
    second = files.save_version(spark.range(2), path)
    assert first < second
    assert files.load_version(spark, path).count() == 2
    assert files.load_version(spark, path, first).count() == 1
    with pytest.raises(ValueError):
        files.load_version(spark, path, "1999")


def test_pin_and_broadcast_limit(spark):
    pinned = session.pin(spark.range(100), "t")
    assert pinned.count() == 100
    hinted = lambda df: "hint" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(session.broadcast_if_small(pinned)) and not hinted(session.broadcast_if_small(pinned, 99))
    assert session.scratch_path(spark, "x").startswith(session.shared_dir(spark))


def test_pin_leaves_no_shuffle_files(spark):
    """What was shuffled for a pinned table goes when it is written; the session's own setting stays as it was, also after a failure."""
    told = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    shuffled = lambda: {f for f in told().split("\n") if f.endswith(".data")}
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own, before, since = spark.conf.get(key, None), shuffled(), time.monotonic()
    rows = spark.range(20_000).repartition(6, "id").groupBy((F.col("id") % 5_000).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    pinned = session.pin(rows, "t")
    while shuffled() - before and time.monotonic() < since + 60:  # they are deleted in the background
        time.sleep(0.2)
    assert not shuffled() - before
    assert pinned.agg(F.count(F.lit(1)), F.sum("n")).first() == (5_000, 20_000) == rows.agg(F.count(F.lit(1)), F.sum("n")).first()
    with pytest.raises(Exception, match="ARITHMETIC|DIVIDE"):
        session.pin(rows.select(F.expr("raise_error('DIVIDE')")), "t")
    assert spark.conf.get(key, None) == own


def test_block_size_follows_the_table(spark):
    small = global_index(spark.range(10), ["id"])
    assert small.schema["idx"].metadata["rows"] == 10
    assert block_rows(small) == 4096
    big = spark.range(1).select(F.col("id").alias("idx", metadata={"rows": 10 ** 12}))
    assert block_rows(big) == 1 << 20


def stream_of(spark, tmp_path, *batches):
    """A stream that reads one file per micro-batch."""
    path = str(tmp_path / "in")
    for i, b in enumerate(batches):
        b.coalesce(1).write.mode("append").parquet(path)
    return streams.read_stream(spark, path, batches[0].schema, files_per_trigger=1)


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    parts = [events.filter(F.col("event_id") % 3 == i) for i in range(3)]
    got = streams.run_available(streams.score_stream(from_events(stream_of(spark, tmp_path, *parts))))
    want = score_logs(network_logs(spark, SF))
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_stream_rejects_repeats(spark, tmp_path):
    schema = "Timestamp timestamp_ntz, Source_IP string, n int"
    t = dt.datetime(2025, 1, 1)
    a = spark.createDataFrame([(t, "a", 1), (t, "b", 2)], schema)
    b = spark.createDataFrame([(t, "a", 3), (t, "c", 4)], schema)
    got = streams.run_available(streams.reject_duplicates(stream_of(spark, tmp_path, a, b), ["Timestamp", "Source_IP"]))
    assert sorted((r.Source_IP, r.n) for r in got.collect()) == [("a", 1), ("b", 2), ("c", 4)]


def test_alerts_close_with_the_watermark(spark, tmp_path):
    got = streams.run_available(streams.alert_counts(
        from_events(stream_of(spark, tmp_path, spark.read.parquet(f"{SF}/events.parquet"))))).collect()
    logs = network_logs(spark, SF)
    last = logs.agg(F.max("Timestamp")).first()[0] - dt.timedelta(minutes=10)
    hour = F.date_trunc("hour", "Timestamp").cast("timestamp_ntz")
    want = score_logs(logs).groupBy(hour.alias("h"), "risk_level").count().collect()
    assert {(r.window_start, r.risk_level): r.n for r in got} == {
        (r.h, r.risk_level): r["count"] for r in want if r.h + dt.timedelta(hours=1) <= last}


def test_dropped_tables_are_gone(spark):
    from logsentry.session import drop, pin, written

    kept, gone = pin(spark.range(3), "kept"), pin(spark.range(3), "gone")
    path = written()[-1]
    drop(spark, [path])
    assert path not in written() and kept.count() == 3 and "gone" in path
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    assert gone.schema == kept.schema
