"""Tables that last: the keyed table, the log that grows, streams into them, versions and run records."""

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from logsentry.operators import features, records
from logsentry.operators.keyed_table import Conflict, KeyedTable
from logsentry.operators.order import global_index
from logsentry.operators.segments import SegmentedLog
from logsentry.sources import files, folders
from logsentry.streaming import arrivals, ordered, scoring
from tests.conftest import SF


@pytest.mark.parametrize("name", ["store_sequence", "ordered_increments", "codes_of_increments", "checked_write"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("events", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    value = lambda v: repr(v + 0.0) if isinstance(v, float) else repr(v)
    rel = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    want = sorted(tuple(value(r[names.index(c)]) for c in cols) for r in rel.fetchall())
    assert sorted(tuple(value(r[c]) for c in cols) for r in df.collect()) == want


# ---- the keyed table

SCHEMA = "k long, part string, arrival long, v string"


def store(spark, path, splits=4, share=0.5):
    return KeyedTable(spark, str(path), spark.createDataFrame([], SCHEMA).schema, ["k", "part"], splits, share)


def rows_of(table):
    return sorted(map(tuple, table.read().collect()), key=repr)


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path):
    table = store(spark, tmp_path)
    batch = spark.createDataFrame([(1, "a", 10, "x"), (1, "a", 9, "first"), (2, None, 11, "y")], SCHEMA)
    rejected = table.insert(batch, "arrival", "stream", 0)
    assert [r["arrival"] for r in rejected.collect()] == [10]
    before, version = rows_of(table), table.version()
    other = spark.createDataFrame([(3, "c", 1, "z")], SCHEMA)
    assert table.insert(other, "arrival", "stream", 0).count() == 0  # the number says that it went in
    assert rows_of(table) == before and table.version() == version
    table.insert(other, "arrival", "stream", 1)
    assert len(rows_of(table)) == 3 and table.last_batch("stream") == 1
    again = KeyedTable(spark, str(tmp_path))  # opened anew, without a schema
    assert rows_of(again) == rows_of(table) and again.key == ["k", "part"] and again.splits == 4
    with pytest.raises(ValueError):
        KeyedTable(spark, str(tmp_path), key=["k"])
    with pytest.raises(ValueError):
        table.insert(other, "arrival", "stream")


def test_changes_in_a_row(spark, tmp_path):
    """Random inserts, patches and deletes against a dictionary; missing parts of a key are values."""
    rng, table, plain = random.Random(1), store(spark, tmp_path), {}
    for step in range(3):
        batch = [(rng.randrange(12), rng.choice("ab") if rng.random() < 0.8 else None, 100 * step + i, f"v{step}") for i in range(10)]
        rejected = table.insert(spark.createDataFrame(batch, SCHEMA), "arrival")
        want = []
        for r in sorted(batch, key=lambda r: r[2]):
            if (r[0], r[1]) in plain:
                want.append(r[2])
            else:
                plain[r[:2]] = r
        assert sorted(r["arrival"] for r in rejected.collect()) == want
        keys = [(rng.randrange(14), rng.choice("ab")) for _ in range(3)]
        patches = [(*k, i, [["v"], []][i % 2], None if step == 2 else f"p{step}") for i, k in enumerate(keys)]
        missing = table.update(spark.createDataFrame(patches, "k long, part string, seq long, supplied array<string>, v string"), "seq")
        assert {tuple(r) for r in missing.collect()} == {k for k in keys if k not in plain}
        for *k, _, given, v in patches:
            if tuple(k) in plain and given:
                plain[tuple(k)] = (*plain[tuple(k)][:3], v)
        gone = [(rng.randrange(14), rng.choice("ab")) for _ in range(2)]
        missing = table.delete(spark.createDataFrame(gone + gone, "k long, part string"))
        assert {tuple(r) for r in missing.collect()} == {k for k in gone if k not in plain}
        for k in gone:
            plain.pop(k, None)
        assert rows_of(table) == sorted(plain.values(), key=repr)
    table.fold(0.0)
    table.clean()
    assert rows_of(table) == sorted(plain.values(), key=repr)


def test_only_touched_parts_are_read_and_written(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), spark.range(0).toDF("k").withColumn("v", F.lit("")).schema, ["k"], splits=16, share=10.0)
    table.insert(spark.range(2000).toDF("k").withColumn("v", F.lit("a")), "k")
    state = table._state()
    assert len(state["folders"]) == 1 and len(state["folders"][0]["parts"]) == 16
    some = spark.createDataFrame([(7,)], "k long")
    found, parts = table._find(state, some)
    assert len(parts) == 1 and found.count() == 1 and len(found.inputFiles()) <= 1
    absent = spark.range(10**9, 10**9 + 100).toDF("k")
    assert len(table._parts_with(state, absent)) <= 2  # a key in a thousand by chance
    table.delete(some)
    assert sorted(len(f["parts"]) for f in table._state()["folders"]) == [1, 16]
    assert table.fold(0.0) and sorted(len(f["parts"]) for f in table._state()["folders"]) == [1, 15]
    assert table.read().count() == 1999


def test_fields_are_added_and_a_second_writer_is_told(spark, tmp_path, monkeypatch):
    table = store(spark, tmp_path)
    table.insert(spark.createDataFrame([(1, "a", 1, "x"), (2, "a", 2, "y")], SCHEMA), "arrival")
    table.update(spark.createDataFrame([(1, "a", 1, ["note"], 5)], "k long, part string, seq long, supplied array<string>, note int"), "seq")
    assert rows_of(table) == [(1, "a", 1, "x", 5), (2, "a", 2, "y", None)]
    behind = store(spark, tmp_path)
    stale = behind._state()
    table.delete(spark.createDataFrame([(2, "a")], "k long, part string"))
    monkeypatch.setattr(behind, "_state", lambda: stale)
    with pytest.raises(Conflict):
        behind.delete(spark.createDataFrame([(1, "a")], "k long, part string"))
    assert rows_of(table) == [(1, "a", 1, "x", 5)]


def test_a_key_comes_again_after_any_time(spark, tmp_path):
    """Three files a year apart each, a restart between them, and a batch repeated by hand."""
    schema = "at timestamp_ntz, key string, id long"
    table = KeyedTable(spark, f"{tmp_path}/t", spark.createDataFrame([], schema).schema, ["key"], splits=4)
    for year in range(3):
        rows = [(dt.datetime(2020 + year, 1, 1), k, 10 * year + i) for i, k in enumerate(["a", "a", f"only {year}"])]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = scoring.read_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema, 1)
        arrivals.reject_known(stream, table, "in", f"{tmp_path}/state", "id", f"{tmp_path}/rejects")
    assert sorted(r["id"] for r in table.read().collect()) == [0, 2, 12, 22]
    assert sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/rejects").collect()) == [1, 10, 11, 20, 21]
    assert table.last_batch("in") == 2


# ---- the log that grows


def test_increments_read_what_they_touch(spark, tmp_path):
    df = spark.range(4000).select(F.floor(F.col("id") / 9).alias("ts"), F.col("id").alias("tie"),
                                  F.when(F.col("id") % 11 != 0, F.col("id") * 37 % 1000).alias("Payload_Size"))
    log = SegmentedLog(spark, str(tmp_path), ["ts", "tie"], 500, "Payload_Size")
    parts = ["tie < 2400 AND tie % 50 <> 7", "tie >= 2400 AND tie % 50 <> 7", "tie % 50 = 7 AND tie BETWEEN 1200 AND 1300", "tie < 0", "tie % 50 = 7 AND NOT tie BETWEEN 1200 AND 1300"]
    for k, part in enumerate(parts):
        before = {s[0] for s in log.segments()}
        did = log.add(df.filter(part))
        kept = before & {s[0] for s in log.segments()}
        if k == 1:  # behind the end: the last segments are read for what they hold before it
            assert len(did["read"]) <= 2 and len(before - kept) <= 1
        if k == 2:  # late rows: their segment, the one behind, and the end of the one before
            assert 0 < len(did["read"]) <= 6 < len(before) and len(kept) >= len(before) - 4
        if k == 3:
            assert did == {"read": [], "written": []} and kept == before
    columns = ["tie", "idx", "payload_rolling_mean", "payload_rolling_std", "payload_lag_1", "payload_lag_5"]
    rows = lambda t: sorted(tuple(x if x is None else round(x, 6) for x in r) for r in t.select(*columns).collect())
    again = SegmentedLog(spark, str(tmp_path), ["ts", "tie"], 500, "Payload_Size")
    assert rows(again.read()) == rows(features.create_ordered_features(global_index(df, ["ts", "tie"]), since=None))
    assert log.clean() and again.read().count() == 4000


def test_ties_and_missing_times(spark, tmp_path):
    rows = [(None if i % 7 == 0 else dt.datetime(2024, 1, 1 + i % 3), i) for i in range(90)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, tie long")
    log = SegmentedLog(spark, str(tmp_path), ["ts", "tie"], 8)
    for k in range(3):
        log.add(df.filter(F.col("tie") % 3 == k))
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [r["tie"] for r in log.read().orderBy("idx").collect()] == [r[1] for r in want]
    assert [r["idx"] for r in log.read().orderBy("idx").collect()] == list(range(90))
    with pytest.raises(ValueError):
        SegmentedLog(spark, f"{tmp_path}/none", ["ts"]).read()


# ---- time since last over a stream


def test_late_rows_are_counted(spark, tmp_path):
    schema = "log_id long, Timestamp timestamp_ntz, Request_Type string"
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    batches = [[(1, at(0), "a"), (2, at(50), "a"), (3, at(20), None), (4, at(30), "b")], [(5, at(200), "a"), (6, at(45), "a"), (7, at(46), "b")],
               [(8, at(1), "a"), (9, at(230), "a"), (10, at(225), "b")]]
    late = 0
    for k, batch in enumerate(batches):
        df = spark.createDataFrame(batch, schema)
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        if k == 2:
            ordered.heartbeat(df, "Timestamp", "2024-02-01 00:00:00").write.mode("append").parquet(f"{tmp_path}/in")
        late += ordered.time_since_stream(scoring.read_stream(spark, f"{tmp_path}/in", df.schema, 1), "Request_Type", "Timestamp", "log_id",
                                          f"{tmp_path}/out", f"{tmp_path}/state", "10 minutes", 600)
    got = {r["tie"]: r["time_since_last"] for r in ordered.time_since_rows(spark, f"{tmp_path}/out").collect()}
    minute = 60.0
    assert late == 1  # row 8, an hour and more behind
    assert got == {1: 0.0, 6: 45 * minute, 2: 5 * minute, 5: 150 * minute, 9: 30 * minute, 3: 0.0, 4: 0.0, 7: 16 * minute, 10: 179 * minute}


# ---- versions and run records


def test_a_save_that_died_is_never_read(spark, tmp_path):
    path = str(tmp_path)
    first = files.save_version(spark.range(1), path)
    spark.range(5).write.parquet(f"{path}/version=9999")  # its rows, but no pointer
    assert files.versions(spark, path) == [first] and files.load_version(spark, path).count() == 1
    with pytest.raises(ValueError):
        files.load_version(spark, path, "9999")
    second = files.save_version(spark.range(2), path)
    third = files.save_version(spark.range(3), path, keep=2)
    assert files.versions(spark, path) == [second, third] and files.load_version(spark, path).count() == 3
    assert f"version={first}" not in folders.names(spark, path)
    with pytest.raises(ValueError):
        files.save_version(spark.range(1), path, third)


def test_a_run_written_again_replaces_its_lines(spark, tmp_path):
    path = f"{tmp_path}/log"
    line = lambda run, stage, value: spark.createDataFrame([(run, stage, "accuracy", value)], "run_id string, stage string, name string, value double")
    for run, stage, value in (("a", "test", 0.1), ("b", "test", 0.5), ("a", "test", 0.9), ("a", "train", 0.3)):
        records.append_log(line(run, stage, value), path)
    told = spark.read.parquet(path)
    assert sorted((r.run_id, r.stage, r.value) for r in told.collect()) == [("a", "test", 0.9), ("a", "train", 0.3), ("b", "test", 0.5)]
    assert {r.run_id: r.accuracy for r in records.compare_runs(told).collect()} == {"a": 0.9, "b": 0.5}
