"""Codes that grow, bodies that arrive one by one, saves that are checked as they are written, sketches with bounds."""

import json

import pytest
from pyspark.sql import functions as F

from logsentry.operators import sketches, validate
from logsentry.operators.dictionary import CodeDictionary
from logsentry.plans.inputs import payload_predictions
from logsentry.sources import checked, files, folders
from logsentry.streaming import bodies, scoring
from tests.conftest import SF


def codes(dictionary):
    return {(r["column"], r["value"]): r["code"] for r in dictionary.mapping().collect()}


def test_codes_stay(spark, tmp_path):
    d = CodeDictionary(spark, str(tmp_path))
    first = spark.createDataFrame([("m", 5), ("c", 5), (None, 7)], "a string, b int")
    assert d.add(first, ["a", "b"]) == 4
    before = codes(d)
    assert before == {("a", "c"): 0, ("a", "m"): 1, ("b", "5"): 0, ("b", "7"): 1}
    second = spark.createDataFrame([("a", 5), ("m", 6), ("z", 6)], "a string, b int")
    assert sorted(map(tuple, d.missing(second, ["a", "b"]).collect())) == [("a", "a"), ("a", "z"), ("b", "6")]
    assert d.add(second, ["a", "b"]) == 3 and d.add(second, ["a", "b"]) == 0 and d.add(first.limit(0), ["a"]) == 0
    after = codes(d)
    assert before.items() <= after.items() and after[("a", "a")] == 2 and after[("a", "z")] == 3 and after[("b", "6")] == 2
    assert d.sizes() == {"a": 4, "b": 3}
    d.merge()
    assert codes(CodeDictionary(spark, str(tmp_path))) == after
    assert d.apply(second, ["a"]).select("a_encoded").orderBy("a").collect() == [(2,), (1,), (3,)]


def test_two_runs_that_add_at_once(spark, tmp_path):
    """The second one's commit comes in between: the first finds its number taken and numbers its values after the other's."""
    mine, other = CodeDictionary(spark, str(tmp_path)), CodeDictionary(spark, str(tmp_path))
    values = lambda *v: spark.createDataFrame([(x,) for x in v], "a string")
    mine.add(values("k"), ["a"])
    put, between = mine.commits.put, [lambda: other.add(values("b", "y"), ["a"])]

    def delayed(number, state):
        if between:
            between.pop()()
        return put(number, state)

    mine.commits.put = delayed
    assert mine.add(values("a", "b", "x"), ["a"]) == 2
    assert codes(mine) == {("a", v): n for n, v in enumerate(["k", "b", "y", "a", "x"])}
    assert len(folders.names(spark, f"{tmp_path}/codes")) == 3  # what was dropped is gone


def test_bodies_part_into_sinks(spark, tmp_path):
    good = {"timestamp": "t", "source_ip": "1", "destination_ip": "2", "source_port": 1, "destination_port": 22, "protocol": "tcp",
            "payload_size": 0, "user_agent": "x", "status": "failed"}
    texts = [json.dumps({"data": [good, {**good, "source_port": "no"}, 5]}), "{broken", json.dumps({"data": []}), json.dumps({"rows": []}),
             json.dumps({"data": good}), json.dumps({"data": [good]}), None]
    given = spark.createDataFrame(list(enumerate(texts)), "n long, body string")
    for part in (given.filter("n < 4"), given.filter("n >= 4")):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        bodies.score_bodies(scoring.read_stream(spark, f"{tmp_path}/in", given.schema, 1), f"{tmp_path}/out", f"{tmp_path}/state")
    out = f"{tmp_path}/out"
    assert sorted((r["n"], r["index"]) for r in bodies.scores(spark, out).collect()) == [(0, 0), (5, 0)]
    assert sorted((r["n"], r["index"], r["error"]) for r in bodies.errors(spark, out).collect()) == sorted(
        (r["n"], r["index"], r["error"]) for r in validate.score_batch(given).filter("error IS NOT NULL").collect())
    want = {r["n"]: (r["error"], r["total_processed"]) for r in validate.body_errors(given).collect()}
    assert {r["n"]: (r["error"], r["total_processed"]) for r in bodies.totals(spark, out).collect()} == want and want[2] == (None, 0)
    # A batch without its commit is seen by no sink; one that comes again replaces what it wrote.
    folders.remove(spark, f"{out}/commits/{1:012d}.json")
    assert {r["n"] for r in bodies.totals(spark, out).collect()} == {0, 1, 2, 3}
    assert {r["n"] for r in bodies.scores(spark, out).collect()} == {0}
    folders.remove(spark, f"{tmp_path}/state/commits/1")
    bodies.score_bodies(scoring.read_stream(spark, f"{tmp_path}/in", given.schema, 1), out, f"{tmp_path}/state")
    assert {r["n"]: (r["error"], r["total_processed"]) for r in bodies.totals(spark, out).collect()} == want


def test_a_checked_save_is_one_job(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 5 == 0).cast("int").alias("y"), F.when(F.col("id") % 10 > 0, F.col("id")).alias("v"))
    sc = spark.sparkContext
    sc.setJobGroup("checked-save", "")
    try:
        version = checked.save_checked(df, str(tmp_path), checked.Gate(1000, 2, ["y"], {"v": 0.1}, "y", least_balance=0.25), ["v"])
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("checked-save")) == 1
    told = checked.saved_metrics(spark, str(tmp_path))
    want = df.agg(F.avg("v"), F.stddev_pop("v")).first()
    assert (told["rows"], told["nulls_v"], told["nulls_y"], told["class_0"], told["class_1"]) == (1000, 100, 0, 800, 200)
    assert abs(told["mean_v"] - want[0]) < 1e-9 and abs(told["std_v"] - want[1]) < 1e-9
    assert files.load_version(spark, str(tmp_path)).count() == 1000
    for gate in (checked.Gate(1001), checked.Gate(most_nulls={"v": 0.05}), checked.Gate(label="y", least_balance=0.3), checked.Gate(label="y", classes=(0, 2)),
                 checked.Gate(columns=3), checked.Gate(required=["w"])):
        with pytest.raises(ValueError):
            checked.save_checked(df, str(tmp_path), gate)
    assert files.versions(spark, str(tmp_path)) == [version] == [n.removeprefix("version=") for n in folders.names(spark, str(tmp_path)) if n.startswith("version=")]


def exact(pred):
    rows = [(r["y_true"], r["y_prob"]) for r in pred.collect()]
    by = {c: sorted(p for y, p in rows if y == c) for c in (0, 1)}
    at = {}
    for p in by[0]:
        at[p] = at.get(p, 0) + 1
    below, seen = {}, 0
    for p in sorted({*by[0], *by[1]}):
        below[p] = seen
        seen += at.get(p, 0)
    auc = sum(below[p] + at.get(p, 0) / 2 for p in by[1]) / (len(by[0]) * len(by[1]))
    return auc, {c: (v[(len(v) - 1) // 2], v[len(v) // 2]) for c, v in by.items()}


@pytest.mark.parametrize("k", [64, sketches.K])
def test_bounds_hold(spark, k):
    """Whatever the days and the partitioning; smooth scores, and scores with many ties."""
    smooth = payload_predictions(spark, SF).withColumn("day", F.col("idx") % 7)
    for pred in (smooth, smooth.withColumn("y_prob", F.round("y_prob", 1))):
        auc, medians = exact(pred)
        for parts in (1, 5):
            r = sketches.sketched_summary(sketches.daily_sketches(pred.repartition(parts), "day", k), k).first()
            assert r["auc_low"] <= auc <= r["auc_high"] and r["auc_low"] <= r["auc"] <= r["auc_high"]
            assert r["auc_high"] - r["auc_low"] <= 6 * sketches.rank_error(k) + 0.2 * (pred is not smooth)
            for c in (0, 1):
                assert r[f"median_{c}_low"] <= medians[c][0] and medians[c][1] <= r[f"median_{c}_high"]
    one = sketches.sketched_summary(sketches.daily_sketches(smooth.filter("y_true = 0"), "day", k), k).first()
    assert one["n_1"] == 0 and one["auc"] is None and one["median_1_low"] is None and one["median_0"] is not None
