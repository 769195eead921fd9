import json

import pytest
from pyspark.sql import functions as F

from logsentry.operators import quality, store, validate
from logsentry.sources.requests import read_bodies

VALID = {
    "timestamp": "2025-01-01T10:00:00", "source_ip": "192.168.1.1", "destination_ip": "10.0.0.1", "source_port": 12345,
    "destination_port": 80, "protocol": "TCP", "payload_size": 1024, "user_agent": "Mozilla/5.0", "status": "success",
}


def bodies(spark, *items):
    return spark.createDataFrame([(i, b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(items)],
                                 "id int, body string")


def one(spark, *items):
    return validate.predict_one(bodies(spark, *items)).orderBy("id").collect()


def batch(spark, *items):
    return validate.score_batch(bodies(spark, {"data": list(items)})).orderBy("index").collect()


def test_worked_scores(spark):
    got = one(spark,
              {**VALID, "destination_port": 22, "payload_size": 0, "user_agent": "bot-scanner", "status": "failed"},
              {**VALID},
              {**VALID, "destination_port": 445, "payload_size": 15000, "user_agent": "exploit-scanner", "status": "failed"})
    assert [(r.status_code, r.prediction.confidence, r.prediction.risk_level, r.prediction.is_intrusion) for r in got] == [
        (200, 1.0, "high", True), (200, 0.0, "low", False), (200, 1.0, "high", True)]
    assert got[0].model_version == "heuristic_v1.0"


def test_boundaries_of_risk(spark):
    got = one(spark, {**VALID, "destination_port": 22}, {**VALID, "destination_port": 22, "user_agent": "GoogleBOT"},
              {**VALID, "payload_size": 10000}, {**VALID, "payload_size": 10001})
    assert [(r.prediction.confidence, r.prediction.risk_level) for r in got] == [
        (0.3, "medium"), (0.7, "high"), (0.0, "low"), (0.2, "low")]


@pytest.mark.parametrize("change,error", [
    ({"source_port": "invalid_port"}, validate.INVALID_VALUES),
    ({"source_port": -1}, validate.INVALID_VALUES),
    ({"destination_port": 70000}, validate.INVALID_VALUES),
    ({"destination_port": 80.0}, validate.INVALID_VALUES),
    ({"destination_port": None}, validate.INVALID_VALUES),
    ({"destination_port": 12345678901234567890}, validate.INVALID_VALUES),
    ({"payload_size": -100}, validate.INVALID_VALUES),
    ({"payload_size": "12"}, validate.INVALID_VALUES),
    ({"protocol": 6}, validate.INVALID_VALUES),
    ({"user_agent": None}, "'NoneType' object has no attribute 'lower'"),
    ({"user_agent": 7}, "'int' object has no attribute 'lower'"),
    ({"user_agent": {"a": 1}}, "'dict' object has no attribute 'lower'"),
    ({"user_agent": ["a"]}, "'list' object has no attribute 'lower'"),
    ({"source_ip": None}, None), ({"timestamp": 5}, None), ({"extra": [1, {"a": 2}]}, None),
    ({"payload_size": 10.5}, None), ({"payload_size": 123456789012345678901234567890}, None),
    ({"source_port": True}, None), ({"source_port": 0}, None), ({"source_port": 65535}, None),
])
def test_single_checks(spark, change, error):
    r = one(spark, {**VALID, **change})[0]
    assert r.error == error and (r.prediction is None) == (error is not None)
    assert r.status_code == (200 if error is None else 400 if error == validate.INVALID_VALUES else 500)


def test_true_and_false_payload(spark):
    got = one(spark, {**VALID, "payload_size": True}, {**VALID, "payload_size": False})
    assert [r.prediction.confidence for r in got] == [0.0, 0.1]


def test_missing_and_broken(spark):
    got = one(spark, {"timestamp": "x", "source_ip": "y"}, {}, "{not json", "[1]")
    assert [r.error for r in got] == [validate.MISSING_FOR_PREDICTION] * 2 + [validate.NOT_JSON, validate.MISSING_FOR_PREDICTION]
    v = validate.validate_records(bodies(spark, {"timestamp": "x", "source_ip": None}, VALID)).orderBy("id").collect()
    assert v[0].missing == [f for f in VALID if f not in ("timestamp", "source_ip")]
    assert [(r.has_fields, r.valid_types) for r in v] == [(False, False), (True, True)]


def test_batch_keeps_going(spark):
    got = batch(spark, VALID, {"timestamp": "x"}, {**VALID, "source_port": "a"}, {**VALID, "user_agent": None}, 5, None, [1], "s",
                {**VALID, "destination_port": 3389})
    assert [r["index"] for r in got] == list(range(9))
    assert [r.error for r in got] == [
        None, validate.MISSING_FIELDS, validate.INVALID_TYPES, "'NoneType' object has no attribute 'lower'",
        "argument of type 'int' is not iterable", "argument of type 'NoneType' is not iterable",
        validate.MISSING_FIELDS, validate.MISSING_FIELDS, None]
    assert got[8].prediction.confidence == 0.3


def test_batch_bodies(spark):
    got = validate.body_errors(bodies(spark, {"data": [VALID, {}]}, {"rows": []}, {"data": {"a": 1}}, "nope", {"data": []}))
    assert [(r.error, r.total_processed) for r in got.orderBy("id").collect()] == [
        (None, 2), (validate.MISSING_DATA, None), (validate.DATA_NOT_LIST, None), (validate.NOT_JSON, None), (None, 0)]


def test_read_bodies(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"data": [VALID]}) + "\n" + json.dumps({"data": [VALID, VALID]}) + "\n")
    assert validate.score_batch(read_bodies(spark, str(tmp_path)).withColumn("id", F.lit(1))).count() == 3


def test_check_fields(spark):
    df = bodies(spark, {"a": 1, "b": None, "c": 3}, {"a": 1}, {}).withColumn("v", F.parse_json("body"))
    assert [r[0] for r in df.orderBy("id").select(validate.check_fields(F.col("v"), ["a", "b"])).collect()] == [True, False, False]


# ---- store


def table(spark, *rows):
    return spark.createDataFrame(rows, "timestamp string, source_ip string, destination_ip string, status string, payload_size int")


def test_insert(spark):
    base = table(spark, ("t1", "a", "b", "ok", 1))
    new = spark.createDataFrame(
        [("t1", "a", "b", "x", 9, 0), ("t2", "a", "b", "first", 2, 1), ("t2", "a", "b", "second", 3, 2), (None, "a", "b", "n1", 4, 3),
         (None, "a", "b", "n2", 5, 4)],
        "timestamp string, source_ip string, destination_ip string, status string, payload_size int, arrival int")
    after, rejected = store.insert_if_absent(base, new, "arrival")
    assert sorted(r.status for r in after.collect()) == ["first", "n1", "ok"]
    assert sorted(r.arrival for r in rejected.collect()) == [0, 2, 4]


def test_update(spark):
    base = table(spark, ("t1", "a", "b", "ok", 1), ("t2", "a", "b", "ok", 2))
    patches = spark.createDataFrame(
        [("t1", "a", "b", 1, "one", None, None, ["status"]), ("t1", "a", "b", 2, "two", None, "x", ["status", "note"]),
         ("t2", "a", "b", 3, None, None, None, ["payload_size"]), ("t9", "a", "b", 4, "z", None, None, ["status"])],
        "timestamp string, source_ip string, destination_ip string, seq int, status string, payload_size int, note string, supplied array<string>")
    after, missing = store.update_by_key(base, patches, "seq")
    got = {r.timestamp: (r.status, r.payload_size, r.note) for r in after.collect()}
    assert got == {"t1": ("two", 1, "x"), "t2": ("ok", None, None)}
    assert [r.timestamp for r in missing.collect()] == ["t9"]


def test_delete(spark):
    base = table(spark, ("t1", "a", "b", "ok", 1), ("t2", "a", "b", "ok", 2))
    keys = spark.createDataFrame([("t1", "a", "b"), ("t1", "a", "b"), ("t7", "a", "b")], "timestamp string, source_ip string, destination_ip string")
    after, missing = store.delete_by_key(base, keys)
    assert [r.timestamp for r in after.collect()] == ["t2"]
    assert [r.timestamp for r in missing.collect()] == ["t7"]


# ---- quality


def test_quality(spark):
    df = spark.createDataFrame([(1.0, 10, "A", 0), (2.0, 20, "B", 1), (None, 30, "A", 0), (4.0, 40, "C", 1), (5.0, 50, None, 1)],
                               "feature1 double, feature2 int, feature3 string, y int")
    assert {r.column: r.n_null for r in quality.null_profile(df).collect()} == {"feature1": 1, "feature2": 0, "feature3": 1, "y": 0}
    filled = quality.mean_impute(df, ["feature1"])
    assert sorted(r.feature1 for r in filled.collect()) == [1, 2, 3, 4, 5]
    s = quality.standard_scale(filled, ["feature1", "feature2"]).agg(
        F.avg("feature1_scaled"), F.stddev_pop("feature1_scaled"), F.stddev_pop("feature2_scaled")).first()
    assert abs(s[0]) < 1e-9 and abs(s[1] - 1) < 1e-9 and abs(s[2] - 1) < 1e-9
    b = quality.class_balance(df, "y").first()
    assert (b.n_classes, b.largest, b.smallest, b.imbalance_ratio) == (2, 3, 2, 1.5)
    assert quality.fill_unknown(df, ["feature3"]).filter("feature3 = 'unknown'").count() == 1
    quality.check_schema(df, 4, ["y"])
    with pytest.raises(ValueError):
        quality.check_schema(df, 16)
    with pytest.raises(ValueError):
        quality.check_schema(df, required=["purchased"])
