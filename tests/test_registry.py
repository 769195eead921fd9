import re

import duckdb
import pytest

import __spark_entry__ as entry
from logsentry.plans import catalog, evaluation, ordered, scoring
from tests.conftest import SF

TABLES = "events lineitem orders customer".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def value(v):
    return repr(v + 0.0) if isinstance(v, float) else repr(v)


def same(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(value(r[c]) for c in cols) for r in df.collect())
    rel = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    want = sorted(tuple(value(r[names.index(c)]) for c in cols) for r in rel.fetchall())
    assert got == want


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["hour", "risk_level", "n", "mean_score"]


@pytest.mark.parametrize("name", ["feature_matrix", "ordered_features_lines", "encode_unseen_check", "stratified_split", "time_folds",
                                  "batch_scoring", "store_insert", "store_update", "store_delete_unmatched", "roc_curve_smooth",
                                  "pr_auc_smooth", "class_histogram", "metric_log", "local_interpretation", "linear_attribution"])
def test_against_sql(spark, duck, name):
    same(spark, duck, name)


# Plans whose only single-partition exchanges are over aggregates, never over rows.
ROW_PLANS = ["rolling_mean_std", "lag_features", "time_since_last", "feature_matrix", "global_index_lines", "prediction_timeline",
             "stratified_split", "roc_curve_smooth", "batch_scoring", "label_encode"]


@pytest.mark.parametrize("name", ROW_PLANS)
def test_no_rows_in_one_partition(spark, name):
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert re.search(r"HashAggregate|SortAggregate|ObjectHashAggregate", lines[i + 1]), lines[i + 1]
        assert "CartesianProduct" not in line and "BroadcastNestedLoopJoin" not in line


def test_scan_is_pruned(spark):
    plan = catalog.QUERIES["calibration_curve"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert "ts:" not in schema and "event_type" not in schema


def test_filter_is_pushed(spark):
    events = spark.read.parquet(f"{SF}/events.parquet").filter("ts >= timestamp_ntz'2024-01-20 00:00:00'")
    from logsentry.sources.network_logs import from_events
    plan = from_events(events).select("log_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan


def test_names():
    for family in (ordered, scoring, evaluation):
        assert all(re.fullmatch(r"[a-z0-9_]+", n) for n in family.QUERIES)
