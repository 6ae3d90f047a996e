"""Runs are published whole, once, or not at all."""

import pytest
from pyspark.sql import functions as F

from wearlog.plans.publish import RunStore, publish_benchmark, run_key, run_tables

SUMMARY = "dataset_id string, model string, rmse double, loss double, train_rows long"


@pytest.fixture
def summary(spark):
    return spark.createDataFrame([("FD001", "random_forest", 1.5, None, 10), ("FD002", "random_forest", 2.5, 0.5, 20)], SUMMARY)


def test_log_has_a_parent_and_its_children(spark, summary, tmp_path):
    config = {"windows": (5, 15), "safe_mode": True}
    key, first = publish_benchmark(spark, str(tmp_path / "r"), config, "fp", summary, spark.createDataFrame([(1, [2])], "a int, b array<int>"))
    assert first and publish_benchmark(spark, str(tmp_path / "r"), config, "fp", summary) == (key, False)
    store = RunStore(spark, str(tmp_path / "r"))
    runs = store.table("runs").collect()
    assert sorted((r.parent_run_id, r.run_name) for r in runs if r.parent_run_id) == [(key, "FD001 random_forest"), (key, "FD002 random_forest")]
    assert [r.run_id for r in runs if r.parent_run_id is None] == [key]
    assert {(r.run_id.split(":")[1], r.key): r.value for r in store.table("run_metrics").collect()} == {
        ("FD001", "rmse"): 1.5, ("FD001", "train_rows"): 10.0, ("FD002", "rmse"): 2.5, ("FD002", "loss"): 0.5, ("FD002", "train_rows"): 20.0
    }
    assert {r.key: r.value for r in store.table("run_params").collect()}["windows"] == "5,15"
    reports = store.runs().first().reports
    assert set(reports) == {"summary.csv", "summary.json", "run_metadata.json"}
    assert spark.read.option("header", True).csv(reports["summary.csv"]).count() == 2
    assert spark.read.json(reports["summary.json"]).where("loss IS NULL").count() == 1


def test_a_failed_attempt_is_seen_by_nobody(spark, summary, tmp_path):
    store, key = RunStore(spark, str(tmp_path / "r")), run_key({}, "x")
    bad = dict(run_tables(key, {"a": 1}, summary))
    bad["summary"] = summary.select(F.raise_error(F.lit("lost")).cast("int").alias("x"))
    with pytest.raises(Exception, match="lost"):
        store.publish(key, bad)
    assert not store.is_published(key) and store.runs().count() == 0
    with pytest.raises(ValueError):
        store.table("runs")
    assert store.publish(key, run_tables(key, {"a": 1}, summary))
    assert store.table("runs").count() == 3 and store.runs().count() == 1


def test_of_two_writers_one_wins(spark, summary, tmp_path):
    store, key = RunStore(spark, str(tmp_path / "r")), run_key({}, "y")
    other = RunStore(spark, str(tmp_path / "r"))
    taken = other.is_published
    store.is_published = lambda k, seen=[]: taken(k) if seen else (seen.append(1), False)[1]  # both look before either commits
    assert other.publish(key, run_tables(key, {"a": 1}, summary, "first"))
    assert not store.publish(key, run_tables(key, {"a": 1}, summary, "second"))
    assert [r.run_name for r in store.table("runs").where("parent_run_id IS NULL").collect()] == ["first"]


def test_keys_tell_settings_and_inputs_apart():
    assert run_key({"a": 1, "b": 2}, "i") == run_key({"b": 2, "a": 1}, "i")
    assert len({run_key({"a": 1}, "i"), run_key({"a": 2}, "i"), run_key({"a": 1}, "j")}) == 3
