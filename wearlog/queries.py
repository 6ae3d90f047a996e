"""Registered queries (Spark) and their DuckDB oracle SQL.

Every query reads the driver's tables (through the fixture mapping in
``sources/fixtures.py``) over whole tables. Computed columns carry the same
names on both sides; doubles are rounded so that no decimal tie can occur
(6 places for windows of <= 30 rows, 8 for whole-table averages, 4 for the
large asymmetric sums), and integer outputs are cast to one agreed type.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.ids import dataset_ids_col, fd_id_col
from .operators.features import build_labeled_features, build_rolling_features, feature_names
from .operators.fingerprint import BASE, PRIME, dataframe_fingerprint
from .operators.labels import add_rul_targets, add_test_rul_targets, missing_truth_units, unplaced_rows
from .operators.latest import dedupe_keep_last, latest_row_per_unit, unit_trajectory
from .operators.metrics import metric_bounds, metric_exprs, pair_by_position, regression_metrics
from .operators.sensors import (
    compute_sensor_summary,
    kept_sensor_frame,
    known_dropped_intersection,
    suggest_low_variance_sensors,
)
from .operators.sequences import create_sequence_dataset, pack_sequences
from .operators.split import apply_split, rows_of_units, split_counts, split_units
from .schema import DROPPED_SENSORS, OP_SETTING_COLUMNS, SENSOR_COLUMNS
from .sources.fixtures import cached_frame, supplier_truth

SENSORS4 = ["sensor_1", "sensor_2", "sensor_3", "sensor_4"]
KEYS = ["dataset_id", "unit_id"]

# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------


def _fa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cached_frame(spark, sf_dir, "lineitem")


def _fb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cached_frame(spark, sf_dir, "events")


def _r(c: str, n: int) -> F.Column:
    return F.round(F.col(c), n).alias(c)


def _r_by_size(c: str) -> F.Column:
    """8 places, or 2 for the prices' large moments (doubles have no more digits)."""
    return F.when(F.abs(F.col(c)) < 1000, F.round(F.col(c), 8)).otherwise(F.round(F.col(c), 2)).alias(c)


def q_rul_labels(spark, sf_dir):
    lab = add_rul_targets(_fa(spark, sf_dir), cap=125)
    return lab.select(*KEYS, "cycle", "rul_raw", "rul")


def q_rul_labels_uncapped(spark, sf_dir):
    lab = add_rul_targets(_fa(spark, sf_dir), cap=None, keep_raw=False)
    return lab.select(*KEYS, "cycle", "rul")


def q_rul_test_labels(spark, sf_dir):
    lab = add_test_rul_targets(_fa(spark, sf_dir), supplier_truth(spark, sf_dir), cap=125)
    return lab.select(*KEYS, "cycle", "rul_raw", "rul")


def q_missing_truth_units(spark, sf_dir):
    return missing_truth_units(_fa(spark, sf_dir), supplier_truth(spark, sf_dir, drop_every=7))


def q_rolling_mean(spark, sf_dir):
    feats = build_rolling_features(_fa(spark, sf_dir), SENSORS4, lags=(), drop_na=False)
    cols = [c for c in feature_names(SENSORS4, (5, 15, 30), ()) if "_mean_" in c]
    return feats.select(*KEYS, "cycle", *[_r(c, 6) for c in cols])


def q_rolling_std(spark, sf_dir):
    feats = build_rolling_features(_fa(spark, sf_dir), SENSORS4, lags=(), drop_na=False)
    cols = [c for c in feature_names(SENSORS4, (5, 15, 30), ()) if "_std_" in c]
    return feats.select(*KEYS, "cycle", *[_r(c, 6) for c in cols])


def _with_gaps(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "sensor_1", F.when(F.col("cycle") % 17 == 0, F.lit(None)).otherwise(F.col("sensor_1"))
    )


def q_rolling_min_periods(spark, sf_dir):
    feats = build_rolling_features(
        _with_gaps(_fa(spark, sf_dir)), ["sensor_1"], windows=(5,), lags=(), min_periods=3, drop_na=False
    )
    return feats.select(
        *KEYS, "cycle", _r("sensor_1_roll_mean_w5", 6), _r("sensor_1_roll_std_w5", 6)
    )


def q_lag_features(spark, sf_dir):
    feats = build_rolling_features(_fa(spark, sf_dir), SENSORS4, windows=(1,), lags=(1, 3, 5))
    return feats.select(*KEYS, "cycle", *[f"{s}_lag_{l}" for s in SENSORS4 for l in (1, 3, 5)])


def q_rolling_features_wide(spark, sf_dir):
    feats = build_labeled_features(_fa(spark, sf_dir), SENSORS4, cap=125)
    names = feature_names(SENSORS4, (5, 15, 30), (1, 3, 5))
    return feats.select(*KEYS, "cycle", "rul", *[_r(c, 6) for c in names])


def q_events_rolling_features(spark, sf_dir):
    feats = build_rolling_features(_fb(spark, sf_dir), ["sensor_1", "sensor_2"], windows=(5, 10), lags=(1, 2))
    names = feature_names(["sensor_1", "sensor_2"], (5, 10), (1, 2))
    return feats.select(*KEYS, "cycle", *[_r(c, 6) for c in names])


def q_events_rul_labels(spark, sf_dir):
    lab = add_rul_targets(_fb(spark, sf_dir), cap=60)
    return lab.select(*KEYS, "cycle", "rul_raw", "rul")


def q_events_sequence_stride(spark, sf_dir):
    lab = add_rul_targets(_fb(spark, sf_dir), cap=60)
    seq = create_sequence_dataset(lab, ["sensor_1", "sensor_2"], sequence_length=10, stride=3)
    return seq.select(*KEYS, "cycle", "rul", F.size("x").cast("int").alias("steps"))


def _labeled(spark, sf_dir):
    return add_rul_targets(_fa(spark, sf_dir), cap=125)


def q_sequence_index(spark, sf_dir):
    seq = create_sequence_dataset(_labeled(spark, sf_dir), SENSORS4, sequence_length=30, stride=1)
    return seq.select(*KEYS, "cycle", "rul")


def q_sequence_stride(spark, sf_dir):
    seq = create_sequence_dataset(_labeled(spark, sf_dir), SENSORS4, sequence_length=30, stride=7)
    return seq.select(*KEYS, "cycle", "rul")


def sequence_checksum(x: F.Column) -> F.Column:
    """sum over steps t and features f of (t+1)*(f+1)*x[t][f], in double."""
    per_step = F.transform(
        x,
        lambda step, t: (t + 1).cast("double")
        * F.aggregate(
            F.transform(step, lambda v, f: (f + 1).cast("double") * v.cast("double")),
            F.lit(0.0),
            lambda acc, v: acc + v,
        ),
    )
    return F.aggregate(per_step, F.lit(0.0), lambda acc, v: acc + v)


def q_sequence_windows_checksum(spark, sf_dir):
    seq = create_sequence_dataset(
        _labeled(spark, sf_dir), ["sensor_1", "sensor_3", "sensor_4"], sequence_length=30, stride=1
    )
    return seq.select(
        *KEYS,
        "cycle",
        F.size("x").cast("int").alias("steps"),
        F.round(sequence_checksum(F.col("x")), 4).alias("checksum"),
    )


SUMMARY_SENSORS = ["sensor_1", "sensor_2", "sensor_3", "sensor_4", "sensor_5"]
SUMMARY_COLS = [
    "global_mean",
    "global_std",
    "global_var",
    "global_iqr",
    "mean_unit_std",
    "median_unit_std",
    "max_unit_std",
]


def q_sensor_summary(spark, sf_dir):
    s = compute_sensor_summary(_fa(spark, sf_dir), SUMMARY_SENSORS)
    return s.select("dataset_id", "sensor", *[_r_by_size(c) for c in SUMMARY_COLS])


def q_low_variance_sensors(spark, sf_dir):
    s = compute_sensor_summary(_fa(spark, sf_dir), SUMMARY_SENSORS)
    return suggest_low_variance_sensors(s, "mean_unit_std", 0.05).select("dataset_id", "sensor")


def q_sensor_intersection(spark, sf_dir):
    s = compute_sensor_summary(_fa(spark, sf_dir), SUMMARY_SENSORS)
    return known_dropped_intersection(suggest_low_variance_sensors(s, "mean_unit_std", 0.05))


def q_kept_sensors(spark, sf_dir):
    return kept_sensor_frame(_fa(spark, sf_dir))


def q_unit_split(spark, sf_dir):
    units = split_units(_fa(spark, sf_dir), validation_fraction=0.2, seed=42)
    return units.select(*KEYS, "is_validation")


def q_split_counts(spark, sf_dir):
    fa = _fa(spark, sf_dir)
    units = split_units(fa, 0.2, 42)
    return split_counts(fa, units).select(
        "dataset_id", "is_validation", F.col("units").cast("long"), F.col("rows").cast("long")
    )


def q_validation_rows(spark, sf_dir):
    """Rows of the validation units only (semi join on the unit list)."""
    from .operators.split import rows_of_units

    fa = _fa(spark, sf_dir)
    units = split_units(fa, 0.2, 42).where("is_validation")
    return rows_of_units(fa, units).select(*KEYS, "cycle", "sensor_1")


def q_null_feature_units(spark, sf_dir):
    """Reject table of the sequence null guard: units with missing values."""
    from .operators.sequences import null_feature_units

    return null_feature_units(_with_gaps(_fa(spark, sf_dir)), ["sensor_1", "sensor_2"]).select(
        *KEYS, F.col("null_rows").cast("long").alias("null_rows")
    )


def _predictions(spark, sf_dir):
    fa = _fa(spark, sf_dir)
    lab = add_rul_targets(fa, cap=125)
    return lab.select(
        *KEYS, "cycle", "rul", (F.col("rul") + F.col("sensor_1") - 25.5).alias("prediction")
    )


def q_regression_metrics(spark, sf_dir):
    m = regression_metrics(_predictions(spark, sf_dir), "rul", "prediction", ["dataset_id"])
    return m.select("dataset_id", _r("rmse", 8), _r("mae", 8), _r("nasa_score", 4))


def q_metrics_by_split(spark, sf_dir):
    pred = _predictions(spark, sf_dir)
    units = split_units(pred, 0.2, 42)
    flagged = apply_split(pred, units)
    m = regression_metrics(flagged, "rul", "prediction", ["dataset_id", "is_validation"])
    return m.select("dataset_id", "is_validation", _r("rmse", 8), _r("mae", 8), _r("nasa_score", 4))


def q_model_comparison(spark, sf_dir):
    """Two simple predictors compared per fleet; only the second reports a
    loss, so the union fills the first one's with NULL."""
    from .plans.sinks import union_results

    lab = add_rul_targets(_fa(spark, sf_dir), cap=125)
    pred = lab.withColumn("prediction", F.col("rul") + F.col("sensor_1") - 25.5)
    a = regression_metrics(pred, "rul", "prediction", ["dataset_id"]).withColumn("model", F.lit("quantity_offset"))
    p2 = lab.withColumn("prediction", F.col("rul") + (F.col("sensor_3") * 100 - 5))
    d = F.col("prediction") - F.col("rul")
    b = (
        regression_metrics(p2, "rul", "prediction", ["dataset_id"])
        .join(p2.groupBy("dataset_id").agg(F.avg(d * d).alias("loss")), "dataset_id")
        .withColumn("model", F.lit("discount_offset"))
    )
    out = union_results([a, b])
    return out.select(
        "dataset_id", "model", _r("rmse", 8), _r("mae", 8), _r("nasa_score", 4), _r("loss", 8)
    ).orderBy("dataset_id", "rmse")


def q_metric_bounds(spark, sf_dir):
    b = metric_bounds(_predictions(spark, sf_dir), "rul", "prediction", ["dataset_id"])
    return b.select("dataset_id", _r("lower", 6), _r("upper", 6))


def q_fingerprint(spark, sf_dir):
    lab = add_rul_targets(_fa(spark, sf_dir), cap=125)
    return dataframe_fingerprint(lab, ["dataset_id", "unit_id", "cycle", "rul"])


def q_fingerprint_ordered(spark, sf_dir):
    lab = add_rul_targets(_fa(spark, sf_dir), cap=125)
    return dataframe_fingerprint(lab, ["dataset_id", "unit_id", "cycle", "rul"], order_by=["cycle", "dataset_id", "unit_id"])


def q_paired_metrics(spark, sf_dir):
    """Labels and predictions without a key, paired by their places in two orders."""
    pred = _predictions(spark, sf_dir)
    labels = pred.select("rul", *KEYS, "cycle")
    values = pred.select("prediction", F.col("cycle").alias("c"), F.col("unit_id").alias("u"), F.col("dataset_id").alias("d"))
    pairs = pair_by_position(labels, values, label_order=[*KEYS, "cycle"], prediction_order=["c", "u", "d"])
    m = pairs.agg(F.count(F.lit(1)).alias("pairs"), *metric_exprs("rul", "prediction"))
    return m.select("pairs", _r("rmse", 8), _r("mae", 8), _r("nasa_score", 2))


def _uneven(spark, sf_dir) -> DataFrame:
    """Lineitem cycles with repeats (three readings to a cycle number) and gaps."""
    fa = _fa(spark, sf_dir).select(*KEYS, "cycle", *SENSORS4).where(F.col("cycle") % 11 != 4)
    return fa.withColumn("cycle", (F.col("cycle") - F.col("cycle") % 3).cast("int"))


def q_rolling_features_split(spark, sf_dir):
    """Repeated and missing cycles with every unit laid out in parts of 64 rows."""
    feats = build_rolling_features(
        _uneven(spark, sf_dir), SENSORS4, windows=(5, 15), lags=(1, 3), drop_na=False, include_original_sensors=True, width=64, hot_rows=20
    )
    return feats.select(*KEYS, "cycle", *SENSORS4, *[_r(c, 6) for c in feature_names(SENSORS4, (5, 15), (1, 3))])


def q_sequence_windows_split(spark, sf_dir):
    lab = add_rul_targets(_uneven(spark, sf_dir), cap=125)
    seq = create_sequence_dataset(lab, ["sensor_1", "sensor_3", "sensor_4"], sequence_length=10, stride=3, width=64, hot_rows=20)
    return seq.select(*KEYS, "cycle", "rul", F.round(sequence_checksum(F.col("x")), 4).alias("checksum"))


def q_unplaced_rows(spark, sf_dir):
    """Rows that labels refuse: no unit (every 13th cycle here) or no cycle (every 17th)."""
    fa = _fa(spark, sf_dir).select(*KEYS, "cycle", "sensor_1", F.col("cycle").alias("at"), F.col("unit_id").alias("unit"))
    holes = fa.withColumns({"unit_id": F.when(F.col("at") % 13 != 0, F.col("unit_id")), "cycle": F.when(F.col("at") % 17 != 0, F.col("cycle"))})
    return unplaced_rows(holes).select("dataset_id", "unit", "at", "problem")


def q_packed_sequences(spark, sf_dir):
    """Packed pieces of units: rows stored, of them again for the next piece's first windows, and windows that start there."""
    packed = pack_sequences(_labeled(spark, sf_dir), SENSORS4, sequence_length=30, stride=7, piece_rows=64)
    sums = packed.groupBy(*KEYS).agg(F.sum(F.size("x")).cast("long").alias("stored"), F.sum(F.size("starts")).cast("long").alias("windows"))
    return sums.select(*KEYS, "stored", "windows")


def q_latest_row_per_unit(spark, sf_dir):
    fa = _fa(spark, sf_dir).select(*KEYS, "cycle", *SENSORS4)
    return latest_row_per_unit(fa)


def q_dedupe_keep_last(spark, sf_dir):
    fa = _fa(spark, sf_dir).select(*KEYS, "cycle", *SENSORS4)
    # Two arrivals per reading slot: slot = ceil(cycle / 2), arrival = cycle.
    dup = fa.select(
        *KEYS,
        F.ceil(F.col("cycle") / 2).cast("int").alias("slot"),
        F.col("cycle").alias("arrival"),
        *SENSORS4,
    ).withColumnRenamed("slot", "cycle")
    out = dedupe_keep_last(dup, "arrival")
    return out.select(*KEYS, "cycle", "arrival", *SENSORS4)


def q_unit_trajectory(spark, sf_dir):
    fa = _fa(spark, sf_dir)
    first = fa.where("dataset_id = 'FD001'").agg(F.min("unit_id")).first()[0]
    return unit_trajectory(fa, {"dataset_id": "FD001", "unit_id": first}, SENSORS4)


def q_normalize_ids(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey")
    k = F.col("s_suppkey")
    raw = (
        F.when(k % 4 == 0, F.concat(F.lit(" fd"), F.lpad((k % 6).cast("string"), 3, "0"), F.lit(" ")))
        .when(k % 4 == 1, F.concat(F.lit("FD"), (k % 6).cast("string")))
        .when(k % 4 == 2, (k % 6).cast("string"))
        .otherwise(F.concat(F.lit("x"), (k % 6).cast("string")))
    )
    listing = F.concat_ws(",", raw, F.concat(F.lit("fd00"), (k % 5).cast("string")), raw)
    df = li.select(k.alias("s_suppkey"), raw.alias("raw"), listing.alias("listing"))
    return df.select(
        "s_suppkey",
        fd_id_col("raw").alias("fd_id"),
        F.array_join(dataset_ids_col("listing"), ",").alias("ids"),
    )


def q_test_rul_tail(spark, sf_dir):
    """Test-split labels of each unit's last cycle (what a test-set score uses)."""
    lab = add_test_rul_targets(_fa(spark, sf_dir), supplier_truth(spark, sf_dir), cap=None)
    last = latest_row_per_unit(lab.select(*KEYS, "cycle", "rul"))
    return last.select(*KEYS, "cycle", "rul")


# --- text sources (files derived from the tables) ----------------------------

_WRITTEN: dict[tuple, str] = {}


def fixture_text_files(spark: SparkSession, sf_dir: str, splits: Sequence[str] = ("train", "test", "rul")) -> str:
    """Write the lineitem fleets as cycle files (train and test) and the
    supplier truth as ordered truth files, each split once per session and only
    if asked for; returns the folder. Each logical file is a folder of ordered
    part files."""
    import os
    import uuid

    from .session import scratch_path
    from .sources.cycle_files import split_file_name

    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    root = _WRITTEN.setdefault(key, scratch_path(spark, "raw", uuid.uuid4().hex[:12]))
    for split in splits:
        if (*key, split) in _WRITTEN:
            continue
        if split == "rul":
            rows = supplier_truth(spark, sf_dir).select("dataset_id", "unit_id", F.col("final_rul").cast("string").alias("value"))
        else:
            fa = _fa(spark, sf_dir)
            values = ["unit_id", "cycle", *OP_SETTING_COLUMNS, *SENSOR_COLUMNS]
            line = F.concat_ws(" ", *[(F.col(c) if c in fa.columns else F.lit(0.0)).cast("string") for c in values])
            rows = fa.select("dataset_id", line.alias("value"))
        for ds in ("FD001", "FD002", "FD003"):
            part = rows.where(F.col("dataset_id") == ds)
            part = part.orderBy("unit_id") if split == "rul" else part
            part.select("value").write.mode("overwrite").text(os.path.join(root, split_file_name(ds, split)))
        _WRITTEN[(*key, split)] = root
    return root


def q_text_source_cycles(spark, sf_dir):
    from .sources.cycle_files import load_split

    root = fixture_text_files(spark, sf_dir, ["train"])
    rows = load_split(spark, root, ["FD001", "FD002", "FD003"], "train", mode="strict")
    return rows.select(*KEYS, "cycle", *SENSORS4)


def q_text_source_truth(spark, sf_dir):
    from .sources.cycle_files import load_split

    root = fixture_text_files(spark, sf_dir, ["rul"])
    return load_split(spark, root, [1, 2, 3], "rul", mode="strict")


def q_availability_grid(spark, sf_dir):
    """Missing files of the fleets asked for, and the rows of those that are there."""
    from .sources.cycle_files import load_split
    from .sources.listing import availability

    root = fixture_text_files(spark, sf_dir)
    available, missing = availability(spark, root, ["FD001", "fd002", "3", "FD004"])
    names = F.transform("paths", lambda p: F.element_at(F.split(p, "/"), -1))
    fleets = [r.dataset_id for r in available.select("dataset_id").collect()]
    rows = load_split(spark, root, fleets, "train").groupBy("dataset_id").agg(F.count(F.lit(1)).alias("train_rows"))
    gone = missing.select("dataset_id", F.explode(names).alias("missing_file"), F.lit(None).cast("long").alias("train_rows"))
    return gone.unionByName(rows.select("dataset_id", F.lit(None).cast("string").alias("missing_file"), "train_rows"))


# --- requests -------------------------------------------------------------------

REQUEST_SIZE = 40


def fixture_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request bodies from the lineitem fleets: each unit's cycles in chunks
    of 40 records; some chunks are made invalid on purpose (selector
    v = (unit_id * 7 + chunk) % 10): 1 extra key, 2 missing field, 3 cycle 0,
    4 no records, 5 unit 0; 6 repeats its last cycle with sensor_2 + 1000
    (the later arrival must win)."""
    from .sources.requests import RECORD_FIELDS

    fa = _fa(spark, sf_dir)
    chunk = F.floor((F.col("cycle") - 1) / REQUEST_SIZE).cast("long")
    fields = [
        (F.col(c).cast("long") if c == "cycle" else (F.col(c) if c in fa.columns else F.lit(0.0)).cast("double")).alias(c)
        for c in RECORD_FIELDS
    ]
    grouped = fa.select(*KEYS, chunk.alias("chunk"), F.struct(*fields).alias("rec")).groupBy(
        *KEYS, "chunk"
    ).agg(F.sort_array(F.collect_list("rec")).alias("recs"), F.max_by("rec", F.col("rec.cycle")).alias("last"))
    v = (F.col("unit_id") * 7 + F.col("chunk")) % 10
    dup = F.col("last").withField("sensor_2", F.col("last.sensor_2") + 1000.0)
    recs = F.when(v == 6, F.concat("recs", F.array(dup))).otherwise(F.col("recs"))
    body = F.to_json(F.struct("unit_id", recs.alias("records")))
    body = (
        F.when(v == 1, F.regexp_replace(body, r"\}$", ',"extra":1}'))
        .when(v == 2, F.regexp_replace(body, r'"sensor_7":[^,}]*,', ""))
        .when(v == 3, F.regexp_replace(body, r'"cycle":[0-9]+', '"cycle":0'))
        .when(v == 4, F.regexp_replace(body, r'"records":\[.*\]', '"records":[]'))
        .when(v == 5, F.regexp_replace(body, r'^\{"unit_id":[0-9]+', '{"unit_id":0'))
        .otherwise(body)
    )
    rid = F.concat_ws(":", "dataset_id", F.col("unit_id").cast("string"), F.col("chunk").cast("string"))
    return grouped.select(rid.alias("request_id"), body.alias("body"))


def q_request_rejects(spark, sf_dir):
    from .plans.scoring import request_features

    _, rejects, _ = request_features(fixture_requests(spark, sf_dir))
    return rejects.select("request_id", "unit_id", "status", "detail")


def q_request_latest_features(spark, sf_dir):
    from .plans.scoring import request_features

    latest, _, names = request_features(fixture_requests(spark, sf_dir))
    return latest.select("request_id", "unit_id", "cycle", *[_r(c, 6) for c in names])


# --- models and streams (rows-only checks) ------------------------------------


def _bench_config(**kw):
    from .plans.benchmark import BenchmarkConfig

    base = dict(rf_num_trees=20, rf_max_depth=8)
    base.update(kw)
    return BenchmarkConfig(**base)


def q_benchmark_counts(spark, sf_dir):
    """Units, rows and sequence samples on both sides of each fleet's split, as the summary reports them."""
    from .plans.benchmark import BenchmarkConfig, prepare_training_inputs, split_sizes

    return split_sizes(prepare_training_inputs(_fa(spark, sf_dir), BenchmarkConfig(include_sequence_model=True)))


def q_published_run_log(spark, sf_dir):
    """The log of a published run, read back after the run was tried twice: a parent and a child for each fleet."""
    import uuid

    from .plans.benchmark import BenchmarkConfig, prepare_training_inputs, split_sizes
    from .plans.publish import RunStore, publish_benchmark
    from .session import materialize, scratch_path

    sizes = materialize(split_sizes(prepare_training_inputs(_fa(spark, sf_dir), BenchmarkConfig())), "split-sizes")
    side = lambda c, flag, name: F.sum(F.when(F.col("is_validation") == flag, F.col(c))).alias(name)
    summary = sizes.groupBy("dataset_id").agg(
        side("units", False, "train_units"), side("units", True, "validation_units"), side("rows", False, "train_rows"), side("rows", True, "validation_rows")
    ).withColumn("model", F.lit("split"))
    root = scratch_path(spark, "published", uuid.uuid4().hex[:12])
    for _ in range(2):
        publish_benchmark(spark, root, {"validation_fraction": 0.2, "seed": 42}, sf_dir, summary)
    store = RunStore(spark, root)
    runs, metrics = store.table("runs"), store.table("run_metrics")
    children = runs.join(metrics, "run_id").where("parent_run_id IS NOT NULL")
    return children.groupBy("run_name", "key").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("value"))


def q_rf_validation_metrics(spark, sf_dir):
    from .plans.benchmark import run_benchmark_on_frame

    summary, _ = run_benchmark_on_frame(spark, _fa(spark, sf_dir), _bench_config())
    return summary


def q_benchmark_summary(spark, sf_dir):
    from .plans.benchmark import run_benchmark_on_frame

    summary, _ = run_benchmark_on_frame(
        spark, _fa(spark, sf_dir), _bench_config(include_sequence_model=True)
    )
    return summary


def q_rf_feature_importances(spark, sf_dir):
    """Top-15 features of each fleet's forest."""
    from .plans.benchmark import run_benchmark_on_frame
    from .plans.models import feature_importances, top_importances

    _, art = run_benchmark_on_frame(spark, _fa(spark, sf_dir), _bench_config())
    frames = [
        top_importances(feature_importances(spark, res.model), 15).withColumn("dataset_id", F.lit(ds))
        for (ds, kind), res in sorted(art["models"].items())
        if kind == "random_forest"
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.select("dataset_id", "feature", "importance")


def q_sequence_regressor_history(spark, sf_dir):
    """Per-round history of each fleet's sequence model."""
    from .operators.sequences import slice_windows
    from .operators.split import apply_split, split_units
    from .plans.models import train_sequence_regressor
    from .session import materialize

    lab = _labeled(spark, sf_dir)
    packed = pack_sequences(lab, ["op_setting_1", "sensor_2", "sensor_3", "sensor_4"], sequence_length=30)
    flagged = materialize(apply_split(packed, split_units(lab, 0.2, 42)), "seq-flagged", partition_by=["dataset_id"])
    fleets = [r.dataset_id for r in flagged.select("dataset_id").distinct().orderBy("dataset_id").collect()]
    out = None
    for ds in fleets:
        part = flagged.where(F.col("dataset_id") == ds)
        res = train_sequence_regressor(
            slice_windows(part.where(~F.col("is_validation")), 30), slice_windows(part.where(F.col("is_validation")), 30), max_rounds=8, patience=3
        )
        h = res.history.withColumn("dataset_id", F.lit(ds)).withColumn("best_round", F.lit(res.best_round))
        out = h if out is None else out.unionByName(h)
    return out


def _scoring_model(spark, sf_dir):
    """Forest of the lineitem fleets over all features that a request gives (sensors the
    fleets lack are sent as 0, and are 0 here)."""
    from .operators.features import build_labeled_features
    from .plans.models import forest_pipeline
    from .session import materialize

    fa = _fa(spark, sf_dir)
    sensors = [c for c in SENSOR_COLUMNS if c not in DROPPED_SENSORS]
    sent = fa.withColumns({c: F.lit(0.0) for c in sensors if c not in fa.columns})
    names = feature_names(sensors, (5, 15, 30), (1, 3, 5))
    train = materialize(build_labeled_features(sent, sensors).select("rul", *names), "scoring-train")
    return forest_pipeline(names, "rul", 42, num_trees=10, max_depth=6).fit(train)


def q_rf_batch_scores(spark, sf_dir):
    from .plans.scoring import score_requests

    responses, _ = score_requests(fixture_requests(spark, sf_dir), _scoring_model(spark, sf_dir), "lineitem_forest")
    return responses


def q_test_set_metrics(spark, sf_dir):
    """Each fleet's forest scored on the last cycle of the units its split held out."""
    from .plans.benchmark import evaluate_on_test, run_benchmark_on_frame
    from .schema import kept_sensors

    cfg = _bench_config()
    fa = _fa(spark, sf_dir)
    _, art = run_benchmark_on_frame(spark, fa, cfg)
    truth, held_out = supplier_truth(spark, sf_dir), art["prepared"].units.where("is_validation")
    out = None
    for (ds, kind), res in sorted(art["models"].items()):
        if kind != "random_forest":
            continue
        test = rows_of_units(fa.where(F.col("dataset_id") == ds), held_out)
        m = evaluate_on_test(res.model, test, truth, res.feature_columns, kept_sensors(fa), cfg)
        out = m if out is None else out.unionByName(m)
    return out


STREAM_SENSORS = ["sensor_1", "sensor_2"]


def stream_arrivals(spark, sf_dir) -> DataFrame:
    """The events fleet as it arrives (``arrival`` 1, 2, 3): half of the cycles first, of
    these every tenth with a wrong reading; then the other half and the readings set
    right; last, every seventh cycle of a unit again, changed, most of them too late."""
    fb = _fb(spark, sf_dir).select(*KEYS, "cycle", *STREAM_SENSORS)
    early, wrong = (F.col("cycle") * 7) % 4 < 2, F.col("cycle") % 10 == 3
    first = fb.where(early).withColumn("sensor_1", F.col("sensor_1") + F.when(wrong, 1000.0).otherwise(0.0))
    second = fb.where(~early | wrong)
    third = fb.where(F.col("cycle") % 7 == 0).withColumn("sensor_1", F.col("sensor_1") + 500.0)
    parts = [p.withColumn("arrival", F.lit(i + 1)) for i, p in enumerate((first, second, third))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_REPLAYED: dict[tuple, str] = {}


def replayed_stream(spark, sf_dir, model=None) -> str:
    """Folder of the scorer's output after the arrivals came in three runs of one stream
    (each run stops and the next goes on from its checkpoint)."""
    import os
    import uuid

    from .session import materialize, scratch_path
    from .streaming.scoring import start_stream_scoring, unit_buffers

    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), model is not None)
    if key not in _REPLAYED:
        root = scratch_path(spark, "stream-demo", uuid.uuid4().hex[:12])
        rows = materialize(stream_arrivals(spark, sf_dir), "arrivals")
        for arrival in (1, 2, 3):
            rows.where(F.col("arrival") == arrival).write.parquet(f"{root}/in/{arrival}")
            stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in/*")
            buffers = unit_buffers(stream, STREAM_SENSORS, "arrival")
            query = start_stream_scoring(
                buffers, STREAM_SENSORS, f"{root}/out", model, "events_forest",
                query_name=f"scores_{uuid.uuid4().hex[:8]}", checkpoint=f"{root}/state", trigger={"availableNow": True},
            )
            query.awaitTermination()
        _REPLAYED[key] = f"{root}/out"
    return _REPLAYED[key]


def q_stream_features(spark, sf_dir):
    """Each unit's last feature row after the whole stream."""
    from .streaming.scoring import latest_scores

    names = feature_names(STREAM_SENSORS, (5, 15, 30), (1, 3, 5))
    return latest_scores(spark, replayed_stream(spark, sf_dir)).select(*KEYS, "cycle", *[_r(c, 6) for c in names])


def q_stream_late_rows(spark, sf_dir):
    from .streaming.scoring import late_totals

    return late_totals(spark, replayed_stream(spark, sf_dir))


def q_stream_scores(spark, sf_dir):
    """Each unit's last score after the whole stream."""
    from .operators.features import build_labeled_features
    from .plans.models import forest_pipeline
    from .streaming.scoring import latest_scores

    fb = _fb(spark, sf_dir)
    names = feature_names(STREAM_SENSORS, (5, 15, 30), (1, 3, 5))
    model = forest_pipeline(names, "rul", 42, num_trees=10, max_depth=6).fit(build_labeled_features(fb, STREAM_SENSORS))
    return latest_scores(spark, replayed_stream(spark, sf_dir, model)).select(*KEYS, "cycle", "rul")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rul_labels": q_rul_labels,
    "rul_labels_uncapped": q_rul_labels_uncapped,
    "rul_test_labels": q_rul_test_labels,
    "missing_truth_units": q_missing_truth_units,
    "rolling_mean": q_rolling_mean,
    "rolling_std": q_rolling_std,
    "rolling_min_periods": q_rolling_min_periods,
    "lag_features": q_lag_features,
    "rolling_features_wide": q_rolling_features_wide,
    "events_rolling_features": q_events_rolling_features,
    "events_rul_labels": q_events_rul_labels,
    "events_sequence_stride": q_events_sequence_stride,
    "sequence_index": q_sequence_index,
    "sequence_stride": q_sequence_stride,
    "sequence_windows_checksum": q_sequence_windows_checksum,
    "sensor_summary": q_sensor_summary,
    "low_variance_sensors": q_low_variance_sensors,
    "sensor_intersection": q_sensor_intersection,
    "kept_sensors": q_kept_sensors,
    "unit_split": q_unit_split,
    "split_counts": q_split_counts,
    "validation_rows": q_validation_rows,
    "null_feature_units": q_null_feature_units,
    "regression_metrics": q_regression_metrics,
    "metrics_by_split": q_metrics_by_split,
    "metric_bounds": q_metric_bounds,
    "model_comparison": q_model_comparison,
    "fingerprint": q_fingerprint,
    "fingerprint_ordered": q_fingerprint_ordered,
    "paired_metrics": q_paired_metrics,
    "rolling_features_split": q_rolling_features_split,
    "sequence_windows_split": q_sequence_windows_split,
    "packed_sequences": q_packed_sequences,
    "unplaced_rows": q_unplaced_rows,
    "stream_features": q_stream_features,
    "stream_late_rows": q_stream_late_rows,
    "benchmark_counts": q_benchmark_counts,
    "published_run_log": q_published_run_log,
    "latest_row_per_unit": q_latest_row_per_unit,
    "dedupe_keep_last": q_dedupe_keep_last,
    "unit_trajectory": q_unit_trajectory,
    "normalize_ids": q_normalize_ids,
    "test_rul_tail": q_test_rul_tail,
    "text_source_cycles": q_text_source_cycles,
    "text_source_truth": q_text_source_truth,
    "availability_grid": q_availability_grid,
    "request_rejects": q_request_rejects,
    "request_latest_features": q_request_latest_features,
    "rf_validation_metrics": q_rf_validation_metrics,
    "rf_feature_importances": q_rf_feature_importances,
    "rf_batch_scores": q_rf_batch_scores,
    "test_set_metrics": q_test_set_metrics,
    "sequence_regressor_history": q_sequence_regressor_history,
    "benchmark_summary": q_benchmark_summary,
    "stream_scores": q_stream_scores,
}


# --------------------------------------------------------------------------
# DuckDB oracle side
# --------------------------------------------------------------------------

_FA = """fa AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 'FD001' WHEN 'N' THEN 'FD002' ELSE 'FD003' END AS dataset_id,
         CAST(l_suppkey AS BIGINT) AS unit_id,
         CAST(row_number() OVER (PARTITION BY l_returnflag, l_suppkey
              ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS INTEGER) AS cycle,
         l_quantity AS sensor_1, l_extendedprice AS sensor_2, l_discount AS sensor_3,
         l_tax AS sensor_4, CAST(518.67 AS DOUBLE) AS sensor_5
  FROM lineitem)"""

_FB = """fb AS (
  SELECT 'FD004' AS dataset_id, CAST(user_id AS BIGINT) AS unit_id,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS cycle,
         value AS sensor_1, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS sensor_2
  FROM events)"""

_LAB = """lab AS (
  SELECT *, CAST(max(cycle) OVER (PARTITION BY dataset_id, unit_id) - cycle AS INTEGER) AS rul_raw
  FROM fa)"""

_TRUTH = """truth AS (
  SELECT d.dataset_id, CAST(s_suppkey AS BIGINT) AS unit_id,
         CAST(s_suppkey % 50 + 10 AS INTEGER) AS final_rul
  FROM supplier, (VALUES ('FD001'), ('FD002'), ('FD003')) AS d(dataset_id) {where})"""

_W = "PARTITION BY dataset_id, unit_id ORDER BY cycle"


def _frame(n: int) -> str:
    return f"({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _mean_sql(s: str, n: int, mp: int = 1) -> str:
    f = _frame(n)
    if mp == 1:
        return f"avg({s}) OVER {f}"
    return f"CASE WHEN count({s}) OVER {f} >= {mp} THEN avg({s}) OVER {f} END"


def _std_sql(s: str, n: int, mp: int = 1) -> str:
    f = _frame(n)
    if mp == 1:
        return f"coalesce(stddev_pop({s}) OVER {f}, 0)"
    return f"coalesce(CASE WHEN count({s}) OVER {f} >= {mp} THEN stddev_pop({s}) OVER {f} END, 0)"


def _feature_select(sensors, windows, lags, rounding=6):
    cols = []
    for s in sensors:
        for n in windows:
            cols.append(f"round({_mean_sql(s, n)}, {rounding}) AS {s}_roll_mean_w{n}")
            cols.append(f"round({_std_sql(s, n)}, {rounding}) AS {s}_roll_std_w{n}")
        for l in lags:
            cols.append(f"lag({s}, {l}) OVER ({_W}) AS {s}_lag_{l}")
    return ",\n  ".join(cols)


def _not_null(names):
    return " AND ".join(f"{c} IS NOT NULL" for c in names)


_SPLIT = """units AS (SELECT DISTINCT dataset_id, unit_id FROM {src}),
hashed AS (
  SELECT *, CAST(('0x' || substr(md5('42:' || dataset_id || ':' || CAST(unit_id AS VARCHAR)), 1, 15)) AS BIGINT) AS h
  FROM units),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY h, unit_id) AS rk,
         count(*) OVER (PARTITION BY dataset_id) AS n
  FROM hashed),
split AS (
  SELECT dataset_id, unit_id,
         (n >= 2 AND rk <= greatest(1, least(n - 1, CAST(round_even(n * CAST(0.2 AS DOUBLE), 0) AS BIGINT)))) AS is_validation
  FROM ranked)"""

_PRED = """pred AS (
  SELECT dataset_id, unit_id, cycle, CAST(least(rul_raw, 125) AS INTEGER) AS rul,
         least(rul_raw, 125) + sensor_1 - CAST(25.5 AS DOUBLE) AS prediction
  FROM lab)"""

_METRICS = """sqrt(avg((prediction - rul) * (prediction - rul))) AS rmse,
  avg(abs(prediction - rul)) AS mae,
  sum(CASE WHEN prediction - rul < 0 THEN exp(-(prediction - rul) / 13.0) - 1
           ELSE exp((prediction - rul) / 10.0) - 1 END) AS nasa_score"""

_SUMMARY_LONG = """long AS (
  UNPIVOT (SELECT dataset_id, unit_id, sensor_1, sensor_2, sensor_3, sensor_4, sensor_5 FROM fa)
  ON sensor_1, sensor_2, sensor_3, sensor_4, sensor_5 INTO NAME sensor VALUE value),
gstats AS (
  SELECT dataset_id, sensor, avg(value) AS global_mean, stddev_pop(value) AS global_std,
         var_pop(value) AS global_var,
         quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS global_iqr
  FROM long GROUP BY dataset_id, sensor),
usd AS (
  SELECT dataset_id, unit_id, sensor, coalesce(stddev_pop(value), 0) AS sd
  FROM long GROUP BY dataset_id, unit_id, sensor),
pu AS (
  SELECT dataset_id, sensor, avg(sd) AS mean_unit_std, quantile_cont(sd, 0.5) AS median_unit_std,
         max(sd) AS max_unit_std
  FROM usd GROUP BY dataset_id, sensor),
summary AS (SELECT * FROM gstats JOIN pu USING (dataset_id, sensor))"""

_DROPPED = "(VALUES ('sensor_1'), ('sensor_5'), ('sensor_6'), ('sensor_10'), ('sensor_16'), ('sensor_18'), ('sensor_19')) AS d(sensor)"

_NORM = """CASE WHEN regexp_matches(upper(trim({x})), '^(FD)?[0-9]+$')
          AND TRY_CAST(regexp_extract(upper(trim({x})), '^(FD)?([0-9]+)$', 2) AS DECIMAL(38,0)) BETWEEN 1 AND 4
     THEN 'FD' || lpad(CAST(CAST(regexp_extract(upper(trim({x})), '^(FD)?([0-9]+)$', 2) AS DECIMAL(38,0)) AS VARCHAR), 3, '0')
END"""


def _oracles() -> dict[str, str]:
    s4 = SENSORS4
    wide = feature_names(s4, (5, 15, 30), (1, 3, 5))
    lags = [f"{s}_lag_{l}" for s in s4 for l in (1, 3, 5)]
    ev_names = feature_names(["sensor_1", "sensor_2"], (5, 10), (1, 2))
    seq_w = "1 * CAST(CAST(sensor_1 AS REAL) AS DOUBLE) + 2 * CAST(CAST(sensor_3 AS REAL) AS DOUBLE) + 3 * CAST(CAST(sensor_4 AS REAL) AS DOUBLE)"
    q: dict[str, str] = {}
    q["rul_labels"] = f"""WITH {_FA}, {_LAB}
SELECT dataset_id, unit_id, cycle, rul_raw, CAST(least(rul_raw, 125) AS INTEGER) AS rul FROM lab"""
    q["rul_labels_uncapped"] = f"""WITH {_FA}, {_LAB}
SELECT dataset_id, unit_id, cycle, rul_raw AS rul FROM lab"""
    q["rul_test_labels"] = f"""WITH {_FA}, {_TRUTH.format(where='')},
raw AS (
  SELECT fa.dataset_id, fa.unit_id, fa.cycle,
         CAST(max(fa.cycle) OVER (PARTITION BY fa.dataset_id, fa.unit_id) + t.final_rul - fa.cycle AS INTEGER) AS rul_raw
  FROM fa LEFT JOIN truth t ON fa.dataset_id = t.dataset_id AND fa.unit_id = t.unit_id)
SELECT dataset_id, unit_id, cycle, rul_raw, CAST(least(rul_raw, 125) AS INTEGER) AS rul FROM raw"""
    q["missing_truth_units"] = f"""WITH {_FA}, {_TRUTH.format(where='WHERE s_suppkey % 7 <> 0')}
SELECT DISTINCT dataset_id, unit_id FROM fa
WHERE NOT EXISTS (SELECT 1 FROM truth t WHERE t.dataset_id = fa.dataset_id AND t.unit_id = fa.unit_id)"""
    q["rolling_mean"] = f"""WITH {_FA}
SELECT dataset_id, unit_id, cycle,
  {", ".join(f"round({_mean_sql(s, n)}, 6) AS {s}_roll_mean_w{n}" for s in s4 for n in (5, 15, 30))}
FROM fa"""
    q["rolling_std"] = f"""WITH {_FA}
SELECT dataset_id, unit_id, cycle,
  {", ".join(f"round({_std_sql(s, n)}, 6) AS {s}_roll_std_w{n}" for s in s4 for n in (5, 15, 30))}
FROM fa"""
    q["rolling_min_periods"] = f"""WITH {_FA},
g AS (SELECT dataset_id, unit_id, cycle, CASE WHEN cycle % 17 = 0 THEN NULL ELSE sensor_1 END AS sensor_1 FROM fa)
SELECT dataset_id, unit_id, cycle,
  round({_mean_sql('sensor_1', 5, 3)}, 6) AS sensor_1_roll_mean_w5,
  round({_std_sql('sensor_1', 5, 3)}, 6) AS sensor_1_roll_std_w5
FROM g"""
    q["lag_features"] = f"""WITH {_FA},
f AS (SELECT dataset_id, unit_id, cycle, {", ".join(f"lag({s}, {l}) OVER ({_W}) AS {s}_lag_{l}" for s in s4 for l in (1, 3, 5))} FROM fa)
SELECT * FROM f WHERE {_not_null(lags)}"""
    q["rolling_features_wide"] = f"""WITH {_FA}, {_LAB},
f AS (SELECT dataset_id, unit_id, cycle, CAST(least(rul_raw, 125) AS INTEGER) AS rul,
  {_feature_select(s4, (5, 15, 30), (1, 3, 5))}
  FROM lab)
SELECT * FROM f WHERE {_not_null(wide)}"""
    q["events_rolling_features"] = f"""WITH {_FB},
f AS (SELECT dataset_id, unit_id, cycle,
  {_feature_select(["sensor_1", "sensor_2"], (5, 10), (1, 2))}
  FROM fb)
SELECT * FROM f WHERE {_not_null(ev_names)}"""
    q["events_rul_labels"] = f"""WITH {_FB},
lab AS (SELECT *, CAST(max(cycle) OVER (PARTITION BY dataset_id, unit_id) - cycle AS INTEGER) AS rul_raw FROM fb)
SELECT dataset_id, unit_id, cycle, rul_raw, CAST(least(rul_raw, 60) AS INTEGER) AS rul FROM lab"""
    q["events_sequence_stride"] = f"""WITH {_FB},
r AS (SELECT *, max(cycle) OVER (PARTITION BY dataset_id, unit_id) - cycle AS rul_raw,
             row_number() OVER ({_W}) AS rn FROM fb)
SELECT dataset_id, unit_id, cycle, CAST(least(rul_raw, 60) AS FLOAT) AS rul, CAST(10 AS INTEGER) AS steps
FROM r WHERE rn >= 10 AND (rn - 10) % 3 = 0"""
    q["sequence_index"] = f"""WITH {_FA}, {_LAB},
r AS (SELECT *, row_number() OVER ({_W}) AS rn FROM lab)
SELECT dataset_id, unit_id, cycle, CAST(least(rul_raw, 125) AS FLOAT) AS rul FROM r WHERE rn >= 30"""
    q["sequence_stride"] = f"""WITH {_FA}, {_LAB},
r AS (SELECT *, row_number() OVER ({_W}) AS rn FROM lab)
SELECT dataset_id, unit_id, cycle, CAST(least(rul_raw, 125) AS FLOAT) AS rul FROM r
WHERE rn >= 30 AND (rn - 30) % 7 = 0"""
    q["sequence_windows_checksum"] = f"""WITH {_FA},
r AS (SELECT *, row_number() OVER ({_W}) AS rn, {seq_w} AS w FROM fa),
s AS (SELECT dataset_id, unit_id, cycle, rn,
        sum(rn * w) OVER {_frame(30)} AS s1, sum(w) OVER {_frame(30)} AS s0 FROM r)
SELECT dataset_id, unit_id, cycle, CAST(30 AS INTEGER) AS steps, round(s1 - (rn - 30) * s0, 4) AS checksum
FROM s WHERE rn >= 30"""
    q["sensor_summary"] = f"""WITH {_FA}, {_SUMMARY_LONG}
SELECT dataset_id, sensor, {", ".join(f"CASE WHEN abs({c}) < 1000 THEN round({c}, 8) ELSE round({c}, 2) END AS {c}" for c in SUMMARY_COLS)} FROM summary"""
    q["low_variance_sensors"] = f"""WITH {_FA}, {_SUMMARY_LONG}
SELECT dataset_id, sensor FROM summary WHERE mean_unit_std <= 0.05"""
    q["sensor_intersection"] = f"""WITH {_FA}, {_SUMMARY_LONG}
SELECT sensor FROM summary WHERE mean_unit_std <= 0.05
INTERSECT SELECT sensor FROM {_DROPPED}"""
    q["kept_sensors"] = f"""WITH {_FA},
present AS (
  SELECT sensor FROM (UNPIVOT (SELECT count(sensor_1) AS sensor_1, count(sensor_2) AS sensor_2,
      count(sensor_3) AS sensor_3, count(sensor_4) AS sensor_4, count(sensor_5) AS sensor_5 FROM fa)
    ON sensor_1, sensor_2, sensor_3, sensor_4, sensor_5 INTO NAME sensor VALUE n) WHERE n > 0)
SELECT sensor FROM present EXCEPT ALL SELECT sensor FROM {_DROPPED}"""
    q["unit_split"] = f"""WITH {_FA}, {_SPLIT.format(src='fa')}
SELECT dataset_id, unit_id, is_validation FROM split"""
    q["split_counts"] = f"""WITH {_FA}, {_SPLIT.format(src='fa')}
SELECT fa.dataset_id, s.is_validation, CAST(count(DISTINCT fa.unit_id) AS BIGINT) AS units,
       CAST(count(*) AS BIGINT) AS rows
FROM fa JOIN split s USING (dataset_id, unit_id) GROUP BY fa.dataset_id, s.is_validation"""
    q["validation_rows"] = f"""WITH {_FA}, {_SPLIT.format(src='fa')}
SELECT dataset_id, unit_id, cycle, sensor_1 FROM fa
WHERE EXISTS (SELECT 1 FROM split s WHERE s.is_validation AND s.dataset_id = fa.dataset_id AND s.unit_id = fa.unit_id)"""
    q["null_feature_units"] = f"""WITH {_FA}
SELECT dataset_id, unit_id, CAST(count(*) AS BIGINT) AS null_rows FROM fa
WHERE cycle % 17 = 0 OR sensor_2 IS NULL OR isnan(sensor_2)
GROUP BY dataset_id, unit_id"""
    q["regression_metrics"] = f"""WITH {_FA}, {_LAB}, {_PRED}
SELECT dataset_id, round(rmse, 8) AS rmse, round(mae, 8) AS mae, round(nasa_score, 4) AS nasa_score
FROM (SELECT dataset_id, {_METRICS} FROM pred GROUP BY dataset_id)"""
    q["metrics_by_split"] = f"""WITH {_FA}, {_LAB}, {_PRED}, {_SPLIT.format(src='pred')}
SELECT dataset_id, is_validation, round(rmse, 8) AS rmse, round(mae, 8) AS mae, round(nasa_score, 4) AS nasa_score
FROM (SELECT p.dataset_id, s.is_validation, {_METRICS}
      FROM pred p JOIN split s USING (dataset_id, unit_id) GROUP BY p.dataset_id, s.is_validation)"""
    q["model_comparison"] = f"""WITH {_FA}, {_LAB}, {_PRED},
p2 AS (SELECT p.dataset_id, p.rul, p.rul + (fa.sensor_3 * 100 - 5) AS prediction
       FROM pred p JOIN fa USING (dataset_id, unit_id, cycle)),
a AS (SELECT dataset_id, 'quantity_offset' AS model, {_METRICS}, CAST(NULL AS DOUBLE) AS loss
      FROM pred GROUP BY dataset_id),
b AS (SELECT dataset_id, 'discount_offset' AS model, {_METRICS},
             avg((prediction - rul) * (prediction - rul)) AS loss
      FROM p2 GROUP BY dataset_id)
SELECT dataset_id, model, round(rmse, 8) AS rmse, round(mae, 8) AS mae, round(nasa_score, 4) AS nasa_score,
       round(loss, 8) AS loss
FROM (SELECT * FROM a UNION ALL SELECT * FROM b)"""
    q["metric_bounds"] = f"""WITH {_FA}, {_LAB}, {_PRED}
SELECT dataset_id, round(least(min(rul), min(prediction)), 6) AS lower,
       round(greatest(max(rul), max(prediction)), 6) AS upper
FROM pred GROUP BY dataset_id"""
    values = ["dataset_id", "CAST(unit_id AS VARCHAR)", "CAST(cycle AS VARCHAR)", "CAST(least(rul_raw, 125) AS VARCHAR)"]
    digest_parts = ", ".join(f"coalesce(length({v}) || ':' || {v}, '\\N')" for v in values)
    q["fingerprint"] = f"""WITH {_FA}, {_LAB},
d AS (SELECT CAST(('0x' || substr(md5(concat_ws('|', {digest_parts})), 1, 15)) AS BIGINT) AS h FROM lab),
a AS (SELECT count(*) AS rows, CAST(sum(CAST(h AS HUGEINT)) AS VARCHAR) AS digest_sum, bit_xor(h) AS digest_xor FROM d)
SELECT rows, digest_sum, digest_xor,
       sha256(concat_ws(':', digest_sum, CAST(digest_xor AS VARCHAR), CAST(rows AS VARCHAR))) AS fingerprint
FROM a"""
    q["fingerprint_ordered"] = f"""WITH {_FA}, {_LAB},
d AS (SELECT cycle, dataset_id, unit_id, CAST(('0x' || substr(md5(concat_ws('|', {digest_parts})), 1, 15)) AS BIGINT) AS h FROM lab),
l AS (SELECT list(CAST(h AS HUGEINT) ORDER BY cycle DESC, dataset_id DESC, unit_id DESC, h DESC) AS hs, count(*) AS rows FROM d),
f AS (SELECT rows, CAST(list_reduce(list_concat([CAST(0 AS HUGEINT)], hs), lambda a, h: (a * {BASE} + h) % {PRIME}) AS BIGINT) AS digest_fold FROM l)
SELECT rows, digest_fold, sha256(concat_ws(':', CAST(digest_fold AS VARCHAR), CAST(rows AS VARCHAR))) AS fingerprint FROM f"""
    q["paired_metrics"] = f"""WITH {_FA}, {_LAB}, {_PRED},
a AS (SELECT rul FROM pred ORDER BY dataset_id, unit_id, cycle, rul),
b AS (SELECT prediction FROM pred ORDER BY cycle, unit_id, dataset_id, prediction),
m AS (SELECT count(*) AS pairs, {_METRICS} FROM a POSITIONAL JOIN b)
SELECT pairs, round(rmse, 8) AS rmse, round(mae, 8) AS mae, round(nasa_score, 2) AS nasa_score FROM m"""
    uneven = f"""{_FA},
uneven AS (SELECT dataset_id, unit_id, CAST(cycle - cycle % 3 AS INTEGER) AS cycle, sensor_1, sensor_2, sensor_3, sensor_4
  FROM fa WHERE cycle % 11 <> 4)"""
    tied = _W + ", sensor_1, sensor_2, sensor_3, sensor_4"
    q["rolling_features_split"] = f"""WITH {uneven}
SELECT dataset_id, unit_id, cycle, {", ".join(s4)},
  {_feature_select(s4, (5, 15), (1, 3)).replace(_W, tied)}
FROM uneven"""
    q["sequence_windows_split"] = f"""WITH {uneven},
l AS (SELECT *, CAST(least(max(cycle) OVER (PARTITION BY dataset_id, unit_id) - cycle, 125) AS INTEGER) AS rul FROM uneven),
r AS (SELECT *, row_number() OVER ({_W}, sensor_1, sensor_3, sensor_4, rul) AS rn, {seq_w} AS w FROM l),
f AS (SELECT *, sum(rn * w) OVER seq - (rn - 10) * sum(w) OVER seq AS checksum FROM r
  WINDOW seq AS (PARTITION BY dataset_id, unit_id ORDER BY rn ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
SELECT dataset_id, unit_id, cycle, CAST(rul AS REAL) AS rul, round(checksum, 4) AS checksum FROM f WHERE rn >= 10 AND (rn - 10) % 3 = 0"""
    q["packed_sequences"] = f"""WITH {_FA},
p AS (SELECT dataset_id, unit_id, row_number() OVER ({_W}) AS rn, count(*) OVER (PARTITION BY dataset_id, unit_id) AS n FROM fa),
e AS (SELECT dataset_id, unit_id, any_value(n) AS n, (rn - 1) // 64 AS piece,
    count(*) + CASE WHEN (rn - 1) // 64 > 0 THEN 29 ELSE 0 END AS stored,
    count(*) FILTER (rn >= 30 AND (rn - 30) % 7 = 0) AS windows
  FROM p GROUP BY dataset_id, unit_id, (rn - 1) // 64)
SELECT dataset_id, unit_id, CAST(sum(stored) AS BIGINT) AS stored, CAST(sum(windows) AS BIGINT) AS windows
FROM e WHERE windows > 0 GROUP BY dataset_id, unit_id"""
    q["unplaced_rows"] = f"""WITH {_FA}
SELECT dataset_id, unit_id AS unit, cycle AS at,
  'NULL ' || concat_ws(', ', CASE WHEN cycle % 13 = 0 THEN 'unit_id' END, CASE WHEN cycle % 17 = 0 THEN 'cycle' END) AS problem
FROM fa WHERE cycle % 13 = 0 OR cycle % 17 = 0"""
    arrivals = f"""{_FB},
arrived AS (
  SELECT dataset_id, unit_id, cycle, sensor_1 + CASE WHEN cycle % 10 = 3 THEN 1000.0 ELSE 0.0 END AS sensor_1, sensor_2, 1 AS arrival FROM fb WHERE (cycle * 7) % 4 < 2
  UNION ALL SELECT dataset_id, unit_id, cycle, sensor_1, sensor_2, 2 FROM fb WHERE (cycle * 7) % 4 >= 2 OR cycle % 10 = 3
  UNION ALL SELECT dataset_id, unit_id, cycle, sensor_1 + 500.0, sensor_2, 3 FROM fb WHERE cycle % 7 = 0)"""
    q["stream_features"] = f"""WITH {arrivals},
last AS (SELECT * FROM arrived QUALIFY row_number() OVER (PARTITION BY dataset_id, unit_id, cycle ORDER BY arrival DESC) = 1),
f AS (SELECT dataset_id, unit_id, cycle, row_number() OVER (PARTITION BY dataset_id, unit_id ORDER BY cycle DESC) AS back,
  {_feature_select(["sensor_1", "sensor_2"], (5, 15, 30), (1, 3, 5))} FROM last)
SELECT * EXCLUDE (back) FROM f WHERE back = 1"""
    # late: thirty greater cycles, and at least one more cycle, came with earlier arrivals
    q["stream_late_rows"] = f"""WITH {arrivals},
seen AS (SELECT a.dataset_id, a.unit_id, a.arrival, a.cycle,
    count(DISTINCT b.cycle) FILTER (b.cycle > a.cycle) AS greater, count(DISTINCT b.cycle) AS n
  FROM arrived a JOIN arrived b ON a.dataset_id = b.dataset_id AND a.unit_id = b.unit_id AND b.arrival < a.arrival
  GROUP BY a.dataset_id, a.unit_id, a.arrival, a.cycle)
SELECT dataset_id, unit_id, CAST(count(*) AS BIGINT) AS late_rows FROM seen WHERE greater >= 30 AND n > 30 GROUP BY dataset_id, unit_id"""
    q["benchmark_counts"] = f"""WITH {_FA}, {_SPLIT.format(src='fa')},
n AS (SELECT dataset_id, unit_id, count(*) AS rows FROM fa GROUP BY dataset_id, unit_id)
SELECT dataset_id, is_validation, count(*) AS units, CAST(sum(rows - 5) AS BIGINT) AS rows,
  CAST(sum(greatest(rows - 29, 0)) AS BIGINT) AS sequence_samples
FROM n JOIN split USING (dataset_id, unit_id) GROUP BY dataset_id, is_validation"""
    q["availability_grid"] = f"""WITH {_FA}
SELECT 'FD004' AS dataset_id, f AS missing_file, CAST(NULL AS BIGINT) AS train_rows FROM (VALUES ('train_FD004.txt'), ('test_FD004.txt'), ('RUL_FD004.txt')) AS v(f)
UNION ALL SELECT dataset_id, NULL, count(*) FROM fa GROUP BY dataset_id"""
    q["published_run_log"] = f"""WITH {_FA}, {_SPLIT.format(src='fa')},
n AS (SELECT dataset_id, unit_id, count(*) AS rows FROM fa GROUP BY dataset_id, unit_id),
w AS (SELECT dataset_id,
    CAST(count(*) FILTER (NOT is_validation) AS DOUBLE) AS train_units, CAST(count(*) FILTER (is_validation) AS DOUBLE) AS validation_units,
    CAST(sum(rows - 5) FILTER (NOT is_validation) AS DOUBLE) AS train_rows, CAST(sum(rows - 5) FILTER (is_validation) AS DOUBLE) AS validation_rows
  FROM n JOIN split USING (dataset_id, unit_id) GROUP BY dataset_id)
SELECT dataset_id || ' split' AS run_name, key, CAST(1 AS BIGINT) AS n, value
FROM (UNPIVOT w ON train_units, validation_units, train_rows, validation_rows INTO NAME key VALUE value)"""
    q["latest_row_per_unit"] = f"""WITH {_FA}
SELECT dataset_id, unit_id, cycle, sensor_1, sensor_2, sensor_3, sensor_4 FROM fa
QUALIFY row_number() OVER (PARTITION BY dataset_id, unit_id ORDER BY cycle DESC) = 1"""
    q["dedupe_keep_last"] = f"""WITH {_FA},
dup AS (SELECT dataset_id, unit_id, CAST(ceil(cycle / 2.0) AS INTEGER) AS slot, cycle AS arrival,
               sensor_1, sensor_2, sensor_3, sensor_4 FROM fa)
SELECT dataset_id, unit_id, slot AS cycle, arrival, sensor_1, sensor_2, sensor_3, sensor_4 FROM dup
QUALIFY row_number() OVER (PARTITION BY dataset_id, unit_id, slot ORDER BY arrival DESC) = 1"""
    q["unit_trajectory"] = f"""WITH {_FA}
SELECT cycle, sensor_1, sensor_2, sensor_3, sensor_4 FROM fa
WHERE dataset_id = 'FD001' AND unit_id = (SELECT min(unit_id) FROM fa WHERE dataset_id = 'FD001')"""
    q["normalize_ids"] = f"""WITH raw AS (
  SELECT s_suppkey,
    CASE WHEN s_suppkey % 4 = 0 THEN ' fd' || lpad(CAST(s_suppkey % 6 AS VARCHAR), 3, '0') || ' '
         WHEN s_suppkey % 4 = 1 THEN 'FD' || CAST(s_suppkey % 6 AS VARCHAR)
         WHEN s_suppkey % 4 = 2 THEN CAST(s_suppkey % 6 AS VARCHAR)
         ELSE 'x' || CAST(s_suppkey % 6 AS VARCHAR) END AS raw,
    'fd00' || CAST(s_suppkey % 5 AS VARCHAR) AS second
  FROM supplier),
n AS (SELECT s_suppkey, {_NORM.format(x='raw')} AS a, {_NORM.format(x='second')} AS b FROM raw)
SELECT s_suppkey, a AS fd_id,
       concat_ws(',', a, CASE WHEN a IS NULL OR b <> a THEN b END) AS ids
FROM n"""
    q["test_rul_tail"] = f"""WITH {_FA}, {_TRUTH.format(where='')},
last AS (SELECT dataset_id, unit_id, max(cycle) AS cycle FROM fa GROUP BY dataset_id, unit_id)
SELECT l.dataset_id, l.unit_id, l.cycle, t.final_rul AS rul
FROM last l LEFT JOIN truth t USING (dataset_id, unit_id)"""
    q["text_source_cycles"] = f"""WITH {_FA}
SELECT dataset_id, unit_id, cycle, sensor_1, sensor_2, sensor_3, sensor_4 FROM fa"""
    q["text_source_truth"] = f"""WITH {_TRUTH.format(where='')}
SELECT dataset_id, CAST(row_number() OVER (PARTITION BY dataset_id ORDER BY unit_id) AS BIGINT) AS unit_id, final_rul
FROM truth"""
    chunk = "CAST(floor((cycle - 1) / 40.0) AS BIGINT)"
    q["request_rejects"] = f"""WITH {_FA},
c AS (SELECT dataset_id, unit_id, {chunk} AS chunk, count(*) AS n FROM fa GROUP BY ALL),
v AS (SELECT *, (unit_id * 7 + chunk) % 10 AS v FROM c)
SELECT dataset_id || ':' || CAST(unit_id AS VARCHAR) || ':' || CAST(chunk AS VARCHAR) AS request_id,
       CASE WHEN v = 5 THEN CAST(0 AS BIGINT) ELSE unit_id END AS unit_id,
       CAST(422 AS INTEGER) AS status,
       CASE WHEN v = 1 THEN 'extra fields not permitted: extra'
            WHEN v = 5 OR unit_id < 1 THEN 'unit_id must be an integer >= 1'
            WHEN v = 4 THEN 'records must contain at least 1 item'
            WHEN v = 2 THEN 'Missing required fields in a record'
            WHEN v = 3 THEN 'cycle must be an integer >= 1'
            ELSE 'Fewer cycles than the features need: send 6 or more (the largest lag is 5), 30 for full windows.' END AS detail
FROM v WHERE v BETWEEN 1 AND 5 OR n < 6 OR unit_id < 1"""
    rs = [c for c in SENSOR_COLUMNS if c not in DROPPED_SENSORS]
    sent = ", ".join(f"{c}" if c in s4 else f"CAST({'518.67' if c == 'sensor_5' else '0'} AS DOUBLE) AS {c}" for c in rs if c != "sensor_2")
    wreq = "PARTITION BY dataset_id, unit_id, chunk ORDER BY cycle"
    req_cols = []
    for s_ in rs:
        for n_ in (5, 15, 30):
            fr = f"({wreq} ROWS BETWEEN {n_ - 1} PRECEDING AND CURRENT ROW)"
            req_cols.append(f"round(avg({s_}) OVER {fr}, 6) AS {s_}_roll_mean_w{n_}")
            req_cols.append(f"round(coalesce(stddev_pop({s_}) OVER {fr}, 0), 6) AS {s_}_roll_std_w{n_}")
        for l_ in (1, 3, 5):
            req_cols.append(f"lag({s_}, {l_}) OVER ({wreq}) AS {s_}_lag_{l_}")
    q["request_latest_features"] = f"""WITH {_FA},
c AS (SELECT *, {chunk} AS chunk FROM fa),
cn AS (SELECT *, count(*) OVER (PARTITION BY dataset_id, unit_id, chunk) AS n,
              max(cycle) OVER (PARTITION BY dataset_id, unit_id, chunk) AS last_cycle,
              (unit_id * 7 + chunk) % 10 AS v FROM c),
adj AS (SELECT dataset_id, unit_id, chunk, cycle,
               CASE WHEN v = 6 AND cycle = last_cycle THEN sensor_2 + 1000.0 ELSE sensor_2 END AS sensor_2,
               {sent}
        FROM cn WHERE NOT (v BETWEEN 1 AND 5) AND n >= 6 AND unit_id >= 1),
f AS (SELECT dataset_id || ':' || CAST(unit_id AS VARCHAR) || ':' || CAST(chunk AS VARCHAR) AS request_id,
             unit_id, cycle, {", ".join(req_cols)},
             row_number() OVER (PARTITION BY dataset_id, unit_id, chunk ORDER BY cycle DESC) AS r
      FROM adj)
SELECT * EXCLUDE (r) FROM f WHERE r = 1"""
    return q


ORACLE_SQL: dict[str, str] = _oracles()
