"""The hot-unit path (units split into parts with a halo) must give exactly
the rows of the plain one-partition-per-unit path."""

import pytest
from pyspark.sql import functions as F

from wearlog.operators.features import build_labeled_features, build_rolling_features
from wearlog.operators.sequences import create_sequence_dataset
from wearlog.operators.unit_layout import row_ordinal, unit_layout
from wearlog.session import materialize
from wearlog.sources.fixtures import lineitem_cycles

from conftest import SF001

SENSORS = ["sensor_1", "sensor_2", "sensor_3"]


@pytest.fixture(scope="module")
def cycles(spark):
    return materialize(lineitem_cycles(spark, SF001), "test-cycles")


def _sorted(df, cols):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("strategy", ["auto-hot", "dense", "general"])
def test_split_units_match_plain_features(cycles, strategy):
    plain = build_labeled_features(cycles, SENSORS, windows=(3, 7), lags=(1, 4))
    kw = {"width": 16}
    if strategy == "auto-hot":
        kw["hot_rows"] = 50  # every unit (172-226 rows) is hot
    else:
        kw["strategy"] = strategy
    split = build_labeled_features(cycles, SENSORS, windows=(3, 7), lags=(1, 4), **kw)
    cols = plain.columns
    assert _sorted(plain, cols) == _sorted(split, cols)


def test_general_path_with_gaps_matches_plain(cycles):
    gappy = cycles.where((F.col("cycle") % 5 != 0) & (F.col("cycle") % 7 != 3))
    plain = build_rolling_features(gappy, SENSORS, windows=(4, 9), lags=(2,), drop_na=False)
    split = build_rolling_features(
        gappy, SENSORS, windows=(4, 9), lags=(2,), drop_na=False, width=16, hot_rows=40
    )
    cols = plain.columns
    assert _sorted(plain, cols) == _sorted(split, cols)


def test_sequences_split_match_plain(cycles):
    lab = build_labeled_features(cycles, ["sensor_1"], windows=(1,), lags=(), include_original_sensors=True)
    plain = create_sequence_dataset(lab, ["sensor_1", "sensor_2"], sequence_length=6, stride=4)
    split = create_sequence_dataset(
        lab, ["sensor_1", "sensor_2"], sequence_length=6, stride=4, width=16, hot_rows=30
    )
    cols = ["dataset_id", "unit_id", "cycle", "rul", "x"]
    a = sorted((r.dataset_id, r.unit_id, r.cycle, r.rul, str(r.x)) for r in plain.select(*cols).collect())
    b = sorted((r.dataset_id, r.unit_id, r.cycle, r.rul, str(r.x)) for r in split.select(*cols).collect())
    assert a == b and len(a) > 0


def test_row_ordinal_hot_matches_row_number(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date"))
    keys = ["l_returnflag", "l_suppkey"]
    plain = row_ordinal(li, keys, order, day, F.col("l_orderkey"), out="rn")
    hot = row_ordinal(li, keys, order, F.floor(day / 30), day, out="rn", hot_rows=10)
    cols = [*keys, *order, "rn"]
    assert _sorted(plain, cols) == _sorted(hot, cols)


def test_plain_layout_has_one_exchange(cycles):
    feats = build_rolling_features(cycles, SENSORS)
    plan = feats._jdf.queryExecution().executedPlan().toString()
    # cycles is a parquet table: the only shuffle is the window's.
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_layout_rejects_bad_arguments(cycles):
    with pytest.raises(ValueError):
        unit_layout(cycles, halo=-1)
    with pytest.raises(ValueError):
        unit_layout(cycles, halo=10, width=10)


def test_sequences_with_gaps_hot_general_match_plain(cycles):
    gappy = cycles.where(F.col("cycle") % 6 != 1).withColumn("rul", F.col("cycle"))
    plain = create_sequence_dataset(gappy, ["sensor_1"], sequence_length=7, stride=3)
    hot = create_sequence_dataset(gappy, ["sensor_1"], sequence_length=7, stride=3, width=16, hot_rows=20)
    a = sorted((r.dataset_id, r.unit_id, r.cycle, str(r.x)) for r in plain.collect())
    b = sorted((r.dataset_id, r.unit_id, r.cycle, str(r.x)) for r in hot.collect())
    assert a == b and len(a) > 0


def test_repeated_cycles_with_a_matching_row_count_are_split_right(spark):
    """Cycles 1,1,3..8 have as many rows as a gap-free unit; positions must still count rows."""
    from wearlog.operators.features import build_rolling_features

    cycles = [1, 1, 3, 4, 5, 6, 7, 8]
    df = spark.createDataFrame([("FD001", 1, c, float(c)) for c in cycles], "dataset_id string, unit_id long, cycle int, sensor_1 double")
    args = dict(sensor_columns_=["sensor_1"], windows=(3,), lags=(2,), drop_na=False)
    plain = sorted(map(tuple, build_rolling_features(df, **args).collect()), key=str)
    split = sorted(map(tuple, build_rolling_features(df, width=4, hot_rows=2, **args).collect()), key=str)
    assert plain == split


def test_nan_is_missing(spark):
    from wearlog.operators.features import build_rolling_features

    df = spark.createDataFrame([("FD001", 1, c, v) for c, v in enumerate([1.0, float("nan"), 3.0, 4.0], 1)], "dataset_id string, unit_id long, cycle int, sensor_1 double")
    rows = build_rolling_features(df, sensor_columns_=["sensor_1"], windows=(3,), lags=(1,), drop_na=False).orderBy("cycle").collect()
    assert [r.sensor_1_roll_mean_w3 for r in rows] == [1.0, 1.0, 2.0, 3.5] and [r.sensor_1_lag_1 for r in rows] == [None, 1.0, None, 3.0]
