"""Total orders: ordinals over range partitions, ordered fingerprints, pairs by position, repeated cycles in every layout, packed sequences, strict NULLs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearlog.operators.features import build_rolling_features
from wearlog.operators.fingerprint import fingerprint_value, fold_digests, join_runs
from wearlog.operators.labels import add_rul_targets, add_test_rul_targets, unplaced_rows
from wearlog.operators.metrics import pair_by_position, regression_metrics
from wearlog.operators.sequences import create_sequence_dataset, pack_sequences, slice_windows
from wearlog.operators.split import split_units
from wearlog.operators.unit_layout import table_ordinals, with_ordinals

KEYS = ["dataset_id", "unit_id"]


@pytest.fixture(scope="module")
def uneven(spark):
    """Units with repeated and missing cycles, whole rows repeated, one hot cycle; columns beside the sensors."""
    rng, rows = np.random.default_rng(4), []
    for unit in range(4):
        cycle = 0
        for _ in range(int(rng.integers(20, 60))):
            cycle += int(rng.integers(0, 4))
            rows.append(("F", unit, cycle, float(rng.integers(0, 3)), float(rng.integers(0, 2)) if rng.random() < 0.9 else None, int(rng.integers(0, 5)), 50 - cycle))
    rows += [("F", 9, 3, float(i % 7), 1.0, i % 3, 5) for i in range(150)] + rows[:20]
    return spark.createDataFrame(rows, "dataset_id string, unit_id long, cycle int, a double, b double, note int, rul int").repartition(5)


def rows_of(df):
    norm = lambda v: round(v, 9) if isinstance(v, float) else str(v) if isinstance(v, list) else v
    return sorted(([norm(v) for v in r] for r in df.collect()), key=repr)


def test_ordinals_are_exact_under_ties_and_hot_values(uneven):
    got = with_ordinals(uneven, ["cycle", "a", "b", "note", "rul"], KEYS).collect()
    null_first = lambda v: (v is not None, v or 0)
    for unit in {r.unit_id for r in got}:
        own = sorted((r for r in got if r.unit_id == unit), key=lambda r: r._ordinal)
        assert [r._ordinal for r in own] == list(range(len(own)))
        keys = [(r.cycle, r.a, null_first(r.b), r.note, r.rul) for r in own]
        assert keys == sorted(keys)
    assert sorted(r._ordinal for r in with_ordinals(uneven, ["cycle"]).collect()) == list(range(uneven.count()))
    assert with_ordinals(uneven.limit(0), ["cycle"], KEYS).count() == 0


def test_table_ordinals_follow_the_table(spark):
    df = spark.range(0, 100, 1, 7).withColumn("v", F.col("id") * 2)
    assert all(r._ordinal == r.id for r in table_ordinals(df).collect())


def test_ordered_fingerprint_sees_order_and_nothing_else(spark):
    rows = [(1, "x"), (2, "y"), (3, None), (3, "z"), (3, "z")]
    df = spark.createDataFrame(rows, "t int, s string")
    whole = fingerprint_value(df, ["s"], ["t"])
    assert {fingerprint_value(df.repartition(n), ["s"], ["t"]) for n in (1, 3, 7)} == {whole}
    swapped = spark.createDataFrame([(2, "x"), (1, "y"), *rows[2:]], "t int, s string")
    assert fingerprint_value(swapped, ["s"], ["t"]) != whole
    assert fingerprint_value(swapped, ["s"]) == fingerprint_value(df, ["s"])
    assert fingerprint_value(df.limit(4), ["s"], ["t"]) != whole
    assert fingerprint_value(df.limit(0), ["s"], ["t"]) == fingerprint_value(df.limit(0), ["s", "t"], ["s"])


def test_runs_join_in_any_grouping():
    digests = [int(x) for x in np.random.default_rng(1).integers(0, 2**60, 50)]
    for cut in (0, 1, 20, 50):
        assert join_runs(fold_digests(digests[:cut]), fold_digests(digests[cut:])) == fold_digests(digests)
    a, b, c = (fold_digests(digests[i::3]) for i in range(3))
    assert join_runs(join_runs(a, b), c) == join_runs(a, join_runs(b, c))


def test_pairs_by_position(spark):
    labels = spark.createDataFrame([(i, float(i)) for i in range(50)], "k int, rul double").repartitionByRange(4, "k").sortWithinPartitions("k")
    guesses = spark.createDataFrame([(i, i + 1.0) for i in range(50)], "other int, prediction double").repartition(3)
    pairs = pair_by_position(labels, guesses, prediction_order=["other"])
    assert regression_metrics(pairs).first().mae == 1.0 and pairs.count() == 50
    with pytest.raises(ValueError, match="50 labels .* 49 predictions"):
        pair_by_position(labels, guesses.where("other > 0"))
    loose = pair_by_position(labels, guesses.where("other > 0"), prediction_order=["other"], validate=False)
    assert loose.where("prediction IS NULL").count() == 1


@pytest.mark.parametrize("width, hot_rows", [(8, 10), (16, 30), (64, 100)])
def test_features_do_not_depend_on_the_layout(uneven, width, hot_rows):
    plain = build_rolling_features(uneven, ["a", "b"], windows=(3, 5), lags=(1, 2), drop_na=False, include_original_sensors=True)
    split = build_rolling_features(uneven, ["a", "b"], windows=(3, 5), lags=(1, 2), drop_na=False, include_original_sensors=True, width=width, hot_rows=hot_rows)
    assert rows_of(split.select(*plain.columns)) == rows_of(plain)


@pytest.mark.parametrize("width, hot_rows, piece", [(8, 10, 512), (16, 30, 8), (4096, 1 << 20, 6), (4096, 1 << 20, 512)])
def test_sequences_do_not_depend_on_layout_or_pieces(uneven, width, hot_rows, piece):
    def windows(w, h, p):
        packed = pack_sequences(uneven, ["a", "note"], "rul", KEYS, "cycle", 6, 4, width=w, hot_rows=h, piece_rows=p)
        return slice_windows(packed, 6, "rul", KEYS)

    got = rows_of(windows(width, hot_rows, piece))
    want = []
    for unit in {r.unit_id for r in uneven.collect()}:
        own = sorted(((r.cycle, r.a, r.note, r.rul) for r in uneven.where(F.col("unit_id") == unit).collect()))
        for s in range(0, len(own) - 5, 4):
            part = own[s : s + 6]
            want.append(["F", unit, part[-1][0], float(part[-1][3]), str([[float(x[1]), float(x[2])] for x in part])])
    assert got == sorted(want, key=repr)


def test_packed_pieces_store_each_row_about_once(spark):
    df = spark.createDataFrame([("F", 1, c, float(c), c) for c in range(1000)], "dataset_id string, unit_id long, cycle int, s double, rul int")
    packed = pack_sequences(df, ["s"], sequence_length=30, stride=7, piece_rows=200)
    rows = packed.collect()
    assert sum(len(r.x) for r in rows) == 1000 + 29 * (len(rows) - 1)
    assert sum(len(r.starts) for r in rows) == (1000 - 30) // 7 + 1
    assert pack_sequences(df, ["s"], sequence_length=1001).count() == 0


def test_missing_features_are_refused_when_read(uneven):
    with pytest.raises(Exception, match="NaN or NULL"):
        create_sequence_dataset(uneven, ["b"], "rul", sequence_length=3).count()
    assert create_sequence_dataset(uneven, ["b"], "rul", sequence_length=3, on_null="keep").count() > 0
    with pytest.raises(ValueError):
        create_sequence_dataset(uneven, ["b"], "rul", on_null="ignore")


def test_null_keys_and_cycles(spark):
    df = spark.createDataFrame([("F", 1, 1), ("F", 1, 2), (None, 1, 1), ("F", None, 1), ("F", 1, None), ("F", None, None)], "dataset_id string, unit_id long, cycle int")
    truth = spark.createDataFrame([("F", 1, 5)], "dataset_id string, unit_id long, final_rul int")
    with pytest.raises(Exception, match="NULL in a unit key or cycle"):
        add_rul_targets(df).collect()
    with pytest.raises(Exception, match="NULL in a unit key or cycle"):
        add_test_rul_targets(df, truth, validate=False).collect()
    assert add_rul_targets(df, on_null="drop").count() == 2 == add_test_rul_targets(df, truth, validate=False, on_null="drop").count()
    assert sorted(r.problem for r in unplaced_rows(df).collect()) == ["NULL cycle", "NULL dataset_id", "NULL unit_id", "NULL unit_id, cycle"]


def test_a_fleet_of_one_unit_cannot_be_split(spark):
    df = spark.createDataFrame([("F", 1), ("G", 1), ("G", 2)], "dataset_id string, unit_id long")
    with pytest.raises(Exception, match="two units"):
        split_units(df).collect()
    assert split_units(df.where("dataset_id = 'G'")).where("is_validation").count() == 1
