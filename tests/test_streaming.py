"""The stateful stream scorer must end with the latest feature row per unit that the
batch operators give, however its rows are cut into micro-batches, and count late rows."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wearlog.operators.features import build_rolling_features, feature_names
from wearlog.operators.latest import dedupe_keep_last, latest_row_per_unit
from wearlog.plans.models import forest_pipeline
from wearlog.sources.fixtures import events_cycles
from wearlog.streaming.scoring import UnitBuffer, late_totals, latest_scores, start_stream_scoring, unit_buffers

from conftest import SF001

SENSORS = ["sensor_1", "sensor_2"]
KEYS = ["dataset_id", "unit_id"]


def run_stream(spark, batches, tmp_path, model=None):
    """Each frame is one run of the stream, which goes on from the last one's checkpoint."""
    out, schema = str(tmp_path / "out"), batches[0].schema
    for i, rows in enumerate(batches):
        rows.write.parquet(str(tmp_path / "in" / f"f{i}"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "*"))
        query = start_stream_scoring(
            unit_buffers(stream, SENSORS, "arrival"), SENSORS, out, model, "m", checkpoint=str(tmp_path / "state"), query_name=f"q{abs(hash(str(tmp_path)))}_{i}", trigger={"availableNow": True},
        )
        assert query.awaitTermination(120)
    return out


def same(batch, streamed):
    cols = batch.columns
    norm = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())
    got = norm(streamed)
    assert got == norm(batch) and got


def test_replay_out_of_order_equals_batch(spark, tmp_path):
    fb = events_cycles(spark, SF001).select(*KEYS, "cycle", *SENSORS).withColumn("arrival", F.lit(1))
    out = run_stream(spark, [fb.where((F.col("cycle") * 7) % 2 == k) for k in (1, 0)], tmp_path)
    same(latest_row_per_unit(build_rolling_features(fb.drop("arrival"), SENSORS)), latest_scores(spark, out))


def test_last_arrival_wins_within_and_across_batches(spark, tmp_path):
    fb = events_cycles(spark, SF001).select(*KEYS, "cycle", *SENSORS)
    send = lambda shift, arrival: fb.withColumn("sensor_1", F.col("sensor_1") + shift).withColumn("arrival", F.lit(arrival))
    recent = F.col("cycle") > 45
    # the right reading (arrival 3) comes first, older ones after it and beside it
    batches = [send(0, 3).where("cycle % 2 = 0").unionByName(send(50, 2).where("cycle % 2 = 0")), send(0, 3).where("cycle % 2 = 1").unionByName(send(70, 1).where(recent))]
    out = run_stream(spark, batches, tmp_path)
    both = batches[0].unionByName(batches[1])
    batch = latest_row_per_unit(build_rolling_features(dedupe_keep_last(both, "arrival").drop("arrival"), SENSORS))
    same(batch, latest_scores(spark, out))


def test_late_rows_are_counted_and_left_out(spark, tmp_path):
    schema = "dataset_id string, unit_id long, cycle int, sensor_1 double, sensor_2 double, arrival long"
    frame = lambda rows: spark.createDataFrame([(*r, 1) for r in rows], schema)
    rows = [("FD001", u, c, float(c), float(c % 3)) for u in (1, 2) for c in range(1, 61)]
    late = [("FD001", 1, 3, 999.0, 999.0), ("FD001", 1, 3, 998.0, 998.0), ("FD001", 1, 30, 1.0, 1.0), ("FD001", 3, 1, 5.0, 5.0), (None, 1, 1, 1.0, 1.0), ("FD001", None, 1, 1.0, 1.0), ("FD001", 2, None, 1.0, 1.0)]
    out = run_stream(spark, [frame(rows), frame(late)], tmp_path)
    same(latest_row_per_unit(build_rolling_features(frame(rows).drop("arrival"), SENSORS)), latest_scores(spark, out))
    assert [tuple(r) for r in late_totals(spark, out).collect()] == [("FD001", 1, 3)]


def test_scores_are_the_models(spark, tmp_path):
    fb = events_cycles(spark, SF001).select(*KEYS, "cycle", *SENSORS)
    feats = build_rolling_features(fb, SENSORS)
    names = feature_names(SENSORS, (5, 15, 30), (1, 3, 5))
    model = forest_pipeline(names, "cycle", num_trees=2, max_depth=3).fit(feats)
    out = run_stream(spark, [fb.withColumn("arrival", F.lit(1))], tmp_path, model=model)
    same(model.transform(latest_row_per_unit(feats)).select(*KEYS, "cycle", F.col("prediction").alias("rul")), latest_scores(spark, out))


def test_arrival_is_required(spark):
    with pytest.raises(TypeError):
        unit_buffers(spark.range(1), SENSORS)
    with pytest.raises(ValueError):
        unit_buffers(events_cycles(spark, SF001), SENSORS, "arrival")


class Held:
    """State of one unit without Spark."""

    def __init__(self):
        self.rows, self.flag, self.timers = {}, [], []

    def getMapState(self, *_):
        held = self.rows

        class M:
            iterator = staticmethod(lambda: iter([((k,), v) for k, v in held.items()]))
            containsKey = staticmethod(lambda k: k[0] in held)
            removeKey = staticmethod(lambda k: held.pop(k[0]))
            updateValue = staticmethod(lambda k, v: held.__setitem__(k[0], v))
            clear = staticmethod(held.clear)

        return M

    def getValueState(self, *_):
        flag = self.flag

        class V:
            exists = staticmethod(lambda: bool(flag))
            update = staticmethod(flag.append)
            clear = staticmethod(flag.clear)

        return V

    listTimers = lambda self: iter(self.timers)
    deleteTimer = lambda self, t: self.timers.remove(t)
    registerTimer = lambda self, t: self.timers.append(t)


class Clock:
    getCurrentProcessingTimeInMs = staticmethod(lambda: 1000)


@pytest.mark.parametrize("seed", range(6))
def test_buffer_is_the_same_for_any_cut_without_late_rows(seed):
    """The map holds the newest cycles' last arrivals, whatever the micro-batches; it never writes a cycle twice in one."""
    import numpy as np
    from pyspark.sql import types as T

    rng = np.random.default_rng(seed)
    rows = pd.DataFrame({"cycle": rng.integers(1, 12, 40), "arrival": rng.permutation(40), "s": rng.random(40)})
    state = Held()
    buffer = UnitBuffer(["u"], "cycle", "arrival", T.LongType(), ["s"], 30, 5000)
    buffer.init(state)
    for cut in np.array_split(rows, int(rng.integers(1, 6))):
        out = list(buffer.handleInputRows((7,), iter([cut]), Clock))
        assert sum(len(o) for o in out) == len(state.rows) and (out[0]["u"] == 7).all()
    want = rows.sort_values("arrival").drop_duplicates("cycle", keep="last")
    assert {c: v[0] for c, v in state.rows.items()} == dict(zip(want.cycle, want.arrival))
    assert state.timers == [6000]
    buffer.handleExpiredTimer((7,), Clock, None)
    assert not state.rows and not state.flag
