"""Structured Streaming scorer: cycle rows in, a score per updated unit out.

Each unit keeps its latest distinct cycles in Spark's state store
(``transformWithState``), as arrays of one value: a micro-batch reads the unit's state
with one request and writes it with one. Of rows for one cycle the last
arrival wins, by ``arrival_col``, wherever micro-batches are cut. The state holds as
many cycles as a feature row needs; a row older than a full state's oldest cycle
comes too late to be placed: it is left out and counted, and the counts are rows
of the output. ``cycle`` is a position, not event time, so there is no watermark;
units without rows for ``idle_timeout`` are dropped by a processing-time timer.

The state operator moves rows only. Features come from the same batch expressions
as everywhere else, applied to the emitted maps of each micro-batch
(:func:`buffer_features`), so there is one copy of the feature rules.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.features import build_rolling_features, check_feature_args, feature_names
from ..operators.latest import latest_row_per_unit
from ..schema import CYCLE, KEYS, require_columns
from ..session import scratch_path

WHOLE = "_whole"
LATE = "_late_rows"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class UnitBuffer(StatefulProcessor):
    """The latest ``capacity`` distinct cycles of a unit.

    Emits, for each unit that a micro-batch changes, every cycle it holds, and one
    row with the number of late rows if there are any.
    """

    def __init__(self, keys, cycle_col, arrival_col, arrival_type, sensors, capacity, idle_ms):
        self.keys, self.cycle_col, self.arrival_col = list(keys), cycle_col, arrival_col
        self.arrival_type, self.sensors, self.capacity, self.idle_ms = arrival_type, list(sensors), capacity, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        entry = T.StructType(
            [T.StructField("arrival", self.arrival_type), *(T.StructField(s, T.DoubleType()) for s in self.sensors)]
        )
        self.cycles = handle.getMapState("cycles", T.StructType([T.StructField("cycle", T.IntegerType())]), entry)
        self.evicted = handle.getValueState("evicted", T.StructType([T.StructField("evicted", T.BooleanType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [f[[self.cycle_col, self.arrival_col, *self.sensors]] for f in rows]
        fresh = [row for part in parts for row in zip(*(part[c].tolist() for c in part.columns))]
        out = self._placed(key, fresh, timerValues)
        if out:
            yield self._emit(out)

    def _placed(self, key, fresh: list[tuple], timerValues) -> list[tuple]:
        """Takes rows (cycle, arrival, sensors) of a unit into its state; the rows to emit."""
        held, evicted = self._read()
        late = 0
        if evicted:
            first = min(held)
            on_time = [row for row in fresh if row[0] >= first]
            late, fresh = len(fresh) - len(on_time), on_time
        known = set(held)
        changed = self._newest(fresh, held)
        held |= changed
        dropped = sorted(held)[: max(0, len(held) - self.capacity)]
        for cycle in dropped:
            del held[cycle]
        self._write(held, changed.keys() & held.keys(), [c for c in dropped if c in known], evicted, evicted or bool(dropped))
        if self.idle_ms:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        out = []
        if changed:
            # the oldest rows of a map that has dropped some lack history
            whole = evicted or bool(dropped)
            out = [(*key, c, *held[c][1:], not whole or i >= self.capacity - 1, None) for i, c in enumerate(sorted(held))]
        if late:
            out.append((*key, None, *(None for _ in self.sensors), None, late))
        return out

    def _read(self) -> tuple[dict, bool]:
        return {k[0]: tuple(v) for k, v in self.cycles.iterator()}, bool(self.evicted.exists())

    def _write(self, held: dict, changed, gone: Sequence[int], was: bool, evicted: bool) -> None:
        for cycle in gone:
            self.cycles.removeKey((cycle,))
        if evicted and not was:
            self.evicted.update((True,))
        for cycle in changed:
            self.cycles.updateValue((cycle,), held[cycle])

    def _newest(self, fresh: Sequence[tuple], held: dict) -> dict:
        """Of the rows, by cycle, those that arrived last and not before the one held."""
        missing = lambda v: v is None or v != v
        order = sorted(fresh, key=lambda row: (row[0], row[1], *((missing(v), 0.0 if missing(v) else v) for v in row[2:])))
        out = {}
        for cycle, arrival, *values in order:
            if cycle not in held or arrival >= held[cycle][0]:
                out[int(cycle)] = (arrival, *(None if missing(v) else float(v) for v in values))
        return out

    def _emit(self, rows: list[tuple]) -> pd.DataFrame:
        kinds = {self.cycle_col: "Int32", **dict.fromkeys(self.sensors, "Float64"), WHOLE: "boolean", LATE: "Int64"}
        return pd.DataFrame({name: pd.array(col, dtype=kinds.get(name)) for name, col in zip([*self.keys, *kinds], map(list, zip(*rows)))})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.cycles.clear()
        self.evicted.clear()
        return iter(())

    def close(self) -> None:
        pass


class PackedBuffer(UnitBuffer):
    """:class:`UnitBuffer` on rows, with a unit's cycles as the arrays of one value: a
    micro-batch reads a unit's state with one request and writes it with one, whatever
    the number of cycles that change (at most ``capacity`` are held)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        arrays = [T.ArrayType(T.IntegerType()), T.ArrayType(self.arrival_type), *(T.ArrayType(T.DoubleType()) for _ in self.sensors)]
        fields = [T.StructField(f"c{i}", kind) for i, kind in enumerate(arrays)]
        self.value = handle.getValueState("unit", T.StructType([*fields, T.StructField("evicted", T.BooleanType())]))

    def handleInputRows(self, key, rows, timerValues):
        fresh = [(row[self.cycle_col], row[self.arrival_col], *(row[s] for s in self.sensors)) for row in rows]
        names = [*self.keys, self.cycle_col, *self.sensors, WHOLE, LATE]
        for row in self._placed(tuple(key), fresh, timerValues):
            yield Row(**dict(zip(names, row)))

    def _read(self) -> tuple[dict, bool]:
        value = self.value.get()
        if value is None:
            return {}, False
        *columns, evicted = value
        return {row[0]: tuple(row[1:]) for row in zip(*columns)}, bool(evicted)

    def _write(self, held: dict, changed, gone: Sequence[int], was: bool, evicted: bool) -> None:
        if changed or gone or was != evicted:
            rows = [(cycle, *values) for cycle, values in sorted(held.items())]
            self.value.update((*map(list, zip(*rows)), evicted))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.value.clear()
        return iter(())


def history_rows(windows: Sequence[int], lags: Sequence[int]) -> int:
    """Rows a feature row needs, itself included."""
    return max(max(windows), max(lags, default=0) + 1)


def unit_buffers(
    stream: DataFrame,
    sensors: Sequence[str],
    arrival_col: str,
    windows: Sequence[int] = (5, 15, 30),
    lags: Sequence[int] = (1, 3, 5),
    keys: Sequence[str] = KEYS,
    cycle_col: str = CYCLE,
    idle_timeout: str | None = None,
) -> DataFrame:
    """Streaming rows of the units that change: keys, cycle, sensors, ``_whole``, ``_late_rows``.

    Rows without key, cycle or arrival cannot be placed and are left out. Needs the
    RocksDB state store, which this sets for the session.
    """
    keys, sensors = list(keys), list(sensors)
    windows, lags = check_feature_args(windows, lags, 1)
    require_columns(stream, [*keys, cycle_col, arrival_col, *sensors])
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    idle_ms = int(pd.Timedelta(idle_timeout).total_seconds() * 1000) if idle_timeout else None
    fields = {f.name: f for f in stream.schema.fields}
    out = T.StructType(
        [
            *(T.StructField(k, fields[k].dataType) for k in keys),
            T.StructField(cycle_col, T.IntegerType()),
            *(T.StructField(s, T.DoubleType()) for s in sensors),
            T.StructField(WHOLE, T.BooleanType()),
            T.StructField(LATE, T.LongType()),
        ]
    )
    rows = stream.select(
        *keys, F.col(cycle_col).cast("int").alias(cycle_col), arrival_col, *(F.col(s).cast("double").alias(s) for s in sensors)
    ).dropna(subset=[*keys, cycle_col, arrival_col])
    processor = PackedBuffer(
        keys, cycle_col, arrival_col, fields[arrival_col].dataType, sensors, history_rows(windows, lags), idle_ms
    )
    return rows.groupBy(*keys).transformWithState(
        statefulProcessor=processor,
        outputStructType=out,
        outputMode="Update",
        timeMode="ProcessingTime" if idle_ms else "None",
    )


def buffer_features(
    buffers: DataFrame,
    sensors: Sequence[str],
    windows: Sequence[int] = (5, 15, 30),
    lags: Sequence[int] = (1, 3, 5),
    keys: Sequence[str] = KEYS,
    cycle_col: str = CYCLE,
) -> DataFrame:
    """The newest complete feature row of each unit in a micro-batch of :func:`unit_buffers`."""
    rows = buffers.where(F.col(LATE).isNull()).drop(LATE)
    # a unit has at most a buffer of rows here, so none is hot
    feats = build_rolling_features(rows, sensors, windows, lags, keys, cycle_col, hot_rows=None)
    return latest_row_per_unit(feats.where(WHOLE).drop(WHOLE), keys=keys, cycle_col=cycle_col)


def late_counts(buffers: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Late rows of each unit in a micro-batch of :func:`unit_buffers`."""
    return buffers.where(F.col(LATE).isNotNull()).groupBy(*keys).agg(F.sum(LATE).alias("late_rows"))


def start_stream_scoring(
    buffers: DataFrame,
    sensors: Sequence[str],
    output_path: str,
    model: PipelineModel | None = None,
    model_name: str = "",
    windows: Sequence[int] = (5, 15, 30),
    lags: Sequence[int] = (1, 3, 5),
    keys: Sequence[str] = KEYS,
    cycle_col: str = CYCLE,
    query_name: str = "unit_scores",
    checkpoint: str | None = None,
    trigger: dict | None = None,
):
    """Write each micro-batch's scores (without ``model``: its feature rows) under
    ``output_path/scores/batch_id=N`` and its late counts under ``output_path/late/batch_id=N``.

    A re-run of a batch overwrites its own folders, so the sink is idempotent.
    State and progress live under the shared checkpoint folder."""
    checkpoint = checkpoint or scratch_path(buffers.sparkSession, "streams", query_name)
    names = feature_names(sensors, windows, lags)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            rows = buffer_features(batch, sensors, windows, lags, keys, cycle_col)
            if model is not None:
                rows = model.transform(rows).select(
                    *(c for c in rows.columns if c not in names),
                    F.lit(model_name).alias("model"),
                    F.col("prediction").alias("rul"),
                )
            rows.write.mode("overwrite").parquet(f"{output_path}/scores/batch_id={batch_id}")
            late_counts(batch, keys).write.mode("overwrite").parquet(f"{output_path}/late/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = (
        buffers.writeStream.outputMode("update")
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .queryName(query_name)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def latest_scores(spark: SparkSession, output_path: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Each unit's row of the last micro-batch that wrote one."""
    rows = spark.read.parquet(f"{output_path}/scores")
    cols = [c for c in rows.columns if c not in (*keys, "batch_id")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), "batch_id").alias("r")).select(*keys, "r.*")


def late_totals(spark: SparkSession, output_path: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Each unit's late rows over all micro-batches."""
    return spark.read.parquet(f"{output_path}/late").groupBy(*keys).agg(F.sum("late_rows").alias("late_rows"))
