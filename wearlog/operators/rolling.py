"""Rolling and lag features of sorted rows, batch by batch, in Arrow tasks.

A window frame of Spark is folded anew for every row, so 14 sensors with windows of
5, 15 and 30 rows cost some 1,400 updates of an aggregate a row. Here the same folds
run over a whole batch at once: step k adds the value k rows before to every row's
sum, oldest first, with the arithmetic of ``avg`` and ``stddev_pop`` (a sum; the
running mean and moment), so results are the same to the last bit. Spark deals out
and sorts the rows; a task keeps the rows that the next batch reaches back to.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T

#: Types whose average and deviation are doubles, and keys that Arrow compares as Spark does.
NUMBERS = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.ByteType)
KEY_TYPES = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.StringType, T.DateType, T.BooleanType)
#: Types that go through Arrow unchanged.
PLAIN = (*NUMBERS, *KEY_TYPES, T.DecimalType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


def arrow_can(schema: T.StructType, sensors: Sequence[str], keys: Sequence[str]) -> bool:
    kinds = {f.name: f.dataType for f in schema.fields}
    return (
        all(isinstance(kinds[s], NUMBERS) for s in sensors)
        and all(isinstance(kinds[k], KEY_TYPES) for k in keys)
        and all(isinstance(k, PLAIN) and not isinstance(k, (T.CharType, T.VarcharType)) for k in kinds.values())
        and len(kinds) == len(schema.fields)
    )


def feature_schema(schema: T.StructType, sensors: Sequence[str], windows: Sequence[int], lags: Sequence[int]) -> T.StructType:
    fields = [T.StructField(f.name, f.dataType) for f in schema.fields]
    for s in sensors:
        for w in windows:
            fields += [T.StructField(f"{s}_roll_mean_w{w}", T.DoubleType()), T.StructField(f"{s}_roll_std_w{w}", T.DoubleType())]
        fields += [T.StructField(f"{s}_lag_{lag}", schema[s].dataType) for lag in lags]
    return T.StructType(fields)


def _depths(rows: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """How many rows of its unit lie before each row."""
    at = np.arange(rows.num_rows)
    fresh = np.zeros(rows.num_rows, bool)
    fresh[:1] = True
    for k in keys:
        col = rows.column(k)
        fresh[1:] |= pc.not_equal(col[1:], col[:-1]).to_numpy(zero_copy_only=False)
    return at - np.maximum.accumulate(np.where(fresh, at, 0))


def _shifted(values: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros_like(values)
    out[k:] = values[: max(0, len(values) - k)]
    return out


def _folds(values: list[np.ndarray], marks: list[np.ndarray], w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, sum and second moment of each row's last ``w`` values (``values[k]``: k rows before; 0 where ``marks[k]`` is)."""
    count, total, mean, moment = (np.zeros(len(values[0])) for _ in range(4))
    for k in range(w - 1, -1, -1):
        x, m = values[k], marks[k]
        count = count + m
        total += x
        delta = (x - mean) * m
        part = delta / np.maximum(count, 1.0)
        mean += part
        moment += delta * (delta - part)
    return count, total, moment


def rolling_batches(
    batches: Iterator[pa.RecordBatch], sensors: Sequence[str], windows: Sequence[int], lags: Sequence[int], min_periods: int, keys: Sequence[str]
) -> Iterator[pa.RecordBatch]:
    """The batches with the features of :func:`feature_schema`; ``keys`` (not null) tell units apart, whose rows lie together in cycle order."""
    reach = max(max(windows) - 1, max(lags, default=0))
    held = None
    for batch in batches:
        new = batch.select([*keys, *dict.fromkeys(sensors)])
        rows = new if held is None else pa.concat_batches([held, new])
        old, n = rows.num_rows - batch.num_rows, rows.num_rows
        held = rows.slice(max(0, n - reach))
        depth = _depths(rows, keys)
        alive = [depth >= k for k in range(max(windows))]
        at = np.arange(n)
        back = [pa.array(np.maximum(at - lag, 0)[old:], mask=(depth < lag)[old:]) for lag in lags]
        out = list(batch.columns)
        with np.errstate(all="ignore"):
            for s in sensors:
                col = rows.column(s)
                there = col.is_valid().to_numpy(zero_copy_only=False)
                raw = col.cast(pa.float64(), safe=False).fill_null(0.0).to_numpy(zero_copy_only=False)
                marks = [(_shifted(there, k) & live).astype(float) for k, live in enumerate(alive)]
                values = [np.where(m > 0, _shifted(raw, k), 0.0) for k, m in enumerate(marks)]
                for w in windows:
                    count, total, moment = (a[old:] for a in _folds(values, marks, w))
                    few = count < max(min_periods, 1)
                    out.append(pa.array(total / count, mask=few))
                    out.append(pa.array(np.where(few, 0.0, np.sqrt(moment / count))))
                out += [col.take(b) for b in back]
        names = [*batch.schema.names, *(f"_f{i}" for i in range(len(out) - batch.num_columns))]
        yield pa.RecordBatch.from_arrays(out, names=names)
