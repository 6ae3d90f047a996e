"""Canonical sensor-table schema and column-list rules (driver side, no jobs)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values that must match the reference: the 26 columns of a cycle file
# in file order, and the sensors dropped as near-constant before modelling.
SENSOR_COLUMNS = [f"sensor_{i}" for i in range(1, 22)]
OP_SETTING_COLUMNS = ["op_setting_1", "op_setting_2", "op_setting_3"]
CYCLE_FILE_COLUMNS = ["unit_id", "cycle", *OP_SETTING_COLUMNS, *SENSOR_COLUMNS]
DROPPED_SENSORS = [
    "sensor_1",
    "sensor_5",
    "sensor_6",
    "sensor_10",
    "sensor_16",
    "sensor_18",
    "sensor_19",
]

DATASET = "dataset_id"
UNIT = "unit_id"
CYCLE = "cycle"
KEYS = (DATASET, UNIT)

CYCLES_SCHEMA = T.StructType(
    [
        T.StructField(DATASET, T.StringType(), False),
        T.StructField(UNIT, T.LongType(), False),
        T.StructField(CYCLE, T.IntegerType(), False),
        *[T.StructField(c, T.DoubleType(), True) for c in OP_SETTING_COLUMNS],
        *[T.StructField(c, T.DoubleType(), True) for c in SENSOR_COLUMNS],
    ]
)

TRUTH_SCHEMA = T.StructType(
    [
        T.StructField(DATASET, T.StringType(), False),
        T.StructField(UNIT, T.LongType(), False),
        T.StructField("final_rul", T.IntegerType(), False),
    ]
)

def column_names(df_or_cols: DataFrame | Iterable[str]) -> list[str]:
    if isinstance(df_or_cols, DataFrame):
        return list(df_or_cols.columns)
    return list(df_or_cols)


def require_columns(df_or_cols: DataFrame | Iterable[str], required: Iterable[str]) -> None:
    """Raise one error naming every missing column (no Spark job)."""
    present = set(column_names(df_or_cols))
    missing = [c for c in required if c not in present]
    if missing:
        raise ValueError(f"the table lacks {missing}; it has {sorted(present)}")


def sensor_columns(
    df_or_cols: DataFrame | Iterable[str], prefix: str = "sensor_", strict: bool = True
) -> list[str]:
    """Sensor columns ordered by their numeric suffix (sensor_2 before sensor_10).

    ``strict`` keeps only ``<prefix><digits>`` names, so engineered columns such
    as ``sensor_1_lag_3`` are not mistaken for sensors. With ``strict=False``
    every name with the prefix is returned, non-numeric suffixes last.
    """
    names = [c for c in column_names(df_or_cols) if c.startswith(prefix)]
    if strict:
        names = [c for c in names if c[len(prefix):].isdigit()]
    if not names:
        raise ValueError(f"no column is named {prefix}<number>")

    def order(name: str) -> tuple[bool, int, str]:
        suffix = name[name.rfind("_") + 1 :]
        number = suffix.isdecimal()
        return not number, int(suffix) if number else 0, name

    return sorted(names, key=order)


def kept_sensors(
    df_or_cols: DataFrame | Iterable[str], dropped: Sequence[str] = DROPPED_SENSORS
) -> list[str]:
    """Sensors left after removing the near-constant ones, in sensor order."""
    drop = set(dropped)
    return [c for c in sensor_columns(df_or_cols) if c not in drop]


def engineered_columns(df_or_cols: DataFrame | Iterable[str]) -> list[str]:
    """Rolling and lag feature columns, in frame order."""
    return [c for c in column_names(df_or_cols) if "_roll_" in c or "_lag_" in c]
