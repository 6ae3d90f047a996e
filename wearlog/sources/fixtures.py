"""The driver's test tables read as canonical sensor frames (see FIXTURES.md).

* lineitem -> three fleets (by return flag), one unit per supplier, cycles in
  ship order, sensors 1-4 from the numeric columns, sensor 5 constant.
* events -> one fleet, one unit per user, cycles in time order.
* supplier -> truth table (final RUL per unit) for the three lineitem fleets.

Only the columns a frame needs are read, so the scans are pruned.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.unit_layout import row_ordinal

LINEITEM_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
# Fixed values of the mapping: return flag -> fleet, and the constant sensor.
FLEET_BY_FLAG = {"A": "FD001", "N": "FD002", "R": "FD003"}
CONSTANT_SENSOR_VALUE = 518.67


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def fleet_of_flag(flag: F.Column) -> F.Column:
    return F.when(flag == "A", F.lit("FD001")).when(flag == "N", F.lit("FD002")).otherwise(
        F.lit("FD003")
    )


def lineitem_cycles(spark: SparkSession, sf_dir: str, n_sensors: int = 5) -> DataFrame:
    """Multi-fleet cycle table from lineitem (fixture F-A)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        "l_suppkey",
        *LINEITEM_ORDER,
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
    )
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date"))
    ranked = row_ordinal(
        li,
        ["l_returnflag", "l_suppkey"],
        LINEITEM_ORDER,
        coarse=day,
        fine=F.shiftright(F.col("l_orderkey"), 24),
        out="cycle",
    )
    sensors = [
        F.col("l_quantity").alias("sensor_1"),
        F.col("l_extendedprice").alias("sensor_2"),
        F.col("l_discount").alias("sensor_3"),
        F.col("l_tax").alias("sensor_4"),
        F.lit(CONSTANT_SENSOR_VALUE).alias("sensor_5"),
    ][:n_sensors]
    return ranked.select(
        fleet_of_flag(F.col("l_returnflag")).alias("dataset_id"),
        F.col("l_suppkey").cast("long").alias("unit_id"),
        F.col("cycle").cast("int").alias("cycle"),
        F.col("l_linenumber").cast("double").alias("op_setting_1"),
        F.lit(0.0).alias("op_setting_2"),
        F.lit(0.0).alias("op_setting_3"),
        *sensors,
    )


def events_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single-fleet cycle table from events (fixture F-B)."""
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value", "props")
    day = F.datediff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date"))
    ranked = row_ordinal(
        ev, ["user_id"], ["ts", "event_id"], coarse=day, fine=F.hour("ts"), out="cycle"
    )
    return ranked.select(
        F.lit("FD004").alias("dataset_id"),
        F.col("user_id").cast("long").alias("unit_id"),
        F.col("cycle").cast("int").alias("cycle"),
        F.lit(0.0).alias("op_setting_1"),
        F.lit(0.0).alias("op_setting_2"),
        F.lit(0.0).alias("op_setting_3"),
        F.col("value").alias("sensor_1"),
        F.get_json_object("props", "$.k").cast("double").alias("sensor_2"),
    )


def supplier_truth(spark: SparkSession, sf_dir: str, drop_every: int | None = None) -> DataFrame:
    """Truth table for the lineitem fleets (fixture F-T).

    ``drop_every=7`` removes truth rows of suppliers with
    ``s_suppkey % 7 = 0``: it defines the missing-truth scenario (those units
    must be reported). It never thins the cycle data: every lineitem row is
    still processed by the queries that use it.
    """
    sup = table(spark, sf_dir, "supplier").select("s_suppkey")
    if drop_every:
        sup = sup.where(F.col("s_suppkey") % drop_every != 0)
    fleets = F.array(*[F.lit(v) for v in sorted(FLEET_BY_FLAG.values())])
    return sup.select(
        F.explode(fleets).alias("dataset_id"),
        F.col("s_suppkey").cast("long").alias("unit_id"),
        (F.col("s_suppkey") % 50 + 10).cast("int").alias("final_rul"),
    )


_MATERIALIZED: dict[tuple, DataFrame] = {}


def cached_frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture frame written once per session to the shared folder."""
    from ..session import materialize

    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), name)
    if key not in _MATERIALIZED:
        builders = {"lineitem": lineitem_cycles, "events": events_cycles}
        _MATERIALIZED[key] = materialize(
            builders[name](spark, sf_dir), f"fixture-{name}", partition_by=["dataset_id"]
        )
    return _MATERIALIZED[key]
