"""Text fixtures are written split by split."""

import pytest
from pyspark.sql import functions as F


def test_truth_alone_writes_no_cycles(spark, tmp_path, monkeypatch):
    from wearlog import queries

    monkeypatch.setattr(queries, "_WRITTEN", {})
    monkeypatch.setattr(queries, "_fa", lambda *_: pytest.fail("the cycle table is not needed"))
    spark.range(1, 60).select(F.col("id").alias("s_suppkey")).write.parquet(str(tmp_path / "supplier.parquet"))
    got = queries.q_text_source_truth(spark, str(tmp_path))
    assert got.count() == 177 and {r.final_rul for r in got.where("unit_id = 7").collect()} == {17}
