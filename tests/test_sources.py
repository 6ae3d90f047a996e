"""Text readers, file listing and request parsing."""

import json
import os

import pytest

from wearlog.sources.cycle_files import load_dataset, load_split, read_cycle_files, split_file_name
from wearlog.sources.listing import availability, collect_available_datasets
from wearlog.sources.requests import parse_requests, read_request_files, requests_from_cycles

def _line(unit, cycle, width=26):
    vals = [str(unit), str(cycle)] + [f"{i}.25" for i in range(width - 2)]
    return " ".join(vals)


def _write(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + ("\n" if lines else ""))


def test_file_names():
    assert split_file_name("1", "train") == "train_FD001.txt"
    assert split_file_name("fd003", "rul") == "RUL_FD003.txt"
    with pytest.raises(ValueError):
        split_file_name("1", "dev")


def test_cycle_reader_blanks_and_padding(spark, tmp_path):
    _write(tmp_path / "train_FD001.txt", [_line(1, 1) + "   ", "  " + _line(1, 2), "", _line(1, 3, width=25)])
    _write(tmp_path / "train_FD002.txt", [_line(7, 1)])
    rows = load_split(spark, str(tmp_path), ["FD001", 2], "train").orderBy("dataset_id", "cycle").collect()
    assert [(r.dataset_id, r.unit_id, r.cycle) for r in rows] == [
        ("FD001", 1, 1), ("FD001", 1, 2), ("FD001", 1, 3), ("FD002", 7, 1)
    ]
    assert rows[2]["sensor_21"] is None and rows[2]["sensor_20"] == 22.25
    assert rows[0]["op_setting_1"] == 0.25


def test_cycle_reader_long_line_and_narrow_file(spark, tmp_path):
    _write(tmp_path / "train_FD001.txt", [_line(1, 1), _line(1, 2, width=27)])
    with pytest.raises(ValueError, match="too many columns"):
        load_split(spark, str(tmp_path), [1], "train")
    rows, rejects = read_cycle_files(spark, [str(tmp_path / "train_FD001.txt")], mode="reject")
    assert rows.count() == 1 and rejects.first()["problem"] == "too many columns"
    _write(tmp_path / "test_FD001.txt", [_line(1, 1, width=25), _line(1, 2, width=25)])
    with pytest.raises(ValueError, match="wrong column count"):
        load_split(spark, str(tmp_path), [1], "test")


def test_cycle_reader_empty_file(spark, tmp_path):
    _write(tmp_path / "train_FD001.txt", [_line(1, 1)])
    _write(tmp_path / "train_FD002.txt", [])
    with pytest.raises(ValueError, match="No data lines"):
        load_split(spark, str(tmp_path), [1, 2], "train")


def test_truth_reader_ordinals_skip_blank_lines(spark, tmp_path):
    _write(tmp_path / "RUL_FD001.txt", ["112", "", "  69 ", "7"])
    got = load_split(spark, str(tmp_path), [1], "rul").orderBy("unit_id").collect()
    assert [(r.unit_id, r.final_rul) for r in got] == [(1, 112), (2, 69), (3, 7)]
    _write(tmp_path / "RUL_FD002.txt", ["1 2"])
    with pytest.raises(ValueError, match="expected 1 column"):
        load_split(spark, str(tmp_path), [2], "rul")


def test_truth_reader_over_ordered_part_files(spark, tmp_path):
    # A sorted Spark write: several part files whose name order is line order.
    out = str(tmp_path / "RUL_FD003.txt")
    spark.range(1, 2001).orderBy("id").selectExpr("cast(id * 3 as string) AS value").write.text(out)
    assert len([p for p in os.listdir(out) if p.startswith("part-")]) > 1
    got = load_split(spark, str(tmp_path), [3], "rul")
    assert got.count() == 2000
    assert got.where("final_rul != unit_id * 3").count() == 0


def test_load_dataset_three_splits(spark, tmp_path):
    _write(tmp_path / "train_FD001.txt", [_line(1, 1), _line(1, 2)])
    _write(tmp_path / "test_FD001.txt", [_line(1, 1)])
    _write(tmp_path / "RUL_FD001.txt", ["30"])
    train, test, truth = load_dataset(spark, str(tmp_path), [1])
    assert (train.count(), test.count(), truth.count()) == (2, 1, 1)


def test_fleets_without_all_their_files(spark, tmp_path):
    """Fleet 4 is whole (its train split a folder of part files), fleet 3 lacks its truth, fleet 1 everything."""
    (tmp_path / "train_FD004.txt").mkdir()
    for name in ("train_FD004.txt/part-0", "test_FD004.txt", "RUL_FD004.txt", "train_FD003.txt", "test_FD003.txt"):
        (tmp_path / name).write_text("1 1\n")
    wanted = ["3", "fd004", "FD001", 4]
    found, gone = collect_available_datasets(spark, str(tmp_path), wanted)
    assert found == ["FD004"] and {k: len(v) for k, v in gone.items()} == {"FD001": 3, "FD003": 1}
    assert gone["FD003"][0].endswith("RUL_FD003.txt")
    with pytest.raises(FileNotFoundError, match="FD001 lacks 3 .*FD003 lacks 1"):
        collect_available_datasets(spark, str(tmp_path), wanted, skip_missing=False)
    with pytest.raises(FileNotFoundError, match="none of the fleets"):
        collect_available_datasets(spark, str(tmp_path), ["3", "1"])
    whole, _ = availability(spark, str(tmp_path), wanted)
    assert [r.dataset_id for r in whole.collect()] == ["FD004"]


def _sample():
    records = [
        {"cycle": c, "op_setting_1": 0.0, "op_setting_2": 0.0, "op_setting_3": 0.0,
         **{f"sensor_{i}": float(i) + c / 10 for i in range(1, 22)}}
        for c in range(1, 7)
    ]
    return {"unit_id": 1, "records": records}


def test_request_rules(spark):
    good = _sample()
    cases = {"ok": good}
    x = json.loads(json.dumps(good)); x["extra"] = 1; cases["extra"] = x
    x = json.loads(json.dumps(good)); del x["records"][0]["sensor_3"]; cases["missing"] = x
    x = json.loads(json.dumps(good)); x["records"][0]["cycle"] = 0; cases["cycle0"] = x
    x = json.loads(json.dumps(good)); x["records"] = []; cases["empty"] = x
    x = json.loads(json.dumps(good)); x["unit_id"] = 0; cases["unit0"] = x
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in cases.items()], "request_id string, body string")
    records, rejects = parse_requests(df)
    bad = {r.request_id: r.detail for r in rejects.collect()}
    assert set(bad) == {"extra", "missing", "cycle0", "empty", "unit0"}
    assert records.where("request_id = 'ok'").count() == 6


def test_request_values_are_parsed_as_numbers_and_again_only_where_that_fails(spark):
    good = _sample()
    bodies = {"ok": json.dumps(good)}
    changed = lambda old, new: json.dumps(good).replace(old, new, 1)
    bodies["quoted"] = changed('"sensor_4": 4.1', '"sensor_4": "4.1"')
    bodies["turned"] = json.dumps({"records": [dict(reversed(r.items())) for r in good["records"]], "unit_id": 1})
    bodies["turned and quoted"] = bodies["turned"].replace('"cycle": 2', '"cycle": " 2 "')
    bodies["unit"] = changed('"unit_id": 1', '"unit_id": "1"')
    bodies["twice"] = changed('"sensor_4": 4.1', '"sensor_4": 4.1, "sensor_4": 9')
    bad = {"word": '"x"', "none": "null", "flag": "true", "list": "[4.1]", "NaN": '"NaN"', "large": "1e400", "small": "-1e400", "inf": '"-Infinity"'}
    bodies |= {k: changed('"sensor_4": 4.1', f'"sensor_4": {v}') for k, v in bad.items()}
    bodies["no list"] = json.dumps({"unit_id": 1, "records": {"cycle": 1}})
    bodies["word and extra"] = changed('"sensor_4": 4.1', '"sensor_4": "x", "more": 1')
    bodies["quoted cycle 0"] = changed('"cycle": 1', '"cycle": "0"')
    df = spark.createDataFrame(list(bodies.items()), "request_id string, body string")
    records, rejects = parse_requests(df)
    want = {k: "record values must be numbers" for k in bad} | {"no list": "records must contain at least 1 item", "word and extra": "extra fields not permitted in a record", "quoted cycle 0": "cycle must be an integer >= 1"}
    assert {r.request_id: r.detail for r in rejects.collect()} == want
    rows = {}
    for r in records.collect():
        rows.setdefault(r.request_id, []).append((r.arrival, r.unit_id, r.cycle, *(r[f"sensor_{i}"] for i in range(1, 22))))
    assert set(rows) == set(bodies) - set(want) and len(rows) == 6
    own = [(c - 1, 1, c, *(float(i) + c / 10 for i in range(1, 22))) for c in range(1, 7)]
    assert all(sorted(r) == own for r in rows.values())
    # strings only under a condition, and no function of each value (a lookup in a map, a test of each number)
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapType(StringType,DoubleType") == 1 and plan.count("MapType(StringType,StringType") == 1
    assert "CASE WHEN _again" in plan and "exists(" not in plan


def test_request_files(spark, tmp_path):
    good = _sample()
    (tmp_path / "r1.json").write_text(json.dumps(good, indent=2))
    bad = dict(good, extra=True)
    (tmp_path / "r2.json").write_text(json.dumps(bad))
    records, rejects = parse_requests(read_request_files(spark, str(tmp_path)))
    assert records.select("request_id").distinct().collect()[0].request_id == "r1.json"
    assert records.count() == 6
    assert [r.request_id for r in rejects.collect()] == ["r2.json"]


def test_requests_from_cycles_round_trip(spark):
    cycles = spark.createDataFrame(
        [("FD001", u, c, 0.0, 0.0, 0.0, float(c), float(u)) for u in (1, 2) for c in range(1, 91)],
        "dataset_id string, unit_id long, cycle int, op_setting_1 double, op_setting_2 double, "
        "op_setting_3 double, sensor_1 double, sensor_2 double",
    )
    bodies = requests_from_cycles(cycles, records_per_request=40)
    assert bodies.count() == 6  # 90 cycles -> 40 + 40 + 10 per unit
    records, rejects = parse_requests(bodies)
    assert rejects.count() == 0 and records.count() == 180
    assert records.where("sensor_1 != cycle OR sensor_21 != 0.0").count() == 0


def test_truth_rejects_keep_the_other_units_in_place(spark, tmp_path):
    from wearlog.sources.cycle_files import load_split

    (tmp_path / "RUL_FD002.txt").write_text("10\nabc\n\n30 4\n1e30\nNaN\n50\n")
    rows, rejects = load_split(spark, str(tmp_path), [2], "rul", mode="reject")
    assert {(r.unit_id, r.final_rul) for r in rows.collect()} == {(1, 10), (6, 50)}
    assert {(r.unit_id, r.line, r.problem) for r in rejects.collect()} == {
        (2, "abc", "non-numeric value"), (3, "30 4", "expected 1 column"),
        (4, "1e30", "value out of range"), (5, "NaN", "value out of range"),
    }
    with pytest.raises(ValueError, match="RUL_FD002"):
        load_split(spark, str(tmp_path), [2], "rul")
