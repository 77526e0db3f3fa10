import datetime as dt
import json
from collections import Counter

import pytest
from helpers import raw_frame, values
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from incident_engine import constants as C
from incident_engine.functions import geo
from incident_engine.operators import cleaning
from incident_engine.sources import files, sinks, synth

ANCHOR = dt.date(2026, 1, 1)


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_with_blank_headers_quotes_and_na_tokens(spark, tmp_path):
    path = write(
        tmp_path / "raw.csv",
        ' Violation_Id ,Timestamp, Location,Violation_Type\n'
        'V0001,2026-01-05 03:04:05,"40.75,-73.98",DUI\n'
        'V0002,2026-1-5 3:4:5,"Main ""A"" St",NA\n'
        'N/A,2026-01-05 03:04:05,"40.75,-73.98", Speeding \n'
        'V0004,2026-01-05 03:04:05,,null\n',
    )
    raw = files.read_incidents_csv(spark, path)
    assert sorted(raw.columns) == sorted(C.RAW_COLUMNS)
    rows = values(raw, *C.RAW_COLUMNS)
    assert rows[1][2:] == (None, 'Main "A" St')
    assert rows[2][0] is None and rows[2][2] == " Speeding "
    assert rows[3][2:] == (None, None)
    assert cleaning.clean(raw).count() == 2
    kept = files.read_incidents_csv(spark, path, na_tokens=None)
    assert values(kept, "Violation_Id")[2] == ("N/A",)


def test_csv_header_with_inner_blanks(spark, tmp_path):
    path = write(tmp_path / "raw.csv", "Violation Id,Violation Type \nV1,DUI\n")
    raw = files.read_incidents_csv(spark, path, underscore=True)
    assert raw.columns == ["Violation_Id", "Violation_Type"]


def test_csv_line_breaks_inside_quotes(spark, tmp_path):
    path = write(tmp_path / "raw.csv", 'Violation_Id,Location\nV1,"a\nb"\n')
    assert values(files.read_incidents_csv(spark, path, multi_line=True), "Location") == [("a\nb",)]


def test_missing_input_fails(spark, tmp_path):
    with pytest.raises(AnalysisException):
        files.read_incidents_csv(spark, str(tmp_path / "none.csv"))


def test_csv_round_trip_keeps_every_text(spark, tmp_path):
    rows = [("V1", "x", " padded ", "40.75,-73.98"), ("V2", None, 'quo"te', "back\\slash")]
    path = str(tmp_path / "out")
    sinks.write_csv(raw_frame(spark, rows), path)
    assert sorted(values(files.read_incidents_csv(spark, path), *C.RAW_COLUMNS)) == sorted(rows)


def test_single_sorted_file(spark, tmp_path):
    path = tmp_path / "out"
    df = spark.createDataFrame([(3, 1), (1, 2), (2, 9)], "hour_of_day int, count bigint")
    sinks.write_csv(df.repartition(3), str(path), ["hour_of_day"])
    parts = list(path.glob("part-*.csv"))
    assert len(parts) == 1
    assert parts[0].read_text().splitlines() == ["hour_of_day,count", "1,2", "2,9", "3,1"]


def test_result_scan_of_directory_file_and_nothing(spark, tmp_path):
    schema = C.LOCATION_COUNT_SCHEMA
    parts = tmp_path / "parts"
    parts.mkdir()
    write(parts / "part-0.csv", "Location,count\na,1\n")
    write(parts / "part-1.csv", 'Location,count\n"b,c",2\n')
    write(parts / "other.csv", "Location,count\nz,9\n")
    assert sorted(values(files.read_result_csv(spark, str(parts), schema), "*")) == [
        ("a", 1),
        ("b,c", 2),
    ]
    plain = tmp_path / "plain"
    plain.mkdir()
    single = write(plain / "x.csv", "Location,count\nz,9\n")
    assert values(files.read_result_csv(spark, str(plain), schema), "*") == [("z", 9)]
    assert values(files.read_result_csv(spark, single, schema), "*") == [("z", 9)]
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(FileNotFoundError):
        files.read_result_csv(spark, str(empty), schema)
    assert values(files.read_result_rows(spark, str(plain), schema), "*") == [("z", "9")]
    for missing in (empty, tmp_path / "missing"):
        rows = files.read_result_rows(spark, str(missing), schema)
        assert rows.columns == ["Location", "count"] and rows.count() == 0


def test_bundle_members(spark, tmp_path):
    path = write(
        tmp_path / "bundle.json",
        json.dumps({"top_locations": [{"Location": "a", "count": 3}], "other": []}, indent=2),
    )
    member = files.read_bundle(spark, path, "top_locations", C.LOCATION_COUNT_SCHEMA)
    assert values(member, "*") == [("a", 3)]
    absent = files.read_bundle(spark, path, "hourly_risk", C.HOURLY_RISK_SCHEMA)
    assert absent.count() == 0 and len(absent.columns) == 8


def test_export_writes_unless_empty(spark, tmp_path):
    df = spark.createDataFrame([("Monday", 1, "DUI", 2)], C.TIME_TYPE_SCHEMA)
    assert sinks.export_report(df, str(tmp_path / "a"), ["Hour"])
    text = next((tmp_path / "a").glob("part-*.csv")).read_text()
    assert text.splitlines() == ["DayOfWeek,Hour,Violation_Type,count", "Monday,1,DUI,2"]
    assert not sinks.export_report(df.limit(0), str(tmp_path / "b"), ["Hour"])
    assert not (tmp_path / "b").exists()


def test_json(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b", 2)], C.LOCATION_COUNT_SCHEMA)
    typed = [json.loads(r[0]) for r in sinks.json_rows(df).collect()]
    assert typed == [{"Location": "a", "count": None}, {"Location": "b", "count": 2}]
    as_text = [json.loads(r[0]) for r in sinks.json_rows(df, as_text=True).collect()]
    assert as_text[1] == {"Location": "b", "count": "2"}
    sinks.write_json(df, str(tmp_path / "j"))
    assert spark.read.schema(C.LOCATION_COUNT_SCHEMA).json(str(tmp_path / "j")).count() == 2


def test_parquet_overwrites(spark, tmp_path):
    path = str(tmp_path / "p")
    sinks.write_parquet(spark.range(5).toDF("id"), path)
    sinks.write_parquet(spark.range(2).toDF("id"), path)
    assert files.read_parquet(spark, path).count() == 2


def test_synthetic_rows(spark):
    raw = synth.synthesize(spark, 20_000, ANCHOR).cache()
    assert raw.columns == list(C.RAW_COLUMNS)
    clean = cleaning.clean(raw)
    assert clean.count() == raw.count() == 20_000
    assert raw.where(geo.is_coordinate_pair(F.col("Location"))).count() == 20_000
    by_number = raw.orderBy(F.length("Violation_Id"), "Violation_Id")
    ids = [r[0] for r in by_number.select("Violation_Id").collect()]
    assert (ids[0], ids[-1]) == ("V0001", "V20000")
    days = clean.selectExpr("date(timestamp_parsed) d").distinct().orderBy("d").collect()
    assert (days[0][0], days[-1][0], len(days)) == (ANCHOR, dt.date(2026, 3, 2), 61)
    hours = Counter(r[0] for r in clean.selectExpr("hour(timestamp_parsed)").collect())
    for hour, weight in enumerate(C.HOUR_WEIGHTS):
        expected = 20_000 * weight / sum(C.HOUR_WEIGHTS)
        assert abs(hours[hour] - expected) < 5 * expected**0.5 + 5
    kinds = Counter(r[0] for r in clean.select("violation_type").collect())
    assert set(kinds) == set(C.SYNTH_TYPES)
    assert all(abs(n - 20_000 / 7) < 300 for n in kinds.values())
    spread = clean.selectExpr("split(location, ',')[0] lat").agg(F.min("lat"), F.max("lat")).first()
    assert 40.67 < float(spread[0]) and float(spread[1]) < 40.84
    raw.unpersist()


def test_synthetic_rows_repeat_on_any_layout(spark):
    one = synth.synthesize(spark, 500, ANCHOR, partitions=1)
    many = synth.synthesize(spark, 500, ANCHOR, partitions=7)
    assert sorted(values(one, "*")) == sorted(values(many, "*"))
    other = synth.synthesize(spark, 500, ANCHOR, seed=7)
    assert sorted(values(one, "*")) != sorted(values(other, "*"))
    with pytest.raises(ValueError):
        synth.synthesize(spark, 10)
