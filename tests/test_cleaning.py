import datetime as dt

import pytest
from helpers import raw_frame, values
from pyspark.sql import functions as F

from incident_engine import constants as C
from incident_engine.functions import text, timeparts
from incident_engine.operators import cleaning

PLACE = "40.758012,-73.985501"


@pytest.mark.parametrize(
    "stamp, expected",
    [
        ("2026-01-05 03:04:05", dt.datetime(2026, 1, 5, 3, 4, 5)),
        ("2026-1-5 3:4:5", dt.datetime(2026, 1, 5, 3, 4, 5)),
        ("bad", None),
        ("2026-01-05", None),
        ("2026-01-05T03:04:05", None),
        ("2026-01-05 03:04", None),
        ("2026-01-05 24:00:00", None),
        ("2026-02-30 01:02:03", None),
        ("2026-01-05 03:04:05 ", None),
        (" 2026-01-05 03:04:05", None),
        ("2026-01-05 03:04:05\n", None),
        ("2026-01-05 03:04:05.5", None),
        ("02026-01-05 03:04:05", None),
        (None, None),
    ],
)
def test_timestamp_shapes(spark, stamp, expected):
    df = spark.createDataFrame([(stamp,)], "t string")
    assert df.select(timeparts.parse_timestamp(F.col("t"))).first()[0] == expected


def test_naive_timestamps_ignore_daylight_saving(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        raw = raw_frame(spark, [("V1", "2026-03-08 02:30:00", "DUI", PLACE)])
        assert cleaning.clean(raw).first()["timestamp_parsed"] == dt.datetime(2026, 3, 8, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_clean_keeps_rows_without_type_and_drops_incomplete_ones(spark):
    good = "2026-01-05 03:04:05"
    raw = raw_frame(
        spark,
        [
            ("V1", good, "DUI", PLACE),
            ("V2", good, None, PLACE),
            ("V2", good, "DUI", "Main St"),
            (None, good, "DUI", PLACE),
            ("V4", "bad", "DUI", PLACE),
            ("V5", good, "DUI", None),
            ("V6", None, "DUI", None),
        ],
    )
    kept = cleaning.clean(raw)
    assert kept.columns == list(C.CLEAN_COLUMNS)
    assert sorted(values(kept, "violation_id", "violation_type"), key=repr) == sorted(
        [("V1", "DUI"), ("V2", None), ("V2", "DUI")], key=repr
    )
    assert tuple(cleaning.reject_counts(raw).first()) == (1, 2, 2, 3, 7)
    flags = cleaning.with_acceptance(raw).groupBy("accepted").count().collect()
    assert {r["accepted"]: r["count"] for r in flags} == {True: 3, False: 4}


def test_clean_of_no_rows_has_the_schema(spark):
    kept = cleaning.clean(raw_frame(spark, []))
    assert kept.count() == 0
    assert dict(kept.dtypes)["timestamp_parsed"] == "timestamp_ntz"


def test_clean_has_no_shuffle_and_reads_only_what_it_needs(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw_frame(spark, [("V1", "2026-01-05 03:04:05", "DUI", PLACE)]).write.parquet(path)
    stored = spark.read.parquet(path)
    plan = cleaning.clean(stored).select("location")._jdf.queryExecution().toString()
    assert "Exchange" not in plan
    assert "IsNotNull(Violation_Id)" in plan and "IsNotNull(Location)" in plan
    assert "ReadSchema: struct<Violation_Id:string,Timestamp:string,Location:string>" in plan


def test_headers(spark):
    df = spark.createDataFrame([(1, 2)], [" Violation Type ", "Location "])
    assert cleaning.trim_headers(df).columns == ["Violation Type", "Location"]
    assert cleaning.underscore_headers(df).columns == ["Violation_Type", "Location"]


def test_ensure_timestamp(spark):
    rows = [("2026-01-05 03:04:05",), ("2026-01-05",), ("junk",)]
    df = cleaning.ensure_timestamp(spark.createDataFrame(rows, "timestamp string"))
    assert [r["timestamp_parsed"] for r in df.collect()] == [
        dt.datetime(2026, 1, 5, 3, 4, 5),
        dt.datetime(2026, 1, 5),
        None,
    ]
    assert cleaning.ensure_timestamp(df) is df
    assert cleaning.parsed_only(df).count() == 2


@pytest.mark.parametrize("token", ["NA", "N/A", "null", "None", "nan", ""])
def test_na_tokens_become_null(spark, token):
    df = spark.createDataFrame([(token,), ("DUI",)], "t string")
    assert [r[0] for r in df.select(text.null_if_na(F.col("t"))).collect()] == [None, "DUI"]


@pytest.mark.parametrize(
    "given, expected",
    [("40.75", 40.75), (" 40.75abc", 40.75), ("-7", -7.0), ("1e2x", 100.0), (".5", 0.5),
     ("Main St", None), ("", None), (None, None)],
)
def test_leading_number(spark, given, expected):
    df = spark.createDataFrame([(given,)], "t string")
    assert df.select(text.leading_number(F.col("t"))).first()[0] == expected


def test_text_helpers(spark):
    row = spark.range(1).select(
        text.hour_label(F.lit(7)),
        text.zero_padded(F.lit(42), 4),
        text.zero_padded(F.lit(123456), 4),
        text.signed_two_decimals(F.lit(1.5)),
        text.signed_two_decimals(F.lit(0.0)),
        text.signed_two_decimals(F.lit(-0.25)),
        text.first_present(F.lit(""), F.lit(None).cast("string"), F.lit("x")),
        text.first_present(F.lit(""), default="N/A"),
        text.strip(F.lit("\t DUI \n")),
        text.lower_contains(F.lit("Main ST"), "n s"),
    )
    assert tuple(row.first()) == (
        "07:00", "0042", "123456", "+1.50", "0.00", "-0.25", "x", "N/A", "DUI", True,
    )
