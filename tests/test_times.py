from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from aeromart.functions import times as H
from tests.conftest import plan, rows


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "t string").select(column).first()[0]


@pytest.mark.parametrize(
    ("text", "wall", "utc"),
    [
        ("2023-12-19T10:00:00+00:00", 10.0, 10.0),
        ("2023-12-19T07:00:00-03:00", 7.0, 10.0),
        ("2023-12-19T07:00:00+0530", 7.0, 1.5),
        ("2023-12-19T07:00:00Z", 7.0, 7.0),
        ("2023-12-19 07:00:00", 7.0, 7.0),
        ("2023-12-19T07:00:00", 7.0, 7.0),
        ("2023-12-19T07:00:00+5:30", 7.0, 1.5),
        ("2023-12-19T07:00:00-00:30", 7.0, 7.5),
        ("2023-12-19T07:00:00 UTC", 7.0, 7.0),
        ("2023-12-19", 0.0, 0.0),
        ("2023-12-19T07:00:00 Europe/Paris", 7.0, None),
        ("2023-12-19T07:00:00 NZ", 7.0, None),
        ("2023-12-19T07:00:00 Etc/GMT+5", 7.0, None),
        ("2023-12-19T07:00:00+99:99", None, None),
        ("bad", None, None),
        (None, None, None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_clocks_do_not_depend_on_the_session_zone(spark, text, wall, utc, zone):
    def hour(at):
        return None if at is None else at.hour + at.minute / 60

    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert hour(one(spark, H.wall_clock(F.col("t")), text)) == wall
        assert hour(one(spark, H.utc_clock(F.col("t")), text)) == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_time_beyond_the_range_is_no_time(spark):
    assert one(spark, H.utc_clock(F.col("t")), "+294247-01-10T04:00:54.775807-05:00") is None


def test_offset_can_move_the_day(spark):
    got = one(spark, H.utc_clock(F.col("t")), "2023-12-19T23:30:00-03:00")
    assert got == datetime(2023, 12, 20, 2, 30)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_hours_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("select timestamp_ntz'2024-03-10 02:30:15.5' as ts")
        start, end = H.previous_hour_of(F.col("ts"))
        assert rows(df, H.hour_of(F.col("ts")), start, end) == [
            (datetime(2024, 3, 10, 2), datetime(2024, 3, 10, 1), datetime(2024, 3, 10, 2))
        ]
        assert rows(H.in_days(df.withColumn("date_utc", F.col("ts")), "2024-03-10", "2024-03-10"), "ts")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_previous_hour():
    assert H.previous_hour(datetime(2023, 12, 19, 10, 25)) == (
        datetime(2023, 12, 19, 9),
        datetime(2023, 12, 19, 10),
    )


def test_both_bound_formats():
    expected = datetime(2023, 12, 19, 10)
    assert H.as_utc("2023-12-19T10:00:00") == expected
    assert H.as_utc("2023-12-19T10:00:00+00:00") == expected
    assert H.as_utc("2023-12-19 07:00:00-03:00") == expected
    assert H.as_day("2023-12-19") == H.as_day(expected) == date(2023, 12, 19)


def test_window_is_half_open(spark):
    times = ["09:00:00", "09:59:59.999999", "10:00:00"]
    df = spark.createDataFrame([(f"2023-12-19 {t}",) for t in times], "t string")
    df = df.select(F.col("t"), F.col("t").cast("timestamp_ntz").alias("ts"))
    inside = H.in_window(F.col("ts"), "2023-12-19T09:00:00", "2023-12-19T10:00:00")
    assert len(rows(df.where(inside))) == 2
    with pytest.raises(ValueError, match="empty window"):
        H.in_window(F.col("ts"), "2023-12-19T10:00:00", "2023-12-19T10:00:00")


def test_day_filter_reaches_the_scan_and_the_partitions(spark, tmp_path):
    df = spark.sql(
        "select timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id) as date_utc, "
        "cast(id as double) as value from range(96)"
    )
    path = str(tmp_path / "t")
    df.withColumn("measure_date", F.to_date("date_utc")).write.partitionBy("measure_date").parquet(path)
    day = H.in_days(spark.read.parquet(path), "2024-01-02", "2024-01-02")
    assert day.count() == 24
    text = plan(day)
    assert "PartitionFilters: [isnotnull(measure_date" in text
    assert "GreaterThanOrEqual(date_utc,2024-01-02T00:00)" in text
    assert "LessThan(date_utc,2024-01-03T00:00)" in text
