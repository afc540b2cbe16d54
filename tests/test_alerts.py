from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from aeromart import schemas as S
from aeromart.operators import alerts as A
from aeromart.operators import star
from aeromart.plans import registry
from aeromart.plans import sample as D
from aeromart.plans.loads import daily_alerts
from aeromart.sources.tables import FactStore
from tests.conftest import plan, rows

DAY = date(2023, 12, 19)
NOON = datetime(2023, 12, 19, 12)


def fact(spark, *found):
    """Rows of (country, value[, parameter[, time]])."""
    data = []
    for country, value, *rest in found:
        parameter, at = (*rest, *("pm25", NOON)[len(rest):])
        data.append((1, country, parameter, value, at, at, None))
    return spark.createDataFrame(data, S.FACT_MEASURE)


SAMPLE = [("AA", 10.0), ("AA", 20.0), ("BB", 1.0), ("BB", 1.0), ("BB", 1.0), ("CC", None), (None, 30.0)]


def test_mean_over_rows_not_over_countries(spark):
    found = A.above_average(fact(spark, *SAMPLE))
    assert rows(found) == [("AA", DAY, "pm25", 15.0, 10.5), (None, DAY, "pm25", 30.0, 10.5)]
    means = A.country_means(A.country_partials(fact(spark, *SAMPLE)))
    assert dict(rows(means, "country_code", "avg_value")) == {"AA": 15.0, "BB": 1.0, "CC": None, None: 30.0}


def test_both_forms_agree(spark):
    df = fact(spark, *SAMPLE, ("AA", 5.0, "pm1"), ("BB", 6.0, "pm1"))
    day = rows(A.above_average_of_day(df, "2023-12-19"))
    assert day == rows(A.above_average(df).drop("base_value"))
    assert day == rows(A.above_average_of_day(df))
    one = rows(A.above_average_of_day(df, DAY, "pm1"))
    assert one == [("BB", DAY, "pm1", 6.0)]


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_both_forms_agree_on_every_day(spark, folder):
    df = D.fact(spark, f"/root/testdata/{folder}")
    everything = A.above_average(df).drop("base_value").withColumn("avg_value", F.round("avg_value", 6))
    for day in ("2024-01-01", "2024-01-17", "2024-01-30"):
        single = A.above_average_of_day(df, day).withColumn("avg_value", F.round("avg_value", 6))
        assert rows(single) == rows(everything.where(F.col("measure_date") == day))


@pytest.mark.parametrize(
    "found",
    [
        [("AA", 0.1), ("AA", 0.2), ("AA", 0.3)],
        [("AA", 2.0), ("BB", 2.0)],
        [("AA", 0.1), ("AA", 0.1), ("AA", 0.1), ("BB", 0.1)],
        [("AA", 0.1)] * 3 + [("BB", 0.1)] * 7,
        [("AA", float("nan")), ("AA", 1.0), ("BB", 1.0)],
        [("AA", None)],
        [],
    ],
)
def test_no_alert_no_message(spark, found):
    alerts = A.above_average(fact(spark, *found))
    assert rows(alerts) == []
    assert rows(A.alert_messages(alerts)) == []


def test_a_lone_country_is_never_above_itself(spark):
    # 0.1 added up in any order is rarely a round number; both means must share the same sum.
    df = spark.range(20_000, numPartitions=7).select(
        F.lit(1).alias("location_id"), F.lit("AA").alias("country_code"), F.lit("p").alias("parameter_code"),
        (F.rand(3) * F.pow(F.lit(10.0), F.col("id") % 8)).alias("value"), F.lit(NOON).cast("timestamp_ntz").alias("date_utc"),
    )
    for n in range(1, 9):
        assert A.above_average(df.repartition(n)).count() == 0
        assert A.above_average_of_day(df.repartition(n)).count() == 0


def test_equal_values_alert_in_no_layout(spark):
    df = fact(spark, *[("AA", 0.1)] * 30, *[("BB", 0.1)] * 7, *[("CC", 0.1)] * 41)
    for n in range(1, 9):
        assert A.above_average(df.repartition(n)).count() == 0
        assert A.above_average_of_day(df.repartition(n), DAY).count() == 0
        assert rows(A.alert_outcomes(df.repartition(n)), "alerts") == [(0,)]


@pytest.mark.parametrize("values", [
    [(1, 10**10 - 1), (2, 10**10), (3, 1)], [(0.000000001, 1), (0.000000002, 1)], [(-0.1, 3), (-0.1, 1), (-0.3, 2)], [(999_999_999.999999, 5)],
])
def test_comparison_equals_fractions(spark, values):
    from decimal import Decimal
    from fractions import Fraction

    from aeromart.functions.numbers import greater_mean

    data = [(Decimal(str(v)) * n, n, Decimal(str(w)) * m, m) for v, n in values for w, m in [*values, (0.1, 7)]]
    df = spark.createDataFrame(data, "a decimal(38,9), n bigint, b decimal(38,9), m bigint")
    found = df.select("a", "n", "b", "m", greater_mean(*[F.col(c) for c in "anbm"]).alias("above")).collect()
    assert [r.above for r in found] == [Fraction(r.a) / r.n > Fraction(r.b) / r.m for r in found]


def test_sums_are_exact_in_every_layout(spark):
    from decimal import Decimal

    from aeromart.functions.numbers import exact_sum, finite

    values = [0.1, -0.1, 4.29, -4.29, 999_999_999.5, -999_999_999.5, 1e-9, -1e-9, 123.456789012, 0.0, None, float("nan")] * 50
    df = spark.createDataFrame([(v,) for v in values], "v double").select(F.lit(1).alias("k"), finite(F.col("v")).alias("v"))
    want = sum((round(Decimal(repr(v)), 9) for v in values if v is not None and v == v), Decimal(0))
    for n in (1, 3, 8):
        got = exact_sum(df.repartition(n).groupBy("k"), "v", "total", "n").first()
        assert (got.total, got.n) == (want, 500)


def test_values_beyond_the_range_are_an_error(spark):
    with pytest.raises(Exception, match="value out of range"):
        A.above_average(fact(spark, ("AA", 1e12))).collect()


def test_recipients_are_refused_or_cleaned(spark):
    df = fact(spark, *SAMPLE)
    for nobody in ([], "", " , "):
        with pytest.raises(ValueError, match="no recipients"):
            daily_alerts(df, DAY, recipients=nobody)
    once = daily_alerts(df, DAY, recipients="a@x, a@x,")
    assert rows(once, "recipient") == [("a@x",)]


def test_ids_keep_their_parts_apart(spark):
    messages = spark.createDataFrame([(DAY, "a|b"), (DAY, "a"), (DAY, None)], "measure_date date, parameter_code string")
    found = A.address(messages, ["c", "b|c", "1:c"])
    assert len(set(rows(found, "alert_id"))) == 9


def test_a_parameter_without_a_name_has_a_table(spark):
    message = A.alert_messages(A.above_average(fact(spark, ("AA", 1.0, None), ("BB", 2.0, None)))).first()
    assert message.body.count("<tr>") == 2 and message.subject.endswith("None")


def test_the_newest_day_prunes_folders(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "fact"), hourly=False)
    store.write(D.fact(spark, "/root/testdata/sf0.001").withColumn("location_id", F.col("location_id").cast("int")))
    found = A.above_average_of_day(store.read())
    assert f"measure_date#" in plan(found).split("PartitionFilters")[1][:200]
    assert store.newest_day() == store.read().agg(F.max("measure_date")).first()[0]
    day = store.newest_day()
    assert rows(found) == rows(A.above_average_of_day(store.read(day, day), day))
    assert {f.split("measure_date=")[1][:10] for f in store.read(day, day).inputFiles()} == {str(day)}
    assert store.read("1999-01-01", "1999-01-02").count() == 0 and store.read("1999-01-01", "1999-01-02").columns == store.read().columns
    assert store.read(day).count() == store.read().where(F.col("measure_date") == day).count()


def test_outcomes_name_the_silent_days_too(spark):
    df = fact(spark, *SAMPLE, ("AA", 3.0, "pm1"))
    assert rows(A.alert_outcomes(df)) == [
        (DAY, "pm1", 1, 0, False), (DAY, "pm25", 4, 2, True)
    ]


def test_day_and_parameter_limits(spark):
    df = fact(
        spark,
        ("AA", 9.0, "pm25", datetime(2023, 12, 19, 23, 59, 59, 999999)),
        ("BB", 1.0, "pm25", datetime(2023, 12, 19)),
        ("CC", 99.0, "pm25", datetime(2023, 12, 20)),
        ("DD", 99.0, "PM25", NOON),
    )
    found = A.above_average(df, "2023-12-19", "2023-12-19", " pm1 , pm25")
    assert rows(found) == [("AA", DAY, "pm25", 9.0, 5.0)]


def test_message_text(spark):
    alerts = A.above_average(fact(spark, *SAMPLE, ("<&>", 40.0)))
    message = A.alert_messages(alerts).first()
    assert message.subject == "[ALERT] Abnormal values on pm25"
    assert "<p>Countries with pm25 value above the daily average for (2023-12-19):</p>" in message.body
    assert "<td>&lt;&amp;&gt;</td>" in message.body and "<td>40.000000</td>" in message.body
    assert "<td>BB</td>" not in message.body
    assert message.countries == 3 and message.body.count("<tr>") == 4


def test_recipients_and_resending(spark):
    df = fact(spark, *SAMPLE)
    sent = daily_alerts(df, DAY, recipients=" a@example.org, b@example.org")
    assert rows(sent, "recipient") == [("a@example.org",), ("b@example.org",)]
    assert len(set(rows(sent, "alert_id"))) == 2
    again = daily_alerts(
        df, "2023-12-19", recipients="a@example.org,b@example.org,c@example.org", sent=sent
    )
    assert rows(again, "recipient") == [("c@example.org",)]


def test_star_join_keeps_unknown_locations(spark):
    df = fact(spark, ("AA", 1.0), ("AA", None), ("BB", 3.0, "nox"))
    dim_location = spark.createDataFrame([(1, "L", "C", "Aland")], "id int, name string, city string, country_name string")
    dim_parameter = spark.createDataFrame([("pm25", "PM2.5", "ug")], "code string, displayname string, preferredunit string")
    joined = star.star_join(df, dim_location, dim_parameter)
    assert rows(joined, "country_name", "parameter_name") == [
        ("Aland", "PM2.5"), ("Aland", "PM2.5"), ("Aland", None)
    ]
    means = star.mean_by_country_and_parameter(df, dim_location, dim_parameter)
    assert rows(means) == [("Aland", "PM2.5", 2, 1.0), ("Aland", None, 1, 3.0)]
    unknown = star.star_join(df, dim_location.where("id > 5"), dim_parameter)
    assert unknown.count() == 3
    twice = dim_location.union(dim_location)
    direct = star.star_join(df, twice, dim_parameter).groupBy("country_name", "parameter_name").agg(
        F.count("*").alias("n"), F.avg("value").alias("a"))
    assert rows(star.mean_by_country_and_parameter(df, twice, dim_parameter)) == rows(direct)


# --- Plans ---------------------------------------------------------------------------------------


def test_one_scan_and_two_exchanges(spark):
    text = plan(A.above_average(spark.read.parquet("/root/testdata/sf0.01/events.parquet").selectExpr(
        "cast(user_id as string) country_code", "event_type parameter_code", "value", "ts date_utc")), "simple")
    assert text.count("FileScan") == 1
    assert text.count("Exchange hashpartitioning") == 2
    assert "partial_sum" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in text


def test_pruning_on_the_stored_fact(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "fact"), hourly=False)
    store.write(D.fact(spark, "/root/testdata/sf0.001").withColumn("location_id", F.col("location_id").cast("int")))
    found = A.above_average(store.read(), "2024-01-05", "2024-01-06", ["click"])
    text = plan(found)
    assert "PartitionFilters: [isnotnull(measure_date" in text
    assert "EqualTo(parameter_code,click)" in text and "GreaterThanOrEqual(date_utc" in text
    files = found.sparkSession.read.parquet(str(tmp_path / "fact")).where(
        "measure_date between '2024-01-05' and '2024-01-06'")
    assert {d for (d,) in rows(found, "measure_date")} <= {d for (d,) in rows(files, "measure_date")}


def test_dimensions_are_broadcast_below_the_limit_and_shuffled_beyond(spark):
    folder = "/root/testdata/sf0.01"
    assert "SortMergeJoin" not in plan(registry.star_join(spark, folder))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(registry.star_join(spark, folder))
        assert "Broadcast" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
