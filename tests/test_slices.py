"""Filtered access to the star, rules as rows, VARIANT fields, the newest day, and what a clean-up may remove."""

import time
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeromart import schemas as S
from aeromart.operators import alerts as A
from aeromart.operators import rules as R
from aeromart.operators import star
from aeromart.operators import variants as V
from aeromart.plans import loads as L
from aeromart.sources import payloads as P
from aeromart.sources.outbox import Outbox
from aeromart.sources.staging import clean_staging, stage
from aeromart.sources.tables import Dimension, FactStore
from tests.conftest import plan, rows
from tests.test_loads import listed_files

FIRST = datetime(2023, 12, 18)  # a Monday


@pytest.fixture
def store(spark, tmp_path):
    made = FactStore(spark, str(tmp_path / "fact"), hourly=False)
    made.write(
        spark.range(0, 14 * 40).selectExpr(
            "cast(id % 40 as int) as location_id", "concat('C', id % 4) as country_code", "if(id % 3 = 0, 'pm1', 'pm25') as parameter_code",
            "cast(id % 17 as double) as value", "cast(null as timestamp_ntz) as date_local",
            "timestamp_ntz'2023-12-18 00:00:00' + make_dt_interval(cast(id div 40 as int), cast(id % 24 as int)) as date_utc",
            "cast(null as timestamp_ntz) as updated_at",
        )
    )
    return made


def dimensions(spark):
    locations = spark.range(30).selectExpr(
        "cast(id as int) as id", "concat('name', id) as name", "if(id % 5 = 0, 'Oslo', 'Lima') as city", "concat('Land', id % 3) as country_name")
    parameters = spark.createDataFrame([("pm1", "PM 1", "ug"), ("pm25", "PM 2.5", "ug")], "code string, displayname string, preferredunit string")
    return locations, parameters


def files_read(spark, df):
    """How many files the scans of a query really opened, from their own counters."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        query = df.select("*")
        query._jdf.collectToPython()
        found, todo = 0, [query._jdf.queryExecution().executedPlan()]
        while todo:
            node = todo.pop()
            todo += [node.children().apply(i) for i in range(node.children().size())]
            if node.getClass().getSimpleName() == "FileSourceScanExec":
                found += node.metrics().apply("numFiles").value()
        return found
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_slice_equals_filters_on_the_whole_star(spark, store):
    locations, parameters = dimensions(spark)
    whole = star.star_join(store.read(), locations, parameters)
    weekend = F.weekday("date_utc") >= 5
    days = star.calendar(store.days()).where("weekday >= 6")
    for options, wanted in (
        ({}, F.lit(True)),
        ({"city": "Oslo"}, F.col("city") == "Oslo"),
        ({"country": ["Land1", "Land2"], "city": "Lima"}, F.col("country_name").isin("Land1", "Land2") & (F.col("city") == "Lima")),
        ({"city": "Nowhere"}, F.lit(False)),
        ({"parameter": "pm1, none"}, F.col("parameter_code") == "pm1"),
        ({"days": days}, weekend),
        ({"days": days, "city": "Oslo", "parameter": ["pm25"]}, weekend & (F.col("city") == "Oslo") & (F.col("parameter_code") == "pm25")),
        ({"start_day": "2023-12-20", "end_day": "2023-12-21"}, F.col("measure_date").between("2023-12-20", "2023-12-21")),
    ):
        found = star.star_slice(store.read(), locations, parameters, **options)
        assert rows(found, *whole.columns) == rows(whole.where(wanted))


def test_days_that_a_calendar_leaves_prune_the_folders(spark, store):
    locations, parameters = dimensions(spark)
    sliced = star.star_slice(store.read(), locations, parameters, days=star.calendar(store.days()).where("weekday = 7"))
    assert "dynamicpruning" in plan(sliced)
    assert files_read(spark, sliced.select("value", "location_name")) == 2  # of 14 days, two are Sundays
    assert files_read(spark, star.star_slice(store.read(), locations, parameters).select("value")) == 14


def test_parameters_and_bounds_of_locations_reach_the_scan(spark, store):
    locations, parameters = dimensions(spark)
    text = plan(star.star_slice(store.read(), locations, parameters, city="Oslo", parameter="pm1"))
    scan = text[text.index("parameter_code"):]
    assert "EqualTo(parameter_code,pm1)" in scan or "In(parameter_code, [pm1])" in scan
    assert "location_id" in text and "Subquery" in text


def test_a_runtime_bloom_filter_where_both_sides_are_shuffled(spark, store):
    locations, parameters = dimensions(spark)
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1b",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        stored = spark.createDataFrame(locations.collect(), locations.schema)
        where = f"{store.path}-locations"
        stored.write.parquet(where)
        text = plan(star.star_slice(store.read(), spark.read.parquet(where), parameters, city="Oslo").select("value", "location_name"))
        assert "might_contain" in text
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_the_newest_day_is_a_subquery_that_prunes_folders(spark, store):
    found = L.newest_alerts(store)
    assert rows(found) == rows(A.above_average_of_day(store.read(), "2023-12-31")) != []
    assert "Subquery" in plan(found)
    assert files_read(spark, found) == 1
    listed = A.above_average_of_day(store.read(), None, "pm1", days=store.days())
    assert rows(listed) == rows(A.above_average_of_day(store.read(), "2023-12-31", "pm1"))
    empty = FactStore(spark, f"{store.path}-empty")
    empty.create_if_absent()
    assert L.newest_alerts(empty).count() == 0


# --- Rules ---------------------------------------------------------------------------------------

RULES = "rule_id int, parameters string, recipients string, first_day date, last_day date"


def test_each_rule_gives_what_a_run_of_its_own_gives(spark, store):
    listed = [
        (1, "pm1", "a@x", date(2023, 12, 19), date(2023, 12, 22)),
        (2, " pm25 ,pm1,pm25", "a@x, ,b@x,a@x", None, date(2023, 12, 20)),
        (3, None, "c@x", date(2023, 12, 30), None),
        (4, "PM1", "a@x", None, None),
        (5, None, "a@x", None, None),
        (6, "pm1", "z@x", date(2030, 1, 1), None),
    ]
    found = L.alerts_by_rule(store, spark.createDataFrame(listed, RULES))
    columns = [c for c in found.columns if c != "rule_id"]
    for rule_id, parameters, recipients, first, last in listed:
        alone = L.daily_alerts(store, first or "2000-01-01", last or "2099-01-01", parameters, recipients=recipients)
        assert rows(found.where(F.col("rule_id") == rule_id), *columns) == rows(alone, *columns)
    assert {r[0] for r in rows(found, "rule_id")} == {1, 2, 3, 5}
    assert L.alerts_by_rule(store, spark.createDataFrame([], RULES)).count() == 0
    with pytest.raises(Exception, match="no recipients in rule 9"):
        L.alerts_by_rule(store, spark.createDataFrame([(9, "pm1", " , ", None, None)], RULES)).collect()


def test_rules_read_the_fact_once_and_post_each_message_once(spark, tmp_path, store):
    listed = [(i, "pm1,pm25" if i % 2 else None, "a@x,b@x", None, None) for i in range(6)]
    found = L.alerts_by_rule(store.read(), spark.createDataFrame(listed, RULES))
    outbox = Outbox(spark, str(tmp_path / "out"))
    posted = outbox.post(found.drop("rule_id"))
    assert posted.count() == found.select("alert_id").distinct().count() > 0
    assert outbox.post(found.drop("rule_id")).count() == 0


def test_a_post_reads_only_the_days_it_is_about(spark, tmp_path, store):
    outbox = Outbox(spark, str(tmp_path / "out"))
    for day in ("2023-12-18", "2023-12-19", "2023-12-20"):
        assert L.post_alerts(store, outbox, day, recipients="a@x").count() > 0
    assert sorted({r[0] for r in rows(outbox.messages(), "measure_date")}) == [date(2023, 12, d) for d in (18, 19, 20)]
    assert all("measure_date=2023-12-19" in f for f in listed_files(outbox.messages([date(2023, 12, 19)])))
    before = sorted(p.name for p in (tmp_path / "out").rglob("*.parquet"))
    assert L.post_alerts(store, outbox, "2023-12-18", "2023-12-20", recipients="a@x").count() == 0
    assert L.post_alerts(store, outbox, "2040-01-01", recipients="a@x").count() == 0
    assert sorted(p.name for p in (tmp_path / "out").rglob("*.parquet")) == before  # nothing to send adds nothing


# --- VARIANT -------------------------------------------------------------------------------------


def test_leaves_of_variants(spark):
    bodies = [
        '{"results":[{"id":1,"dev":{"Ser no":"a","gain":1.5,"x":{"y":true}},"list":[1,{"k":2}],"odd":1}]}',
        '{"results":[{"id":2,"dev":{"it\'s":"q","a\'\\"b":{"z":4}},"odd":"t","none":null,"dev_gain":7},3,"text",null]}',
        "garbage", '{"results":5}', '{"detail":1}', None, '{"results":[]}',
    ]
    df = spark.createDataFrame([(n, b) for n, b in enumerate(bodies)], "n int, body string")
    found = V.variant_elements(df, keep=["n"])
    assert found.groupBy("n").count().count() == 2 and found.count() == 5
    flat = V.flatten_variant(found, keep=["n"], without={("id",)})
    made = {(r.n, r.odd): r.asDict() for r in flat.collect() if r.odd is not None}
    one, two = made[(0, "1")], made[(1, "t")]
    assert one["dev_Ser no"] == "a" and float(one["dev_gain"]) == 1.5 and one["dev_x_y"] is True and one["list"] == '[1,{"k":2}]'
    assert two["dev_it's"] == "q" and two["dev_a'\"b_z"] == 4 and two["dev_gain"] is None and two["dev_gain_2"] == 7 and two["list"] is None
    assert "id" not in flat.columns and flat.count() == 5
    assert V.variant_field(F.col("element"), ["dev", "x"], "int") is not None
    wrong = found.select(V.variant_field(F.col("element"), ["odd"], "int").alias("v"))
    assert rows(wrong.where("v is not null")) == [(1,)]


def test_variants_of_nothing(spark):
    df = spark.createDataFrame([("garbage",)], "body string")
    found = V.variant_elements(df)
    assert found.count() == 0 and V.variant_type(found) == T.StructType()
    assert V.flatten_variant(found).columns == []
    assert ("date", "utc") in V.named_paths(T.DataType.fromDDL(S.MEASUREMENTS_ELEMENT))


# --- Storage that stays bounded ------------------------------------------------------------------


def published(spark, tmp_path, n):
    dim = Dimension(spark, str(tmp_path / "dim"), S.DIM_PARAMETER)
    for k in range(n):
        dim.publish(spark.createDataFrame([(k, "c", None, None, None, None)], S.DIM_PARAMETER))
    return dim


def test_a_reader_opened_before_the_clean_up_still_finishes(spark, tmp_path):
    dim = published(spark, tmp_path, 3)
    later = datetime.now(timezone.utc) + timedelta(days=2)
    with dim.reading() as held:
        before = dim.current()
        dim.publish(spark.createDataFrame([(9, "c", None, None, None, None)], S.DIM_PARAMETER))
        assert dim.clean(now=later) == [1, 2]
        assert rows(held, "id") == rows(before, "id") == [(2,)]
        assert dim.numbers() == [4, 3]
    assert dim.clean(now=later) == [3] and dim.numbers() == [4] and rows(dim.current(), "id") == [(9,)]
    assert dim.clean(now=later) == []


def test_young_snapshots_and_the_current_one_stay(spark, tmp_path):
    dim = published(spark, tmp_path, 3)
    assert dim.clean() == [] and dim.numbers() == [3, 2, 1]
    time.sleep(1.1)
    assert dim.clean(min_age=timedelta(seconds=1)) == [1, 2]
    assert rows(dim.current(), "id") == [(2,)]
    # a reader that died long ago holds nothing
    with dim.reading():
        dim.publish(spark.createDataFrame([(5, "c", None, None, None, None)], S.DIM_PARAMETER))
        assert dim.clean(now=datetime.now(timezone.utc) + timedelta(days=30)) == [3]
    # what a writer left that died before it was done
    (tmp_path / "dim" / "snapshot=2").mkdir()
    (tmp_path / "dim" / "snapshot=9").mkdir()
    assert dim.clean(now=datetime.now(timezone.utc) + timedelta(days=30)) == [2]
    assert (tmp_path / "dim" / "snapshot=9").exists()


def test_staging_folders_go_when_their_load_is_over(spark, tmp_path):
    base = tmp_path / "staging"
    bodies = spark.createDataFrame([('{"results":[{"code":"AA","name":"x"}]}',)], "body string")
    over, running = (stage(P.extract_countries(bodies), f"{base}/{n}", S.STG_COUNTRIES) for n in ("over", "running"))
    (base / "other").mkdir()
    over.finished()
    assert rows(over.good()) == [("AA", "x")]  # the mark is no data
    assert clean_staging(spark, str(base), timedelta(hours=5)) == ["over"]
    assert rows(running.good()) == [("AA", "x")]
    assert clean_staging(spark, str(base), timedelta(hours=5), datetime.now(timezone.utc) + timedelta(days=1)) == ["running"]
    assert (base / "other").exists() and clean_staging(spark, str(base / "none"), timedelta(0)) == []
