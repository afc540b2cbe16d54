import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aeromart import schemas as S
from aeromart.operators import merge as M
from aeromart.plans import loads as L
from aeromart.plans import sizing
from aeromart.sources.tables import Dimension, FactStore, create_star_schema
from aeromart.streaming.measurements import start_measurement_stream
from tests.conftest import plan, rows

AS_OF = datetime(2024, 1, 1)
FIRST = datetime(2023, 12, 19)


def measurement(at, value, location=1, country="AA"):
    return {
        "locationId": location, "parameter": "pm25", "value": value, "country": country,
        "date": {"utc": at.isoformat() + "+00:00", "local": at.isoformat() + "-03:00"},
    }


def land(path, name, *bodies):
    path.mkdir(exist_ok=True)
    texts = [b if isinstance(b, str) else json.dumps({"results": b}) for b in bodies]
    (path / name).write_text("\n".join(texts) + "\n")
    return str(path / name)


@pytest.fixture(params=[False, True], ids=["daily", "hourly"])
def store(request, spark, tmp_path):
    made = FactStore(spark, str(tmp_path / "fact"), hourly=request.param)
    made.create_if_absent()
    return made


def stored(store):
    return rows(store.read(), "location_id", "value", "date_utc")


def files(store):
    """Name and change time of every data file."""
    from pathlib import Path

    return {str(p): p.stat().st_mtime_ns for p in Path(store.path).rglob("*.parquet")}


def test_create_twice(spark, tmp_path):
    for _ in range(2):
        locations, parameters, fact = create_star_schema(spark, str(tmp_path))
        assert fact.hourly and locations.current().schema.names == S.DIM_LOCATION.names
        assert parameters.current().count() == fact.read().count() == 0
    assert fact.read().columns == [*S.FACT_MEASURE.names, "measure_date", "measure_hour"]


def test_the_other_layout_is_refused(spark, tmp_path, store):
    L.load_window(
        spark, land(tmp_path / "landing", "a.json", [measurement(FIRST, 1.0)]), store, FIRST, FIRST + timedelta(hours=1)
    )
    store.create_if_absent()
    with pytest.raises(ValueError, match="stored by"):
        FactStore(spark, store.path, not store.hourly).create_if_absent()


def test_hourly_windows_equal_one_range(spark, tmp_path, store):
    hours = [FIRST + timedelta(hours=h) for h in (0, 1, 2, 23, 24, 25)]
    found = [
        measurement(at + timedelta(minutes=m), float(m), location)
        for at in hours
        for m in (0, 59)
        for location in (1, 2)
    ]
    landing = land(tmp_path / "landing", "a.json", found)
    for at in hours:
        L.load_window(spark, landing, store, at, at + timedelta(hours=1), as_of=AS_OF)
    one = FactStore(spark, str(tmp_path / "one"), store.hourly)
    report = L.load_range(
        spark, landing, one, FIRST.isoformat() + "+00:00", FIRST + timedelta(days=2), as_of=AS_OF
    )
    assert report == L.LoadReport(len(found), 0, 0, 0, len(found))
    assert stored(store) == stored(one)
    assert len(stored(store)) == len(found)
    assert rows(store.read(), "updated_at") == [(None,)] * len(found)
    again = L.load_range(spark, landing, store, FIRST, FIRST + timedelta(days=2), as_of=AS_OF)
    assert (again.updated, again.inserted) == (len(found), 0)
    assert rows(store.read(), "updated_at") == [(AS_OF,)] * len(found)


def test_the_end_belongs_to_the_next_window(spark, tmp_path, store):
    landing = land(tmp_path / "landing", "a.json", [measurement(datetime(2023, 12, 19, 10), 1.0)])
    L.load_previous_hour(spark, landing, store, datetime(2023, 12, 19, 10, 25))
    assert stored(store) == []
    L.load_previous_hour(spark, landing, store, datetime(2023, 12, 19, 11, 5))
    assert len(stored(store)) == 1


def test_only_the_days_in_the_source_are_rewritten(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "fact"), hourly=False)
    landing = tmp_path / "landing"
    days = [FIRST + timedelta(days=d) for d in range(3)]
    L.load_range(
        spark, land(landing, "a", [measurement(d, 1.0) for d in days]), store, days[0], days[2] + timedelta(days=1)
    )
    before = files(store)
    late = land(landing, "b", [measurement(days[1], 2.0), measurement(days[2] + timedelta(days=1), 3.0)])
    report = L.load_range(spark, late, store, days[0], days[2] + timedelta(days=2))
    assert (report.kept, report.updated, report.inserted) == (1, 0, 2)
    after = files(store)
    untouched = {f for f in before if before[f] == after.get(f)}
    assert sorted(f.split("measure_date=")[1][:10] for f in untouched) == ["2023-12-19", "2023-12-21"]
    assert [v for _, v, _ in stored(store)] == [1.0, 1.0, 1.0, 2.0, 3.0]


def test_bad_rows_are_counted_and_duplicates_merge_as_one(spark, tmp_path, store):
    landing = land(
        tmp_path / "landing", "a.json",
        [measurement(FIRST, 1.0), measurement(FIRST, 1.0, country="BB"), measurement(FIRST, 1.0, country="TOO")],
        "garbage",
        [{"locationId": None, "value": 1}],
    )
    report = L.load_window(spark, landing, store, FIRST, FIRST + timedelta(hours=1))
    assert report == L.LoadReport(good=2, quarantined=3, kept=0, updated=0, inserted=1)
    assert rows(store.read(), "country_code") == [("BB",)]


def test_loads_of_nothing(spark, tmp_path, store):
    landing = land(tmp_path / "landing", "a.json", '{"results":[]}')
    empty = L.LoadReport(0, 0, 0, 0, 0)
    window = (FIRST, FIRST + timedelta(hours=1))
    assert L.load_window(spark, landing, store, *window) == empty
    (tmp_path / "landing" / "b.json").write_text("")
    assert L.load_window(spark, str(tmp_path / "landing" / "b.json"), store, *window) == empty
    assert stored(store) == []


def test_rows_without_a_time_are_carried_along(spark, tmp_path, store):
    nothing = spark.createDataFrame(
        [(1, "AA", "p", 1.0, None, None, None), (2, "AA", "p", 1.0, None, FIRST, None)], S.FACT_MEASURE
    )
    store.write(nothing)
    new = spark.createDataFrame(
        [(3, "p", 1.0, "AA", None, None), (2, "p", 1.0, "BB", FIRST, FIRST)],
        "locationid int, parameter string, value double, country string, date_utc timestamp_ntz, date_local timestamp_ntz",
    )
    counts = store.merge(new, on_duplicate="dedupe", as_of=AS_OF)
    assert counts == {"kept": 1, "updated": 1, "inserted": 1}
    assert rows(store.read(), "location_id", "country_code", "updated_at") == [
        (1, "AA", None), (2, "BB", AS_OF), (3, "AA", None)
    ]


def test_keys_without_the_time_are_refused(spark, store):
    keys = {k: v for k, v in M.MEASURE_KEYS.items() if k != "date_utc"}
    with pytest.raises(ValueError, match="date_utc"):
        store.merge(spark.createDataFrame([], S.staging_schema(S.STG_MEASUREMENTS)), keys=keys)


def test_a_corrected_value_can_replace_the_old_one(spark, tmp_path, store):
    landing = tmp_path / "landing"
    window = (FIRST, FIRST + timedelta(hours=1))
    L.load_window(spark, land(landing, "a", [measurement(FIRST, 1.0)]), store, *window)
    keys = {k: v for k, v in M.MEASURE_KEYS.items() if k != "value"}
    fixed = spark.createDataFrame([(1, "pm25", 5.0, "AA", FIRST, FIRST)],
        "locationid int, parameter string, value double, country string, date_utc timestamp_ntz, date_local timestamp_ntz")
    assert store.merge(fixed, keys=keys)["updated"] == 1
    assert [v for _, v, _ in stored(store)] == [5.0]


def listed_files(df):
    """All files that the scans of a frame know of, before any pruning."""
    found, open_ = [], [df._jdf.queryExecution().optimizedPlan()]
    while open_:
        node = open_.pop()
        children = node.children()
        open_ += [children.apply(i) for i in range(children.size())]
        if node.getClass().getSimpleName() == "LogicalRelation":
            found += list(node.relation().location().inputFiles())
    return found


def test_merge_reads_only_the_touched_partitions(spark, tmp_path, store):
    old = spark.range(96).selectExpr(
        "1 as location_id", "'AA' as country_code", "'p' as parameter_code", "cast(id as double) as value",
        "cast(null as timestamp_ntz) as date_local",
        "timestamp_ntz'2023-12-19 00:00:00' + make_dt_interval(0, cast(id as int)) as date_utc",
        "cast(null as timestamp_ntz) as updated_at",
    )
    store.write(old)
    seen = []

    def spy(target, source, **options):
        seen.append(target)
        return M.merge_measures(target, source, **options)

    new = old.where("value = 30").selectExpr(
        "location_id as locationid", "parameter_code as parameter", "value", "country_code as country",
        "date_utc", "date_local")
    counts = store.merge(new, merge=spy, on_duplicate="dedupe")
    assert counts == {"kept": 0 if store.hourly else 23, "updated": 1, "inserted": 0}
    # nothing but the touched partition was listed
    listed = {f.split("measure_date=")[1].rpartition("/")[0] for f in listed_files(seen[0])}
    assert listed == ({"2023-12-20/measure_hour=6"} if store.hourly else {"2023-12-20"})
    assert len(stored(store)) == 96


def test_new_partitions_need_no_join(spark, tmp_path, store):
    seen = []

    def spy(target, source, **options):
        seen.append(M.merge_measures(target, source, strategy="shuffle", **options))
        return seen[-1]

    new = spark.createDataFrame([(1, "pm25", 5.0, "AA", FIRST, FIRST)],
        "locationid int, parameter string, value double, country string, date_utc timestamp_ntz, date_local timestamp_ntz")
    assert store.merge(new, merge=spy, on_duplicate="dedupe") == {"kept": 0, "updated": 0, "inserted": 1}
    assert "Join" not in plan(seen[0])


def test_fact_files_are_sorted(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "fact"), hourly=False)
    shuffled = spark.range(2000).selectExpr(
        "1 as location_id", "cast(id % 7 as string) as country_code", "cast(id % 3 as string) as parameter_code",
        "cast(id as double) as value", "cast(null as timestamp_ntz) as date_local",
        "timestamp_ntz'2023-12-19 00:00:00' + make_dt_interval(0, cast(pmod(id * 37, 48) as int)) as date_utc",
        "cast(null as timestamp_ntz) as updated_at").repartition(5)
    store.write(shuffled)
    import pyarrow.parquet as pq

    assert len(files(store)) == 2
    for name in files(store):
        got = pq.ParquetFile(name).read(["date_utc", "country_code", "parameter_code"]).to_pylist()
        keys = [tuple(r.values()) for r in got]
        assert keys == sorted(keys)


def test_a_hot_day_is_written_by_many_tasks(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "fact"), hourly=False)
    store.create_if_absent()
    hot = spark.range(60_000, numPartitions=8).selectExpr(
        "cast(id as int) as location_id", "'AA' as country_code", "sha1(cast(id as string)) as parameter_code",
        "rand(1) as value", "cast(null as timestamp_ntz) as date_local",
        "timestamp_ntz'2023-12-19 00:00:00' + make_dt_interval(if(id % 3 = 0, cast(id % 20 as int), 0)) as date_utc",
        "cast(null as timestamp_ntz) as updated_at")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "300KB")
    try:
        store.write(hot)
    finally:
        spark.conf.set(key, old)
    assert sum("2023-12-19" in name for name in files(store)) > 4
    assert store.read().count() == 60_000


def test_a_whole_run_twice(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    newer, older = ({"id": 1, "name": n, "country": c, "lastUpdated": f"2023-12-{d}T00:00:00+00:00"}
                    for n, c, d in (("a", "AA", 19), ("z", "BB", 18)))
    land(landing / "locations", "a", [newer, older], [{"id": "x"}])
    land(landing / "countries", "a", [{"code": "AA", "name": "Aland"}])
    land(landing / "parameters", "a", [{"id": 2, "name": "pm25", "displayName": "PM2.5"}])
    land(landing / "measurements", "a", [measurement(FIRST, 1.0), measurement(FIRST, 2.0)])
    tables = create_star_schema(spark, str(tmp_path / "star"))
    for run in range(2):
        got = L.load_all(spark, str(landing), tables, FIRST, FIRST + timedelta(hours=1), AS_OF)
        assert got["locations"] == {"good": 2, "quarantine": 1}
        assert got["measurements"] == L.LoadReport(2, 0, 0, 2 * run, 2 * (1 - run))
        assert rows(tables[0].current(), "id", "name", "country_name") == [(1, "a", "Aland")]
        assert rows(tables[1].current(), "id", "code", "displayname") == [(2, "pm25", "PM2.5")]
        assert tables[2].read().count() == 2


def test_dimension_snapshots(spark, tmp_path):
    dim = Dimension(spark, str(tmp_path / "dim"), S.DIM_PARAMETER)
    dim.create_if_absent()
    parameters = spark.createDataFrame([(1, "a", "A", "d", "u")], S.staging_schema(S.STG_PARAMETERS))
    L.refresh_parameters(dim, parameters, as_of=AS_OF)
    reader = dim.current()
    assert rows(L.refresh_parameters(dim, parameters, as_of=AS_OF), "id", "updated_at") == [(1, AS_OF)]
    assert rows(reader, "updated_at") == [(None,)]
    # A snapshot whose job never committed is not seen, and its number is used again.
    reader.write.parquet(str(tmp_path / "dim" / "snapshot=4"))
    (tmp_path / "dim" / "snapshot=4" / "_SUCCESS").unlink()
    assert rows(dim.current(), "updated_at") == [(AS_OF,)]
    assert dim.publish(dim.current()).count() == 1


def test_locations_move_before_countries_are_named(spark, tmp_path):
    dim, _, _ = create_star_schema(spark, str(tmp_path))
    names = spark.createDataFrame([("AA", "Aland"), ("BB", "Bland")], "code string, name string")
    schema = S.staging_schema(S.STG_LOCATIONS)

    def at(country):
        row = {"id": 1, "country": country}
        return spark.createDataFrame([tuple(row.get(f.name) for f in schema)], schema)

    assert rows(L.refresh_locations(dim, at("AA"), names), "country_name") == [("Aland",)]
    assert rows(L.refresh_locations(dim, at("BB"), names), "country_name") == [("Bland",)]


def test_stream_reads_new_files_only_and_survives_replay(spark, tmp_path, store):
    landing, reports = tmp_path / "landing", []

    def run(checkpoint):
        start_measurement_stream(
            spark, str(landing), store, str(tmp_path / checkpoint), str(tmp_path / "staging"),
            as_of=AS_OF, reports=reports,
        ).awaitTermination()

    land(landing, "a.json", [measurement(FIRST, 1.0)], "garbage")
    run("one")
    land(landing, "b.json", [measurement(FIRST + timedelta(hours=30), 2.0), measurement(FIRST, 3.0)])
    run("one")
    run("one")
    assert [(r.good, r.quarantined, r.inserted) for r in reports] == [(1, 1, 1), (2, 0, 2)]
    once = stored(store)
    run("lost")  # a new checkpoint replays everything
    assert stored(store) == once and reports[-1].inserted == 0


def test_stream_reads_late_files_with_an_old_time(spark, tmp_path, store):
    import os
    import time

    landing = tmp_path / "landing"

    def run():
        start_measurement_stream(
            spark, str(landing), store, str(tmp_path / "checkpoint"), str(tmp_path / "staging"), as_of=AS_OF
        ).awaitTermination()

    land(landing, "a.json", [measurement(FIRST, 1.0, 1)])
    run()
    old = land(landing, "b.json", [measurement(FIRST, 1.0, 2)])
    os.utime(old, (time.time() - 10 * 86400,) * 2)
    land(landing, "c.json", [measurement(FIRST, 1.0, 3)])
    run()
    assert rows(store.read(), "location_id") == [(1,), (2,), (3,)]


def test_whole_files_in_loads_and_the_stream(spark, tmp_path, store):
    landing = tmp_path / "landing"
    landing.mkdir()
    for n in (1, 2):
        found = [measurement(FIRST + timedelta(minutes=m), float(m), n) for m in range(7)]
        (landing / f"{n}.json").write_text(json.dumps({"results": found}, indent=2))
    window = (FIRST, FIRST + timedelta(hours=1))
    report = L.load_window(spark, str(landing), store, *window, whole_files=True)
    assert (report.good, report.quarantined, report.inserted) == (14, 0, 14)
    again = FactStore(spark, str(tmp_path / "again"), store.hourly)
    start_measurement_stream(
        spark, str(landing), again, str(tmp_path / "checkpoint"), str(tmp_path / "staging"), whole_files=True
    ).awaitTermination()
    assert stored(again) == stored(store)


def test_alerts_are_posted_once(spark, tmp_path):
    from aeromart.sources.outbox import Outbox

    data = [(1, c, "pm25", v, FIRST, FIRST, None) for c, v in (("AA", 9.0), ("BB", 1.0))]
    fact, outbox = spark.createDataFrame(data, S.FACT_MEASURE), Outbox(spark, str(tmp_path / "outbox"))
    assert outbox.messages() is None
    assert L.post_alerts(fact, outbox, FIRST, recipients="a@x").count() == 1
    assert L.post_alerts(fact, outbox, FIRST, recipients="a@x,b@x").select("recipient").collect() == [("b@x",)]
    assert L.post_alerts(fact, outbox, FIRST, recipients="a@x,b@x").count() == 0
    # a run whose job never committed has sent nothing
    broken = next(p for p in (tmp_path / "outbox").glob("run=*/_SUCCESS") if outbox.messages().count() == 2)
    broken.unlink()
    left = outbox.messages()
    assert (0 if left is None else left.count()) < 2
    L.post_alerts(fact, outbox, FIRST, recipients="a@x,b@x")
    assert sorted(outbox.messages().select("recipient").collect()) == [("a@x",), ("b@x",)]


def test_shared_folder_comes_from_the_session(spark, monkeypatch):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = (sizing.shared_dir(spark, "x") for _ in range(2))
    assert one.startswith(base) and one != two


def test_no_private_folder_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        sizing.shared_dir(Session(), "x")
