from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from aeromart import schemas as S
from aeromart.operators import merge as M
from tests.conftest import plan, rows

AS_OF = datetime(2024, 1, 1)
TARGET = "id int, v string, keep string, updated_at timestamp_ntz"


def target(spark, *found):
    return spark.createDataFrame([(i, v, "k", None) for i, v in found], TARGET)


def source(spark, *found):
    return spark.createDataFrame(list(found), "id int, v string")


def merge(t, s, **options):
    options = {"as_of": AS_OF, "action": "action", **options}
    return M.scd1_merge(t, s, {"id": "id"}, {"v": "v"}, {"id": "id", "v": "v"}, **options)


def outcome(merged):
    return rows(merged, "id", "v", "keep", "updated_at", "action")


BOTH = pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])


@BOTH
def test_reference_case(spark, strategy):
    t = target(spark, (1, "a"), (1, "a2"), (2, "b"), (None, "n"))
    s = source(spark, (1, "A"), (3, "C"), (3, "C2"), (None, "N"))
    assert outcome(merge(t, s, strategy=strategy)) == sorted(
        [
            (1, "A", "k", AS_OF, "updated"),
            (1, "A", "k", AS_OF, "updated"),
            (2, "b", "k", None, "kept"),
            (3, "C", None, None, "inserted"),
            (3, "C2", None, None, "inserted"),
            (None, "n", "k", None, "kept"),
            (None, "N", None, None, "inserted"),
        ],
        key=repr,
    )


@BOTH
def test_duplicate_source_keys(spark, strategy):
    t = target(spark, (1, "a"))
    s = source(spark, (1, "A"), (1, "B"), (2, "C"), (2, "D"))
    with pytest.raises(PySparkException, match="several source rows match one target row: 1"):
        merge(t, s, strategy=strategy).collect()
    with pytest.raises(PySparkException, match="several source rows"):
        merge(t, s, strategy=strategy).count()
    every = merge(t, s, strategy=strategy, on_duplicate="insert_all")
    assert rows(every, "id", "v") == [(1, "B"), (2, "C"), (2, "D")]
    single = merge(t, s, strategy=strategy, on_duplicate="dedupe")
    assert rows(single, "id", "v") == [(1, "B"), (2, "D")]


def test_dedupe_order(spark):
    s = spark.createDataFrame([(1, "z", 1), (1, "a", 2)], "id int, v string, seen int")
    merged = merge(target(spark, (1, "x")), s, on_duplicate="dedupe", order_by=["seen"])
    assert rows(merged, "v") == [("a",)]


def test_options(spark):
    t, s = target(spark, (1, "a"), (2, "b")), source(spark, (1, "a"), (2, "B"), (3, "c"))
    stamps = dict(rows(merge(t, s), "id", "updated_at"))
    assert stamps == {1: AS_OF, 2: AS_OF, 3: None}
    stamps = dict(rows(merge(t, s, only_if_changed=True, stamp_inserts=True), "id", "updated_at"))
    assert stamps == {1: None, 2: AS_OF, 3: AS_OF}
    now = merge(t, s, as_of=None)
    assert dict(now.dtypes)["updated_at"] == "timestamp_ntz"
    for wrong in ({"on_duplicate": "x"}, {"strategy": "x"}):
        with pytest.raises(ValueError):
            merge(t, s, **wrong)


def test_other_key_types_and_zero(spark):
    t = spark.createDataFrame([(0.0, "a"), (float("nan"), "b")], "k double, v string")
    s = spark.createDataFrame([(-0.0, "A"), (float("nan"), "B"), (7.0, "C")], "k double, v string")
    for strategy in ("broadcast", "shuffle"):
        merged = M.scd1_merge(
            t, s, {"k": "k"}, {"v": "v"}, {"k": "k", "v": "v"}, strategy=strategy
        )
        assert [v for (v,) in rows(merged, "v")] == ["A", "B", "C"]
    long_keys = spark.createDataFrame([(1, "A")], "id long, v string")
    merged = merge(target(spark, (1, "a")), long_keys, strategy="shuffle")
    assert rows(merged, "v", "action") == [("A", "updated")]


def expected(t, s, on_duplicate):
    """The merge rules as plain loops."""
    by_key = {}
    for key, value in s:
        if key is not None:
            by_key.setdefault(key, []).append(value)
    held = {key for key, _ in t if key is not None}
    if on_duplicate == "error" and any(len(v) > 1 and k in held for k, v in by_key.items()):
        return None
    out = []
    for key, value in t:
        if key in by_key:
            out.append((key, max(by_key[key]), "k", AS_OF, "updated"))
        else:
            out.append((key, value, "k", None, "kept"))
    for key, values in by_key.items():
        if key not in held:
            chosen = [max(values)] if on_duplicate == "dedupe" else values
            out += [(key, v, None, None, "inserted") for v in chosen]
    out += [(None, v, None, None, "inserted") for key, v in s if key is None]
    return sorted(out, key=repr)


ROWS = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.sampled_from("abc")), max_size=8
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(t=ROWS, s=ROWS)
@pytest.mark.parametrize("on_duplicate", M.ON_DUPLICATE)
@BOTH
def test_equals_plain_loops(spark, strategy, on_duplicate, t, s):
    merged = merge(
        target(spark, *t), source(spark, *s), strategy=strategy, on_duplicate=on_duplicate
    )
    want = expected(t, s, on_duplicate)
    if want is None:
        with pytest.raises(PySparkException, match="several source rows"):
            merged.collect()
    else:
        assert outcome(merged) == want


def test_merging_twice_changes_no_rows(spark):
    t, s = target(spark, (1, "a"), (2, "b")), source(spark, (2, "B"), (3, "C"))
    once = merge(t, s, action=None)
    assert rows(merge(once, s, action=None), "id", "v") == rows(once, "id", "v")


def test_row_order_and_partitions_do_not_matter(spark):
    t = spark.range(200).selectExpr("cast(id as int) id", "'a' v", "'k' keep", "cast(null as timestamp_ntz) updated_at")
    s = spark.range(100, 500).selectExpr("cast(id % 250 as int) id", "cast(id as string) v")
    results = [
        rows(merge(t.repartition(n), s.repartition(n, "v"), strategy=how, on_duplicate="dedupe"))
        for n in (1, 7)
        for how in ("broadcast", "shuffle")
    ]
    assert all(r == results[0] for r in results)


# --- Plans ---------------------------------------------------------------------------------------


def test_joins_are_not_hinted(spark, tmp_path):
    t = spark.range(1000).selectExpr("cast(id as int) id", "'a' v", "'k' keep", "cast(null as timestamp_ntz) updated_at")
    s = t.select("id", "v")
    t.write.parquet(str(tmp_path / "t"))
    s.write.parquet(str(tmp_path / "s"))
    t, s = (spark.read.parquet(str(tmp_path / n)) for n in "ts")
    merged = merge(t, s, on_duplicate="dedupe")
    assert "ResolvedHint" not in merged._jdf.queryExecution().analyzed().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        large = plan(merge(t, s, on_duplicate="dedupe"))
        assert "SortMergeJoin LeftOuter" in large and "SortMergeJoin LeftAnti" in large
        assert "Broadcast" not in large
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_floating_keys_cost_no_further_shuffle(spark, tmp_path):
    """As many exchanges for the keys of a measurement as without the value among them."""
    at = "timestamp_ntz'2023-12-19 00:00:00' + make_dt_interval(0, cast(id % 24 as int))"
    fact = spark.range(1000).selectExpr(
        "cast(id as int) location_id", "'AA' country_code", "'p' parameter_code", "cast(id as double) value",
        f"{at} date_local", f"{at} date_utc", "cast(null as timestamp_ntz) updated_at")
    new = fact.selectExpr("location_id locationid", "country_code country", "parameter_code parameter", "value", "date_utc", "date_local")
    fact.write.parquet(str(tmp_path / "f"))
    new.write.parquet(str(tmp_path / "n"))
    fact, new = (spark.read.parquet(str(tmp_path / n)) for n in "fn")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = {k: v for k, v in M.MEASURE_KEYS.items() if k != "value"}
        counts = [
            M.merge_measures(fact, new, keys, on_duplicate="dedupe")._jdf.queryExecution().executedPlan().toString()
            .count("Exchange hashpartitioning") for keys in (None, plain)
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert counts[0] == counts[1]


def test_the_default_stamp_is_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        stamp = merge(target(spark, (1, "a")), source(spark, (1, "b")), as_of=None).selectExpr("cast(updated_at as string)").first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    from datetime import timezone

    assert abs((datetime.now(timezone.utc).replace(tzinfo=None) - datetime.fromisoformat(stamp)).total_seconds()) < 120


HOT = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "60KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "30KB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "8",
}


def final_plan(df, tmp_path):
    counted = df.groupBy("action").agg(F.count("*").alias("n"), F.max("v"), F.max("id"))
    found = {r.action: r.n for r in counted.collect()}
    return found, counted._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    ("side", "on_duplicate"),
    [
        ("target", "error"), ("target_null", "error"), ("source", "error"), ("source_null", "error"),
        ("target", "dedupe"), ("target_null", "dedupe"), ("source", "dedupe"),
    ],
)
def test_hot_keys_are_split_over_tasks(spark, tmp_path, side, on_duplicate):
    """A third of all rows with one key, or without one, does not end up in one task."""
    hot = F.lit(None).cast("int") if side.endswith("null") else F.lit(-1)
    many = spark.range(150_000).select(
        F.when(F.col("id") % 3 == 0, hot).otherwise(F.col("id")).cast("int").alias("id"),
        F.col("id").cast("string").alias("v"),
    )
    few = spark.range(30_000).select(F.col("id").cast("int").alias("id"), F.lit("new").alias("v"))
    many.write.parquet(str(tmp_path / "many"))
    few.write.parquet(str(tmp_path / "few"))
    many, few = (spark.read.parquet(str(tmp_path / n)) for n in ("many", "few"))
    big, other = (many, few) if side.startswith("target") else (few, many)
    big = big.selectExpr("id", "v", "'k' keep", "cast(null as timestamp_ntz) updated_at")
    old = {key: spark.conf.get(key) for key in HOT}
    for key, setting in HOT.items():
        spark.conf.set(key, setting)
    try:
        found, text = final_plan(
            merge(big, other, strategy="shuffle", on_duplicate=on_duplicate), tmp_path
        )
    finally:
        for key, setting in old.items():
            spark.conf.set(key, setting)
    # 20,000 of the 30,000 keys below 30,000 occur in the larger table.
    if side.startswith("target"):
        assert found == {"updated": 20_000, "kept": 130_000, "inserted": 10_000}
    elif on_duplicate == "dedupe":
        # The hot key is one row before the shuffle already: nothing is left to split.
        assert found == {"updated": 20_000, "kept": 10_000, "inserted": 80_001}
        return
    else:
        assert found == {"updated": 20_000, "kept": 10_000, "inserted": 130_000}
    assert "skew=true" in text


# --- The merges of the star schema ---------------------------------------------------------------


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def staged(spark, rules, *found):
    schema = S.staging_schema(rules)
    return spark.createDataFrame(
        [tuple(row.get(f.name) for f in schema.fields) for row in found], schema
    )


def test_locations_and_country_names(spark):
    def at(number, country, city="c"):
        return {"id": number, "country": country, "city": city, "name": "n", "ismobile": True}

    countries = spark.createDataFrame(
        [("AA", "Aland"), ("BB", "Bland"), (None, "Nowhere")], "code string, name string"
    )
    first = M.merge_locations(
        empty(spark, S.DIM_LOCATION),
        staged(spark, S.STG_LOCATIONS, at(1, "AA"), at(2, "AA"), at(3, "CC"), at(4, None)),
        as_of=AS_OF,
    )
    assert rows(first, "country_name", "updated_at") == [(None, None)] * 4
    named = M.update_country_names(first, countries)
    names = dict(rows(named, "id", "country_name"))
    assert names == {1: "Aland", 2: "Aland", 3: None, 4: None}
    assert rows(named, "updated_at") == [(None,)] * 4
    moved = M.merge_locations(
        named, staged(spark, S.STG_LOCATIONS, at(1, "BB"), at(2, "CC", "d")), as_of=AS_OF
    )
    got = {r.id: (r.country_code, r.country_name, r.city, r.updated_at) for r in moved.collect()}
    assert got[1] == ("BB", "Aland", "c", AS_OF)
    assert got[2] == ("CC", "Aland", "d", AS_OF)
    assert got[3] == ("CC", None, "c", None)
    again = dict(rows(M.update_country_names(moved, countries), "id", "country_name"))
    assert again == {1: "Bland", 2: "Aland", 3: None, 4: None}
    assert again and moved.columns == S.DIM_LOCATION.names


def test_two_names_for_one_country(spark):
    dim = staged(spark, S.STG_LOCATIONS, {"id": 1, "country": "AA"})
    dim = M.merge_locations(empty(spark, S.DIM_LOCATION), dim)
    twice = spark.createDataFrame([("AA", "x"), ("AA", "y")], "code string, name string")
    assert rows(M.update_country_names(dim, twice), "country_name") == [("y",)]
    with pytest.raises(PySparkException, match="several names for country AA"):
        M.update_country_names(dim, twice, on_duplicate="error").collect()


def test_parameters(spark):
    def p(number, name):
        return {"id": number, "name": name, "displayname": name.upper(), "preferredunit": "u"}

    first = M.merge_parameters(
        empty(spark, S.DIM_PARAMETER), staged(spark, S.STG_PARAMETERS, p(1, "a"), p(2, "b"))
    )
    second = M.merge_parameters(
        first, staged(spark, S.STG_PARAMETERS, p(2, "bb"), p(3, "c")), as_of=AS_OF
    )
    assert rows(second, "id", "code", "displayname", "updated_at") == [
        (1, "a", "A", None), (2, "bb", "BB", AS_OF), (3, "c", "C", None)
    ]


def test_measures_by_value_or_without_it(spark):
    def m(value, country="AA"):
        return {
            "locationid": 1, "parameter": "pm25", "value": value, "country": country,
            "date_utc": datetime(2023, 12, 19, 10), "date_local": datetime(2023, 12, 19, 7),
        }

    first = M.merge_measures(
        empty(spark, S.FACT_MEASURE), staged(spark, S.STG_MEASUREMENTS, m(1.0))
    )
    corrected = staged(spark, S.STG_MEASUREMENTS, m(2.0), m(1.0, "BB"))
    assert rows(M.merge_measures(first, corrected, as_of=AS_OF), "value", "country_code", "updated_at") == [
        (1.0, "BB", AS_OF), (2.0, "AA", None)
    ]
    keys = {k: v for k, v in M.MEASURE_KEYS.items() if k != "value"}
    only = staged(spark, S.STG_MEASUREMENTS, m(2.0))
    assert rows(M.merge_measures(first, only, keys=keys), "value") == [(2.0,)]
