"""The sample tables in the shape of the star schema, its staging rows and its payloads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = datetime(2024, 2, 1)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def located_events(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    customer = table(spark, folder, "customer")
    return events.join(customer, events["user_id"] == customer["c_custkey"])


def fact(spark: SparkSession, folder: str) -> DataFrame:
    return located_events(spark, folder).select(
        F.col("user_id").alias("location_id"),
        F.col("c_nationkey").cast("string").alias("country_code"),
        F.col("event_type").alias("parameter_code"),
        "value",
        F.col("ts").alias("date_local"),
        F.col("ts").alias("date_utc"),
        _null("timestamp_ntz").alias("updated_at"),
    )


def redelivered_measures(spark: SparkSession, folder: str) -> DataFrame:
    """Every measurement delivered again with its region as country and a shifted local time;
    clicks with a corrected value, errors without a location."""
    nation = table(spark, folder, "nation")
    rows = located_events(spark, folder)
    rows = rows.join(nation, rows["c_nationkey"] == nation["n_nationkey"])
    return rows.select(
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("locationid"),
        F.col("event_type").alias("parameter"),
        F.when(F.col("event_type") == "click", F.col("value") + 1000)
        .otherwise(F.col("value"))
        .alias("value"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("country"),
        F.col("ts").alias("date_utc"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("date_local"),
    )


def dim_location(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("city"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("string").alias("country_code"),
        F.concat(F.lit("old "), F.col("c_mktsegment")).alias("country_name"),
        _null("string").alias("sources"),
        F.lit(False).alias("ismobile"),
        _null("boolean").alias("isanalysis"),
        F.lit("fixed").alias("sensortype"),
        F.col("c_acctbal").alias("coordinates_latitude"),
        F.lit(0.0).alias("coordinates_longitude"),
        _null("timestamp_ntz").alias("updated_at"),
    )


def staged_locations(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as delivered locations; the stride lets some ids meet customers and some not."""
    return table(spark, folder, "supplier").select(
        (F.col("s_suppkey") * 20).alias("id"),
        F.lit("harbour").alias("city"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("string").alias("country"),
        F.concat(F.lit('["'), F.col("s_name"), F.lit('"]')).alias("sources"),
        F.lit(True).alias("ismobile"),
        F.lit(False).alias("isanalysis"),
        F.lit("mobile").alias("sensortype"),
        F.col("s_acctbal").alias("coordinates_latitude"),
        F.lit(1.0).alias("coordinates_longitude"),
    )


def dim_parameter(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("code"),
        F.col("p_brand").alias("displayname"),
        F.col("p_type").alias("description"),
        F.col("p_size").cast("string").alias("preferredunit"),
        _null("timestamp_ntz").alias("updated_at"),
    )


def staged_parameters(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        (F.col("c_custkey") * 2).alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("displayname"),
        F.concat(F.lit("segment "), F.col("c_mktsegment")).alias("description"),
        F.col("c_nationkey").cast("string").alias("preferredunit"),
    )


def event_types(spark: SparkSession, folder: str) -> DataFrame:
    """The parameters that the events measure, as a dimension."""
    codes = table(spark, folder, "events").select(F.col("event_type").alias("code")).distinct()
    return codes.select(
        "code",
        F.concat(F.lit("type "), F.col("code")).alias("displayname"),
        F.lit("units").alias("preferredunit"),
    )


def event_type_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """The same parameters as a payload; their first letters differ and serve as ids."""
    kinds = event_types(spark, folder)
    return kinds.select(
        body_of(
            F.ascii("code").alias("id"),
            F.col("code").alias("name"),
            F.col("displayname").alias("displayName"),
            F.col("preferredunit").alias("preferredUnit"),
        )
    )


def countries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("name")
    )


def region_names(spark: SparkSession, folder: str) -> DataFrame:
    """Regions as a country list: it names some of the country codes and leaves others out."""
    return table(spark, folder, "region").select(
        F.col("r_regionkey").cast("string").alias("code"), F.col("r_name").alias("name")
    )


def body_of(*fields: Column) -> Column:
    return F.to_json(F.struct(F.array(F.struct(*fields)).alias("results"))).alias("body")


def iso(ts: Column, offset: str = "") -> Column:
    return F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit(offset))


def location_bodies(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        body_of(
            F.col("c_custkey").alias("id"),
            F.col("c_mktsegment").alias("city"),
            F.col("c_name").alias("name"),
            F.lit("community").alias("entity"),
            F.col("c_nationkey").cast("string").alias("country"),
            F.array(
                F.struct(F.col("c_mktsegment").alias("name"), F.col("c_custkey").alias("id"))
            ).alias("sources"),
            (F.col("c_acctbal") < 0).alias("isMobile"),
            F.lit("fixed").alias("sensorType"),
            F.lit("2024-01-05T06:07:08+00:00").alias("lastUpdated"),
            F.struct(
                F.col("c_acctbal").alias("latitude"), F.lit(2.5).alias("longitude")
            ).alias("coordinates"),
            F.array(F.lit("dropped")).alias("parameters"),
            F.array(F.lit(1.0), F.lit(2.0)).alias("bounds"),
        )
    )


def country_bodies(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        body_of(
            F.col("n_nationkey").cast("string").alias("code"),
            F.col("n_name").alias("name"),
            F.col("n_regionkey").alias("locations"),
        )
    )


def parameter_bodies(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        body_of(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("displayName"),
            F.col("p_type").alias("description"),
            F.col("p_size").alias("preferredUnit"),
        )
    )


def _measurement() -> list[Column]:
    ts = F.col("ts")
    return [
        F.col("user_id").alias("locationId"),
        F.col("c_name").alias("location"),
        F.col("event_type").alias("parameter"),
        F.col("value"),
        F.lit("ug/m3").alias("unit"),
        F.col("c_nationkey").cast("string").alias("country"),
        F.col("c_mktsegment").alias("city"),
        F.lit(False).alias("isMobile"),
        F.struct(
            iso(ts, "+00:00").alias("utc"), iso(ts - F.expr("INTERVAL 3 HOURS"), "-03:00").alias("local")
        ).alias("date"),
        F.struct(F.col("c_acctbal").alias("latitude"), F.lit(2.5).alias("longitude")).alias("coordinates"),
    ]


def measurement_bodies(rows: DataFrame) -> DataFrame:
    """One body per located event."""
    return rows.select(body_of(*_measurement()))


def pretty_measurement_bodies(rows: DataFrame) -> DataFrame:
    """Bodies of many lines, each with the events of a thousand neighbouring ids at most."""
    grouped = rows.groupBy(F.floor(F.col("event_id") / 1000)).agg(F.collect_list(F.struct(*_measurement())).alias("results"))
    return grouped.select(F.to_json(F.struct("results"), {"pretty": "true"}).alias("body"))


def extended_measurement_bodies(rows: DataFrame) -> DataFrame:
    """Measurements with fields that no table holds: a device, a list and a field whose type differs between rows."""
    device = F.struct(
        F.col("event_id").alias("serial"), F.struct(F.col("c_mktsegment").alias("maker"), F.col("c_acctbal").alias("gain")).alias("model")
    )
    mixed = F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(F.col("event_id").alias("n"))))
    extra = [device.alias("device"), F.array(F.col("event_id"), F.col("user_id")).alias("channels"), mixed.alias("remark")]
    return rows.select(body_of(*_measurement(), *extra))


def alert_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rules from the regions: each asks for some event types, by one or two people, in its own span of days."""
    key = F.col("r_regionkey")
    first = F.when(key != 0, F.date_add(F.lit("2024-01-01").cast("date"), 5 * key))
    return table(spark, folder, "region").select(
        key.alias("rule_id"),
        F.when(key != 1, F.when(key % 2 == 0, " view,click ,view").otherwise("error, Purchase ,signup")).alias("parameters"),
        F.concat(F.lit("ops@example.org, ,"), F.when(key > 1, F.concat(F.lower("r_name"), F.lit("@example.org"))).otherwise("")).alias("recipients"),
        first.alias("first_day"),
        F.when(key != 3, F.date_add(first, 9)).alias("last_day"),
    )
