"""Every operator as a query over the whole sample tables, next to the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import text as X
from ..functions import times as H
from ..operators import alerts as A
from ..operators import merge as M
from ..operators import metrics, star
from ..operators import variants as V
from ..operators.coverage import gaps, islands
from ..operators.flatten import flatten
from ..operators.validate import problems
from ..sources import envelope as E
from ..sources import payloads as P
from ..sources.loadlog import LoadLog
from ..sources.outbox import Outbox
from ..sources.partials import PartialStore
from ..sources.quarantine import Quarantine
from ..sources.staging import stage
from ..sources.tables import FactStore, create_star_schema
from ..streaming.measurements import start_measurement_stream
from . import loads as L
from . import sample as D
from .sizing import shared_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        SQL[run.__name__] = sql
        return run

    return add


def six(*names: str) -> list:
    """Means to six places, halves away from zero."""
    return [F.round(F.col(n), 6).alias(n) for n in names]


def units(value: str) -> str:
    """A value in whole units of the ninth place, of which any number adds up exactly."""
    return f"CAST(CAST(CAST({value} AS DECIMAL(18, 9)) AS DECIMAL(28, 9)) * 1000000000 AS HUGEINT)"


def six_sql(total: str, count: str) -> str:
    """The mean of ``count`` values with the sum ``total`` (in units) to six places, in whole numbers until the end."""
    millionths = f"(2 * abs({total}) + 1000 * {count}) // (2000 * {count})"
    return f"CAST(sign({total}) * {millionths} AS DOUBLE) / 1000000"


FACT_SQL = """
  SELECT e.user_id AS location_id, CAST(c.c_nationkey AS VARCHAR) AS country_code,
         e.event_type AS parameter_code, e.value, e.ts AS date_local, e.ts AS date_utc
  FROM events e JOIN customer c ON c.c_custkey = e.user_id"""

MEANS_SQL = f"""
  f AS ({FACT_SQL}),
  g AS (SELECT country_code, CAST(date_utc AS DATE) AS measure_date, parameter_code,
               sum({units("value")}) AS s, count(value) AS n
        FROM f GROUP BY ALL),
  b AS (SELECT measure_date, parameter_code, CAST(sum(s) AS HUGEINT) AS bs, CAST(sum(n) AS HUGEINT) AS bn
        FROM g GROUP BY ALL),
  m6 AS (SELECT country_code, measure_date, parameter_code, {six_sql("s", "n")} AS avg_value FROM g),
  a AS (SELECT g.country_code, g.measure_date, g.parameter_code, {six_sql("g.s", "g.n")} AS avg_value,
               {six_sql("b.bs", "b.bn")} AS base_value
        FROM g JOIN b USING (measure_date, parameter_code) WHERE g.s * b.bn > b.bs * g.n)"""


# --- Daily alerts --------------------------------------------------------------------------------


@query(f"""WITH {MEANS_SQL}
SELECT country_code, measure_date, parameter_code, avg_value, base_value FROM a""")
def alert_above_average(spark: SparkSession, folder: str) -> DataFrame:
    found = A.above_average(D.fact(spark, folder))
    return found.select(
        "country_code", "measure_date", "parameter_code", *six("avg_value", "base_value")
    )


@query(f"""WITH {MEANS_SQL}
SELECT country_code, measure_date, parameter_code, avg_value
FROM a WHERE measure_date = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def alert_newest_day(spark: SparkSession, folder: str) -> DataFrame:
    found = A.above_average_of_day(D.fact(spark, folder))
    return found.select("country_code", "measure_date", "parameter_code", *six("avg_value"))


@query(f"""WITH {MEANS_SQL}
SELECT country_code, measure_date, parameter_code, avg_value
FROM a WHERE parameter_code IN ('view', 'error', 'purchase', 'signup')""")
def alert_listed_parameters(spark: SparkSession, folder: str) -> DataFrame:
    """A configured list: blanks do not count, capital letters do."""
    listed = " view,error , purchase,signup, Click"
    found = A.above_average(D.fact(spark, folder), parameters=listed)
    return found.select("country_code", "measure_date", "parameter_code", *six("avg_value"))


@query(f"""WITH {MEANS_SQL}
SELECT country_code, measure_date, parameter_code, avg_value FROM m6""")
def country_means(spark: SparkSession, folder: str) -> DataFrame:
    found = A.country_means(A.country_partials(D.fact(spark, folder)))
    return found.select("country_code", "measure_date", "parameter_code", *six("avg_value"))


@query(f"""WITH {MEANS_SQL}
SELECT measure_date, parameter_code, {six_sql("bs", "bn")} AS base_value FROM b""")
def overall_means(spark: SparkSession, folder: str) -> DataFrame:
    found = A.overall_means(A.country_partials(D.fact(spark, folder)))
    return found.select("measure_date", "parameter_code", *six("base_value"))


@query(f"""WITH {MEANS_SQL}
SELECT g.measure_date, g.parameter_code, count(*) AS countries,
       count(a.country_code) AS alerts, count(a.country_code) > 0 AS send
FROM g LEFT JOIN a USING (country_code, measure_date, parameter_code)
GROUP BY g.measure_date, g.parameter_code""")
def alert_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return A.alert_outcomes(D.fact(spark, folder))


MESSAGES_SQL = f"""WITH {MEANS_SQL},
  m AS (SELECT measure_date, parameter_code, CAST(count(*) AS INTEGER) AS countries,
    string_agg(country_code, ', ' ORDER BY country_code) AS country_list,
    '[ALERT] Abnormal values on ' || parameter_code AS subject,
    '<html><head></head><body>\n<p>Countries with ' || parameter_code
      || ' value above the daily average for (' || CAST(measure_date AS VARCHAR)
      || '):</p>\n<table border="1" class="dataframe">\n  <thead>\n    <tr>\n'
      || '      <th>country_code</th>\n      <th>date</th>\n      <th>parameter_code</th>\n'
      || '      <th>avg</th>\n    </tr>\n  </thead>\n  <tbody>\n'
      || string_agg('    <tr>\n      <td>' || country_code || '</td>\n      <td>'
           || CAST(measure_date AS VARCHAR) || '</td>\n      <td>' || parameter_code
           || '</td>\n      <td>' || printf('%.6f', avg_value) || '</td>\n    </tr>\n', ''
           ORDER BY country_code)
      || '  </tbody>\n</table>\n</body></html>' AS body
  FROM a GROUP BY measure_date, parameter_code)"""


@query(f"{MESSAGES_SQL} SELECT * FROM m")
def alert_messages(spark: SparkSession, folder: str) -> DataFrame:
    return A.alert_messages(A.above_average(D.fact(spark, folder)))


ADDRESSED_SQL = f"""{MESSAGES_SQL},
  r AS (SELECT m.*, p.recipient, sha256('10:' || CAST(measure_date AS VARCHAR)
               || length(parameter_code) || ':' || parameter_code
               || length(p.recipient) || ':' || p.recipient) AS alert_id
        FROM m, (VALUES ('ops@example.org'), ('lab@example.org')) p(recipient))"""


@query(f"{ADDRESSED_SQL} SELECT measure_date, parameter_code, subject, recipient, alert_id FROM r")
def alert_recipients(spark: SparkSession, folder: str) -> DataFrame:
    messages = A.alert_messages(A.above_average(D.fact(spark, folder)))
    addressed = A.address(messages, "ops@example.org, lab@example.org")
    return addressed.select("measure_date", "parameter_code", "subject", "recipient", "alert_id")


@query(f"""{ADDRESSED_SQL}
SELECT measure_date, parameter_code, recipient, alert_id FROM r
WHERE recipient <> 'lab@example.org'""")
def alerts_not_yet_sent(spark: SparkSession, folder: str) -> DataFrame:
    """A retry after everything for one of two recipients has gone out."""
    messages = A.alert_messages(A.above_average(D.fact(spark, folder)))
    sent = A.address(messages, ["lab@example.org"])
    both = A.address(messages, ["ops@example.org", "lab@example.org"])
    left = A.not_yet_sent(both, sent)
    return left.select("measure_date", "parameter_code", "recipient", "alert_id")


# --- Merges --------------------------------------------------------------------------------------

REDELIVERED_SQL = """
  SELECT CASE WHEN e.event_type <> 'error' THEN e.user_id END AS locationid,
         e.event_type AS parameter,
         CASE WHEN e.event_type = 'click' THEN e.value + 1000 ELSE e.value END AS value,
         'R' || CAST(n.n_regionkey AS VARCHAR) AS country, e.ts AS date_utc,
         e.ts + INTERVAL 1 HOUR AS date_local
  FROM events e JOIN customer c ON c.c_custkey = e.user_id
                JOIN nation n ON n.n_nationkey = c.c_nationkey"""

MERGED_FACT_SQL = f"""WITH t AS ({FACT_SQL}), s AS ({REDELIVERED_SQL}),
  m AS (SELECT t.location_id, coalesce(s.country, t.country_code) AS country_code,
               t.parameter_code, t.value, coalesce(s.date_local, t.date_local) AS date_local,
               t.date_utc,
               CASE WHEN s.parameter IS NOT NULL THEN TIMESTAMP '2024-02-01' END AS updated_at,
               CASE WHEN s.parameter IS NOT NULL THEN 'updated' ELSE 'kept' END AS action
        FROM t LEFT JOIN s ON s.locationid = t.location_id AND s.parameter = t.parameter_code
                          AND s.value = t.value AND s.date_utc = t.date_utc
        UNION ALL
        SELECT s.locationid, s.country, s.parameter, s.value, s.date_local, s.date_utc, NULL,
               'inserted'
        FROM s WHERE NOT EXISTS (SELECT 1 FROM t
          WHERE s.locationid = t.location_id AND s.parameter = t.parameter_code
            AND s.value = t.value AND s.date_utc = t.date_utc))"""


@query(f"{MERGED_FACT_SQL} SELECT * FROM m")
def merge_fact(spark: SparkSession, folder: str) -> DataFrame:
    return M.merge_measures(
        D.fact(spark, folder),
        D.redelivered_measures(spark, folder),
        as_of=D.AS_OF,
        action="action",
    )


@query(f"""{MERGED_FACT_SQL}
SELECT count(*) FILTER (action = 'kept') AS kept, count(*) FILTER (action = 'updated') AS updated,
       count(*) FILTER (action = 'inserted') AS inserted FROM m""")
def merge_counts(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.action_counts(merge_fact(spark, folder), "action")


DIM_LOCATION_SQL = """
  SELECT c_custkey AS id, c_mktsegment AS city, c_name AS name,
         CAST(c_nationkey AS VARCHAR) AS country_code, 'old ' || c_mktsegment AS country_name,
         CAST(NULL AS VARCHAR) AS sources, false AS ismobile, CAST(NULL AS BOOLEAN) AS isanalysis,
         'fixed' AS sensortype, c_acctbal AS coordinates_latitude,
         CAST(0 AS DOUBLE) AS coordinates_longitude, CAST(NULL AS TIMESTAMP) AS updated_at
  FROM customer"""
STAGED_LOCATION_SQL = """
  SELECT s_suppkey * 20 AS id, 'harbour' AS city, s_name AS name,
         CAST(s_nationkey AS VARCHAR) AS country, '["' || s_name || '"]' AS sources,
         true AS ismobile, false AS isanalysis, 'mobile' AS sensortype,
         s_acctbal AS coordinates_latitude, CAST(1 AS DOUBLE) AS coordinates_longitude
  FROM supplier"""
MERGED_LOCATION_SQL = f"""
  t AS ({DIM_LOCATION_SQL}), s AS ({STAGED_LOCATION_SQL}),
  m AS (SELECT id, city, name, country_code, country_name, sources, ismobile, isanalysis,
               sensortype, coordinates_latitude, coordinates_longitude, updated_at
        FROM t WHERE id NOT IN (SELECT id FROM s)
        UNION ALL
        SELECT s.id, s.city, s.name, s.country, t.country_name, s.sources, s.ismobile,
               s.isanalysis, s.sensortype, s.coordinates_latitude, s.coordinates_longitude,
               CASE WHEN t.id IS NOT NULL THEN TIMESTAMP '2024-02-01' END
        FROM s LEFT JOIN t ON t.id = s.id)"""


@query(f"WITH {MERGED_LOCATION_SQL} SELECT * FROM m")
def merge_dim_location(spark: SparkSession, folder: str) -> DataFrame:
    return M.merge_locations(
        D.dim_location(spark, folder), D.staged_locations(spark, folder), as_of=D.AS_OF
    )


MERGED_PARAMETER_SQL = """
  t AS (SELECT p_partkey AS id, p_name AS code, p_brand AS displayname, p_type AS description,
               CAST(p_size AS VARCHAR) AS preferredunit FROM part),
  s AS (SELECT c_custkey * 2 AS id, c_name AS code, c_mktsegment AS displayname,
               'segment ' || c_mktsegment AS description,
               CAST(c_nationkey AS VARCHAR) AS preferredunit FROM customer),
  m AS (SELECT *, CAST(NULL AS TIMESTAMP) AS updated_at FROM t WHERE id NOT IN (SELECT id FROM s)
        UNION ALL
        SELECT s.*, CASE WHEN t.id IS NOT NULL THEN TIMESTAMP '2024-02-01' END
        FROM s LEFT JOIN t ON t.id = s.id)"""


@query(f"WITH {MERGED_PARAMETER_SQL} SELECT * FROM m")
def merge_dim_parameter(spark: SparkSession, folder: str) -> DataFrame:
    return M.merge_parameters(
        D.dim_parameter(spark, folder), D.staged_parameters(spark, folder), as_of=D.AS_OF
    )


@query(f"""WITH t AS ({DIM_LOCATION_SQL}),
  s AS (SELECT o_custkey AS id, o_orderstatus AS city, o_orderpriority AS name,
               row_number() OVER (PARTITION BY o_custkey
                 ORDER BY o_orderkey DESC) AS rn FROM orders)
SELECT coalesce(t.id, s.id) AS id, coalesce(s.city, t.city) AS city,
       coalesce(s.name, t.name) AS name, t.country_name,
       CASE WHEN t.id IS NULL THEN 'inserted' WHEN s.id IS NULL THEN 'kept' ELSE 'updated' END
         AS action
FROM t FULL JOIN (SELECT * FROM s WHERE rn = 1) s ON s.id = t.id""")
def merge_newest_of_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Many source rows per key: orders as deliveries about their customer, the last one wins."""
    deliveries = D.table(spark, folder, "orders").select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderkey").alias("delivery"),
        F.col("o_orderstatus").alias("city"),
        F.col("o_orderpriority").alias("name"),
    )
    merged = M.scd1_merge(
        D.dim_location(spark, folder),
        deliveries,
        keys={"id": "id"},
        set_map={"city": "city", "name": "name"},
        insert_map={"id": "id", "city": "city", "name": "name"},
        as_of=D.AS_OF,
        on_duplicate="dedupe",
        order_by=["delivery"],
        action="action",
    )
    return merged.select("id", "city", "name", "country_name", "action")


def _order_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    return D.table(spark, folder, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("delivery"), F.col("o_orderstatus").alias("city")
    )


@query("""WITH t AS (SELECT s_suppkey * 20 AS id, s_name AS city FROM supplier),
  s AS (SELECT o_custkey AS id, o_orderkey AS delivery, o_orderstatus AS city FROM orders)
SELECT t.id, coalesce(n.city, t.city) AS city, CASE WHEN n.id IS NULL THEN 'kept' ELSE 'updated' END AS action
FROM t LEFT JOIN (SELECT id, arg_max(city, delivery) AS city FROM s GROUP BY id) n ON n.id = t.id
UNION ALL SELECT id, city, 'inserted' FROM s WHERE id NOT IN (SELECT id FROM t)""")
def merge_insert_all(spark: SparkSession, folder: str) -> DataFrame:
    """Several deliveries per key: the last one updates a row that is there, all are inserted where none is."""
    dim = D.staged_locations(spark, folder).select("id", F.col("name").alias("city"))
    keys = {"id": "id", "city": "city"}
    return M.scd1_merge(
        dim, _order_deliveries(spark, folder), {"id": "id"}, {"city": "city"}, keys, on_duplicate="insert_all",
        order_by=["delivery"], action="action",
    )


@query("""SELECT -1 - s_suppkey AS id, s_name AS city, 'kept' AS action FROM supplier
UNION ALL SELECT o_custkey, o_orderstatus, 'inserted' FROM orders""")
def merge_duplicates_of_new_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Under ``error``, duplicates of a key that is not in the target are all inserted."""
    dim = D.table(spark, folder, "supplier").select((-1 - F.col("s_suppkey")).alias("id"), F.col("s_name").alias("city"))
    keys = {"id": "id", "city": "city"}
    return M.scd1_merge(
        dim, _order_deliveries(spark, folder), {"id": "id"}, {"city": "city"}, keys, on_duplicate="error", action="action"
    )


@query("""SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN 'moved' ELSE c_mktsegment END AS city,
       CASE WHEN c_acctbal < 0 THEN TIMESTAMP '2024-02-01' END AS updated_at,
       CASE WHEN c_acctbal < 0 THEN 'updated' ELSE 'kept' END AS action FROM customer
UNION ALL SELECT -1 - s_suppkey, s_name, TIMESTAMP '2024-02-01', 'inserted' FROM supplier""")
def merge_changes_only(spark: SparkSession, folder: str) -> DataFrame:
    """``only_if_changed`` leaves equal rows and their stamp alone; ``stamp_inserts`` stamps new ones."""
    customer = D.table(spark, folder, "customer")
    moved = F.when(F.col("c_acctbal") < 0, "moved").otherwise(F.col("c_mktsegment"))
    new = D.table(spark, folder, "supplier").select((-1 - F.col("s_suppkey")).alias("id"), F.col("s_name").alias("city"))
    source = customer.select(F.col("c_custkey").alias("id"), moved.alias("city")).unionByName(new)
    dim = D.dim_location(spark, folder).select("id", "city", "updated_at")
    return M.scd1_merge(
        dim, source, {"id": "id"}, {"city": "city"}, {"id": "id", "city": "city"}, as_of=D.AS_OF,
        only_if_changed=True, stamp_inserts=True, action="action",
    )


@query(f"""WITH t AS ({DIM_LOCATION_SQL})
SELECT t.* REPLACE (coalesce(r.r_name, t.country_name) AS country_name)
FROM t LEFT JOIN region r ON CAST(r.r_regionkey AS VARCHAR) = t.country_code""")
def update_country_name(spark: SparkSession, folder: str) -> DataFrame:
    return M.update_country_names(D.dim_location(spark, folder), D.region_names(spark, folder))


@query(f"""WITH {MERGED_LOCATION_SQL}
SELECT m.* REPLACE (CAST(m.id AS INTEGER) AS id,
                    coalesce(n.n_name, m.country_name) AS country_name)
FROM m LEFT JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = m.country_code""")
def refresh_locations(spark: SparkSession, folder: str) -> DataFrame:
    """Merge, then country names, as a new snapshot of a table on disk."""
    dim, _, _ = create_star_schema(spark, shared_dir(spark, "star"))
    dim.publish(D.dim_location(spark, folder).withColumn("id", F.col("id").cast("int")))
    return L.refresh_locations(
        dim, D.staged_locations(spark, folder), D.countries(spark, folder), as_of=D.AS_OF
    )


@query(f"""WITH {MERGED_PARAMETER_SQL}
SELECT m.* REPLACE (CAST(id AS INTEGER) AS id) FROM m""")
def refresh_parameters(spark: SparkSession, folder: str) -> DataFrame:
    _, dim, _ = create_star_schema(spark, shared_dir(spark, "star"))
    dim.publish(D.dim_parameter(spark, folder).withColumn("id", F.col("id").cast("int")))
    return L.refresh_parameters(dim, D.staged_parameters(spark, folder), as_of=D.AS_OF)


@query("""SELECT event_id, sha1(length(CAST(user_id AS VARCHAR)) || ':' || CAST(user_id AS VARCHAR)
         || length(event_type) || ':' || event_type
         || length(CAST(event_id AS VARCHAR)) || ':' || CAST(event_id AS VARCHAR)) AS row_key FROM events""")
def row_key(spark: SparkSession, folder: str) -> DataFrame:
    return D.table(spark, folder, "events").select(
        "event_id", X.row_key(F.col("user_id"), F.col("event_type"), F.col("event_id")).alias("row_key")
    )


# --- Star join -----------------------------------------------------------------------------------

STAR_SQL = f"""
  f AS ({FACT_SQL}),
  l AS (SELECT c_custkey AS id, c_name AS location_name, c_mktsegment AS city,
               coalesce(r_name, 'old ' || c_mktsegment) AS country_name
        FROM customer LEFT JOIN region ON r_regionkey = c_nationkey),
  p AS (SELECT DISTINCT event_type AS code, 'type ' || event_type AS parameter_name FROM events)"""


def _named_locations(spark: SparkSession, folder: str) -> DataFrame:
    return M.update_country_names(D.dim_location(spark, folder), D.region_names(spark, folder))


@query(f"""WITH {STAR_SQL}
SELECT f.location_id, f.parameter_code, f.value, f.date_utc, l.location_name, l.city,
       l.country_name, p.parameter_name, 'units' AS preferredunit
FROM f LEFT JOIN l ON l.id = f.location_id LEFT JOIN p ON p.code = f.parameter_code""")
def star_join(spark: SparkSession, folder: str) -> DataFrame:
    joined = star.star_join(
        D.fact(spark, folder), _named_locations(spark, folder), D.event_types(spark, folder)
    )
    return joined.select(
        "location_id", "parameter_code", "value", "date_utc", "location_name", "city",
        "country_name", "parameter_name", "preferredunit",
    )


@query(f"""WITH {STAR_SQL}
SELECT l.country_name, p.parameter_name, count(*) AS measurements,
       {six_sql(f"sum({units('f.value')})", "count(f.value)")} AS avg_value
FROM f LEFT JOIN l ON l.id = f.location_id LEFT JOIN p ON p.code = f.parameter_code
GROUP BY ALL""")
def star_means(spark: SparkSession, folder: str) -> DataFrame:
    found = star.mean_by_country_and_parameter(
        D.fact(spark, folder), _named_locations(spark, folder), D.event_types(spark, folder)
    )
    return found.select("country_name", "parameter_name", "measurements", *six("avg_value"))


# --- Payloads ------------------------------------------------------------------------------------


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS props_k
FROM events""")
def flatten_props(spark: SparkSession, folder: str) -> DataFrame:
    events = D.table(spark, folder, "events").select(
        "event_id", F.from_json("props", "k int").alias("props")
    )
    return flatten(events)


@query("""SELECT CAST(c_custkey AS INTEGER) AS id, c_mktsegment AS city, c_name AS name,
       'community' AS entity, CAST(c_nationkey AS VARCHAR) AS country,
       '[{"name":"' || c_mktsegment || '","id":' || CAST(c_custkey AS VARCHAR) || '}]' AS sources,
       c_acctbal < 0 AS ismobile, CAST(NULL AS BOOLEAN) AS isanalysis, 'fixed' AS sensortype,
       TIMESTAMP '2024-01-05 06:07:08' AS lastupdated, CAST(NULL AS TIMESTAMP) AS firstupdated,
       c_acctbal AS coordinates_latitude, CAST(2.5 AS DOUBLE) AS coordinates_longitude
FROM customer""")
def extract_locations(spark: SparkSession, folder: str) -> DataFrame:
    return P.good(P.extract_locations(D.location_bodies(spark, folder)))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS name FROM nation")
def extract_countries(spark: SparkSession, folder: str) -> DataFrame:
    return P.good(P.extract_countries(D.country_bodies(spark, folder)))


@query("""SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS name, p_brand AS displayname,
       p_type AS description, CAST(p_size AS VARCHAR) AS preferredunit FROM part""")
def extract_parameters(spark: SparkSession, folder: str) -> DataFrame:
    return P.good(P.extract_parameters(D.parameter_bodies(spark, folder)))


STAGED_MEASUREMENT_SQL = """
  SELECT CAST(e.user_id AS INTEGER) AS locationid, c.c_name AS location,
         e.event_type AS parameter, e.value, 'ug/m3' AS unit,
         CAST(c.c_nationkey AS VARCHAR) AS country, c.c_mktsegment AS city, false AS ismobile,
         CAST(NULL AS BOOLEAN) AS isanalysis, CAST(NULL AS VARCHAR) AS entity,
         CAST(NULL AS VARCHAR) AS sensortype, e.ts AS date_utc,
         e.ts - INTERVAL 3 HOURS AS date_local, c.c_acctbal AS coordinates_latitude,
         CAST(2.5 AS DOUBLE) AS coordinates_longitude
  FROM events e JOIN customer c ON c.c_custkey = e.user_id"""


@query(STAGED_MEASUREMENT_SQL)
def extract_measurements(spark: SparkSession, folder: str) -> DataFrame:
    return P.good(
        P.extract_measurements(D.measurement_bodies(D.located_events(spark, folder)))
    )


@query("""SELECT 'ok' AS reason, count(*) AS rows FROM events
UNION ALL SELECT 'unparsable body', count(*) FROM documents
UNION ALL SELECT 'no results list', count(*) FROM labels
UNION ALL SELECT 'country: longer than 2', count(*) FROM customer
UNION ALL SELECT 'date_utc: not a timestamp_ntz', count(*) FROM customer
UNION ALL SELECT 'value: missing', count(*) FROM customer
UNION ALL SELECT 'value: not finite', count(*) FROM supplier
UNION ALL SELECT 'coordinates_latitude: not finite', count(*) FROM supplier
UNION ALL SELECT 'value: out of range', count(*) FROM part
UNION ALL SELECT 'date_utc: not between 1970-01-01 and 2099-12-31', count(*) FROM part""")
def quarantine_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """Readable events, documents that are no JSON, JSON without results, and bad elements."""
    documents = D.table(spark, folder, "documents").select(F.col("text").alias("body"))
    labels = D.table(spark, folder, "labels")
    labels = labels.select(F.to_json(F.struct(*labels.columns)).alias("body"))
    bad = D.table(spark, folder, "customer").select(
        D.body_of(
            F.col("c_custkey").alias("locationId"),
            F.lit("pm25").alias("parameter"),
            F.col("c_mktsegment").alias("country"),
            F.struct(F.col("c_name").alias("utc")).alias("date"),
        )
    )
    odd = D.table(spark, folder, "supplier").select(
        D.body_of(
            F.col("s_suppkey").alias("locationId"),
            F.lit("pm25").alias("parameter"),
            F.lit("NaN").alias("value"),
            F.struct(F.lit("2024-01-05T00:00:00+00:00").alias("utc")).alias("date"),
            F.struct(F.lit("Infinity").alias("latitude")).alias("coordinates"),
        )
    )
    far = D.table(spark, folder, "part").select(
        D.body_of(
            F.col("p_partkey").alias("locationId"),
            F.lit("pm25").alias("parameter"),
            F.lit("-1e12").alias("value"),
            F.struct(F.lit("9024-01-05T00:00:00+00:00").alias("utc")).alias("date"),
        )
    )
    bodies = D.measurement_bodies(D.located_events(spark, folder)).union(documents)
    bodies = bodies.union(labels).union(bad).union(odd).union(far)
    return metrics.quarantine_counts(P.extract_measurements(bodies))


@query("""SELECT CAST(doc_id AS INTEGER) AS id, length(text) > 256 AS too_many_characters,
       strlen(text) > 256 AS too_many_bytes FROM documents""")
def text_limits(spark: SparkSession, folder: str) -> DataFrame:
    """Documents against the text limit of a parameter's description, in characters and bytes."""
    rule = next(rule for rule in S.STG_PARAMETERS if rule.name == "description")

    def too_long(in_bytes: bool):
        (check,) = problems(F.col("text"), rule, in_bytes)
        return check.isNotNull()

    return D.table(spark, folder, "documents").select(
        F.col("doc_id").cast("int").alias("id"),
        too_long(in_bytes=False).alias("too_many_characters"),
        too_long(in_bytes=True).alias("too_many_bytes"),
    )


@query(STAGED_MEASUREMENT_SQL)
def landing_files(spark: SparkSession, folder: str) -> DataFrame:
    """Bodies through files of saved responses."""
    landing = shared_dir(spark, "landing")
    D.measurement_bodies(D.located_events(spark, folder)).write.text(landing)
    return P.good(P.extract_measurements(E.read_bodies(spark, landing)))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS name FROM nation")
def staging_truncates(spark: SparkSession, folder: str) -> DataFrame:
    """Staging twice into one folder leaves the second load only."""
    where = shared_dir(spark, "countries")
    regions = D.region_names(spark, folder).select(D.body_of(F.col("code"), F.col("name")))
    stage(P.extract_countries(regions), where, S.STG_COUNTRIES)
    again = stage(
        P.extract_countries(D.country_bodies(spark, folder)), where, S.STG_COUNTRIES
    )
    return again.good()


@query("""SELECT event_id,
  CASE event_type WHEN 'view' THEN ts + INTERVAL 3 HOURS
                  WHEN 'click' THEN ts - INTERVAL 330 MINUTES ELSE ts END AS date_utc,
  ts AS date_local FROM events""")
def iso_clocks(spark: SparkSession, folder: str) -> DataFrame:
    """ISO text with and without an offset: the wall clock it shows, and the UTC clock."""
    kind, ts = F.col("event_type"), F.col("ts")
    written = (
        F.when(kind == "view", D.iso(ts, "-03:00"))
        .when(kind == "click", D.iso(ts, "+0530"))
        .when(kind == "error", D.iso(ts, "Z"))
        .when(kind == "signup", ts.cast("string"))
        .otherwise(D.iso(ts, "+00:00"))
    )
    text = D.table(spark, folder, "events").select("event_id", written.alias("text"))
    return text.select(
        "event_id",
        H.utc_clock(F.col("text")).alias("date_utc"),
        H.wall_clock(F.col("text")).alias("date_local"),
    )


@query(r"""SELECT doc_id, CAST(len(items) AS INTEGER) AS items,
       md5(array_to_string(items, '|')) AS joined
FROM (SELECT doc_id, list_transform(string_split(text, ','), lambda x:
        regexp_replace(x, '^[ \t\r\n\f]+|[ \t\r\n\f]+\z', '', 'g')) AS items FROM documents)""")
def comma_lists(spark: SparkSession, folder: str) -> DataFrame:
    items = X.split_trim(F.col("text"))
    return D.table(spark, folder, "documents").select(
        "doc_id", F.size(items).alias("items"), F.md5(F.array_join(items, "|")).alias("joined")
    )


@query("""SELECT page_id, md5(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'),
       '>', '&gt;'), '"', '&quot;')) AS escaped FROM pages""")
def html_escapes(spark: SparkSession, folder: str) -> DataFrame:
    return D.table(spark, folder, "pages").select(
        "page_id", F.md5(X.html_escape(F.col("html"))).alias("escaped")
    )


# --- Time windows and loads ----------------------------------------------------------------------


@query("""SELECT date_trunc('hour', ts) AS window_start,
       date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS measurements
FROM events GROUP BY ALL""")
def hourly_windows(spark: SparkSession, folder: str) -> DataFrame:
    start = H.hour_of(F.col("ts")).alias("window_start")
    hours = D.table(spark, folder, "events").groupBy(start).agg(
        F.count(F.lit(1)).alias("measurements")
    )
    end = F.col("window_start") + F.expr("INTERVAL 1 HOUR")
    return hours.select("window_start", end.alias("window_end"), "measurements")


@query("""SELECT event_id, date_trunc('hour', ts) - INTERVAL 1 HOUR AS window_start,
       date_trunc('hour', ts) AS window_end FROM events""")
def previous_hours(spark: SparkSession, folder: str) -> DataFrame:
    start, end = H.previous_hour_of(F.col("ts"))
    return D.table(spark, folder, "events").select(
        "event_id", start.alias("window_start"), end.alias("window_end")
    )


def _span(spark: SparkSession, folder: str) -> tuple[datetime, datetime]:
    first, last = D.table(spark, folder, "events").agg(F.min("ts"), F.max("ts")).first()
    return first, last


@query("""SELECT event_id, ts FROM events
WHERE ts >= (SELECT min(ts) FROM events) AND ts < (SELECT max(ts) FROM events)""")
def half_open_window(spark: SparkSession, folder: str) -> DataFrame:
    """From the first event, included, to the last one, excluded."""
    events = D.table(spark, folder, "events").select("event_id", "ts")
    return events.where(H.in_window(F.col("ts"), *_span(spark, folder)))


@query("""SELECT event_id, ts FROM events
WHERE ts >= TIMESTAMP '2024-01-05 21:30:00' AND ts < TIMESTAMP '2024-01-21 00:00:00.5'""")
def text_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """Window bounds as text, one with an offset."""
    events = D.table(spark, folder, "events").select("event_id", "ts")
    return events.where(H.in_window(F.col("ts"), " 2024-01-06T00:30:00+03:00", "2024-01-21T00:00:00.500"))


STORED_SQL = """
  SELECT CAST(e.user_id AS INTEGER) AS location_id, CAST(c.c_nationkey AS VARCHAR) AS country_code,
         e.event_type AS parameter_code, e.value, e.ts - INTERVAL 3 HOURS AS date_local,
         e.ts AS date_utc, CAST(e.ts AS DATE) AS measure_date
  FROM events e JOIN customer c ON c.c_custkey = e.user_id"""


@query(f"""SELECT s.location_id, s.parameter_code, s.value, s.date_utc, c.c_name AS location_name,
       c.c_mktsegment AS city, n.n_name AS country_name, 'type ' || s.parameter_code AS parameter_name,
       'units' AS preferredunit
FROM ({STORED_SQL}) s JOIN customer c ON c.c_custkey = s.location_id
                      JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def whole_run(spark: SparkSession, folder: str) -> DataFrame:
    """Four folders of responses into empty tables, then the star join of what is stored."""
    first, last = _span(spark, folder)
    landing = shared_dir(spark, "landing")
    for name, bodies in (
        ("locations", D.location_bodies(spark, folder)),
        ("countries", D.country_bodies(spark, folder)),
        ("parameters", D.event_type_bodies(spark, folder)),
        ("measurements", D.measurement_bodies(D.located_events(spark, folder))),
    ):
        bodies.write.text(f"{landing}/{name}")
    tables = create_star_schema(spark, shared_dir(spark, "star"), hourly=False)
    L.load_all(spark, landing, tables, first, last + timedelta(hours=1), as_of=D.AS_OF)
    locations, parameters, store = tables
    return star.star_join(store.read(), locations.current(), parameters.current()).select(
        "location_id", "parameter_code", "value", "date_utc", "location_name", "city",
        "country_name", "parameter_name", "preferredunit",
    )


@query(f"""SELECT measure_date, CAST(hour(date_utc) AS INTEGER) AS measure_hour,
       count(*) AS measurements, min(date_utc) AS first_at
FROM ({STORED_SQL}) GROUP BY ALL""")
def fact_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """The fact written by day and hour, read back."""
    store = FactStore(spark, shared_dir(spark, "fact"), hourly=True)
    store.create_if_absent()
    store.write(
        D.fact(spark, folder).withColumn("location_id", F.col("location_id").cast("int"))
    )
    return store.read().groupBy("measure_date", "measure_hour").agg(
        F.count(F.lit(1)).alias("measurements"), F.min("date_utc").alias("first_at")
    )


def _land(spark: SparkSession, rows: DataFrame) -> str:
    landing = shared_dir(spark, "landing")
    D.measurement_bodies(rows).write.text(landing)
    return landing


def _store(spark: SparkSession) -> FactStore:
    """By day: these queries load many days at once."""
    return create_star_schema(spark, shared_dir(spark, "star"), hourly=False)[2]


def _rows(store: FactStore) -> DataFrame:
    return store.read().drop("updated_at")


@query(STORED_SQL)
def load_range(spark: SparkSession, folder: str) -> DataFrame:
    """A backfill of the whole time span as one load."""
    first, last = _span(spark, folder)
    store = _store(spark)
    landing = _land(spark, D.located_events(spark, folder))
    L.load_range(spark, landing, store, first, last + timedelta(hours=1), as_of=D.AS_OF)
    return _rows(store)


@query(STORED_SQL)
def load_windows(spark: SparkSession, folder: str) -> DataFrame:
    """The same span in three windows that overlap, one after the other."""
    first, last = _span(spark, folder)
    store = _store(spark)
    third = (last - first) / 3
    events = D.located_events(spark, folder)
    for number in range(3):
        start = first + third * number
        end = start + third + timedelta(hours=6)
        landing = _land(spark, events.where(H.in_window(F.col("ts"), start, end)))
        L.load_window(spark, landing, store, start, end, as_of=D.AS_OF)
    return _rows(store)


@query(f"""WITH b AS (SELECT date_trunc('hour', max(ts)) AS high FROM events)
SELECT s.* FROM ({STORED_SQL}) s, b WHERE date_utc >= high - INTERVAL 1 HOUR AND date_utc < high""")
def load_previous_hour(spark: SparkSession, folder: str) -> DataFrame:
    """The last complete hour before the newest event, out of all landed events."""
    _, last = _span(spark, folder)
    store = _store(spark)
    landing = _land(spark, D.located_events(spark, folder))
    L.load_previous_hour(spark, landing, store, last, as_of=D.AS_OF)
    return _rows(store)


@query(STORED_SQL)
def load_whole_files(spark: SparkSession, folder: str) -> DataFrame:
    """Pretty-printed responses, one per file, each with up to a thousand measurements."""
    first, last = _span(spark, folder)
    store, landing = _store(spark), shared_dir(spark, "landing")
    bodies = D.pretty_measurement_bodies(D.located_events(spark, folder))
    bodies.write.option("maxRecordsPerFile", 1).text(landing)
    L.load_range(spark, landing, store, first, last + timedelta(hours=1), as_of=D.AS_OF, whole_files=True)
    return _rows(store)


@query("""SELECT 1 AS run, count(*) AS good, 0 AS quarantined, 0 AS kept, 0 AS updated,
       count(*) AS inserted FROM events
UNION ALL SELECT 2, count(*), 0, 0, count(*), 0 FROM events""")
def load_reports(spark: SparkSession, folder: str) -> DataFrame:
    """What a load counts, and that loading again only updates."""
    first, last = _span(spark, folder)
    store = _store(spark)
    landing = _land(spark, D.located_events(spark, folder))
    reports = [
        L.load_range(spark, landing, store, first, last + timedelta(hours=1), as_of=D.AS_OF)
        for _ in range(2)
    ]
    rows = [
        (run, r.good, r.quarantined, r.kept, r.updated, r.inserted)
        for run, r in enumerate(reports, 1)
    ]
    return spark.createDataFrame(
        rows, "run int, good long, quarantined int, kept int, updated long, inserted long"
    )


@query(STORED_SQL)
def stream_load(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows as a file stream in two runs, the second finding new files only."""
    first, last = _span(spark, folder)
    middle = first + (last - first) / 2
    store, base = _store(spark), shared_dir(spark, "stream")
    events = D.located_events(spark, folder)
    halves = (events.where(F.col("ts") < H.ntz(middle)), events.where(F.col("ts") >= H.ntz(middle)))
    for half in halves:
        D.measurement_bodies(half).write.mode("append").text(f"{base}/landing")
        start_measurement_stream(
            spark, f"{base}/landing", store, f"{base}/checkpoint", f"{base}/staging", as_of=D.AS_OF
        ).awaitTermination()
    return _rows(store)


@query(f"""{ADDRESSED_SQL}
SELECT measure_date, parameter_code, countries, country_list, subject, recipient, alert_id FROM r""")
def daily_alert_run(spark: SparkSession, folder: str) -> DataFrame:
    """The alerts of all stored days in one run, from the stored fact."""
    first, last = _span(spark, folder)
    store = _store(spark)
    store.write(
        D.fact(spark, folder).withColumn("location_id", F.col("location_id").cast("int"))
    )
    found = L.daily_alerts(
        store, first.date(), last.date(), recipients="ops@example.org,lab@example.org"
    )
    return found.select(
        "measure_date", "parameter_code", "countries", "country_list", "subject", "recipient",
        "alert_id",
    )


@query(f"""{ADDRESSED_SQL}
SELECT measure_date, parameter_code, subject, body, recipient, alert_id,
       CASE WHEN recipient = 'lab@example.org' THEN 2 ELSE 1 END AS posted_by
FROM r""")
def post_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Three runs into one outbox: one recipient, then two, then the same again, which adds nothing."""
    first, last = _span(spark, folder)
    fact, outbox = D.fact(spark, folder), Outbox(spark, shared_dir(spark, "outbox"))
    runs = [
        L.post_alerts(fact, outbox, first.date(), last.date(), recipients=to).select("alert_id", F.lit(n).alias("posted_by"))
        for n, to in enumerate(["ops@example.org", "ops@example.org, lab@example.org", "lab@example.org,ops@example.org"], 1)
    ]
    posted = runs[0].union(runs[1]).union(runs[2])
    return outbox.messages().join(posted, "alert_id").select(
        "measure_date", "parameter_code", "subject", "body", "recipient", "alert_id", "posted_by"
    )


# --- What loads keep beside the fact -------------------------------------------------------------


def _ledger(spark: SparkSession) -> L.Ledger:
    base = shared_dir(spark, "ledger")
    return L.Ledger(
        LoadLog(spark, f"{base}/log"), PartialStore(spark, f"{base}/partials"), Quarantine(spark, f"{base}/quarantine")
    )


@query(f"""WITH {MEANS_SQL}
SELECT country_code, measure_date, parameter_code, avg_value, base_value FROM a""")
def alerts_from_partials(spark: SparkSession, folder: str) -> DataFrame:
    """Loads with wrong clicks, then a correction, then the first half once more; the alerts come from the sums that the loads kept."""
    first, last = _span(spark, folder)
    end, middle = last + timedelta(hours=1), first + (last - first) / 2
    events, store, ledger = D.located_events(spark, folder), _store(spark), _ledger(spark)
    wrong = F.when(F.col("event_type") == "click", F.col("value") + 1000).otherwise(F.col("value"))
    corrected = {"keys": {k: v for k, v in M.MEASURE_KEYS.items() if k != "value"} | {"date_local": "date_local"}}
    for rows, start, stop in ((events.withColumn("value", wrong), first, end), (events, first, end), (events, first, middle)):
        landing = _land(spark, rows.withColumn("user_id", F.col("event_id")))
        L.load_window(spark, landing, store, start, stop, as_of=D.AS_OF, ledger=ledger, merge_options=corrected)
    found = L.alerts_between(ledger.partials, first.date(), last.date())
    return found.select("country_code", "measure_date", "parameter_code", *six("avg_value", "base_value"))


@query("""WITH b AS (SELECT min(ts) AS low, max(ts) AS high FROM events),
  m AS (SELECT low, high, low + (high - low) / 2 AS middle FROM b)
SELECT 'a' AS load_id, 'done' AS outcome, count(*) + (SELECT count(*) FROM customer) AS rows_in, count(*) AS good,
       (SELECT count(*) FROM customer) AS quarantined, count(*) AS inserted, 0 AS updated
FROM events, m WHERE ts < middle
UNION ALL SELECT 'b', 'done', count(*), count(*), 0, count(*), 0 FROM events, m WHERE ts >= middle AND ts < high
UNION ALL SELECT 'c', 'done', count(*), count(*), 0, 0, count(*) FROM events, m WHERE ts >= middle AND ts < high
UNION ALL SELECT 'd', 'failed', NULL, NULL, NULL, NULL, NULL""")
def load_log(spark: SparkSession, folder: str) -> DataFrame:
    """Two windows, the first delivered twice under one id, the second under two, and a load that finds nothing to read."""
    first, last = _span(spark, folder)
    middle = first + (last - first) / 2
    events, store, ledger = D.located_events(spark, folder), _store(spark), _ledger(spark)
    odd = D.table(spark, folder, "customer").select(D.body_of(F.col("c_custkey").alias("locationId")))
    landing, other = shared_dir(spark, "landing"), _land(spark, events)
    D.measurement_bodies(events).union(odd).write.text(landing)
    for load_id, path, start, end in (
        ("a", landing, first, middle), ("a", landing, first, middle), ("b", other, middle, last), ("c", other, middle, last),
    ):
        L.load_window(spark, path, store, start, end, as_of=D.AS_OF, ledger=ledger, load_id=load_id)
    try:
        L.load_window(spark, f"{other}-missing", store, first, last, as_of=D.AS_OF, ledger=ledger, load_id="d")
    except Exception:  # logged as failed, which is what this query shows
        pass
    return ledger.log.entries().select("load_id", "outcome", "rows_in", "good", "quarantined", "inserted", "updated")


@query("""WITH w AS (SELECT o_orderkey AS k, CAST(o_orderdate AS TIMESTAMP) + INTERVAL (o_orderkey % 24) HOUR AS s FROM orders),
  c AS (SELECT s, s + INTERVAL (3 + k % 40) HOUR AS e FROM w WHERE k % 5 = 0),
  r AS (SELECT s, e, max(e) OVER (ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM c),
  n AS (SELECT s, e, sum(CASE WHEN s <= reached THEN 0 ELSE 1 END) OVER (ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS i FROM r),
  g AS (SELECT min(s) AS window_start, max(e) AS window_end FROM n GROUP BY i)
SELECT 'covered' AS kind, window_start, window_end FROM g
UNION ALL SELECT 'missing', window_end, next FROM (SELECT window_end, lead(window_start) OVER (ORDER BY window_start) AS next FROM g)
WHERE next IS NOT NULL""")
def covered_and_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as windows of three hours to two days: what they cover between the first start and the last end, and what is left out."""
    key = F.col("o_orderkey")
    start = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(hours=(key % 24).cast("int"))
    windows = D.table(spark, folder, "orders").where(key % 5 == 0).select(start.alias("window_start"), key)
    end = F.col("window_start") + F.make_dt_interval(hours=(3 + key % 40).cast("int"))
    windows = windows.select("window_start", end.alias("window_end"))
    low, high = windows.agg(F.min("window_start"), F.max("window_end")).first()
    covered = islands(windows, low, high).select(F.lit("covered").alias("kind"), "window_start", "window_end")
    return covered.union(gaps(windows, low, high).select(F.lit("missing"), "window_start", "window_end"))


@query(STORED_SQL)
def load_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Two windows that leave the start, the middle and the end out, a failed load over all, then one load of what is missing."""
    first, last = _span(spark, folder)
    end = last + timedelta(hours=1)
    store, ledger = _store(spark), _ledger(spark)
    landing = _land(spark, D.located_events(spark, folder))
    fifth = (end - first) / 5
    for n in (1, 3):
        L.load_window(spark, landing, store, first + n * fifth, first + (n + 1) * fifth, as_of=D.AS_OF, ledger=ledger)
    ledger.log.failed("all", [(first, end)], "did not finish")
    found = L.load_missing(spark, landing, store, ledger, first, end, as_of=D.AS_OF)
    if found.updated or L.load_missing(spark, landing, store, ledger, first, end) is not None:
        raise AssertionError("loaded more than what was missing")
    return _rows(store)


@query("""SELECT CAST(c.c_custkey AS INTEGER) AS location_id, left(c.c_mktsegment, 10) AS country_code, 'pm25' AS parameter_code,
  c.c_acctbal AS value, TIMESTAMP '2024-01-05 00:00:00' AS date_utc, 'loaded' AS state FROM customer c
WHERE length(c.c_mktsegment) <= 9
UNION ALL SELECT DISTINCT NULL, c.c_mktsegment, 'country: longer than 9', NULL, NULL, 'open' FROM customer c
WHERE length(c.c_mktsegment) > 9""")
def replay_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Countries of up to ten letters, delivered twice, under a limit of two and then of nine: who fits is loaded, the rest stays open."""
    store, ledger = _store(spark), _ledger(spark)
    landing = shared_dir(spark, "landing")
    D.table(spark, folder, "customer").select(
        D.body_of(
            F.col("c_custkey").alias("locationId"), F.lit("pm25").alias("parameter"), F.col("c_acctbal").alias("value"),
            F.col("c_mktsegment").alias("country"), F.struct(F.lit("2024-01-05T00:00:00+00:00").alias("utc")).alias("date"),
        )
    ).write.text(landing)
    for _ in range(2):
        L.load_window(spark, landing, store, "2024-01-05", "2024-01-06", as_of=D.AS_OF, ledger=ledger)
    wider = tuple(replace(rule, max_length=9) if rule.name == "country" else rule for rule in S.STG_MEASUREMENTS)
    for _ in range(2):
        L.replay_quarantine(store, ledger, as_of=D.AS_OF, rules=wider)
    stored = store.read().select("location_id", "country_code", "parameter_code", "value", "date_utc", F.lit("loaded").alias("state"))
    left = P.quarantined(P.extract_measurements(ledger.quarantine.bodies(), rules=wider))
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("value", "double"), ("date_utc", "timestamp_ntz"))]
    country = F.get_json_object("_raw", "$.country").alias("country_code")
    still = left.select(F.lit(None).cast("int"), country, F.col("_reasons"), *nothing, F.lit("open")).distinct()
    return stored.union(still)


@query(f"""{MESSAGES_SQL},
  u AS (SELECT r_regionkey AS rule_id,
    CASE WHEN r_regionkey = 1 THEN NULL WHEN r_regionkey % 2 = 0 THEN ['view', 'click'] ELSE ['error', 'Purchase', 'signup'] END AS wanted,
    CASE WHEN r_regionkey > 1 THEN ['ops@example.org', lower(r_name) || '@example.org'] ELSE ['ops@example.org'] END AS people,
    CASE WHEN r_regionkey <> 0 THEN DATE '2024-01-01' + 5 * r_regionkey END AS first_day,
    CASE WHEN r_regionkey NOT IN (0, 3) THEN DATE '2024-01-01' + 5 * r_regionkey + 9 END AS last_day FROM region),
  p AS (SELECT * EXCLUDE people, unnest(people) AS recipient FROM u)
SELECT p.rule_id, m.measure_date, m.parameter_code, m.countries, m.country_list, p.recipient,
  sha256('10:' || CAST(measure_date AS VARCHAR) || length(parameter_code) || ':' || parameter_code
         || length(p.recipient) || ':' || p.recipient) AS alert_id
FROM m JOIN p ON (p.wanted IS NULL OR list_contains(p.wanted, m.parameter_code))
  AND (p.first_day IS NULL OR m.measure_date >= p.first_day) AND (p.last_day IS NULL OR m.measure_date <= p.last_day)""")
def alerts_by_rule(spark: SparkSession, folder: str) -> DataFrame:
    """Rules as rows, with lists, spans of days and one rule for everything."""
    found = L.alerts_by_rule(D.fact(spark, folder), D.alert_rules(spark, folder))
    return found.select("rule_id", "measure_date", "parameter_code", "countries", "country_list", "recipient", "alert_id")


@query(f"""WITH {MEANS_SQL}
SELECT country_code, measure_date, parameter_code, avg_value
FROM a WHERE measure_date = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def alert_newest_stored_day(spark: SparkSession, folder: str) -> DataFrame:
    """From the stored fact: the newest day is a subquery that prunes its folders."""
    store = _store(spark)
    store.write(D.fact(spark, folder).withColumn("location_id", F.col("location_id").cast("int")))
    return L.newest_alerts(store).select("country_code", "measure_date", "parameter_code", *six("avg_value"))


@query(f"""WITH {STAR_SQL}
SELECT f.location_id, f.parameter_code, f.value, f.date_utc, l.location_name, l.city, l.country_name,
       'type ' || f.parameter_code AS parameter_name
FROM f JOIN l ON l.id = f.location_id
WHERE l.city IN ('BUILDING', 'MACHINERY') AND f.parameter_code IN ('view', 'click')
  AND l.country_name IN ('AFRICA', 'old BUILDING', 'old MACHINERY', 'ASIA')
  AND isodow(f.date_utc) >= 6 AND f.date_utc >= TIMESTAMP '2024-01-03' AND f.date_utc < TIMESTAMP '2024-01-26'""")
def star_slice(spark: SparkSession, folder: str) -> DataFrame:
    """Some cities, countries, parameters and the weekends of a span of days, from the stored fact."""
    store = _store(spark)
    store.write(D.fact(spark, folder).withColumn("location_id", F.col("location_id").cast("int")))
    found = star.star_slice(
        store.read("2024-01-03", "2024-01-25"),
        _named_locations(spark, folder),
        D.event_types(spark, folder),
        city="BUILDING, MACHINERY",
        country=["AFRICA", "old BUILDING", "old MACHINERY", "ASIA"],
        parameter="view,click",
        days=star.calendar(store.days()).where("weekday >= 6"),
    )
    return found.select(
        "location_id", "parameter_code", "value", "date_utc", "location_name", "city", "country_name", "parameter_name"
    )


@query(STAGED_MEASUREMENT_SQL)
def spread_elements(spark: SparkSession, folder: str) -> DataFrame:
    """Bodies of a thousand measurements each, cut into elements that are dealt over tasks before they are typed."""
    bodies = D.pretty_measurement_bodies(D.located_events(spark, folder))
    return P.good(P.extract_measurements(bodies, spread=True))


@query("""SELECT e.event_id AS device_serial, c.c_mktsegment AS device_model_maker,
       CAST(c.c_acctbal AS DOUBLE) AS device_model_gain, '[' || e.event_id || ',' || e.user_id || ']' AS channels,
       CASE WHEN e.event_id % 2 = 0 THEN '{"n":' || e.event_id || '}' END AS remark
FROM events e JOIN customer c ON c.c_custkey = e.user_id""")
def unnamed_fields(spark: SparkSession, folder: str) -> DataFrame:
    """What measurements hold beyond the fields of the tables, found from the data, amid bodies that are no JSON."""
    bodies = D.extended_measurement_bodies(D.located_events(spark, folder))
    texts = D.table(spark, folder, "documents").select(F.col("text").alias("body"))
    found = V.variant_elements(bodies.union(texts))
    named = V.named_paths(T.DataType.fromDDL(S.MEASUREMENTS_ELEMENT))
    flat = V.flatten_variant(found, without=named)
    return flat.withColumn("device_model_gain", F.col("device_model_gain").cast("double"))
