"""Table and payload schemas.

Payload schemas keep every leaf as text: a typed JSON schema turns one odd value into a lost
record, whereas text can be cast column by column afterwards (``operators.validate``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    """How one flattened payload column becomes a typed staging column.

    ``type`` is a Spark SQL type, or ``utc`` for ISO text that is moved to the UTC wall clock.
    """

    name: str
    type: str = "string"
    max_length: int | None = None
    required: bool = False

    @property
    def sql_type(self) -> str:
        return "timestamp_ntz" if self.type == "utc" else self.type


def _texts(*names: str) -> str:
    return ", ".join(f"{n}: string" for n in names)


# --- Fixed values: field names of the four payloads (JSON matching is case-sensitive). -----------
LOCATIONS_ELEMENT = (
    "struct<"
    + _texts("id", "city", "name", "entity", "country", "sources", "isMobile", "isAnalysis",
             "sensorType", "lastUpdated", "firstUpdated")
    + ", coordinates: struct<" + _texts("latitude", "longitude") + ">>"
)
COUNTRIES_ELEMENT = "struct<" + _texts("code", "name") + ">"
PARAMETERS_ELEMENT = (
    "struct<" + _texts("id", "name", "displayName", "description", "preferredUnit") + ">"
)
MEASUREMENTS_ELEMENT = (
    "struct<"
    + _texts("locationId", "location", "parameter", "value", "unit", "country", "city",
             "isMobile", "isAnalysis", "entity", "sensorType")
    + ", date: struct<" + _texts("utc", "local") + ">"
    + ", coordinates: struct<" + _texts("latitude", "longitude") + ">>"
)

# --- Fixed values: column names, types and text limits of the staging tables. --------------------
STG_LOCATIONS = (
    Rule("id", "int", required=True),
    Rule("city", max_length=256),
    Rule("name", max_length=256),
    Rule("entity", max_length=256),
    Rule("country", max_length=2),
    Rule("sources", max_length=256),
    Rule("ismobile", "boolean"),
    Rule("isanalysis", "boolean"),
    Rule("sensortype", max_length=256),
    Rule("lastupdated", "utc"),
    Rule("firstupdated", "utc"),
    Rule("coordinates_latitude", "double"),
    Rule("coordinates_longitude", "double"),
)
STG_COUNTRIES = (
    Rule("code", max_length=2, required=True),
    Rule("name", max_length=50),
)
STG_PARAMETERS = (
    Rule("id", "int", required=True),
    Rule("name", max_length=256),
    Rule("displayname", max_length=256),
    Rule("description", max_length=256),
    Rule("preferredunit", max_length=256),
)
STG_MEASUREMENTS = (
    Rule("locationid", "int", required=True),
    Rule("location", max_length=256),
    Rule("parameter", max_length=20, required=True),
    Rule("value", "double", required=True),
    Rule("unit", max_length=256),
    Rule("country", max_length=2),
    Rule("city", max_length=256),
    Rule("ismobile", "boolean"),
    Rule("isanalysis", "boolean"),
    Rule("entity", max_length=256),
    Rule("sensortype", max_length=256),
    Rule("date_utc", "utc", required=True),
    Rule("date_local", "timestamp_ntz"),
    Rule("coordinates_latitude", "double"),
    Rule("coordinates_longitude", "double"),
)


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "double": T.DoubleType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame that the optimiser knows to be empty."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def staging_schema(rules: tuple[Rule, ...]) -> T.StructType:
    return _struct(**{rule.name: rule.sql_type for rule in rules})


# --- Fixed values: the star schema. --------------------------------------------------------------
DIM_LOCATION = _struct(
    id="int",
    city="string",
    name="string",
    country_code="string",
    country_name="string",
    sources="string",
    ismobile="boolean",
    isanalysis="boolean",
    sensortype="string",
    coordinates_latitude="double",
    coordinates_longitude="double",
    updated_at="timestamp_ntz",
)
DIM_PARAMETER = _struct(
    id="int",
    code="string",
    displayname="string",
    description="string",
    preferredunit="string",
    updated_at="timestamp_ntz",
)
FACT_MEASURE = _struct(
    location_id="int",
    country_code="string",
    parameter_code="string",
    value="double",
    date_local="timestamp_ntz",
    date_utc="timestamp_ntz",
    updated_at="timestamp_ntz",
)
FACT_SORT = ("date_utc", "country_code", "parameter_code")
