"""Type-1 merges: a generic one, the three of the star schema, and the update from a join.

Rules of the generic merge

* A target row whose key is in the source is overwritten and stamped; all others are kept.
* A source row whose key is not in the target is inserted; its stamp stays NULL.
* NULL never equals NULL: such target rows are kept, such source rows inserted each time.

Physical form. The target is left-joined with one row per source key, and the inserts are an
anti-join against the distinct target keys. Both leave the large side of a hot key splittable by
AQE (a full outer join would not), and one-row-per-key is reached with map-side aggregation. No join
is hinted: Spark and AQE broadcast a small source from its real size. Floating keys are compared as
text, in which NaN equals NaN and -0.0 equals 0.0: Spark would otherwise rewrite them in every join
and shuffle again what an aggregation has just shuffled by them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import ntz

ON_DUPLICATE = ("error", "insert_all", "dedupe")
STRATEGIES = ("broadcast", "shuffle")
KEPT, UPDATED, INSERTED = "kept", "updated", "inserted"

_COPIES, _PICK, _SPREAD, _TARGET_SPREAD = "_copies", "_pick", "_spread", "_to_spread"


def stamp_of(as_of: datetime | Column | None) -> Column:
    if as_of is None:
        return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
    return ntz(as_of) if isinstance(as_of, datetime) else as_of.cast("timestamp_ntz")


def _comparable(key: Column, kind: T.DataType) -> Column:
    """A floating key as text; its cast back gives the number again."""
    if not isinstance(kind, (T.FloatType, T.DoubleType)):
        return key
    return F.when(key == 0, F.lit("0.0")).otherwise(key.cast("string"))


def _one_per_key(rows: DataFrame, keys: Sequence[str], rest: Sequence[str]) -> DataFrame:
    """The largest row of each key and how many there were, partly found before the shuffle."""
    copies = F.count(F.lit(1)).alias(_COPIES)
    picked = [F.max(F.struct(*rest)).alias(_PICK)] if rest else []
    grouped = rows.groupBy(*keys).agg(copies, *picked)
    return grouped.select(*keys, _COPIES, *([f"{_PICK}.*"] if rest else []))


def scd1_merge(
    target: DataFrame,
    source: DataFrame,
    keys: Mapping[str, str],
    set_map: Mapping[str, str],
    insert_map: Mapping[str, str] | None = None,
    as_of: datetime | Column | None = None,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    stamp: str = "updated_at",
    stamp_inserts: bool = False,
    only_if_changed: bool = False,
    action: str | None = None,
    strategy: str = "shuffle",
) -> DataFrame:
    """Merge ``source`` into ``target``; all maps go from target column to source column.

    ``on_duplicate`` says what happens when several source rows have one key. ``error`` fails if
    that key is in the target and inserts all of them if not. ``insert_all`` updates from one of
    them instead of failing. ``dedupe`` uses one of them throughout. "One of them" is the largest
    by ``order_by`` and then by all columns, so it never depends on row order.

    ``action`` names an output column that tells kept, updated and inserted rows apart.
    ``strategy`` is ``shuffle`` (joins without a hint, the default) or ``broadcast`` (the source is
    hinted, for callers who know that it is small).
    """
    if on_duplicate not in ON_DUPLICATE:
        raise ValueError(f"on_duplicate must be one of {ON_DUPLICATE}")
    dedupe = on_duplicate == "dedupe"
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    insert_map = set_map if insert_map is None else insert_map
    now = stamp_of(as_of)
    key_names = [f"_k{i}" for i in range(len(keys))]
    key_of = dict(zip(keys, key_names))
    # A column that only repeats a key is read from the key instead of being carried twice.
    used = [*order_by, *[m[to] for m in (set_map, insert_map) for to in m if m[to] != keys.get(to)]]
    held = {name: f"_s{i}" for i, name in enumerate(dict.fromkeys(used))}
    kinds = {to: target.schema[to].dataType for to in keys}
    rows = source.select(
        *[_comparable(F.col(name).cast(kinds[to]), kinds[to]).alias(key_of[to]) for to, name in keys.items()],
        *[F.col(name).alias(alias) for name, alias in held.items()],
    )
    keyless = rows.where(reduce(or_, [F.col(k).isNull() for k in key_names]))
    keyed = rows.where(reduce(and_, [F.col(k).isNotNull() for k in key_names]))
    single = _one_per_key(keyed, key_names, list(held.values()))
    target_key = {k: _comparable(F.col(to), kinds[to]) for to, k in key_of.items()}
    target_keys = target.select(*[column.alias(k) for k, column in target_key.items()])

    same_key = [column == F.col(k) for k, column in target_key.items()]
    if strategy == "broadcast":
        joined = target.join(F.broadcast(single), same_key, "left")
        # Never more keys than the source has, so this side is bounded by the same check.
        present = target_keys.join(
            F.broadcast(single.select(*key_names)), key_names, "left_semi"
        ).distinct()
        candidates = single.drop(_COPIES) if dedupe else rows
        new = candidates.join(F.broadcast(present), key_names, "left_anti")
    else:
        # AQE splits hot partitions only where a join sits on plain shuffles, not on aggregates.
        # A hash as one more join column makes Spark shuffle the aggregated side again, for the join
        # alone; it also gives the sort a first column that decides.
        joined = target.withColumn(_TARGET_SPREAD, F.xxhash64(*target_key.values())).join(
            single.withColumn(_SPREAD, F.xxhash64(*key_names)),
            [F.col(_TARGET_SPREAD) == F.col(_SPREAD), *same_key],
            "left",
        )
        known = target_keys.distinct()
        if dedupe:
            # One row per key on both sides, shuffled alike already: nothing to split, and as no key
            # is a floating number, nothing to move.
            new = single.drop(_COPIES).join(known, key_names, "left_anti")
        else:
            spread = F.xxhash64(*key_names)
            new = rows.withColumn(_SPREAD, spread).join(
                known.withColumn(_SPREAD, spread), [_SPREAD, *key_names], "left_anti"
            )

    if dedupe:
        new = new.unionByName(keyless)

    hit = F.col(key_names[0]).isNotNull()
    if on_duplicate == "error":
        # A filter, so that no later projection can prune the check away.
        message = F.concat(
            F.lit("several source rows match one target row: "),
            F.concat_ws(", ", *[F.col(to).cast("string") for to in keys]),
        )
        joined = joined.where(
            F.when(hit & (F.col(_COPIES) > 1), F.raise_error(message).cast("boolean")).otherwise(
                True
            )
        )

    def from_source(to: str, mapping: Mapping[str, str]) -> Column:
        if mapping[to] == keys.get(to):
            return F.col(key_of[to]).cast(kinds[to])
        return F.col(held[mapping[to]]).cast(target.schema[to].dataType)

    if only_if_changed:
        same = [F.col(to).eqNullSafe(from_source(to, set_map)) for to in set_map]
        hit = hit & ~reduce(and_, same)

    def merged(to: str) -> Column:
        if to in set_map:
            return F.when(hit, from_source(to, set_map)).otherwise(F.col(to)).alias(to)
        if to == stamp:
            return F.when(hit, now).otherwise(F.col(to)).alias(to)
        return F.col(to)

    def inserted(to: str) -> Column:
        if to in insert_map:
            return from_source(to, insert_map).alias(to)
        value = now if to == stamp and stamp_inserts else F.lit(None)
        return value.cast(target.schema[to].dataType).alias(to)

    names = target.columns
    old_action = [] if action is None else [F.when(hit, UPDATED).otherwise(KEPT).alias(action)]
    new_action = [] if action is None else [F.lit(INSERTED).alias(action)]
    return joined.select(*[merged(c) for c in names], *old_action).unionByName(
        new.select(*[inserted(c) for c in names], *new_action)
    )


# --- Fixed values: which staging column fills which column of the star schema. -------------------
LOCATION_KEYS = {"id": "id"}
LOCATION_COLUMNS = {
    "id": "id",
    "city": "city",
    "name": "name",
    "country_code": "country",
    "sources": "sources",
    "ismobile": "ismobile",
    "isanalysis": "isanalysis",
    "sensortype": "sensortype",
    "coordinates_latitude": "coordinates_latitude",
    "coordinates_longitude": "coordinates_longitude",
}
PARAMETER_KEYS = {"id": "id"}
PARAMETER_COLUMNS = {
    "code": "name",
    "displayname": "displayname",
    "description": "description",
    "preferredunit": "preferredunit",
}
MEASURE_KEYS = {
    "location_id": "locationid",
    "parameter_code": "parameter",
    "value": "value",
    "date_utc": "date_utc",
}
MEASURE_COLUMNS = {
    "location_id": "locationid",
    "country_code": "country",
    "parameter_code": "parameter",
    "value": "value",
    "date_local": "date_local",
    "date_utc": "date_utc",
}


def merge_locations(dim: DataFrame, staged: DataFrame, **options) -> DataFrame:
    """Locations by id. ``country_name`` is kept on a match and NULL on an insert."""
    return scd1_merge(dim, staged, LOCATION_KEYS, LOCATION_COLUMNS, **options)


def merge_parameters(dim: DataFrame, staged: DataFrame, **options) -> DataFrame:
    return scd1_merge(
        dim, staged, PARAMETER_KEYS, PARAMETER_COLUMNS, {"id": "id", **PARAMETER_COLUMNS}, **options
    )


def merge_measures(
    fact: DataFrame, staged: DataFrame, keys: Mapping[str, str] | None = None, **options
) -> DataFrame:
    """Measurements by location, parameter, value and time, or by another list of ``keys``.

    With the value in the key, a corrected measurement is a new row. As in any Spark join, NaN
    equals NaN and -0.0 equals 0.0.
    """
    return scd1_merge(fact, staged, keys or MEASURE_KEYS, MEASURE_COLUMNS, **options)


def update_country_names(
    dim: DataFrame, countries: DataFrame, on_duplicate: str = "max"
) -> DataFrame:
    """``country_name`` from the country list, where the code is in it.

    Rows without a match keep their name, and no stamp changes. If two names have one code, the
    larger is taken, or the update fails with ``on_duplicate="error"``.
    """
    if on_duplicate not in ("max", "error"):
        raise ValueError("on_duplicate must be max or error")
    named = countries.where(F.col("code").isNotNull()).groupBy(F.col("code").alias("_code")).agg(
        F.max("name").alias("_name"), F.count(F.lit(1)).alias(_COPIES)
    )
    if on_duplicate == "error":
        message = F.concat(F.lit("several names for country "), F.col("_code"))
        named = named.where(
            F.when(F.col(_COPIES) > 1, F.raise_error(message).cast("boolean")).otherwise(True)
        )
    code = F.col("country_code").cast(countries.schema["code"].dataType)
    # A hash beside the code, for the same reason as in the merge: a country may hold most rows.
    joined = dim.withColumn(_TARGET_SPREAD, F.xxhash64(code)).join(
        named.drop(_COPIES).withColumn(_SPREAD, F.xxhash64("_code")),
        [F.col(_TARGET_SPREAD) == F.col(_SPREAD), code == F.col("_code")],
        "left",
    )
    name = F.when(
        F.col("_code").isNotNull(), F.col("_name").cast(dim.schema["country_name"].dataType)
    )
    return joined.select(
        *[
            name.otherwise(F.col(c)).alias(c) if c == "country_name" else F.col(c)
            for c in dim.columns
        ]
    )
