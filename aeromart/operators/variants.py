"""Payload fields that no schema names, kept queryable as VARIANT.

The typed extracts read the fields that the tables hold and nothing else. Here an element stays what it is: one VARIANT, of which any path
can be asked for, and whose leaves can be laid out as columns once it is known which ones there are. Only the ``try_`` forms are
used: malformed text is NULL, and so is a value that does not fit the type it is asked as.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ELEMENT = "element"
_TOKEN = re.compile(r"`(?:[^`]|``)*`|OBJECT<|VOID")


def variant_elements(bodies: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of each body's list, as ``element``; bodies that are no JSON or have no list give no row."""
    listed = F.try_variant_get(F.try_parse_json(F.col(body)), "$.results", "array<variant>")
    return bodies.select(*keep, F.explode(listed).alias(ELEMENT))


def variant_field(value: Column, path: Sequence[str], kind: str = "string") -> Column:
    """The value at a path of field names, or NULL. Names that no path can write are looked up in the object as a map."""
    steps = ""
    for name in path:
        quote = next((q for q in "'\"" if q not in name and "\\" not in name), None)
        if quote:
            steps += f"[{quote}{name}{quote}]"
        else:
            fields = F.try_variant_get(value, f"${steps}", "map<string, variant>")
            value, steps = F.try_element_at(fields, F.lit(name)), ""
    return F.try_variant_get(value, f"${steps}", kind)


def variant_type(df: DataFrame, column: str = ELEMENT) -> T.StructType:
    """The type that all objects of a column share: fields of any of them, of a common type where there is one, else VARIANT.

    One aggregation, of which a single type comes to the driver, as large as the number of different fields.
    """
    objects = df.where(F.schema_of_variant(F.col(column)).startswith("OBJECT<"))
    text = objects.agg(F.schema_of_variant_agg(F.col(column))).first()[0]
    if not text or not text.startswith("OBJECT<"):
        return T.StructType()
    names = {"OBJECT<": "struct<", "VOID": "string"}
    return T.DataType.fromDDL(_TOKEN.sub(lambda m: names.get(m[0], m[0]), text))


def _leaves(kind: T.StructType, path: tuple[str, ...]) -> Iterator[tuple[tuple[str, ...], T.DataType]]:
    for field in kind.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here, field.dataType


def named_paths(kind: T.StructType) -> set[tuple[str, ...]]:
    """The leaves that a payload schema names already."""
    return {path for path, _ in _leaves(kind, ())}


def flatten_variant(
    df: DataFrame,
    column: str = ELEMENT,
    kind: T.StructType | None = None,
    without: set[tuple[str, ...]] = frozenset(),
    keep: Sequence[str] = (),
    sep: str = "_",
) -> DataFrame:
    """The leaves of a VARIANT column as columns named after their paths: ``device.id`` becomes ``device_id``.

    ``kind`` is found from the data unless it is given. ``without`` leaves out the paths that a schema names, so what remains is what the
    typed tables lose. Lists, and leaves whose types differ between rows, are JSON text. Two paths that would get one name
    are told apart by a number. Rows that are no objects have NULL in all columns.
    """
    kind = variant_type(df, column) if kind is None else kind
    taken = {name.lower() for name in keep}
    columns = []
    for path, leaf in _leaves(kind, ()):
        if path in without:
            continue
        as_text = isinstance(leaf, (T.ArrayType, T.VariantType, T.MapType))
        name, number = sep.join(path), 2
        while name.lower() in taken:
            name, number = f"{sep.join(path)}{sep}{number}", number + 1
        taken.add(name.lower())
        columns.append(variant_field(F.col(column), path, "string" if as_text else leaf.simpleString()).alias(name))
    return df.select(*keep, *columns)
