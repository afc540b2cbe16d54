"""Nested objects to flat columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(schema: T.StructType, at: Column | None, prefix: str, sep: str, arrays_as_text: bool):
    for field in schema.fields:
        here = F.col(f"`{field.name}`") if at is None else at.getField(field.name)
        name = f"{prefix}{field.name}"
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here, name + sep, sep, arrays_as_text)
        elif arrays_as_text and isinstance(field.dataType, T.ArrayType):
            yield F.to_json(here).alias(name)
        else:
            yield here.alias(name)


def flatten(
    df: DataFrame,
    sep: str = "_",
    lower: bool = False,
    arrays_as_text: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``date.utc`` becomes ``date_utc``, at any depth.

    The schema drives it, so a row whose object is null gets null columns and an empty input keeps
    all its columns. Arrays stay as they are, or become JSON text with ``arrays_as_text``. The
    columns in ``keep`` come first, as they are.
    """
    rest = T.StructType([f for f in df.schema.fields if f.name not in keep])
    flat = df.select(*keep, *_leaves(rest, None, "", sep, arrays_as_text))
    if not lower:
        return flat
    return flat.toDF(*keep, *[c.lower() for c in flat.columns[len(keep):]])
