"""Text helpers: lists in one string, HTML cells, row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGE_SPACE = r"^[ \t\r\n\f]+|[ \t\r\n\f]+\z"


def split_trim(text: Column, separator: str = ",") -> Column:
    """``" pm1 , voc"`` to ``["pm1", "voc"]``; empty items are kept."""
    return F.transform(
        F.split(text, f"\\Q{separator}\\E"), lambda item: F.regexp_replace(item, _EDGE_SPACE, "")
    )


def name_list(names: str | list[str] | tuple[str, ...]) -> list[str]:
    """The same list as an argument: a comma list or a Python sequence."""
    items = names.split(",") if isinstance(names, str) else names
    return [item.strip() for item in items]


def html_escape(text: Column) -> Column:
    for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def text_key(*columns: Column) -> Column:
    """The columns as one text that no other row shares: each with its length before it, NULL as ``-``."""
    texts = [c.cast("string") for c in columns]
    return F.concat(
        *[F.coalesce(F.concat(F.char_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    )


def row_key(*columns: Column) -> Column:
    """Hex SHA-1 over the columns as text; rows that differ in any column, or in what is NULL, differ."""
    return F.sha1(text_key(*columns))
