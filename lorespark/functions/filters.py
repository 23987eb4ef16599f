"""The filter language: nested dictionaries to one Column, with unknown operators refused."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class UnsupportedFilter(ValueError):
    """A filter names an operator that doesn't exist."""


_COMPARE = {
    "$eq": lambda c, v: c == v,
    "$ne": lambda c, v: ~c.eqNullSafe(v),
    "$in": lambda c, v: c.isin(list(v)),
    "$nin": lambda c, v: ~F.coalesce(c.isin(list(v)), F.lit(False)),
    "$gt": lambda c, v: c > v,
    "$gte": lambda c, v: c >= v,
    "$lt": lambda c, v: c < v,
    "$lte": lambda c, v: c <= v,
    "$contains": lambda c, v: F.contains(c, F.lit(v)),
}
_JOIN = {"$and": lambda a, b: a & b, "$or": lambda a, b: a | b}


def where_column(where: dict[str, Any] | None, document: str = "document") -> Column:
    """`{field: value}`, `{field: {op: value}}`, `{"$and" | "$or": [...]}` or `{"$contains": text}` on the document.

    Several entries of one dictionary must all hold. Raises UnsupportedFilter for unknown operators, at planning time.
    """
    parts = []
    for key, value in (where or {}).items():
        if key in _JOIN:
            if not value:
                raise UnsupportedFilter(f"{key} needs at least one filter")
            parts.append(reduce(_JOIN[key], [where_column(v, document) for v in value]))
        elif key == "$contains":
            parts.append(F.contains(F.col(document), F.lit(value)))
        elif key.startswith("$"):
            raise UnsupportedFilter(f"unknown operator {key}")
        elif isinstance(value, dict):
            for op, operand in value.items():
                if op not in _COMPARE:
                    raise UnsupportedFilter(f"unknown operator {op}")
                parts.append(_COMPARE[op](F.col(key), operand))
        else:
            parts.append(F.col(key) == value)
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def get(chunks: DataFrame, ids: list[str] | None = None, where: dict | None = None, where_document: dict | None = None, limit: int | None = None, offset: int = 0, include: tuple[str, ...] = ("document",)) -> DataFrame:
    """Filtered rows by id order, with the id and the included columns only."""
    out = chunks.where(where_column(where)).where(where_column(where_document))
    if ids is not None:
        out = out.where(F.col("id").isin(ids))
    out = out.withColumn("document", F.coalesce("document", F.lit(""))) if "document" in include else out
    out = out.orderBy("id").offset(offset) if limit is not None or offset else out
    return (out if limit is None else out.limit(limit)).select("id", *include)


def scope(wing: str | None = None, room: str | None = None) -> Column:
    return where_column({k: v for k, v in (("wing", wing), ("room", room)) if v})
