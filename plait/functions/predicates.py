"""Filters written as texts (``eq.open``, ``gte.2026-01-01``, ``in.(a,b)``, ``not.is.null``) as column expressions.

Every filter of a scan must hold.  A value takes the type of its column, so that the scan can push the comparison down.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, functions as F, types as T

_COMPARE = {
    "eq": lambda c, v: c == v, "neq": lambda c, v: c != v, "gt": lambda c, v: c > v, "gte": lambda c, v: c >= v, "lt": lambda c, v: c < v, "lte": lambda c, v: c <= v,
}


def _column(df: DataFrame, name: str) -> tuple[Column, T.DataType]:
    """A column, or with ``column->>field`` a field of a struct or of JSON text, as text."""
    base, _, field = name.partition("->>")
    kind = df.schema[base].dataType
    if not field:
        return F.col(base), kind
    found = F.get_json_object(F.col(base), f"$.{field}") if isinstance(kind, T.StringType) else F.col(base)[field].cast("string")
    return found, T.StringType()


def predicate(df: DataFrame, name: str, text: str) -> Column:
    """One filter; an unknown operator is an error."""
    column, kind = _column(df, name)
    if text.startswith("not."):
        return ~predicate(df, name, text[4:])
    op, _, value = text.partition(".")
    if op == "is" and value in ("null", "true", "false"):
        return column.isNull() if value == "null" else column == (value == "true")
    if op == "in" and value.startswith("(") and value.endswith(")"):
        return column.isin(*[F.lit(v).cast(kind) for v in next(csv.reader([value[1:-1]]), [])])
    if op in _COMPARE:
        return _COMPARE[op](column, F.lit(value).cast(kind))
    raise ValueError(f"no such filter: {name}={text}")


def scan(df: DataFrame, select: str = "*", order: str | None = None, limit: int | None = None, offset: int | None = None, **filters: str) -> DataFrame:
    """A table scan: filters, then order (``published_at.asc,id.desc``, nulls last), offset and limit, then columns."""
    out = df
    for name, text in filters.items():
        out = out.where(predicate(df, name, text))
    if order:
        keys = [x.partition(".") for x in order.split(",")]
        out = out.orderBy(*[F.desc_nulls_last(k) if way == "desc" else F.asc_nulls_last(k) for k, _, way in keys])
    if offset:
        out = out.offset(offset)
    if limit is not None:
        out = out.limit(limit)
    return out if select == "*" else out.select(*[c.strip() for c in select.split(",")])
