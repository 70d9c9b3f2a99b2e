"""Row-local parsing of report texts: lines, name/value lookups, safe numbers."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lines(body: Column) -> Column:
    return F.split(F.regexp_replace(body, "\r\n?", "\n"), "\n")


def number(value: Column) -> Column:
    """Double, with ``?``, blanks and NaN as null. The usual gaps are sorted out first: a failing cast is slow."""
    text = F.trim(value)
    return F.when(~text.isin("?", "", "NaN", "nan"), text).try_cast("double")


def fields(line: Column) -> Column:
    return F.split(line, "\t")


def last_value(pairs: Column, name: str) -> Column:
    """Value of the last ``(name, value)`` pair called ``name``, null when absent."""
    return F.try_element_at(F.filter(pairs, lambda p: p["name"] == name), F.lit(-1))["value"]


def by_header(header: Column, values: Column, name: str) -> Column:
    """Field of ``values`` that stands under ``name`` in ``header``; null when the name or the field is absent."""
    return F.get(values, F.array_position(header, F.lit(name)).cast("int") - 1)


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100
