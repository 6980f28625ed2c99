"""Typed reads, rates and date buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's own cast accepts '12d' and 'NaN'; a money field must not.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def text_at(record: Column, key: str) -> Column:
    """A top-level key of a variant as text; the key may contain dots."""
    return F.try_variant_get(record, f"$['{key}']", "string")


def wall_clock(text: Column) -> Column:
    """Timestamp without time zone; an offset in the text is dropped."""
    return text.try_cast("timestamp_ntz")


def to_number(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def ratio(part: Column, whole: Column) -> Column:
    return part / F.nullif(whole, F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    return F.round(ratio(part, whole) * 100, 1)


def indicator(condition: Column) -> Column:
    """1 when true, 0 when false or unknown."""
    return F.when(condition, 1).otherwise(0)


def week_of(moment: Column) -> Column:
    return F.trunc(moment.cast("date"), "week")


def month_of(moment: Column) -> Column:
    return F.trunc(moment.cast("date"), "month")


def ends_with_any(text: Column, endings: Sequence[str]) -> Column:
    """Case-insensitive; FALSE for a missing text."""
    found = F.lit(False)
    for ending in endings:
        found = found | text.ilike(f"%{ending}")
    return F.coalesce(found, F.lit(False))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)
