"""Resolving custom fields of activities through the field dictionary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.config import CUSTOM_ACTIVITY, CUSTOM_PREFIX
from funnelspark.operators.lookup import lookup_join

_RECORD = ("lead_id", "activity_id")


def field_key() -> Column:
    """The key under which a record holds the dictionary's field."""
    return F.concat(F.lit(CUSTOM_PREFIX), F.col("field_id"))


def custom_records(activities: DataFrame) -> DataFrame:
    """Only records that can carry custom fields; the filter reaches the scan."""
    return activities.where(F.col("record_type") == CUSTOM_ACTIVITY).select(
        "lead_id", "activity_id", "activity_at", "type_id", "user_id", "custom_fields"
    )


def resolved_fields(activities: DataFrame, fields: DataFrame, fits: bool | str | None) -> DataFrame:
    """One row per (activity, field) with the names of the field and its type.

    A field shared by several types counts only for the activity's own type.
    """
    entries = custom_records(activities).select(
        "lead_id",
        "activity_id",
        "activity_at",
        "type_id",
        "user_id",
        F.explode("custom_fields").alias("key", "outcome_value"),
    )
    names = fields.select(
        field_key().alias("key"),
        F.col("custom_activity_type_id").alias("type_id"),
        "custom_activity_type_name",
        "field_name",
    )
    on = ["key", "type_id"]
    return lookup_join(entries, names, on, "inner", spread=_RECORD, fits=fits)


def _largest(keys: str) -> Column:
    """MAX over the values of the record's keys named in ``keys``."""
    return F.expr(f"array_max(transform({keys}, key -> custom_fields[key]))")


def fields_as_columns(
    activities: DataFrame,
    fields: DataFrame,
    type_names: Sequence[str],
    columns: Mapping[str, str],
    fits: bool | str | None,
    *,
    how: str = "inner",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per activity of the given types with chosen fields as columns.

    ``columns`` maps an output column to a field name. A silver activity is a
    single record holding all its fields, so pivoting it needs no shuffle: the
    dictionary is gathered to one row per type, naming the keys of each column.
    An activity counts when it has at least one field of its type. With
    ``how="left"`` activities of other types stay, their columns NULL.
    """
    of_types = fields.where(F.col("custom_activity_type_name").isin(*type_names))
    named = [
        F.collect_set(F.when(F.col("field_name") == name, field_key())).alias(f"_keys_{column}")
        for column, name in columns.items()
    ]
    # A type's fields came out of one catalog document, which bounds the arrays.
    per_type = of_types.groupBy(F.col("custom_activity_type_id").alias("type_id")).agg(
        F.collect_set(field_key()).alias("_keys"), *named
    )
    records = custom_records(activities)
    joined = lookup_join(records, per_type, ["type_id"], how, spread=_RECORD, fits=fits)
    if how == "inner":
        joined = joined.where(F.arrays_overlap(F.map_keys("custom_fields"), "_keys"))
    return joined.select(
        "lead_id",
        "activity_id",
        "activity_at",
        *keep,
        *[_largest(f"_keys_{column}").alias(column) for column in columns],
    )
