"""Gold views: user dimension, field fact and one view per activity family."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark import config as c
from funnelspark.functions.values import ends_with_any, week_of
from funnelspark.operators.fields import field_key, fields_as_columns, resolved_fields
from funnelspark.operators.latest import latest_per_key
from funnelspark.operators.lookup import lookup_join
from funnelspark.plans.silver import Silver

_SPREAD = ("lead_id", "activity_id")


def dim_users(silver: Silver, internal: tuple[str, ...] = c.INTERNAL_DOMAINS) -> DataFrame:
    return silver.users.select(
        "user_id",
        "email",
        "first_name",
        "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "role",
        "status",
        ends_with_any(F.col("email"), internal).alias("is_internal"),
    )


def with_user(silver: Silver, rows: DataFrame, role: str, email: str, name: str) -> DataFrame:
    """Add the e-mail and full name of the user in ``<role>_user_id``."""
    users = dim_users(silver).select(
        F.col("user_id").alias(f"{role}_user_id"),
        F.col("email").alias(email),
        F.col("full_name").alias(name),
    )
    key = [f"{role}_user_id"]
    return lookup_join(rows, users, key, "left", spread=_SPREAD, fits=silver.users_fit)


def fact_lead_funnel(silver: Silver) -> DataFrame:
    resolved = resolved_fields(silver.activities, silver.fields, _fits(silver))
    return resolved.select(
        "lead_id",
        "activity_id",
        "activity_at",
        "custom_activity_type_name",
        "field_name",
        "outcome_value",
        F.col("user_id").alias("record_user_id"),
    )


def _fits(silver: Silver) -> bool | str | None:
    """A part of a dictionary that fits also fits; otherwise measure the part."""
    return silver.fields_fit or None


def _family(silver: Silver, types: tuple[str, ...], columns: dict[str, str]) -> DataFrame:
    activities = silver.activities_of("custom_activity_type_name", types)
    return fields_as_columns(activities, silver.fields, types, columns, _fits(silver))


def strategy_call_activities(silver: Silver, corrected: bool = False) -> DataFrame:
    """One row per strategy call. Corrected: follow-ups use their own outcome field."""
    columns = {
        "setter_user_id": c.SETTER,
        "closer_user_id": c.CLOSER,
        "strategy_call_outcome": c.STRATEGY_OUTCOME,
        "offer_presented": c.OFFER_PRESENTED,
        "contract_value": c.CONTRACT_VALUE,
    }
    if not corrected:
        return _family(silver, c.STRATEGY_TYPES, columns)
    calls = _family(silver, c.STRATEGY_TYPES, columns | {"follow_up": c.FOLLOW_UP_OUTCOME})
    outcome = F.coalesce("strategy_call_outcome", "follow_up")
    return calls.withColumn("strategy_call_outcome", outcome).drop("follow_up")


def attendance(outcome: Column, corrected: bool = False) -> Column:
    """Everything not listed, a missing outcome included, counts as attended.

    Corrected: three explicit classes, and a missing outcome is pending.
    """
    if corrected:
        return (
            F.when(outcome.isin(*c.CORRECTED_ATTENDED), "ATTENDED")
            .when(outcome.isin(*c.CORRECTED_NOT_ATTENDED), "NOT_ATTENDED")
            .otherwise("PENDING")
        )
    return F.when(outcome.isin(*c.NOT_ATTENDED), "NOT_ATTENDED").otherwise("ATTENDED")


def strategy_calls(silver: Silver, corrected: bool = False) -> DataFrame:
    calls = strategy_call_activities(silver, corrected)
    return calls.withColumn("status", attendance(F.col("strategy_call_outcome"), corrected))


def _triage_calls(silver: Silver) -> DataFrame:
    columns = {"setter_user_id": c.SETTER, "triage_call_outcome": c.TRIAGE_OUTCOME}
    return _family(silver, c.TRIAGE_TYPES, columns)


def _prospecting_calls(silver: Silver) -> DataFrame:
    columns = {"setter_user_id": c.SETTER, "prospecting_call_outcome": c.PROSPECTING_OUTCOME}
    return _family(silver, c.PROSPECTING_TYPES, columns)


def inbound_strategies_booked(silver: Silver) -> DataFrame:
    calls = with_user(
        silver, _triage_calls(silver), "setter", "setter_closer_email", "setter_closer_name"
    )
    return calls.select(
        "lead_id",
        F.col("activity_at").alias("activity_log_date"),
        "setter_closer_email",
        "setter_closer_name",
        "triage_call_outcome",
        F.col("activity_at").alias("triage_call_date"),
        (F.col("triage_call_outcome") == c.TRIAGE_SET).alias("strategy_call_booked"),
        week_of(F.col("activity_at")).alias("sc_year_week"),
    )


def outbound_strategies_booked(silver: Silver) -> DataFrame:
    calls = with_user(
        silver, _prospecting_calls(silver), "setter", "setter_closer_email", "setter_closer_name"
    )
    return calls.select(
        "lead_id",
        F.col("activity_at").alias("activity_log_date"),
        "setter_closer_email",
        "setter_closer_name",
        F.col("activity_at").alias("prospect_call_date"),
        (F.col("prospecting_call_outcome") == c.PROSPECTING_SET).alias("strategy_call_booked"),
        week_of(F.col("activity_at")).alias("sc_year_week"),
    )


def all_strategies_details(silver: Silver, corrected: bool = False) -> DataFrame:
    calls = with_user(silver, strategy_calls(silver, corrected), "setter", "setter", "setter_name")
    calls = with_user(silver, calls, "closer", "closer_email", "closer_name")
    return calls.select(
        "lead_id",
        F.col("activity_at").alias("activity_log_date"),
        F.col("strategy_call_outcome").alias("custom_activity"),
        "status",
        "closer_email",
        "closer_name",
        "strategy_call_outcome",
        F.col("activity_at").alias("date_of_strategy_call"),
        "offer_presented",
        "setter",
        "setter_name",
    )


def latest_sales(silver: Silver) -> DataFrame:
    """The current sale of each lead; records without type, value and cash are stubs."""
    sales = _family(
        silver,
        c.SALE_TYPES,
        {
            "setter_user_id": c.SETTER,
            "closer_user_id": c.CLOSER,
            "sale_status": c.SALES_TYPE,
            "contracted_value": c.CONTRACT_VALUE,
            "cash_collected": c.CASH_COLLECTED,
            "program": c.PROGRAM,
            "date_of_sale": c.DATE_OF_SALE,
        },
    )
    real = sales.na.drop("all", subset=["sale_status", "contracted_value", "cash_collected"])
    newest = [F.col("activity_at").desc_nulls_first(), F.col("activity_id").desc()]
    return latest_per_key(real, ["lead_id"], newest)


def sales_details(silver: Silver) -> DataFrame:
    sales = with_user(silver, latest_sales(silver), "setter", "setter_email", "setter_name")
    sales = with_user(silver, sales, "closer", "closer_email", "closer_name")
    return sales.select(
        "lead_id",
        "activity_at",
        "sale_status",
        "setter_email",
        "setter_name",
        "closer_email",
        "closer_name",
        "contracted_value",
        "date_of_sale",
        "program",
        "cash_collected",
    )


def outbound_prospect_dials(silver: Silver) -> DataFrame:
    calls = with_user(
        silver, _prospecting_calls(silver), "setter", "setter_closer_email", "setter_closer_name"
    )
    outcome = F.col("prospecting_call_outcome")
    return calls.select(
        "lead_id",
        F.col("activity_at").alias("activity_log_date"),
        week_of(F.col("activity_at")).alias("prospect_year_week"),
        F.lit(c.PROSPECTING_TYPES[0]).alias("custom_activity"),
        F.when(outcome == c.PROSPECTING_SET, "SET").otherwise("DIAL_ONLY").alias("status"),
        outcome.alias("custom_activity_outcome_name"),
        outcome.alias("custom_activity_outcome"),
        "setter_closer_email",
        "setter_closer_name",
    )


def objections_faced(silver: Silver) -> DataFrame:
    """One row per objection field of an activity, with the call's closer.

    The closer sits on the same record, so it is read before the fields are
    spread out instead of joining the calls back. Activities that are not
    strategy calls have none.
    """
    closers = fields_as_columns(
        silver.activities_of("field_name", (c.OBJECTIONS,)),
        silver.fields,
        c.STRATEGY_TYPES,
        {"closer_user_id": c.CLOSER},
        _fits(silver),
        how="left",
        keep=("type_id", "custom_fields"),
    )
    entries = closers.select(
        "lead_id",
        "activity_id",
        "activity_at",
        "type_id",
        "closer_user_id",
        F.explode("custom_fields").alias("key", "objection_raw"),
    )
    named = silver.fields.where(F.col("field_name") == c.OBJECTIONS).select(
        field_key().alias("key"),
        F.col("custom_activity_type_id").alias("type_id"),
    )
    on = ["key", "type_id"]
    rows = lookup_join(entries, named, on, "inner", spread=_SPREAD, fits=_fits(silver))
    return with_user(silver, rows, "closer", "closer_email", "closer_name").select(
        "lead_id", "activity_id", "activity_at", "closer_name", "objection_raw"
    )


VIEWS = {
    "dim_users": dim_users,
    "fact_lead_funnel": fact_lead_funnel,
    "strategy_call_activities": strategy_call_activities,
    "inbound_strategies_booked": inbound_strategies_booked,
    "outbound_strategies_booked": outbound_strategies_booked,
    "all_strategies_details": all_strategies_details,
    "sales_details": sales_details,
    "outbound_prospect_dials": outbound_prospect_dials,
}
