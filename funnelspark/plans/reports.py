"""The four funnel reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark import config as c
from funnelspark.functions.values import (
    count_where,
    indicator,
    month_of,
    percent,
    ratio,
    to_number,
)
from funnelspark.plans import gold
from funnelspark.plans.silver import Silver


def strategy_per_lead(silver: Silver, corrected: bool = False) -> DataFrame:
    """Whether a lead ever attended, and ever got an offer at an attended call."""
    attended = F.col("status") == "ATTENDED"
    return gold.strategy_calls(silver, corrected).groupBy("lead_id").agg(
        F.max(indicator(attended)).alias("attended"),
        F.max(indicator(attended & (F.col("offer_presented") == "Yes"))).alias("offered"),
    )


def contract_per_lead(silver: Silver) -> DataFrame:
    value = to_number(F.col("contracted_value")).alias("contract_value")
    return gold.latest_sales(silver).select("lead_id", value)


def with_funnel(silver: Silver, touched: DataFrame, corrected: bool) -> DataFrame:
    """Add what became of each lead: flags for set, shown, offered and sold.

    ``touched`` is already one row per (date, setter, lead), and both joined sides
    are one row per lead, so nothing fans out and no lead brings its raw calls.
    """
    joined = touched.join(strategy_per_lead(silver, corrected), "lead_id", "left").join(
        contract_per_lead(silver), "lead_id", "left"
    )
    shown = (F.col("is_set") == 1) & (F.coalesce("attended", F.lit(0)) == 1)
    sold = shown & F.col("contract_value").isNotNull()
    return joined.withColumns(
        {
            "shown": indicator(shown),
            "offer": indicator(shown & (F.coalesce("offered", F.lit(0)) == 1)),
            "sold": indicator(sold),
            "revenue": F.when(sold, F.col("contract_value")).otherwise(0.0),
        }
    )


def inbound_grain(silver: Silver, corrected: bool = False) -> DataFrame:
    """One row per (triage date, setter, lead) with what became of the lead."""
    outcome = F.col("triage_call_outcome")
    taken = outcome.isNotNull() & ~outcome.isin(*c.TRIAGE_NOT_TAKEN)
    touched = (
        gold.inbound_strategies_booked(silver)
        .groupBy(
            F.col("triage_call_date").cast("date").alias("triage_date"),
            F.col("setter_closer_email").alias("setter"),
            "lead_id",
        )
        .agg(
            F.max(indicator(taken)).alias("is_taken"),
            F.max(indicator(F.col("strategy_call_booked"))).alias("is_set"),
        )
    )
    return with_funnel(silver, touched, corrected)


def inbound_totals(grain: DataFrame) -> DataFrame:
    totals = grain.groupBy("triage_date", "setter").agg(
        F.count("*").alias("inbound_booked"),
        F.sum("is_taken").alias("inbound_taken"),
        F.sum("is_set").alias("strategy_call_booked"),
        F.sum("shown").alias("strategy_call_taken"),
        F.sum("offer").alias("_offers"),
        F.sum("sold").alias("total_sales"),
        F.sum("revenue").alias("_revenue"),
    )
    booked, taken, set_, shown, sold = (
        F.col(name)
        for name in (
            "inbound_booked",
            "inbound_taken",
            "strategy_call_booked",
            "strategy_call_taken",
            "total_sales",
        )
    )
    return totals.select(
        "triage_date",
        "setter",
        "inbound_booked",
        "inbound_taken",
        percent(taken, booked).alias("show_rate"),
        percent(set_, taken).alias("triage_set_rate"),
        "strategy_call_booked",
        "strategy_call_taken",
        percent(F.col("_offers"), shown).alias("offer_rate"),
        "total_sales",
        percent(sold, shown).alias("sale_rate"),
        F.round(ratio(F.col("_revenue"), sold), 2).alias("average_order_value"),
    )


def inbound_setter_report(silver: Silver, corrected: bool = False) -> DataFrame:
    return inbound_totals(inbound_grain(silver, corrected))


def outbound_grain(silver: Silver, corrected: bool = False) -> DataFrame:
    """One row per (dial date, setter, lead) with what became of the lead."""
    touched = (
        gold.outbound_prospect_dials(silver)
        .groupBy(
            F.col("activity_log_date").cast("date").alias("dial_date"),
            F.col("setter_closer_email").alias("setter"),
            "lead_id",
        )
        .agg(
            F.count("*").alias("calls"),
            F.max(indicator(F.col("status") == "SET")).alias("is_set"),
        )
    )
    return with_funnel(silver, touched, corrected)


def outbound_totals(grain: DataFrame) -> DataFrame:
    totals = grain.groupBy("dial_date", "setter").agg(
        F.sum("calls").alias("total_outbound_calls"),
        F.count("*").alias("total_leads_touched"),
        F.sum("is_set").alias("outbound_set"),
        F.sum("shown").alias("total_closer_show"),
        F.sum("offer").alias("total_offer"),
        F.sum("sold").alias("total_sale"),
        F.sum("revenue").alias("total_revenue"),
    )
    calls, set_, shown, sold = (
        F.col(name)
        for name in ("total_outbound_calls", "outbound_set", "total_closer_show", "total_sale")
    )
    return totals.select(
        "dial_date",
        "setter",
        "total_outbound_calls",
        "total_leads_touched",
        "outbound_set",
        "total_closer_show",
        "total_offer",
        "total_sale",
        percent(set_, calls).alias("dial_to_set_rate"),
        percent(shown, set_).alias("set_to_show_rate"),
        percent(sold, shown).alias("show_to_sale_rate"),
        "total_revenue",
        F.round(ratio(F.col("total_revenue"), sold), 2).alias("average_order_value"),
    )


def outbound_setter_report(silver: Silver, corrected: bool = False) -> DataFrame:
    return outbound_totals(outbound_grain(silver, corrected))


def closer_grain(silver: Silver, corrected: bool = False) -> DataFrame:
    """One row per (lead, closer, month): its calls by result, and the lead's current sale."""
    outcomes = c.CORRECTED_CLOSER_COUNTS if corrected else c.CLOSER_COUNTS
    counts: dict[str, Column] = {
        name: F.col("strategy_call_outcome").isin(*values) for name, values in outcomes.items()
    }
    cancels = tuple(value for name in c.CANCEL_COLUMNS for value in outcomes[name])
    counts["total_cancel"] = F.col("strategy_call_outcome").isin(*cancels)
    counts["strtgy_call_shw"] = F.col("status") == "ATTENDED"
    calls = gold.with_user(
        silver, gold.strategy_calls(silver, corrected), "closer", "closer_email", "closer_name"
    )
    per_lead = calls.groupBy(
        "lead_id", "closer_name", month_of(F.col("activity_at")).alias("call_year_month")
    ).agg(
        F.count("*").alias("call_booked"),
        *[count_where(test).alias(name) for name, test in counts.items()],
    )
    sales = gold.latest_sales(silver).select(
        "lead_id",
        F.nullif(to_number(F.col("contracted_value")), F.lit(0.0)).alias("value"),
        to_number(F.col("cash_collected")).alias("cash"),
    )
    return per_lead.join(sales, "lead_id", "left")


def closer_totals(grain: DataFrame) -> DataFrame:
    weight = F.col("call_booked")
    counts = [n for n in grain.columns if n not in ("lead_id", "closer_name", "call_year_month", "value", "cash")]
    totals = grain.groupBy("closer_name", "call_year_month").agg(
        *[F.sum(name).alias(name) for name in counts],
        F.sum(F.col("value") * weight).alias("_value"),
        F.sum(F.when(F.col("value").isNotNull(), weight)).alias("_valued"),
        F.sum(F.col("cash") * weight).alias("cash_collected"),
    )
    return totals.select(
        "closer_name",
        "call_year_month",
        "call_booked",
        "admin_cancel",
        "cancel_nurture",
        "cancel_not_interest",
        "total_cancel",
        "no_show",
        "strtgy_call_shw",
        "lost",
        "sale",
        F.round(F.col("_value") / F.col("_valued"), 2).alias("avg_value"),
        "cash_collected",
    )


def closer_report(silver: Silver, corrected: bool = False) -> DataFrame:
    """Calls, cancellations and results per closer and month.

    The lead's current sale counts once per call of the lead. Calls are added up
    per (lead, closer, month) before the sale is joined, and the sale is weighted
    by their number, so a lead with many calls is never spread out again.
    """
    return closer_totals(closer_grain(silver, corrected))


def objections_faced_report(
    silver: Silver, patterns: Mapping[str, str] = c.OBJECTION_PATTERNS
) -> DataFrame:
    rows = gold.objections_faced(silver)
    return rows.groupBy(
        "closer_name", F.col("activity_at").cast("date").alias("activity_date")
    ).agg(
        F.countDistinct("activity_id").alias("total_calls"),
        *[
            count_where(F.col("objection_raw").ilike(f"%{text}%")).alias(name)
            for name, text in patterns.items()
        ],
    )


def corrected_objections_report(silver: Silver) -> DataFrame:
    return objections_faced_report(silver, c.CORRECTED_OBJECTION_PATTERNS)


REPORTS = {
    "inbound_setter_report": inbound_setter_report,
    "outbound_setter_report": outbound_setter_report,
    "closer_report": closer_report,
    "objections_faced_report": objections_faced_report,
}
