"""Headline numbers and trends over the reports.

Rates are pooled: numerators and denominators are added up first. A mean of daily
rates would give a one-lead day the weight of a fifty-lead day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.config import CANCEL_COLUMNS, OBJECTION_PATTERNS
from funnelspark.functions.values import ratio


def pooled_percent(part: str, whole: str) -> Column:
    return F.coalesce(ratio(F.sum(part), F.sum(whole)) * 100, F.lit(0.0))


def inbound_headline(report: DataFrame) -> DataFrame:
    return report.agg(
        F.sum("inbound_booked").alias("total_inbound_booked"),
        pooled_percent("inbound_taken", "inbound_booked").alias("show_rate"),
        F.sum("total_sales").alias("total_sales"),
    )


def outbound_headline(report: DataFrame) -> DataFrame:
    return report.agg(
        F.sum("total_outbound_calls").alias("total_outbound_calls"),
        pooled_percent("outbound_set", "total_outbound_calls").alias("dial_to_set"),
        F.sum("total_revenue").alias("total_revenue"),
    )


def closer_headline(report: DataFrame) -> DataFrame:
    return report.agg(
        F.sum("call_booked").alias("total_calls_booked"),
        F.sum("sale").alias("total_sales"),
        F.sum("cash_collected").alias("total_cash_collected"),
    )


def trend(report: DataFrame, date: str, rates: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Pooled rates per date; 0 where nothing was there to divide by."""
    columns = [pooled_percent(part, whole).alias(name) for name, (part, whole) in rates.items()]
    return report.groupBy(date).agg(*columns)


def inbound_trend(report: DataFrame) -> DataFrame:
    return trend(report, "triage_date", {"show_rate": ("inbound_taken", "inbound_booked")})


def outbound_trend(report: DataFrame) -> DataFrame:
    return trend(
        report,
        "dial_date",
        {
            "dial_to_set_rate": ("outbound_set", "total_outbound_calls"),
            "set_to_show_rate": ("total_closer_show", "outbound_set"),
            "show_to_sale_rate": ("total_sale", "total_closer_show"),
        },
    )


def column_totals(report: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """One row per column with its total."""
    totals = report.agg(*[F.sum(column).alias(column) for column in columns])
    return totals.unpivot([], list(columns), name, "total")


def cancellation_breakdown(report: DataFrame) -> DataFrame:
    return column_totals(report, CANCEL_COLUMNS, "cancellation")


def objection_totals(report: DataFrame) -> DataFrame:
    totals = column_totals(report, list(OBJECTION_PATTERNS), "category")
    return totals.orderBy(F.col("total").desc(), "category")


def newest_first(report: DataFrame, date: str) -> DataFrame:
    return report.orderBy(F.col(date).desc_nulls_first())
