"""Load reconciliation and invariants."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.config import ERROR_RATE_LIMIT
from funnelspark.functions.values import ratio


def reconciliation(
    ledger: DataFrame, now: datetime, since: timedelta = timedelta(hours=2)
) -> DataFrame:
    """Files, rows and errors per table among the loads of the last hours."""
    recent = ledger.where(F.col("load_time") >= F.lit(now - since).cast("timestamp_ntz"))
    totals = recent.groupBy("table_name").agg(
        F.countDistinct("file_name").alias("files_staged"),
        F.sum("row_count").alias("rows_loaded"),
        F.sum("row_parsed").alias("rows_parsed"),
        F.sum("error_count").alias("errors_seen"),
    )
    return totals.select(
        F.lit(now).cast("timestamp_ntz").alias("check_time"),
        "table_name",
        "files_staged",
        "rows_loaded",
        "rows_parsed",
        "errors_seen",
    )


def error_rate(
    checks: DataFrame,
    now: datetime,
    since: timedelta = timedelta(minutes=10),
    limit: float = ERROR_RATE_LIMIT,
) -> DataFrame:
    """One row: failed share of the rows checked lately, and whether it is too high."""
    recent = checks.where(F.col("check_time") >= F.lit(now - since).cast("timestamp_ntz"))
    rate = F.coalesce(ratio(F.sum("errors_seen"), F.sum("rows_loaded")), F.lit(0.0))
    return recent.agg(rate.alias("error_rate")).withColumn("breached", F.col("error_rate") > limit)


def parsed_without_data(parsed: DataFrame) -> DataFrame:
    """Documents that parse but hold no ``data``; flattening drops them silently."""
    missing = F.try_variant_get("parsed", "$.data", "variant").isNull()
    return parsed.agg(F.count_if(missing).alias("rows_without_data"))
