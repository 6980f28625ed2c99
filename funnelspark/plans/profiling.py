"""Looking into the raw source tables before trusting them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.config import OUTCOME_CODE
from funnelspark.functions.values import text_at
from funnelspark.operators.nested import string_leaves
from funnelspark.operators.quarantine import parse_payload
from funnelspark.plans.silver import items_of
from funnelspark.sources.landing import latest_raw, snapshot_date


def parsed_source(raw: DataFrame, limit: int | None = None) -> DataFrame:
    """Documents of the newest ``limit`` raw rows, or of all; NULL where parsing failed.

    Flattening drops the NULLs. Filtering them out here would move the whole repair
    into the filter as well and run it twice.
    """
    rows = raw if limit is None else latest_raw(raw, limit)
    payload = F.try_parse_json("raw_data").alias("payload")
    return parse_payload(rows.select(payload, "insert_date"))


def newest_snapshot(raw: DataFrame) -> DataFrame:
    """The raw rows of the newest snapshot; rows without a date count as newest."""
    dated = raw.withColumn("_snapshot", snapshot_date())
    newest = F.max(F.struct(F.col("_snapshot").isNull(), F.col("_snapshot"))).alias("newest")
    only = dated.agg(newest).select(F.col("newest._snapshot").alias("_newest"))
    same = F.col("_snapshot").eqNullSafe(F.col("_newest"))
    return dated.join(F.broadcast(only), same).select(*raw.columns)


def activity_catalog(raw: DataFrame) -> DataFrame:
    """Activity types of the newest snapshot, by name, archived ones marked."""
    types = items_of(parsed_source(newest_snapshot(raw)), "parsed", "type")
    name = text_at(F.col("type"), "name")
    archived = F.coalesce(F.try_variant_get("type", "$.is_archived", "boolean"), F.lit(False))
    mark = F.when(archived, " [ARCHIVED]").otherwise("")
    named = types.select(
        F.coalesce(name, F.lit("")).alias("name"),
        F.concat(F.coalesce(name, F.lit("None")), mark).alias("listing"),
    )
    return named.orderBy("name", "listing")


def outcome_values(raw: DataFrame, limit: int | None = None) -> DataFrame:
    """How often each coded outcome ("N. Label") occurs under each key path."""
    leaves = string_leaves(parsed_source(raw, limit), "parsed", lambda value: value.rlike(OUTCOME_CODE))
    counts = leaves.groupBy("key_path", "value").count()
    return counts.orderBy(F.col("count").desc(), "key_path", "value")


def outcome_highlights(outcomes: DataFrame) -> DataFrame:
    value = F.lower("value")
    return outcomes.where(value.contains("no show") | value.contains("cancel"))


def source_users(raw: DataFrame, limit: int | None = None) -> DataFrame:
    users = items_of(parsed_source(raw, limit), "parsed", "user")
    return users.select(
        text_at(F.col("user"), "email").alias("email"), text_at(F.col("user"), "role").alias("role")
    )


def email_domains(users: DataFrame) -> DataFrame:
    domain = F.lower(F.substring_index("email", "@", -1)).alias("domain")
    counts = users.where(F.col("email").contains("@")).groupBy(domain).count()
    return counts.orderBy(F.col("count").desc(), "domain")


def role_histogram(users: DataFrame) -> DataFrame:
    counts = users.where(F.col("role") != "").groupBy("role").count()
    return counts.orderBy(F.col("count").desc(), "role")
