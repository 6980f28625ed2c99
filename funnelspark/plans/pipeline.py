"""The daily stages: extract, load bronze, reconcile, build silver, publish views."""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.config import CRM_USERS, CUSTOM_ACTIVITIES, LEAD_ACTIVITIES, SOURCE_TABLES
from funnelspark.operators.history import fold_versions
from funnelspark.operators.quarantine import failures, no_data, parsed_rows, unseen_failures
from funnelspark.operators.upsert import UpsertRule, read_table, upsert_table
from funnelspark.plans import gold, quality, reports, silver
from funnelspark.sources.generations import newest, read_live
from funnelspark.sources.landing import extract_table, read_checkpoint, read_jdbc_table, run_summary
from funnelspark.sources.storage import open_table, whole_variants, written
from funnelspark.streaming.ingest import load_bronze_tables, read_bronze, read_ledger
from funnelspark.streaming.upserts import each_new_batch

MISSING_KEY = "record without a key"
NO_DATA = "document without data"


@dataclass(frozen=True)
class Folders:
    """One shared root; every stage owns a part of it."""

    root: str

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def state(self) -> str:
        return f"{self.root}/state"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def reconciliation(self) -> str:
        return f"{self.root}/reconciliation"

    @property
    def checkpoints(self) -> str:
        return f"{self.root}/checkpoints"


def extract(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    folders: Folders,
    run_ts: datetime,
    **options,
) -> DataFrame:
    """Land what is new in every source table; one summary row per table."""
    runs = [
        extract_table(spark, rows, table, folders.landing, folders.state, run_ts, **options)
        for table, rows in sources.items()
    ]
    return run_summary(spark, runs)


def extract_jdbc(
    spark: SparkSession, url: str, folders: Folders, run_ts: datetime, properties: Mapping[str, str] | None = None,
    **options,
) -> DataFrame:
    """Land what is new in the source tables of a database."""
    sources = {
        table: read_jdbc_table(spark, url, table, read_checkpoint(spark, folders.state, table), properties=properties)
        for table in SOURCE_TABLES
    }
    return extract(spark, sources, folders, run_ts, **options)


def load_bronze(spark: SparkSession, folders: Folders, run_ts: datetime) -> DataFrame:
    """Load the files not loaded before; one summary row per file."""
    load_bronze_tables(
        spark, folders.landing, folders.bronze, folders.checkpoints, SOURCE_TABLES, run_ts
    )
    return read_ledger(spark, folders.bronze).where(F.col("load_time") == _stamp(run_ts))


def reconcile(spark: SparkSession, folders: Folders, now: datetime) -> DataFrame:
    """Record the check of the latest loads and return the error rate."""
    checks = quality.reconciliation(read_ledger(spark, folders.bronze), now)
    checks.write.mode("append").parquet(folders.reconciliation)
    return quality.error_rate(spark.read.parquet(folders.reconciliation), now)


def record_failures(found: DataFrame, path: str) -> None:
    like = found.withColumn("occurrences", F.lit(0).cast("long"))
    fresh = unseen_failures(found, open_table(path, like))
    fresh.write.mode("append").parquet(path)


def parse_and_quarantine(bronze: DataFrame, table: str, root: str, run_ts: datetime) -> DataFrame:
    """Documents of the rows that parse; the others, and those without ``data``, are recorded."""
    path = f"{root}/{table}_parsed"
    rows = silver.parse_object_text(bronze)
    # Parsed once: good rows and failures, which alone need their text, are read from it.
    without = F.try_variant_get("parsed", "$.data", "variant").isNull()
    text = F.when(F.col("parsed").isNull() | without, F.col("raw_payload")).alias("raw_payload")
    rows = rows.select("insert_date", text, "parsed")
    with whole_variants(rows.sparkSession):
        rows.write.mode("overwrite").parquet(path)
    stored = rows.sparkSession.read.schema(rows.schema).parquet(path)
    found = failures(stored, table, _stamp(run_ts)).unionByName(
        failures(no_data(stored, "parsed"), table, _stamp(run_ts), NO_DATA)
    )
    record_failures(found, f"{root}/parse_failures")
    return parsed_rows(stored)


def _stamp(run_ts: datetime) -> Column:
    return F.lit(run_ts).cast("timestamp_ntz")


def upsert_users(
    bronze: DataFrame, root: str, run_ts: datetime, rule: UpsertRule, buckets: int | None = None
) -> DataFrame:
    """Upsert the newest users of ``bronze``; the table as it is then."""
    parsed = parse_and_quarantine(bronze, CRM_USERS, root, run_ts)
    users = silver.latest_users(parsed)
    schema = upsert_table(f"{root}/users", users, rule, _stamp(run_ts), buckets)
    return read_table(bronze.sparkSession, f"{root}/users", schema)


def fold_fields(bronze: DataFrame, root: str, run_ts: datetime, buckets: int | None = None) -> None:
    """Add catalog snapshots to the field dictionary; only these are parsed."""
    parsed = parse_and_quarantine(bronze, CUSTOM_ACTIVITIES, root, run_ts)
    versions = written(silver.hashed_fields(silver.field_versions(parsed)), "fields")
    narrow = versions.select("field_id", "custom_activity_type_id", "md5_hash", "version", "insert_date")
    fold_versions(
        f"{root}/custom_activity_fields", narrow, silver.latest_fields(versions), silver.FIELD_HISTORY, buckets
    )


def fold_users(bronze: DataFrame, root: str, run_ts: datetime, buckets: int | None = None) -> None:
    """Add user snapshots to the users."""
    parsed = parse_and_quarantine(bronze, CRM_USERS, root, run_ts)
    versions = written(silver.user_versions(parsed), "users")
    narrow = versions.select("user_id", "md5_hash", "insert_date", silver.version_of("insert_date"))
    latest = silver.latest_of_users(versions)
    fold_versions(f"{root}/users", narrow, latest, silver.USER_HISTORY, buckets)


def fold_activities(bronze: DataFrame, root: str, run_ts: datetime, buckets: int | None = None) -> None:
    """Add snapshots of activities; records without a key, and payloads without data, are recorded."""
    # Read, flattened and hashed once; what failed is read back without the records.
    flat = written(silver.flattened_activities(bronze), "activities")

    def failed(text: str, detail: str) -> DataFrame:
        rows = flat.where(F.col(text).isNotNull()).select("insert_date", F.col(text).alias("raw_payload"))
        return failures(rows.withColumn("parsed", F.lit(None)), LEAD_ACTIVITIES, _stamp(run_ts), detail)

    found = failed("keyless", MISSING_KEY).unionByName(failed("no_data", NO_DATA))
    record_failures(found, f"{root}/parse_failures")
    versions = flat.where("no_data IS NULL").drop("keyless", "no_data")
    # Kinds of records lie together, so a scan for one kind skips the others.
    order = ("record_type", "type_id")
    version = silver.version_of("activity_at", "insert_date")
    narrow = versions.select("lead_id", "activity_id", "activity_at", "md5_hash", "insert_date", version)
    latest = silver.latest_of_activities(versions)
    fold_versions(f"{root}/lead_activities", narrow, latest, silver.ACTIVITY_HISTORY, buckets, order)


#: How each bronze table becomes a silver one, and under which name.
_FOLDS = {
    CUSTOM_ACTIVITIES: (fold_fields, "custom_activity_fields"),
    CRM_USERS: (fold_users, "users"),
    LEAD_ACTIVITIES: (fold_activities, "lead_activities"),
}


def build_silver(
    spark: SparkSession,
    bronze: Mapping[str, DataFrame],
    root: str,
    run_ts: datetime,
    buckets: int | None = None,
) -> silver.Silver:
    """Bring the silver tables under ``root`` up to date with all of bronze."""
    for table, (fold, _) in _FOLDS.items():
        fold(bronze[table], root, run_ts, buckets)
    return read_silver(spark, root)


def update_silver(
    spark: SparkSession, folders: Folders, run_ts: datetime, buckets: int | None = None, max_files: int = 10_000
) -> silver.Silver:
    """Bring silver up to date from the bronze rows not processed before.

    In whatever order and slices the rows arrive, every row is the same as after one build
    over all of them. Work follows the new rows; published views see the result.
    """
    root = folders.silver
    for table, (fold, name) in _FOLDS.items():
        if newest(spark, f"{root}/{name}") is None:
            # The tables are there before any row is.
            fold(read_bronze(spark, folders.bronze, table).limit(0), root, run_ts, buckets)
        each_new_batch(
            spark,
            f"{folders.bronze}/{table}",
            f"{folders.checkpoints}/silver-{table}",
            partial(_folded, fold, root, run_ts, buckets),
            max_files,
        )
    refresh_views(spark)
    return read_silver(spark, root)


def _folded(fold, root: str, run_ts: datetime, buckets: int | None, batch: DataFrame) -> None:
    fold(batch, root, run_ts, buckets)


def read_silver(spark: SparkSession, root: str) -> silver.Silver:
    """The silver tables as they are now."""
    return silver.Silver(
        fields=read_table(spark, f"{root}/custom_activity_fields", silver.FIELDS_SCHEMA),
        users=read_table(spark, f"{root}/users", silver.USERS_SCHEMA),
        activities=read_table(spark, f"{root}/lead_activities", silver.ACTIVITIES_SCHEMA),
    )


def live_silver(spark: SparkSession, root: str) -> silver.Silver:
    """The silver tables as they are whenever a view of them is run."""

    def table(name: str, schema: str) -> DataFrame:
        return read_live(spark, f"{root}/{name}", "rows", schema).drop("bucket")

    return silver.Silver(
        fields=table("custom_activity_fields", silver.FIELDS_SCHEMA),
        users=table("users", silver.USERS_SCHEMA),
        activities=table("lead_activities", silver.ACTIVITIES_SCHEMA),
        live=True,
    )


#: Published views by application, and the reads of ``load_view`` with their times.
_published: dict[str, list[str]] = {}
_loaded: dict[tuple[str, str], tuple[float, DataFrame]] = {}
CACHE_SECONDS = 300


def publish(spark: SparkSession, tables: silver.Silver) -> dict[str, DataFrame]:
    """Register every gold view and report.

    Over ``live_silver`` they find the newest version, its rows and its types when they are run. Spark lists
    a view's files once, and again on ``REFRESH TABLE``: ``update_silver`` does that in its
    session, ``load_view`` in any other.
    """
    views = {name: view(tables) for name, view in {**gold.VIEWS, **reports.REPORTS}.items()}
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    _published[spark.sparkContext.applicationId] = list(views)
    return views


def refresh_views(spark: SparkSession) -> None:
    """Let the views published in this application list their files anew."""
    for name in _published.get(spark.sparkContext.applicationId, []):
        spark.catalog.refreshTable(name)


def load_view(spark: SparkSession, name: str, max_age: float = CACHE_SECONDS) -> DataFrame:
    """A published view as of now; its rows are kept for reads within ``max_age`` seconds."""
    key = (spark.sparkContext.applicationId, name)
    loaded_at, rows = _loaded.get(key, (0.0, None))
    if rows is not None and rows.is_cached and time.monotonic() - loaded_at < max_age:
        return rows
    if rows is not None:
        rows.unpersist()
    spark.catalog.refreshTable(name)
    rows = spark.table(name).cache()
    _loaded[key] = (time.monotonic(), rows)
    return rows


def export_csv(report: DataFrame, path: str) -> None:
    """Write one report as CSV with a header; a small one ends up in a single file."""
    report.write.mode("overwrite").option("header", True).csv(path)


def run_daily(
    spark: SparkSession, sources: Mapping[str, DataFrame], folders: Folders, run_ts: datetime
) -> DataFrame:
    """All stages in order; a failing stage keeps the later ones from running."""
    extract(spark, sources, folders, run_ts)
    load_bronze(spark, folders, run_ts)
    rate = reconcile(spark, folders, run_ts)
    update_silver(spark, folders, run_ts)
    publish(spark, live_silver(spark, folders.silver))
    return rate
