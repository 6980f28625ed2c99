"""Named queries over a folder with the given test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark import config as c
from funnelspark.operators import quarantine
from funnelspark.operators.upsert import read_table, upsert_table
from funnelspark.plans import gold, metrics, pipeline, profiling, quality, reports, silver
from funnelspark.sources import crm, landing
from funnelspark.sources.rolling import written_files
from funnelspark.sources.storage import new_folder, whole_variants, written
from funnelspark.streaming.ingest import load_bronze_tables, read_bronze, read_ledger
from funnelspark.streaming.upserts import each_new_batch

Query = Callable[[SparkSession, str], DataFrame]

FIRST_RUN = datetime(2024, 3, 1)
SECOND_RUN = datetime(2024, 3, 2)
SCAN_FROM = datetime(2024, 1, 10, 13)
LAST_FIRST_RUN_SNAPSHOT = datetime(2024, 1, 11, 13)
SECOND_LOAD_FROM = datetime(2024, 1, 12)
SMALL_BATCH_BYTES = 4096
SAMPLE_ROWS = 200

_built: dict[tuple, silver.Silver] = {}


def _state_of(spark: SparkSession, sf_dir: str) -> tuple:
    """Number, size and last change of the input files."""
    files = spark.read.format("binaryFile").load(
        [f"{sf_dir}/{table}.parquet" for table in ("events", "customer", "part")]
    )
    return tuple(files.agg(F.count("*"), F.sum("length"), F.max("modificationTime")).first())


def new_silver(spark: SparkSession, sf_dir: str) -> silver.Silver:
    # A build reads each bronze table once and writes what it makes of it, so bronze itself is not written before.
    bronze = crm.bronze_tables(spark, sf_dir)
    return pipeline.build_silver(spark, bronze, new_folder(spark, "silver"), FIRST_RUN)


def silver_of(spark: SparkSession, sf_dir: str) -> silver.Silver:
    """The written silver tables of the folder, built on first use and when it changes."""
    key = (spark.sparkContext.applicationId, sf_dir, _state_of(spark, sf_dir))
    if key not in _built:
        _built[key] = new_silver(spark, sf_dir)
    return _built[key]


def _on_silver(view: Callable[[silver.Silver], DataFrame]) -> Query:
    return lambda spark, sf_dir: view(silver_of(spark, sf_dir))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _money(report: DataFrame, *columns: str) -> DataFrame:
    """Sums of doubles depend on their order beyond the cents."""
    return report.withColumns({name: F.round(name, 2) for name in columns})


# Extraction and landing


def incremental_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for table, rows in crm.raw_tables(spark, sf_dir).items():
        fresh = landing.after_checkpoint(rows, SCAN_FROM)
        mark = F.coalesce(F.max("insert_date"), F.lit(SCAN_FROM).cast("timestamp_ntz"))
        parts.append(
            fresh.agg(F.count("*").alias("rows_extracted"), mark.alias("new_checkpoint")).select(
                F.lit(table).alias("table_name"), "*"
            )
        )
    return _union(parts)


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two extractions of the same sources; the second finds nothing new.

    The files listed by a run must be as many as its batches and hold as many rows.
    """
    folders = pipeline.Folders(new_folder(spark, "extract"))
    sources = crm.raw_tables(spark, sf_dir)
    runs = []
    for number, run_ts in enumerate((FIRST_RUN, SECOND_RUN), start=1):
        summary = pipeline.extract(spark, sources, folders, run_ts).withColumn("run", F.lit(number))
        listed = _union(
            [
                written_files(spark, landing.keys_folder(folders.landing, table, FIRST_RUN)).select(
                    F.lit(table).alias("table"), F.lit(1).alias("run"), "rows"
                )
                for table in sources
            ]
        )
        files = listed.groupBy("table", "run").agg(F.count("*").alias("files"), F.sum("rows").alias("n"))
        runs.append(summary.join(files, ["table", "run"], "left"))
    return _union(runs).select(
        "table",
        "rows_extracted",
        "checkpoint_advanced",
        "new_checkpoint",
        "run",
        (F.coalesce("files", F.lit(0)) == F.col("batches")).alias("all_listed"),
        F.coalesce("n", F.lit(0)).alias("rows_listed"),
    )


def _land_and_load(spark: SparkSession, lines: dict[str, DataFrame]) -> pipeline.Folders:
    folders = pipeline.Folders(new_folder(spark, "load"))
    for table, rows in lines.items():
        landing.roll_landing(rows, folders.landing, table, FIRST_RUN)
    pipeline.load_bronze(spark, folders, FIRST_RUN)
    return folders


def envelope_land_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows after landing and loading, and after loading the same files again."""
    raw = crm.raw_tables(spark, sf_dir)
    folders = _land_and_load(spark, {t: landing.envelope(rows) for t, rows in raw.items()})

    def loaded(number: int) -> DataFrame:
        return _union(
            [
                read_bronze(spark, folders.bronze, table)
                .agg(
                    F.count("*").alias("rows_loaded"),
                    F.count("payload").alias("payloads"),
                    F.min("insert_date").alias("first_insert"),
                    F.max("insert_date").alias("last_insert"),
                )
                .select(F.lit(table).alias("table_name"), F.lit(number).alias("load"), "*")
                for table in raw
            ]
        )

    first = loaded(1)
    pipeline.load_bronze(spark, folders, SECOND_RUN)
    return first.unionByName(loaded(2))


_loads: dict[tuple, pipeline.Folders] = {}


def _two_loads(spark: SparkSession, sf_dir: str) -> pipeline.Folders:
    """Raw rows landed in a file a day and loaded and reconciled in two runs; some lines are cut off.

    Done on first use and when the folder changes.
    """
    key = (spark.sparkContext.applicationId, sf_dir, _state_of(spark, sf_dir))
    if key in _loads:
        return _loads[key]
    day = F.date_format("insert_date", "yyyyMMdd").cast("long")
    raw = {t: rows.withColumn("batch", day).repartition("batch") for t, rows in crm.raw_tables(spark, sf_dir).items()}
    # Most of the texts: they are made in the tasks that write them.
    raw[c.LEAD_ACTIVITIES] = crm.lead_activities_by(spark, sf_dir, day)
    lines = {t: landing.envelope(rows) for t, rows in raw.items()}
    cut = F.col("line").rlike('"acti_[0-9]*00"')
    half = F.col("line").substr(F.lit(1), F.floor(F.length("line") / 2).cast("int"))
    lines[c.LEAD_ACTIVITIES] = lines[c.LEAD_ACTIVITIES].withColumn(
        "line", F.when(cut, half).otherwise(F.col("line"))
    )
    folders = pipeline.Folders(new_folder(spark, "loads"))
    late = F.col("insert_date") >= F.lit(SECOND_LOAD_FROM).cast("timestamp_ntz")
    for part, run_ts in ((~late, FIRST_RUN), (late, SECOND_RUN)):
        for table, rows in lines.items():
            landing.write_landing(rows.where(part), folders.landing, table, run_ts)
        pipeline.load_bronze(spark, folders, run_ts)
        pipeline.reconcile(spark, folders, run_ts)
    _loads[key] = folders
    return folders


def load_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reconciliation of all files of two loads."""
    ledger = read_ledger(spark, _two_loads(spark, sf_dir).bronze)
    return quality.reconciliation(ledger, SECOND_RUN, since=SECOND_RUN - FIRST_RUN)


def size_bounded_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    raw = events.select(
        F.col("props").alias("raw_data"), F.col("ts").alias("insert_date"), "event_id"
    )
    lines = landing.envelope(raw)
    groups = landing.group_count(lines.agg(landing.line_bytes()).first()[0], SMALL_BATCH_BYTES)
    batched = landing.size_batches(
        lines, SMALL_BATCH_BYTES, ["insert_date", "event_id"], groups, spread=F.col("event_id")
    )
    return batched.groupBy("batch").agg(
        F.count("*").alias("lines"),
        landing.line_bytes().alias("bytes"),
        F.count_if("opens_batch").alias("opened"),
    )


def raw_latest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = landing.latest_raw(crm.crm_users(spark, sf_dir), SAMPLE_ROWS)
    return newest.select(
        "insert_date",
        F.nullif(F.regexp_extract("raw_data", "'id': '(user_[0-9]+)'", 1), F.lit("")).alias(
            "first_user"
        ),
    )


def ordered_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts")
    return landing.page(events, ["ts", "event_id"], limit=100, offset=300)


# Load quality


def load_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reconciliation at the second load, whose two hours leave the first one out."""
    ledger = read_ledger(spark, _two_loads(spark, sf_dir).bronze)
    return quality.reconciliation(ledger, SECOND_RUN)


def error_rate_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error rate over the recorded checks of the last minutes."""
    checks = spark.read.parquet(_two_loads(spark, sf_dir).reconciliation)
    return quality.error_rate(checks, SECOND_RUN)


# Repair and quarantine


def payload_shape_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per layout; the keys are looked at only where no layout matches."""
    keys = F.when(F.col("shape") == "unrecognized", quarantine.payload_keys(F.col("payload")))
    parts = [
        rows.withColumn("shape", quarantine.payload_shape(F.col("payload")))
        .groupBy(F.lit(table).alias("table_name"), "shape", keys.alias("keys"))
        .agg(F.count("*").alias("rows"))
        for table, rows in crm.bronze_tables(spark, sf_dir).items()
    ]
    return _union(parts)


def _parsed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.parse_object_text(crm.bronze_tables(spark, sf_dir)[c.CRM_USERS])


def repair_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.user_versions(_parsed_users(spark, sf_dir)).drop("md5_hash")


def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = crm.bronze_tables(spark, sf_dir)
    parts = []
    for table in (c.CUSTOM_ACTIVITIES, c.CRM_USERS):
        parsed = silver.parse_object_text(bronze[table])
        parts.append(
            parsed.groupBy("insert_date")
            .agg(
                F.count("parsed").alias("parsed_rows"),
                F.count_if(F.col("parsed").isNull()).alias("failed_rows"),
            )
            .select(F.lit(table).alias("source_table"), "*")
        )
    return _union(parts)


def parse_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined rows of both sources after two runs over the same input."""
    bronze = crm.bronze_tables(spark, sf_dir)
    path = new_folder(spark, "parse_failures")
    for run_ts in (FIRST_RUN, SECOND_RUN):
        stamp = F.lit(run_ts).cast("timestamp_ntz")
        found = _union(
            [
                quarantine.failures(silver.parse_object_text(bronze[table]), table, stamp)
                for table in (c.CUSTOM_ACTIVITIES, c.CRM_USERS)
            ]
        )
        pipeline.record_failures(found, path)
    rows = spark.read.parquet(path)
    return rows.select(
        "source_table",
        "insert_date",
        "error_detail",
        "raw_payload",
        F.length("raw_payload").alias("text_length"),
        "occurrences",
        "failed_at",
    )


def quarantine_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine.failure_samples(_parsed_users(spark, sf_dir))


# Silver


def silver_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each silver table, built anew."""
    tables = new_silver(spark, sf_dir)
    return _union(
        [
            rows.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
            for name, rows in vars(tables).items()
            if name in ("fields", "users", "activities")
        ]
    )


def field_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = crm.bronze_tables(spark, sf_dir)[c.CUSTOM_ACTIVITIES]
    return silver.field_dictionary(silver.parse_object_text(bronze))


def _until(rows: DataFrame, last: datetime) -> DataFrame:
    return rows.where(F.col("insert_date") <= F.lit(last).cast("timestamp_ntz"))


def _stamp(run_ts: datetime):
    return F.lit(run_ts).cast("timestamp_ntz")


def users_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users after a run over the first two snapshots and one over all of them."""
    bronze = crm.bronze_tables(spark, sf_dir)[c.CRM_USERS]
    root = new_folder(spark, "users")
    first = _until(bronze, LAST_FIRST_RUN_SNAPSHOT)
    for rows, run_ts in ((first, FIRST_RUN), (bronze, SECOND_RUN)):
        users = pipeline.upsert_users(rows, root, run_ts, silver.USER_RULE)
    return users.drop("md5_hash", "version")


def users_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two runs as streams over landed files and a written table."""
    raw = crm.crm_users(spark, sf_dir)
    folders = pipeline.Folders(new_folder(spark, "users_stream"))
    rule = replace(silver.USER_RULE, version="version")
    for run_ts in (FIRST_RUN, SECOND_RUN):
        arrived = _until(raw, LAST_FIRST_RUN_SNAPSHOT) if run_ts == FIRST_RUN else raw
        landing.extract_table(
            spark, arrived, c.CRM_USERS, folders.landing, folders.state, run_ts
        )
        load_bronze_tables(
            spark, folders.landing, folders.bronze, folders.checkpoints, [c.CRM_USERS], run_ts
        )
        each_new_batch(
            spark,
            f"{folders.bronze}/{c.CRM_USERS}",
            f"{folders.checkpoints}/silver",
            lambda batch: pipeline.upsert_users(batch, folders.silver, run_ts, rule),
        )
    return read_table(spark, f"{folders.silver}/users", silver.USERS_SCHEMA).drop("md5_hash")


def activities_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activities after a run without and a run with the last snapshot of each."""
    bronze = crm.bronze_tables(spark, sf_dir)[c.LEAD_ACTIVITIES]
    moment = F.try_variant_get("payload", "$.data[0].activity_at", "string")
    age = F.datediff("insert_date", silver.wall_clock(moment))
    path = new_folder(spark, "lead_activities")
    for rows, run_ts in ((bronze.where(age <= 2), FIRST_RUN), (bronze, SECOND_RUN)):
        source = silver.latest_activities(rows)
        upsert_table(path, source, silver.ACTIVITY_RULE, _stamp(run_ts))
    return _whole_activities(read_table(spark, path, silver.ACTIVITIES_SCHEMA))


_daily: dict[tuple, silver.Silver] = {}


def _daily_silver(spark: SparkSession, sf_dir: str) -> silver.Silver:
    """Silver after the late snapshots and then all of them again, once per state of the folder."""
    key = (spark.sparkContext.applicationId, sf_dir, _state_of(spark, sf_dir))
    if key not in _daily:
        bronze = {t: written(rows, t) for t, rows in crm.bronze_tables(spark, sf_dir).items()}
        root = new_folder(spark, "daily")
        late = F.col("insert_date") >= F.lit(SECOND_LOAD_FROM).cast("timestamp_ntz")
        pipeline.build_silver(spark, {t: rows.where(late) for t, rows in bronze.items()}, root, FIRST_RUN)
        _daily[key] = pipeline.build_silver(spark, bronze, root, SECOND_RUN)
    return _daily[key]


def daily_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows of the users of daily runs, snapshots out of order."""
    return _daily_silver(spark, sf_dir).users.drop("md5_hash")


def daily_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_silver(spark, sf_dir).fields


def _whole_activities(activities: DataFrame) -> DataFrame:
    return activities.select(
        "lead_id",
        "activity_id",
        "activity_at",
        "record_type",
        "type_id",
        "user_id",
        F.col("custom_fields")[f"custom.{crm.field_id(c.SETTER)}"].alias("setter"),
        F.size("custom_fields").alias("custom_fields"),
        "insert_date",
        "update_date",
    )


def daily_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows of the activities of daily runs, snapshots out of order."""
    return _whole_activities(_daily_silver(spark, sf_dir).activities)


def activities_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows from a stream over bronze files, half of a run's files a batch, with repeats."""
    bronze = crm.bronze_tables(spark, sf_dir)[c.LEAD_ACTIVITIES]
    folders = pipeline.Folders(new_folder(spark, "activities_stream"))
    late = F.col("insert_date") >= F.lit(SECOND_LOAD_FROM).cast("timestamp_ntz")
    stored = bronze.withColumn("error", F.lit(None).cast("string"))
    path = f"{folders.bronze}/{c.LEAD_ACTIVITIES}"
    # A task writes a file, so a batch is read by many tasks.
    half = -(-crm.pieces(spark, sf_dir, "events") // 2)
    for rows, run_ts in ((stored.where(late), FIRST_RUN), (stored, SECOND_RUN)):
        # Batches read whole payloads.
        with whole_variants(spark):
            rows.write.mode("append").parquet(path)
        each_new_batch(
            spark,
            path,
            f"{folders.checkpoints}/silver",
            lambda batch: pipeline.fold_activities(batch, folders.silver, run_ts),
            max_files=half,
        )
    schema = silver.ACTIVITIES_SCHEMA
    return _whole_activities(read_table(spark, f"{folders.silver}/lead_activities", schema))


def missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activities that cannot be upserted because they have no id."""
    versions = silver.activity_versions(crm.bronze_tables(spark, sf_dir)[c.LEAD_ACTIVITIES])
    rows = silver.without_keys(versions, silver.ACTIVITY_RULE)
    return rows.groupBy("lead_id", "insert_date").agg(F.count("*").alias("rows"))


# Profiling


def _raw(table: str, job: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: job(crm.raw_tables(spark, sf_dir)[table])


QUERIES: dict[str, Query] = {
    "incremental_scan": incremental_scan,
    "run_summary": run_summary,
    "ordered_page": ordered_page,
    "envelope_land_roundtrip": envelope_land_roundtrip,
    "size_bounded_batches": size_bounded_batches,
    "load_ledger": load_ledger,
    "load_reconciliation": load_reconciliation,
    "error_rate_check": error_rate_check,
    "raw_latest_n": raw_latest_n,
    "payload_shape_route": payload_shape_route,
    "repair_parse": repair_parse,
    "quarantine_split": quarantine_split,
    "parse_failures": parse_failures,
    "quarantine_samples": quarantine_samples,
    "silver_build": silver_build,
    "field_dictionary": field_dictionary,
    "users_upsert": users_upsert,
    "users_stream_upsert": users_stream_upsert,
    "activities_upsert": activities_upsert,
    "daily_users": daily_users,
    "daily_dictionary": daily_dictionary,
    "daily_activities": daily_activities,
    "activities_stream_upsert": activities_stream_upsert,
    "missing_keys": missing_keys,
    "dim_users": _on_silver(gold.dim_users),
    "fact_lead_funnel": _on_silver(gold.fact_lead_funnel),
    "strategy_call_activities": _on_silver(gold.strategy_call_activities),
    "inbound_booked": _on_silver(gold.inbound_strategies_booked),
    "outbound_booked": _on_silver(gold.outbound_strategies_booked),
    "all_strategies": _on_silver(gold.all_strategies_details),
    "all_strategies_fixed": _on_silver(lambda s: gold.all_strategies_details(s, corrected=True)),
    "sales_details": _on_silver(gold.sales_details),
    "prospect_dials": _on_silver(gold.outbound_prospect_dials),
    "inbound_report": _on_silver(reports.inbound_setter_report),
    "inbound_report_fixed": _on_silver(lambda s: reports.inbound_setter_report(s, corrected=True)),
    "outbound_report": _on_silver(
        lambda s: _money(reports.outbound_setter_report(s), "total_revenue")
    ),
    "outbound_report_fixed": _on_silver(
        lambda s: _money(reports.outbound_setter_report(s, corrected=True), "total_revenue")
    ),
    "closer_report": _on_silver(lambda s: _money(reports.closer_report(s), "cash_collected")),
    "closer_report_fixed": _on_silver(
        lambda s: _money(reports.closer_report(s, corrected=True), "cash_collected")
    ),
    "objections_report": _on_silver(reports.objections_faced_report),
    "objections_report_fixed": _on_silver(reports.corrected_objections_report),
    "inbound_kpis": _on_silver(
        lambda s: metrics.inbound_headline(reports.inbound_setter_report(s))
    ),
    "outbound_kpis": _on_silver(
        lambda s: _money(
            metrics.outbound_headline(reports.outbound_setter_report(s)), "total_revenue"
        )
    ),
    "closer_kpis": _on_silver(
        lambda s: _money(
            metrics.closer_headline(reports.closer_report(s)), "total_cash_collected"
        )
    ),
    "inbound_trend": _on_silver(lambda s: metrics.inbound_trend(reports.inbound_setter_report(s))),
    "outbound_trend": _on_silver(
        lambda s: metrics.outbound_trend(reports.outbound_setter_report(s))
    ),
    "cancel_breakdown": _on_silver(
        lambda s: metrics.cancellation_breakdown(reports.closer_report(s))
    ),
    "objection_totals": _on_silver(
        lambda s: metrics.objection_totals(reports.objections_faced_report(s))
    ),
    "activity_catalog": _raw(c.CUSTOM_ACTIVITIES, profiling.activity_catalog),
    "outcome_scan": _raw(c.LEAD_ACTIVITIES, profiling.outcome_values),
    "outcome_highlights": _raw(
        c.LEAD_ACTIVITIES, lambda raw: profiling.outcome_highlights(profiling.outcome_values(raw))
    ),
    "email_domains": _raw(
        c.CRM_USERS, lambda raw: profiling.email_domains(profiling.source_users(raw))
    ),
    "role_histogram": _raw(
        c.CRM_USERS, lambda raw: profiling.role_histogram(profiling.source_users(raw))
    ),
}
