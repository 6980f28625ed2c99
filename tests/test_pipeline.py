"""Stages in order, run twice, and the shape of the plans."""

from datetime import datetime, timedelta

import pytest
from conftest import SMALLEST
from pyspark.sql import functions as F

from funnelspark import config as c
from funnelspark.plans import gold, pipeline, profiling, quality, reports
from funnelspark.plans import silver as silver_plan
from funnelspark.sources import crm, generations
from funnelspark.sources.storage import new_folder
from funnelspark.streaming.ingest import read_bronze

FIRST = datetime(2024, 3, 1, 13)


class Sliced(pipeline.Folders):
    """The bronze of one folder with silver and checkpoints in another."""

    def __init__(self, root, other):
        super().__init__(root)
        object.__setattr__(self, "other", other)

    @property
    def silver(self):
        return f"{self.other}/silver"

    @property
    def checkpoints(self):
        return f"{self.other}/checkpoints"


@pytest.fixture(scope="module")
def daily(spark):
    """Two daily runs: first without the last snapshots, then with everything."""
    folders = pipeline.Folders(new_folder(spark, "daily"))
    raw = crm.raw_tables(spark, SMALLEST)
    early = {
        table: rows.where(F.col("insert_date") < F.lit("2024-01-12").cast("timestamp_ntz"))
        for table, rows in raw.items()
    }
    rates = [pipeline.run_daily(spark, early, folders, FIRST).first()]
    rates.append(pipeline.run_daily(spark, raw, folders, FIRST + timedelta(days=1)).first())
    return folders, rates


TABLES = {
    "fields": ["field_id", "custom_activity_type_id"],
    "users": ["user_id"],
    "activities": ["lead_id", "activity_id"],
}


def assert_equal_rows(found, expected):
    """All columns of all rows; a variant is compared by its text."""
    for name, key in TABLES.items():
        texts = [getattr(t, name) for t in (found, expected)]
        if name == "activities":
            columns = {"full_record": F.to_json("full_record"), "custom_fields": F.to_json("custom_fields")}
            texts = [t.withColumns(columns) for t in texts]
        a, b = texts
        assert a.columns == b.columns
        assert a.count() == b.count() == a.select(*key).distinct().count()
        assert a.exceptAll(b).count() == 0


def test_two_days_equal_one_build(spark, silver, daily):
    folders, rates = daily
    assert_equal_rows(pipeline.read_silver(spark, folders.silver), silver)
    assert [(r.error_rate, r.breached) for r in rates] == [(0.0, False)] * 2


def test_snapshots_may_arrive_in_any_order(spark, silver):
    """Newest first, with repeats, gives the same rows as all at once."""
    bronze = crm.bronze_tables(spark, SMALLEST)
    root = new_folder(spark, "backwards")
    limit = F.lit("2024-01-12").cast("timestamp_ntz")
    late, early = F.col("insert_date") >= limit, F.col("insert_date") < limit
    for part in (late, early, late):
        pipeline.build_silver(spark, {t: rows.where(part) for t, rows in bronze.items()}, root, FIRST, 3)
    assert_equal_rows(pipeline.read_silver(spark, root), silver)


def test_a_few_files_at_a_time(spark, silver, daily):
    """Micro-batches of some files give the same rows as one batch."""
    folders, _ = daily
    slices = Sliced(folders.root, new_folder(spark, "slices"))
    pipeline.update_silver(spark, slices, FIRST, 3, max_files=9)
    assert_equal_rows(pipeline.read_silver(spark, slices.silver), silver)


def test_views_follow_later_loads(spark):
    """A view published first reads the rows, types and users of the loads that follow."""
    folders = pipeline.Folders(new_folder(spark, "live"))
    raw = crm.raw_tables(spark, SMALLEST)
    early = F.col("insert_date") < F.lit("2024-01-11").cast("timestamp_ntz")
    sources = {t: rows.where(early) for t, rows in raw.items()}
    # The first load knows no types, so the views are empty.
    sources[c.CUSTOM_ACTIVITIES] = sources[c.CUSTOM_ACTIVITIES].limit(0)
    pipeline.run_daily(spark, sources, folders, FIRST)
    names = ["closer_report", "inbound_setter_report", "sales_details", "dim_users", "objections_faced_report"]
    views = {name: spark.table(name) for name in names}
    assert views["closer_report"].count() == 0
    pipeline.extract(spark, raw, folders, FIRST + timedelta(days=1))
    pipeline.load_bronze(spark, folders, FIRST + timedelta(days=1))
    built = pipeline.update_silver(spark, folders, FIRST + timedelta(days=1))
    for name in names:
        expected = {**gold.VIEWS, **reports.REPORTS}[name](built)
        found = spark.sql(f"SELECT * FROM {name}")
        assert found.count() == expected.count() > 0
        if name != "closer_report":  # sums of doubles depend on their order
            assert found.exceptAll(expected).count() == 0


def test_bronze_holds_every_raw_row_with_content(spark, daily):
    folders, _ = daily
    for table, rows in crm.raw_tables(spark, SMALLEST).items():
        bronze = read_bronze(spark, folders.bronze, table)
        assert bronze.count() == rows.count()
        assert bronze.where("payload IS NULL").count() == 0


def test_views_answer_sql(spark, daily):
    total = spark.sql("SELECT sum(call_booked) AS n FROM closer_report").first().n
    assert total == spark.sql("SELECT count(*) AS n FROM all_strategies_details").first().n
    report = pipeline.load_view(spark, "inbound_setter_report")
    assert report.is_cached and report.count() > 0
    assert pipeline.load_view(spark, "inbound_setter_report") is report
    again = pipeline.load_view(spark, "inbound_setter_report", max_age=0)
    assert again is not report and again.count() == report.count()
    again.unpersist()


def test_run_without_any_rows(spark):
    folders = pipeline.Folders(new_folder(spark, "empty"))
    raw = {table: rows.limit(0) for table, rows in crm.raw_tables(spark, SMALLEST).items()}
    rate = pipeline.run_daily(spark, raw, folders, FIRST).first()
    assert (rate.error_rate, rate.breached) == (0.0, False)
    assert spark.table("closer_report").count() == 0


def test_silver_again_changes_nothing(spark, daily):
    folders, _ = daily
    bronze = {t: read_bronze(spark, folders.bronze, t) for t in c.SOURCE_TABLES}

    def state():
        path = folders.silver
        return (
            spark.read.parquet(f"{path}/parse_failures").count(),
            generations.newest(spark, f"{path}/users").version,
            generations.newest(spark, f"{path}/lead_activities").version,
            generations.newest(spark, f"{path}/custom_activity_fields").version,
        )

    before = state()
    pipeline.build_silver(spark, bronze, folders.silver, FIRST + timedelta(days=9))
    assert state() == before
    details = spark.read.parquet(f"{folders.silver}/parse_failures").select("error_detail").distinct()
    assert {row.error_detail for row in details.collect()} == {
        "no JSON document after repair",
        pipeline.MISSING_KEY,
    }


def test_export(spark, silver):
    path = new_folder(spark, "export")
    report = reports.closer_report(silver)
    pipeline.export_csv(report, path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == report.columns
    assert back.count() == report.count()


def test_nested_custom_object_does_not_count(spark, bronze_rows):
    rows = bronze_rows(
        [
            (
                '{"data":[{"id":"a","lead_id":"l","_type":"CustomActivity",'
                '"custom":{"cf_x":"nested"},"custom.cf_x":["M","it\'s"],"custom.cf_n":5.50,'
                '"custom.cf_null":null}]}',
                "2024-01-01 00:00:00",
            )
        ]
    )
    record = silver_plan.latest_activities(rows).first()
    assert record.custom_fields == {
        "custom.cf_x": '["M","it\'s"]',
        "custom.cf_n": "5.5",
        "custom.cf_null": None,
    }


def test_equal_times_keep_the_newest_snapshot(spark, bronze_rows):
    payload = '{"data":[{"id":"a","lead_id":"l","activity_at":"2024-01-01T00:00:00Z","v":"%s"}]}'
    rows = bronze_rows([(payload % v, f"2024-01-0{i} 00:00:00") for i, v in enumerate("abc", 1)])
    row = silver_plan.latest_activities(rows).select(F.to_json("full_record").alias("r")).first()
    assert '"v":"c"' in row.r


def test_key_order_does_not_change_the_hash(spark, bronze_rows):
    rows = bronze_rows(
        [
            ('{"data":[{"id":"a","lead_id":"l"}]}', "2024-01-01 00:00:00"),
            ('{"data":[{"lead_id":"l","id":"a"}]}', "2024-01-02 00:00:00"),
        ]
    )
    assert silver_plan.activity_versions(rows).select("md5_hash").distinct().count() == 1


def test_documents_without_data_are_counted(spark, bronze_rows):
    rows = bronze_rows([('{"data":[]}', "2024-01-01 00:00:00"), ('{"x":1}', "2024-01-01 00:00:00")])
    parsed = rows.withColumnRenamed("payload", "parsed")
    assert quality.parsed_without_data(parsed).first().rows_without_data == 1


def test_profiling_takes_the_newest_rows(spark):
    raw = crm.crm_users(spark, SMALLEST)
    newest = profiling.source_users(raw, limit=20)
    assert 0 < newest.count() < profiling.source_users(raw).count()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(silver):
    fact = plan_of(gold.fact_lead_funnel(silver))
    assert fact.count("Exchange") == fact.count("BroadcastExchange") == 1
    assert "full_record" not in fact
    assert "EqualTo(record_type,CustomActivity)" in fact
    calls = plan_of(gold.all_strategies_details(silver))
    # Shuffled is only the dictionary; activities stay where they are.
    assert calls.count("Exchange hashpartitioning") == 1
    assert "In(type_id" in calls
    for view in [*gold.VIEWS.values(), *reports.REPORTS.values()]:
        plan = plan_of(view(silver))
        assert "Python" not in plan and "CartesianProduct" not in plan
    assert plan_of(gold.latest_sales(silver)).count("WindowGroupLimit") == 2
