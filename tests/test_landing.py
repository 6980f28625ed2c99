import os
from datetime import datetime, timedelta
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from funnelspark.config import CRM_USERS
from funnelspark.functions.values import wall_clock, week_of
from funnelspark.sources import landing
from funnelspark.sources.storage import new_folder, shared_folder
from funnelspark.streaming.ingest import load_bronze_tables, read_bronze, read_ledger

RUN = datetime(2024, 3, 1, 13)


def source(spark, days, rows=10):
    """``rows`` raw rows a day; every fifth holds a long text."""
    return spark.range(days * rows).selectExpr(
        "concat('{\"id\": ', id, ', \"text\": \"', repeat('é', IF(id % 5 = 0, 300, 3)), '\"}') AS raw_data",
        f"timestampadd(DAY, CAST(floor(id / {rows}) AS INT), timestamp_ntz'2024-01-01 13:00:00') AS insert_date",
    )


def test_shared_folder_follows_the_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert base is None or folder.startswith(base)
    assert spark.sparkContext.applicationId in folder


def test_only_a_local_session_may_use_a_temporary_folder():
    def session(master, setting):
        conf = SimpleNamespace(get=lambda name, default: setting)
        context = SimpleNamespace(master=master, applicationId="app-1")
        return SimpleNamespace(conf=conf, sparkContext=context)

    assert shared_folder(session("yarn", "/shared/")) == "/shared/funnelspark-app-1"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn", None))
    assert shared_folder(session("local[2]", None)) == shared_folder(session("local[2]", None))


def test_envelope_lines(spark):
    rows = spark.sql(
        """SELECT '{"a":\n1}' AS raw_data, timestamp_ntz'2024-01-01 10:00:00' AS insert_date
           UNION ALL SELECT NULL, timestamp_ntz'2024-01-01 10:00:00.000123'"""
    )
    assert [row.line for row in landing.envelope(rows).collect()] == [
        '{"payload": {"a": 1}, "insert_date": "2024-01-01 10:00:00"}',
        '{"payload": null, "insert_date": "2024-01-01 10:00:00.000123"}',
    ]


def test_wall_clock_ignores_the_session_time_zone(spark):
    """02:30 did not exist in New York on this day; it still is a wall clock time."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = spark.sql("SELECT '{}' AS raw_data, timestamp_ntz'2024-03-10 02:30:00.25' AS insert_date")
        line = landing.envelope(rows).select(
            "line", week_of(F.col("insert_date")).alias("week"),
            wall_clock(F.lit("2024-03-10T02:30:00Z")).cast("string").alias("clock"),
        )
        row = line.first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.line.endswith('"2024-03-10 02:30:00.250000"}')
    assert (str(row.week), row.clock) == ("2024-03-04", "2024-03-10 02:30:00")


@pytest.mark.parametrize("groups", [1, 4])
def test_batches_stay_near_the_limit(spark, groups):
    limit = 1000
    lines = landing.envelope(source(spark, 20)).withColumn("n", F.octet_length("line"))
    batched = landing.size_batches(lines, limit, ["insert_date"], groups)
    rows = batched.collect()
    assert len(rows) == 200
    batches = {}
    for row in rows:
        batches.setdefault(row.batch, []).append(row)
    for batch in batches.values():
        assert sum(r.n for r in batch) < limit + max(r.n for r in batch)
        assert sum(r.opens_batch for r in batch) == 1
    assert len(batches) > groups


def test_copies_of_one_line_are_dealt_evenly(spark):
    """Half of the rows are the same line; no group gets more than its share."""
    rows = spark.range(4000).selectExpr(
        "IF(id % 2 = 0, '{}', concat('{\"id\": ', id, '}')) AS raw_data",
        "timestamp_ntz'2024-01-01' AS insert_date",
    )
    batched = landing.size_batches(landing.envelope(rows), 10**9, ["insert_date"], 4)
    sizes = [row["count"] for row in batched.groupBy("batch").count().collect()]
    assert sum(sizes) == 4000 and len(sizes) == 4 and max(sizes) < 1100


def test_extraction_moves_forward(spark):
    root = new_folder(spark, "test")
    state, folder = f"{root}/state", f"{root}/landing"
    assert landing.read_checkpoint(spark, state, "t") == datetime(1970, 1, 1)
    first = landing.extract_table(spark, source(spark, 2), "t", folder, state, RUN, max_bytes=1000)
    assert (first.rows_extracted, first.checkpoint_advanced) == (20, True)
    assert first.batches > 1
    assert first.new_checkpoint == datetime(2024, 1, 2, 13)
    assert landing.read_checkpoint(spark, state, "other") == datetime(1970, 1, 1)
    again = landing.extract_table(spark, source(spark, 2), "t", folder, state, RUN + timedelta(hours=1))
    assert (again.rows_extracted, again.checkpoint_advanced) == (0, False)
    assert again.new_checkpoint == first.new_checkpoint
    # A later run on the same day lands beside the first one.
    third = landing.extract_table(spark, source(spark, 3), "t", folder, state, RUN + timedelta(hours=2))
    assert third.rows_extracted == 10
    assert spark.read.text(f"{folder}/t").count() == 30
    summary = landing.run_summary(spark, [first, again, third]).collect()
    assert [row.rows_extracted for row in summary] == [20, 0, 10]
    assert summary[0].first_key < summary[0].last_key and summary[1].first_key is None


def test_tasks_roll_their_files(spark):
    """Files stay near the limit, the lists name all of them, and no row is shuffled."""
    root, limit = new_folder(spark, "test"), 1000
    lines = landing.envelope(source(spark, 20)).repartition(3)
    files = landing.roll_landing(lines, f"{root}/landing", "t", RUN, limit).collect()
    folder = Path(landing.run_folder(f"{root}/landing", "t", RUN))
    assert sorted(p.name for p in folder.iterdir()) == sorted(f.key for f in files)
    longest = max(len(r.line.encode()) for r in lines.collect())
    for file in files:
        text = (folder / file.key).read_bytes()
        assert text.count(b"\n") == file.rows and len(text) == file.bytes + file.rows
        assert file.bytes < limit + longest
    # All but the last file of a task have reached the limit.
    assert sum(f.bytes < limit for f in files) <= 3 < len(files)
    back = spark.read.text(str(folder)).withColumnRenamed("value", "line")
    assert back.exceptAll(lines.select("line")).count() == 0 == lines.select("line").exceptAll(back).count()
    # Repeating the run with fewer rows leaves nothing of it.
    landing.roll_landing(lines.limit(5), f"{root}/landing", "t", RUN, limit)
    assert spark.read.text(str(folder)).count() == 5


def test_a_line_beyond_the_limit_and_no_lines(spark):
    root = new_folder(spark, "test")
    lines = spark.createDataFrame([("x" * 3_000_000,), ("é",), ("",)], "line string").coalesce(1)
    files = landing.roll_landing(lines, f"{root}/landing", "t", RUN, 1_000_000).orderBy("key").collect()
    assert [(f.rows, f.bytes) for f in files] == [(1, 3_000_000), (2, 2)]
    assert landing.roll_landing(lines.limit(0), f"{root}/landing", "none", RUN).count() == 0


def test_a_lost_task_leaves_no_files_to_readers(spark):
    root = new_folder(spark, "test")

    def broken(batches):
        for batch in batches:
            yield batch
            raise OSError("lost")

    lines = landing.envelope(source(spark, 5)).select("line").coalesce(1).mapInArrow(broken, "line string")
    with pytest.raises(Exception, match="lost"):
        landing.roll_landing(lines, f"{root}/landing", "t", RUN, 100)
    assert spark.read.text(landing.run_folder(f"{root}/landing", "t", RUN)).count() == 0


def test_failed_write_keeps_the_checkpoint(spark, monkeypatch):
    state = f"{new_folder(spark, 'test')}/state"

    def fail(*args):
        raise OSError("no space left")

    monkeypatch.setattr(landing, "roll_landing", fail)
    with pytest.raises(OSError):
        landing.extract_table(spark, source(spark, 1), "t", "unused", state, RUN)
    assert landing.read_checkpoint(spark, state, "t") == datetime(1970, 1, 1)


def test_latest_raw_puts_rows_without_date_first(spark):
    rows = spark.createDataFrame(
        [('{"INSERT_DATE":"2024-01-01"}',), ('{"INSERT_DATE":"2024-01-02"}',), ('{"data":[]}',)],
        "raw_data string",
    )
    found = [row.raw_data for row in landing.latest_raw(rows, 2).collect()]
    assert found == ['{"data":[]}', '{"INSERT_DATE":"2024-01-02"}']


def test_files_load_once_and_bad_lines_count(spark):
    root = new_folder(spark, "test")
    folder = f"{root}/landing/{CRM_USERS}/dt=2024-03-01/run=1/batch=0"
    good = '{"payload": {"data": [1]}, "insert_date": "2024-01-01 13:00:00"}'
    lines = [
        good,
        '{"payload": {"data": [1]}, "insert_date": "2024-01-01 13:00:00.5"}',
        '{"payload": {"data": [1',
        '{"payload": {"data": [1]}, "insert_date": "yesterday"}',
        '{"wrapped": "by nobody"}',
    ]

    def write(batch, content):
        path = folder.replace("batch=0", f"batch={batch}")
        spark.createDataFrame([(x,) for x in content], "line string").coalesce(1).write.text(path)

    def load():
        load_bronze_tables(
            spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint", [CRM_USERS], RUN
        )
        return read_bronze(spark, f"{root}/bronze", CRM_USERS)

    write(0, lines)
    rows = load()
    assert rows.count() == 3
    # A line without the wrapper loads with nothing in it, as its file is valid JSON.
    assert rows.where("payload IS NULL").count() == 1
    assert load().count() == 3
    write(1, [good])
    assert load().count() == 4
    ledger = read_ledger(spark, f"{root}/bronze").orderBy(F.col("row_parsed").desc()).collect()
    assert [(r.row_parsed, r.row_count, r.error_count) for r in ledger] == [(5, 3, 2), (1, 1, 0)]
    # A file that arrives with an old modification time is loaded too.
    write(2, [good, good])
    for part in Path(folder.replace("batch=0", "batch=2")).glob("part-*"):
        os.utime(part, (1_500_000_000, 1_500_000_000))
    assert load().count() == 6


def test_jdbc_reader_needs_a_driver(spark):
    with pytest.raises(Exception, match="(?i)driver|jdbc"):
        landing.read_jdbc_table(spark, "jdbc:nowhere:x", "t", datetime(2024, 1, 1), slices=2)


def skewed(spark):
    """Rows of one hour hold a third of all, those of one snapshot another third."""
    return spark.range(30_000).selectExpr(
        "concat('{\"id\": ', id, '}') AS raw_data",
        """CASE id % 3 WHEN 0 THEN timestamp_ntz'2024-02-01 13:00:00'
        WHEN 1 THEN timestampadd(SECOND, CAST(id % 3600 AS INT), timestamp_ntz'2024-03-01 00:00:00')
        ELSE timestampadd(MINUTE, CAST(id AS INT), timestamp_ntz'2024-01-01 00:00:00') END AS insert_date""",
    )


def test_slices_of_a_skewed_source_are_even(spark):
    rows = skewed(spark).cache()
    low, high = datetime(1970, 1, 1), rows.agg(F.max("insert_date")).first()[0]
    sample = landing.sampled_times(rows.select("insert_date"), 5000)
    slices = landing.time_slices(sample, low, high, 16)
    number = "abs(cast(hash({}) AS bigint))"
    sizes = [rows.where(s.predicate(number)).count() for s in slices]
    assert sum(sizes) == 30_000 and max(sizes) <= 2 * 30_000 / 16
    every = " + ".join(f"int({s.predicate(number)})" for s in slices)
    assert rows.where(f"{every} <> 1").count() == 0
    rows.unpersist()


def test_slices_of_few_or_no_times():
    low, high = datetime(2024, 1, 1), datetime(2024, 1, 3)
    assert landing.time_slices([], low, high, 4) == [landing.Slice(low, high)]
    assert landing.time_slices([high] * 8, low, high, 4) == [landing.Slice(low, high, i, 4) for i in range(4)]


def test_jdbc_tables_are_read_slice_by_slice(spark, monkeypatch):
    """With a reader that answers the three queries from a frame."""
    rows = skewed(spark)
    asked = []

    class Reader:
        def jdbc(self, url, table, predicates=None, properties=None):
            asked.append((table, predicates))
            if "max(" in table:
                return rows.agg(F.max("insert_date").alias("m"))
            return rows.where(" OR ".join(f"({p})" for p in predicates)) if predicates else rows.select("insert_date")

    session = SimpleNamespace(read=Reader())
    low = datetime(2024, 1, 10)
    found = landing.read_jdbc_table(session, "url", "t", low, slices=8, hash_sql="abs(cast(hash({}) AS bigint))")
    assert found.exceptAll(rows.where(F.col("insert_date") > F.lit(low).cast("timestamp_ntz"))).count() == 0
    assert found.count() == rows.where(F.col("insert_date") > F.lit(low).cast("timestamp_ntz")).count()
    assert "TABLESAMPLE" in asked[1][0] and len(asked[2][1]) >= 8


def test_bronze_that_was_never_loaded_is_an_error(spark):
    with pytest.raises(AnalysisException):
        read_bronze(spark, new_folder(spark, "nothing"), CRM_USERS)
