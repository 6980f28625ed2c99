"""Input dealt evenly to tasks, read once, and batches that more than one task reads."""

from datetime import datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import SMALLEST
from pyspark.sql import functions as F

from funnelspark import queries
from funnelspark.operators.history import HistoryRule, fold_versions
from funnelspark.plans import pipeline, silver
from funnelspark.sources import crm
from funnelspark.sources.storage import new_folder, whole_variants, written

RUN = datetime(2024, 3, 1)


@pytest.fixture
def small_splits(spark):
    """Splits far smaller than a row group, as those of a large file on many cores."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, "1k")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_one_row_group_is_dealt_to_every_task(spark, tmp_path, monkeypatch, small_splits):
    """One row group is read by one task, though its file has more splits than there are cores."""
    monkeypatch.setattr(crm, "ROWS_PER_TASK", 100, raising=False)
    stored = spark.range(4000).select("id", F.md5(F.col("id").cast("string")).alias("text"))
    stored.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    rows = crm._read(spark, str(tmp_path), "events")
    assert sorted(r.id for r in rows.select("id").collect()) == list(range(4000))
    sizes = [row["count"] for row in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 40 and max(sizes) <= 150


#: The payload, and the failures it leaves.
PAYLOADS = [
    ('{"data": [{"id": "a", "lead_id": "l", "activity_at": "2024-01-01T00:00:00"}]}', []),
    ('{"data": [{"id": "b"}, {"id": "c", "lead_id": "l"}]}', [(pipeline.MISSING_KEY, '{"id":"b"}')]),
    ('{"data": [null]}', [(pipeline.MISSING_KEY, "null")]),
    ('{"data": []}', []),
    ('{"data": null}', []),
    ('{"data": 7}', []),
    ('{"data": {"x": {"id": "d", "lead_id": "l"}}}', []),
    ('{"other": 1}', [(pipeline.NO_DATA, '{"other":1}')]),
    ("[1]", [(pipeline.NO_DATA, "[1]")]),
    ("null", [(pipeline.NO_DATA, "null")]),
    (None, []),
]


def test_activities_are_read_once(spark):
    """Rows and both kinds of failures come from one pass over bronze."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    texts = spark.createDataFrame([(text,) for text, _ in PAYLOADS], "text string")
    bronze = texts.mapInArrow(counted, "text string").select(
        F.try_parse_json("text").alias("payload"), F.lit(RUN).cast("timestamp_ntz").alias("insert_date")
    )
    root = new_folder(spark, "once")
    pipeline.fold_activities(bronze, root, RUN, 2)
    assert seen.value == len(PAYLOADS)
    found = spark.read.parquet(f"{root}/parse_failures").select("error_detail", "raw_payload", "occurrences")
    expected = [(*failure, 1) for _, failures in PAYLOADS for failure in failures]
    assert sorted(tuple(row) for row in found.collect()) == sorted(expected)
    stored = pipeline.read_table(spark, f"{root}/lead_activities", silver.ACTIVITIES_SCHEMA)
    assert sorted(r.activity_id for r in stored.collect()) == ["a", "c", "d"]


def test_flattened_rows_are_the_versions(spark):
    bronze = spark.createDataFrame([(text,) for text, _ in PAYLOADS], "text string").select(
        F.try_parse_json("text").alias("payload"), F.lit(RUN).cast("timestamp_ntz").alias("insert_date")
    )
    columns = ["lead_id", "activity_id", "activity_at", "md5_hash", "insert_date"]
    flat = silver.flattened_activities(bronze).where("no_data IS NULL").select(*columns)
    versions = silver.activity_versions(bronze).select(*columns)
    assert sorted(flat.collect(), key=repr) == sorted(versions.collect(), key=repr)


#: Documents whose text a content hash is made of.
DOCUMENTS = [
    '{"b": "x", "a": 1, "custom.c": ["y", null, 2.50], "d": {"f": {}, "e": [true, 1e300]}}',
    '{"quote \\" and \\\\ key": "line\\nend \\u0001\\u2028 / é 😀", "": "", "n": null, "big": 123456789012345678901234567890}',
    '{"z": -0.0, "long": 9223372036854775807, "decimal": 0.10, "bool": false, "deep": [[{"k": "\\t"}]]}',
    "{}", "[]", '["a", {"b": null}]', '"text \\" quoted"', "7", "1.50", "true", "null", None,
]


def test_hashes_are_those_of_cast_records(spark):
    """Content hashes are made without a cast of whole objects, and are the same as ever."""
    stored = spark.createDataFrame([(text,) for text in DOCUMENTS], "text string")
    records = written(stored.select(F.try_parse_json("text").alias("record")), "records")
    record = F.col("record")
    pairs = records.select(
        silver.record_text(record).alias("text"), record.cast("string").alias("cast_text"),
        silver.content_hash(record).alias("hash"), F.md5(record.cast("string")).alias("cast_hash"),
    )
    found = pairs.collect()
    # A JSON null and a missing document have no text.
    assert sum(row.text is not None for row in found) == len(DOCUMENTS) - 2
    assert all(row.text == row.cast_text and row.hash == row.cast_hash for row in found), found


def test_stream_batches_have_many_tasks(spark, monkeypatch):
    """A batch of bronze files is read by more than one task."""
    tasks = []
    fold = pipeline.fold_activities

    def watched(batch, *args):
        tasks.append(batch.select(F.spark_partition_id()).distinct().count())
        fold(batch, *args)

    monkeypatch.setattr(pipeline, "fold_activities", watched)
    assert queries.activities_stream_upsert(spark, SMALLEST).count() > 0
    assert len(tasks) == 4 and min(tasks) > 1


@pytest.fixture
def uncoalesced(spark):
    """As many tasks as shuffle partitions, as in a large run."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def test_a_bucket_is_written_by_one_task(spark, uncoalesced):
    """A first fold, and one that changes and adds keys, write a file for each bucket they replace."""
    rule = HistoryRule(keys=("id",))
    root = new_folder(spark, "files")

    def fold(last, text):
        rows = spark.range(last).select(
            F.col("id").cast("string").alias("id"), F.lit(text).alias("text"), F.md5(F.lit(text)).alias("md5_hash"),
            F.struct(F.lit(text).alias("v")).alias("version"), F.lit(RUN).cast("timestamp_ntz").alias("insert_date"),
        )
        fold_versions(root, rows.drop("text"), rows.drop("insert_date"), rule, 8)

    def new_files(part, known):
        return {str(f) for f in Path(root, part).glob("generation=*/bucket=*/*.parquet") if "none" not in str(f)} - known

    fold(2000, "a")
    first = {part: new_files(part, set()) for part in ("keys", "bitmap", "rows")}
    assert {part: len(files) for part, files in first.items()} == {"keys": 8, "bitmap": 8, "rows": 8}
    fold(3000, "b")
    assert len(new_files("keys", first["keys"])) == 8
    assert len(new_files("bitmap", first["bitmap"])) == 8
    assert len(new_files("changes", set())) == 8
    stored = pipeline.read_table(spark, root, "id string, text string")
    assert stored.groupBy("text").count().collect() == [("b", 3000)]


def test_variants_are_stored_whole(spark):
    """No variant is taken apart into columns, and the session is left as it was."""
    name = "spark.sql.variant.inferShreddingSchema"
    before = spark.conf.get(name, None)
    rows = spark.range(10).select(F.try_parse_json(F.lit('{"a": "x", "b": 1}')).alias("record"))
    files = [f.removeprefix("file:") for f in written(rows, "variants").inputFiles()]
    assert files and not any("typed_value" in str(pq.ParquetFile(f).schema) for f in files)
    assert spark.conf.get(name, None) == before
    with pytest.raises(ZeroDivisionError), whole_variants(spark):
        1 / 0
    assert spark.conf.get(name, None) == before


def test_texts_are_made_before_the_snapshots(spark):
    """One text for each content of an event, whose making Spark compiles, below the snapshots."""
    rows = crm.lead_activities(spark, SMALLEST)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    above, _, below = plan.partition("Generate")
    assert "StructsToJson" not in above and "StructsToJson" in below and "lambda" not in plan
    parsed = F.try_parse_json("raw_data")
    date = F.try_variant_get(parsed, "$.INSERT_DATE", "timestamp_ntz")
    ids = F.try_variant_get(parsed, "$.data", "array<variant>")
    assert rows.where(~date.eqNullSafe(F.col("insert_date")) | ~F.size(ids).isin(1, 2)).isEmpty()


def test_a_build_does_not_store_its_source(spark, monkeypatch):
    """The build reads bronze once, so it is not written before."""
    monkeypatch.setattr(queries, "written", lambda rows, label: pytest.fail(f"{label} is written"))
    assert queries.new_silver(spark, SMALLEST).activities.count() > 0
