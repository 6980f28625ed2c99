"""What loads keep on disk: compressed landing files, and events shuffled instead of their texts."""

from datetime import datetime
from pathlib import Path

import pytest
from conftest import SMALLEST
from pyspark.sql import functions as F

from funnelspark import queries
from funnelspark.config import LEAD_ACTIVITIES
from funnelspark.sources import crm, landing
from funnelspark.sources.storage import new_folder


def test_landed_batches_are_compressed(spark):
    root = new_folder(spark, "landed")
    rows = spark.range(3000).selectExpr("concat('{\"id\": ', id % 100, '}') AS line", "id % 3 AS batch")
    landing.write_landing(rows.repartition("batch"), root, "t", datetime(2024, 3, 1))
    folder = landing.run_folder(root, "t", datetime(2024, 3, 1))
    files = [f for f in Path(folder).glob("batch=*/*") if not f.name.startswith((".", "_"))]
    assert len(files) == 3 and sum(f.stat().st_size for f in files) < 3000 * 10 / 5
    assert spark.read.text(folder).select("value").exceptAll(rows.select("line")).isEmpty()


def test_loads_shuffle_events_and_not_their_texts(spark, monkeypatch):
    landed = {}
    write = landing.write_landing

    def watched(lines, folder, table, run_ts):
        landed.setdefault(table, []).append(lines._jdf.queryExecution().optimizedPlan().toString())
        write(lines, folder, table, run_ts)

    monkeypatch.setattr(landing, "write_landing", watched)
    monkeypatch.setattr(queries, "_loads", {})
    assert queries.load_ledger(spark, SMALLEST).count() == 3
    assert len(landed[LEAD_ACTIVITIES]) == 2
    for plan in landed[LEAD_ACTIVITIES]:
        above, _, below = plan.partition("RepartitionByExpression")
        assert "to_json" in above.lower() or "structstojson" in above.lower()
        assert "structstojson" not in below.lower() and "to_json" not in below.lower()


@pytest.mark.parametrize("ts", ["2024-01-11 23:59:59.5", None])
def test_gathered_activities_are_the_activities(spark, tmp_path, ts):
    events = spark.read.parquet(f"{SMALLEST}/events.parquet")
    odd = events.limit(3).withColumn("ts", F.lit(ts).cast(events.schema["ts"].dataType))
    events.unionByName(odd).unionByName(events.limit(5)).write.parquet(f"{tmp_path}/events.parquet")
    day = F.date_format("insert_date", "yyyyMMdd").cast("long")
    found = crm.lead_activities_by(spark, str(tmp_path), day)
    expected = crm.lead_activities(spark, str(tmp_path)).withColumn("batch", day)
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    # A batch is in one partition, and sorted there, so that writing need not sort texts.
    places = found.select("batch", F.spark_partition_id().alias("place")).distinct().collect()
    assert len({row.batch for row in places}) == len(places)
