"""Newest content per key as streaming state."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from funnelspark.sources.storage import new_folder
from funnelspark.streaming.newest import append_changes, newest_rows

START = datetime(2024, 1, 1)


def test_late_repeated_and_unchanged_snapshots(spark):
    """One change is logged per content that wins; the newest rows are those of all snapshots."""
    folder = new_folder(spark, "state")
    batches = [
        [("a", "A", 3), ("a", "X", 1), ("b", "B", 3), (None, "N", 1), ("c", "C", None)],
        [("a", "A", 3), ("a", "B", 2), ("b", "B", 5), ("c", "D", 9)],  # repeated, late, unchanged
        [("b", "Z", 4), ("a", "C", 6), ("a", "D", 5), ("d", "E", 1)],  # older than the time b was seen again
        [],
    ]
    keys = ["k"]

    def versions(rows):
        text = [F.try_variant_get("payload", f"$.{name}", "string").alias(name) for name in ("k", "v")]
        return rows.select(*text, "insert_date").withColumn("md5_hash", F.md5("v"))

    for number, batch in enumerate(batches):
        rows = [(k, v, None if day is None else START + timedelta(days=day)) for k, v, day in batch]
        frame = spark.createDataFrame(rows, "k string, v string, insert_date timestamp_ntz")
        payload = F.parse_json(F.to_json(F.struct("k", "v"))).alias("payload")
        error = F.lit(None).cast("string").alias("error")
        stored = frame.select(payload, "insert_date", error).coalesce(1)
        stored.write.mode("append").parquet(f"{folder}/bronze")
        append_changes(spark, f"{folder}/bronze", f"{folder}/checkpoint", f"{folder}/log", versions, keys, 1)
        if number == 0:
            assert spark.read.parquet(f"{folder}/log").count() == 3
    log = spark.read.parquet(f"{folder}/log")
    assert sorted((r.k, r.v) for r in log.collect()) == [("a", "A"), ("a", "C"), ("b", "B"), ("c", "C"), ("d", "E")]
    found = newest_rows(spark, f"{folder}/log", keys)
    assert sorted((r.k, r.v) for r in found.collect()) == [("a", "C"), ("b", "B"), ("c", "C"), ("d", "E")]
