"""Generations, the key index, and histories that do not depend on the order of arrival."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from funnelspark.operators import key_index
from funnelspark.operators.history import HistoryRule, fold_versions
from funnelspark.operators.latest import latest_per_key
from funnelspark.operators.upsert import UpsertRule, read_table, upsert_table
from funnelspark.sources import generations
from funnelspark.sources.generations import Change
from funnelspark.sources.storage import new_folder

RULE = UpsertRule(keys=("a",), updated=("v",))
UPSERTED = "a string, v string, md5_hash string"
HISTORY = HistoryRule(keys=("a",), first_seen=("at",))
VERSIONS = "a string, v string, at int, insert_date int"
ROWS = "a string, v string, md5_hash string, at int, insert_date int, update_date int"


def upsert(spark, path, pairs, stamp):
    rows = [(a, v, f"hash of {v}") for a, v in pairs]
    return upsert_table(path, spark.createDataFrame(rows, UPSERTED), RULE, F.lit(stamp), buckets=4)


def content(spark, path, schema):
    return sorted(tuple(row) for row in read_table(spark, path, schema).collect())


def fold(spark, path, versions, buckets=3):
    rows = spark.createDataFrame(versions, VERSIONS).withColumn("md5_hash", F.concat(F.lit("h"), "v"))
    rows = rows.withColumn("version", F.struct("insert_date", F.col("md5_hash").alias("hash")))
    latest = latest_per_key(rows, ["a"], [F.col("version").desc()]).select("a", "v", "md5_hash", "version")
    fold_versions(path, rows.drop("v"), latest, HISTORY, buckets)


def rows_by_hand(versions):
    """The row of each key from all of its versions at once."""
    out = []
    by_key = {}
    for a, v, at, moment in versions:
        if a is not None:
            by_key.setdefault(a, []).append((moment, f"h{v}", v, at))
    for a, seen in by_key.items():
        newest = max(seen)
        first = min(seen)
        since = min(moment for moment, h, *_ in seen if h == newest[1])
        out.append((a, newest[2], newest[1], first[3], first[0], since))
    return sorted(out)


def test_any_order_gives_equal_rows(spark):
    """Backwards, shuffled, in one batch, with repeats and after an empty batch."""
    draw = random.Random(2)
    # The first-seen column goes with the content, as in a record.
    versions = [
        (f"k{draw.randrange(12)}", v := draw.choice("ABC"), ord(v), day) for day in range(3) for _ in range(14)
    ] + [(None, "X", 1, 1)]
    versions = list(dict.fromkeys(versions))
    days = [[r for r in versions if r[3] == day] for day in range(3)]
    orders = [days[::-1], [versions], [[], days[1], versions, days[0]]]
    for batches in orders:
        path = new_folder(spark, "history")
        for batch in batches:
            fold(spark, path, batch)
        assert content(spark, path, ROWS) == rows_by_hand(versions)


def test_known_content_rewrites_narrow_parts_only(spark):
    path = new_folder(spark, "history")
    fold(spark, path, [(f"k{i}", "A", 65, 1) for i in range(30)])
    first = generations.newest(spark, path)
    fold(spark, path, [("k7", "A", 65, 5)])
    second = generations.newest(spark, path)
    assert second.pieces["rows"] == first.pieces["rows"] and second.pieces["bitmap"] == first.pieces["bitmap"]
    assert len(set(second.pieces["keys"].items()) - set(first.pieces["keys"].items())) == 1
    fold(spark, path, [("k7", "A", 65, 5)])
    assert generations.newest(spark, path) == second  # nothing new, no version
    fold(spark, path, [("k7", "B", 66, 3)])  # late, and older than the last time of A
    assert ("k7", "A", "hA", 65, 1, 1) in content(spark, path, ROWS)


@pytest.mark.parametrize("lost", ["rows", "keys", "bitmap", "commit"])
def test_a_lost_run_loses_nothing(spark, monkeypatch, lost):
    """A run that ends before its manifest leaves all rows; repeating it gives what it would have."""
    path, calm = new_folder(spark, "lost"), new_folder(spark, "calm")
    first = [(f"k{i}", "old") for i in range(20)]
    second = [(f"k{i}", "new" if i % 3 else "old") for i in range(25)]
    for target in (path, calm):
        schema = upsert(spark, target, first, "1")
    before = content(spark, path, schema)
    replace, commit = Change.replace, Change.commit

    def failing_replace(self, part, *args, **options):
        replace(self, part, *args, **options)
        if part == lost:
            raise KeyboardInterrupt

    def failing_commit(self):
        raise KeyboardInterrupt

    monkeypatch.setattr(Change, "replace", failing_replace)
    if lost == "commit":
        monkeypatch.setattr(Change, "commit", failing_commit)
    with pytest.raises(KeyboardInterrupt):
        upsert(spark, path, second, "2")
    monkeypatch.setattr(Change, "replace", replace)
    monkeypatch.setattr(Change, "commit", commit)
    assert content(spark, path, schema) == before
    upsert(spark, path, second, "2")
    upsert(spark, calm, second, "2")
    assert content(spark, path, schema) == content(spark, calm, schema) != before


def test_the_second_of_two_runs_is_told(spark):
    path = new_folder(spark, "race")
    schema = upsert(spark, path, [("k", "old")], "1")
    before = generations.newest(spark, path)
    rows = generations.read(spark, path, "rows", schema, before)
    runs = [Change(spark, path, before, before.buckets) for _ in range(2)]
    for run in runs:
        run.replace("rows", rows.withColumn("v", F.lit(run.run)))
    runs.sort(key=lambda run: run.run)
    runs[0].commit()
    with pytest.raises(generations.ConcurrentRun):
        runs[1].commit()
    assert content(spark, path, schema)[0][1] == runs[0].run


def test_vacuum_keeps_the_newest_versions(spark):
    path = new_folder(spark, "vacuum")
    for run in range(5):
        schema = upsert(spark, path, [(f"k{i}", f"{run if i == run else 'same'}") for i in range(12)], str(run))
    before = content(spark, path, schema)
    assert generations.vacuum(spark, path, keep=1) > 0
    assert content(spark, path, schema) == before
    assert generations.vacuum(spark, path, keep=1) == 0
    upsert(spark, path, [("k9", "later")], "9")
    assert ("k9", "later", "hash of later", "9") in content(spark, path, schema)


def test_keys_are_found_without_shuffling_the_stored_ones(spark):
    path = new_folder(spark, "index")
    keys = [(f"k{i}", "v") for i in range(5000)]
    upsert(spark, path, keys, "1")
    at = generations.newest(spark, path)
    wanted = [("k1",), ("k77",), *((f"new{i}",) for i in range(2000))]
    batch = spark.createDataFrame(wanted, "a string").withColumn("bucket", key_index.bucket_of(["a"], 4))
    possible = {row.a for row in key_index.possibly_stored(batch, path, at, ["a"]).collect()}
    assert {"k1", "k77"} <= possible and len(possible) < 2 + 2000 * 2 / key_index.BITS_PER_KEY
    found = key_index.stored_keys(batch, path, at, ["a"], "a string, md5_hash string")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange") == plan.count("BroadcastExchange") == 1
    assert {row.a for row in found.collect()} == {"k1", "k77"}


def test_buckets_without_possible_keys_are_not_read(spark):
    path = new_folder(spark, "index")
    upsert(spark, path, [(f"k{i}", "v") for i in range(40)], "1")
    at = generations.newest(spark, path)
    batch = spark.createDataFrame([("k3",)], "a string").withColumn("bucket", key_index.bucket_of(["a"], 4))
    found = key_index.stored_keys(batch, path, at, ["a"], "a string, md5_hash string")
    assert len({file.split("/bucket=")[1][0] for file in found.inputFiles() if "/keys/" in file}) == 1


def test_live_reads_see_later_versions(spark):
    path = new_folder(spark, "live")
    schema = upsert(spark, path, [("k1", "old")], "1")
    generations.read_live(spark, path, "rows", schema).drop("bucket").createOrReplaceTempView("live_rows")
    for run, v in itertools.product(("2", "3"), ("b", "c")):
        upsert(spark, path, [("k1", v + run), ("k" + run, v)], run)
        spark.catalog.refreshTable("live_rows")
        found = sorted(tuple(r) for r in spark.table("live_rows").collect())
        assert found == content(spark, path, schema)
