"""Batches whose possible keys are too many to broadcast are folded in one shuffle, to the same table."""

import random
from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import SMALLEST
from pyspark.sql import functions as F
from test_history import HISTORY, ROWS, VERSIONS, content, fold, rows_by_hand

from funnelspark import queries
from funnelspark.config import LEAD_ACTIVITIES
from funnelspark.operators import history, key_index
from funnelspark.operators.history import fold_versions
from funnelspark.operators.latest import latest_per_key
from funnelspark.sources import generations
from funnelspark.sources.storage import new_folder

KEYS = (
    "a string, md5_hash string, at int, version struct<insert_date:int,hash:string>, first_time int, last_time int"
)


@pytest.fixture
def large(monkeypatch):
    monkeypatch.setattr(key_index, "BROADCAST_ROWS", -1)


def drawn(seed, keys=15):
    draw = random.Random(seed)
    days = [
        [(f"k{draw.randrange(keys)}", v := draw.choice("ABC"), ord(v), day) for _ in range(20)] for day in range(4)
    ]
    days[1] += [(None, "A", 65, 1), ("k1", "D", None, 1), ("k2", "C", 67, None)]
    draw.shuffle(days)
    return days


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_keys_and_changes_are_those_of_small_batches(spark, monkeypatch, seed):
    paths = {limit: new_folder(spark, "large") for limit in (1_000_000, -1)}
    for batch in [*drawn(seed), [], [("k1", "A", 65, 0)], [("new", "A", 65, 9)]]:
        found = []
        for limit, path in paths.items():
            monkeypatch.setattr(key_index, "BROADCAST_ROWS", limit)
            fold(spark, path, batch)
            at = generations.newest(spark, path)
            keys = generations.read(spark, path, "keys", KEYS, at).collect()
            changes = generations.read(spark, path, "changes", "a string", at).collect()
            found.append((at.version, Counter(keys), Counter(changes), content(spark, path, ROWS)))
        assert found[0] == found[1]


def test_any_order_gives_the_rows_of_one_build(spark, large):
    days = [[v for v in day if None not in v[1:]] for day in drawn(3)]
    for order in (days, days[::-1], [*days, *days]):
        path = new_folder(spark, "large")
        for day in order:
            fold(spark, path, day)
        assert content(spark, path, ROWS) == rows_by_hand([v for day in days for v in day])


def test_known_content_leaves_the_table(spark, large):
    path = new_folder(spark, "large")
    rows = [(f"k{i}", "A", 65, 1) for i in range(20)]
    fold(spark, path, rows)
    fold(spark, path, rows[:5])
    assert generations.newest(spark, path).version == 0
    # Seen again later: the narrow part of its bucket alone is written.
    before = generations.newest(spark, path)
    fold(spark, path, [("k3", "A", 65, 2)])
    after = generations.newest(spark, path)
    assert after.version == 1 and after.pieces["rows"] == before.pieces["rows"]
    assert sum(after.pieces["keys"][b] != before.pieces["keys"][b] for b in before.pieces["keys"]) == 1


def test_a_large_batch_writes_fewer_tables(spark, monkeypatch, large):
    """Neither stored keys nor merged intervals are written beside the table."""
    labels = []
    write = history.written
    monkeypatch.setattr(history, "written", lambda df, label: labels.append(label) or write(df, label))
    path = new_folder(spark, "large")
    fold(spark, path, [("k1", "A", 65, 1)])
    fold(spark, path, [("k1", "B", 66, 2), ("k2", "A", 65, 2)])
    assert labels == ["seen", "delta"]
    assert len(content(spark, path, ROWS)) == 2


def test_newest_rows_are_found_once(spark):
    """Stored rows get the batch's rows by one join; the newest of each key are ranked once."""
    path = new_folder(spark, "large")
    fold(spark, path, [("k1", "A", 65, 1)])
    plans = []
    replace = generations.Change.replace

    def watched(self, part, rows, *args, **options):
        if part == "rows":
            plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        replace(self, part, rows, *args, **options)

    rows = spark.createDataFrame([("k1", "B", 66, 2), ("k2", "A", 65, 2)], VERSIONS)
    rows = rows.withColumn("md5_hash", F.concat(F.lit("h"), "v"))
    rows = rows.withColumn("version", F.struct("insert_date", F.col("md5_hash").alias("hash")))
    latest = latest_per_key(rows, ["a"], [F.col("version").desc()]).select("a", "v", "md5_hash", "version")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(generations.Change, "replace", watched)
        fold_versions(path, rows.drop("v"), latest, HISTORY, 3)
    assert [plan.count(" Window [row_number") for plan in plans] == [1]


def test_streamed_payloads_are_stored_whole(spark, monkeypatch, tmp_path):
    """Batches read all of a payload, so none is taken apart into columns."""
    monkeypatch.setattr(queries, "new_folder", lambda spark, label: f"{tmp_path}/{label}")
    assert queries.activities_stream_upsert(spark, SMALLEST).count() > 0
    files = list(Path(tmp_path, "activities_stream/bronze", LEAD_ACTIVITIES).glob("*.parquet"))
    assert files and not any("typed_value" in str(pq.ParquetFile(f).schema) for f in files)
