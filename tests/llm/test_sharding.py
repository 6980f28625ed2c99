"""Sharding against one pass over the records in order."""

import random
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from funnelspark.llm import sharding


@pytest.mark.parametrize("total", [1, 9, 24, 30 * 10**9, 10**14 + 7, 10**15, 10**17])
def test_shard_numbers_are_whole_divisions(spark, total):
    """Also for a last record that is small beside the total, whose middle is just below its end."""
    middles = sorted({0, total, 2 * total - 1, max(0, 2 * total - 500), *(2 * total * k // 24 for k in range(24))})
    rows = spark.createDataFrame([(m,) for m in middles], "middle long")
    found = rows.select("middle", sharding.shard_of(F.col("middle"), total, 24).alias("shard")).collect()
    assert [(r.middle, r.shard) for r in found] == [(m, m * 24 // (2 * total)) for m in middles]
    assert all(r.shard < 24 for r in found)


def test_against_one_pass(spark):
    draw = random.Random(4)
    texts = ["", "é", "many " * 3, *["".join(draw.choices("abc d", k=draw.randrange(200))) for _ in range(300)]]
    rows = [(i, draw.choice([None, *texts])) for i in range(900)] + [(7, "copy")] * 700 + [(None, "x" * 100_000)]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, size string, shard int")
    found = sharding.shard(docs.repartition(5), 6, ranges_per_shard=4).collect()

    def size(text):
        return len((text or "").encode()) + 8

    def crc(text):
        return None if text is None else zlib.crc32(text.encode())

    key = lambda r: tuple((x is not None, x) for x in r)
    wanted = sorted(((d, size(t), crc(t)) for d, t in rows), key=key)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in found), key=key) == wanted
    total, before, places = sum(size(t) for _, t in rows), 0, {}
    for r in sorted(found, key=lambda r: (r.shard, r.slot)):
        assert r.shard == int(Fraction(6 * (2 * before + r["size"]), 2 * total))
        assert r.slot == places.setdefault(r.shard, 0)
        places[r.shard] += 1
        before += r["size"]
    assert before == total


def test_equal_rows_are_split(spark):
    docs = spark.range(20_000).select(F.lit(1).alias("doc_id"), F.lit("same text").alias("text"))
    records = docs.select(
        F.lit(17).cast("long").alias("size"), F.xxhash64("text").alias("h"),
        F.xxhash64("doc_id", F.monotonically_increasing_id()).alias("s"), F.lit(1 / 20_000).alias("weight"),
    )
    ranges = sharding._ranged(records, sharding._splitters(records, 16)).groupBy("range").count().collect()
    assert max(r["count"] for r in ranges) <= 2 * 20_000 / 16
    assert {r.shard for r in sharding.shard(docs, 8, ranges_per_shard=4).collect()} == set(range(8))


def test_very_long_text(spark):
    docs = spark.createDataFrame([(1, "a" * 3_000_000), (2, "b"), (3, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in sharding.shard(docs, 3).collect()}
    assert found[1]["size"] == 3_000_008 and found[3].text_crc32 is None
