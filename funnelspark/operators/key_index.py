"""Which stored rows a batch of keys can touch, found without shuffling the stored keys.

Beside the narrow ``keys`` part of a table lies a bitmap of the keys of each bucket: a key sets the
bit its hash points to. A key whose bit is clear is new; buckets without any possible key are not
read. What may be stored is broadcast to the keys of the other buckets, if its size allows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.operators.lookup import BROADCAST_BYTES, BROADCAST_ROWS
from funnelspark.sources import generations
from funnelspark.sources.generations import Change, Snapshot
from funnelspark.sources.storage import written

#: Bits for each key, so about one new key in so many looks stored.
BITS_PER_KEY = 16
#: Bits of one page, as the bitmap functions have them.
PAGE_BITS = 32_768

_BITMAP = "page int, bits binary"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The hash of a shuffle on the same keys, so that a task of as many partitions holds one bucket."""
    return F.pmod(F.hash(*keys), F.lit(buckets))


def _placed(rows: DataFrame, keys: Sequence[str], pages: dict[int, int]) -> DataFrame:
    """``rows`` of the given buckets with ``_page`` and ``_bit`` of their keys."""
    sizes = rows.sparkSession.createDataFrame(sorted(pages.items()) or [], "bucket int, _pages int")
    place = F.pmod(F.xxhash64(*keys), F.col("_pages").cast("long") * PAGE_BITS)
    placed = rows.join(F.broadcast(sizes), "bucket", "left").withColumn("_place", place)
    page = F.floor(F.col("_place") / PAGE_BITS).cast("int")
    return placed.select(*rows.columns, page.alias("_page"), (F.col("_place") % PAGE_BITS).cast("int").alias("_bit"))


def index_keys(change: Change, keys: Sequence[str], schema: str, buckets: Iterable[int]) -> None:
    """Write the bitmaps of ``buckets`` anew from the keys that ``change`` has written."""
    buckets = list(buckets)
    stored = change.written("keys", schema, buckets).select(*keys, "bucket")
    # At most one row for each bucket.
    counts = stored.groupBy("bucket").count().collect()
    pages = {row.bucket: -(-row["count"] * BITS_PER_KEY // PAGE_BITS) for row in counts}
    change.pages = {b: n for b, n in change.pages.items() if b not in buckets} | pages
    placed = _placed(stored, keys, pages).groupBy("bucket", F.col("_page").alias("page"))
    change.replace("bitmap", placed.agg(F.bitmap_construct_agg("_bit").alias("bits")), buckets, gather=["bucket"])


def possibly_stored(batch: DataFrame, path: str, at: Snapshot, keys: Sequence[str]) -> DataFrame:
    """``keys`` and ``bucket`` of the rows of ``batch`` whose bit is set."""
    bitmap = generations.read(batch.sparkSession, path, "bitmap", _BITMAP, at)
    placed = _placed(batch.select(*keys, "bucket"), keys, dict(at.pages))
    same = ["bucket", "_page"]
    met = placed.join(bitmap.withColumnRenamed("page", "_page"), same)
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10)
    is_set = F.call_function("shiftright", byte.cast("int"), F.col("_bit") % 8).bitwiseAND(1) == 1
    return met.where(is_set).select(*keys, "bucket")


@dataclass(frozen=True)
class Candidates:
    """Keys of a batch that may be stored, the buckets they are in, and whether they can be broadcast."""

    keys: DataFrame
    buckets: list[int]
    small: bool


def candidates(batch: DataFrame, path: str, at: Snapshot, keys: Sequence[str]) -> Candidates:
    """What of ``batch``, which has a ``bucket``, may be stored."""
    wanted = written(possibly_stored(batch, path, at, keys).distinct(), "possible")
    width = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys), F.lit(0))
    # At most one row for each bucket.
    sizes = wanted.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(width).alias("bytes")).collect()
    small = sum(r.n for r in sizes) <= BROADCAST_ROWS and sum(r.bytes for r in sizes) <= BROADCAST_BYTES
    return Candidates(wanted.drop("bucket"), [row.bucket for row in sizes], small)


def known_keys(found: Candidates, path: str, at: Snapshot, keys: Sequence[str], schema: str) -> DataFrame:
    """The rows of the ``keys`` part that have one of the candidates."""
    known = generations.read(found.keys.sparkSession, path, "keys", schema, at, found.buckets)
    return known.join(F.broadcast(found.keys) if found.small else found.keys, list(keys), "left_semi")


def stored_keys(batch: DataFrame, path: str, at: Snapshot, keys: Sequence[str], schema: str) -> DataFrame:
    """The rows of the ``keys`` part whose keys ``batch`` has; ``batch`` has a ``bucket``."""
    return known_keys(candidates(batch, path, at, keys), path, at, keys, schema)
