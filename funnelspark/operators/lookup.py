"""Joining records to a dimension whose size is checked first."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
#: Keys that a sketch of the records may find to be hot, and those it keeps track of.
HOT_KEYS = 64
TRACKED_KEYS = 4096
#: Pieces of a hot key for each mean task, so that pieces that meet in a task do not weigh much.
PIECES = 16
#: For ``lookup_join``: the sizes found when the join is run decide.
WHEN_RUN = "when run"


def fits_broadcast(dim: DataFrame) -> bool:
    """Whether ``dim`` is within the row and byte bounds; reads at most the bound."""
    width = F.lit(0)
    for name in dim.columns:
        width = width + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    head = dim.select(width.cast("long").alias("width")).limit(BROADCAST_ROWS + 1)
    rows, size = head.agg(F.count("*"), F.coalesce(F.sum("width"), F.lit(0))).first()
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def lookup_join(
    records: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    spread: Sequence[str],
    fits: bool | str | None = None,
) -> DataFrame:
    """Join ``records`` to the dimension on ``on`` ("left" or "inner").

    A dimension within the bounds is broadcast. A larger one is shuffled, and keys that
    hold more than their share of the records are split over salts taken from ``spread``,
    as many as their size asks for; only their rows of the dimension are copied. Records
    without a key match nothing and are spread at random. ``WHEN_RUN`` leaves the choice, and
    the splitting of large keys, to the adaptive planner.
    """
    on = list(on)
    if fits == WHEN_RUN:
        return records.join(dim, on, how)
    if fits is None:
        fits = fits_broadcast(dim)
    if fits:
        return records.join(F.broadcast(dim), on, how)
    partitions = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    records, dim = salted(records, dim, on, spread, hot_keys(records, on, partitions), PIECES * partitions)
    # Size estimates do not see the copies, so the optimizer might still broadcast them.
    return records.join(dim.hint("merge"), [*on, "_salt"], how).drop("_salt")


def hot_keys(records: DataFrame, on: Sequence[str], partitions: int) -> dict[int, int]:
    """Hashes of the keys with more records than a mean task, and the salts of each.

    A sketch of bounded size counts the largest keys in one pass over the key columns.
    """
    present = records.where(" AND ".join(f"`{name}` IS NOT NULL" for name in on))
    keys = present.select(F.xxhash64(*on).alias("key"))
    top = F.expr(f"approx_top_k(key, {HOT_KEYS}, {TRACKED_KEYS})")
    found, n = keys.agg(top, F.count("*")).first()
    mean = n / partitions
    return {row["item"]: math.ceil(PIECES * row["count"] / mean) for row in found or [] if row["count"] > mean}


def salted(
    records: DataFrame, dim: DataFrame, on: Sequence[str], spread: Sequence[str], hot: dict[int, int], empty: int
) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``: 0 but for hot keys and, in the records, ``empty`` salts for missing keys."""
    number = F.lit(1)
    if hot:
        listed = F.create_map(*[F.lit(x) for item in hot.items() for x in item])
        number = F.coalesce(listed[F.xxhash64(*on)], F.lit(1))
    missing = F.greatest(*[F.col(name).isNull() for name in on]) if len(on) > 1 else F.col(on[0]).isNull()
    salts = F.when(missing, F.lit(empty)).otherwise(number)
    records = records.withColumn("_salt", F.pmod(F.xxhash64(*spread), salts).cast("int"))
    return records, dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), number - 1)))
