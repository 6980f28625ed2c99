"""Shards of nearly equal bytes by sampled splitters, in DataFrame operations only.

Records are ordered by (hash of the text, hash of the id). A sample weighted by size and
number of rows gives the splitters of a few thousand ranges; equal texts lie side by side,
and a text with very many rows falls into several ranges. Ranges of more than twice the mean
weight are split again by a sample of their own until only single records are that large. Sums by range and running sums within a range
give each record its place in the whole order, and the order is cut into shards of equal
bytes: two shards differ by less than the size of two records.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelspark.sources.storage import written

#: Bytes counted for a record besides its text.
RECORD_BYTES = 8
RANGES_PER_SHARD = 16
SAMPLES_PER_RANGE = 20

#: Cells by the highest bits of the hash, for finding a record's range.
_CELLS = 1024
_CELL_SHIFT = 54

_KEYS = "array<struct<h:bigint,s:bigint>>"

Key = tuple[int, int]


def shard(
    docs: DataFrame, shards: int = 24, id_column: str = "doc_id", text_column: str = "text",
    ranges_per_shard: int = RANGES_PER_SHARD,
) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law`` (``bytes``), ``shard``, ``slot``, ``grown_shard``.

    One row per row of ``docs``. ``size`` is the text's UTF-8 bytes plus 8, null text
    counts none and has a null ``text_crc32``. Rows that are equal in id and text take
    neighbouring slots in any order; null ids are ordered like any value. ``slot`` runs
    from 0 without gaps in every shard. ``grown_shard`` is null: cuts by bytes move when a
    shard is added. No rows give no rows.
    """
    text = F.col(text_column)
    records = written(
        docs.select(
            F.col(id_column).alias("doc_id"),
            (F.coalesce(F.octet_length(text).cast("long"), F.lit(0)) + RECORD_BYTES).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
            # The row's number makes rows that are equal in id and text different keys.
            F.xxhash64(F.col(id_column), text, F.monotonically_increasing_id()).alias("s"),
        ),
        "records",
    )
    rows, total = records.agg(F.count("*"), F.sum("size")).first()
    if not rows:
        return _result(records.withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("long")))

    # Half of a record's weight is its share of the bytes, half its share of the rows.
    records = records.withColumn("weight", F.col("size") / F.lit(2.0 * total) + F.lit(0.5 / rows))
    splitters = _splitters(records, shards * ranges_per_shard)
    placed = _ranged(records, splitters)
    sums = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("count"))
    # One row for each range: their number is a parameter, not a matter of the input.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("rows_before"),
    )
    order = Window.partitionBy("range").orderBy("h", "s", "doc_id")
    placed = (
        placed.withColumn("sum", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("nth", F.row_number().over(order))
        .join(F.broadcast(starts), "range")
    )
    # The shard in which the record's middle byte lies.
    middle = (F.col("bytes_before") + F.col("sum")) * 2 - F.col("size")
    placed = placed.withColumn("shard", shard_of(middle, total, shards))
    placed = placed.withColumn("place", F.col("rows_before") + F.col("nth") - 1)
    placed = written(placed.select("doc_id", "size", "text_crc32", "shard", "place"), "placed")
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))
    slots = placed.join(F.broadcast(first), "shard").withColumn("slot", F.col("place") - F.col("first"))
    return _result(slots)


def shard_of(middle: Column, total: int, shards: int) -> Column:
    """The shard of a record whose middle is at ``middle`` half bytes of ``total`` bytes.

    Whole division of whole numbers: no quotient is rounded up to the next shard.
    """
    wide = "decimal(38,0)"
    return F.call_function(
        "div", (F.lit(shards).cast("decimal(10,0)") * middle.cast("decimal(20,0)")).cast(wide), F.lit(2 * total).cast(wide)
    ).cast("int")


def _result(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def _sampled(records: DataFrame, number: int) -> list[Key]:
    """Sorted keys of a sample without replacement, larger weights more often.

    The records with the smallest ``-ln(u) / weight``, u uniform and made from the key.
    """
    u = (F.pmod(F.xxhash64("h", "s", F.lit(2)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    drawn = records.select("h", "s", (-F.log(u) / F.col("weight")).alias("draw"))
    return sorted((r["h"], r["s"]) for r in drawn.orderBy("draw", "h", "s").limit(number).collect())


def _splitters(records: DataFrame, ranges: int) -> list[Key]:
    sample = _sampled(records, ranges * SAMPLES_PER_RANGE)
    found = set(sample[SAMPLES_PER_RANGE // 2 :: SAMPLES_PER_RANGE])
    while True:
        splitters = sorted(found)
        placed = _ranged(records, splitters)
        # Of several records; one alone cannot be split, however large.
        heavy = placed.groupBy("range").agg(F.sum("weight").alias("total"), F.count("*").alias("n"))
        heavy = [r["range"] for r in heavy.where((F.col("total") > 2.0 / ranges) & (F.col("n") > 1)).collect()]
        if not heavy:
            return splitters
        inside = reduce(lambda a, b: a | b, (F.col("range") == r for r in heavy))
        more = _sampled(placed.where(inside), len(heavy) * SAMPLES_PER_RANGE)
        found.update(more[:: max(1, SAMPLES_PER_RANGE // 4)])
        if len(found) == len(splitters):
            return splitters


def _ranged(records: DataFrame, splitters: list[Key]) -> DataFrame:
    """``records`` with ``range``: how many splitters are not above the record's key.

    The hashes' highest bits lead to the few splitters that begin with the same bits; that
    table has ``_CELLS`` rows and all splitters, whose number is a parameter.
    """
    by_cell: dict[int, list[Key]] = {}
    for key in splitters:
        by_cell.setdefault(key[0] >> _CELL_SHIFT, []).append(key)
    rows, before = [], 0
    for cell in range(-_CELLS // 2, _CELLS // 2):
        inside = by_cell.get(cell, [])
        keys = ", ".join(f"named_struct('h', {_long(h)}, 's', {_long(s)})" for h, s in inside)
        rows.append(f"({cell}L, {before}, cast(array({keys}) AS {_KEYS}))")
        before += len(inside)
    cells = records.sparkSession.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS cells(cell, before, inside)")
    count = F.expr("before + size(filter(inside, x -> x <= named_struct('h', h, 's', s)))")
    return (
        records.withColumn("cell", F.shiftright("h", _CELL_SHIFT))
        .join(F.broadcast(cells), "cell")
        .withColumn("range", count.cast("int"))
        .drop("cell", "before", "inside")
    )


def _long(value: int) -> str:
    return f"{value}L" if value > -(1 << 63) else "(-9223372036854775807L - 1L)"
