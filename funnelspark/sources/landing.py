"""Incremental extraction of raw tables into NDJSON landing files."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from funnelspark.config import EPOCH
from funnelspark.sources.rolling import roll_lines
from funnelspark.sources.storage import open_table

BATCH_BYTES = 4 * 1024 * 1024
# Batches packed in one sorted group; keeps a group's size bounded.
BATCHES_PER_GROUP = 8
#: Times drawn to cut a read into slices.
SAMPLED_TIMES = 20_000
_MARKS = "table_name string, high_water timestamp_ntz"


@dataclass(frozen=True)
class Slice:
    """Rows with ``low < insert_date <= high``, and of these one of ``parts`` by hash."""

    low: datetime
    high: datetime
    part: int = 0
    parts: int = 1

    def predicate(self, hash_sql: str) -> str:
        """As SQL; ``hash_sql`` makes a whole number from 0 of the text in its braces."""
        times = f"insert_date > TIMESTAMP '{self.low}' AND insert_date <= TIMESTAMP '{self.high}'"
        if self.parts == 1:
            return times
        number = hash_sql.format("coalesce(raw_data, '')")
        return f"{times} AND {number} % {self.parts} = {self.part}"


def time_slices(sample: Sequence[datetime], low: datetime, high: datetime, slices: int) -> list[Slice]:
    """Slices of about equal numbers of rows that together cover ``low < insert_date <= high``.

    Cut at quantiles of ``sample``, times of rows drawn at random. A time with more than a
    mean slice, such as that of a snapshot, is split by hash.
    """
    mean = max(1.0, len(sample) / slices)
    found, edge, last, weight = [], low, low, 0
    for moment, count in sorted(Counter(t for t in sample if low < t <= high).items()):
        if count > mean or weight + count > mean:
            if last > edge:
                found.append(Slice(edge, last))
            edge, weight = last, 0
        if count > mean:
            parts = math.ceil(count / mean)
            found += [Slice(edge, moment, part, parts) for part in range(parts)]
            edge = moment
        else:
            weight += count
        last = moment
    return [*found, Slice(edge, high)] if high > edge else found


def sampled_times(times: DataFrame, size: int = SAMPLED_TIMES) -> list[datetime]:
    """About ``size`` values of the only column of ``times``, drawn at random."""
    n = times.count()
    return [row[0] for row in times.sample(min(1.0, size / max(n, 1)), seed=0).limit(2 * size).collect()]


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    low: datetime,
    slices: int = 64,
    properties: Mapping[str, str] | None = None,
    sampled: str = "TABLESAMPLE SYSTEM (1)",
    hash_sql: str = "abs(hashtext({})::bigint)",
) -> DataFrame:
    """``raw_data, insert_date`` with ``low < insert_date``, up to the newest row there is now.

    Read in slices of about equal numbers of rows by a sample that the database draws.
    ``sampled`` and ``hash_sql`` are in its dialect, by default that of PostgreSQL.
    """
    options = dict(properties or {})
    newer = f"WHERE insert_date > TIMESTAMP '{low}'"
    high = spark.read.jdbc(url, f"(SELECT max(insert_date) AS m FROM {table} {newer}) AS newest", properties=options)
    high = high.select(F.col("m").cast("timestamp_ntz")).first()[0]
    query = f"(SELECT raw_data::text AS raw_data, insert_date FROM {table}) AS source"
    if high is None:
        predicates = ["1 = 0"]
    else:
        drawn = f"(SELECT insert_date FROM {table} {sampled} {newer}) AS drawn"
        times = spark.read.jdbc(url, drawn, properties=options).select(F.col("insert_date").cast("timestamp_ntz"))
        found = time_slices(sampled_times(times), low, high, slices)
        predicates = [s.predicate(hash_sql) for s in found]
    rows = spark.read.jdbc(url, query, predicates=predicates, properties=options)
    return rows.select("raw_data", F.col("insert_date").cast("timestamp_ntz"))


def read_checkpoint(spark: SparkSession, state: str, table: str) -> datetime:
    """High-water mark of the last finished extraction of ``table``."""
    marks = open_table(state, spark.createDataFrame([], _MARKS)).where(F.col("table_name") == table)
    return marks.agg(F.max("high_water")).first()[0] or datetime.fromisoformat(EPOCH)


def advance_checkpoint(spark: SparkSession, state: str, table: str, mark: datetime) -> None:
    spark.createDataFrame([(table, mark)], _MARKS).write.mode("append").parquet(state)


def after_checkpoint(
    rows: DataFrame, low: datetime | Column, high: Column | None = None
) -> DataFrame:
    """Rows with ``low < insert_date``, up to and including ``high`` when given."""
    low = low if isinstance(low, Column) else F.lit(low).cast("timestamp_ntz")
    newer = rows.where(F.col("insert_date") > low)
    return newer if high is None else newer.where(F.col("insert_date") <= high)


def page(rows: DataFrame, order: Sequence[str], limit: int, offset: int) -> DataFrame:
    """One page of an ordered scan."""
    return rows.orderBy(*order).offset(offset).limit(limit)


def snapshot_date() -> Column:
    """The INSERT_DATE text inside a raw row."""
    return F.get_json_object("raw_data", "$.INSERT_DATE")


def latest_raw(rows: DataFrame, limit: int) -> DataFrame:
    """Newest rows by snapshot date, rows without one first."""
    return rows.orderBy(snapshot_date().desc_nulls_first(), F.col("raw_data")).limit(limit)


def spaced_timestamp(moment: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` with six more digits only when there is a fraction."""
    text = moment.cast("string")
    padded = F.rpad(text, F.lit(26), F.lit("0"))
    return F.when(F.contains(text, F.lit(".")), padded).otherwise(text)


def envelope(rows: DataFrame) -> DataFrame:
    """Add ``line``: the payload and its insert_date as one JSON line."""
    line = F.concat(
        F.lit('{"payload": '),
        F.coalesce("raw_data", F.lit("null")),
        F.lit(', "insert_date": "'),
        spaced_timestamp(F.col("insert_date")),
        F.lit('"}'),
    )
    # Line breaks are only layout in JSON text, but they would split the line.
    return rows.withColumn("line", F.translate(line, "\r\n", "  "))


def group_count(total_bytes: int | None, max_bytes: int) -> int:
    """Groups needed so that each holds about ``BATCHES_PER_GROUP`` batches."""
    return max(1, -(-(total_bytes or 0) // (max_bytes * BATCHES_PER_GROUP)))


def line_bytes() -> Column:
    return F.sum(F.octet_length("line"))


def size_batches(
    lines: DataFrame,
    max_bytes: int,
    order: Sequence[str],
    groups: int,
    spread: Column | None = None,
) -> DataFrame:
    """Add ``batch``: consecutive lines of a group until ``max_bytes`` is reached.

    A batch is closed by the line that reaches the limit, so it exceeds the limit
    by less than one line. Rows are dealt out evenly over the groups, however many
    copies of a line there are, or follow ``spread`` if it is unique per row; so no
    group grows with the table. ``opens_batch`` marks first lines.
    """
    if spread is None:
        # Dealing is repeatable: Spark orders each partition's rows before it.
        dealt = lines.repartition(groups).withColumn("_group", F.spark_partition_id())
    else:
        dealt = lines.withColumn("_group", F.pmod(spread, F.lit(groups)))
    in_order = Window.partitionBy("_group").orderBy(*order, F.xxhash64("line"))
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    written = F.coalesce(F.sum(F.octet_length("line")).over(before), F.lit(0))
    # Batch numbers of the groups interleave.
    number = F.floor(written / max_bytes) * groups + F.col("_group")
    numbered = dealt.withColumn("batch", number.cast("long"))
    previous = F.lag("batch").over(in_order)
    opens = ~previous.eqNullSafe(F.col("batch"))
    return numbered.withColumn("opens_batch", opens).drop("_group")


def write_landing(lines: DataFrame, landing: str, table: str, run_ts: datetime) -> None:
    """``<landing>/<table>/dt=<day>/run=<time>/batch=<n>/``, compressed; repeating a run replaces it."""
    folder = run_folder(landing, table, run_ts)
    lines.select("line", "batch").write.mode("overwrite").partitionBy("batch").text(folder, compression="gzip")


def run_folder(landing: str, table: str, run_ts: datetime) -> str:
    return f"{landing}/{table}/dt={run_ts:%Y-%m-%d}/run={run_ts:%Y%m%d_%H%M%S}"


def keys_folder(landing: str, table: str, run_ts: datetime) -> str:
    """Where a run lists the files it has written, beside the folders that loads read."""
    return f"{landing}/_keys/{table}/run={run_ts:%Y%m%d_%H%M%S}"


def roll_landing(
    lines: DataFrame, landing: str, table: str, run_ts: datetime, max_bytes: int = BATCH_BYTES
) -> DataFrame:
    """Land ``line`` in files of ``max_bytes``, in one pass; ``key, rows, bytes`` of every file.

    ``<landing>/<table>/dt=<day>/run=<time>/<table>_<time>_task<t>_batch<n>.json``;
    repeating a run replaces it.
    """
    name = f"{table}_{run_ts:%Y%m%d_%H%M%S}"
    folder, keys = run_folder(landing, table, run_ts), keys_folder(landing, table, run_ts)
    return roll_lines(lines.select("line"), folder, keys, name, max_bytes)


@dataclass(frozen=True)
class Extraction:
    """What one run did to one table."""

    table: str
    rows_extracted: int
    batches: int
    checkpoint_advanced: bool
    new_checkpoint: datetime
    #: Of the files, all of which ``written_files`` of the run's ``keys_folder`` lists.
    first_key: str | None = None
    last_key: str | None = None


def extract_table(
    spark: SparkSession,
    rows: DataFrame,
    table: str,
    landing: str,
    state: str,
    run_ts: datetime,
    max_bytes: int = BATCH_BYTES,
) -> Extraction:
    """Land the rows after the checkpoint, then move the checkpoint.

    The upper end is fixed before anything is written, so rows arriving during the
    run wait for the next one; finding it reads times only. A failure leaves the checkpoint
    where it was.
    """
    low = read_checkpoint(spark, state, table)
    high = after_checkpoint(rows, low).agg(F.max("insert_date")).first()[0]
    if high is None:
        return Extraction(table, 0, 0, False, low)
    lines = envelope(after_checkpoint(rows, low, F.lit(high).cast("timestamp_ntz")))
    files = roll_landing(lines, landing, table, run_ts, max_bytes)
    landed = files.agg(F.sum("rows"), F.count("*"), F.min("key"), F.max("key")).first()
    advance_checkpoint(spark, state, table, high)
    return Extraction(table, landed[0], landed[1], True, high, landed[2], landed[3])


def run_summary(spark: SparkSession, runs: Sequence[Extraction]) -> DataFrame:
    schema = (
        "table string, rows_extracted long, batches long, checkpoint_advanced boolean,"
        " new_checkpoint timestamp_ntz, first_key string, last_key string"
    )
    return spark.createDataFrame([vars(run) for run in runs], schema)
