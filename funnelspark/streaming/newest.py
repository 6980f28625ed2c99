"""The newest content of every key as the state of a stream.

The state of a key is the time and hash of its newest content, a few bytes. A snapshot that is
older than it, repeats it or shows the same content again goes no further, so what leaves the
stream is one row per change of content, whatever the order and slices of arrival. No stored
table is read or rewritten; the log of changes has the current rows as its newest per key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from funnelspark.operators.latest import latest_per_key
from funnelspark.streaming.upserts import bronze_stream

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: State with values per key needs this store; it keeps them on the executor's disk.
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Microseconds that stand for a missing time, which counts as the newest.
OPEN = (1 << 63) - 1


class NewestContent(StatefulProcessor):
    """Lets a row through when it is newer than its key's state and has other content."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._newest = handle.getValueState("newest", "moment long, md5_hash string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = tuple(self._newest.get()) if self._newest.exists() else None
        newest, best = known, None
        for frame in rows:
            top = frame.sort_values(["moment", "md5_hash"]).tail(1)
            version = (int(top["moment"].iloc[0]), top["md5_hash"].iloc[0])
            if newest is None or version > newest:
                newest, best = version, top
        if best is None:
            return
        self._newest.update(newest)
        if known is None or known[1] != newest[1]:
            yield best

    def close(self) -> None:
        pass


def moment_of(time: Column) -> Column:
    """Microseconds by the wall clock."""
    return F.coalesce(F.unix_micros(time.cast("timestamp")), F.lit(OPEN))


def changes(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of a stream of ``versions`` that bring newer content of their key.

    ``versions`` has ``md5_hash`` and ``insert_date``; the result has ``moment`` besides. Of two
    contents at one time the greater hash counts as newer. Rows without a key are left out.
    """
    present = versions.where(" AND ".join(f"`{key}` IS NOT NULL" for key in keys))
    timed = present.withColumn("moment", moment_of(F.col("insert_date")))
    return timed.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=NewestContent(), outputStructType=timed.schema, outputMode="Append", timeMode="None"
    )


def append_changes(
    spark: SparkSession,
    bronze_table: str,
    checkpoint: str,
    log: str,
    versions_of: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    max_files: int = 10_000,
) -> None:
    """Add the changes in the bronze rows loaded since the last call to ``log``.

    Every micro-batch has a folder of its own, which a repeat replaces.
    """
    found = changes(versions_of(bronze_stream(spark, bronze_table, max_files)), keys)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")

    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        query = (
            found.writeStream.foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def newest_rows(spark: SparkSession, log: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key in a log of changes."""
    newest = [F.col("moment").desc(), F.col("md5_hash").desc()]
    return latest_per_key(spark.read.parquet(log), keys, newest).drop("moment", "batch")
