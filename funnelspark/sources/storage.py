"""Where written intermediate tables go."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_SHREDDING = "spark.sql.variant.inferShreddingSchema"
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """This application's part of the folder named by ``spark.checkpoint.dir``.

    Every executor must reach it. Only a local session without the setting gets a
    temporary folder.
    """
    application = spark.sparkContext.applicationId
    base = spark.conf.get(_SETTING, None) or _local_folders.get(application)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="funnelspark-")
        _local_folders[application] = base
    return f"{base.rstrip('/')}/funnelspark-{application}"


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid4().hex}"


@contextmanager
def whole_variants(spark: SparkSession) -> Iterator[None]:
    """Writes inside store each variant as it is.

    Spark takes the variants of a file apart into a column for each common field, which suits
    readers of single fields; here they are put together again by whoever reads them next.
    """
    before = spark.conf.get(_SHREDDING, None)
    spark.conf.set(_SHREDDING, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHREDDING)
        else:
            spark.conf.set(_SHREDDING, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back, so its plan starts at the files."""
    path = new_folder(df.sparkSession, label)
    with whole_variants(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_table(path: str, like: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """The table at ``path``, created empty with the columns of ``like`` when missing."""
    like.limit(0).write.mode("ignore").partitionBy(*partition_by).parquet(path)
    return like.sparkSession.read.schema(like.schema).parquet(path)
