"""Flattening variants."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.sources.storage import written

#: Levels opened in one pass: a source document with its lists has as many.
LEVELS = 4


def explode_items(df: DataFrame, array: Column, item: str) -> DataFrame:
    """One row per element of a variant array; none for a missing array."""
    flat = df.lateralJoin(df.sparkSession.tvf.variant_explode(array.outer()))
    return flat.withColumnRenamed("value", item).drop("pos", "key")


def explode_outer(df: DataFrame, array: Column, item: str) -> DataFrame:
    """``explode_items`` with a row without ``item`` for a missing or empty array."""
    flat = df.lateralJoin(df.sparkSession.tvf.variant_explode_outer(array.outer()))
    return flat.withColumnRenamed("value", item).drop("pos", "key")


def string_leaves(
    df: DataFrame, document: str, wanted: Callable[[Column], Column] | None = None
) -> DataFrame:
    """(key_path, value) of every string at any level of a variant column.

    Only strings that are ``wanted``, by default all, are written. List positions are not
    part of the path. One pass opens ``LEVELS`` levels; what is still a container then goes
    through the next pass, until none is left, so no depth is too great and usual
    documents are scanned once.
    """
    tree = df.select(F.lit("").alias("key_path"), F.col(document).alias("node"))
    passes = []
    while True:
        walked = written(_opened(tree, wanted), "leaves")
        passes.append(walked.where("value IS NOT NULL").select("key_path", "value"))
        tree = walked.where("node IS NOT NULL").select("key_path", "node")
        if tree.isEmpty():
            return reduce(DataFrame.unionByName, passes)


def _opened(tree: DataFrame, wanted: Callable[[Column], Column] | None) -> DataFrame:
    """Wanted strings as ``value`` and deeper containers as ``node``, other leaves left out."""
    tvf = tree.sparkSession.tvf
    for _ in range(LEVELS):
        opened = tree.lateralJoin(tvf.variant_explode_outer(F.col("node").outer()))
        tree = opened.select(
            F.when(F.col("key").isNull(), F.col("key_path"))
            .when(F.col("key_path") == "", F.col("key"))
            .otherwise(F.concat("key_path", F.lit("."), "key"))
            .alias("key_path"),
            F.when(F.col("pos").isNull(), F.col("node")).otherwise(F.col("value")).alias("node"),
        )
    kind = F.schema_of_variant("node")
    container = (kind.startswith("OBJECT<") & (kind != "OBJECT<>")) | (
        kind.startswith("ARRAY<") & (F.size(F.col("node").try_cast("array<variant>")) > 0)
    )
    text = F.when(kind == "STRING", F.col("node").cast("string"))
    return tree.select(
        "key_path",
        (text if wanted is None else F.when(wanted(text), text)).alias("value"),
        F.when(container, F.col("node")).alias("node"),
    ).where("value IS NOT NULL OR node IS NOT NULL")
