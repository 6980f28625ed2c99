"""Insert new keys and update changed ones."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.operators.key_index import bucket_of, index_keys, stored_keys
from funnelspark.sources import generations
from funnelspark.sources.generations import Change
from funnelspark.sources.storage import written


@dataclass(frozen=True)
class UpsertRule:
    """Rows match on ``keys``; a different hash replaces only ``updated`` columns.

    With a ``version`` column, only a source row of a version greater than any seen for
    its key replaces the stored one, so batches may arrive in any order.
    """

    keys: Sequence[str]
    updated: Sequence[str]
    hash_column: str = "md5_hash"
    version: str | None = None


def has_keys(rule: UpsertRule) -> Column:
    present = F.lit(True)
    for key in rule.keys:
        present = present & F.col(key).isNotNull()
    return present


def new_rows(source: DataFrame, run_ts: Column) -> DataFrame:
    return source.withColumn("update_date", run_ts)


def schema_of(df: DataFrame) -> str:
    """The columns of ``df`` besides ``bucket``, as text."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != "bucket")


def updated_rows(
    target: DataFrame, source: DataFrame, rule: UpsertRule, run_ts: Column
) -> DataFrame:
    """The target with the changes of the source, whose other rows are left out.

    The source may be broadcast when its size allows, and then the target is not
    shuffled.
    """
    data = [c for c in target.columns if c != "update_date"]
    old = target.alias("old")
    new = source.select(*data).withColumn("_given", F.lit(True)).alias("new")
    same_key = F.lit(True)
    for key in rule.keys:
        same_key = same_key & (F.col(f"old.{key}") == F.col(f"new.{key}"))
    differs = F.col(f"old.{rule.hash_column}") != F.col(f"new.{rule.hash_column}")
    changed = F.col("new._given").isNotNull() & differs
    replaced = {*rule.updated, rule.hash_column}
    if rule.version:
        changed = changed & (F.col(f"new.{rule.version}") > F.col(f"old.{rule.version}"))
        replaced.add(rule.version)

    def merged(name: str) -> Column:
        if name not in replaced:
            return F.col(f"old.{name}")
        return F.when(changed, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)

    stamp = F.when(changed, run_ts).otherwise(F.col("old.update_date")).alias("update_date")
    return old.join(new, same_key, "left").select(*[merged(c) for c in data], stamp)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of an upserted table as of now."""
    return generations.read(spark, path, "rows", schema, generations.newest(spark, path)).drop("bucket")


def upsert_table(
    path: str,
    source: DataFrame,
    rule: UpsertRule,
    run_ts: Column,
    buckets: int | None = None,
    sort_by: Sequence[str] = (),
) -> str:
    """Upsert into a table of buckets by key hash; returns the columns of the rows.

    Changed and new rows are found from narrow keys and hashes, of which only those
    that a key bitmap holds for possible are read; only
    the buckets with changes are rewritten. They are switched together by one manifest
    file, so a run that is lost leaves the table as it was, and running it again
    changes nothing. The number of ``buckets`` is that of the first run, by default the
    number of shuffle partitions.

    A newer version with unchanged content goes to the narrow keys alone, so nothing wide is
    rewritten for it.
    """
    spark = source.sparkSession
    before = generations.newest(spark, path)
    if before:
        buckets = before.buckets
    elif buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = source.where(has_keys(rule)).withColumn("bucket", bucket_of(rule.keys, buckets))
    rows_schema = schema_of(new_rows(source, run_ts))
    narrow = [*rule.keys, rule.hash_column, *([rule.version] if rule.version else [])]
    keys_schema = schema_of(source.select(*narrow))
    change = Change(spark, path, before, buckets)
    if before is None:
        change.replace("rows", new_rows(source, run_ts), sort_by=sort_by)
        change.replace("keys", change.written("rows", rows_schema).select(*narrow, "bucket"))
        index_keys(change, rule.keys, keys_schema, range(buckets))
        change.commit()
        return rows_schema

    source = written(source, "source")
    known = stored_keys(source, path, before, rule.keys, keys_schema).drop("bucket")
    known = known.withColumnRenamed(rule.hash_column, "_hash").withColumn("_known", F.lit(True))
    if rule.version:
        known = known.withColumnRenamed(rule.version, "_seen")
    newer = F.col(rule.version) > F.col("_seen") if rule.version else F.lit(True)
    same = F.col("_hash") == F.col(rule.hash_column)
    fresh = F.col("_known").isNull()
    # What becomes of the row: wide parts are read and written for new and changed ones only.
    kind = F.when(fresh, "new").when(newer & ~same, "changed")
    if rule.version:
        kind = kind.when(newer, "seen")
    delta = written(source.join(known, list(rule.keys), "left").withColumn("_kind", kind).where("_kind IS NOT NULL"), "delta")
    # At most three rows for each bucket.
    touched = {(row["_kind"], row.bucket) for row in delta.select("_kind", "bucket").distinct().collect()}
    if not touched:
        return rows_schema
    given = delta.select(*source.columns, "_kind")
    wide = sorted({b for k, b in touched if k != "seen"})
    if wide:
        kept = generations.read(spark, path, "rows", rows_schema, before, wide)
        changes = given.where("_kind = 'changed'").drop("_kind")
        added = new_rows(given.where("_kind = 'new'").drop("_kind"), run_ts)
        change.replace("rows", updated_rows(kept, changes, rule, run_ts).unionByName(added), wide, sort_by)
    every = sorted({b for _, b in touched})
    now = given.select(*narrow, "bucket")
    others = generations.read(spark, path, "keys", keys_schema, before, every).join(now, list(rule.keys), "left_anti")
    change.replace("keys", others.unionByName(now), every)
    index_keys(change, rule.keys, keys_schema, sorted({b for k, b in touched if k == "new"}))
    change.commit()
    return rows_schema
