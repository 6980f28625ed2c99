"""Rows of the newest content per key, the same in whatever order snapshots arrive.

Of every content of a key the first and the last time it was seen are kept, and the greatest
version. Merging two such intervals takes the lesser first and the greater last time, so
batches may be cut, repeated and ordered in any way. A stored row is a function of its key's history:
the content of the greatest version, first-seen columns from the content seen first, ``insert_date``
from the first time of all and ``update_date`` from the first time of the newest content.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelspark.operators.key_index import bucket_of, candidates, index_keys, known_keys
from funnelspark.operators.upsert import schema_of
from funnelspark.sources import generations
from funnelspark.sources.generations import Change
from funnelspark.sources.storage import written


@dataclass(frozen=True)
class HistoryRule:
    """``keys`` of a row, the columns whose first-seen value stays, the content's hash and version."""

    keys: Sequence[str]
    first_seen: Sequence[str] = ()
    hash_column: str = "md5_hash"
    version: str = "version"
    moment: str = "insert_date"


def observed(versions: DataFrame, rule: HistoryRule) -> DataFrame:
    """One row per key and content: when it was seen first and last, and its greatest version."""
    content = [*rule.keys, rule.hash_column]
    seen = versions.select(
        *content, *rule.first_seen, rule.version,
        F.col(rule.moment).alias("first_time"), F.col(rule.moment).alias("last_time"),
    )
    return merged(seen, rule)


def merged(intervals: DataFrame, rule: HistoryRule) -> DataFrame:
    """Intervals of the same key and content as one."""
    groups = intervals.groupBy(*rule.keys, rule.hash_column, *(["bucket"] if "bucket" in intervals.columns else []))
    return groups.agg(
        *[F.max(c).alias(c) for c in rule.first_seen],
        F.max(rule.version).alias(rule.version),
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
    )


def audited(history: DataFrame, rule: HistoryRule) -> DataFrame:
    """One row per key: the newest content's hash and the columns that follow from the history."""
    first = F.struct(F.col("first_time"), F.col(rule.hash_column))
    newest = F.struct(F.col(rule.version), F.col(rule.hash_column))
    return history.groupBy(*rule.keys).agg(
        F.max_by(rule.hash_column, newest).alias(rule.hash_column),
        *[F.min_by(c, first).alias(c) for c in rule.first_seen],
        F.min("first_time").alias(rule.moment),
        F.max_by("first_time", newest).alias("update_date"),
    )


def fold_versions(
    path: str, versions: DataFrame, latest: DataFrame, rule: HistoryRule, buckets: int | None = None,
    sort_by: Sequence[str] = (),
) -> None:
    """Bring the table at ``path`` up to date with a batch of versions.

    ``versions`` has every version of the batch, narrow; ``latest`` the wide row of the greatest
    one of each key, with its hash. Rows without a key are left out. Only buckets in which a row changes are
    rewritten, and those that only see known content again in their narrow part alone; all are
    switched together, so a lost run leaves the table as it was. The keys of changed rows are
    listed as the version's ``changes``.
    """
    spark = versions.sparkSession
    before = generations.newest(spark, path)
    if before:
        buckets = before.buckets
    elif buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys, bucket = list(rule.keys), bucket_of(rule.keys, buckets)
    with_keys = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    seen = observed(versions.where(with_keys), rule).withColumn("bucket", bucket)
    keys_schema = schema_of(seen)
    derived = [*rule.first_seen, rule.moment, "update_date"]
    content = [c for c in latest.columns if c not in {*derived, rule.version, *keys}]
    change = Change(spark, path, before, buckets)
    given = latest.where(with_keys).select(*keys, *content)

    def rows_of(audit: DataFrame) -> DataFrame:
        return given.join(audit.drop(rule.hash_column), keys).withColumn("bucket", bucket)

    if before is None:
        change.replace("keys", seen, gather=keys)
        history = change.written("keys", keys_schema)
        change.replace("rows", rows_of(audited(history, rule)), sort_by=sort_by)
        index_keys(change, keys, keys_schema, range(buckets))
        change.commit()
        return

    seen = written(seen, "seen")
    found = candidates(seen, path, before, keys)
    if found.small:
        old = written(known_keys(found, path, before, keys, keys_schema), "old")
        now = written(merged(old.unionByName(seen), rule), "now")
        delta = _delta(audited(now, rule), audited(old, rule), rule, derived).withColumn("bucket", bucket)
        narrow = _buckets(_new_intervals(now, old, rule))
        if narrow:
            others = generations.read(spark, path, "keys", keys_schema, before, narrow).join(
                seen.select(*keys).distinct(), keys, "left_anti"
            )
            change.replace("keys", others.unionByName(now.where(F.col("bucket").isin(narrow))), narrow, gather=keys)
    else:
        # Most of the stored keys: all keys of the batch's buckets are merged, compared and stored in one shuffle.
        given_buckets = _buckets(seen)
        stored = generations.read(spark, path, "keys", keys_schema, before, given_buckets)
        marked = _marked(stored, seen, rule, derived)
        marks_schema = schema_of(marked)
        change.replace("keys", marked, given_buckets)
        marks = change.written("keys", marks_schema, given_buckets)
        narrow = _buckets(marks.where("_new"))
        change.keep("keys", set(given_buckets) - set(narrow))
        names = (rule.hash_column, *derived)
        delta = marks.where("_leads").select(
            *keys, *[F.col(f"_now_{name}").alias(name) for name in names], "_fresh", "bucket"
        )
    if not narrow:
        return
    delta = written(delta, "delta")
    # At most two rows for each bucket, and one.
    touched = {(row["_fresh"], row.bucket) for row in delta.select("_fresh", "bucket").distinct().collect()}
    wide = sorted({b for _, b in touched})
    if wide:
        schema = schema_of(given.join(delta.select(*keys, *derived), keys))
        kept = generations.read(spark, path, "rows", schema, before, wide)
        rows = _with_changes(kept, delta.drop("_fresh", "bucket"), given, rule, derived, content, bucket)
        change.replace("rows", rows, wide, sort_by)
        change.replace("changes", delta.select(*keys, "bucket"), gather=keys)
    index_keys(change, keys, keys_schema, sorted({b for fresh, b in touched if fresh}))
    change.commit()


def _buckets(rows: DataFrame) -> list[int]:
    """The buckets of ``rows``: at most one row for each is collected."""
    return sorted(row.bucket for row in rows.select("bucket").distinct().collect())


def _delta(now: DataFrame, was: DataFrame, rule: HistoryRule, derived: Sequence[str]) -> DataFrame:
    """What ``audited`` says of the keys for which it differs, and whether the key is ``_fresh``."""
    keys = list(rule.keys)
    is_same = F.lit(True)
    for name in (rule.hash_column, *derived):
        is_same = is_same & F.col(f"now.{name}").eqNullSafe(F.col(f"was.{name}"))
    joined = now.alias("now").join(was.alias("was"), keys, "left")
    fresh = F.col(f"was.{rule.hash_column}").isNull()
    return joined.where(~is_same | fresh).select(
        *keys, *[F.col(f"now.{name}").alias(name) for name in (rule.hash_column, *derived)], fresh.alias("_fresh")
    )


def _marked(stored: DataFrame, seen: DataFrame, rule: HistoryRule, derived: Sequence[str]) -> DataFrame:
    """``merged`` rows of both, shuffled by key, with what ``_new_intervals`` and ``_delta`` would find.

    ``_new`` marks an interval that ``seen`` has made or stretched. One row of each key that differs ``_leads``:
    it has the key's audit columns as ``_now_...`` and tells whether the key is ``_fresh``.
    """
    keys, hash_column = list(rule.keys), rule.hash_column
    values = [*rule.first_seen, rule.version, "first_time", "last_time"]
    both = stored.withColumn("_met", F.lit(True)).unionByName(seen.withColumn("_met", F.lit(False)))
    earlier = [F.max(F.when(F.col("_met"), F.col(c))).alias(f"_old_{c}") for c in values]
    contents = both.repartition(*keys).groupBy(*keys, hash_column, "bucket").agg(
        *[F.max(c).alias(c) for c in (*rule.first_seen, rule.version)],
        F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"),
        F.max("_met").alias("_met"), *earlier,
    )

    def audits(prefix: str, known: Column, label: str) -> list[Column]:
        """As ``audited``, over the contents for which ``known`` holds: no others have a place in the order."""
        first = F.when(known, F.struct(F.col(f"{prefix}first_time"), F.col(hash_column)))
        newest = F.when(known, F.struct(F.col(f"{prefix}{rule.version}"), F.col(hash_column)))
        found = {
            hash_column: F.max_by(hash_column, newest),
            **{c: F.min_by(f"{prefix}{c}", first) for c in rule.first_seen},
            rule.moment: F.min(F.when(known, F.col(f"{prefix}first_time"))),
            "update_date": F.max_by(f"{prefix}first_time", newest),
        }
        return [found[name].over(of_key).alias(f"{label}{name}") for name in (hash_column, *derived)]

    of_key = Window.partitionBy(*keys)
    compared = contents.select(
        "*", *audits("", F.lit(True), "_now_"), *audits("_old_", F.col("_met"), "_was_"),
        F.min(hash_column).over(of_key).eqNullSafe(F.col(hash_column)).alias("_least"),
    )
    fresh = F.col(f"_was_{hash_column}").isNull()
    is_same = F.lit(True)
    for name in (hash_column, *derived):
        is_same = is_same & F.col(f"_now_{name}").eqNullSafe(F.col(f"_was_{name}"))
    stretched = F.lit(False)
    for name in ("first_time", "last_time"):
        stretched = stretched | ~F.col(name).eqNullSafe(F.col(f"_old_{name}"))
    leads = F.col("_least") & (~is_same | fresh)
    return compared.select(
        *keys, hash_column, *values, (~F.col("_met") | stretched).alias("_new"), leads.alias("_leads"),
        fresh.alias("_fresh"),
        # Only the rows that lead need them.
        *[F.when(leads, F.col(f"_now_{name}")).alias(f"_now_{name}") for name in (hash_column, *derived)], "bucket",
    )


def _new_intervals(now: DataFrame, old: DataFrame, rule: HistoryRule) -> DataFrame:
    """The intervals that the batch has made or stretched."""
    content = [*rule.keys, rule.hash_column]
    before = old.select(*content, F.col("first_time").alias("_first"), F.col("last_time").alias("_last"))
    same = F.col("first_time").eqNullSafe(F.col("_first")) & F.col("last_time").eqNullSafe(F.col("_last"))
    # Whether the content was known at all, also without times.
    met = now.join(before.withColumn("_met", F.lit(True)), content, "left")
    return met.where(F.col("_met").isNull() | ~same)


def _with_changes(
    kept: DataFrame, audits: DataFrame, given: DataFrame, rule: HistoryRule, derived: Sequence[str],
    content: Sequence[str], bucket: Column,
) -> DataFrame:
    """Stored rows with the audit columns of ``audits``, and with the batch's content where it is newer; fresh rows."""
    keys = list(rule.keys)

    def other(frame: DataFrame, names: Sequence[str]) -> DataFrame:
        return frame.withColumnsRenamed({name: f"_{name}" for name in names})

    # Newer content comes from the batch; otherwise the audit columns alone have changed.
    changes = other(audits.withColumnRenamed(rule.hash_column, "_newest"), derived).join(
        other(given, content), keys, "left"
    )
    joined = kept.drop("bucket").join(changes, keys, "full")
    known = F.col("_newest").isNotNull()
    newer = known & ~F.col("_newest").eqNullSafe(F.col(rule.hash_column))

    def chosen(test: Column, name: str) -> Column:
        return F.when(test, F.col(f"_{name}")).otherwise(F.col(name)).alias(name)

    return joined.select(
        *keys, *[chosen(newer, name) for name in content], *[chosen(known, name) for name in derived]
    ).withColumn("bucket", bucket)
