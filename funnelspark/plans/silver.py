"""From bronze payloads to the field dictionary, users and activities."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.config import CUSTOM_PREFIX
from funnelspark.functions.values import text_at, wall_clock
from funnelspark.operators.history import HistoryRule
from funnelspark.operators.latest import latest_per_key
from funnelspark.operators.lookup import WHEN_RUN, fits_broadcast
from funnelspark.operators.nested import explode_items, explode_outer
from funnelspark.operators.quarantine import parse_repaired
from funnelspark.operators.upsert import UpsertRule

USER_RULE = UpsertRule(
    keys=("user_id",),
    updated=("email", "first_name", "last_name", "role", "status", "version"),
)
# The activity time stays as first seen.
ACTIVITY_RULE = UpsertRule(
    keys=("lead_id", "activity_id"),
    updated=("full_record", "record_type", "type_id", "user_id", "custom_fields", "version"),
)


FIELDS_SCHEMA = (
    "custom_activity_type_id string, custom_activity_type_name string, is_archived boolean,"
    " field_id string, field_name string, field_type string"
)
USERS_SCHEMA = (
    "user_id string, email string, first_name string, last_name string, role string,"
    " status string, md5_hash string, insert_date timestamp_ntz, update_date timestamp_ntz"
)
ACTIVITIES_SCHEMA = (
    "lead_id string, activity_id string, full_record variant, activity_at timestamp_ntz,"
    " record_type string, type_id string, user_id string, custom_fields map<string,string>,"
    " md5_hash string, insert_date timestamp_ntz, update_date timestamp_ntz"
)
MAX_LISTED_TYPES = 1000

# Daily runs keep the history of each key, so that the order of arrival does not matter.
USER_HISTORY = HistoryRule(keys=("user_id",))
ACTIVITY_HISTORY = HistoryRule(keys=("lead_id", "activity_id"), first_seen=("activity_at",))
FIELD_HISTORY = HistoryRule(keys=("field_id", "custom_activity_type_id"))


@dataclass(frozen=True, eq=False)
class Silver:
    """The three tables the gold views read, as of the time they were opened.

    With ``live`` they are as of the time a view is run, so nothing about their rows, such
    as sizes or type ids, is settled before.
    """

    fields: DataFrame
    users: DataFrame
    activities: DataFrame
    live: bool = False

    @cached_property
    def fields_fit(self) -> bool | str:
        return WHEN_RUN if self.live else fits_broadcast(self.fields)

    @cached_property
    def users_fit(self) -> bool | str:
        wanted = self.users.select("user_id", "email", "first_name", "last_name")
        return WHEN_RUN if self.live else fits_broadcast(wanted)

    @cached_property
    def _types(self) -> dict[tuple[str, tuple[str, ...]], list[str] | None]:
        return {}

    def type_ids(self, column: str, values: tuple[str, ...]) -> list[str] | None:
        """Ids of the types whose dictionary rows have one of the values.

        A few ids can be pushed down to the scan of the activities, which are
        sorted by type. None when there are too many to list.
        """
        if (column, values) not in self._types:
            rows = self.fields.where(F.col(column).isin(*values))
            ids = rows.select("custom_activity_type_id").distinct().limit(MAX_LISTED_TYPES + 1)
            found = [row[0] for row in ids.collect()]
            self._types[column, values] = found if len(found) <= MAX_LISTED_TYPES else None
        return self._types[column, values]

    def activities_of(self, column: str, values: tuple[str, ...]) -> DataFrame:
        """The activities whose type has one of the values, as far as ids can be listed."""
        if self.live:
            of_types = self.fields.where(F.col(column).isin(*values))
            ids = of_types.select(F.col("custom_activity_type_id").alias("type_id"))
            return self.activities.join(ids, "type_id", "left_semi")
        ids = self.type_ids(column, values)
        return self.activities if ids is None else self.activities.where(F.col("type_id").isin(ids))


def parse_object_text(bronze: DataFrame) -> DataFrame:
    """Repair and parse the text under JSON_OBJECT of catalog and user rows."""
    return parse_repaired(bronze, F.try_variant_get("payload", "$.JSON_OBJECT", "string"))


def items_of(rows: DataFrame, document: str, item: str) -> DataFrame:
    return explode_items(rows, F.try_variant_get(document, "$.data", "variant"), item)


def field_versions(parsed: DataFrame) -> DataFrame:
    """A row per field of each activity type in each snapshot."""
    types = items_of(parsed.select("insert_date", "parsed"), "parsed", "type")
    fields = F.try_variant_get("type", "$.fields", "variant")
    pairs = explode_items(types.select("insert_date", "type"), fields, "field")
    return pairs.select(
        text_at(F.col("type"), "id").alias("custom_activity_type_id"),
        text_at(F.col("type"), "name").alias("custom_activity_type_name"),
        F.try_variant_get("type", "$.is_archived", "boolean").alias("is_archived"),
        text_at(F.col("field"), "id").alias("field_id"),
        text_at(F.col("field"), "name").alias("field_name"),
        text_at(F.col("field"), "type").alias("field_type"),
        "insert_date",
    )


_FIELD_TIES = ("custom_activity_type_name", "field_name", "field_type", "is_archived")


def latest_fields(versions: DataFrame) -> DataFrame:
    newest = [F.col(name).desc_nulls_first() for name in ("insert_date", *_FIELD_TIES)]
    return latest_per_key(versions, ["field_id", "custom_activity_type_id"], newest)


def field_dictionary(parsed: DataFrame) -> DataFrame:
    """One row per (field, activity type), from the newest snapshot that lists it."""
    return latest_fields(field_versions(parsed)).drop("insert_date")


def hashed_fields(versions: DataFrame) -> DataFrame:
    """``versions`` with the hash of what a row says of its field, and its version."""
    said = F.to_json(F.struct(*_FIELD_TIES))
    hashed = versions.withColumn("md5_hash", F.md5(said))
    return hashed.withColumn("version", version_of("insert_date", *_FIELD_TIES))


def content_hash(record: Column) -> Column:
    """Equal for equal content: a variant writes its keys in order."""
    return F.md5(record_text(record))


def record_text(record: Column) -> Column:
    """``record`` as JSON, the text that a cast to string gives.

    A cast sets up a JSON writer for each key and each string. A map of the record's fields is written
    with one writer for all keys; what is not an object is cast.
    """
    fields = record.try_cast("map<string,variant>")
    return F.coalesce(F.to_json(fields), record.cast("string"))


def version_of(*moments: str) -> Column:
    """What makes one version newer than another: its times, a missing one first."""
    parts = [part for name in moments for part in (F.col(name).isNull(), F.col(name))]
    names = [f"{kind}_{i}" for i in range(len(moments)) for kind in ("open", "at")]
    struct = [part.alias(name) for part, name in zip(parts, names)]
    return F.struct(*struct, F.col("md5_hash").alias("hash")).alias("version")


def user_versions(parsed: DataFrame) -> DataFrame:
    users = items_of(parsed.select("insert_date", "parsed"), "parsed", "user")
    user = F.col("user")
    return users.select(
        text_at(user, "id").alias("user_id"),
        text_at(user, "email").alias("email"),
        text_at(user, "first_name").alias("first_name"),
        text_at(user, "last_name").alias("last_name"),
        text_at(user, "role").alias("role"),
        text_at(user, "status").alias("status"),
        content_hash(user).alias("md5_hash"),
        "insert_date",
    )


def latest_of_users(versions: DataFrame) -> DataFrame:
    newest = [F.col("insert_date").desc_nulls_first(), F.col("md5_hash").desc()]
    return latest_per_key(versions, ["user_id"], newest)


def latest_users(parsed: DataFrame) -> DataFrame:
    return latest_of_users(user_versions(parsed)).withColumn("version", version_of("insert_date"))


def activity_versions(bronze: DataFrame) -> DataFrame:
    return _versions(items_of(bronze.select("payload", "insert_date"), "payload", "record"))


def _versions(records: DataFrame, *kept: str) -> DataFrame:
    record = F.col("record")
    return records.select(
        text_at(record, "lead_id").alias("lead_id"),
        text_at(record, "id").alias("activity_id"),
        record.alias("full_record"),
        wall_clock(text_at(record, "activity_at")).alias("activity_at"),
        content_hash(record).alias("md5_hash"),
        "insert_date",
        *kept,
    )


def flattened_activities(bronze: DataFrame) -> DataFrame:
    """``activity_versions`` with what they leave out, from one pass over ``bronze``.

    ``keyless`` is the text of a record without a key. A payload without ``data`` is a row of
    its own, which has nothing but its time and its text, ``no_data``.
    """
    payload, items = F.col("payload"), F.col("_items")
    # Taken out of the payload once: that copies all of it.
    found = bronze.select("payload", "insert_date", F.try_variant_get(payload, "$.data", "variant").alias("_items"))
    no_data = F.when(payload.isNotNull() & items.isNull(), F.to_json(payload)).alias("no_data")
    opened = explode_outer(found.select("insert_date", "_items", no_data), items, "record")
    records = opened.where("record IS NOT NULL OR no_data IS NOT NULL").drop("_items")
    missing = keys_missing(ACTIVITY_RULE) & F.col("no_data").isNull()
    versions = _versions(records, "no_data")
    return versions.withColumn("keyless", F.when(missing, F.to_json("full_record")))


def latest_activities(bronze: DataFrame) -> DataFrame:
    return latest_of_activities(activity_versions(bronze))


def latest_of_activities(versions: DataFrame) -> DataFrame:
    """One row per (lead, activity), with the keys every view reads as columns.

    The custom fields become a map of text here, once, so that the views read
    narrow columns and never open the record again.
    """
    newest = [
        F.col("activity_at").desc_nulls_first(),
        F.col("insert_date").desc_nulls_first(),
        F.col("md5_hash").desc(),
    ]
    latest = latest_per_key(versions, ["lead_id", "activity_id"], newest)
    record = F.col("full_record")
    entries = record.try_cast("map<string,variant>").cast("map<string,string>")
    return latest.select(
        "lead_id",
        "activity_id",
        "full_record",
        "activity_at",
        text_at(record, "_type").alias("record_type"),
        text_at(record, "custom_activity_type_id").alias("type_id"),
        text_at(record, "user_id").alias("user_id"),
        F.map_filter(entries, lambda key, _: key.startswith(CUSTOM_PREFIX)).alias("custom_fields"),
        "md5_hash",
        "insert_date",
        version_of("activity_at", "insert_date"),
    )


def keys_missing(rule: UpsertRule) -> Column:
    missing = F.lit(False)
    for key in rule.keys:
        missing = missing | F.col(key).isNull()
    return missing


def without_keys(source: DataFrame, rule: UpsertRule) -> DataFrame:
    """Rows that can never match because a key is missing."""
    return source.where(keys_missing(rule))

