"""CRM-shaped source tables derived row by row from the given test tables.

``events`` become activities, ``customer`` becomes the users and ``part`` widens the
activity catalog. Every raw row comes from one input row, so no step here groups.
Each entity appears in three daily snapshots; some change in the last one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.config import CRM_USERS, CUSTOM_ACTIVITIES, LEAD_ACTIVITIES

# Outcomes and objections as the source spells them, which reports compare with.
TRIAGE_OUTCOMES = (
    "1. Strategy Call Scheduled",
    "2. Unqualified",
    "3. Follow Up < 10 Days",
    None,
    "5. Long Term Follow Up",
    "6. No Show",
    "7. Reschedule",
    "8. Cancel",
)
PROSPECTING_OUTCOMES = (
    "1. Triage Booked",
    "2. Strategy Call Scheduled",
    "3. Follow Up",
    "4. Unqualified",
    "5. Inaccurate Contact",
    "6. Not Interested",
    None,
    "2. Strategy Call Scheduled",
)
STRATEGY_OUTCOMES = (
    "1. Follow Up",
    "2. Admin Cancel",
    "3. Cancel- Not Interested",
    "4. No Show",
    "5. Reschedule",
    "6. Sale",
    "7. Lost",
    "8. Cancel- Nurture",
)
FOLLOW_UP_OUTCOMES = (
    "1. Follow Up",
    "2. Cancel- No Longer Interested",
    "3. No Show",
    "4. Reschedule",
    "5. Sale",
    "6. Lost",
    "7. Cancel- Nurture",
    None,
)
OBJECTIONS = (
    "Money",
    "Fear",
    "Hung Up",
    "Logistical",
    "No Objection",
    "Other Coaches",
    "Partner",
    "Think About It",
    "Time",
    "Trust",
    "Value",
    "Wasn't Looking For What We Offered",
    "No Show",
)
DOMAINS = (
    "staff.example",
    "Staff.Example",
    "agency.test",
    "Agency.test",
    "saff.example",
    "setters.test",
)
# Types of the catalog document and the names of their fields.
CORE_TYPES = (
    ("actitype_0", "0) Pipeline Update", False, ("Pipeline Note",)),
    ("actitype_1", "1) Prospecting Activity", False, ("Setter", "Prospecting Call Outcome")),
    ("actitype_2", "2) Prospecting Follow Up", False, ("Setter", "Prospecting Call Outcome")),
    ("actitype_3", "3) Triage Call", False, ("Setter", "Triage Call Outcome", "Objections Faced?")),
    ("actitype_4", "4) Triage Call Follow Up", False, ("Setter", "Triage Call Outcome")),
    (
        "actitype_5",
        "5) Strategy Call",
        False,
        (
            "Setter",
            "Closer",
            "Strategy Call Outcome",
            "Offer Presented",
            "Contract Value",
            "Objections Faced?",
        ),
    ),
    (
        "actitype_6",
        "6) Strategy Call Follow Up",
        False,
        (
            "Setter",
            "Closer",
            "Strategy Call Outcome",
            "Follow Up Call Outcome",
            "Offer Presented",
            "Contract Value",
            "Objections Faced?",
        ),
    ),
    (
        "actitype_7",
        "7) New Sale",
        False,
        (
            "Setter",
            "Closer",
            "Sales Type",
            "Contract Value",
            "Cash Collected",
            "Program",
            "Date of Sale",
        ),
    ),
    (
        "actitype_8",
        "8) New Sale [Custom Payment Plan]",
        False,
        (
            "Setter",
            "Closer",
            "Sales Type",
            "Contract Value",
            "Cash Collected",
            "Program",
            "Date of Sale",
        ),
    ),
    ("actitype_9", "Backend Sale Pitch [ARCHIVED]", True, ("Setter",)),
)
FIRST_SNAPSHOT = "2024-01-10"
SNAPSHOTS = 3
#: Rows of a given table that one task turns into raw rows.
ROWS_PER_TASK = 20_000


def field_id(name: str) -> str:
    return "cf_" + "".join(ch for ch in name.lower() if ch.isalnum())


def pieces(spark: SparkSession, sf_dir: str, table: str) -> int:
    """Tasks that read a table: as many for each core as its rows ask for, and one at least."""
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    cores = spark.sparkContext.defaultParallelism
    return cores * max(1, math.ceil(rows / (ROWS_PER_TASK * cores)))


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table, dealt evenly to its tasks.

    The splits of a file say little: a row group is read by one task, however many splits it
    spans, and a row here becomes several records of a hundred times its stored size.
    """
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return rows.repartition(pieces(spark, sf_dir, table))


def _pick(values: Sequence[str | None], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _each_snapshot(rows: DataFrame) -> DataFrame:
    return rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(SNAPSHOTS - 1))))


def _snapshot_time() -> Column:
    first = F.lit(f"{FIRST_SNAPSHOT} 13:00:00").cast("timestamp_ntz")
    return first + F.make_dt_interval(F.col("k"))


def _object_row(text: Column, unusable: Column | None = None) -> Column:
    """Raw row holding pseudo-JSON as text; unusable rows lack JSON_OBJECT."""
    stamp = F.date_format("insert_date", "yyyy-MM-dd HH:mm:ss")
    row = F.to_json(F.struct(stamp.alias("INSERT_DATE"), text.alias("JSON_OBJECT")))
    if unusable is None:
        return row
    other = F.to_json(F.struct(stamp.alias("INSERT_DATE"), F.lit(1).alias("other")))
    return F.when(unusable, other).otherwise(row)


def _quoted(pairs: dict[str, Column]) -> Column:
    """{'key': 'value', ...} without the missing values and without escaping."""
    items = [F.concat(F.lit(f"'{key}': '"), value, F.lit("'")) for key, value in pairs.items()]
    return F.concat(F.lit("{"), F.concat_ws(", ", *items), F.lit("}"))


def lead_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_data`` with the activity of one event, sometimes with a note beside it.

    A text is made for each content of an event, not for each snapshot.
    """
    events = _read(spark, sf_dir, "events").withColumn("first_text", F.to_json(_records(0)))
    changed = F.when(_changes(), F.to_json(_records(1)))
    rows = _each_snapshot(events.withColumn("last_text", F.coalesce(changed, "first_text")))
    text = F.when(F.col("k") == SNAPSHOTS - 1, F.col("last_text")).otherwise(F.col("first_text"))
    return _dated(rows.withColumn("insert_date", _activity_time()), text)


def lead_activities_by(spark: SparkSession, sf_dir: str, batch: Column) -> DataFrame:
    """The rows of ``lead_activities`` with ``batch``, made of ``insert_date``; each batch in one task.

    What is shuffled are events: a text of a hundred times their size is made where it is written.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = _each_snapshot(events).withColumn("insert_date", _activity_time()).withColumn("batch", batch)
    gathered = rows.repartition("batch").sortWithinPartitions("batch")
    changed = (F.col("k") == SNAPSHOTS - 1) & _changes()
    return _dated(gathered, F.when(changed, F.to_json(_records(1))).otherwise(F.to_json(_records(0))), "batch")


def _changes() -> Column:
    """Whether the last snapshot of an event differs."""
    return F.col("event_id") % 10 == 0


def _activity_time() -> Column:
    return F.col("ts").cast("date").cast("timestamp_ntz") + F.make_dt_interval(F.col("k") + 1, F.lit(13))


def _dated(rows: DataFrame, text: Column, *kept: str) -> DataFrame:
    """Raw rows of the records in ``text``, as ``to_json`` writes both: without a missing date."""
    stamp = F.date_format("insert_date", "yyyy-MM-dd HH:mm:ss")
    dated = F.coalesce(F.concat(F.lit('"INSERT_DATE":"'), stamp, F.lit('",')), F.lit(""))
    raw = F.concat(F.lit("{"), dated, F.lit('"data":'), text, F.lit("}"))
    return rows.select(raw.alias("raw_data"), "insert_date", *kept)


def _records(changed: int) -> Column:
    """The records of an event before (0) or after (1) its change."""
    e, u = F.col("event_id"), F.col("user_id")
    kind = F.col("event_type")
    outcome = (F.floor(e / 4) + changed) % 8
    twin = e % 4 == 0
    strategy, sale = kind == "click", kind == "purchase"
    custom = kind != "error"
    number = (
        F.when(kind == "view", 3).when(kind == "signup", 1).when(strategy, 5).when(sale, 7)
    ) + F.when(twin, 1).otherwise(0)
    money = F.floor(F.col("value") * 100 + 0.5) + 100 * changed
    contract = (
        F.when(e % 17 == 0, "n/a")
        .when(e % 19 == 0, "")
        .when(e % 23 == 0, "0")
        .when(e % 29 == 0, "12d")
        .otherwise(money.cast("string"))
    )
    offer = F.when(e % 3 == 0, "Yes").when(e % 3 == 1, "No")
    real_sale = sale & (e % 5 != 0)
    objections = F.array(_pick(OBJECTIONS, e % 13), _pick(OBJECTIONS, F.floor(e / 13) % 13))
    fields = {
        "Setter": F.when(custom, _person((e * 7 + u) % 53)),
        "Closer": F.when(strategy | sale, _person((e * 5 + u) % 41)),
        "Triage Call Outcome": F.when(kind == "view", _pick(TRIAGE_OUTCOMES, outcome)),
        "Prospecting Call Outcome": F.when(
            kind == "signup", _pick(PROSPECTING_OUTCOMES, outcome)
        ),
        "Strategy Call Outcome": F.when(
            strategy & ~twin & (e % 11 != 0), _pick(STRATEGY_OUTCOMES, outcome)
        ),
        "Follow Up Call Outcome": F.when(strategy & twin, _pick(FOLLOW_UP_OUTCOMES, outcome)),
        "Offer Presented": F.when(strategy, offer),
        "Contract Value": F.when((strategy & (e % 3 == 0)) | real_sale, contract),
        "Objections Faced?": F.when(
            (strategy & (e % 2 == 1)) | ((kind == "view") & ~twin & (e % 6 == 1)), objections
        ),
        "Sales Type": F.when(real_sale & (e % 3 != 0), "New Sale"),
        "Cash Collected": F.when(
            real_sale & (e % 13 != 0),
            F.when(e % 7 == 0, "n/a").otherwise(
                F.concat(F.floor(money / 2).cast("string"), F.lit(".50"))
            ),
        ),
        "Program": F.when(sale, F.concat(F.lit("Program "), e % 3)),
        "Date of Sale": F.when(real_sale, F.date_format("ts", "yyyy-MM-dd")),
        "Legacy Note": F.when(strategy & (e % 25 == 1), "kept"),
        "Unknown": F.when(custom & (e % 9 == 0), "not in the catalog"),
    }
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    lead = F.concat(F.lit("lead_"), u)
    actor = _person(e % 43)

    def record(is_note: bool) -> Column:
        def given(value: Column) -> Column:
            return F.when(F.lit(not is_note), value)

        identity = F.concat(F.lit("note_" if is_note else "acti_"), e)
        columns = [
            F.when((e % 997 != 5) | F.lit(is_note), identity).alias("id"),
            lead.alias("lead_id"),
            at.alias("activity_at"),
            (F.lit("Note") if is_note else F.when(custom, "CustomActivity").otherwise("SMS")).alias(
                "_type"
            ),
            actor.alias("user_id"),
            given(F.concat(F.lit("actitype_"), number)).alias("custom_activity_type_id"),
            F.when(F.lit(is_note), 'Prospect\'s "note"').alias("note"),
        ]
        named = [given(v).alias(f"custom.{field_id(name)}") for name, v in fields.items()]
        return F.struct(*columns, *named)

    # Without a lambda, whose arguments Spark does not compile.
    return F.when(e % 3 == 0, F.array(record(False), record(True))).otherwise(F.array(record(False)))


def custom_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog snapshots: one core document and one document per part."""
    parts = _each_snapshot(_read(spark, sf_dir, "part")).withColumn("insert_date", _snapshot_time())
    p = F.col("p_partkey")
    renamed = (F.col("k") == 2) & (p % 10 == 0)
    name = F.concat(F.lit("Part's "), F.col("p_type"), F.when(renamed, " v2").otherwise(""))

    def field(identity: Column, field_name: Column, kind: str) -> Column:
        return _quoted({"id": identity, "name": field_name, "type": F.lit(kind)})

    head = _quoted({"id": F.concat(F.lit("actitype_p"), p), "name": name})
    text = F.concat(
        F.lit("{'data': ["),
        F.rtrim(head, F.lit("}")),
        F.lit(", 'is_archived': "),
        (p % 7 == 0).cast("string"),
        F.lit(", 'fields': ["),
        field(F.concat(F.lit("cf_p"), p), F.col("p_name"), "text"),
        F.lit(", "),
        field(F.lit(field_id("Setter")), F.lit("Setter"), "user"),
        F.lit("]}]}"),
    )
    cut = (F.col("k") == 2) & (p % 40 == 39)
    document = F.when(cut, text.substr(F.lit(1), F.length(text) - 10)).otherwise(text)
    of_parts = parts.select(_object_row(document).alias("raw_data"), "insert_date")

    core = _each_snapshot(spark.range(1)).withColumn("insert_date", _snapshot_time())
    core_text = F.when(F.col("k") == 0, _core_document(legacy=True)).otherwise(
        _core_document(legacy=False)
    )
    return of_parts.unionByName(
        core.select(_object_row(core_text).alias("raw_data"), "insert_date")
    )


def _core_document(legacy: bool) -> str:
    types = []
    for identity, name, archived, names in CORE_TYPES:
        if legacy and identity == "actitype_5":
            names = (*names, "Legacy Note")
        fields = ", ".join(
            f"{{'id': '{field_id(n)}', 'name': '{n}', 'type': '{field_type(n)}'}}" for n in names
        )
        types.append(
            f"{{'id': '{identity}', 'name': '{name}', "
            f"'is_archived': {str(archived).lower()}, 'fields': [{fields}]}}"
        )
    return "{'data': [" + ", ".join(types) + "]}"


def field_type(name: str) -> str:
    if name in ("Setter", "Closer"):
        return "user"
    return "choices" if "Outcome" in name or "Objections" in name else "text"


def _person(number: Column) -> Column:
    """The id of a user, or of one who left and is in no snapshot."""
    prefix = F.when(number % 12 == 11, "former_").otherwise("user_")
    return F.concat(prefix, number)


def crm_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User snapshots as pseudo-JSON; some rows are cut off, empty or of another shape."""
    rows = _each_snapshot(_read(spark, sf_dir, "customer")).withColumn(
        "insert_date", _snapshot_time()
    )
    n, k = F.col("c_custkey"), F.col("k")
    changed = (k == 2) & (n % 10 == 3)
    role = (
        F.when(n % 5 == 1, "setter").when(n % 5 == 2, "closer").when(n % 5 == 3, "manager").when(
            n % 5 == 4, ""
        )
    )
    user = _quoted(
        {
            "id": F.concat(F.lit("user_"), n),
            "email": F.when(
                n % 9 != 8, F.concat(F.lit("agent"), n, F.lit("@"), _pick(DOMAINS, n % 6))
            ),
            "first_name": F.when(n % 13 != 12, F.when(n % 6 == 1, 'Al "Ace"').otherwise("Agent")),
            "last_name": F.when(n % 4 == 0, F.concat(F.lit("O'Hara "), n)).otherwise(
                F.concat(F.lit("Smith "), n)
            ),
            "role": role,
            "status": F.when(changed, "inactive").otherwise("active"),
        }
    )
    assistant = _quoted(
        {
            "id": F.concat(F.lit("user_"), n, F.lit("a")),
            "email": F.concat(F.lit("desk"), n, F.lit("@desk.test")),
            "status": F.lit("active"),
        }
    )
    both = F.when(n % 5 == 0, F.concat(user, F.lit(", "), assistant)).otherwise(user)
    text = F.concat(F.lit("{'data': ["), both, F.lit("]}"))
    cut = (k == 1) & (n % 50 == 49)
    document = (
        F.when((k == 2) & (n % 61 == 60), F.lit(None))
        .when(cut, text.substr(F.lit(1), F.length(text) - 10))
        .otherwise(text)
    )
    unusable = (k == 0) & (n % 71 == 70)
    return rows.select(_object_row(document, unusable).alias("raw_data"), "insert_date")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        LEAD_ACTIVITIES: lead_activities(spark, sf_dir),
        CUSTOM_ACTIVITIES: custom_activities(spark, sf_dir),
        CRM_USERS: crm_users(spark, sf_dir),
    }


def bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The raw tables as they look once loaded: ``payload, insert_date``."""
    return {
        table: rows.select(F.try_parse_json("raw_data").alias("payload"), "insert_date")
        for table, rows in raw_tables(spark, sf_dir).items()
    }
