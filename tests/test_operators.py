import json
import random
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from funnelspark.functions import values
from funnelspark.operators import fields, lookup, nested, quarantine
from funnelspark.operators.latest import latest_per_key
from funnelspark.operators.upsert import UpsertRule, read_table, upsert_table
from funnelspark.sources import generations
from funnelspark.sources.storage import new_folder

RULE = UpsertRule(keys=("a", "b"), updated=("v",))
COLUMNS = "a string, b string, v string, at int, md5_hash string"


def tuples(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_numbers(spark):
    cases = {
        " 6000 ": 6000.0,
        "1e3": 1000.0,
        ".5": 0.5,
        "5.": 5.0,
        "-3.2": -3.2,
        "12d": None,
        "NaN": None,
        "Infinity": None,
        "$6": None,
        "": None,
        "n/a": None,
        None: None,
    }
    frame = spark.createDataFrame([(t,) for t in cases], "t string")
    rows = frame.select("t", values.to_number(F.col("t")).alias("n")).collect()
    assert {row.t: row.n for row in rows} == cases


def test_dates_and_rates(spark):
    row = (
        spark.sql("SELECT timestamp_ntz'2024-03-06 10:00:00' AS t, 1 AS part, 0 AS none, 16 AS all")
        .select(
            values.week_of(F.col("t")).alias("week"),
            values.month_of(F.col("t")).alias("month"),
            values.percent(F.col("part"), F.col("all")).alias("rate"),
            values.percent(F.col("part"), F.col("none")).alias("undefined"),
            values.wall_clock(F.lit("2024-03-06T10:00:00.5+02:00")).alias("clock"),
            values.ends_with_any(F.lit("X@Staff.Example"), ["staff.example"]).alias("inside"),
            values.ends_with_any(F.lit(None).cast("string"), ["staff.example"]).alias("missing"),
        )
        .first()
    )
    assert row.week == date(2024, 3, 4) and row.month == date(2024, 3, 1)
    assert row.rate == 6.3 and row.undefined is None
    assert row.clock == datetime(2024, 3, 6, 10, 0, 0, 500000)
    assert row.inside is True and row.missing is False


def test_latest_puts_missing_times_first(spark):
    rows = [("x", 1, "old"), ("x", None, "unknown"), ("y", 1, "old"), ("y", 2, "new")]
    frame = spark.createDataFrame(rows, "k string, t int, v string")
    latest = latest_per_key(frame, ["k"], [F.col("t").desc_nulls_first()])
    assert tuples(latest.select("k", "v")) == [("x", "unknown"), ("y", "new")]


def test_latest_limits_groups_before_the_shuffle(spark):
    frame = spark.range(1000).selectExpr("id % 2 AS k", "id AS t")
    latest = latest_per_key(frame, ["k"], [F.col("t").desc_nulls_first()])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert tuples(latest) == [(0, 998), (1, 999)]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_lookup_equals_broadcast(spark, monkeypatch, how):
    # A third of the records share one key, another third have none.
    records = spark.range(3000).selectExpr(
        "id", "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN NULL ELSE 'k' || id END AS k"
    )
    dim = spark.range(2000).selectExpr("'k' || id AS k", "id * 2 AS v")
    dim = dim.unionByName(spark.sql("SELECT 'hot' AS k, -1L AS v"))
    expected = tuples(lookup.lookup_join(records, dim, ["k"], how, spread=["id"]))
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 100)
    assert not lookup.fits_broadcast(dim)
    salted = lookup.lookup_join(records, dim, ["k"], how, spread=["id"])
    assert "SortMergeJoin" in salted._jdf.queryExecution().executedPlan().toString()
    assert tuples(salted) == expected
    assert len(expected) == (3000 if how == "left" else 1000 + 666)


def test_only_hot_keys_are_salted(spark):
    """A key with a third of the records, and as many without one, spread within twice the median."""
    records = spark.range(30_000).selectExpr(
        "id", "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN NULL ELSE 'k' || id END AS k"
    )
    dim = records.where("k IS NOT NULL").select("k").distinct()
    hot = lookup.hot_keys(records, ["k"], 8)
    assert len(hot) == 1
    left, right = lookup.salted(records, dim, ["k"], ["id"], hot, 8 * lookup.PIECES)
    assert right.count() == dim.count() + sum(hot.values()) - 1
    dealt = left.repartition(8, "k", "_salt").groupBy(F.spark_partition_id()).count().collect()
    sizes = sorted(row["count"] for row in dealt)
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]


def test_lookup_bound_counts_bytes(spark, monkeypatch):
    dim = spark.range(10).selectExpr("repeat('x', 100) AS text")
    assert lookup.fits_broadcast(dim)
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 999)
    assert not lookup.fits_broadcast(dim)


def upserted(spark, batches, rule=RULE):
    """The table after upserting the batches one by one, stamped 1, 2, ..."""
    path = new_folder(spark, "test")
    for run, rows in enumerate(batches, start=1):
        frame = spark.createDataFrame(rows, COLUMNS)
        schema = upsert_table(path, frame, rule, F.lit(str(run)), buckets=3)
    return tuples(read_table(spark, path, schema))


def test_upsert_replaces_only_listed_columns(spark):
    first = [("l", "1", "old", 1, "h1"), ("l", "2", "same", 1, "h2")]
    second = [("l", "1", "new", 9, "h9"), ("l", "2", "same", 9, "h2"), ("l", "3", "add", 9, "h3")]
    assert upserted(spark, [first, second]) == [
        ("l", "1", "new", 1, "h9", "2"),
        ("l", "2", "same", 1, "h2", "1"),
        ("l", "3", "add", 9, "h3", "2"),
    ]


def test_upsert_ignores_older_versions(spark):
    rule = UpsertRule(("a", "b"), ("v",), version="at")
    batches = [
        [("l", "1", "new", 5, "h5")],
        [("l", "1", "old", 4, "h4"), ("l", "2", "add", 4, "h")],
        [("l", "1", "newer", 6, "h6")],
    ]
    assert upserted(spark, batches[:2], rule) == [
        ("l", "1", "new", 5, "h5", "1"),
        ("l", "2", "add", 4, "h", "2"),
    ]
    assert upserted(spark, batches, rule)[0] == ("l", "1", "newer", 6, "h6", "3")


def test_unchanged_snapshots_advance_the_version(spark):
    """A, then A again, then a late B: A is the newest."""
    rule = UpsertRule(("a", "b"), ("v",), version="at")
    batches = [
        [("l", "1", "A", 1, "hA")],
        [("l", "1", "A", 3, "hA")],
        [("l", "1", "B", 2, "hB")],
    ]
    assert upserted(spark, batches, rule)[0][2] == "A"
    newest = [("l", "1", "B", 4, "hB")]
    assert upserted(spark, [*batches, newest], rule)[0][2:4] == ("B", 4)


def test_upsert_table_rewrites_only_touched_buckets(spark):
    path = new_folder(spark, "test")
    rows = [("l", str(i), f"v{i}", i, f"h{i}") for i in range(100)]
    rows += [(None, "x", "no key", 0, "h"), ("l", None, "no key", 0, "h")]
    source = spark.createDataFrame(rows, COLUMNS)
    stamp = [F.lit(s) for s in ("one", "two", "three")]
    schema = upsert_table(path, source, RULE, stamp[0])

    def folders():
        return set(generations.newest(spark, path).pieces["rows"].items())

    first = folders()
    assert read_table(spark, path, schema).count() == 100
    upsert_table(path, source, RULE, stamp[1])
    assert folders() == first  # nothing changed, nothing written
    changed = spark.createDataFrame([("l", "7", "new", 0, "h-new")], COLUMNS)
    # Another bucket count must not duplicate the stored row.
    upsert_table(path, changed, RULE, stamp[2], buckets=5)
    assert len(folders() - first) == len(first - folders()) == 1
    table = read_table(spark, path, schema)
    assert table.count() == table.select("a", "b").distinct().count() == 100
    assert tuples(table.where("update_date <> 'one'").select("b", "v", "at")) == [("7", "new", 7)]


def leaves_by_hand(node, path=""):
    if isinstance(node, dict):
        for key, child in node.items():
            yield from leaves_by_hand(child, f"{path}.{key}" if path else key)
    elif isinstance(node, list):
        for child in node:
            yield from leaves_by_hand(child, path)
    elif isinstance(node, str):
        yield path, node


def random_tree(rng, depth):
    if depth == 0 or rng.random() < 0.3:
        return rng.choice(["1. x", "text", 6000.5, 7, True, None, [], {}])
    if rng.random() < 0.5:
        return [random_tree(rng, depth - 1) for _ in range(rng.randrange(4))]
    return {f"k.{i}": random_tree(rng, depth - 1) for i in range(rng.randrange(4))}


def test_string_leaves_of_random_trees(spark):
    rng = random.Random(3)
    trees = [random_tree(rng, 5) for _ in range(300)]
    frame = spark.createDataFrame([(json.dumps(t),) for t in trees], "t string")
    found = nested.string_leaves(frame.selectExpr("parse_json(t) AS d"), "d").collect()
    expected = Counter(leaf for tree in trees for leaf in leaves_by_hand(tree))
    assert Counter((row.key_path, row.value) for row in found) == expected


@pytest.mark.parametrize("depth", [6, 7, 20])
def test_string_leaves_of_any_depth(spark, depth):
    text = '{"a":' * depth + '["x", 1, {}, []]' + "}" * depth
    deep = spark.createDataFrame([(text,), ('"top"',), (None,)], "t string")
    found = nested.string_leaves(deep.selectExpr("parse_json(t) AS d"), "d").collect()
    assert sorted(map(tuple, found)) == [("", "top"), (".".join("a" * depth), "x")]


def test_explode_items(spark):
    frame = spark.createDataFrame(
        [(1, '{"data":[1,2]}'), (2, '{"data":null}'), (3, "{}"), (4, None), (5, '{"data":[]}')],
        "i int, t string",
    ).selectExpr("i", "parse_json(t) AS d")
    items = nested.explode_items(frame, F.try_variant_get("d", "$.data", "variant"), "item")
    assert [row.i for row in items.collect()] == [1, 1]


def test_columns_equal_grouped_fact(spark, silver):
    """Reading fields off the record gives what grouping the fact rows gives."""
    types = ("5) Strategy Call", "7) New Sale")
    columns = {"closer": "Closer", "money": "Contract Value", "nothing": "No Such Field"}
    wide = fields.fields_as_columns(silver.activities, silver.fields, types, columns, True)
    fact = fields.resolved_fields(silver.activities, silver.fields, True)
    grouped = (
        fact.where(F.col("custom_activity_type_name").isin(*types))
        .groupBy("lead_id", "activity_id", "activity_at")
        .agg(
            *[
                F.max(F.when(F.col("field_name") == name, F.col("outcome_value"))).alias(column)
                for column, name in columns.items()
            ]
        )
    )
    assert tuples(wide) == tuples(grouped)


def test_two_fields_of_one_name_give_the_larger_value(spark):
    activities = spark.sql(
        """SELECT 'l' AS lead_id, 'a' AS activity_id, timestamp_ntz'2024-01-01' AS activity_at,
             'CustomActivity' AS record_type, 't' AS type_id, 'u' AS user_id,
             map('custom.f1', 'low', 'custom.f2', 'more', 'custom.f3', NULL) AS custom_fields
           UNION ALL SELECT 'l', 'b', NULL, 'CustomActivity', 't', 'u', map('custom.zz', '1')"""
    )
    dictionary = spark.createDataFrame(
        [("t", "T", "f1", "Name"), ("t", "T", "f2", "Name"), ("t", "T", "f3", "Other")],
        "custom_activity_type_id string, custom_activity_type_name string, field_id string,"
        " field_name string",
    )
    wide = fields.fields_as_columns(
        activities, dictionary, ["T"], {"name": "Name", "other": "Other"}, None
    )
    # Activity b has no field of its type.
    assert [tuple(r) for r in wide.drop("activity_at").collect()] == [("l", "a", "more", None)]


def test_quarantine_counts_copies_once_per_run(spark):
    rows = spark.createDataFrame(
        [("t", "{bad"), ("t", "{bad"), ("t", None)], "s string, raw_payload string"
    ).selectExpr(
        "raw_payload", "timestamp_ntz'2024-01-01' AS insert_date", "CAST(NULL AS VARIANT) AS parsed"
    )
    found = quarantine.failures(rows, "t", F.lit("now"))
    nothing = found.limit(0)
    fresh = quarantine.unseen_failures(found, nothing)
    assert tuples(fresh.select("raw_payload", "occurrences")) == [("{bad", 2), (None, 1)]
    assert quarantine.unseen_failures(found, found).count() == 0
    other = found.withColumn("insert_date", F.lit(None).cast("timestamp_ntz"))
    assert quarantine.unseen_failures(other, found).count() == 2


def test_payload_router(spark, bronze_rows):
    rows = bronze_rows(
        [
            ("""{"JSON_OBJECT": "{'data': ['it's']}"}""", "2024-01-01 00:00:00"),
            ('{"JSON_OBJECT": null, "data": [1]}', "2024-01-01 00:00:01"),
            ('{"data": [1]}', "2024-01-01 00:00:02"),
            ('{"other": 1, "more": 2}', "2024-01-01 00:00:03"),
        ]
    )
    routed = quarantine.parse_payload(rows).orderBy("insert_date")
    found = routed.select("shape", F.to_json("parsed").alias("p"), quarantine.payload_keys(F.col("payload")))
    assert [tuple(row) for row in found.collect()] == [
        ("repair", '{"data":["it\'s"]}', "JSON_OBJECT"),
        ("repair", None, "JSON_OBJECT,data"),
        ("pass_through", '{"data":[1]}', "data"),
        ("unrecognized", None, "more,other"),
    ]
