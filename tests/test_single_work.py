"""Work on a text or payload that is done once, and only where it is needed."""

import random

from conftest import SMALLEST
from pyspark.sql import functions as F
from test_pseudo_json import repaired_by_hand

from funnelspark.functions.pseudo_json import repair_quotes
from funnelspark.plans import silver
from funnelspark.sources import crm


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_texts_without_double_quotes_are_not_taken_apart(spark):
    rng = random.Random(8)
    alphabet = "' a,:}][{\\\n\t\r$é😀"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(0, 25))) for _ in range(20_000)]
    texts += [None, "", "'", "''", "' '", "'a' '", "{'a': 'it's'", "'open  ", "'a'  ", "a '  ", "'" * 5, "'$1\\'"]
    texts.append("{'a': '" + "it's so " * 50_000 + "'}")
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select(
        "i", repair_quotes(F.col("t")).alias("r")
    )
    assert [row.r for row in rows.orderBy("i").collect()] == [repaired_by_hand(t) for t in texts]
    plan = plan_of(rows)
    assert plan.index("CASE WHEN Contains(") < plan.index("regexp_extract_all(")


def test_data_is_taken_out_of_a_payload_once(spark):
    rows = crm.bronze_tables(spark, SMALLEST)["lead_activites_raw"]
    assert plan_of(silver.flattened_activities(rows)).count("$.data") == 1
