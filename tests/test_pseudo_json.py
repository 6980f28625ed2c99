import json
import random

from conftest import SMALLEST
from pyspark.sql import functions as F

from funnelspark.functions.pseudo_json import repair_quotes, whole_document, wrapped_document


def repaired_by_hand(text):
    """Split at quotes, then decide piece by piece whether a quote closes."""
    if text is None:
        return None
    out, inside = [], False
    for position, char in enumerate(text):
        if char != "'":
            out.append('\\"' if inside and char == '"' else char)
            continue
        if not inside:
            inside = True
            out.append('"')
            continue
        rest = text[position + 1 :].lstrip(" \t\n\r")
        inside = bool(rest) and rest[0] not in ",}]:"
        out.append("'" if inside else '"')
    return "".join(out)


def repaired(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = frame.select("i", repair_quotes(F.col("t")).alias("r")).orderBy("i").collect()
    return [row.r for row in rows]


def test_repair_random_texts(spark):
    rng = random.Random(7)
    alphabet = "'\" a,:}][{\\\n\té"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(0, 30))) for _ in range(20_000)]
    texts += [None, "", "'", "''", "'''", "{'a': 'Prospect's Name', 'b': 'say \"hi\"'}"]
    assert repaired(spark, texts) == [repaired_by_hand(t) for t in texts]


def test_repair_whole_documents(spark):
    rows = spark.read.parquet(f"{SMALLEST}/documents.parquet").select("text").collect()
    texts = [f"{{'data': '{row.text}'}}" for row in rows]
    assert repaired(spark, texts) == [repaired_by_hand(t) for t in texts]


def test_repair_long_text(spark):
    text = "{'a': '" + "it's \"so\" " * 50_000 + "'}"
    assert json.loads(repaired(spark, [text])[0])["a"].startswith("it's \"so\"")


def test_only_whole_documents_parse(spark):
    cases = {
        '{"a":1}': '{"a":1}',
        ' {"a":1}  ': '{"a":1}',
        "[1,2]": "[1,2]",
        '"x"': '"x"',
        "null": "null",
        '{"a":1} trailing': None,
        '{"a":1},{"b":2}': None,
        '{"a":1}], [1': None,
        '{"a":1}] junk': None,
        "": None,
        None: None,
        '{"a":None}': None,
        '{"a":"open': None,
    }
    frame = spark.createDataFrame([(t,) for t in cases], "t string")
    parsed = frame.withColumn("w", wrapped_document(F.col("t"))).select(
        "t", F.to_json(whole_document(F.col("w"))).alias("json")
    )
    assert {row.t: row.json for row in parsed.collect()} == cases
