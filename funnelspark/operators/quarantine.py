"""Separating rows that parse from rows that do not."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.functions.pseudo_json import repair_quotes, whole_document, wrapped_document

PARSE_ERROR = "no JSON document after repair"


def parse_repaired(rows: DataFrame, text: Column) -> DataFrame:
    """Add ``raw_payload``, ``repaired`` and ``parsed`` (NULL when hopeless)."""
    repaired = rows.withColumn("raw_payload", text).withColumn(
        "repaired", repair_quotes(F.col("raw_payload"))
    )
    wrapped = repaired.withColumn("_wrapped", wrapped_document(F.col("repaired")))
    return wrapped.withColumn("parsed", whole_document(F.col("_wrapped"))).drop("_wrapped")


def parsed_rows(rows: DataFrame) -> DataFrame:
    return rows.where("parsed IS NOT NULL")


def failures(
    rows: DataFrame, source_table: str, run_ts: Column, detail: str = PARSE_ERROR
) -> DataFrame:
    return rows.where("parsed IS NULL").select(
        F.lit(source_table).alias("source_table"),
        "raw_payload",
        "insert_date",
        F.lit(detail).alias("error_detail"),
        run_ts.alias("failed_at"),
    )


def no_data(rows: DataFrame, document: str) -> DataFrame:
    """Rows whose document holds no ``data``; they look like failures, ``parsed`` NULL."""
    missing = F.try_variant_get(document, "$.data", "variant").isNull()
    return rows.where(F.col(document).isNotNull() & missing).withColumn("parsed", F.lit(None))


_FAILURE = ("source_table", "insert_date", "error_detail")


def unseen_failures(found: DataFrame, recorded: DataFrame) -> DataFrame:
    """Failures not recorded by an earlier run, so a repeated run adds nothing.

    Equal failures are one record with their number, ``occurrences``, in the run that met
    them first; failures without text are told apart by source, time and reason.
    """
    digest = F.md5("raw_payload").alias("_digest")
    once = found.groupBy(*_FAILURE, digest).agg(
        F.any_value("raw_payload").alias("raw_payload"),
        F.min("failed_at").alias("failed_at"),
        F.count("*").alias("occurrences"),
    )
    left = once.alias("found")
    right = recorded.select(*_FAILURE, digest).alias("seen")
    same = F.lit(True)
    for name in (*_FAILURE, "_digest"):
        same = same & F.col(f"found.{name}").eqNullSafe(F.col(f"seen.{name}"))
    return left.join(right, same, "left_anti").drop("_digest")


def payload_shape(payload: Column) -> Column:
    """Which of the two known layouts a raw payload has; a JSON null counts as given."""

    def has(key: str) -> Column:
        return F.try_variant_get(payload, f"$.{key}", "variant").isNotNull()

    return F.when(has("JSON_OBJECT"), "repair").when(has("data"), "pass_through").otherwise(
        "unrecognized"
    )


def payload_keys(payload: Column) -> Column:
    return F.array_join(F.array_sort(F.map_keys(payload.try_cast("map<string,variant>"))), ",")


def parse_payload(rows: DataFrame) -> DataFrame:
    """Route raw payloads: repaired text, valid data as it is, or NULL."""
    routed = rows.withColumn("shape", payload_shape(F.col("payload")))
    text = F.try_variant_get("payload", "$.JSON_OBJECT", "string")
    parsed = parse_repaired(routed, F.when(F.col("shape") == "repair", text))
    return parsed.withColumn(
        "parsed",
        F.when(F.col("shape") == "pass_through", F.col("payload")).otherwise(F.col("parsed")),
    )


def failure_samples(rows: DataFrame, limit: int = 3) -> DataFrame:
    """The first failures with the text around the error, for a person to read."""

    def error_context(texts: pd.Series) -> pd.DataFrame:
        found = []
        for text in texts:
            position = 0
            try:
                json.loads(text)
            except json.JSONDecodeError as error:
                position = error.pos
            found.append((position, text[max(0, position - 80) : position + 80]))
        return pd.DataFrame(found, columns=["position", "context"])

    # Only the parser of the Python runtime reports a position; it sees the sample alone.
    context = F.pandas_udf(error_context, "struct<position int, context string>")
    first = (
        rows.where("parsed IS NULL AND repaired IS NOT NULL")
        .orderBy("insert_date", "raw_payload")
        .limit(limit)
    )
    return first.withColumn("_at", context("repaired")).select(
        "insert_date",
        F.length("repaired").alias("text_length"),
        F.col("_at.position").alias("position"),
        F.col("_at.context").alias("context"),
    )
