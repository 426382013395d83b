"""Authored claims checked against facts of each snapshot, with the last success carried forward."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def reason(value: Column, low: Column, high: Column, equals: Column) -> Column:
    return (
        F.when(value.isNull(), "missing").when(value < low, "below minimum").when(value > high, "above maximum")
        .when(~value.eqNullSafe(equals) & equals.isNotNull(), "not equal")
    )


def evaluate(claims: DataFrame, facts: DataFrame) -> DataFrame:
    """claims(claim, entity, low, high, equals), facts(snapshot, entity, value) ->
    (claim, snapshot, status, reason, last_success): a claim without a fact in a snapshot fails as missing."""
    captures = [r["snapshot"] for r in facts.select("snapshot").distinct().orderBy("snapshot").collect()]  # one row per capture
    wanted = claims.withColumn("snapshot", F.explode(F.array(*[F.lit(c) for c in captures])))
    why = reason(F.col("value"), F.col("low"), F.col("high"), F.col("equals"))
    rows = wanted.join(facts, ["snapshot", "entity"], "left").select("claim", "snapshot", why.alias("reason"))
    order = Window.partitionBy("claim").orderBy("snapshot").rowsBetween(Window.unboundedPreceding, 0)
    last = F.max(F.when(F.col("reason").isNull(), F.col("snapshot"))).over(order)
    return rows.select("claim", "snapshot", F.when(F.col("reason").isNull(), "ok").otherwise("failed").alias("status"), "reason", last.alias("last_success"))
