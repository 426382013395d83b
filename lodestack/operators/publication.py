"""Entry points of topics: which partition is one, rolling it over, and the order in which partitions are published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestack.session import cut


def active(parts: DataFrame) -> DataFrame:
    """parts(topic, id, ordinal, sealed, entrypoint) -> (topic, id): the open partition that is the first one or an entry point; each topic has just one."""
    is_front = ~F.col("sealed") & ((F.col("ordinal") == 0) | F.col("entrypoint"))
    fronts = cut(parts.groupBy("topic").agg(F.count_if(is_front).alias("n"), F.max(F.when(is_front, F.col("id"))).alias("id")))
    wrong = [r["topic"] for r in fronts.filter("n != 1").limit(5).collect()]
    if wrong:
        raise ValueError(f"not just one active entry point: {wrong}")
    return fronts.select("topic", "id")


def rollover(parts: DataFrame, requested: DataFrame, name: Column) -> DataFrame:
    """parts with the fronts of requested(topic) sealed and a new front each, one ordinal further; ``name`` makes its id of topic and ordinal."""
    fronts = active(parts)
    strange = [r["topic"] for r in requested.join(fronts, "topic", "left_anti").limit(5).collect()]
    if strange:
        raise ValueError(f"no such topics: {strange}")
    wanted = requested.select("topic").distinct()
    retiring = fronts.join(wanted, "topic").select("topic", "id", F.lit(True).alias("retires"))
    kept = parts.join(retiring, ["topic", "id"], "left").withColumn("sealed", F.col("sealed") | F.coalesce("retires", F.lit(False))).select(*parts.columns)
    last = parts.join(wanted, "topic", "left_semi").groupBy("topic").agg((F.max("ordinal") + 1).alias("ordinal"))
    fresh = last.select("topic", name.alias("id"), "ordinal", F.lit(False).alias("sealed"), F.lit(True).alias("entrypoint"))
    taken = [r["id"] for r in fresh.join(parts.select("id"), "id", "left_semi").limit(5).collect()]
    if taken:
        raise ValueError(f"ids that are taken: {taken}")
    return kept.unionByName(fresh.select(*parts.columns))


def groups(parts: DataFrame, before: DataFrame, hub) -> DataFrame:
    """(id, rank): what others need first (0: partitions, 1: fronts, 2: retiring fronts, 3: the hub's new front); the hub's old front selects and has none.

    ``before`` are the fronts (topic, id) until now.
    """
    now = active(parts).select("topic", F.col("id").alias("front"))
    rows = parts.select("topic", "id").join(now, "topic").join(before.select("topic", F.col("id").alias("old")), "topic", "left")
    is_front, retires = F.col("id") == F.col("front"), (F.col("id") == F.col("old")) & (F.col("old") != F.col("front"))
    is_hub = F.col("topic") == F.lit(hub)
    control = is_hub & (F.col("id") == F.coalesce("old", "front"))
    rank = F.when(is_hub & is_front, 3).when(F.coalesce(retires, F.lit(False)), 2).when(is_front, 1).otherwise(0)
    return rows.filter(~control).select("id", rank.alias("rank"))
