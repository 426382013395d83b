"""Differences of snapshots: rows with moved pairs removed, and fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def snapshot(old: DataFrame, new: DataFrame) -> DataFrame:
    """old, new(key, revision) -> (key, op): added, removed, changed; a removed and an added row of one revision are a move and drop out."""
    both = old.withColumnRenamed("revision", "a").join(new.withColumnRenamed("revision", "b"), "key", "full")
    op = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").otherwise("changed")
    rows = both.filter("NOT (a <=> b)").select("key", op.alias("op"), F.coalesce("b", "a").alias("revision"))
    # The n-th removed row of a revision pairs with the n-th added one.
    order = Window.partitionBy("revision", "op").orderBy("key")
    numbered = rows.filter("op != 'changed'").withColumn("k", F.row_number().over(order))
    moved = numbered.groupBy("revision", "k").count().filter("count = 2").select("revision", "k")
    stay = numbered.join(moved, ["revision", "k"], "left_anti").select("key", "op")
    return rows.filter("op = 'changed'").select("key", "op").union(stay)


def fields(old: DataFrame, new: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Changed fields of rows in both: keys plus (field, old, new) as text, compared null-safely."""
    pair = F.array(
        *[
            F.struct(F.lit(n).alias("field"), F.col(f"o.{n}").cast("string").alias("old"), F.col(f"n.{n}").cast("string").alias("new"))
            for n in names
        ]
    )
    both = old.alias("o").join(new.alias("n"), [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys])
    rows = both.select(*[F.col(f"n.{k}") for k in keys], F.explode(F.filter(pair, lambda x: ~x["old"].eqNullSafe(x["new"]))).alias("x"))
    return rows.select(*keys, "x.field", "x.old", "x.new")


def topic_counts(changes: DataFrame, topics: DataFrame) -> DataFrame:
    """changes(key, op, topic), topics(topic, comparable) -> (topic, new, changed, removed); nulls for a topic without an earlier capture."""
    n = lambda op: F.count_if(F.col("op") == op)
    counted = changes.groupBy("topic").agg(n("added").alias("new"), n("changed").alias("changed"), n("removed").alias("removed"))
    told = lambda c: F.when(F.col("comparable"), F.coalesce(c, F.lit(0))).alias(c)
    return topics.join(counted, "topic", "left").select("topic", *(told(c) for c in ("new", "changed", "removed")))


def append_new(log: DataFrame, entry: DataFrame, snapshot_col: str) -> DataFrame:
    """Append an entry unless its snapshot is in the log already."""
    return log.unionByName(entry.join(log.select(snapshot_col).distinct(), snapshot_col, "left_anti"))


def detail(runs: DataFrame, retained: DataFrame) -> DataFrame:
    """runs(run, base), retained(run, artifact) -> (run, detail): without the base's state an initial entry, without its models no fields."""
    kept = retained.groupBy(F.col("run").alias("base")).agg(F.bool_or(F.col("artifact") == "state").alias("state"), F.bool_or(F.col("artifact") == "models").alias("models"))
    there = lambda name: F.coalesce(name, F.lit(False))
    told = F.when(~there("state"), "initial entry").when(~there("models"), "no field detail").otherwise("full")
    return runs.join(kept, "base", "left").select("run", told.alias("detail"))


def identity(rows: DataFrame, names: list[str]) -> tuple:
    """Number of rows and a sum of their hashes: equal for equal inventories in any order."""
    return tuple(rows.agg(F.count("*"), F.sum(F.xxhash64(*names).cast("decimal(38,0)"))).first())
