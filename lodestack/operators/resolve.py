"""Entity resolution: levels of decreasing evidence, mutual uniqueness, and the ledger over captures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestack.session import cut


def fingerprint(names: list[str]):
    """Hash of an anchor's members; null if any is missing."""
    whole = F.sha2(F.concat_ws("|", *[F.col(n).cast("string") for n in names]), 256)
    missing = F.lit(False)
    for n in names:
        missing = missing | F.col(n).isNull()
    return F.when(~missing, whole)


def unique_pairs(old: DataFrame, new: DataFrame, names: list[str]) -> DataFrame:
    """(old_id, new_id) for tuples that occur once on either side; counted before the join, so repeated tuples cost nothing."""
    one = lambda df, key: df.groupBy(*names).agg(F.count("*").alias("_times"), F.min(key).alias(key)).filter("_times = 1").drop("_times")
    return one(old, "old_id").join(one(new, "new_id"), names).select("old_id", "new_id")


def reconcile(old: DataFrame, new: DataFrame, levels: list[list[str]]) -> DataFrame:
    """(new_id, old_id, level): level by level from the strongest, rows that match uniquely on both sides are taken.

    A row whose best level is ambiguous is never forced at a weaker one: a tuple
    that both sides have, but not uniquely, bars its rows from later levels.
    """
    taken = None
    for level, names in zip(range(len(levels), 0, -1), levels):
        pairs = cut(unique_pairs(old, new, names).withColumn("level", F.lit(level)))
        both = old.select(*names).distinct().join(new.select(*names).distinct(), names)
        taken = pairs if taken is None else taken.union(pairs)
        # All rows that had a candidate at this level are decided: matched above or ambiguous.
        old = cut(old.join(both, names, "left_anti"))
        new = cut(new.join(both, names, "left_anti"))
    return taken.select("new_id", "old_id", "level")


def ledger(prior: DataFrame, current: DataFrame, snapshot: int) -> DataFrame:
    """prior(key, revision, first_seen, last_seen, last_changed) merged with current(key, revision)."""
    rows = prior.join(current.withColumnRenamed("revision", "now"), "key", "full")
    here, known = F.col("now").isNotNull(), F.col("revision").isNotNull()
    changed = here & ~F.col("now").eqNullSafe(F.col("revision"))
    return rows.select(
        "key",
        F.coalesce("now", "revision").alias("revision"),
        F.coalesce("first_seen", F.lit(snapshot)).alias("first_seen"),
        F.when(here, snapshot).otherwise(F.col("last_seen")).alias("last_seen"),
        F.when(changed, snapshot).otherwise(F.col("last_changed")).alias("last_changed"),
        F.when(~known, "new").when(~here, "absent").when(changed, "changed").otherwise("unchanged").alias("status"),
    )


def absence(states: DataFrame, kinds: DataFrame, scopes: DataFrame, anchors: DataFrame, objects: DataFrame) -> DataFrame:
    """states(key, kind, summary, source_object, scope, anchor) without a row in a capture -> (key, status).

    uncaptured: the capture has nothing of the kind, or of the scope of an object inside one; not-present: it would
    have been seen; unresolved: its anchor, or without one its object, is still there. A summary is never unresolved.
    """
    seen = lambda df, name: df.select(F.col(df.columns[0]).alias(name)).distinct().withColumn(f"has_{name}", F.lit(True))
    rows = states
    for df, name in ((kinds, "kind"), (scopes, "scope"), (anchors, "anchor"), (objects, "source_object")):
        rows = rows.join(seen(df, name), name, "left")
    has = lambda name: F.coalesce(f"has_{name}", F.lit(False))
    there = F.when(F.col("anchor").isNotNull(), has("anchor")).otherwise(has("source_object"))
    status = (
        F.when(~has("kind"), "uncaptured").when(F.col("summary"), "not-present")
        .when(F.contains("source_object", F.lit("#")) & ~has("scope"), "uncaptured").when(there, "unresolved").otherwise("not-present")
    )
    return rows.select("key", status.alias("status"))


def rebuild(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """rows(row, h) and decisions(row, entity) -> (entity, digest) over the sorted content hashes of an entity's rows."""
    return rows.join(decisions, "row").groupBy("entity").agg(F.md5(F.array_join(F.array_sort(F.collect_list("h")), ",")).alias("digest"))


def latest(rows: DataFrame, key: str, order: list) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")


def parent_child(
    old_parents: DataFrame, new_parents: DataFrame, old: DataFrame, new: DataFrame, parent_levels: list[list[str]], levels: list[list[str]]
) -> DataFrame:
    """Children are matched only inside parents that were matched first; children carry old_parent and new_parent."""
    parents = reconcile(old_parents, new_parents, parent_levels).select(F.col("old_id").alias("old_parent"), F.col("new_id").alias("parent"))
    inside = old.join(parents, "old_parent").drop("old_parent")
    return reconcile(inside, new.withColumnRenamed("new_parent", "parent"), [["parent", *names] for names in levels])


def replay(captures: list[DataFrame], names: list[str]) -> DataFrame:
    """Captures (id, names...) in order -> (key, names..., seen): a row takes the key of the prior row that it matches
    uniquely on both sides, else a new key; prior rows without a match stay with the capture that saw them last."""
    state = None
    for k, capture in enumerate(captures, 1):
        fresh = capture.withColumn("fresh", F.concat(F.lit(f"{k}-"), F.col("id")))
        if state is None:
            state = cut(fresh.select(F.col("fresh").alias("key"), *names, F.lit(k).alias("seen")))
            continue
        pairs = unique_pairs(state.select(F.col("key").alias("old_id"), *names), capture.select(F.col("id").alias("new_id"), *names), names)
        pairs = cut(pairs)
        current = fresh.join(pairs, fresh["id"] == pairs["new_id"], "left").select(
            F.coalesce("old_id", "fresh").alias("key"), *names, F.lit(k).alias("seen")
        )
        absent = state.join(pairs.select(F.col("old_id").alias("key")), "key", "left_anti").select("key", *names, "seen")
        state = cut(current.union(absent))
    return state
