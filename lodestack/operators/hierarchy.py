"""Trees and graphs of any depth: paths by pointer doubling, ancestor tests by intervals, stage graphs with cones of change."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.operators.packing import ordered
from lodestack.session import cut, exists

#: Sorts behind every key of a path.
LAST = "\U0010ffff"


def paths(nodes: DataFrame) -> DataFrame:
    """nodes(key, name, parent, ordinal) -> (key, names array, ordinals array, depth): from the root down to the node.

    A node without a parent is a root; its ordinal counts for nothing. A node with
    several rows (owners), a null name, a parent that is not there, or an ordinal
    that is missing or not its own under the parent has no path, nor has any node
    below it, nor has a node on a cycle or below one: their columns are null.

    Every row knows the 2^k nodes above it after round k, so there are as many
    rounds as the depth has bits. A round that ends no row is the last one: of the
    rows that are left, none ends.
    """
    sole = nodes.groupBy("key").agg(F.count("*").alias("n"), *(F.min(c).alias(c) for c in ("name", "parent", "ordinal")))
    sound = sole.filter("n = 1 AND name IS NOT NULL AND (parent IS NULL OR ordinal IS NOT NULL)").drop("n")
    taken = sound.filter("parent IS NOT NULL").groupBy("parent", "ordinal").agg(F.count("*").alias("m"))
    sound = sound.join(taken, ["parent", "ordinal"], "left").filter("parent IS NULL OR m = 1")
    no_ordinal = F.when(F.col("parent").isNotNull(), F.col("ordinal").cast("long"))
    state = cut(sound.select("key", F.array("name").alias("names"), F.array(no_ordinal).alias("ordinals"), F.col("parent").alias("up")))
    done = state.filter("up IS NULL")
    rest = state.filter("up IS NOT NULL")
    while True:
        # Rows that have ended hand their whole path to those that point at them.
        above = done.union(rest).select(F.col("key").alias("up"), F.col("names").alias("n"), F.col("ordinals").alias("o"), F.col("up").alias("next"))
        step = rest.join(above, "up").select("key", F.concat("n", "names").alias("names"), F.concat("o", "ordinals").alias("ordinals"), F.col("next").alias("up"))
        step = cut(step)
        ended = step.filter("up IS NULL")
        if ended.isEmpty():
            break
        done, rest = cut(done.union(ended)), step.filter("up IS NOT NULL")
    found = done.select("key", "names", "ordinals", F.size("names").alias("depth"))
    return nodes.select("key").distinct().join(found, "key", "left")


def intervals(tree: DataFrame) -> DataFrame:
    """tree(key, path array<string>) -> (key, opens, closes): a node is above another exactly if its interval holds the other's.

    One sort of two events per node; arrays sort element by element, so whatever
    stands below a node sorts between its path and its path with the last key.
    """
    opens = tree.select("key", "path", F.lit(0).alias("end"))
    closes = tree.select("key", F.concat("path", F.array(F.lit(LAST))).alias("path"), F.lit(1).alias("end"))
    ranks = ordered(opens.union(closes), ["path", "end"], "at")
    at = lambda end: F.max(F.when(F.col("end") == end, F.col("at")))
    return ranks.groupBy("key").agg(at(0).alias("opens"), at(1).alias("closes"))


def is_above(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """pairs(a, b) -> with ``above``: whether a is a proper ancestor of b; two joins by equality, whatever the depth."""
    a = labels.select(F.col("key").alias("a"), F.col("opens").alias("a_opens"), F.col("closes").alias("a_closes"))
    b = labels.select(F.col("key").alias("b"), F.col("opens").alias("b_opens"), F.col("closes").alias("b_closes"))
    inside = (F.col("a_opens") < F.col("b_opens")) & (F.col("b_closes") < F.col("a_closes"))
    return pairs.join(a, "a", "left").join(b, "b", "left").select(*pairs.columns, F.coalesce(inside, F.lit(False)).alias("above"))


# Stage graphs


class StageError(ValueError):
    """A stage graph that cannot run."""


@dataclass(frozen=True)
class Stage:
    """A step from its inputs, sources or other stages, to a table; another version counts as another step."""

    name: str
    inputs: tuple[str, ...]
    build: Callable[[dict[str, DataFrame]], DataFrame]
    version: str = "1"


@dataclass(frozen=True)
class Result:
    name: str
    table: DataFrame
    fingerprint: str
    reused: bool


def in_order(stages: list[Stage], sources: set[str]) -> tuple[list[Stage], dict[str, frozenset[str]]]:
    """Stages after all that they need, in the order given where that leaves a choice, and all inputs, near and far, of each."""
    names = [s.name for s in stages]
    for s in stages:
        if names.count(s.name) > 1 or s.name in sources:
            raise StageError(f"{s.name}: the name occurs twice")
        if len({*s.inputs}) < len(s.inputs):
            raise StageError(f"{s.name}: an input occurs twice")
        if odd := [i for i in s.inputs if i not in sources and i not in names]:
            raise StageError(f"{s.name}: unknown input {odd[0]}")
    out, needs, left = [], {}, list(stages)
    while left:
        ready = next((s for s in left if all(i in sources or i in needs for i in s.inputs)), None)
        if ready is None:
            raise StageError(f"a cycle among {', '.join(s.name for s in left)}")
        needs[ready.name] = frozenset(ready.inputs).union(*(needs.get(i, ()) for i in ready.inputs))
        out.append(ready)
        left.remove(ready)
    return out, needs


def run_stages(spark: SparkSession, stages: list[Stage], sources: dict[str, tuple[DataFrame, str]], root: str) -> dict[str, Result]:
    """Results of all stages; sources are name -> (table, fingerprint).

    A stage's fingerprint is that of its version and its inputs' fingerprints, and
    its table lies under it. So a change reaches exactly the stages that need it,
    near or far, and all others are read as they were written. A table without its
    success mark, of a run that was lost, is written again.
    """
    made: dict[str, Result] = {n: Result(n, t, f, True) for n, (t, f) in sources.items()}
    for stage in in_order(stages, {*sources})[0]:
        told = [stage.name, stage.version, *(f"{i}={made[i].fingerprint}" for i in stage.inputs)]
        fingerprint = hashlib.sha256("\n".join(told).encode()).hexdigest()
        path = f"{root}/{stage.name}-{fingerprint[:32]}"
        reused = exists(spark, f"{path}/_SUCCESS")
        if not reused:
            stage.build({i: made[i].table for i in stage.inputs}).write.mode("overwrite").parquet(path)
        made[stage.name] = Result(stage.name, spark.read.parquet(path), fingerprint, reused)
    return {s.name: made[s.name] for s in stages}
