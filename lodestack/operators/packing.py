"""Packing and partition planning: prefix packs, sequential batches, first-fit-decreasing bins, memoized stages."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestack.session import cut, exists, shuffle_partitions


def in_packs(rows: DataFrame, limit: int) -> DataFrame:
    """rows(key, size, ...) with ``pack`` and ``depth``: keys split by longer and longer prefixes until a pack fits.

    A pack that does not fit is split at once behind what all its keys have in
    common, so long common prefixes cost no rounds. Rows of one key cannot be split:
    a single row above the limit stands alone, several of one key fail the job.
    Packs depend on their own keys only, so inserting a key changes one pack.
    """
    rest, packed = rows.withColumn("depth", F.lit(0)), None
    alike = "aggregate(sequence(1, greatest(least(length(first), length(last)), 1)), 0, (n, i) -> IF(n = i - 1 AND length(first) >= i AND substring(first, i, 1) = substring(last, i, 1), i, n))"
    while True:
        named = rest.withColumn("pack", F.expr("substring(key, 1, depth)"))
        totals = named.groupBy("pack", "depth").agg(F.min("key").alias("first"), F.max("key").alias("last"), F.sum("size").alias("bytes"), F.count("*").alias("count"))
        totals = cut(totals.withColumn("fits", (F.col("bytes") <= limit) | (F.col("count") == 1)))
        stuck = [r["first"] for r in totals.filter("NOT fits AND first = last").limit(3).collect()]
        if stuck:
            raise ValueError(f"rows of one key exceed a pack: {stuck}")
        done = cut(named.join(totals.filter("fits").select("pack", "depth"), ["pack", "depth"]))
        packed = done if packed is None else packed.unionByName(done)
        wide = totals.filter("NOT fits").select("pack", "depth", (F.expr(alike) + 1).cast("int").alias("next"))
        rest = cut(named.join(wide, ["pack", "depth"]).drop("pack", "depth").withColumnRenamed("next", "depth"))
        if rest.isEmpty():
            return packed


def prefix_packs(rows: DataFrame, limit: int) -> DataFrame:
    """rows(key, size) -> (pack, first, last, bytes, count), see ``in_packs``."""
    return (
        in_packs(rows.select("key", "size"), limit).groupBy("pack", "depth")
        .agg(F.min("key").alias("first"), F.max("key").alias("last"), F.sum("size").alias("bytes"), F.count("*").alias("count")).drop("depth")
    )


def ranked(rows: DataFrame, key: str) -> DataFrame:
    """rows with ``rank`` from 0 in the order of a unique key: places in sorted ranges and the counts of the ranges before."""
    parts = shuffle_partitions(rows.sparkSession)
    ranged = cut(rows.repartitionByRange(parts, key).withColumn("range", F.spark_partition_id()))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = ranged.groupBy("range").count().select("range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    local = F.row_number().over(Window.partitionBy("range").orderBy(key)) - 1
    return ranged.withColumn("local", local).join(F.broadcast(offsets), "range").withColumn("rank", F.col("before") + F.col("local")).drop("range", "local", "before")


def ordered(rows: DataFrame, order: list, name: str = "rank", group: tuple[str, ...] = ()) -> DataFrame:
    """rows with their place from 0 in the order of columns, within a group if one is named; ties get different places.

    One sort by ranges and one row per range and group: a group may span any number of tasks.
    """
    keys = [*group, *order]
    parts = shuffle_partitions(rows.sparkSession)
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())  # splits rows that are alike
    ranged = tied.repartitionByRange(parts, *keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie")
    ranged = cut(ranged.withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}))
    own = F.struct(*group) if group else F.lit(0)
    shares = ranged.groupBy(own.alias("_g"), "_range").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("_g").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select("_g", "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    same = own.eqNullSafe(F.col("s._g")) & (F.col("r._range") == F.col("s._range"))
    found = ranged.alias("r").join(shares.alias("s"), same)
    return found.select("r.*", (F.col("_at") + F.col("_shift")).alias(name)).drop("_range", "_at")


def directory(rows: DataFrame, limit: int, page_limit: int, entry_bytes: int, most_levels: int = 32) -> DataFrame:
    """rows(key, size) -> (level, pack, first, last, count, entries): packs at level 0 and directory pages over them above.

    Pages take packs in the order of their keys until they are full; levels end when one page holds all. A page is
    named by its first key.
    """
    names = ["pack", "first", "last", "count", "entries"]
    below = cut(prefix_packs(rows, limit).withColumn("entries", F.col("count")).select(*names))
    out, size, each = below.withColumn("level", F.lit(0)), below.count(), max(2, page_limit // entry_bytes)
    for level in range(1, most_levels + 1):
        if size <= 1:
            break
        pages = ranked(below.select("first", "last", "count"), "first").groupBy(F.floor(F.col("rank") / each).alias("page"))
        made = pages.agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("count").alias("count"), F.count("*").alias("entries"))
        below = cut(made.withColumn("pack", F.col("first")).select(*names))
        out, size = out.unionByName(below.withColumn("level", F.lit(level))), below.count()
    return out.select("level", *names)


def place_levels(leaves: DataFrame, budget: int, entry_bytes: int) -> DataFrame:
    """leaves(topic, key, size) -> (level, topic, key, bin): leaves into bins, one index entry per bin into bins, and so for the configuration."""
    out, rows = None, leaves.withColumn("key", F.col("key").cast("string"))
    for level in ("leaf", "index", "configuration"):
        placed = cut(bin_pack_ffd(rows, budget).select(F.lit(level).alias("level"), "topic", "key", "bin"))
        out = placed if out is None else out.union(placed)
        rows = placed.select("topic", "bin").distinct().select("topic", F.concat(F.lit(f"{level}-"), "bin").alias("key"), F.lit(entry_bytes).alias("size"))
    return out


def reuse(rows: DataFrame, signed: DataFrame, stored: DataFrame, group: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Results per group: stored(group, signature, ...) where signed(group, signature) agrees, else build() over the other groups' rows."""
    signed = cut(signed)
    kept = stored.join(signed, [group, "signature"]).withColumn("reused", F.lit(True))
    moved = signed.join(stored.select(group, "signature"), [group, "signature"], "left_anti")
    fresh = build(rows.join(moved.select(group), group, "left_semi")).join(moved, group).withColumn("reused", F.lit(False))
    return kept.unionByName(fresh)


def batch_chunks(rows: DataFrame, group: str, most_rows: int, most_bytes: int) -> DataFrame:
    """rows(group, key, size) -> (group, key, batch): consecutive rows of a group until a batch is full.

    Whether a batch ends depends on where it began, so the fold is sequential; it
    runs per group over keys and sizes alone, as a stream of sorted rows.
    """
    spark = rows.sparkSession
    schema = f"{group} {dict(rows.dtypes)[group]}, key {dict(rows.dtypes)['key']}, batch long"

    def fold(batches):
        now, batch, count, size = object(), 0, 0, 0
        for frame in batches:
            out = []
            for g, key, n in zip(frame[group], frame["key"], frame["size"]):
                if g != now:
                    now, batch, count, size = g, 0, 0, 0
                elif count + 1 > most_rows or size + n > most_bytes:
                    batch, count, size = batch + 1, 0, 0
                count, size = count + 1, size + n
                out.append((g, key, batch))
            yield pd.DataFrame(out, columns=[group, "key", "batch"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.select(group, "key", "size").repartition(parts, group).sortWithinPartitions(group, "key")
    return ordered.mapInPandas(fold, schema)


def ffd_runs(sizes: list[int], counts: list[int], budget: int) -> list[tuple[int, int, int, int, int]]:
    """First fit of so many items of each size, sizes descending -> (size, rank, items, bin, each).

    From that rank among its size on, so many items go into bins from that one
    on, that many each. Bins with the same past are one run, so the work depends
    on the number of sizes, not on that of items.
    """
    start, many, free = (np.zeros(0, dtype=np.int64) for _ in range(3))
    out, bins = [], 0
    for size, count in zip(sizes, counts):
        rank = 0
        split: dict[int, list[tuple[int, int, int]]] = {}
        for r in np.flatnonzero(free >= size):
            if rank == count:
                break
            first, n, room = int(start[r]), int(many[r]), int(free[r])
            each = room // size if size else count
            take = min(count - rank, n * each)
            out.append((size, rank, take, first, each))
            rank += take
            full, over = divmod(take, each)
            parts = [(first, full, room - each * size), (first + full, min(1, over), room - over * size), (first + full + (over > 0), n - full - (over > 0), room)]
            split[int(r)] = [x for x in parts if x[1]]
        if rank < count:
            each = max(1, budget // size) if size else count
            left = count - rank
            out.append((size, rank, left, bins, each))
            full, over = divmod(left, each)
            new = [(bins, full, max(0, budget - each * size)), (bins + full, min(1, over), max(0, budget - over * size))]
            split[len(start)] = [x for x in new if x[1]]
            bins += full + (over > 0)
        runs = []
        at = 0
        for r in sorted(split):
            runs += [np.stack([start[at:r], many[at:r], free[at:r]], axis=1), np.array(split[r], dtype=np.int64).reshape(-1, 3)]
            at = r + 1
        runs.append(np.stack([start[at:], many[at:], free[at:]], axis=1))
        start, many, free = np.concatenate(runs).T.copy()
    return out


def bin_pack_ffd(items: DataFrame, budget: int) -> DataFrame:
    """items(topic, key, size) -> (topic, key, size, bin): first fit decreasing inside each topic; too large items stand alone.

    A topic is planned from its sizes and their counts alone, at most budget + 2
    of them; items find their bins by their rank among those of their size. Ranks
    come from sorted ranges and the counts of the ranges before, so no task holds
    a topic. A null size is planned as zero.
    """
    kinds = dict(items.dtypes)
    planned = F.least(F.greatest(F.coalesce("size", F.lit(0)), F.lit(0)), F.lit(budget + 1)).cast("long")
    rows = items.select("topic", "key", "size", planned.alias("plan"))
    order = [F.col("plan").desc(), F.col("size").desc(), "key"]
    parts = shuffle_partitions(items.sparkSession)
    ranged = cut(rows.repartitionByRange(parts, "topic", *order).withColumn("range", F.spark_partition_id()))
    sums = ranged.groupBy("topic", "plan", "range").count()
    before = Window.partitionBy("topic", "plan").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("topic", "plan", "range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    local = F.row_number().over(Window.partitionBy("topic", "plan", "range").orderBy(F.col("size").desc(), "key")) - 1
    ranks = ranged.withColumn("local", local).alias("r").join(
        offsets.alias("o"), [F.col("r.topic").eqNullSafe(F.col("o.topic")), *(F.col(f"r.{c}") == F.col(f"o.{c}") for c in ("plan", "range"))]
    ).select("r.*", (F.col("before") + F.col("local")).alias("rank"))

    def plan(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("plan", ascending=False)
        runs = ffd_runs(frame["plan"].tolist(), frame["n"].tolist(), budget)
        out = pd.DataFrame(runs, columns=["plan", "first", "items", "bin", "each"])
        return out.groupby("plan", sort=False).agg(list).reset_index().assign(topic=frame["topic"].iloc[0])[["topic", "plan", "first", "bin", "each"]]

    classes = ranged.groupBy("topic", "plan").agg(F.count("*").alias("n"))
    lists = "first array<long>, bin array<long>, each array<long>"
    plans = classes.groupBy("topic").applyInPandas(plan, f"topic {kinds['topic']}, plan long, {lists}")
    found = ranks.alias("r").join(plans.alias("p"), [F.col("r.topic").eqNullSafe(F.col("p.topic")), F.col("r.plan") == F.col("p.plan")])
    run = F.size(F.filter("first", lambda x: x <= F.col("rank"))) - 1
    placed = F.get("bin", run) + F.floor((F.col("rank") - F.get("first", run)) / F.get("each", run))
    return found.select("r.topic", "key", "size", placed.cast("long").alias("bin"))


def running_digest(rows: DataFrame, group: str, key: str, algorithm: str) -> DataFrame:
    """rows(group, key, h) -> (group, digest): the digest of a group's h in the order of keys, nulls left out.

    The digest is sequential; it runs as a stream of sorted rows, so a group is
    never held in one row or in memory.
    """
    kind = dict(rows.dtypes)[group]

    def fold(batches):
        now, digest, begun = None, None, False
        for frame in batches:
            out = []
            for g, h in zip(frame[group].astype(object), frame["h"]):
                g = None if pd.isna(g) else g
                if not begun or g != now:
                    if begun:
                        out.append((now, digest.hexdigest()))
                    now, digest, begun = g, hashlib.new(algorithm), True
                if h is not None:
                    digest.update(h.encode())
            yield pd.DataFrame(out, columns=[group, "digest"])
        if begun:
            yield pd.DataFrame([(now, digest.hexdigest())], columns=[group, "digest"])

    ordered = rows.select(group, key, "h").repartition(shuffle_partitions(rows.sparkSession), group).sortWithinPartitions(group, key, "h")
    return ordered.mapInPandas(fold, f"{group} {kind}, digest string")


def memoized(spark: SparkSession, inputs: DataFrame, version: str, root: str, build: Callable[[], DataFrame]) -> tuple[DataFrame, bool]:
    """The stage's stored output if inputs(path, bytes, modified) and code version are as before, else built and stored."""
    path = f"{root}/{version}-{files_fingerprint(inputs)}"
    there = exists(spark, f"{path}/_SUCCESS")
    if not there:
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), there


def files_fingerprint(files: DataFrame) -> str:
    """Of files(path, bytes, modified): a sum of hashes, so that no order and no list of all files is needed."""
    told = F.sha2(F.concat_ws("|", "path", F.col("bytes").cast("string"), F.col("modified").cast("string")), 256)
    part = lambda k: F.sum(F.conv(F.substring(told, 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)"))
    row = files.agg(F.count("*"), *(part(k) for k in range(4))).first()
    return hashlib.sha256("|".join(map(str, row)).encode()).hexdigest()


def first_per_group(rows: DataFrame, group: list[str], order: list, most: int) -> DataFrame:
    return rows.withColumn("k", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("k") <= most)
