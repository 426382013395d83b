"""Merkle manifest of a dataset: leaves, roots and proofs by lag and lead windows.

Rows get dense positions inside their group: they are sorted by ranges, and the
counts of the ranges before give the rest, so no task holds a group. ``span``
consecutive nodes of a group are a block, and a window over a block climbs as many
levels as make ``span`` from ``fan_out``: at each level lag and lead columns of
fixed offsets (multiples of the level's stride), masked by a node's slot among its
parent's children and by the length of the run, are its siblings. The row of a
parent's first child hashes the parent, and a running last value hands the digest
to the parent's other rows. All levels of a block share one sort. The blocks' tops
are the nodes of the next round, a ``span``-th of the rows, until each group has
one node; the groups' roots form a tree of their own in the same way. Proofs are
put together on the way down, by one join per round on group and block.

Defined cases: a null field hashes as ``-``; the null group is a group of its own
and the first; null ids come first in their group; rows of one id are ordered by
their leaves, and rows that repeat each other have equal leaves, so their places
are interchangeable; empty texts are values of no bytes; an empty table has no
root and gives no rows; extra columns are ignored unless they are carried along
under a name of the caller's choice, which may not begin with ``mk_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestack.session import cut, shuffle_partitions

FAN_OUT = 2
#: Nodes of a block; a power of the fan-out.
SPAN = 1024


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other; digests go in as hex text."""
    return F.sha2(F.concat(*parts), 256)


def leaf(*fields: Column) -> Column:
    """Digest of a row: each field as its UTF-8 length, a colon and its value, or ``-`` if null."""
    coded = []
    for field in fields:
        text = field.cast("string")
        coded.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(*coded)


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of its path."""
    return F.aggregate(path, start, lambda d, step: digest(step["before"], d, step["after"]))


def proof_text(path: Column) -> Column:
    """The digests of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def positions(rows: DataFrame) -> DataFrame:
    """rows(mk_g, mk_k, mk_d, ...) -> with mk_p, the place from 0 in group mk_g by mk_k and mk_d, and mk_n, the rows of the group."""
    order = ["mk_g", "mk_k", "mk_d", "mk_tie"]
    parts = shuffle_partitions(rows.sparkSession)
    tied = rows.withColumn("mk_tie", F.monotonically_increasing_id())  # splits what repeats; such rows are interchangeable
    placed = tied.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("mk_tie")
    placed = cut(placed.withColumns({"mk_r": F.spark_partition_id(), "mk_i": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}))
    # One row for each range and group in it; a group's first place in a range is its own.
    shares = placed.groupBy("mk_g", "mk_r").agg(F.count("*").alias("mk_c"), F.min("mk_i").alias("mk_first"))
    whole = Window.partitionBy("mk_g")
    before = whole.orderBy("mk_r").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select("mk_g", "mk_r", "mk_first", F.coalesce(F.sum("mk_c").over(before), F.lit(0)).alias("mk_b"), F.sum("mk_c").over(whole).alias("mk_n"))
    joined = placed.join(shares, ["mk_g", "mk_r"])
    return joined.withColumn("mk_p", F.col("mk_b") + F.col("mk_i") - F.col("mk_first")).drop("mk_r", "mk_i", "mk_first", "mk_b", "mk_k")


def climb(nodes: DataFrame, fan_out: int, span: int) -> DataFrame:
    """nodes(mk_g, mk_p, mk_n, mk_d, ...) -> with mk_block, mk_steps (siblings per level) and mk_top, the digest of the block's top."""
    nodes = nodes.withColumns({"mk_block": F.expr(f"mk_p div {span}"), "mk_x": F.col("mk_d")})
    block = Window.partitionBy("mk_g", "mk_block").orderBy("mk_p")
    whole = block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    p, n, none = F.col("mk_p"), F.col("mk_n"), F.lit("")
    steps, stride = [], 1
    while stride < span:
        slot = F.expr(f"mk_p div {stride} % {fan_out}")
        own = p - p % stride
        goes_on = n > stride  # more than one node at this level
        left, right = [], []
        for j in range(1, fan_out):
            left.insert(0, F.when(slot >= j, F.lag("mk_x", j * stride).over(block)))
            # The last node of a run may have fewer rows; its last row stands in for a mirror that is not there.
            there = (slot + j < fan_out) & (own + j * stride < n)
            right.append(F.when(there, F.coalesce(F.lead("mk_x", j * stride).over(block), F.last("mk_x").over(whole))))
        joined = lambda xs: F.concat(*(F.coalesce(x, none) for x in xs))
        step = f"mk_s{len(steps)}"
        nodes = nodes.withColumn(step, F.when(goes_on, F.struct(joined(left).alias("before"), joined(right).alias("after"))))
        first_child = p % (stride * fan_out) == 0
        nodes = nodes.withColumn("mk_up", F.when(goes_on & first_child, digest(F.col("mk_x"), F.col(step)["after"])))
        nodes = nodes.withColumn("mk_x", F.when(goes_on, F.last("mk_up", ignorenulls=True).over(running)).otherwise(F.col("mk_x")))
        steps.append(step)
        stride *= fan_out
    done = nodes.withColumns({"mk_steps": F.array_compact(F.array(*steps)), "mk_top": F.col("mk_x")})
    return done.drop("mk_x", "mk_up", *steps)


def tree(nodes: DataFrame, fan_out: int, span: int) -> tuple[list[DataFrame], DataFrame]:
    """nodes(mk_g, mk_p, mk_n, mk_d, ...) -> the rounds' tables, and (mk_g, mk_d): the root of each group."""
    rounds = []
    while True:
        made = cut(climb(nodes, fan_out, span))
        rounds.append(made)
        nodes = made.filter(F.col("mk_p") % span == 0).select("mk_g", F.col("mk_block").alias("mk_p"), F.expr(f"(mk_n + {span - 1}) div {span}").alias("mk_n"), F.col("mk_top").alias("mk_d"))
        if (nodes.agg(F.max("mk_n")).first()[0] or 0) <= 1:
            return rounds, nodes.select("mk_g", "mk_d")


def paths(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The first round's rows with mk_path, where above(mk_g, mk_path, ...) goes on from each group's root."""
    names = [c for c in above.columns if c != "mk_g"]
    upper = rounds[-1].join(above, "mk_g")
    for k in reversed(range(len(rounds))):
        upper = upper.withColumn("mk_path", F.concat("mk_steps", "mk_path")).drop("mk_steps")
        if k:
            upper = upper.select("mk_g", F.col("mk_p").alias("mk_block"), *names)
            upper = rounds[k - 1].join(upper, ["mk_g", "mk_block"])
    return upper


def manifest(
    docs: DataFrame, leaf_hash: Column, group: Column, key: Column, carry: dict[str, Column], fan_out: int = FAN_OUT, span: int = SPAN
) -> DataFrame:
    """One row per row: the carried columns, leaf, subroot, root and path array<struct<before string, after string>>.

    The path's siblings lead from the leaf to the root; ``fold`` recomputes the root.
    """
    if fan_out < 2 or span not in {fan_out**k for k in range(1, 64)}:
        raise ValueError("span has to be a power of a fan-out of 2 or more")
    # The null group's name comes before all others, and names keep the order of UTF-8 bytes.
    name = F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))
    rows = docs.select(name.alias("mk_g"), key.alias("mk_k"), leaf_hash.alias("mk_d"), F.struct(*(c.alias(n) for n, c in carry.items())).alias("mk_row"))
    rounds, subroots = tree(positions(rows), fan_out, span)
    subroots = cut(subroots)
    top = subroots.select(F.lit("").alias("mk_g"), F.col("mk_g").alias("mk_k"), "mk_d", F.col("mk_g").alias("mk_name"))
    top_rounds, root = tree(positions(top), fan_out, span)
    none = F.array().cast("array<struct<before:string,after:string>>")
    groups = paths(top_rounds, root.select("mk_g", none.alias("mk_path"), F.col("mk_d").alias("mk_root")))
    groups = groups.select(F.col("mk_name").alias("mk_g"), F.col("mk_d").alias("mk_subroot"), "mk_root", "mk_path")
    found = paths(rounds, groups)
    return found.select("mk_row.*", F.col("mk_d").alias("leaf"), F.col("mk_subroot").alias("subroot"), F.col("mk_root").alias("root"), F.col("mk_path").alias("path"))
