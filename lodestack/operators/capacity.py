"""First fit decreasing into bins with two budgets, earlier placements, sealed bins and units that stay together.

An item has two sizes, and a bin of its topic two budgets. Items of a unit go to
one bin; equal contents inside a unit are charged once. What was placed before
stays where it is, and fills its bin; a unit with such a member goes to that bin or
nowhere. All other units are taken by falling size and go to the first open bin
that has room in both budgets, else to a new one.

A topic is planned from its classes alone: so many units of one pair of sizes. Bins
with the same past are one run, and runs are kept in blocks that know the most free
room they hold in either budget, so a search skips whole blocks. Units then find
their bins by their rank inside their class; ranks come from sorted ranges, so no
task holds a topic's items.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestack.operators.packing import ordered
from lodestack.session import cut

BLOCK = 64


@dataclass
class Run:
    """``many`` consecutive bins from ``first`` on, each with room a and b."""

    first: int
    many: int
    a: int
    b: int

    def each(self, a: int, b: int, count: int) -> int:
        """How many items of these sizes one of the bins takes."""
        return min(self.a // a if a else count, self.b // b if b else count)


class Bins:
    """Runs of bins in order, in blocks with the most room of either kind."""

    def __init__(self, runs: Iterable[Run], budget: tuple[int, int], next_bin: int):
        self.budget, self.next = budget, next_bin
        self.blocks: list[list[Run]] = []
        self.most: list[tuple[int, int]] = []
        for run in runs:
            self._append(run)

    def _append(self, run: Run) -> None:
        if not self.blocks or len(self.blocks[-1]) >= BLOCK:
            self.blocks.append([])
            self.most.append((0, 0))
        self.blocks[-1].append(run)
        self._settle(len(self.blocks) - 1)

    def _settle(self, at: int) -> None:
        block = self.blocks[at]
        if len(block) > 2 * BLOCK:
            self.blocks[at : at + 1] = [block[:BLOCK], block[BLOCK:]]
            self.most[at : at + 1] = [(0, 0), (0, 0)]
            self._settle(at + 1)
            block = self.blocks[at]
        self.most[at] = max(r.a for r in block), max(r.b for r in block)

    def _split(self, run: Run, a: int, b: int, each: int, take: int) -> list[Run]:
        full, over = divmod(take, each)
        parts = [Run(run.first, full, run.a - each * a, run.b - each * b)]
        if over:
            parts.append(Run(run.first + full, 1, run.a - over * a, run.b - over * b))
        used = full + (over > 0)
        parts.append(Run(run.first + used, run.many - used, run.a, run.b))
        return [p for p in parts if p.many]

    def place(self, a: int, b: int, count: int) -> Iterator[tuple[int, int, int]]:
        """(items, first bin, items per bin) for ``count`` equal items, in order."""
        at = 0
        while count and at < len(self.blocks):
            if self.most[at][0] < a or self.most[at][1] < b:
                at += 1
                continue
            block, out = self.blocks[at], []
            for run in block:
                each = run.each(a, b, count) if count and run.a >= a and run.b >= b else 0
                if not each:
                    out.append(run)
                    continue
                take = min(count, run.many * each)
                yield take, run.first, each
                count -= take
                out += self._split(run, a, b, each, take)
            self.blocks[at] = out
            before = len(self.blocks)
            self._settle(at)
            at += 1 + len(self.blocks) - before
        if count:
            fresh = Run(self.next, count, *self.budget)
            each = fresh.each(a, b, count)
            fresh.many = -(-count // each)
            self.next += fresh.many
            yield count, fresh.first, each
            for part in self._split(fresh, a, b, each, count):
                self._append(part)

    def pin(self, a: int, b: int, bin_: int, count: int) -> int:
        """How many of these items the one bin takes."""
        for at, block in enumerate(self.blocks):
            for k, run in enumerate(block):
                if run.first <= bin_ < run.first + run.many:
                    take = min(count, run.each(a, b, count)) if run.a >= a and run.b >= b else 0
                    left, right = bin_ - run.first, run.first + run.many - bin_ - 1
                    parts = [Run(run.first, left, run.a, run.b), Run(bin_, 1, run.a - take * a, run.b - take * b), Run(bin_ + 1, right, run.a, run.b)]
                    block[k : k + 1] = [p for p in parts if p.many]
                    self._settle(at)
                    return take
        return 0


def plan(classes: list[tuple[int, int, int | None, int]], bins: list[tuple[int, int, int, bool]], budget: tuple[int, int]) -> list[tuple]:
    """classes(a, b, pin, count) in order and bins(bin, used a, used b, sealed) -> (class, first rank, items, bin, each); bin None: no room."""
    rooms = [Run(k, 1, -1 if sealed else budget[0] - a, -1 if sealed else budget[1] - b) for k, a, b, sealed in sorted(bins)]
    state = Bins(rooms, budget, max((k for k, *_ in bins), default=-1) + 1)
    out = []
    for number, (a, b, pin, count) in enumerate(classes):
        rank = 0
        if a > budget[0] or b > budget[1]:
            out.append((number, 0, count, None, 1))
        elif pin is not None:
            took = state.pin(a, b, pin, count)
            out += [x for x in ((number, 0, took, pin, count), (number, took, count - took, None, 1)) if x[2]]
        else:
            for items, first, each in state.place(a, b, count):
                out.append((number, rank, items, first, each))
                rank += items
    return out


def allocate(items: DataFrame, bins: DataFrame, placed: DataFrame, budget: tuple[int, int]) -> DataFrame:
    """(topic, key, unit, bin, state) for each of items(topic, key, unit, content, a, b): kept, placed, no-room or too-large.

    bins(topic, bin, a, b, sealed) are there already, with what they hold;
    placed(topic, key, bin) is what was placed before. The order of units is falling
    b, then a, then the least key. An item that cannot be placed has no bin, and the
    others are placed as if it were not there.
    """
    before = placed.select("topic", "key", F.col("bin").alias("had"))
    known = cut(items.join(before, ["topic", "key"], "left"))
    pins = known.filter("had IS NOT NULL").groupBy("topic", "unit").agg(F.min("had").alias("pin"), F.max("had").alias("other"))
    fresh = known.filter("had IS NULL")
    contents = fresh.groupBy("topic", "unit", "content").agg(F.max("a").alias("a"), F.max("b").alias("b"), F.min("key").alias("key"))
    units = contents.groupBy("topic", "unit").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.min("key").alias("key"))
    # A unit that is spread over bins already has no one bin to go to.
    units = units.join(pins, ["topic", "unit"], "left").select(
        "topic", "unit", "key", F.col("a").cast("long"), F.col("b").cast("long"), F.col("pin").cast("long"), F.coalesce(F.col("pin") != F.col("other"), F.lit(False)).alias("spread")
    )
    units = cut(units)
    # Units that come one after another, with equal sizes and pin, are a class.
    of = ("topic", "b", "a", "pin")
    movable = units.filter("NOT spread").withColumns({"b_down": -F.col("b"), "a_down": -F.col("a")})
    ranked = cut(ordered(movable, ["key"], "rank", ("topic", "b_down", "a_down", "pin")))
    classes = ranked.groupBy(*of).agg(F.count("*").alias("n"), F.min("key").alias("key"))
    kind = dict(items.dtypes)["topic"]
    schema = f"topic {kind}, b long, a long, pin long, first array<long>, bin array<long>, each array<long>"

    def plan_topic(key: tuple, classes: pd.DataFrame, bins: pd.DataFrame) -> pd.DataFrame:
        number = lambda v: None if pd.isna(v) else int(v)
        # Pinned units of a size come before the free ones of that size.
        rows = sorted(((int(r.a), int(r.b), number(r.pin), int(r.n)) for r in classes.itertuples()), key=lambda c: (-c[1], -c[0], c[2] is None, c[2] or 0))
        told = plan(rows, [(int(r.bin), int(r.a), int(r.b), bool(r.sealed)) for r in bins.itertuples()], budget)
        found = pd.DataFrame([(key[0], rows[i][1], rows[i][0], rows[i][2], rank, at, each) for i, rank, _, at, each in told], columns=["topic", "b", "a", "pin", "first", "bin", "each"])
        if found.empty:
            return found
        for c in ("pin", "bin"):
            found[c] = found[c].astype("Int64")
        out = found.groupby(["b", "a", "pin"], sort=False, dropna=False).agg({"first": list, "bin": lambda v: [None if pd.isna(x) else int(x) for x in v], "each": list}).reset_index()
        return out.assign(topic=key[0])[["topic", "b", "a", "pin", "first", "bin", "each"]]

    plans = cut(classes.groupBy("topic").cogroup(bins.select("topic", "bin", "a", "b", "sealed").groupBy("topic")).applyInPandas(plan_topic, schema))
    same = F.col("u.topic").eqNullSafe(F.col("p.topic")) & F.col("u.pin").eqNullSafe(F.col("p.pin"))
    for c in "ab":
        same &= F.col(f"u.{c}") == F.col(f"p.{c}")
    joined = ranked.alias("u").join(plans.alias("p"), same)
    run = F.size(F.filter("first", lambda x: x <= F.col("rank"))) - 1
    at = F.get("p.bin", run) + F.when(F.col("u.pin").isNotNull(), 0).otherwise(F.floor((F.col("rank") - F.get("first", run)) / F.get("each", run)))
    too_large = (F.col("u.a") > budget[0]) | (F.col("u.b") > budget[1])
    state = F.when(too_large, "too-large").when(at.isNull(), "no-room").otherwise("placed")
    went = joined.select("u.topic", "unit", at.cast("long").alias("to"), state.alias("state"))
    over = (F.col("a") > budget[0]) | (F.col("b") > budget[1])
    apart = units.filter("spread").select("topic", "unit", F.lit(None).cast("long").alias("to"), F.when(over, "too-large").otherwise("no-room").alias("state"))
    went = went.unionByName(apart)
    new = fresh.join(went, ["topic", "unit"]).select("topic", "key", "unit", F.col("to").alias("bin"), "state")
    return known.filter("had IS NOT NULL").select("topic", "key", "unit", F.col("had").cast("long").alias("bin"), F.lit("kept").alias("state")).unionByName(new)
