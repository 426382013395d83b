"""Link operators: resolution by alias, priority matches, propagation, redirects, range lookup and integrity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestack.functions.text import title_key
from lodestack.session import cut


def resolve(wanted: DataFrame, direct: DataFrame, named: DataFrame) -> DataFrame:
    """wanted(source, target), direct(alias, entity), named(alias, entity) -> (source, target, entity, status).

    A direct match beats any name; several candidates of the best kind are
    ambiguous and never chosen from. Candidates are counted per alias before the
    join, so an alias that many rows use, or that many entities share, costs one
    row; repeated pairs count once.
    """
    kinds = direct.withColumn("rank", F.lit(0)).unionByName(named.withColumn("rank", F.lit(1))).distinct()
    counted = kinds.groupBy("alias", "rank").agg(F.count("*").alias("n"), F.min("entity").alias("entity"))
    best = counted.groupBy("alias").agg(F.min_by(F.struct("n", "entity"), "rank").alias("best"))
    status = F.when(F.col("best").isNull(), "missing-target").when(F.col("best.n") == 1, "resolved").otherwise("ambiguous-target")
    return wanted.join(best, wanted["target"] == best["alias"], "left").select(
        "source", "target", F.when(F.col("best.n") == 1, F.col("best.entity")).alias("entity"), status.alias("status")
    )


def by_priority(wanted: DataFrame, keys: DataFrame, named: DataFrame) -> DataFrame:
    """wanted(source, key, name) -> (source, target, how): the key's entity, else the name's if it is the only one."""
    unique = named.groupBy("name").agg(F.min("entity").alias("by_name"), F.count("*").alias("n"))
    found = wanted.join(keys.withColumnRenamed("entity", "by_key"), "key", "left").join(unique, "name", "left")
    how = (
        F.when(F.col("by_key").isNotNull(), "key").when(F.col("n") == 1, "name").when(F.col("n") > 1, "ambiguous").otherwise("missing")
    )
    return found.select("source", F.coalesce("by_key", F.when(F.col("n") == 1, F.col("by_name"))).alias("target"), how.alias("how"))


def propagate(seeds: DataFrame, edges: DataFrame, steps: int) -> DataFrame:
    """(owner, node) pairs reached from seeds(owner, node) over edges(src, dst) in at most ``steps`` steps; cycles are safe."""
    seen = frontier = cut(seeds.select("owner", "node").distinct())
    for _ in range(steps):
        step = frontier.join(edges, frontier["node"] == edges["src"]).select("owner", F.col("dst").alias("node")).distinct()
        frontier = cut(step.join(seen, ["owner", "node"], "left_anti"))
        if frontier.isEmpty():
            break
        seen = seen.union(frontier)
    return seen


def follow_redirects(keys: DataFrame, redirects: DataFrame, most: int) -> DataFrame:
    """(key, destination, hops) along redirects(key, to) for at most ``most`` hops.

    Redirects are doubled: after round k a row knows where 2^k hops lead. Each
    power is written once, so the number of joins grows with the logarithm of the
    chain, and a cycle ends with the hop limit.
    """
    at = keys.select("key", F.col("key").alias("destination"), F.lit(0).alias("hops"))
    jump = redirects.select(F.col("key").alias("k"), F.col("to").alias("to"))
    powers = [cut(jump)]
    while 2 ** len(powers) <= most:
        a, b = powers[-1].alias("a"), powers[-1].alias("b")
        powers.append(cut(a.join(b, F.col("a.to") == F.col("b.k")).select("a.k", "b.to")))
    # The whole jumps are taken from the longest to the shortest that still fits the limit.
    for p in reversed(range(len(powers))):
        fits = F.col("hops") + 2**p <= most
        at = (
            at.join(powers[p], (F.col("destination") == F.col("k")) & fits, "left")
            .select("key", F.coalesce("to", "destination").alias("destination"), (F.col("hops") + F.when(F.col("to").isNull(), 0).otherwise(2**p)).alias("hops"))
        )
    return at


def chain_ends(keys: DataFrame, redirects: DataFrame) -> DataFrame:
    """(key, destination, hops) at the end of redirects(key, to), however long the chain; on or before a cycle there is no end: nulls.

    A row that knows where 2^k hops lead takes over what the row there knows. A
    round that ends no row is the last one, as only cycles are left then.
    """
    jumps = redirects.select(F.col("key").alias("k"), "to")
    stops = jumps.select(F.col("k").alias("to"), F.lit(True).alias("goes_on"))
    state = cut(jumps.join(stops, "to", "left").select("k", "to", F.lit(1).cast("long").alias("hops"), F.col("goes_on").isNotNull().alias("open")))
    done, rest = state.filter("NOT open"), state.filter("open")
    while True:
        there = done.union(rest).select(F.col("k").alias("to"), F.col("to").alias("next"), F.col("hops").alias("more"), F.col("open").alias("still"))
        step = cut(rest.join(there, "to").select("k", F.col("next").alias("to"), (F.col("hops") + F.col("more")).alias("hops"), F.col("still").alias("open")))
        ended = step.filter("NOT open")
        if ended.isEmpty():
            break
        done, rest = cut(done.union(ended)), step.filter("open")
    known = done.union(rest.select("k", F.lit(None).cast(dict(done.dtypes)["to"]).alias("to"), F.lit(None).cast("long").alias("hops"), "open"))
    found = keys.select("key").join(known.withColumn("has", F.lit(True)), F.col("key") == F.col("k"), "left")
    at = lambda c, own: F.when(F.col("has"), F.col(c)).otherwise(own).alias("destination" if c == "to" else c)
    return found.select("key", at("to", F.col("key")), at("hops", F.lit(0)))


def longest_token(names: DataFrame, tokens: DataFrame) -> DataFrame:
    """names(name), tokens(token) -> (name, token): the longest token that stands anywhere in a name, of equally long ones the first.

    A name's parts of the lengths that tokens have meet tokens by equality, so no name is compared with every token.
    """
    tokens = tokens.select("token").filter("length(token) > 0").distinct()
    sizes = [r[0] for r in tokens.select(F.length("token")).distinct().collect()]  # lengths, not tokens
    each = names.select("name").distinct()
    parts = [
        each.filter(F.length("name") >= n).select("name", F.explode(F.transform(F.sequence(F.lit(1), F.length("name") - n + 1), lambda i: F.substring("name", i, F.lit(n)))).alias("token"))
        for n in sizes
    ]
    if not parts:
        return each.select("name", F.lit(None).cast("string").alias("token")).filter("false")
    met = union_all(parts).distinct().join(tokens, "token")
    return met.groupBy("name").agg(F.min(F.struct((-F.length("token")).alias("n"), "token")).alias("best")).select("name", F.col("best.token").alias("token"))


def require(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """rows joined with known(key, ...); a key that is missing there, or there twice, fails the job."""
    counts = rows.select(key).distinct().join(known.groupBy(key).agg(F.count("*").alias("n")), key, "left")
    wrong = counts.filter(F.coalesce("n", F.lit(0)) != 1).limit(5).collect()
    if wrong:
        raise ValueError(f"evidence is missing or ambiguous: {[r[key] for r in wrong]}")
    return rows.join(known, key)


def title_match(entities: DataFrame, titles: DataFrame, prefixes: list[str], complete: bool = True) -> DataFrame:
    """entities(id, name), titles(title) -> (id, status, reason, title) by the normalized last part of titles under one of the prefixes.

    One candidate of a complete inventory matches; several are ambiguous, none is missing, and an incomplete
    inventory decides nothing. Names are normalized once each, and candidates counted before the join.
    """
    under = F.lit(False)
    for p in prefixes:
        under |= F.startswith("title", F.lit(p + "/"))
    leaf = F.element_at(F.split(F.regexp_replace("title", "^[^:]*:", ""), "/"), -1)
    known = titles.filter(under).select(title_key(leaf).alias("k"), "title").groupBy("k").agg(F.count_distinct("title").alias("n"), F.min("title").alias("title"))
    names = entities.select("name").distinct().withColumn("k", title_key("name")).join(known, "k", "left")
    n = F.coalesce("n", F.lit(0))
    if not complete:
        status, reason = F.lit("unavailable"), F.lit("incomplete-index")
    else:
        status = F.when(n == 0, "missing").when(n == 1, "matched").otherwise("unavailable")
        reason = F.when(n == 0, "no-exact-title").when(n == 1, "exact-title").otherwise("ambiguous-title")
    told = names.select("name", status.alias("status"), reason.alias("reason"), F.when(F.lit(complete) & (n == 1), F.col("title")).alias("title"))
    return entities.join(told, entities["name"].eqNullSafe(told["name"])).select("id", "status", "reason", "title")


def nearest_ancestor(runs: DataFrame, most: int = 1 << 16) -> DataFrame:
    """runs(run, parent, snapshot) -> (run, base, state): the nearest ancestor of another snapshot, none, or a cycle on the way.

    Parents of the same snapshot are followed by doubling to the last of them; its parent is the base.
    """
    up = runs.select(F.col("run").alias("parent"), F.col("snapshot").alias("above"))
    known = cut(runs.join(up, "parent", "left"))
    same = known.filter("above = snapshot").select(F.col("run").alias("key"), F.col("parent").alias("to"))
    ends = follow_redirects(runs.select(F.col("run").alias("key")), same, most)
    last = known.select(F.col("run").alias("destination"), "parent", (F.col("above") == F.col("snapshot")).alias("loops"), F.col("above").isNotNull().alias("there"))
    found = ends.join(last, "destination")
    loops = F.coalesce("loops", F.lit(False))
    state = F.when(loops, "cycle").when(F.col("there"), "base").otherwise("none")
    return found.select(F.col("key").alias("run"), F.when(~loops & F.col("there"), F.col("parent")).alias("base"), state.alias("state"))


def range_lookup(keys: DataFrame, directory: DataFrame, width: int) -> DataFrame:
    """keys(key) inside directory ranges [first, last]: ranges are listed under every bucket they touch, so rows meet by equality."""
    buckets = F.sequence(F.floor(F.col("first") / width), F.floor(F.col("last") / width))
    spread = directory.withColumn("bucket", F.explode(buckets))
    found = keys.withColumn("bucket", F.floor(F.col("key") / width)).join(spread, "bucket")
    return found.filter("key BETWEEN first AND last").drop("bucket")


def two_way(a: DataFrame, a_name: str, b: DataFrame, b_name: str) -> DataFrame:
    """Keys that one side has and the other lacks, as (side, key).

    Both sides meet in one sum per key, so nothing is sorted or held but the keys
    themselves; a null key equals none and is reported by each side that has it.
    """
    sides = a.select("key", F.lit(1).alias("side")).union(b.select("key", F.lit(2).alias("side"))).groupBy("key").agg(F.bit_or("side").alias("sides"))
    told = lambda bit, name: F.when(F.col("sides").bitwiseAND(bit) > 0, F.lit(name))
    lone = sides.filter("sides != 3 OR key IS NULL").select(F.explode(F.array(told(1, a_name), told(2, b_name))).alias("side"), "key")
    return lone.filter("side IS NOT NULL")


def mutual_unique(candidates: DataFrame, left: str, right: str) -> DataFrame:
    """Candidate pairs in which both sides occur once."""
    n = lambda c: F.count("*").over(Window.partitionBy(c))
    return candidates.withColumns({"_l": n(left), "_r": n(right)}).filter("_l = 1 AND _r = 1").drop("_l", "_r")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
