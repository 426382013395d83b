"""Hashes over a dependency graph: a node's hash covers the content of all that it reaches, cycles included."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestack.session import remove, scratch, shuffle_partitions, stored, written

PARTS = 4


def _sums(hash_: Column, prefix: str) -> list[Column]:
    """A sum of hashes in parts: of any number of them, in any order, and summed before the shuffle."""
    return [F.sum(F.conv(F.substring(hash_, 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)")).alias(f"{prefix}{k}") for k in range(PARTS)]


def _told(prefix: str) -> list[Column]:
    return [F.coalesce(F.col(f"{prefix}{k}").cast("string"), F.lit("0")) for k in range(PARTS)]


def _own(content: str, prefix: str) -> Column:
    return F.sha2(F.concat_ws("|", content, F.col("missing").cast("string"), *_told(prefix)), 256)


def _all(like: DataFrame, path: str) -> DataFrame:
    """What the rounds have written under a folder, a table each."""
    return like.sparkSession.read.schema(like.schema).option("recursiveFileLookup", "true").parquet(path)


def strong_components(keys: DataFrame, edges: DataFrame) -> DataFrame:
    """keys(key), distinct, and edges(src, dst) between them -> (key, component) of at least all components that no other one follows.

    Every key takes the greatest key that it reaches; those that this one reaches
    back, among keys that took the same, are its component.
    """
    spark = keys.sparkSession
    parts, home = shuffle_partitions(spark), scratch(spark, "components")
    by_dst = stored(edges.select("src", "dst").repartition(parts, "dst"), "dst", f"{home}/edges")
    color = stored(keys.select("key", F.col("key").alias("color"), F.lit(True).alias("moved")).repartition(parts, "key"), "key", f"{home}/color/0")
    for k in count(1):
        news = color.filter("moved")
        if news.isEmpty():
            break
        sent = by_dst.join(news.select(F.col("key").alias("dst"), "color").hint("shuffle_hash"), "dst").groupBy(F.col("src").alias("key")).agg(F.max("color").alias("sent"))
        rises = F.coalesce(F.col("sent") > F.col("color"), F.lit(False))
        both = color.drop("moved").join(sent.hint("shuffle_hash"), "key", "left")
        color = stored(both.select("key", F.when(rises, F.col("sent")).otherwise(F.col("color")).alias("color"), rises.alias("moved")), "key", f"{home}/color/{k}")
        remove(spark, f"{home}/color/{k - 1}")
    color = color.select("key", "color")
    inside = by_dst.join(color.select(F.col("key").alias("dst"), F.col("color").alias("of")), "dst").join(color.select(F.col("key").alias("src"), "color"), "src")
    inside = stored(inside.filter("color = of").select("src", "dst"), "src", f"{home}/inside")
    news = written(color.filter("key = color").select("key"), f"{home}/reached/0")
    for k in count(1):
        step = inside.join(news.select(F.col("key").alias("src")).hint("shuffle_hash"), "src", "left_semi").select(F.col("dst").alias("key")).distinct()
        reached = _all(news, f"{home}/reached")
        news = written(step.join(reached, "key", "left_anti"), f"{home}/reached/{k}")
        if news.isEmpty():
            return color.join(_all(news, f"{home}/reached").hint("shuffle_hash"), "key", "left_semi").withColumnRenamed("color", "component")


def hashes(nodes: DataFrame, edges: DataFrame, contents: dict[str, str] | None = None) -> DataFrame:
    """nodes(key, content), edges(src, dst): src depends on dst -> (key, hash).

    Nodes whose dependencies all have hashes get theirs, round by round. Where none
    is left but some wait, they wait for cycles: the members of a component that
    needs nothing else any more get one hash of all their contents and of what they
    need outside, each with its own content. Dependencies on unknown keys count as
    missing and change nothing else; a null content is an empty one.

    ``contents`` names several columns of contents, each with the name of its hash;
    all are hashed in the same rounds.

    Nodes and edges are tables that the rounds read where they lie. A round shuffles
    what has just got its hash, the edges to it and the nodes that know some of their
    dependencies only, so an edge counts once, however many rounds there are. All
    components that are found stay found, whether they can have their hashes or not.
    """
    contents = contents or {"content": "hash"}
    spark = nodes.sparkSession
    parts, home = shuffle_partitions(spark), scratch(spark, "hashes")
    sums = [f"{name}_{k}" for name in contents.values() for k in range(PARTS)]
    own_hashes = [_own(c, f"{name}_").alias(name) for c, name in contents.items()]
    nodes = stored(nodes.select("key", *(F.coalesce(c, F.lit("")).alias(c) for c in contents)).repartition(parts, "key"), "key", f"{home}/nodes")
    there = nodes.select(F.col("key").alias("dst"), F.lit(True).alias("there")).dropDuplicates(["dst"])
    dealt = edges.select("src", "dst").filter("src != dst").repartition(parts, "dst").dropDuplicates(["src", "dst"])
    dealt = stored(dealt.join(there.hint("shuffle_hash"), "dst", "left"), "dst", f"{home}/edges")
    needs = dealt.groupBy(F.col("src").alias("key")).agg(F.count("there").alias("out"), F.count_if(F.col("there").isNull()).alias("missing"))
    kind = nodes.schema["key"].dataType
    waiting = nodes.join(needs.hint("shuffle_hash"), "key", "left").fillna(0, ["out", "missing"])
    waiting = stored(waiting.withColumns({"unit": F.lit(None).cast(kind), "alone": F.lit(False)}), "key", f"{home}/waiting/0")
    # An edge is there until its ends are one component.
    links, total, members = dealt.filter("there").select("src", "dst"), waiting.count(), None
    none = [F.lit(None).cast("decimal(38,0)").alias(c) for c in sums]
    partial = waiting.filter("false").select("key", F.lit(0).cast("long").alias("told"), *none)
    news = written(waiting.filter("out = 0").select("*", *none).select("key", *own_hashes), f"{home}/done/0")
    for k in count(1):
        stuck = news.isEmpty()
        if stuck:
            done = _all(news, f"{home}/done")
            if done.count() == total:
                return done
            waiting, links = _grouped(waiting, links, done, f"{home}/waiting/{k}")
            members = waiting.filter("unit IS NOT NULL")
            known = partial
        else:
            told = news.groupBy(F.col("key").alias("dst")).agg(*(x for name in contents.values() for x in _sums(F.col(name), f"{name}_")))
            sent = links.join(told.hint("shuffle_hash"), "dst").groupBy(F.col("src").alias("key")).agg(F.count("*").alias("told"), *(F.sum(c).cast("decimal(38,0)").alias(c) for c in sums))
            known = partial.union(sent).groupBy("key").agg(F.sum("told").alias("told"), *(F.sum(c).cast("decimal(38,0)").alias(c) for c in sums))
        rows = written(waiting.join(known.hint("shuffle_hash"), "key"), f"{home}/rows/{k}")
        remove(spark, f"{home}/rows/{k - 1}")
        single = F.col("unit").isNull() & (F.col("told") == F.col("out"))
        ready, left = rows.filter(single).select("key", *own_hashes), rows.filter(~single)
        if members is not None:
            # A component's members are told together; one that needs nothing at all is ready when it is found.
            so_far = rows.filter("unit IS NOT NULL").groupBy("unit").agg(F.sum("told").alias("told"))
            need = members.groupBy("unit").agg(F.sum("out").alias("need")).join(so_far, "unit", "left" if stuck else "inner")
            full = written(need.filter("need = coalesce(told, 0)").select("unit"), f"{home}/full/{k}")
            each = members.join(full, "unit", "left_semi").join(rows.select("key", *sums).dropDuplicates(["key"]), "key", "left")
            ready, left = ready.union(_whole(each, contents)), left.join(full, "unit", "left_anti")
        partial = left.select("key", "told", *sums).dropDuplicates(["key"])
        news = written(ready, f"{home}/done/{k}")


def _grouped(waiting: DataFrame, links: DataFrame, done: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Those that still wait, with the components that can be told now, and the links between different ones of them."""
    rows = waiting.filter("key IS NOT NULL").join(done.select("key").hint("shuffle_hash"), "key", "left_anti")
    rows = stored(rows, "key", f"{path}/rows")
    unknown = rows.filter("unit IS NULL AND NOT alone").select("key").distinct()
    among = links.join(unknown.select(F.col("key").alias("dst")).hint("shuffle_hash"), "dst", "left_semi").join(unknown.select(F.col("key").alias("src")).hint("shuffle_hash"), "src", "left_semi")
    of = strong_components(unknown, among)
    several = of.filter("key != component").select("component").distinct().withColumn("more", F.lit(True))
    found = of.join(several, "component", "left").select("key", F.when(F.col("more"), F.col("component")).alias("found"), F.col("more").isNull().alias("single"))
    rows = rows.join(found.hint("shuffle_hash"), "key", "left")
    rows = rows.withColumns({"unit": F.coalesce("unit", "found"), "alone": F.col("alone") | F.coalesce("single", F.lit(False))}).drop("found", "single")
    rows = stored(rows, "key", f"{path}/found")
    of = rows.select("key", "unit").dropDuplicates(["key"])
    ends = links.join(of.select(F.col("key").alias("src"), "unit").hint("shuffle_hash"), "src")
    ends = ends.join(of.filter("unit IS NOT NULL").select(F.col("key").alias("dst"), F.col("unit").alias("of")).hint("shuffle_hash"), "dst", "left")
    ends = stored(ends.select("src", "dst", F.coalesce(F.col("unit") == F.col("of"), F.lit(False)).alias("inside")), "dst", f"{path}/links")
    inside = ends.filter("inside").groupBy(F.col("src").alias("key")).agg(F.count("*").alias("inside"))
    rows = rows.join(inside.hint("shuffle_hash"), "key", "left").withColumn("out", F.col("out") - F.coalesce("inside", F.lit(0))).drop("inside")
    return stored(rows, "key", f"{path}/told"), ends.filter("NOT inside").select("src", "dst")


def _whole(each: DataFrame, contents: dict[str, str]) -> DataFrame:
    """Hashes of the members of components that need nothing else any more."""
    each = each.select("key", "unit", *(_own(c, f"{name}_").alias(name) for c, name in contents.items()))
    whole = each.groupBy("unit").agg(F.count("*").alias("n"), *(x for name in contents.values() for x in _sums(F.col(name), f"{name}_")))
    whole = whole.select("unit", *(F.sha2(F.concat_ws("|", F.col("n").cast("string"), *_told(f"{name}_")), 256).alias(f"whole_{name}") for name in contents.values()))
    return each.join(whole, "unit").select("key", *(F.sha2(F.concat_ws("|", f"whole_{name}", name), 256).alias(name) for name in contents.values()))
