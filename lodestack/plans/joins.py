"""Joins: resolution of links, priority and unique matches, chains and integrity checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestack.operators import links
from lodestack.plans.base import Registry, Tables

R = Registry()


@R.query("SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON c_custkey = o_custkey")
def join_hash_inner(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "o_totalprice")


@R.query(
    """WITH l AS (SELECT DISTINCT l_orderkey AS source, CASE WHEN l_orderkey % 3 = 0 THEN CAST(l_partkey AS VARCHAR)
   WHEN l_orderkey % 3 = 1 THEN p_name ELSE 'absent ' || l_partkey END AS target FROM lineitem JOIN part ON p_partkey = l_partkey),
a AS (SELECT CAST(p_partkey AS VARCHAR) AS alias, p_partkey AS entity, 1 AS direct FROM part UNION ALL SELECT p_name, p_partkey, 0 FROM part),
c AS (SELECT l.source, l.target, a.entity, a.direct, max(a.direct) OVER (PARTITION BY l.source, l.target) AS best FROM l LEFT JOIN a ON a.alias = l.target)
SELECT source, target, CASE WHEN count(entity) = 1 THEN max(entity) END AS entity,
 CASE count(entity) WHEN 0 THEN 'missing-target' WHEN 1 THEN 'resolved' ELSE 'ambiguous-target' END AS status
FROM c WHERE direct IS NOT DISTINCT FROM best GROUP BY source, target"""
)
def resolve_links(t: Tables) -> DataFrame:
    """Links from orders to parts by key, by name and by nothing; names are ambiguous."""
    rows = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    target = (
        F.when(F.col("l_orderkey") % 3 == 0, F.col("l_partkey").cast("string"))
        .when(F.col("l_orderkey") % 3 == 1, F.col("p_name"))
        .otherwise(F.concat(F.lit("absent "), "l_partkey"))
    )
    wanted = rows.select(F.col("l_orderkey").alias("source"), target.alias("target")).distinct()
    direct = t.part.select(F.col("p_partkey").cast("string").alias("alias"), F.col("p_partkey").alias("entity"))
    named = t.part.select(F.col("p_name").alias("alias"), F.col("p_partkey").alias("entity"))
    return links.resolve(wanted, direct, named)


@R.query(
    """WITH a AS (SELECT p_partkey, p_brand, CASE WHEN p_size < 10 THEN NULL ELSE p_size END AS s FROM part WHERE p_partkey % 2 = 0),
b AS (SELECT DISTINCT p_brand, CASE WHEN p_size < 10 THEN NULL ELSE p_size END AS s FROM part WHERE p_partkey % 2 = 1)
SELECT p_partkey FROM a JOIN b ON a.p_brand = b.p_brand AND a.s IS NOT DISTINCT FROM b.s"""
)
def join_null_safe(t: Tables) -> DataFrame:
    size = F.when(F.col("p_size") >= 10, F.col("p_size")).alias("s")
    a = t.part.filter("p_partkey % 2 = 0").select("p_partkey", "p_brand", size).alias("a")
    b = t.part.filter("p_partkey % 2 = 1").select("p_brand", size).distinct().alias("b")
    return a.join(b, (F.col("a.p_brand") == F.col("b.p_brand")) & F.col("a.s").eqNullSafe(F.col("b.s"))).select("p_partkey")


@R.query(
    """WITH addr AS (SELECT s_suppkey, min(n_regionkey) AS r, count(DISTINCT n_regionkey) AS k FROM supplier JOIN nation ON n_nationkey = s_nationkey
  WHERE s_suppkey % 3 <> 0 GROUP BY 1),
named AS (SELECT s_suppkey, s_suppkey % 5 AS r FROM supplier WHERE s_suppkey % 2 = 0)
SELECT s.s_suppkey AS supplier, coalesce(CASE WHEN addr.k = 1 THEN addr.r END, named.r) AS region, r_name AS name
FROM supplier s LEFT JOIN addr USING (s_suppkey) LEFT JOIN named USING (s_suppkey)
LEFT JOIN region ON r_regionkey = coalesce(CASE WHEN addr.k = 1 THEN addr.r END, named.r)"""
)
def join_chain_fallback(t: Tables) -> DataFrame:
    """Address by a chain of joins if it is unique, else by name."""
    address = (
        t.supplier.filter("s_suppkey % 3 != 0").join(t.nation, F.col("n_nationkey") == F.col("s_nationkey"))
        .groupBy("s_suppkey").agg(F.collect_set("n_regionkey").alias("found"))
        .select("s_suppkey", F.when(F.size("found") == 1, F.get("found", F.lit(0))).alias("by_address"))
    )
    named = t.supplier.filter("s_suppkey % 2 = 0").select("s_suppkey", (F.col("s_suppkey") % 5).cast("int").alias("by_name"))
    rows = t.supplier.select("s_suppkey").join(address, "s_suppkey", "left").join(named, "s_suppkey", "left")
    rows = rows.select(F.col("s_suppkey").alias("supplier"), F.coalesce("by_address", "by_name").alias("region"))
    return rows.join(t.region, F.col("region") == F.col("r_regionkey"), "left").select("supplier", "region", F.col("r_name").alias("name"))


@R.query(
    "SELECT DISTINCT l_orderkey AS holder, s_nationkey AS owner FROM lineitem JOIN supplier ON s_suppkey = l_suppkey"
)
def join_array_explode(t: Tables) -> DataFrame:
    """Holders whose array shares a member with an owner's array, through exploded members of both sides."""
    held = t.lineitem.groupBy(F.col("l_orderkey").alias("holder")).agg(F.collect_set("l_suppkey").alias("members"))
    owned = t.supplier.groupBy(F.col("s_nationkey").alias("owner")).agg(F.collect_set("s_suppkey").alias("members"))
    a, b = held.select("holder", F.explode("members").alias("m")), owned.select("owner", F.explode("members").alias("m"))
    return a.join(b, "m").select("holder", "owner").distinct()


@R.query(
    """WITH w AS (SELECT s_suppkey AS source, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey ELSE 0 END AS key, p_name AS name
  FROM supplier JOIN part ON p_partkey = s_suppkey * 3),
u AS (SELECT p_name, min(p_partkey) AS k, count(*) AS n FROM part WHERE p_size > 40 GROUP BY 1)
SELECT source, coalesce(p.p_partkey, CASE WHEN u.n = 1 THEN u.k END) AS target,
 CASE WHEN p.p_partkey IS NOT NULL THEN 'key' WHEN u.n = 1 THEN 'name' WHEN u.n > 1 THEN 'ambiguous' ELSE 'missing' END AS how
FROM w LEFT JOIN part p ON p.p_partkey = w.key LEFT JOIN u ON u.p_name = w.name"""
)
def join_priority_unique(t: Tables) -> DataFrame:
    """Exact key first, then a unique name within scope, else the reason."""
    key = F.when(F.col("s_suppkey") % 2 == 0, F.col("s_suppkey")).otherwise(F.lit(0))
    wanted = t.supplier.join(t.part, F.col("p_partkey") == F.col("s_suppkey") * 3).select(
        F.col("s_suppkey").alias("source"), key.alias("key"), F.col("p_name").alias("name")
    )
    keys = t.part.select(F.col("p_partkey").alias("key"), F.col("p_partkey").alias("entity"))
    named = t.part.filter("p_size > 40").select(F.col("p_name").alias("name"), F.col("p_partkey").alias("entity"))
    return links.by_priority(wanted, keys, named)


@R.query(
    """SELECT a.c_custkey AS customer, min(s_suppkey) AS supplier FROM customer a JOIN supplier b
ON lower(replace(a.c_name, 'Customer', 'x')) = lower(replace(b.s_name, 'Supplier', 'X')) GROUP BY 1"""
)
def join_casefold(t: Tables) -> DataFrame:
    """Names equal but for case; of several the least key."""
    a = t.customer.select(F.col("c_custkey").alias("customer"), F.lower(F.expr("replace(c_name, 'Customer', 'x')")).alias("name"))
    b = t.supplier.select("s_suppkey", F.lower(F.expr("replace(s_name, 'Supplier', 'X')")).alias("name"))
    return a.join(b, "name").groupBy("customer").agg(F.min("s_suppkey").alias("supplier"))


@R.query(
    """WITH t AS (SELECT DISTINCT lower(unnest(string_split(p_type, ' '))) AS token FROM part UNION SELECT DISTINCT unnest(string_split(p_name, ' ')) FROM part WHERE p_partkey % 3 = 0),
n AS (SELECT p_partkey, p_name || ' ' || lower(p_brand) || ' ' || lower(p_type) AS name FROM part)
SELECT p_partkey, token FROM (SELECT p_partkey, token, row_number() OVER (PARTITION BY p_partkey ORDER BY -length(token), token) AS k FROM n JOIN t ON contains(name, token)) WHERE k = 1"""
)
def join_longest_token(t: Tables) -> DataFrame:
    """The longest token of a table of tokens that a bundle's name contains."""
    tokens = t.part.select(F.explode(F.split(F.lower("p_type"), " ")).alias("token")).union(t.part.filter("p_partkey % 3 = 0").select(F.explode(F.split("p_name", " "))))
    named = t.part.select("p_partkey", F.concat_ws(" ", "p_name", F.lower("p_brand"), F.lower("p_type")).alias("name"))
    return named.join(links.longest_token(named, tokens), "name").select("p_partkey", "token")


@R.query(
    """SELECT s_suppkey AS source, l_partkey AS item, CAST(sum(l_quantity) AS BIGINT) AS weight FROM supplier JOIN nation ON n_nationkey = s_nationkey
JOIN region ON r_regionkey = n_regionkey JOIN lineitem ON l_suppkey = s_suppkey WHERE r_name = 'ASIA' AND l_discount > 0 GROUP BY 1, 2"""
)
def join_loot_chain(t: Tables) -> DataFrame:
    near = (
        t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey"))
        .join(t.region.filter("r_name = 'ASIA'"), F.col("r_regionkey") == F.col("n_regionkey")).select("s_suppkey")
    )
    lines = t.lineitem.filter("l_discount > 0")
    return lines.join(near, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(
        F.col("s_suppkey").alias("source"), F.col("l_partkey").alias("item")
    ).agg(F.sum("l_quantity").cast("long").alias("weight"))


@R.query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def join_left_semi(t: Tables) -> DataFrame:
    large = t.orders.filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey").join(large, "c_custkey", "left_semi")


@R.query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def join_left_anti(t: Tables) -> DataFrame:
    large = t.orders.filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey").join(large, "c_custkey", "left_anti")


@R.query(
    """SELECT l_partkey AS target, count(DISTINCT l_orderkey) AS n, array_to_string(list_slice(list(DISTINCT l_orderkey ORDER BY l_orderkey), 1, 5), ',') AS first
FROM lineitem GROUP BY 1"""
)
def backlinks(t: Tables) -> DataFrame:
    """Reverse edges: who links here, counted, with the first five sources."""
    pairs = t.lineitem.select(F.col("l_partkey").alias("target"), "l_orderkey").distinct()
    order = Window.partitionBy("target").orderBy("l_orderkey")
    return (
        pairs.withColumn("k", F.row_number().over(order)).groupBy("target")
        .agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("k") <= 5, F.col("l_orderkey")))), ",").alias("first"))
    )


@R.query(
    """WITH RECURSIVE w(owner, node, d) AS (SELECT p_partkey, p_partkey, 0 FROM part WHERE p_partkey BETWEEN 100 AND 103
UNION SELECT owner, p_partkey, d + 1 FROM w JOIN part ON p_partkey // 2 = node WHERE d < 4)
SELECT node, array_to_string(list(DISTINCT owner ORDER BY owner), ',') AS owners FROM w GROUP BY node"""
)
def membership_owners(t: Tables) -> DataFrame:
    """Owners travel along the edges key -> 2 key, 2 key + 1."""
    edges = t.part.select(F.expr("p_partkey div 2").alias("src"), F.col("p_partkey").alias("dst"))
    seeds = t.part.filter("p_partkey BETWEEN 100 AND 103").select(F.col("p_partkey").alias("owner"), F.col("p_partkey").alias("node"))
    reached = links.propagate(seeds, edges, steps=4)
    return reached.groupBy("node").agg(F.array_join(F.array_sort(F.collect_set("owner")), ",").alias("owners"))


@R.query(
    """SELECT o_custkey AS weapon, count(DISTINCT n_regionkey) AS regions, min(s_suppkey) AS first FROM orders JOIN lineitem ON l_orderkey = o_orderkey
JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1"""
)
def join_four_hop(t: Tables) -> DataFrame:
    places = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey")).select("s_suppkey", "n_regionkey")
    return (
        t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).join(places, F.col("s_suppkey") == F.col("l_suppkey"))
        .groupBy(F.col("o_custkey").alias("weapon"))
        .agg(F.count_distinct("n_regionkey").alias("regions"), F.min("s_suppkey").alias("first"))
    )


@R.query(
    """WITH c AS (SELECT DISTINCT l_orderkey AS claim, l_partkey AS owner FROM lineitem)
SELECT claim, owner FROM (SELECT *, count(*) OVER (PARTITION BY claim) AS a, count(*) OVER (PARTITION BY owner) AS b FROM c) WHERE a = 1 AND b <= 60"""
)
def claims_unique(t: Tables) -> DataFrame:
    """Claims that one owner makes, of owners with few claims."""
    c = t.lineitem.select(F.col("l_orderkey").alias("claim"), F.col("l_partkey").alias("owner")).distinct()
    counted = c.withColumns({"a": F.count("*").over(Window.partitionBy("claim")), "b": F.count("*").over(Window.partitionBy("owner"))})
    return counted.filter("a = 1 AND b <= 60").select("claim", "owner")


@R.query(
    """SELECT o_orderkey AS key, o_orderkey // 100 AS shard FROM orders""",
    name="range_join_directory",
)
def range_join_directory(t: Tables) -> DataFrame:
    """Keys looked up in a directory of [first, last] ranges: the range key is bucketed, so the join is an equi-join."""
    directory = t.orders.groupBy(F.expr("o_orderkey div 100").alias("shard")).agg(
        F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last")
    )
    keys = t.orders.select(F.col("o_orderkey").alias("key"))
    return links.range_lookup(keys, directory, width=100).select("key", "shard")


@R.query(
    """SELECT p_partkey AS key, CASE WHEN p_partkey % 10 = 0 AND p_partkey > 10 THEN p_partkey - 1 ELSE p_partkey END AS canonical FROM part"""
)
def redirect_join(t: Tables) -> DataFrame:
    redirects = t.part.filter("p_partkey % 10 = 0 AND p_partkey > 10").select(F.col("p_partkey").alias("key"), (F.col("p_partkey") - 1).alias("to"))
    return t.part.select(F.col("p_partkey").alias("key")).join(redirects, "key", "left").select("key", F.coalesce("to", "key").alias("canonical"))


@R.query(
    """WITH RECURSIVE r AS (SELECT p_partkey AS key, p_partkey // 2 AS to_ FROM part WHERE p_partkey % 2 = 1 AND p_partkey > 1),
w(origin, place, hops) AS (SELECT p_partkey, p_partkey, 0 FROM part UNION ALL SELECT origin, to_, hops + 1 FROM w JOIN r ON r.key = w.place)
SELECT origin AS key, arg_max(place, hops) AS destination, max(hops) AS hops FROM w GROUP BY origin"""
)
def redirect_chain(t: Tables) -> DataFrame:
    redirects = t.part.filter("p_partkey % 2 = 1 AND p_partkey > 1").select(F.col("p_partkey").alias("key"), F.expr("p_partkey div 2").alias("to"))
    return links.chain_ends(t.part.select(F.col("p_partkey").alias("key")), redirects)


@R.query(
    """WITH k AS (SELECT p_brand, list(DISTINCT p_size) AS sizes FROM part WHERE p_partkey % 2 = 0 GROUP BY 1),
j AS (SELECT p_brand, list(DISTINCT p_size) AS sizes FROM part WHERE p_partkey % 2 = 1 AND p_size > 45 GROUP BY 1)
SELECT k.p_brand, list_has_any(k.sizes, j.sizes) AS overlap FROM k JOIN j USING (p_brand)"""
)
def join_overlap_check(t: Tables) -> DataFrame:
    k = t.part.filter("p_partkey % 2 = 0").groupBy("p_brand").agg(F.collect_set("p_size").alias("a"))
    j = t.part.filter("p_partkey % 2 = 1 AND p_size > 45").groupBy("p_brand").agg(F.collect_set("p_size").alias("b"))
    return k.join(j, "p_brand").select("p_brand", F.arrays_overlap("a", "b").alias("overlap"))


@R.query(
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE (l_partkey % 4 = 0 OR l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 25))
AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)"""
)
def visible_sources(t: Tables) -> DataFrame:
    """A source counts if every key that it names is visible; a null key needs no match."""
    rows = t.lineitem.withColumn("bench", F.when(F.col("l_partkey") % 4 != 0, F.col("l_partkey")))
    benches = t.part.filter("p_size > 25").select(F.col("p_partkey").alias("bench"), F.lit(True).alias("seen"))
    makers = t.supplier.filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    seen = rows.join(benches, "bench", "left").filter("bench IS NULL OR seen")
    return seen.join(makers, "l_suppkey", "left_semi").select("l_orderkey", "l_linenumber", "l_partkey")


@R.query(
    """WITH n AS (SELECT p_type, p_name, 'known' AS status FROM part WHERE p_size = 1 GROUP BY ALL)
SELECT p_partkey, coalesce(status, 'unknown') AS status FROM part LEFT JOIN n USING (p_type, p_name)"""
)
def memo_distinct_join(t: Tables) -> DataFrame:
    """Look up each distinct (kind, name) once, then join back."""
    names = t.part.select("p_type", "p_name").distinct()
    titles = t.part.filter("p_size = 1").select("p_type", "p_name").distinct().withColumn("status", F.lit("known"))
    looked = names.join(titles, ["p_type", "p_name"], "left").na.fill("unknown", ["status"])
    return t.part.select("p_partkey", "p_type", "p_name").join(looked, ["p_type", "p_name"]).select("p_partkey", "status")


@R.query(
    """SELECT 'orders' AS side, o_orderkey AS key FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'lineitem', l_orderkey FROM (SELECT DISTINCT l_orderkey FROM lineitem) WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"""
)
def integrity_two_way(t: Tables) -> DataFrame:
    return links.two_way(t.orders.select(F.col("o_orderkey").alias("key")), "orders", t.lineitem.select(F.col("l_orderkey").alias("key")), "lineitem")


@R.query(
    """SELECT 'lineitem.l_partkey' AS reference, count(*) AS broken FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'orders.o_custkey', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0)"""
)
def integrity_fk_anti(t: Tables) -> DataFrame:
    a = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left_anti")
    known = t.customer.filter("c_custkey % 10 != 0")
    b = t.orders.join(known, F.col("o_custkey") == F.col("c_custkey"), "left_anti")
    count = lambda df, name: df.agg(F.lit(name).alias("reference"), F.count("*").alias("broken"))
    return count(a, "lineitem.l_partkey").union(count(b, "orders.o_custkey"))


@R.query(
    """WITH p AS (SELECT o_orderkey AS path, 'site-' || (o_orderkey % 4) || '/' || o_orderkey AS public FROM orders WHERE o_orderkey % 3 = 0)
SELECT l_orderkey AS owner, l_linenumber AS at, l_partkey AS part, coalesce(public, CAST(l_orderkey AS VARCHAR)) AS ref, public IS NOT NULL AS changed
FROM lineitem LEFT JOIN p ON path = l_orderkey"""
)
def rewrite_refs(t: Tables) -> DataFrame:
    placed = t.orders.filter("o_orderkey % 3 = 0").select(
        F.col("o_orderkey").alias("l_orderkey"), F.concat(F.lit("site-"), F.col("o_orderkey") % 4, F.lit("/"), "o_orderkey").alias("public")
    )
    rows = t.lineitem.join(placed, "l_orderkey", "left")
    return rows.select(
        F.col("l_orderkey").alias("owner"), F.col("l_linenumber").alias("at"), F.col("l_partkey").alias("part"),
        F.coalesce("public", F.col("l_orderkey").cast("string")).alias("ref"), F.col("public").isNotNull().alias("changed"),
    )


@R.query(
    """SELECT p_partkey, coalesce(n1.n_name, n2.n_name, 'Other') AS category FROM part
LEFT JOIN nation n1 ON n1.n_nationkey = CASE WHEN p_size <= 10 THEN p_size END LEFT JOIN nation n2 ON n2.n_nationkey = p_partkey % 50"""
)
def category_fallback(t: Tables) -> DataFrame:
    label = t.nation.select(F.col("n_nationkey").alias("k1"), F.col("n_name").alias("label"))
    fact = t.nation.select(F.col("n_nationkey").alias("k2"), F.col("n_name").alias("fact"))
    first = F.when(F.col("p_size") <= 10, F.col("p_size"))
    return (
        t.part.join(label, first == F.col("k1"), "left").join(fact, F.col("p_partkey") % 50 == F.col("k2"), "left")
        .select("p_partkey", F.coalesce("label", "fact", F.lit("Other")).alias("category"))
    )


_TITLES = """SELECT CASE WHEN p_partkey % 5 = 0 THEN 'Wiki:Gear/' WHEN p_partkey % 5 = 1 THEN 'Items/' ELSE 'Other/' END || upper(replace(p_name, ' ', '_')) ||
 CASE WHEN p_partkey % 2 = 0 THEN '' ELSE '_' || p_brand END AS title FROM part WHERE p_size < 12"""


@R.query(
    f"""WITH t AS (SELECT DISTINCT title FROM ({_TITLES})), k AS (SELECT lower(trim(replace(regexp_extract(title, '/([^/]*)$', 1), '_', ' '))) AS k, count(*) AS n, min(title) AS title FROM t
 WHERE starts_with(title, 'Wiki:Gear/') OR starts_with(title, 'Items/') GROUP BY 1)
SELECT p_partkey AS id, CASE WHEN n IS NULL THEN 'missing' WHEN n = 1 THEN 'matched' ELSE 'unavailable' END AS status, CASE WHEN n IS NULL THEN 'no-exact-title' WHEN n = 1 THEN 'exact-title' ELSE 'ambiguous-title' END AS reason,
 CASE WHEN n = 1 THEN title END AS title FROM part LEFT JOIN k ON k = lower(trim(p_name))"""
)
def join_title_exact(t: Tables) -> DataFrame:
    """Names against normalized titles under two prefixes: matched, missing or ambiguous."""
    titles = t.sql(_TITLES.replace("FROM part", "FROM {part}"))
    return links.title_match(t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")), titles, ["Wiki:Gear", "Items"])


@R.query("SELECT l_orderkey, l_linenumber, l_partkey, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey")
def evidence_join(t: Tables) -> DataFrame:
    """Rows joined with their evidence; a missing or doubled key fails the job."""
    known = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return links.require(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), known, "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey", "p_brand")


@R.query(
    """WITH RECURSIVE w(key, place, hops) AS (SELECT p_partkey, p_partkey, 0 FROM part UNION ALL SELECT key, p.p_partkey // 2, hops + 1 FROM w JOIN part p ON p.p_partkey = w.place WHERE p.p_size <= 30 AND p.p_partkey > 1)
SELECT key, CASE WHEN p_size > 30 THEN place END AS holder FROM (SELECT key, arg_max(place, hops) AS place FROM w GROUP BY key) JOIN part ON p_partkey = place"""
)
def inherited_member(t: Tables) -> DataFrame:
    """The nearest class at or above one that has the member itself; bases (key div 2) are followed to their end, and a cycle has none."""
    bases = t.part.filter("p_size <= 30 AND p_partkey > 1").select(F.col("p_partkey").alias("key"), F.expr("p_partkey div 2").alias("to"))
    ends = links.chain_ends(t.part.select(F.col("p_partkey").alias("key")), bases)
    has = t.part.filter("p_size > 30").select(F.col("p_partkey").alias("destination"), F.col("p_partkey").alias("holder"))
    return ends.join(has, "destination", "left").select("key", "holder")
