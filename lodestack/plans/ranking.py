"""Ranking, top-k, sort and limit; filters and validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestack.plans.base import Registry, Tables

R = Registry()


@R.query(
    """SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_size NULLS LAST, p_retailprice DESC, lower(p_name), p_partkey) AS rank FROM part"""
)
def sort_multikey(t: Tables) -> DataFrame:
    """Total order by several keys within each brand."""
    order = Window.partitionBy("p_brand").orderBy(F.asc_nulls_last("p_size"), F.desc("p_retailprice"), F.lower("p_name"), "p_partkey")
    return t.part.select("p_partkey", F.row_number().over(order).cast("long").alias("rank"))


@R.query(
    """SELECT l_partkey AS item, arg_min(l_suppkey, {'c': -w, 's': l_suppkey}) AS supplier, max(w) AS weight
FROM (SELECT l_partkey, l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS w FROM lineitem GROUP BY 1, 2) GROUP BY 1""",
    name="top1_mining",
)
def top1_mining(t: Tables) -> DataFrame:
    w = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").cast("long").alias("w"))
    return w.groupBy(F.col("l_partkey").alias("item")).agg(
        F.min_by("l_suppkey", F.struct(-F.col("w"), "l_suppkey")).alias("supplier"), F.max("w").alias("weight")
    )


_LIMITED = """SELECT p_type, p_partkey, k, greatest(n - 10, 0) AS remainder FROM (SELECT p_type, p_partkey,
 row_number() OVER (PARTITION BY p_type ORDER BY lower(p_name), p_partkey) AS k, count(*) OVER (PARTITION BY p_type) AS n FROM part) WHERE k <= 10"""


@R.query(_LIMITED)
def limit_per_group(t: Tables) -> DataFrame:
    """First ten of each type and how many more there are; counts are summed apart from the ranking."""
    order = Window.partitionBy("p_type").orderBy(F.lower("p_name"), "p_partkey")
    top = t.part.select("p_type", "p_partkey", F.row_number().over(order).cast("long").alias("k")).filter("k <= 10")
    counts = t.part.groupBy("p_type").agg(F.greatest(F.count("*") - 10, F.lit(0)).alias("remainder"))
    return top.join(counts, "p_type").select("p_type", "p_partkey", "k", "remainder")


@R.query(
    """SELECT p_brand, array_to_string(list_slice(list(DISTINCT p_type ORDER BY p_type), 1, 3), ', ') ||
 CASE WHEN count(DISTINCT p_type) > 3 THEN ' and ' || (count(DISTINCT p_type) - 3) || ' more' ELSE '' END AS label FROM part GROUP BY p_brand"""
)
def capped_list(t: Tables) -> DataFrame:
    kinds = F.array_sort(F.collect_set("p_type"))
    more = F.size("kinds") - 3
    text = F.concat(F.array_join(F.slice("kinds", 1, 3), ", "), F.when(more > 0, F.concat(F.lit(" and "), more, F.lit(" more"))).otherwise(""))
    return t.part.groupBy("p_brand").agg(kinds.alias("kinds")).select("p_brand", text.alias("label"))


@R.query(
    """WITH c AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS k, count(*) OVER (PARTITION BY p_brand) AS m FROM c)
SELECT p_brand, p_type, n, greatest(m - 3, 0) AS more FROM r WHERE k <= 3"""
)
def top_families(t: Tables) -> DataFrame:
    c = t.part.groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))
    w = Window.partitionBy("p_brand")
    ranked = c.withColumns({"k": F.row_number().over(w.orderBy(F.desc("n"), "p_type")), "m": F.count("*").over(w)})
    return ranked.filter("k <= 3").select("p_brand", "p_type", "n", F.greatest(F.col("m") - 3, F.lit(0)).alias("more"))


@R.query(
    """SELECT event_type, n, row_number() OVER (ORDER BY event_type = 'view', n DESC, event_type) AS place FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1)"""
)
def custom_order(t: Tables) -> DataFrame:
    """One kind always last, the others by size; the window runs over a handful of groups."""
    counts = t.events.groupBy("event_type").agg(F.count("*").alias("n"))
    order = Window.orderBy(F.col("event_type") == "view", F.desc("n"), "event_type")
    return counts.withColumn("place", F.row_number().over(order).cast("long"))


@R.query(
    """SELECT user_id, event_id, ts FROM (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events)
WHERE k = 1 ORDER BY ts DESC, event_id DESC LIMIT 4"""
)
def latest_per_version(t: Tables) -> DataFrame:
    last = t.events.groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).alias("x"))
    return last.select("user_id", "x.event_id", "x.ts").orderBy(F.desc("ts"), F.desc("event_id")).limit(4)


@R.query("SELECT user_id, max(event_id) AS attempt, arg_max(event_type, event_id) AS state FROM events GROUP BY user_id")
def max_by_attempt(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.max("event_id").alias("attempt"), F.max_by("event_type", "event_id").alias("state"))


@R.query(
    """SELECT e.event_id, max_by(p.event_id, {'t': p.ts, 'e': p.event_id}) AS previous FROM events e LEFT JOIN events p
ON p.user_id = e.user_id AND p.event_type = 'purchase' AND (p.ts < e.ts OR (p.ts = e.ts AND p.event_id < e.event_id)) WHERE e.event_type = 'error' GROUP BY e.event_id"""
)
def asof_previous(t: Tables) -> DataFrame:
    """Latest earlier purchase of each error: one window over both kinds instead of a range join."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = t.events.filter("event_type IN ('error', 'purchase')")
    bought = F.last(F.when(F.col("event_type") == "purchase", F.col("event_id")), ignorenulls=True).over(order)
    return rows.withColumn("previous", bought).filter("event_type = 'error'").select("event_id", "previous")


@R.query(
    """SELECT p_partkey, CASE WHEN n > 1 THEN p_name || ' (variant ' || k || ')' ELSE p_name END AS name FROM (SELECT p_partkey, p_name,
 row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS k, count(*) OVER (PARTITION BY p_name) AS n FROM part)"""
)
def ordinal_suffix(t: Tables) -> DataFrame:
    w = Window.partitionBy("p_name")
    k, n = F.row_number().over(w.orderBy("p_partkey")), F.count("*").over(w)
    name = F.when(F.col("n") > 1, F.concat("p_name", F.lit(" (variant "), "k", F.lit(")"))).otherwise(F.col("p_name"))
    return t.part.select("p_partkey", "p_name", k.alias("k"), n.alias("n")).select("p_partkey", name.alias("name"))


@R.query(
    """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS ordinal FROM orders)
SELECT o_orderkey, ordinal FROM r WHERE ordinal < 1000 ORDER BY ordinal DESC LIMIT 50"""
)
def keyset_page(t: Tables) -> DataFrame:
    """Page below a cursor. The ordinals below it need the first rows only, so the sort is a bounded top-k."""
    first = t.orders.orderBy("o_orderdate", "o_orderkey").limit(999).select("o_orderdate", "o_orderkey")
    ordinal = F.row_number().over(Window.orderBy("o_orderdate", "o_orderkey")).cast("long")
    return first.select("o_orderkey", ordinal.alias("ordinal")).orderBy(F.desc("ordinal")).limit(50)


@R.query(
    """SELECT letter, p_partkey FROM (SELECT upper(substr(p_name, 1, 1)) AS letter, p_partkey,
 row_number() OVER (PARTITION BY upper(substr(p_name, 1, 1)) ORDER BY p_name, p_partkey) AS k FROM part) WHERE k <= 900"""
)
def alpha_index(t: Tables) -> DataFrame:
    letter = F.upper(F.substring("p_name", 1, 1))
    rows = t.part.select(letter.alias("letter"), "p_name", "p_partkey")
    order = Window.partitionBy("letter").orderBy("p_name", "p_partkey")
    return rows.withColumn("k", F.row_number().over(order)).filter("k <= 900").select("letter", "p_partkey")


_REPORT = """WITH a AS (SELECT p_partkey % 300 AS id, max(p_size) AS v FROM part WHERE p_partkey % 3 <> 0 GROUP BY 1),
b AS (SELECT p_partkey % 350 AS id, max(p_size) AS v FROM part WHERE p_partkey % 4 <> 0 AND p_partkey % 350 > 20 GROUP BY 1)
SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.id IS NULL THEN 'new' WHEN b.id IS NULL THEN 'resolved' WHEN a.v = b.v THEN 'unchanged' ELSE 'changed' END AS state
FROM a FULL JOIN b ON a.id = b.id"""


@R.query(_REPORT)
def report_diff(t: Tables) -> DataFrame:
    a = t.part.filter("p_partkey % 3 != 0").groupBy((F.col("p_partkey") % 300).alias("id")).agg(F.max("p_size").alias("a"))
    b = t.part.filter("p_partkey % 4 != 0 AND p_partkey % 350 > 20").groupBy((F.col("p_partkey") % 350).alias("id")).agg(F.max("p_size").alias("b"))
    state = F.when(F.col("a").isNull(), "new").when(F.col("b").isNull(), "resolved").when(F.col("a") == F.col("b"), "unchanged").otherwise("changed")
    return a.join(b, "id", "full").select("id", state.alias("state"))


@R.query(
    """WITH m AS (SELECT l_partkey AS item, date_trunc('year', l_shipdate) AS snap, sum(CAST(l_quantity AS DECIMAL(18,2))) AS v FROM lineitem GROUP BY 1, 2),
c AS (SELECT *, lag(v) OVER (PARTITION BY item ORDER BY snap) IS DISTINCT FROM v AS changed FROM m)
SELECT item, min(snap) AS first_seen, max(snap) AS last_seen, max(snap) FILTER (WHERE changed) AS last_changed FROM c GROUP BY item"""
)
def seen_ledger(t: Tables) -> DataFrame:
    months = t.lineitem.groupBy(F.col("l_partkey").alias("item"), F.date_trunc("year", "l_shipdate").alias("snap")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("v")
    )
    before = F.lag("v").over(Window.partitionBy("item").orderBy("snap"))
    rows = months.withColumn("changed", ~before.eqNullSafe(F.col("v")))
    return rows.groupBy("item").agg(
        F.min("snap").alias("first_seen"), F.max("snap").alias("last_seen"), F.max(F.when(F.col("changed"), F.col("snap"))).alias("last_changed")
    )


@R.query(
    """SELECT p_brand, p_partkey FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS k,
 count(*) OVER (PARTITION BY p_brand) AS n FROM part) WHERE k = 1 OR k = n // 2 + 1 OR k = n"""
)
def sample_first_mid_last(t: Tables) -> DataFrame:
    w = Window.partitionBy("p_brand")
    rows = t.part.select("p_brand", "p_partkey", F.row_number().over(w.orderBy("p_partkey")).cast("long").alias("k"), F.count("*").over(w).alias("n"))
    return rows.filter("k = 1 OR k = n div 2 + 1 OR k = n").select("p_brand", "p_partkey")


@R.query(
    """SELECT event_type, CAST(round(CAST(100.0 * count(*) / (SELECT count(*) FROM events) AS DECIMAL(18,6)), 2) AS DOUBLE) AS share FROM events GROUP BY 1"""
)
def share_of_total(t: Tables) -> DataFrame:
    counts = t.events.groupBy("event_type").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select("event_type", F.round((F.lit(100.0) * F.col("n") / total).cast("decimal(18,6)"), 2).cast("double").alias("share"))


@R.query(
    """SELECT path, row_number() OVER (PARTITION BY CAST(regexp_extract(path, '/(\\d+)/', 1) AS INT) % 7 ORDER BY CAST(regexp_extract(path, '/(\\d+)/', 1) AS INT)) AS place
FROM (SELECT 'rows/' || p_partkey || '/size' AS path FROM part)"""
)
def order_by_path_index(t: Tables) -> DataFrame:
    rows = t.part.select(F.concat(F.lit("rows/"), "p_partkey", F.lit("/size")).alias("path"))
    rows = rows.withColumn("i", F.regexp_extract("path", r"/(\d+)/", 1).cast("int"))
    return rows.select("path", F.row_number().over(Window.partitionBy(F.col("i") % 7).orderBy("i")).cast("long").alias("place"))


@R.query(
    """SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_size > 40 THEN NULL ELSE p_size END NULLS LAST, p_partkey) AS place FROM part"""
)
def sort_nulls_last(t: Tables) -> DataFrame:
    depth = F.when(F.col("p_size") <= 40, F.col("p_size"))
    return t.part.select("p_brand", "p_partkey", F.row_number().over(Window.partitionBy("p_brand").orderBy(depth.asc_nulls_last(), "p_partkey")).cast("long").alias("place"))


@R.query(
    """SELECT user_id, CAST(round(sum(CAST(value AS DECIMAL(18,4))), 2) AS DOUBLE) AS wall FROM events GROUP BY user_id ORDER BY sum(CAST(value AS DECIMAL(18,4))) DESC, user_id LIMIT 3"""
)
def timing_top3(t: Tables) -> DataFrame:
    wall = t.events.groupBy("user_id").agg(F.sum(F.col("value").cast("decimal(18,4)")).alias("w"))
    return wall.orderBy(F.desc("w"), "user_id").limit(3).select("user_id", F.round("w", 2).cast("double").alias("wall"))


# Filters and validation


@R.query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 100000")
def filter_present(t: Tables) -> DataFrame:
    return t.orders.filter((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 100000)).select("o_orderkey")


@R.query(
    """SELECT class, count(*) AS n FROM (SELECT CASE WHEN p_size <= 5 THEN 'tiny' WHEN p_name LIKE '%blue%' THEN 'blue' WHEN p_brand IN ('Brand#11', 'Brand#22') THEN 'branded'
 WHEN p_retailprice > 1500 THEN 'costly' WHEN p_type IS NULL THEN 'untyped' ELSE 'other' END AS class FROM part) GROUP BY class"""
)
def classify_case(t: Tables) -> DataFrame:
    kind = (
        F.when(F.col("p_size") <= 5, "tiny").when(F.col("p_name").contains("blue"), "blue").when(F.col("p_brand").isin("Brand#11", "Brand#22"), "branded")
        .when(F.col("p_retailprice") > 1500, "costly").when(F.col("p_type").isNull(), "untyped").otherwise("other")
    )
    return t.part.groupBy(kind.alias("class")).agg(F.count("*").alias("n"))


@R.query(
    """SELECT l_orderkey AS recipe FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1
HAVING bool_and(coalesce(p_size > 5 AND p_name NOT LIKE '%large%', false))"""
)
def visible_parts(t: Tables) -> DataFrame:
    """Recipes whose every ingredient is visible."""
    shown = t.part.filter("p_size > 5 AND p_name NOT LIKE '%large%'").select(F.col("p_partkey").alias("l_partkey"), F.lit(True).alias("ok"))
    rows = t.lineitem.join(shown, "l_partkey", "left")
    return rows.groupBy(F.col("l_orderkey").alias("recipe")).agg(F.bool_and(F.coalesce("ok", F.lit(False))).alias("ok")).filter("ok").select("recipe")


@R.query("SELECT p_partkey FROM part WHERE NOT regexp_matches(p_name, '^(red|hot)|small$|gr[ae]y')")
def exclude_patterns(t: Tables) -> DataFrame:
    return t.part.filter(~F.col("p_name").rlike("^(red|hot)|small$|gr[ae]y")).select("p_partkey")


@R.query("SELECT p_partkey FROM part WHERE p_size IN (1, 5, 9) OR p_brand = 'Brand#33'")
def condition_match(t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_size").isin(1, 5, 9) | (F.col("p_brand") == "Brand#33")).select("p_partkey")


@R.query(
    """SELECT event_id, CASE WHEN value = 0 THEN 'zero' WHEN props IS NULL OR props = '{}' THEN 'empty' WHEN event_type = 'view' THEN 'equals' WHEN value <= 25 THEN 'max_below' END AS omitted_by FROM events"""
)
def omit_rules(t: Tables) -> DataFrame:
    rule = (
        F.when(F.col("value") == 0, "zero").when(F.col("props").isNull() | (F.col("props") == "{}"), "empty")
        .when(F.col("event_type") == "view", "equals").when(F.col("value") <= 25, "max_below")
    )
    return t.events.select("event_id", rule.alias("omitted_by"))


@R.query("SELECT p_partkey, coalesce(CASE WHEN p_size = 7 THEN 'seven' END, CASE WHEN p_brand LIKE '%#1%' THEN 'ones' END, p_type) AS label FROM part")
def case_override(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey", F.coalesce(F.when(F.col("p_size") == 7, "seven"), F.when(F.col("p_brand").contains("#1"), "ones"), "p_type").alias("label")
    )


@R.query(
    """SELECT p_partkey, CASE WHEN p_retailprice IS NULL THEN 'missing' WHEN p_retailprice < 1000 THEN 'below minimum' WHEN p_retailprice > 1900 THEN 'above maximum'
 WHEN p_size = 13 AND p_brand <> 'Brand#13' THEN 'not equal' END AS reason FROM part"""
)
def assert_rules(t: Tables) -> DataFrame:
    price = F.col("p_retailprice")
    reason = (
        F.when(price.isNull(), "missing").when(price < 1000, "below minimum").when(price > 1900, "above maximum")
        .when((F.col("p_size") == 13) & (F.col("p_brand") != "Brand#13"), "not equal")
    )
    return t.part.select("p_partkey", reason.alias("reason"))


@R.query(
    """WITH s AS (SELECT CASE WHEN count(*) FILTER (WHERE n_name = 'FRANCE') = 1 THEN true ELSE false END AS live FROM nation)
SELECT n_nationkey FROM nation, s WHERE live OR n_regionkey <> 3"""
)
def feature_switch(t: Tables) -> DataFrame:
    """A switch is live if its manager row occurs exactly once; the one-row aggregate rides along as a scalar."""
    live = t.nation.agg((F.count_if(F.col("n_name") == "FRANCE") == 1).alias("live"))
    return t.nation.join(F.broadcast(live), F.col("live") | (F.col("n_regionkey") != 3)).select("n_nationkey")


@R.query("SELECT event_id FROM events WHERE value IS NOT NULL AND isfinite(value) AND value > 90")
def finite_filter(t: Tables) -> DataFrame:
    v = F.col("value")
    return t.events.filter(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")) & (v > 90)).select("event_id")


@R.query(
    """SELECT p_name, p_brand, CASE WHEN count(DISTINCT p_size) = 1 AND min(p_size) > 0 THEN min(p_size) END AS v FROM part GROUP BY ALL"""
)
def single_value_fact(t: Tables) -> DataFrame:
    rows = t.part.groupBy("p_name", "p_brand").agg(F.min("p_size").alias("a"), F.max("p_size").alias("b"))
    return rows.select("p_name", "p_brand", F.when((F.col("a") == F.col("b")) & (F.col("a") > 0), F.col("a")).alias("v"))


@R.query("SELECT page_id, url FROM pages WHERE starts_with(url, 'https://')")
def url_prefix_filter(t: Tables) -> DataFrame:
    return t.pages.filter(F.col("url").startswith("https://")).select("page_id", "url")


@R.query(
    """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) IS NULL THEN 'bad definition' END AS error FROM events"""
)
def bad_definition_rows(t: Tables) -> DataFrame:
    """Bad input becomes an error column, not a failure."""
    parsed = F.from_json("props", "k long, bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"})
    rows = t.events.select("event_id", parsed.alias("x"))
    return rows.select("event_id", "x.k", F.when(F.col("x.k").isNull(), "bad definition").alias("error"))


@R.query(
    """SELECT c_custkey, CASE WHEN n IS NULL THEN 'missing' WHEN last = 'F' THEN 'built' WHEN last = 'P' THEN 'building' WHEN n > 12 THEN 'queued' ELSE 'failed' END AS state
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, arg_max(o_orderstatus, o_orderkey) AS last FROM orders GROUP BY 1) ON o_custkey = c_custkey"""
)
def state_case(t: Tables) -> DataFrame:
    last = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.max_by("o_orderstatus", "o_orderkey").alias("last"))
    state = (
        F.when(F.col("n").isNull(), "missing").when(F.col("last") == "F", "built").when(F.col("last") == "P", "building").when(F.col("n") > 12, "queued").otherwise("failed")
    )
    return t.customer.join(last, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", state.alias("state"))
