"""Aggregations, distinct and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestack.operators import packing
from lodestack.plans.base import Registry, Tables

R = Registry()


@R.query("SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand")
def count_by_topic(t: Tables) -> DataFrame:
    return t.part.groupBy("p_brand").agg(F.count("*").alias("n"))


@R.query("SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ROLLUP (p_brand, p_type)")
def rollup_topic_kind(t: Tables) -> DataFrame:
    return t.part.rollup("p_brand", "p_type").agg(F.count("*").alias("n"))


@R.query(
    """SELECT s_nationkey, to_json(list(DISTINCT l_partkey ORDER BY l_partkey)) AS parts
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY s_nationkey"""
)
def collect_set_sorted(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"))
    return rows.groupBy("s_nationkey").agg(F.to_json(F.array_sort(F.collect_set("l_partkey"))).alias("parts"))


@R.query(
    """WITH o AS (SELECT l_orderkey, max(l_partkey) AS output, count(DISTINCT l_partkey) AS k FROM lineitem GROUP BY 1)
SELECT l_orderkey AS recipe, l_partkey AS item, CAST(sum(l_quantity) AS BIGINT) AS count
FROM lineitem JOIN o USING (l_orderkey) WHERE k >= 2 AND l_partkey <> output GROUP BY 1, 2"""
)
def recipe_ingredients(t: Tables) -> DataFrame:
    """Ingredients of each order, amounts of repeated parts merged; the output part is left out."""
    lines = t.lineitem.groupBy("l_orderkey", "l_partkey").agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("q"))
    output = lines.groupBy("l_orderkey").agg(F.max("l_partkey").alias("output"))
    return (
        lines.join(output, "l_orderkey")
        .filter("l_partkey != output")
        .select(F.col("l_orderkey").alias("recipe"), F.col("l_partkey").alias("item"), F.col("q").cast("long").alias("count"))
    )


@R.query(
    """WITH w AS (SELECT l_suppkey, l_partkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS w FROM lineitem GROUP BY 1, 2),
c AS (SELECT l_suppkey, l_partkey, CAST(w AS DOUBLE) / greatest(1.0, CAST(sum(w) OVER (PARTITION BY l_suppkey) AS DOUBLE)) AS c FROM w)
SELECT l_partkey AS item, max(c) AS chance FROM c JOIN supplier ON s_suppkey = l_suppkey WHERE s_nationkey = 0 GROUP BY 1"""
)
def base_max_chance(t: Tables) -> DataFrame:
    """Best chance per item at one place, the nation 0."""
    weights = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("w"))
    totals = weights.groupBy("l_suppkey").agg(F.sum("w").alias("total"))
    near = t.supplier.filter("s_nationkey = 0").select(F.col("s_suppkey").alias("l_suppkey"))
    chance = F.col("w").cast("double") / F.greatest(F.lit(1.0), F.col("total").cast("double"))
    return weights.join(near, "l_suppkey").join(totals, "l_suppkey").groupBy(F.col("l_partkey").alias("item")).agg(
        F.max(chance).alias("chance")
    )


R.sql("distinct_sorted", "SELECT DISTINCT p_type, p_size FROM {part} ORDER BY p_type, p_size")


@R.query(
    """SELECT o_custkey, bool_or(o_orderstatus = 'F') AS any_final, bool_and(o_totalprice > 1000) AS all_large
FROM orders GROUP BY o_custkey"""
)
def bool_aggs(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(
        F.bool_or(F.col("o_orderstatus") == "F").alias("any_final"), F.bool_and(F.col("o_totalprice") > 1000).alias("all_large")
    )


@R.query(
    """WITH c AS (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY 1, 2)
SELECT p_brand, p_size AS mode FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_size) AS k FROM c) WHERE k = 1"""
)
def mode_min_tie(t: Tables) -> DataFrame:
    """Most frequent value; the least one among ties."""
    counts = t.part.groupBy("p_brand", "p_size").agg(F.count("*").alias("n"))
    return counts.groupBy("p_brand").agg(F.min_by("p_size", F.struct(-F.col("n"), F.col("p_size"))).alias("mode"))


@R.query("SELECT l_suppkey, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY l_suppkey")
def count_distinct(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("n"))


@R.query(
    """WITH i AS (SELECT 'negative-value' AS code, event_type AS topic, event_id FROM events WHERE value < 10
UNION ALL SELECT 'small-k', event_type, event_id FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) < 5)
SELECT substr(sha256(code || '|' || topic), 1, 24) AS id, code, topic, count(*) AS occurrences,
       array_to_string(list_slice(list(DISTINCT CAST(event_id AS VARCHAR) ORDER BY CAST(event_id AS VARCHAR)), 1, 8), ',') AS examples
FROM i GROUP BY code, topic"""
)
def exception_report(t: Tables) -> DataFrame:
    """Grouped exceptions: id of code and topic, occurrences and the first eight sorted examples."""
    k = F.get_json_object("props", "$.k").cast("long")
    rules = F.array_compact(
        F.array(F.when(F.col("value") < 10, F.lit("negative-value")), F.when(k < 5, F.lit("small-k")))
    )
    issues = t.events.select(F.explode(rules).alias("code"), F.col("event_type").alias("topic"), F.col("event_id").cast("string").alias("e"))
    counts = issues.groupBy("code", "topic").agg(F.count("*").alias("occurrences"))
    # Only the first eight of a group are ever gathered.
    order = Window.partitionBy("code", "topic").orderBy("e")
    examples = (
        issues.distinct().withColumn("k", F.row_number().over(order)).filter("k <= 8")
        .groupBy("code", "topic").agg(F.array_join(F.array_sort(F.collect_list("e")), ",").alias("examples"))
    )
    key = F.substring(F.sha2(F.concat_ws("|", "code", "topic"), 256), 1, 24)
    return counts.join(examples, ["code", "topic"]).select(key.alias("id"), "code", "topic", "occurrences", "examples")


@R.query(
    """SELECT p_type, count(*) AS n, array_to_string(list_slice(list(p_partkey ORDER BY p_partkey), 1, 8), ',') AS examples
FROM part GROUP BY p_type"""
)
def type_summary(t: Tables) -> DataFrame:
    first = Window.partitionBy("p_type").orderBy("p_partkey")
    return (
        t.part.select("p_type", "p_partkey", F.row_number().over(first).alias("k"))
        .groupBy("p_type")
        .agg(
            F.count("*").alias("n"),
            F.array_join(F.array_sort(F.collect_list(F.when(F.col("k") <= 8, F.col("p_partkey")))), ",").alias("examples"),
        )
    )


@R.query(
    """SELECT p_name, p_brand, p_type, p_size FROM part GROUP BY ALL HAVING count(*) = 1"""
)
def unique_keys(t: Tables) -> DataFrame:
    names = ["p_name", "p_brand", "p_type", "p_size"]
    return t.part.groupBy(*names).count().filter("count = 1").select(*names)


@R.query(
    """WITH d AS (SELECT doc_id, md5(text) AS sig, doc_id % 2 AS side,
  row_number() OVER (PARTITION BY md5(text), doc_id % 2 ORDER BY doc_id) AS k FROM documents)
SELECT a.doc_id AS old_id, b.doc_id AS new_id FROM d a JOIN d b ON a.sig = b.sig AND a.k = b.k WHERE a.side = 0 AND b.side = 1"""
)
def multiset_moved(t: Tables) -> DataFrame:
    """Equal signatures of two captures paired by occurrence number, so each row moves at most once."""
    order = Window.partitionBy("sig", "side").orderBy("doc_id")
    rows = t.documents.select("doc_id", F.md5("text").alias("sig"), (F.col("doc_id") % 2).alias("side"))
    rows = rows.withColumn("k", F.row_number().over(order))
    old, new = (rows.filter(F.col("side") == s).select("sig", "k", F.col("doc_id").alias(n)) for s, n in ((0, "old_id"), (1, "new_id")))
    return old.join(new, ["sig", "k"]).select("old_id", "new_id")


@R.query(
    """SELECT user_id, CASE WHEN bool_or(event_type = 'error') THEN 'error' WHEN bool_or(event_type = 'purchase') THEN 'purchase'
 WHEN bool_or(event_type = 'click') THEN 'click' ELSE 'not-run' END AS status FROM events GROUP BY user_id"""
)
def status_priority(t: Tables) -> DataFrame:
    """Worst status wins."""
    rank = F.when(F.col("event_type") == "error", 0).when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "click", 2)
    names = F.array(*[F.lit(x) for x in ("error", "purchase", "click", "not-run")])
    return t.events.groupBy("user_id").agg(F.get(names, F.coalesce(F.min(rank), F.lit(3))).alias("status"))


@R.query(
    """SELECT o_orderpriority AS parent, min(o_orderkey) AS first, max(o_orderkey) AS last, count(*) AS count
FROM orders GROUP BY o_orderpriority"""
)
def range_rollup(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_orderpriority").alias("parent")).agg(
        F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"), F.count("*").alias("count")
    )


@R.query(
    """SELECT source, CAST(sum(n_chars) AS BIGINT) AS bytes, count(*) AS objects
FROM (SELECT DISTINCT source, md5(text) AS h, n_chars FROM documents) GROUP BY source"""
)
def dedup_bytes(t: Tables) -> DataFrame:
    """Size of shared objects: each content counts once per partition."""
    return (
        t.documents.select("source", F.md5("text").alias("h"), "n_chars").distinct().groupBy("source")
        .agg(F.sum("n_chars").alias("bytes"), F.count("*").alias("objects"))
    )


@R.query(
    """SELECT o_orderpriority, sha256(string_agg(md5(o_orderkey || ':' || o_orderstatus), '' ORDER BY o_orderkey)) AS fingerprint
FROM orders GROUP BY o_orderpriority"""
)
def dataset_fingerprint(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderpriority", "o_orderkey", F.md5(F.concat_ws(":", "o_orderkey", "o_orderstatus")).alias("h")
    )
    return packing.running_digest(rows, "o_orderpriority", "o_orderkey", "sha256").withColumnRenamed("digest", "fingerprint")


@R.query(
    """SELECT count(*) AS objects, CAST(sum(n) AS BIGINT) AS bytes, max(n) AS largest
FROM (SELECT md5(text) AS h, max(n_chars) AS n FROM documents GROUP BY 1)"""
)
def size_stats(t: Tables) -> DataFrame:
    objects = t.documents.groupBy(F.md5("text").alias("h")).agg(F.max("n_chars").alias("n"))
    return objects.agg(F.count("*").alias("objects"), F.sum("n").alias("bytes"), F.max("n").alias("largest"))


R.sql("status_summary", "SELECT event_type AS status, count(*) AS n FROM {events} GROUP BY event_type")


@R.query(
    """SELECT user_id, event_type, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total,
 arg_max(event_id, {'t': ts, 'e': event_id}) AS last_event FROM events GROUP BY user_id, event_type"""
)
def phase_times(t: Tables) -> DataFrame:
    """Time per phase with the outcome of its last record."""
    return t.events.groupBy("user_id", "event_type").agg(
        F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total"),
        F.max_by("event_id", F.struct("ts", "event_id")).alias("last_event"),
    )


@R.query(
    "SELECT o_orderkey AS key FROM orders UNION ALL SELECT c_custkey FROM customer"
)
def union_all_entities(t: Tables) -> DataFrame:
    a = t.orders.select(F.col("o_orderkey").alias("key"))
    return a.unionByName(t.customer.select(F.col("c_custkey").alias("key")))


@R.query(
    """SELECT 'both' AS side, count(*) AS n FROM (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A')
UNION ALL SELECT 'either', count(*) FROM (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' UNION SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A')
UNION ALL SELECT 'first', count(*) FROM (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A')"""
)
def set_ops_keys(t: Tables) -> DataFrame:
    """Union, intersection and difference of two key sets from one aggregate instead of three scans."""
    sides = t.lineitem.groupBy("l_partkey").agg(
        F.bool_or(F.col("l_returnflag") == "R").alias("r"), F.bool_or(F.col("l_returnflag") == "A").alias("a")
    )
    counts = sides.agg(
        F.count_if(F.expr("r AND a")).alias("both"), F.count_if(F.expr("r OR a")).alias("either"), F.count_if(F.expr("r AND NOT a")).alias("first")
    )
    return counts.selectExpr("stack(3, 'both', both, 'either', either, 'first', first) AS (side, n)")


#: One plan under the names of the operators that it serves.
_MANIFEST = """WITH o AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 7 <> 0),
n AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 5 <> 0)
SELECT coalesce(o.o_orderkey, n.o_orderkey) AS path, CASE WHEN o.o_orderkey IS NULL THEN 'add' WHEN n.o_orderkey IS NULL THEN 'delete' ELSE 'change' END AS op
FROM o FULL JOIN n USING (o_orderkey) WHERE o.o_orderstatus IS DISTINCT FROM n.o_orderstatus"""


@R.query(_MANIFEST, name="manifest_diff")
@R.query(_MANIFEST, name="join_full_outer_diff")
@R.query(_MANIFEST, name="changed_paths_orders")
def manifest_diff(t: Tables) -> DataFrame:
    """Adds, changes and deletes between two inventories; here two views of the orders stand for two revisions."""
    o = t.orders.filter("o_orderkey % 7 != 0").select("o_orderkey", F.col("o_orderstatus").alias("old"))
    status = F.when(F.col("o_orderkey") % 11 == 0, "X").otherwise(F.col("o_orderstatus"))
    n = t.orders.filter("o_orderkey % 5 != 0").select("o_orderkey", status.alias("new"))
    op = F.when(F.col("old").isNull(), "add").when(F.col("new").isNull(), "delete").otherwise("change")
    return o.join(n, "o_orderkey", "full").filter("NOT (old <=> new)").select(F.col("o_orderkey").alias("path"), op.alias("op"))


@R.query(
    """SELECT l_partkey AS item, min(n_regionkey) AS region FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
JOIN nation ON n_nationkey = s_nationkey WHERE l_quantity >= 45 GROUP BY 1 HAVING count(DISTINCT n_regionkey) = 1"""
)
def subset_exclusive(t: Tables) -> DataFrame:
    """Items whose regions all lie inside one region."""
    return _placed(t, "l_quantity >= 45").groupBy(F.col("l_partkey").alias("item")).agg(
        F.min("n_regionkey").alias("region"), F.max("n_regionkey").alias("last")
    ).filter("region = last").select("item", "region")


def _placed(t: Tables, where: str = "true") -> DataFrame:
    places = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_regionkey")
    return t.lineitem.filter(where).select("l_partkey", "l_suppkey").distinct().join(places, F.col("s_suppkey") == F.col("l_suppkey"))


@R.query(
    """SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE o_orderdate >= TIMESTAMP '1998-07-01' AND l_quantity >= 48)"""
)
def gc_unreachable(t: Tables) -> DataFrame:
    """What no live order keeps."""
    live = t.orders.filter("o_orderdate >= timestamp'1998-07-01'").select(F.col("o_orderkey").alias("l_orderkey"))
    keep = t.lineitem.filter("l_quantity >= 48").join(live, "l_orderkey", "left_semi").select(F.col("l_partkey").alias("p_partkey"))
    return t.part.select("p_partkey").join(keep, "p_partkey", "left_anti")


@R.query(
    """SELECT md5(text) AS sha, n_chars AS bytes, count(*) AS files, CAST((count(*) - 1) * n_chars AS BIGINT) AS saved
FROM documents GROUP BY 1, 2 HAVING count(*) > 1"""
)
def dup_by_hash(t: Tables) -> DataFrame:
    groups = t.documents.groupBy(F.md5("text").alias("sha"), F.col("n_chars").alias("bytes")).agg(F.count("*").alias("files"))
    return groups.filter("files > 1").withColumn("saved", (F.col("files") - 1) * F.col("bytes"))


@R.query(
    """SELECT l_partkey AS item, min(n_regionkey) AS ring FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
JOIN nation ON n_nationkey = s_nationkey GROUP BY 1"""
)
def first_located(t: Tables) -> DataFrame:
    """Each item with the region where it is located and in none earlier."""
    return _placed(t).groupBy(F.col("l_partkey").alias("item")).agg(F.min("n_regionkey").alias("ring"))
