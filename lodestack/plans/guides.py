"""Guide queries, reader lookups and packing over the acquisition facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestack.functions import text as X
from lodestack.operators import packing, pointers, publication, receipts, search
from lodestack.plans import acquisition
from lodestack.plans.base import Registry, Tables
from lodestack.session import scratch
from lodestack.sources import files

R = Registry()

_BEST = acquisition.ORACLES["gq_new_materials"]


def best(t: Tables) -> DataFrame:
    return acquisition.new_materials(t.spark, t.sf_dir)


R.queries["best_mining_site"] = lambda spark, sf_dir: acquisition.new_materials(spark, sf_dir).select(F.col("p").alias("item"), "ring", "chance")
R.oracles["best_mining_site"] = f"SELECT p AS item, ring, chance FROM ({_BEST})"


@R.query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 0")
def gq_first_biome(t: Tables) -> DataFrame:
    return t.nation.filter("n_regionkey = 0").select("n_nationkey", "n_name")


@R.query(f"SELECT p AS item, p_name AS name, chance FROM ({_BEST}) JOIN part ON p_partkey = p WHERE ring = 0 AND p_size > 10")
def gq_start_materials(t: Tables) -> DataFrame:
    shown = t.part.filter("p_size > 10").select(F.col("p_partkey").alias("p"), "p_name")
    return best(t).filter("ring = 0").join(shown, "p").select(F.col("p").alias("item"), F.col("p_name").alias("name"), "chance")


_BODY = "b AS (SELECT DISTINCT l_orderkey AS recipe, l_partkey AS item FROM lineitem)"


@R.query(f"WITH s AS ({_BEST}), {_BODY} SELECT recipe FROM b JOIN s ON p = item GROUP BY 1 HAVING bool_and(ring <= 1)")
def gq_hand_recipes(t: Tables) -> DataFrame:
    """Recipes whose every ingredient lies in the first two rings."""
    body = t.lineitem.select(F.col("l_orderkey").alias("recipe"), F.col("l_partkey").alias("p")).distinct()
    return body.join(best(t), "p").groupBy("recipe").agg(F.max("ring").alias("m")).filter("m <= 1").select("recipe")


@R.query("SELECT 'benches' AS intro WHERE EXISTS (SELECT 1 FROM orders WHERE o_totalprice > 100000)")
def gq_exists_intro(t: Tables) -> DataFrame:
    return t.orders.filter("o_totalprice > 100000").limit(1).select(F.lit("benches").alias("intro"))


@R.query("SELECT c_custkey AS bench, coalesce(n, 0) AS unlock_count FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = c_custkey", name="gq_start_benches")
@R.query("SELECT c_custkey AS bench, coalesce(n, 0) AS unlock_count FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = c_custkey", name="gq_benches")
def gq_start_benches(t: Tables) -> DataFrame:
    n = t.orders.filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return t.customer.join(n, "c_custkey", "left").select(F.col("c_custkey").alias("bench"), F.coalesce("n", F.lit(0)).alias("unlock_count"))


_TOP = """SELECT output, recipe FROM (SELECT output, recipe, row_number() OVER (PARTITION BY output ORDER BY ring NULLS LAST, n, recipe) AS k FROM
(SELECT l_orderkey AS recipe, max(l_partkey) AS output, max(ring) AS ring, count(*) AS n FROM lineitem LEFT JOIN s ON p = l_partkey GROUP BY 1)) WHERE k = 1"""


@R.query(f"WITH s AS ({_BEST}) {_TOP}", name="top1_recipe")
@R.query(f"WITH s AS ({_BEST}) {_TOP}", name="gq_start_tools")
def top1_recipe(t: Tables) -> DataFrame:
    """Per output the best recipe by (ring, null last; lines; key)."""
    lines = t.lineitem.join(best(t), F.col("p") == F.col("l_partkey"), "left")
    recipes = lines.groupBy(F.col("l_orderkey").alias("recipe")).agg(F.max("l_partkey").alias("output"), F.max("ring").alias("ring"), F.count("*").alias("n"))
    order = F.struct(F.col("ring").isNull(), "ring", "n", "recipe")
    return recipes.groupBy("output").agg(F.min_by("recipe", order).alias("recipe"))


@R.query("SELECT n_regionkey AS ring, count(*) AS biomes, min(n_name) AS first FROM nation GROUP BY 1", name="gq_world_rings")
@R.query("SELECT n_regionkey AS ring, count(*) AS biomes, min(n_name) AS first FROM nation GROUP BY 1", name="gq_biome_rows")
def gq_world_rings(t: Tables) -> DataFrame:
    return t.nation.groupBy(F.col("n_regionkey").alias("ring")).agg(F.count("*").alias("biomes"), F.min("n_name").alias("first"))


@R.query("SELECT n_regionkey AS ring, n_name AS biome FROM nation", name="gq_rings")
def gq_rings(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_regionkey").alias("ring"), F.col("n_name").alias("biome"))


@R.query("SELECT s_nationkey AS place, count(*) AS n, s_nationkey = 0 AS near FROM supplier GROUP BY 1")
def gq_near_spawn(t: Tables) -> DataFrame:
    return t.supplier.groupBy(F.col("s_nationkey").alias("place")).agg(F.count("*").alias("n")).withColumn("near", F.col("place") == 0)


@R.query("SELECT r_regionkey AS ring, 1 + r_regionkey * 25 / 100 AS scale FROM region")
def gq_scaling(t: Tables) -> DataFrame:
    return t.region.select(F.col("r_regionkey").alias("ring"), (1 + F.col("r_regionkey") * 25 / 100).alias("scale"))


_CHANCES = acquisition.ORACLES["mining_chance"]


@R.query(
    f"WITH c AS ({_CHANCES}), r AS (SELECT part, n_regionkey AS ring, max(chance) AS chance FROM c JOIN supplier ON s_suppkey = supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY 1, 2) "
    "SELECT part AS item, ring FROM (SELECT *, lag(chance) OVER (PARTITION BY part ORDER BY ring) AS before FROM r) WHERE chance > before"
)
def gq_easier(t: Tables) -> DataFrame:
    """Rings where an item is easier to get than in the ring before that has it."""
    places = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey")).select(F.col("s_suppkey").alias("supplier"), F.col("n_regionkey").alias("ring"))
    rows = acquisition.mining_chance(t.spark, t.sf_dir).join(places, "supplier").groupBy("part", "ring").agg(F.max("chance").alias("chance"))
    before = F.lag("chance").over(Window.partitionBy("part").orderBy("ring"))
    return rows.withColumn("before", before).filter("chance > before").select(F.col("part").alias("item"), "ring")


@R.query(f"WITH s AS ({_BEST}), {_BODY}, r AS (SELECT recipe, max(ring) AS ring FROM b JOIN s ON p = item GROUP BY 1) SELECT recipe, ring FROM r WHERE recipe NOT IN (SELECT c_custkey FROM customer)")
def gq_new_recipes(t: Tables) -> DataFrame:
    body = t.lineitem.select(F.col("l_orderkey").alias("recipe"), F.col("l_partkey").alias("p")).distinct()
    ring = body.join(best(t), "p").groupBy("recipe").agg(F.max("ring").alias("ring"))
    return ring.join(t.customer.select(F.col("c_custkey").alias("recipe")), "recipe", "left_anti")


@R.query("SELECT bench, first FROM (SELECT o_custkey AS bench, min(o_orderkey) AS first FROM orders GROUP BY 1) WHERE first > 100")
def gq_new_benches(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_custkey").alias("bench")).agg(F.min("o_orderkey").alias("first")).filter("first > 100")


@R.query(
    "SELECT l_partkey AS item, min(n_regionkey) AS ring FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey WHERE l_discount >= 0.1 AND l_returnflag = 'R' GROUP BY 1 HAVING count(DISTINCT n_regionkey) = 1"
)
def gq_exclusive(t: Tables) -> DataFrame:
    places = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), "n_regionkey")
    rows = t.lineitem.filter("l_discount >= 0.1 AND l_returnflag = 'R'").join(places, "l_suppkey").groupBy(F.col("l_partkey").alias("item"))
    return rows.agg(F.min("n_regionkey").alias("ring"), F.max("n_regionkey").alias("last")).filter("ring = last").select("item", "ring")


@R.query("SELECT n_regionkey AS ring, count(DISTINCT l_partkey) AS wares FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1")
def gq_merchants(t: Tables) -> DataFrame:
    places = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_regionkey").alias("ring"))
    return t.lineitem.select("l_partkey", "l_suppkey").join(places, "l_suppkey").groupBy("ring").agg(F.count_distinct("l_partkey").alias("wares"))


@R.query("SELECT l_partkey AS weapon, count(*) FILTER (WHERE l_returnflag = 'A') AS a, count(*) FILTER (WHERE l_returnflag = 'N') AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS r FROM lineitem GROUP BY 1")
def gq_weapons_pivot(t: Tables) -> DataFrame:
    """Stats by column; the columns are given, so no job looks for them."""
    wide = t.lineitem.groupBy(F.col("l_partkey").alias("weapon")).pivot("l_returnflag", ["A", "N", "R"]).count()
    return wide.select("weapon", *[F.coalesce(F.col(c), F.lit(0)).alias(c.lower()) for c in "ANR"])


@R.query("SELECT p_type AS label, min(p_partkey) AS first_seen FROM part GROUP BY 1")
def gq_stat_labels(t: Tables) -> DataFrame:
    return t.part.groupBy(F.col("p_type").alias("label")).agg(F.min("p_partkey").alias("first_seen"))


@R.query("SELECT p_name AS ammo, p_brand AS bench, count(*) AS sources FROM part GROUP BY 1, 2")
def gq_ammo(t: Tables) -> DataFrame:
    return t.part.groupBy(F.col("p_name").alias("ammo"), F.col("p_brand").alias("bench")).agg(F.count("*").alias("sources"))


@R.query(
    "SELECT lower(p_name) AS name, count(*) AS n, CASE WHEN count(DISTINCT p_brand) > 1 THEN 'brand' WHEN count(DISTINCT p_size) > 1 THEN 'size' END AS differs FROM part GROUP BY 1 HAVING count(*) > 1"
)
def gq_variants(t: Tables) -> DataFrame:
    differs = F.when(F.min("p_brand") != F.max("p_brand"), "brand").when(F.min("p_size") != F.max("p_size"), "size")
    return t.part.groupBy(F.lower("p_name").alias("name")).agg(F.count("*").alias("n"), differs.alias("differs")).filter("n > 1")


@R.query("SELECT o_custkey AS bench, o_orderkey AS recipe, CAST(sum(l_quantity) AS BIGINT) AS cost FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2")
def gq_bench_detail(t: Tables) -> DataFrame:
    """Scoped sections with the scope as a join column, not a loop."""
    scope = t.orders.select(F.col("o_custkey").alias("bench"), F.col("o_orderkey").alias("recipe"))
    rows = scope.join(t.lineitem, F.col("l_orderkey") == F.col("recipe"))
    return rows.groupBy("bench", "recipe").agg(F.sum("l_quantity").cast("long").alias("cost"))


@R.query(
    "SELECT item, array_to_string(list(phrase ORDER BY prio)[1:2], '; ') AS how FROM (SELECT DISTINCT l_partkey AS item, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS prio, CASE l_returnflag WHEN 'A' THEN 'mine' WHEN 'N' THEN 'craft' ELSE 'loot' END AS phrase FROM lineitem) GROUP BY 1"
)
def how_priority(t: Tables) -> DataFrame:
    prio = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
    names = F.array(F.lit("mine"), F.lit("craft"), F.lit("loot"))
    ways = t.lineitem.groupBy(F.col("l_partkey").alias("item")).agg(F.array_sort(F.collect_set(prio)).alias("w"))
    return ways.select("item", F.array_join(F.transform(F.slice("w", 1, 2), lambda k: F.get(names, k - 1)), "; ").alias("how"))


@R.query("SELECT l_partkey AS item, count(DISTINCT l_orderkey) AS n, array_to_string(list(DISTINCT l_orderkey ORDER BY l_orderkey)[1:12], ',') AS first FROM lineitem GROUP BY 1", name="used_in")
def used_in(t: Tables) -> DataFrame:
    pairs = t.lineitem.select(F.col("l_partkey").alias("item"), F.col("l_orderkey").alias("o")).distinct()
    first = packing.first_per_group(pairs, ["item"], ["o"], 12).groupBy("item").agg(F.array_join(F.array_sort(F.collect_list("o")), ",").alias("first"))
    return pairs.groupBy("item").agg(F.count("*").alias("n")).join(first, "item")


@R.query("SELECT p_partkey FROM part WHERE NOT (p_name LIKE '%blue%' OR p_name LIKE '%red%' OR p_type LIKE 'STANDARD%')")
def unmatched_rules(t: Tables) -> DataFrame:
    return t.part.filter(~(F.col("p_name").contains("blue") | F.col("p_name").contains("red") | F.col("p_type").startswith("STANDARD"))).select("p_partkey")


@R.query(f"WITH s AS ({_BEST}), u AS (SELECT l_partkey AS p, count(DISTINCT l_orderkey) AS used FROM lineitem GROUP BY 1) SELECT p_partkey AS item, p_name AS name, ring, coalesce(used, 0) AS used FROM part LEFT JOIN s ON s.p = p_partkey LEFT JOIN u ON u.p = p_partkey")
def player_projection(t: Tables) -> DataFrame:
    used = t.lineitem.groupBy(F.col("l_partkey").alias("p")).agg(F.count_distinct("l_orderkey").alias("used"))
    rows = t.part.select(F.col("p_partkey").alias("p"), F.col("p_name").alias("name")).join(best(t), "p", "left").join(used, "p", "left")
    return rows.select(F.col("p").alias("item"), "name", "ring", F.coalesce("used", F.lit(0)).alias("used"))


def _passes(columns: list[str]) -> str:
    steps = ["d0 AS (SELECT p_partkey, p_name, CAST(NULL AS VARCHAR) AS suffix, count(*) OVER (PARTITION BY p_name) = 1 AS done, p_brand, p_type, p_size FROM part)"]
    for i, c in enumerate(columns):
        steps.append(
            f"d{i + 1} AS (SELECT p_partkey, p_name, CASE WHEN NOT done AND count(*) OVER (PARTITION BY p_name, done, {c}) = 1 THEN CAST({c} AS VARCHAR) ELSE suffix END AS suffix,"
            f" done OR count(*) OVER (PARTITION BY p_name, done, {c}) = 1 AS done, p_brand, p_type, p_size FROM d{i})"
        )
    last = len(columns)
    return "WITH " + ",\n".join(steps) + (
        f" SELECT p_partkey, p_name || CASE WHEN suffix IS NOT NULL THEN ' (' || suffix || ')' WHEN done THEN '' ELSE ' (' || row_number() OVER (PARTITION BY p_name, done ORDER BY p_partkey) || ')' END AS name FROM d{last}"
    )


@R.query(_passes(["p_brand", "p_type", "p_size"]))
def disambiguate_names(t: Tables) -> DataFrame:
    """Ordered passes: brand, type, size, ordinal; a suffix is kept only if it is unique among the names still alike."""
    rows = t.part.withColumns({"suffix": F.lit(None).cast("string"), "done": F.count("*").over(Window.partitionBy("p_name")) == 1})
    for c in ("p_brand", "p_type", "p_size"):
        one = F.count("*").over(Window.partitionBy("p_name", "done", c)) == 1
        rows = rows.withColumn("one", one).withColumns(
            {"suffix": F.when(~F.col("done") & F.col("one"), F.col(c).cast("string")).otherwise(F.col("suffix")), "done": F.col("done") | F.col("one")}
        )
    k = F.row_number().over(Window.partitionBy("p_name", "done").orderBy("p_partkey"))
    rows = rows.withColumn("k", k)
    tail = F.when(F.col("suffix").isNotNull(), F.col("suffix")).when(~F.col("done"), F.col("k").cast("string"))
    return rows.select("p_partkey", F.concat("p_name", F.coalesce(F.concat(F.lit(" ("), tail, F.lit(")")), F.lit(""))).alias("name"))


@R.query("SELECT l_orderkey AS recipe, string_agg(p_name || ' x' || q, ', ' ORDER BY lower(p_name), p_partkey) AS items FROM (SELECT l_orderkey, l_partkey, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY 1, 2) JOIN part ON p_partkey = l_partkey GROUP BY 1")
def ingredients_list(t: Tables) -> DataFrame:
    sums = t.lineitem.groupBy("l_orderkey", "l_partkey").agg(F.sum("l_quantity").cast("long").alias("q"))
    rows = sums.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    entry = F.struct(F.lower("p_name").alias("a"), F.col("p_partkey").alias("b"), F.concat("p_name", F.lit(" x"), "q").alias("text"))
    return rows.groupBy(F.col("l_orderkey").alias("recipe")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["text"]), ", ").alias("items"))


# Reader


@R.query("SELECT * FROM orders WHERE o_orderkey = 4242")
def point_lookup(t: Tables) -> DataFrame:
    """The key reaches the scan, where file and row-group ranges skip the rest."""
    return t.orders.filter("o_orderkey = 4242")


@R.query("SELECT c_custkey, c_name FROM customer WHERE starts_with(c_name, 'Customer#00000012')")
def prefix_scan(t: Tables) -> DataFrame:
    return t.customer.filter(F.col("c_name").startswith("Customer#00000012")).select("c_custkey", "c_name")


_EVERY = "len(list_filter(['old', 'small'], lambda w: {})) = 2"
_FOUND = f"""SELECT *, CASE WHEN n = 'old small' THEN 100 WHEN starts_with(n, 'old small') THEN 80
 WHEN {_EVERY.format("len(list_filter(string_split_regex(n, '[ _().,-]+'), lambda p: starts_with(p, w))) > 0")} THEN 60 WHEN {_EVERY.format("contains(n, w)")} THEN 40 ELSE 10 END
 + CASE WHEN {_EVERY.format("list_contains(string_split_regex(n, '[ ()]+'), w)")} THEN 10 ELSE 0 END + CASE WHEN p_size > 25 THEN 5 ELSE 0 END AS score
FROM (SELECT *, lower(CASE WHEN p_partkey % 3 = 0 THEN p_name || ' behold' WHEN p_partkey % 3 = 1 THEN 'old ' || p_name ELSE p_name END) AS n FROM part) WHERE {_EVERY.format("contains(n || ' ' || lower(p_brand) || ' ' || lower(p_type), w)")}"""


def found(t: Tables) -> DataFrame:
    """Parts that match "old small", words in another order than in the names; names are brought to search form once each."""
    name = F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit(" behold"))).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("old "), "p_name"))
    rows = t.part.withColumn("n", X.search_form(F.coalesce(name, "p_name"))).withColumn("hay", F.concat_ws(" ", "n", F.lower("p_brand"), F.lower("p_type")))
    return rows.withColumn("score", search.score(F.col("n"), F.col("hay"), "old small", F.col("p_size") > 25)).filter("score IS NOT NULL")


@R.query(f"SELECT p_partkey, score FROM ({_FOUND}) ORDER BY p_size < 3, score DESC, lower(n), p_partkey LIMIT 100")
def search_rank(t: Tables) -> DataFrame:
    return search.rank(found(t), "p_partkey", "n", F.col("p_size") < 3, 100).select("p_partkey", "score")


@R.query(f"SELECT p_type, count(*) AS n FROM ({_FOUND}) GROUP BY 1")
def search_facets(t: Tables) -> DataFrame:
    return found(t).groupBy("p_type").agg(F.count("*").alias("n"))


# Packing and incremental work


def _prefix_oracle(limit: int, depth: int) -> str:
    steps = ["x0 AS (SELECT md5(CAST(doc_id AS VARCHAR)) AS key, n_chars AS size FROM documents)"]
    for d in range(depth):
        steps.append(f"t{d} AS (SELECT substr(key, 1, {d}) AS pack, min(key) AS first, max(key) AS last, CAST(sum(size) AS BIGINT) AS bytes, count(*) AS count FROM x{d} GROUP BY 1 HAVING sum(size) <= {limit} OR count(*) = 1)")
        steps.append(f"x{d + 1} AS (SELECT * FROM x{d} WHERE substr(key, 1, {d}) NOT IN (SELECT pack FROM t{d}))")
    return "WITH " + ",\n".join(steps) + " " + " UNION ALL ".join(f"SELECT * FROM t{d}" for d in range(depth))


@R.query(_prefix_oracle(60_000, 6))
def prefix_packs(t: Tables) -> DataFrame:
    rows = t.documents.select(F.md5(F.col("doc_id").cast("string")).alias("key"), F.col("n_chars").alias("size"))
    return packing.prefix_packs(rows, limit=60_000)


def _directory_oracle(limit: int, each: int, levels: int) -> str:
    steps = [f"p0 AS MATERIALIZED (SELECT pack, first, last, count FROM ({_prefix_oracle(limit, 6)}))"]
    out = ["SELECT 0 AS level, pack, first, last, count, count AS entries FROM p0"]
    for level in range(1, levels + 1):
        steps.append(
            f"p{level} AS MATERIALIZED (SELECT min(first) AS pack, min(first) AS first, max(last) AS last, CAST(sum(count) AS BIGINT) AS count, count(*) AS entries"
            f" FROM (SELECT *, (row_number() OVER (ORDER BY first) - 1) // {each} AS page FROM p{level - 1}) WHERE (SELECT count(*) FROM p{level - 1}) > 1 GROUP BY page)"
        )
        out.append(f"SELECT {level}, pack, first, last, count, entries FROM p{level}")
    return "WITH " + ",\n".join(steps) + " " + " UNION ALL ".join(out)


@R.query(_directory_oracle(60_000, 15, 5))
def pack_directory(t: Tables) -> DataFrame:
    """Packs and the directory pages over them, each within its size; a page lists its packs' first and last key and count."""
    rows = t.documents.select(F.md5(F.col("doc_id").cast("string")).alias("key"), F.col("n_chars").alias("size"))
    return packing.directory(rows, limit=60_000, page_limit=3_000, entry_bytes=200)


@R.query(
    """WITH RECURSIVE o AS (SELECT source, doc_id, n_chars AS size, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
w(source, doc_id, i, batch, cnt, bytes) AS (SELECT source, doc_id, i, CAST(0 AS BIGINT), 1, CAST(size AS BIGINT) FROM o WHERE i = 1 UNION ALL
SELECT o.source, o.doc_id, o.i, CASE WHEN w.cnt + 1 > 16 OR w.bytes + o.size > 40000 THEN w.batch + 1 ELSE w.batch END,
 CASE WHEN w.cnt + 1 > 16 OR w.bytes + o.size > 40000 THEN 1 ELSE w.cnt + 1 END, CASE WHEN w.cnt + 1 > 16 OR w.bytes + o.size > 40000 THEN o.size ELSE w.bytes + o.size END FROM w JOIN o ON o.source = w.source AND o.i = w.i + 1)
SELECT source, doc_id AS key, batch FROM w"""
)
def batch_chunks(t: Tables) -> DataFrame:
    rows = t.documents.select("source", F.col("doc_id").alias("key"), F.col("n_chars").alias("size"))
    return packing.batch_chunks(rows, "source", most_rows=16, most_bytes=40_000)


@R.query()
def bin_pack_ffd(t: Tables) -> DataFrame:
    return packing.bin_pack_ffd(t.documents.select(F.col("source").alias("topic"), F.col("doc_id").alias("key"), F.col("n_chars").alias("size")), budget=30_000)


@R.query("SELECT n_regionkey, count(*) AS count, true AS reused FROM nation JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1")
def memo_reuse(t: Tables) -> DataFrame:
    """A stage run twice over unchanged input: the second run reads its stored output."""
    root = scratch(t.spark, "memo")
    inputs = files.inventory(t.spark, t.sf_dir, "*.parquet")
    build = lambda: t.nation.join(t.supplier, F.col("s_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey").count()
    packing.memoized(t.spark, inputs, "v1", root, build)
    out, reused = packing.memoized(t.spark, inputs, "v1", root, build)
    return out.withColumn("reused", F.lit(reused))


@R.query(
    """WITH g AS (SELECT source, md5(string_agg(md5(text), '' ORDER BY doc_id)) AS signature, count(*) AS docs, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY source)
SELECT source, signature, docs, chars, ascii(right(source, 1)) % 2 = 0 AS reused FROM g"""
)
def incremental_signature(t: Tables) -> DataFrame:
    """Results of groups whose signature is the stored one are reused; only the others are computed anew."""
    rows = t.documents.select("source", "doc_id", F.md5("text").alias("h"))
    signed = packing.running_digest(rows, "source", "doc_id", "md5").withColumnRenamed("digest", "signature")
    build = lambda df: df.groupBy("source").agg(F.count("*").alias("docs"), F.sum("n_chars").alias("chars"))
    # An earlier run that saw sources with an odd last letter in another state.
    even = F.ascii(F.right("source", F.lit(1))) % 2 == 0
    stored = build(t.documents).join(signed, "source").withColumn("signature", F.when(even, F.col("signature")).otherwise("other"))
    return packing.reuse(t.documents, signed, stored, "source", build).select("source", "signature", "docs", "chars", "reused")


_PARTS = "SELECT s_nationkey AS topic, s_suppkey AS id, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS ordinal FROM supplier"


@R.query(
    f"""WITH p AS ({_PARTS}), n AS (SELECT topic, 100000000 + topic AS id FROM p WHERE topic % 3 = 0 GROUP BY topic)
SELECT id, CASE WHEN topic % 3 = 0 AND ordinal = 0 THEN 2 WHEN ordinal = 0 THEN 1 ELSE 0 END AS group_rank FROM p WHERE NOT (topic = 6 AND ordinal = 0)
UNION ALL SELECT id, CASE WHEN topic = 6 THEN 3 ELSE 1 END FROM n"""
)
def rank_groups(t: Tables) -> DataFrame:
    """Suppliers as partitions of their nations: every third nation gets a new entry point, and what others need is published first."""
    order = Window.partitionBy("s_nationkey").orderBy("s_suppkey")
    parts = t.supplier.select(F.col("s_nationkey").alias("topic"), F.col("s_suppkey").alias("id"), (F.row_number().over(order) - 1).alias("ordinal"))
    parts = parts.withColumns({"sealed": F.lit(False), "entrypoint": F.lit(False)})
    wanted = parts.filter("topic % 3 = 0").select("topic").distinct()
    rolled = publication.rollover(parts, wanted, F.lit(100000000) + F.col("topic"))
    return publication.groups(rolled, publication.active(parts), 6).select("id", F.col("rank").alias("group_rank"))


def _pages_oracle(limit: int, depth: int) -> str:
    entry = """'"' || key || '":{' || CASE WHEN a THEN '"allocated":true,' ELSE '' END || '"bytes":' || n || CASE WHEN r THEN ',"retained":true' ELSE '' END || ',"sha256":"' || h || '"}'"""
    steps = [
        "f AS (SELECT 'site/' || md5(CAST(doc_id AS VARCHAR)) || '.json' AS key, sha256(coalesce(text, '')) AS h, coalesce(n_chars, 0) AS n, doc_id % 3 = 0 AS a, doc_id % 5 = 0 AS r FROM documents)",
        f"x0 AS (SELECT key, {entry} AS entry, strlen({entry}) + 1 AS size FROM f)",
    ]
    for d in range(depth):
        steps.append(
            f"t{d} AS (SELECT substr(key, 1, {d}) AS pack, min(key) AS first, max(key) AS last, count(*) AS count, '{{' || string_agg(entry, ',' ORDER BY key) || '}}' AS body FROM x{d} GROUP BY 1 HAVING sum(size) <= {limit - 1} OR count(*) = 1)"
        )
        steps.append(f"x{d + 1} AS (SELECT * FROM x{d} WHERE substr(key, 1, {d}) NOT IN (SELECT pack FROM t{d}))")
    return "WITH " + ",\n".join(steps) + " SELECT sha256(body) AS name, first, last, count, CAST(strlen(body) AS BIGINT) AS bytes FROM (" + " UNION ALL ".join(f"SELECT * FROM t{d}" for d in range(depth)) + ")"


def owned(t: Tables) -> DataFrame:
    doc = F.col("doc_id")
    return t.documents.select(
        F.concat(F.lit("site/"), F.md5(doc.cast("string")), F.lit(".json")).alias("path"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"),
        F.coalesce("n_chars", F.lit(0)).alias("bytes"), (doc % 3 == 0).alias("allocated"), (doc % 5 == 0).alias("retained"),
    )


@R.query(_pages_oracle(6_000, 12))
def ownership_pages(t: Tables) -> DataFrame:
    """A receipt of all documents in pages of at most 6,000 bytes."""
    return receipts.encode(owned(t), 6_000)[0].drop("body")


@R.query("SELECT 'site/' || md5(CAST(doc_id AS VARCHAR)) || '.json' AS path, sha256(coalesce(text, '')) AS sha256, coalesce(n_chars, 0) AS bytes, doc_id % 3 = 0 AS allocated, doc_id % 5 = 0 AS retained FROM documents")
def ownership_records(t: Tables) -> DataFrame:
    """The files of a receipt, read from its pages and held against its root."""
    return receipts.decode(*receipts.encode(owned(t), 6_000))


@R.query(f"SELECT (k - 1) // 100 AS page, k AS place, p_partkey FROM (SELECT p_partkey, row_number() OVER (ORDER BY p_size < 3, score DESC, lower(n), p_partkey) AS k FROM ({_FOUND}))")
def search_pages(t: Tables) -> DataFrame:
    """All results of a search in order, a hundred a page."""
    rows = found(t).withColumns({"last": F.col("p_size") < 3, "down": -F.col("score")})
    placed = packing.ordered(rows.select("last", "down", "n", "p_partkey"), ["last", "down", "n", "p_partkey"], "k")
    return placed.select(F.expr("k div 100").alias("page"), (F.col("k") + 1).alias("place"), "p_partkey")


@R.query("SELECT p_partkey, 'obj/' || p_partkey AS path, md5(p_name) AS sha FROM part UNION ALL SELECT p_partkey, 'obj/' || p_brand, md5(p_brand) FROM part")
def gc_paths(t: Tables) -> DataFrame:
    """Artifact references anywhere in a document: (path, sha) pairs by descent."""
    item = lambda path, text: f"named_struct('path', concat('obj/', {path}), 'sha256', md5({text}))"
    doc = F.expr(f"parse_json(to_json(named_struct('a', {item('p_partkey', 'p_name')}, 'b', array(named_struct('c', {item('p_brand', 'p_brand')})))))")
    leaves = pointers.leaves(t.part.select("p_partkey", doc.alias("v")), ["p_partkey"], "v", depth=5)
    owner, name = F.regexp_replace("pointer", "/[^/]*$", ""), F.element_at(F.split("pointer", "/"), -1)
    text = F.regexp_replace("leaf", '^"|"$', "")
    found_ = leaves.select("p_partkey", owner.alias("owner"), name.alias("name"), text.alias("text")).filter("name IN ('path', 'sha256')")
    return found_.groupBy("p_partkey", "owner").agg(F.max(F.when(F.col("name") == "path", F.col("text"))).alias("path"), F.max(F.when(F.col("name") == "sha256", F.col("text"))).alias("sha")).drop("owner")
