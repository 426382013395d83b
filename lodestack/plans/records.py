"""Scans, contracts, projections and nested access."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestack.operators import contracts, pointers
from lodestack.plans.base import Registry, Tables
from lodestack.sources import files

R = Registry()
PROPS = contracts.Contract((contracts.Field("k", "number"), contracts.Field("z", "text")))


@R.query("SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k, CAST(NULL AS VARCHAR) AS z FROM events")
def contract_project_props(t: Tables) -> DataFrame:
    return contracts.project(t.events, "props", PROPS, ["event_id"])


@R.query("SELECT event_id, 'missing-field' AS code, 'z' AS field FROM events")
def schema_drift_props(t: Tables) -> DataFrame:
    return contracts.drift(t.events, "props", PROPS, ["event_id"])


_PART_JSON = "to_json(named_struct('name', p_name, 'size', p_size, 'maker', named_struct('brand', p_brand, 'tags', array(p_type, p_brand)), 'flag', p_size > 25))"


def part_json(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.expr(_PART_JSON).alias("j"))


@R.query("SELECT p_partkey, p_name AS name, CAST(p_size AS DOUBLE) AS size, CAST(NULL AS DOUBLE) AS flag FROM part")
def contract_project_flat(t: Tables) -> DataFrame:
    """A boolean is no number, so the flag that was declared as one is null."""
    c = contracts.Contract((contracts.Field("name", "text"), contracts.Field("size", "number"), contracts.Field("flag", "number")))
    return contracts.project(part_json(t), "j", c, ["p_partkey"])


@R.query(
    """SELECT event_id, 'no-complete-layout' AS code, '' AS field FROM events UNION ALL SELECT event_id, 'new-field', 'k' FROM events"""
)
def layout_alternatives(t: Tables) -> DataFrame:
    c = contracts.Contract((), layouts=(("a", "b"), ("k", "z")))
    return contracts.drift(t.events, "props", c, ["event_id"])


@R.query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_pointer_get(t: Tables) -> DataFrame:
    return t.events.select("event_id", pointers.get(F.parse_json("props"), "/k", "long").alias("k"))


@R.query("SELECT p_partkey, CAST(i - 1 AS INTEGER) AS pos, CASE i WHEN 1 THEN p_type ELSE p_brand END AS tag FROM part, (SELECT unnest([1, 2]) AS i)")
def json_pointer_walk(t: Tables) -> DataFrame:
    """/maker/tags/*: one variant_explode per star."""
    rows = part_json(t).select("p_partkey", pointers.get(F.parse_json("j"), "/maker/tags").alias("v"))
    found = rows.lateralJoin(t.spark.tvf.variant_explode(F.col("v").outer()))
    return found.select("p_partkey", F.col("pos").cast("int").alias("pos"), F.try_variant_get("value", "$", "string").alias("tag"))


@R.query(
    """SELECT p_partkey, pointer, leaf FROM (SELECT p_partkey, unnest(['/name', '/size', '/maker/brand', '/maker/tags/0', '/maker/tags/1', '/flag']) AS pointer,
 unnest(['"' || p_name || '"', CAST(p_size AS VARCHAR), '"' || p_brand || '"', '"' || p_type || '"', '"' || p_brand || '"', CAST(p_size > 25 AS VARCHAR)]) AS leaf FROM part)"""
)
def flatten_leaves(t: Tables) -> DataFrame:
    rows = part_json(t).select("p_partkey", F.parse_json("j").alias("v"))
    return pointers.leaves(rows, ["p_partkey"], "v", depth=4)


@R.query(
    """SELECT pointer, count(*) AS n FROM (SELECT unnest(['/name', '/size', '/maker/brand', '/maker/tags/*', '/maker/tags/*', '/flag']) AS pointer FROM part) GROUP BY pointer"""
)
def normalize_pointer(t: Tables) -> DataFrame:
    rows = part_json(t).select("p_partkey", F.parse_json("j").alias("v"))
    found = pointers.leaves(rows, ["p_partkey"], "v", depth=4)
    return found.groupBy(pointers.normalize(F.col("pointer")).alias("pointer")).agg(F.count("*").alias("n"))


@R.query("SELECT p_partkey, pointer FROM (SELECT p_partkey, unnest(['/maker/brand', '/maker/tags/0', '/maker/tags/1']) AS pointer FROM part)")
def path_prefix_filter(t: Tables) -> DataFrame:
    rows = part_json(t).select("p_partkey", F.parse_json("j").alias("v"))
    return pointers.leaves(rows, ["p_partkey"], "v", depth=4).filter(pointers.under(F.col("pointer"), "/maker")).select("p_partkey", "pointer")


@R.query(
    """SELECT doc_id, CASE WHEN strlen(text) > 240 THEN '{"omitted_bytes":' || strlen(text) || ',"sha256":"' || sha256(text) || '"}' ELSE text END AS value FROM documents"""
)
def truncate_or_hash(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", pointers.truncate_or_hash(F.col("text"), 240).alias("value"))


@R.query("SELECT o_orderkey, 'orders-' || (o_orderkey % 16) AS shard, o_orderkey AS id FROM orders")
def route_partition_key(t: Tables) -> DataFrame:
    """The shard is what stands before # in an id."""
    ids = t.orders.select("o_orderkey", F.concat(F.lit("orders-"), F.col("o_orderkey") % 16, F.lit("#"), "o_orderkey").alias("i"))
    return ids.select("o_orderkey", F.substring_index("i", "#", 1).alias("shard"), F.substring_index("i", "#", -1).cast("long").alias("id"))


@R.query(
    """SELECT k AS key, o_totalprice, o_orderkey IS NULL AS missing FROM (SELECT unnest(range(1, 40000, 777)) AS k) LEFT JOIN orders ON o_orderkey = k"""
)
def lookup_objects_by_key(t: Tables) -> DataFrame:
    """Keys stay on the left: a missing object is a row, not an error."""
    keys = t.spark.range(1, 40000, 777).select(F.col("id").alias("key"))
    found = keys.join(t.orders, F.col("key") == F.col("o_orderkey"), "left")
    return found.select("key", "o_totalprice", F.col("o_orderkey").isNull().alias("missing"))


@R.query(
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, sha256(props) AS sha FROM events"""
)
def selective_decode_props(t: Tables) -> DataFrame:
    """Only the wanted member is decoded; the hash covers all bytes."""
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.sha2("props", 256).alias("sha"))


R.sql("assert_unique_orderkey", "SELECT o_orderkey, count(*) AS n FROM {orders} GROUP BY o_orderkey HAVING count(*) > 1")


@R.query("SELECT count(*) AS violations FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)")
def assert_sorted_unique(t: Tables) -> DataFrame:
    """Order is no property of a table here, so strictly increasing means unique."""
    return t.orders.groupBy("o_orderkey").count().filter("count > 1").agg(F.count("*").alias("violations"))


@R.query(
    """SELECT 'part' AS kind, p_partkey AS id, p_name AS name FROM part UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier
UNION ALL SELECT 'customer', c_custkey, c_name FROM customer UNION ALL SELECT 'nation', n_nationkey, n_name FROM nation"""
)
def extract_union_views(t: Tables) -> DataFrame:
    view = lambda df, kind, key, name: df.select(F.lit(kind).alias("kind"), F.col(key).cast("long").alias("id"), F.col(name).alias("name"))
    return (
        view(t.part, "part", "p_partkey", "p_name").unionByName(view(t.supplier, "supplier", "s_suppkey", "s_name"))
        .unionByName(view(t.customer, "customer", "c_custkey", "c_name")).unionByName(view(t.nation, "nation", "n_nationkey", "n_name"))
    )


@R.query("SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_discount > 0.05)")
def referenced_semi_scan(t: Tables) -> DataFrame:
    wanted = t.lineitem.filter("l_returnflag = 'R' AND l_discount > 0.05").select(F.col("l_partkey").alias("p_partkey"))
    return t.part.join(wanted, "p_partkey", "left_semi").select("p_partkey", "p_name")


@R.query(
    """WITH c AS (SELECT p_type, p_brand, min(p_partkey) AS k FROM part WHERE p_size < 10 GROUP BY 1, 2), f AS (SELECT p_type, min(k) AS k FROM c GROUP BY 1)
SELECT p_partkey, coalesce(c.k, f.k) AS contract FROM part LEFT JOIN c USING (p_type, p_brand) LEFT JOIN f USING (p_type)"""
)
def contract_lookup(t: Tables) -> DataFrame:
    """Contract by type and brand, by type alone where the brand has none."""
    exact = t.part.filter("p_size < 10").groupBy("p_type", "p_brand").agg(F.min("p_partkey").alias("k"))
    loose = exact.groupBy("p_type").agg(F.min("k").alias("any_k"))
    return t.part.join(exact, ["p_type", "p_brand"], "left").join(loose, "p_type", "left").select("p_partkey", F.coalesce("k", "any_k").alias("contract"))


@R.query(
    """SELECT DISTINCT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS code FROM events"""
)
def enum_usage(t: Tables) -> DataFrame:
    code = F.regexp_extract("props", r'"k":\s*(-?\d+)', 1).cast("long") % 10
    return t.events.select("event_type", code.alias("code")).dropDuplicates()


@R.query("SELECT conv_id, CASE WHEN count(*) FILTER (WHERE role = 'user') = 1 THEN max(text) FILTER (WHERE role = 'user') END AS text FROM conversations GROUP BY conv_id")
def unique_or_null_lang(t: Tables) -> DataFrame:
    """The entry of one kind if there is exactly one."""
    own = F.when(F.col("role") == "user", F.col("text"))
    return t.conversations.groupBy("conv_id").agg(F.when(F.count_if(F.col("role") == "user") == 1, F.max(own)).alias("text"))


@R.query(
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 9 = 0 THEN 'null-pointer' WHEN p_partkey IS NULL THEN 'missing-target' ELSE 'resolved' END AS status
FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 5) ON p_partkey = l_partkey"""
)
def ref_status(t: Tables) -> DataFrame:
    known = t.part.filter("p_size > 5").select("p_partkey")
    rows = t.lineitem.join(known, F.col("l_partkey") == F.col("p_partkey"), "left")
    status = F.when(F.col("l_partkey") % 9 == 0, "null-pointer").when(F.col("p_partkey").isNull(), "missing-target").otherwise("resolved")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", status.alias("status"))


@R.query("SELECT CASE WHEN l_linenumber BETWEEN 1 AND 5 THEN l_linenumber END AS idx, count(*) AS n FROM lineitem GROUP BY 1")
def index_counts(t: Tables) -> DataFrame:
    """Counts per prototype index; what is out of range counts as unresolved (null)."""
    return t.lineitem.groupBy(F.when(F.col("l_linenumber").between(1, 5), F.col("l_linenumber")).alias("idx")).agg(F.count("*").alias("n"))


@R.query("SELECT p_partkey, substr(sha256('[\"part\",\"' || p_partkey || '\"]'), 1, 32) AS observation_key FROM part")
def observation_key(t: Tables) -> DataFrame:
    canonical = F.concat(F.lit('["part","'), "p_partkey", F.lit('"]'))
    return t.part.select("p_partkey", F.substring(F.sha2(canonical, 256), 1, 32).alias("observation_key"))


@R.query(
    """SELECT 'parent' AS kind, o_orderkey AS owner, -1 AS at, o_custkey AS target FROM orders
UNION ALL SELECT 'line', o, k - 1, p FROM (SELECT l_orderkey AS o, l_partkey AS p, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS k FROM lineitem)"""
)
def expand_order_lines(t: Tables) -> DataFrame:
    """Members of a nested array become child rows; the parent keeps the rest."""
    lines = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("lines"))
    parents = t.orders.select(F.lit("parent").alias("kind"), F.col("o_orderkey").alias("owner"), F.lit(-1).cast("long").alias("at"), F.col("o_custkey").alias("target"))
    children = lines.select(F.col("l_orderkey").alias("owner"), F.posexplode("lines").alias("at", "x")).select(
        F.lit("line").alias("kind"), "owner", F.col("at").cast("long").alias("at"), F.col("x.l_partkey").alias("target")
    )
    return parents.unionByName(children)


@R.query("SELECT p_partkey, sha256(p_name || '|' || p_size) AS revision, 'part' AS source FROM part")
def semantic_project(t: Tables) -> DataFrame:
    """Meaning and provenance apart; the revision hashes the meaning alone."""
    rows = t.part.select("p_partkey", F.struct("p_name", "p_size").alias("semantic"), F.struct(F.lit("part").alias("source")).alias("provenance"))
    return rows.select("p_partkey", F.sha2(F.concat_ws("|", "semantic.p_name", "semantic.p_size"), 256).alias("revision"), "provenance.source")


@R.query(
    "SELECT p_partkey, 'name=' || p_name || ';size=' || p_size || CASE WHEN p_size % 2 = 0 THEN ';old=true' ELSE '' END || ';type=' || p_type || ';brand=' || p_brand || ';key=' || p_partkey"
    " || CASE WHEN p_size % 2 = 0 THEN '' ELSE ';also=' || p_type END AS brief FROM part"
)
def search_brief(t: Tables) -> DataFrame:
    """The first six facts that are single values; lists, objects and nulls are passed over."""
    shown = lambda c: F.concat(F.lit('"'), F.col(c), F.lit('"'))
    facts = {
        "name": shown("p_name"), "tags": F.to_json(F.split("p_name", " ")), "size": F.col("p_size").cast("string"), "old": F.when(F.col("p_size") % 2 == 0, "true"),
        "where": F.to_json(F.struct("p_brand")), "type": shown("p_type"), "brand": shown("p_brand"), "key": F.col("p_partkey").cast("string"), "also": shown("p_type"), "last": shown("p_name"),
    }
    entries = F.array(*(F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in facts.items()))
    first = F.slice(F.filter(entries, lambda e: e["value"].isNotNull() & ~F.substring(e["value"], 1, 1).isin("[", "{")), 1, 6)
    text = lambda e: F.concat(e["key"], F.lit("="), F.regexp_replace(e["value"], '^"|"$', ""))
    return t.part.select("p_partkey", F.array_join(F.transform(first, text), ";").alias("brief"))


@R.query("SELECT p_name, coalesce(CASE WHEN count(DISTINCT p_type) = 1 THEN min(p_type) END, 'internal ' || p_name) AS label FROM part GROUP BY p_name")
def label_or_internal(t: Tables) -> DataFrame:
    rows = t.part.groupBy("p_name").agg(F.min("p_type").alias("a"), F.max("p_type").alias("b"))
    return rows.select("p_name", F.coalesce(F.when(F.col("a") == F.col("b"), F.col("a")), F.concat(F.lit("internal "), "p_name")).alias("label"))


@R.query(
    """SELECT o_orderkey, array_to_string(list_sort(list_distinct(list(x))), ' ') AS ids FROM (SELECT o_orderkey, 'customer#' || o_custkey AS x FROM orders
UNION ALL SELECT l_orderkey, 'part#' || l_partkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey) GROUP BY 1"""
)
def referenced_ids(t: Tables) -> DataFrame:
    """Every id that a row names, by shape."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set(F.concat(F.lit("part#"), "l_partkey")).alias("parts"))
    rows = t.orders.join(lines, "o_orderkey", "left")
    own = F.array(F.concat(F.lit("customer#"), "o_custkey"), "o_orderstatus")
    ids = F.filter(F.array_distinct(F.concat(own, F.coalesce("parts", F.array().cast("array<string>")))), lambda x: x.rlike(r"#-?\d+$"))
    return rows.select("o_orderkey", F.array_join(F.array_sort(ids), " ").alias("ids"))


@R.query(
    "SELECT conv_id, turn, pos - 1 AS run, word FROM (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) AS pos FROM conversations)"
)
def document_text_runs(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", F.posexplode(F.split("text", " ")).alias("run", "word")).withColumn("run", F.col("run").cast("long"))


# Sources and sinks over files


@R.query()
def src_file_inventory(t: Tables) -> DataFrame:
    """Files of a snapshot directory with their sizes, by listing alone."""
    return files.inventory(t.spark, t.sf_dir, "region.parquet")


@R.query()
def src_file_hash(t: Tables) -> DataFrame:
    return files.hashes(t.spark, t.sf_dir, "nation.parquet")


@R.query()
def parse_kv_text(t: Tables) -> DataFrame:
    """Nested key-value text, parsed to (pointer, value) rows."""
    text = F.concat(F.lit('"region" { "key" "'), "r_regionkey", F.lit('" "inner" { "name" "'), "r_name", F.lit('" } }'))
    return files.parse_key_values(t.region.select(F.col("r_regionkey").alias("id"), text.alias("text")))


@R.query("SELECT page_id, url, strlen(html) AS length FROM pages")
def inventory_pages(t: Tables) -> DataFrame:
    return t.pages.select("page_id", "url", F.octet_length("html").cast("long").alias("length"))


@R.query("SELECT r_regionkey, sha256('{\"key\":' || r_regionkey || ',\"name\":\"' || r_name || '\"}') AS digest FROM region")
def canonical_hash(t: Tables) -> DataFrame:
    """Canonical JSON has its keys sorted; to_json keeps the order given, so the struct is built sorted."""
    return t.region.select("r_regionkey", F.sha2(F.to_json(F.struct(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"))), 256).alias("digest"))


@R.query(
    """SELECT p_type, (k - 1) // 100 AS page, count(*) AS n, min(k) AS first FROM (SELECT p_type, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS k FROM part) GROUP BY 1, 2"""
)
def paginate_100(t: Tables) -> DataFrame:
    k = F.row_number().over(Window.partitionBy("p_type").orderBy("p_partkey")).cast("long")
    rows = t.part.select("p_type", k.alias("k"))
    return rows.groupBy("p_type", F.expr("(k - 1) div 100").alias("page")).agg(F.count("*").alias("n"), F.min("k").alias("first"))


@R.query("SELECT page_id, link FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS link FROM pages) WHERE link NOT IN (SELECT '/' || n_name FROM nation)")
def html_dangling_links(t: Tables) -> DataFrame:
    links = t.pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).alias("link"))
    return links.join(t.nation.select(F.concat(F.lit("/"), "n_name").alias("link")), "link", "left_anti").select("page_id", "link")
