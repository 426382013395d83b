"""Guides from a spec, identity levels, placement with two budgets, paths of any depth and stage graphs."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestack.operators import capacity, guide, hierarchy, identity, packing
from lodestack.plans.base import Registry, Tables
from lodestack.session import cut, scratch
from lodestack.sources import files, ordered, postings

R = Registry()

# Guides

SPEC = json.dumps({
    "id": "suppliers", "title": "Suppliers by region", "schema_version": 1,
    "sections": [
        {"id": "intro", "heading": "Overview", "blocks": [
            {"type": "sentence", "query": "totals", "template": "{suppliers} suppliers in {nations} nations."},
        ]},
        {"id": "region", "heading": "Region {region}", "repeat": "regions", "blocks": [
            {"type": "table", "title": "Nations", "query": "nations", "columns": ["nation", "suppliers"]},
            {"type": "list", "query": "suppliers", "item": "{supplier}: {cents}", "group_by": "nation", "limit_per_group": 3, "more": "{remaining} more suppliers"},
            {"type": "steps", "query": "debtors", "item": "Ask {supplier} of {nation}", "empty": "Nobody owes anything."},
            {"type": "sentence", "title": "Largest", "query": "large", "template": "Most of all: {who}.", "optional": True},
        ]},
        {"id": "odd", "heading": "Nations without suppliers", "blocks": [{"type": "checklist", "query": "unused", "item": "{nation}", "optional": True}]},
        {"id": "sources", "heading": "Sources", "blocks": [{"type": "sources", "template": "Build {build_id}"}]},
    ],
})


def context(t: Tables) -> dict[str, guide.Frame]:
    """All joins of the guide, once; its blocks share the table of suppliers."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    link = F.struct(F.col("s_name").alias("text"), F.concat(F.lit("e-"), F.md5(F.col("s_suppkey").cast("string"))).alias("entity"))
    joined = places.join(t.supplier, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("r_name").alias("region"), F.col("n_name").alias("nation"), "s_suppkey", F.round(F.col("s_acctbal") * 100).cast("long").alias("cents"),
        F.when(F.col("s_suppkey").isNotNull(), link).alias("supplier"),
    )
    rows = cut(joined)
    there = rows.filter("s_suppkey IS NOT NULL")
    debtors = there.filter("cents < -99000")
    # Every part of the order is unique within its scope.
    count = F.count("s_suppkey").alias("suppliers")
    who = F.transform(F.slice(F.array_sort(F.collect_list(F.struct("s_suppkey", "supplier"))), 1, 3), lambda x: x["supplier"])
    return {
        "totals": guide.Frame(rows.agg(count, F.count_distinct("nation").alias("nations")), ("nations",)),
        "regions": guide.Frame(rows.select("region").distinct(), ("region",)),
        "nations": guide.Frame(rows.groupBy("region", "nation").agg(count), ("nation",), ("region",)),
        "suppliers": guide.Frame(there, ("nation", "s_suppkey"), ("region",)),
        "debtors": guide.Frame(debtors, ("s_suppkey",), ("region",)),
        "large": guide.Frame(there.filter("cents > 990000").groupBy("region").agg(who.alias("who")), (), ("region",)),
        "unused": guide.Frame(rows.filter("s_suppkey IS NULL"), ("nation",)),
    }


_GUIDE = """WITH r AS (SELECT r_name AS region, n_name AS nation, s_suppkey, CAST(round(s_acctbal * 100) AS BIGINT) AS cents, '[' || s_name || '](e-' || md5(CAST(s_suppkey AS VARCHAR)) || ')' AS link
 FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN supplier ON s_nationkey = n_nationkey),
sc AS (SELECT region, row_number() OVER (ORDER BY region) - 1 AS scope FROM (SELECT DISTINCT region FROM r)),
x AS (SELECT scope, r.* FROM r JOIN sc USING (region)),
nat AS (SELECT scope, nation, n, row_number() OVER (ORDER BY scope, nation) - 1 AS rank FROM (SELECT scope, nation, count(s_suppkey) AS n FROM x GROUP BY 1, 2)),
sup AS (SELECT *, row_number() OVER (ORDER BY scope, nation, s_suppkey) - 1 AS rank, row_number() OVER (PARTITION BY scope, nation ORDER BY s_suppkey) AS k, count(*) OVER (PARTITION BY scope, nation) AS n FROM x WHERE s_suppkey IS NOT NULL),
grp AS (SELECT scope, nation, min(rank) AS grp, max(n) AS n FROM sup GROUP BY 1, 2),
deb AS (SELECT *, row_number() OVER (ORDER BY scope, s_suppkey) - 1 AS rank FROM x WHERE cents < -99000),
big AS (SELECT scope, array_to_string(list(link ORDER BY s_suppkey)[1:3], ', ') AS who FROM x WHERE cents > 990000 GROUP BY 1),
odd AS (SELECT nation, row_number() OVER (ORDER BY nation) - 1 AS rank FROM r WHERE s_suppkey IS NULL)
SELECT 0 AS section, 'intro' AS section_id, 0 AS scope, -1 AS block, -1 AS grp, -1 AS item, -1 AS part, 'heading' AS kind, 'Overview' AS text
UNION ALL SELECT 0, 'intro', 0, 0, -1, 0, -1, 'text', count(s_suppkey) || ' suppliers in ' || count(DISTINCT nation) || ' nations.' FROM r
UNION ALL SELECT 1, 'region-' || scope, scope, -1, -1, -1, -1, 'heading', 'Region ' || region FROM sc
UNION ALL SELECT 1, 'region-' || scope, scope, 0, -1, -1, -1, 'title', 'Nations' FROM sc
UNION ALL SELECT 1, 'region-' || scope, scope, 0, -1, rank, 0, 'cell', nation FROM nat
UNION ALL SELECT 1, 'region-' || scope, scope, 0, -1, rank, 1, 'cell', CAST(n AS VARCHAR) FROM nat
UNION ALL SELECT 1, 'region-' || scope, scope, 1, grp, -1, -1, 'group', nation FROM grp
UNION ALL SELECT 1, 'region-' || scope, scope, 1, grp, rank, -1, 'item', link || ': ' || cents FROM sup JOIN grp USING (scope, nation) WHERE k <= 3
UNION ALL SELECT 1, 'region-' || scope, scope, 1, grp, 9223372036854775807, -1, 'more', (n - 3) || ' more suppliers' FROM grp WHERE n > 3
UNION ALL SELECT 1, 'region-' || scope, scope, 2, -1, rank, -1, 'item', 'Ask ' || link || ' of ' || nation FROM deb
UNION ALL SELECT 1, 'region-' || scope, scope, 2, -1, 0, -1, 'text', 'Nobody owes anything.' FROM sc WHERE scope NOT IN (SELECT scope FROM deb)
UNION ALL SELECT 1, 'region-' || scope, scope, 3, -1, -1, -1, 'title', 'Largest' FROM big
UNION ALL SELECT 1, 'region-' || scope, scope, 3, -1, 0, -1, 'text', 'Most of all: ' || who || '.' FROM big
UNION ALL SELECT 2, 'odd', 0, -1, -1, -1, -1, 'heading', 'Nations without suppliers' WHERE EXISTS (SELECT 1 FROM odd)
UNION ALL SELECT 2, 'odd', 0, 0, -1, rank, -1, 'item', nation FROM odd
UNION ALL SELECT 3, 'sources', 0, -1, -1, -1, -1, 'heading', 'Sources'
UNION ALL SELECT 3, 'sources', 0, 0, -1, 0, -1, 'text', 'Build 7'"""


@R.query(_GUIDE)
def guide_render(t: Tables) -> DataFrame:
    lines = guide.render(SPEC, context(t), {"build_id": "7"})
    return lines.select("section", "section_id", "scope", "block", "grp", "item", "part", "kind", guide.plain(F.col("runs")).alias("text"))


# Identity

#: Two captures of parts. In the new one some have another name, source or facts; some rows are slots, some entities are absent.
_DESCRIPTOR = """p_type AS family, CASE WHEN p_size > 10 THEN 'large' ELSE 'small' END AS component, p_brand AS scope, concat('s', {src} // 4) AS source_id, concat('obj', {src} // 8) AS source_object,
 {name} AS name, md5({facts}) AS facts_hash, p_size > 5 AS has_facts, {paths} AS paths,
 CASE WHEN p_size % 3 = 0 THEN concat(p_name, '/', p_brand, '/', p_partkey // 3) END AS anchor, CASE WHEN p_partkey % 11 = 0 THEN 'slot' END AS context_kind, concat('r', p_size % 2) AS review"""
_NAME, _FACTS = "concat(p_name, ' ', p_partkey // 12)", "concat(p_name, p_size % 5, '-', p_partkey // 20)"
_WAS = {"src": "p_partkey", "name": _NAME, "facts": _FACTS}
_IS = {
    "src": "(p_partkey + CASE WHEN p_partkey % 5 = 0 THEN 4 ELSE 0 END)", "name": f"CASE WHEN p_partkey % 4 = 0 THEN concat({_NAME}, ' new') ELSE {_NAME} END",
    "facts": f"CASE WHEN p_partkey % 7 = 0 THEN 'other' ELSE {_FACTS} END",
}
_DUCK_PATHS = f"CASE WHEN p_size % 4 = 0 THEN CAST([] AS VARCHAR[]) ELSE ['a/' || {_NAME}, 'b/' || p_brand || p_size || '/' || p_partkey // 9] END"
_SPARK_PATHS = f"CASE WHEN p_size % 4 = 0 THEN cast(array() AS array<string>) ELSE array(concat('a/', {_NAME}), concat('b/', p_brand, p_size, '/', p_partkey // 9)) END"
_DUCK_WAS, _DUCK_IS = (_DESCRIPTOR.format(**x, paths=_DUCK_PATHS) for x in (_WAS, _IS))
_SPARK_WAS, _SPARK_IS = (_DESCRIPTOR.format(**x, paths=_SPARK_PATHS).replace("//", "div") for x in (_WAS, _IS))

_IDENTITY = f"""WITH n AS (SELECT concat('n', p_partkey) AS key, {_DUCK_IS} FROM part WHERE p_partkey % 3 <> 0),
o AS (SELECT concat('e', p_partkey) AS entity, CASE WHEN p_partkey % 10 = 0 THEN 'absent' ELSE 'present' END AS status, p_partkey % 14 = 0 AS unresolved, {_DUCK_WAS} FROM part WHERE p_partkey % 2 = 0),
na AS (SELECT family, component, anchor, min(key) AS key FROM n WHERE anchor IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) = 1),
oa AS (SELECT family, component, anchor, min(entity) AS entity FROM o WHERE anchor IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) = 1),
ap AS (SELECT entity, key FROM na JOIN oa USING (family, component, anchor) JOIN n USING (key) JOIN o USING (entity) WHERE (n.context_kind IS NULL AND o.context_kind IS NULL) OR n.review = o.review),
np AS (SELECT key, family, component, unnest(paths) AS path FROM n), op AS (SELECT entity, family, component, unnest(paths) AS path FROM o),
up AS (SELECT key, path FROM (SELECT family, component, path, min(key) AS key FROM np GROUP BY 1, 2, 3 HAVING count(*) = 1) JOIN (SELECT family, component, path FROM op GROUP BY 1, 2, 3 HAVING count(*) = 1) USING (family, component, path)),
d AS (SELECT n.key, o.entity, n.context_kind IS NULL AND o.context_kind IS NULL AS plain, n.name = o.name AS same_name, n.facts_hash = o.facts_hash AS same_facts, n.has_facts, o.status,
  len(n.paths) = 0 OR len(o.paths) = 0 OR list_has_any(n.paths, o.paths) AS paths_meet,
  n.anchor = o.anchor OR EXISTS (SELECT 1 FROM up JOIN op USING (path) WHERE up.key = n.key AND op.entity = o.entity) AS independent
 FROM n JOIN o USING (family, component, source_id) LEFT JOIN ap ON ap.entity = o.entity WHERE ap.key IS NULL OR ap.key = n.key),
pp AS (SELECT DISTINCT n.key, o.entity FROM np JOIN op USING (family, component, path) JOIN n ON n.key = np.key JOIN o ON o.entity = op.entity
 WHERE n.context_kind IS NULL AND o.context_kind IS NULL AND (n.name = o.name OR (n.has_facts AND n.facts_hash = o.facts_hash))),
props AS (SELECT key, entity, 4 AS level FROM ap
 UNION SELECT key, entity, CASE status WHEN 'present' THEN 3 ELSE 2 END FROM d WHERE plain AND CASE WHEN same_name THEN paths_meet OR same_facts ELSE coalesce(independent, false) AND has_facts AND same_facts END
 UNION SELECT key, entity, 2 FROM pp
 UNION SELECT n.key, o.entity, 1 FROM n JOIN o USING (family, component, scope, name, facts_hash) WHERE n.has_facts AND o.has_facts AND n.context_kind IS NULL AND o.context_kind IS NULL),
rel AS (SELECT key FROM d UNION SELECT key FROM props UNION SELECT n.key FROM n JOIN o USING (family, component, scope, name) UNION SELECT n.key FROM n JOIN o USING (family, component, anchor)),
fix AS (SELECT 'n' || p_partkey AS key, CASE WHEN p_partkey % 2 = 0 THEN 'e' || p_partkey ELSE 'new' END AS target FROM part WHERE p_partkey % 301 = 1),
fx AS (SELECT key, CASE target WHEN 'new' THEN 'e-' || sha256('capture 2|' || key || '|reviewed-new')[1:32] ELSE target END AS entity FROM fix WHERE key IN (SELECT key FROM n)),
top AS (SELECT key, max(level) AS level FROM props GROUP BY 1),
ch AS (SELECT key, entity, level FROM props JOIN top USING (key, level) WHERE key NOT IN (SELECT key FROM fx)),
mt AS (SELECT key, entity, level FROM (SELECT key, entity, level, count(*) OVER (PARTITION BY ch.key) AS a, count(*) OVER (PARTITION BY entity, level) AS b FROM ch)
 WHERE a = 1 AND b = 1 AND entity NOT IN (SELECT entity FROM fx) QUALIFY row_number() OVER (PARTITION BY entity ORDER BY level DESC) = 1)
SELECT n.key, coalesce(fx.entity, mt.entity, 'e-' || sha256('capture 2|' || n.family || '|' || n.key)[1:32]) AS entity,
 CASE WHEN fx.key IS NOT NULL THEN 'reviewed' WHEN mt.key IS NOT NULL THEN CASE WHEN o.unresolved AND mt.level <> 4 THEN 'ambiguous' ELSE 'matched' END WHEN n.key IN (SELECT key FROM rel) THEN 'ambiguous' ELSE 'new' END AS status, top.level
FROM n LEFT JOIN fx ON fx.key = n.key LEFT JOIN mt ON mt.key = n.key LEFT JOIN o ON o.entity = mt.entity LEFT JOIN top ON top.key = n.key"""


def identity_captures(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    new = t.sql(f"SELECT concat('n', p_partkey) AS key, {_SPARK_IS} FROM {{part}} WHERE p_partkey % 3 <> 0")
    old = t.sql(
        f"SELECT concat('e', p_partkey) AS entity, concat('n', p_partkey) AS key, CASE WHEN p_partkey % 10 = 0 THEN 'absent' ELSE 'present' END AS status, p_partkey % 14 = 0 AS unresolved, {_SPARK_WAS}"
        " FROM {part} WHERE p_partkey % 2 = 0"
    )
    fixes = t.sql("SELECT concat('n', p_partkey) AS key, CASE WHEN p_partkey % 2 = 0 THEN concat('e', p_partkey) ELSE 'new' END AS entity FROM {part} WHERE p_partkey % 301 = 1")
    return new, old, fixes.join(new.select("key"), "key", "left_semi")


@R.query(_IDENTITY)
def er_levels(t: Tables) -> DataFrame:
    """Two captures of parts at four levels, with vetoes and reviewed overrides; the fifth needs one capture twice."""
    new, old, fixes = identity_captures(t)
    return identity.assign(new, old, "capture 2", "request", reviewed=fixes).select("key", "entity", "status", "level")


@R.query("SELECT concat('n', p_partkey) AS key, concat('e', p_partkey) AS entity, 'matched' AS status, 5 AS level FROM part")
def er_same_capture(t: Tables) -> DataFrame:
    """A capture read again: each row is its own entity, whatever else it looks like."""
    rows = t.sql(f"SELECT concat('n', p_partkey) AS key, {_SPARK_WAS} FROM {{part}}")
    known = rows.withColumns({"entity": F.concat(F.lit("e"), F.substring("key", 2, 20)), "status": F.lit("present"), "unresolved": F.lit(False)})
    return identity.assign(rows, known, "capture 2", "request", same_capture=True).select("key", "entity", "status", "level")


# Placement


@R.query()
def place_two_budgets(t: Tables) -> DataFrame:
    """Documents into bins per source: pages of a unit stay together, earlier ones where they are, sealed bins are left alone."""
    doc = F.col("doc_id")
    unit = F.when(doc % 5 == 0, F.concat(F.lit("set"), F.floor(doc / 20))).otherwise(doc.cast("string"))
    n = F.coalesce("n_chars", F.lit(0))
    items = t.documents.select(
        F.col("source").alias("topic"), doc.alias("key"), unit.alias("unit"), F.md5(F.coalesce("text", F.lit(""))).alias("content"), F.when(doc % 3 == 0, n).otherwise(0).alias("a"), n.alias("b")
    )
    before = items.filter("key % 7 = 0")
    bins = before.groupBy("topic").agg(F.lit(0).alias("bin"), F.sum("a").alias("a"), F.sum("b").alias("b")).withColumn("sealed", F.col("topic").endswith("0"))
    return capacity.allocate(items, bins, before.select("topic", "key", F.lit(0).alias("bin")), (200_000, 600_000))


# Paths and ancestors


def part_tree(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    return t.part.select(key.alias("key"), key.cast("string").alias("name"), F.when(key != 1, F.floor(key / 3)).alias("parent"), (key % 3).alias("ordinal"))


_TREE = """p(key, path, ordinals, depth) AS (SELECT p_partkey, CAST(p_partkey AS VARCHAR), '', 1 FROM part WHERE p_partkey = 1
UNION ALL SELECT part.p_partkey, path || '/' || part.p_partkey, ordinals || '/' || part.p_partkey % 3, depth + 1 FROM p JOIN part ON part.p_partkey // 3 = p.key AND part.p_partkey <> p.key)"""


@R.query(f"WITH RECURSIVE {_TREE} SELECT key, path, ordinals, depth FROM p")
def hierarchy_path(t: Tables) -> DataFrame:
    """Paths from the root of a tree, with the ordinals on the way; parts outside the tree have none."""
    found = hierarchy.paths(part_tree(t)).filter("depth IS NOT NULL")
    ordinals = F.transform(F.slice("ordinals", 2, F.col("depth")), lambda x: F.concat(F.lit("/"), x.cast("string")))
    return found.select("key", F.array_join("names", "/").alias("path"), F.array_join(ordinals, "").alias("ordinals"), "depth")


@R.query(
    f"""WITH RECURSIVE {_TREE}, q AS (SELECT DISTINCT l_suppkey AS a, l_partkey AS b FROM lineitem)
SELECT a, b, coalesce(x.key <> y.key AND starts_with(y.path || '/', x.path || '/'), false) AS above FROM q LEFT JOIN p x ON x.key = a LEFT JOIN p y ON y.key = b"""
)
def ancestor_pairs(t: Tables) -> DataFrame:
    """Which pairs of order lines have their first part above the second one in the tree of parts."""
    labels = hierarchy.intervals(hierarchy.paths(part_tree(t)).filter("depth IS NOT NULL").select("key", F.col("names").alias("path")))
    return hierarchy.is_above(t.lineitem.select(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b")).distinct(), labels)


# Stage graphs


def stages() -> list[hierarchy.Stage]:
    per_nation = lambda table, key: lambda x: x[table].join(x["nation"], F.col(key) == F.col("n_nationkey")).groupBy("n_nationkey", "n_regionkey").count()
    both = lambda x: x["customers"].withColumnRenamed("count", "c").join(x["suppliers"].withColumnRenamed("count", "s"), ["n_nationkey", "n_regionkey"])
    return [
        hierarchy.Stage("summary", ("both", "region"), lambda x: x["both"].join(x["region"], F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.sum("c").alias("c"), F.sum("s").alias("s"))),
        hierarchy.Stage("customers", ("customer", "nation"), per_nation("customer", "c_nationkey")),
        hierarchy.Stage("suppliers", ("supplier", "nation"), per_nation("supplier", "s_nationkey")),
        hierarchy.Stage("both", ("customers", "suppliers"), both),
    ]


_COUNTS = """c AS (SELECT n_nationkey, n_regionkey, count(*) AS c FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2), s AS (SELECT n_nationkey, n_regionkey, count(*) AS s FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey > 0 GROUP BY 1, 2), b AS (SELECT * FROM c JOIN s USING (n_nationkey, n_regionkey))"""


@R.query(
    f"WITH {_COUNTS} SELECT 'customers' AS stage, true AS reused, count(*) AS rows FROM c UNION ALL SELECT 'suppliers', false, count(*) FROM s"
    " UNION ALL SELECT 'both', false, count(*) FROM b UNION ALL SELECT 'summary', false, count(DISTINCT n_regionkey) FROM b"
)
def stage_graph(t: Tables) -> DataFrame:
    """Stages run twice, the second time with other suppliers: only what needs them is built again."""
    names = ("customer", "supplier", "nation", "region")
    prints = {n: packing.files_fingerprint(files.inventory(t.spark, t.sf_dir, f"{n}.parquet")) for n in names}
    root = scratch(t.spark, "stages")
    sources = {n: (getattr(t, n), prints[n]) for n in names}
    hierarchy.run_stages(t.spark, stages(), sources, root)
    changed = sources | {"supplier": (t.supplier.filter("s_suppkey > 0"), prints["supplier"] + " changed")}
    out = [
        r.table.agg(F.count("*").alias("rows")).select(F.lit(name).alias("stage"), F.lit(r.reused).alias("reused"), "rows")
        for name, r in hierarchy.run_stages(t.spark, stages(), changed, root).items()
    ]
    return out[0].union(out[1]).union(out[2]).union(out[3])


# Ordered store

#: What a reader asks for: fifty keys and one prefix.
_KEYS = [str(k * 7) for k in range(50)]


@R.query(
    "SELECT key, doc_id, n_chars, how FROM (SELECT md5(CAST(doc_id AS VARCHAR)) AS key, doc_id, n_chars FROM documents), (VALUES ('key'), ('prefix')) v(how)"
    f" WHERE CASE how WHEN 'key' THEN key IN ({', '.join(f"md5('{k}')" for k in _KEYS)}) ELSE starts_with(key, 'a7') END"
)
def store_lookup(t: Tables) -> DataFrame:
    """Documents stored in order of their key; fifty keys and a prefix open only the files that can hold them."""
    folder = scratch(t.spark, "store")
    ordered.write(t.documents.select(F.md5(F.col("doc_id").cast("string")).alias("key"), "doc_id", "n_chars"), "key", folder, files=200)
    keys = [hashlib.md5(k.encode()).hexdigest() for k in _KEYS]
    found = ordered.by_keys(t.spark, folder, "key", keys).withColumn("how", F.lit("key"))
    return found.unionByName(ordered.by_prefix(t.spark, folder, "key", "a7").withColumn("how", F.lit("prefix")))


# Inverted index


@R.query(
    "SELECT p_partkey FROM (SELECT p_partkey, lower(CASE WHEN p_partkey % 10 = 3 THEN 'old small ' || p_type ELSE p_name || ' ' || p_brand || ' ' || p_type END) AS hay FROM part)"
    " WHERE contains(hay, 'small') AND contains(hay, 'econ')"
)
def index_search(t: Tables) -> DataFrame:
    """Parts that hold both words, found by postings; every tenth part was changed after the index was built."""
    folder = scratch(t.spark, "index")
    key = F.col("p_partkey")
    rows = t.part.select(key.alias("id"), F.lower(F.concat_ws(" ", "p_name", "p_brand", "p_type")).alias("hay"))
    changed = t.part.filter(key % 10 == 3).select(key.alias("id"), F.lower(F.concat(F.lit("old small "), "p_type")).alias("hay"))
    postings.build(rows, f"{folder}/0", files=32)
    postings.build(changed, f"{folder}/1", files=8)
    return postings.search(t.spark, [f"{folder}/0", f"{folder}/1"], ["small", "econ"]).select(F.col("id").alias("p_partkey"))
