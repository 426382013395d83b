"""Written and verified artifacts, texts of reports, definitions and placement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestack.operators import contracts, packing
from lodestack.plans import guides, history
from lodestack.plans.base import Registry, Tables
from lodestack.session import scratch
from lodestack.sources import files

R = Registry()


@R.query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def scan_jsonl_events(t: Tables) -> DataFrame:
    """Canonical JSON lines, written and read back with a declared schema; a malformed line fails the read."""
    path = scratch(t.spark, "events")
    files.write_json_lines(t.events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k")), f"{path}/rows")
    return files.json_lines(t.spark, f"{path}/rows", "event_id long, k long").select("event_id", "k")


@R.query("SELECT event_id, '{\"event_type\":\"' || event_type || '\",\"id\":' || event_id || ',\"none\":null}' AS line FROM events")
def write_canonical_rows(t: Tables) -> DataFrame:
    """Lines as they are written: sorted keys, compact, nulls kept."""
    path = scratch(t.spark, "rows")
    files.write_json_lines(t.events.select(F.col("event_id").alias("id"), "event_type", F.lit(None).cast("string").alias("none")), f"{path}/rows")
    lines = t.spark.read.text(f"{path}/rows")
    return lines.select(F.get_json_object("value", "$.id").cast("long").alias("event_id"), F.col("value").alias("line"))


@R.query("SELECT n_regionkey AS region, count(*) AS nations FROM nation GROUP BY 1")
def scan_json_document(t: Tables) -> DataFrame:
    """A document of its own per file, here a list of regions with their nations."""
    path = scratch(t.spark, "documents")
    names = t.nation.groupBy(F.col("n_regionkey").alias("region")).agg(F.array_sort(F.collect_list("n_name")).alias("names"))
    names.agg(F.to_json(F.collect_list(F.struct("names", "region"))).alias("value")).write.text(f"{path}/rows")
    return files.json_document(t.spark, f"{path}/rows", "region long, names array<string>").select("region", F.size("names").cast("long").alias("nations"))


@R.query("SELECT unnest(['nation.parquet', 'region.parquet', 'none.parquet']) AS path, unnest(['same', 'changed', 'missing']) AS state")
def verify_artifacts(t: Tables) -> DataFrame:
    """A manifest of sizes and hashes against the files that are there."""
    there = files.hashes(t.spark, t.sf_dir, "{nation,region}.parquet")
    wrong = F.when(F.col("path") == "region.parquet", F.sha2("sha256", 256)).otherwise(F.col("sha256"))
    absent = t.spark.range(1).select(F.lit("none.parquet").alias("path"), F.lit(1).cast("long").alias("bytes"), F.lit("").alias("sha256"))
    return files.verified(t.spark, t.sf_dir, "{nation,region}.parquet", there.withColumn("sha256", wrong).unionByName(absent))


@R.query(
    f"WITH d AS (SELECT *, (row_number() OVER (PARTITION BY op ORDER BY key) - 1) // 100 AS page FROM ({history.R.oracles['snapshot_diff']})) SELECT op, page, '## ' || upper(op[1]) || op[2:]"
    " || chr(10) || string_agg('- entry ' || key, chr(10) ORDER BY key) AS section FROM d GROUP BY op, page"
)
def change_log_text(t: Tables) -> DataFrame:
    """The sections of a change log in pages of a hundred lines, in order of keys."""
    placed = packing.ordered(history.snapshot_diff(t), ["key"], "k", ("op",))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list("key")), lambda k: F.concat(F.lit("- entry "), k)), "\n")
    rows = placed.groupBy("op", F.expr("k div 100").alias("page")).agg(lines.alias("body"))
    return rows.select("op", "page", F.concat(F.lit("## "), F.initcap("op"), F.lit("\n"), "body").alias("section"))


@R.query("SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN CAST(event_id AS DOUBLE) END AS value, CASE event_id % 10 WHEN 0 THEN 'nan' WHEN 5 THEN '-infinity' END AS marker FROM events")
def sentinel_numbers(t: Tables) -> DataFrame:
    """Numbers whose special values are spelled as objects: {"float": "nan"}."""
    special = F.concat(F.lit('{"float":"'), F.when(F.col("event_id") % 10 == 0, "nan").otherwise("-infinity"), F.lit('"}'))
    raw = F.when(F.col("event_id") % 5 == 0, special).otherwise(F.col("event_id").cast("string"))
    return t.events.select("event_id", contracts.sentinel_number(F.parse_json(raw)).alias("x")).select("event_id", "x.value", "x.marker")


_DEFINITION = """CASE p_partkey % 5 WHEN 0 THEN '{"kind":"item","fields":["a","b"]}' WHEN 1 THEN '{"kind":"item"}' WHEN 2 THEN '{"kind":"ghost","fields":["a"]}'
 WHEN 3 THEN '{"kind":"item","fields":["a","b","c","d"]}' ELSE '{"kind":"item","fields":[],"extra":1}' END"""


@R.query("SELECT p_partkey, unnest(CASE p_partkey % 5 WHEN 1 THEN ['missing-field'] WHEN 2 THEN ['unowned-kind'] WHEN 3 THEN ['too-many'] ELSE ['too-few', 'new-field'] END) AS code FROM part WHERE p_partkey % 5 <> 0")
def definition_issues(t: Tables) -> DataFrame:
    """Definitions against a closed set of keys, owned kinds and bounds of their lists."""
    rows = t.part.select("p_partkey", F.expr(_DEFINITION).alias("j"))
    return contracts.definition_issues(rows, "j", ["p_partkey"], required=("kind", "fields"), kinds=("item", "recipe"), lists={"fields": (1, 3)})


@R.query(f"WITH d AS ({guides.R.oracles['disambiguate_names']}) SELECT p_type AS kind, count(*) FILTER (WHERE name <> p_name) AS renamed, count(*) AS entries FROM d JOIN part USING (p_partkey) GROUP BY 1")
def rename_counts(t: Tables) -> DataFrame:
    """Entries whose shown name differs from their own, per kind."""
    rows = guides.disambiguate_names(t).join(t.part.select("p_partkey", "p_name", F.col("p_type").alias("kind")), "p_partkey")
    return rows.groupBy("kind").agg(F.count_if(F.col("name") != F.col("p_name")).alias("renamed"), F.count("*").alias("entries"))


@R.query("SELECT 1 AS n, 'gathering' AS topic FROM lineitem HAVING count(*) FILTER (WHERE l_returnflag = 'A') > 0")
def gq_gathering_intro(t: Tables) -> DataFrame:
    """One row of fixed words, if anything is gathered at all."""
    return t.lineitem.agg(F.count_if(F.col("l_returnflag") == "A").alias("c")).filter("c > 0").select(F.lit(1).alias("n"), F.lit("gathering").alias("topic"))


@R.query(f"SELECT layer AS ring, min(inner_edge) AS inner_edge, max(outer_edge) AS outer_edge, count(biome) AS biomes FROM ({history.R.oracles['ring_spans']}) GROUP BY 1")
def gq_ring_span(t: Tables) -> DataFrame:
    """Where each ring begins and ends."""
    return history.ring_spans(t).groupBy(F.col("layer").alias("ring")).agg(F.min("inner_edge").alias("inner_edge"), F.max("outer_edge").alias("outer_edge"), F.count("biome").alias("biomes"))


@R.query("SELECT r_regionkey AS region, '| Nation | Key |' || chr(10) || '|-|-|' || chr(10) || string_agg('| ' || n_name || ' | ' || n_nationkey || ' |', chr(10) ORDER BY n_nationkey) AS md FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1")
def markdown_table(t: Tables) -> DataFrame:
    """A table per scope, rows in order."""
    row = F.struct("n_nationkey", F.concat(F.lit("| "), "n_name", F.lit(" | "), "n_nationkey", F.lit(" |")).alias("line"))
    rows = t.nation.groupBy(F.col("n_regionkey").alias("region")).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return rows.select("region", F.concat(F.lit("| Nation | Key |\n|-|-|\n"), F.array_join(F.transform("rows", lambda x: x["line"]), "\n")).alias("md"))


@R.query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def all_rows(t: Tables) -> DataFrame:
    """A full scan of the shown columns."""
    return t.customer.select("c_custkey", "c_name", "c_nationkey")


@R.query("SELECT source AS topic, count(*) AS objects, CAST(sum(n_chars) AS BIGINT) AS bytes, max(n_chars) AS largest, max(n_chars) > 15000 AS over_budget, CAST(ceil(sum(n_chars) / 60000.0) AS BIGINT) AS partitions FROM documents GROUP BY 1")
def placement_inventory(t: Tables) -> DataFrame:
    """What each topic has to place, against the budget of an object and of a partition."""
    rows = t.documents.groupBy(F.col("source").alias("topic")).agg(F.count("*").alias("objects"), F.sum("n_chars").alias("bytes"), F.max("n_chars").alias("largest"))
    return rows.select("topic", "objects", "bytes", "largest", (F.col("largest") > 15000).alias("over_budget"), F.ceil(F.col("bytes") / 60000).alias("partitions"))


@R.query()
def place_levels(t: Tables) -> DataFrame:
    """Leaves, then indexes over the bins of leaves, then one configuration over the bins of indexes."""
    leaves = t.documents.select(F.col("source").alias("topic"), F.col("doc_id").alias("key"), F.col("n_chars").alias("size"))
    return packing.place_levels(leaves, budget=30_000, entry_bytes=200)
