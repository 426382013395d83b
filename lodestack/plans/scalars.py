"""Scalar functions: naming, formats, text assembly, time and enums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestack.functions import text as X
from lodestack.operators import search
from lodestack.plans.base import Registry, Tables

R = Registry()


_RAW = """CASE event_id % 6 WHEN 0 THEN event_type || 'EventKind' || event_id % 7 WHEN 1 THEN 'HTTPServer_' || event_type WHEN 2 THEN 'z-' || event_type || '/M4A1Rifle'
 WHEN 3 THEN event_type || 'HitSet' WHEN 4 THEN '_' ELSE 'JSONTo' || upper(event_type) || 'View' END"""


@R.query(
    f"""WITH r AS (SELECT event_id, {_RAW} AS raw FROM events),
w AS (SELECT event_id, raw, list_filter(string_split_regex(regexp_replace(regexp_replace(raw, '([a-z0-9])([A-Z])|([A-Z])([A-Z][a-z])', '\\1\\3 \\2\\4', 'g'), '[_/-]+', ' ', 'g'), ' +'), lambda x: x <> '') AS l FROM r),
k AS (SELECT event_id, raw, CASE WHEN len(l) >= 2 AND lower(l[-2] || ' ' || l[-1]) = 'hit set' THEN l[1:len(l) - 2] ELSE l END AS l FROM w)
SELECT event_id, raw, CASE WHEN len(l) = 0 THEN 'Unnamed record' ELSE upper(array_to_string(l, ' ')[1]) || lower(array_to_string(l, ' ')[2:]) END AS label FROM k"""
)
def humanize(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.expr(_RAW).alias("raw")).select("event_id", "raw", X.humanize(F.col("raw")).alias("label"))


@R.query("SELECT o_orderkey, lower(regexp_replace(regexp_replace(o_orderpriority, '^[0-9]-', ''), '[ _]+', ' ', 'g')) AS label FROM orders")
def readable_enum(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", F.lower(F.regexp_replace(F.regexp_replace("o_orderpriority", "^[0-9]-", ""), "[ _]+", " ")).alias("label")
    )


@R.query("SELECT s_suppkey, CASE WHEN regexp_extract(s_name, '(\\d+)$', 1) LIKE '%7' THEN 'seven' WHEN regexp_matches(s_name, '0{3,}') THEN 'padded' ELSE 'plain' END AS pattern FROM supplier")
def regex_case_name(t: Tables) -> DataFrame:
    digits = F.regexp_extract("s_name", r"(\d+)$", 1)
    return t.supplier.select("s_suppkey", F.when(digits.endswith("7"), "seven").when(F.col("s_name").rlike("0{3,}"), "padded").otherwise("plain").alias("pattern"))


@R.query("SELECT p_partkey, CAST(regexp_extract('box_' || p_size || 'x' || (p_size + 1), '(\\d+)x(\\d+)', 1) AS INT) AS w, CAST(regexp_extract('box_' || p_size || 'x' || (p_size + 1), '(\\d+)x(\\d+)', 2) AS INT) AS h FROM part")
def shape_extract(t: Tables) -> DataFrame:
    name = F.concat(F.lit("box_"), "p_size", F.lit("x"), F.col("p_size") + 1)
    return t.part.select("p_partkey", *[F.regexp_extract(name, r"(?<=_)(\d+)x(\d+)", k).cast("int").alias(n) for k, n in ((1, "w"), (2, "h"))])


@R.query("SELECT p_partkey, regexp_replace(p_name || '_lod1_small_02', '(_(lod[0-9]+|small|[0-9]+))+$', '') AS family FROM part")
def token_strip(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.regexp_replace(F.concat("p_name", F.lit("_lod1_small_02")), "(_(lod[0-9]+|small|[0-9]+))+$", "").alias("family"))


@R.query("SELECT p_partkey, list_has_all(string_split(p_name || ' old', ' '), string_split(p_name, ' ')) AND p_size > 25 AS subset FROM part")
def word_subset(t: Tables) -> DataFrame:
    inside = X.word_subset(F.col("p_name"), F.concat("p_name", F.lit(" old")))
    return t.part.select("p_partkey", (inside & (F.col("p_size") > 25)).alias("subset"))


@R.query("SELECT l_orderkey, l_linenumber, l_partkey, round(CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(l_discount AS DECIMAL(18,4)) AS DECIMAL(18,4)), 2)::DOUBLE AS v FROM lineitem")
def round_half_up(t: Tables) -> DataFrame:
    v = (F.col("l_extendedprice").cast("decimal(18,4)") * F.col("l_discount").cast("decimal(18,4)")).cast("decimal(18,4)")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.round(v, 2).cast("double").alias("v"))


@R.query(
    """SELECT p_partkey, format('{:,}', CAST(p_size * 1000 AS BIGINT)) AS integer, CASE WHEN p_size > 0 THEN CAST(p_size AS VARCHAR) END AS positive, p_size || '%' AS percent,
 'x' || p_size AS multiplier, p_size || ' - ' || (p_size + 2) AS range, p_size * 60 || ' per minute' AS per_minute, CASE WHEN p_size % 2 = 1 THEN 'Yes' ELSE 'No' END AS yes_no FROM part"""
)
def display_formats(t: Tables) -> DataFrame:
    n = F.col("p_size")
    return t.part.select(
        "p_partkey", X.thousands(n * 1000).alias("integer"), F.when(n > 0, n.cast("string")).alias("positive"), F.concat(n, F.lit("%")).alias("percent"),
        F.concat(F.lit("x"), n).alias("multiplier"), F.concat(n, F.lit(" - "), n + 2).alias("range"), F.concat(n * 60, F.lit(" per minute")).alias("per_minute"),
        F.when(n % 2 == 1, "Yes").otherwise("No").alias("yes_no"),
    )


@R.query("SELECT p_partkey, CASE WHEN p_size * 100 >= 1000 THEN CAST(CAST(p_size AS DECIMAL(18,1)) / 10 AS DECIMAL(18,1)) || ' km' ELSE p_size * 100 || ' m' END AS distance FROM part")
def format_distance(t: Tables) -> DataFrame:
    km = (F.col("p_size").cast("decimal(18,1)") / 10).cast("decimal(18,1)")
    return t.part.select("p_partkey", F.when(F.col("p_size") * 100 >= 1000, F.concat(km, F.lit(" km"))).otherwise(F.concat(F.col("p_size") * 100, F.lit(" m"))).alias("distance"))


@R.query("SELECT l_orderkey, l_linenumber, l_partkey, CAST((CAST(1 + l_discount AS DECIMAL(18,4)) - 1) * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * 100 AS DOUBLE) AS effect FROM lineitem")
def effect_percent(t: Tables) -> DataFrame:
    """(factor - neutral) * direction * 100, in decimals."""
    direction = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    effect = ((1 + F.col("l_discount")).cast("decimal(18,4)") - 1) * direction * 100
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", effect.cast("double").alias("effect"))


@R.query("SELECT l_orderkey AS recipe, coalesce(p_name, 'unknown') AS name, CAST(l_quantity AS BIGINT) AS count, p_partkey AS target, p_partkey IS NULL AS gap FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON p_partkey = l_partkey")
def ingredient_rows(t: Tables) -> DataFrame:
    known = t.part.filter("p_size > 10").select("p_partkey", "p_name")
    rows = t.lineitem.join(known, F.col("p_partkey") == F.col("l_partkey"), "left")
    return rows.select(
        F.col("l_orderkey").alias("recipe"), F.coalesce("p_name", F.lit("unknown")).alias("name"), F.col("l_quantity").cast("long").alias("count"),
        F.col("p_partkey").alias("target"), F.col("p_partkey").isNull().alias("gap"),
    )


@R.query("SELECT p_partkey, 'Brand=' || p_brand || CASE WHEN p_size > 10 THEN ' | Size=' || p_size ELSE '' END || ' | Type=' || p_type AS card FROM part")
def card_stats(t: Tables) -> DataFrame:
    """Facts against a registry of fields: order, label and the rule that omits small sizes."""
    registry = (("Brand", F.col("p_brand"), F.lit(True)), ("Size", F.col("p_size").cast("string"), F.col("p_size") > 10), ("Type", F.col("p_type"), F.lit(True)))
    rows = F.array_compact(F.array(*[F.when(shown, F.concat(F.lit(f"{label}="), value)) for label, value, shown in registry]))
    return t.part.select("p_partkey", F.array_join(rows, " | ").alias("card"))


@R.query("SELECT p_partkey, 'The ' || p_name || ' is a ' || p_type || ' of size ' || p_size || '.' AS line FROM part")
def template_fill(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", X.fill("The {p_name} is a {p_type} of size {p_size}.").alias("line"))


@R.query(
    """SELECT n_regionkey, CASE WHEN len(l) = 1 THEN l[1] ELSE array_to_string(l[1:len(l) - 1], ', ') || ' and ' || l[len(l)] END AS names FROM (SELECT n_regionkey, list(n_name ORDER BY n_name) AS l FROM nation GROUP BY 1)"""
)
def join_with_and(t: Tables) -> DataFrame:
    return t.nation.groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("l")).select("n_regionkey", X.join_and(F.col("l")).alias("names"))


@R.query("SELECT p_partkey, replace(replace(replace('*' || p_name || '_<' || p_size || '>', '*', '\\*'), '_', '\\_'), '<', '&lt;') AS md FROM part")
def escape_markdown(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", X.escape_markdown(F.concat(F.lit("*"), "p_name", F.lit("_<"), "p_size", F.lit(">"))).alias("md"))


@R.query("SELECT event_id, CASE WHEN ts > TIMESTAMP '2024-01-30' - INTERVAL 3 DAY THEN 'fresh' WHEN event_type = 'error' AND ts > TIMESTAMP '2024-01-30' - INTERVAL 10 DAY THEN 'retry' ELSE 'stale' END AS state FROM events")
def ttl_age(t: Tables) -> DataFrame:
    age = F.timestamp_diff("SECOND", F.col("ts"), F.lit("2024-01-30").cast("timestamp"))
    day = 86400
    return t.events.select("event_id", F.when(age < 3 * day, "fresh").when((F.col("event_type") == "error") & (age < 10 * day), "retry").otherwise("stale").alias("state"))


@R.query("SELECT p_name, CASE WHEN count(DISTINCT p_type) = 1 AND count(*) = count(p_type) THEN min(p_type) END AS label FROM part GROUP BY 1")
def unique_label(t: Tables) -> DataFrame:
    one = (F.min("p_type") == F.max("p_type")) & (F.count("*") == F.count("p_type"))
    return t.part.groupBy("p_name").agg(F.when(one, F.min("p_type")).alias("label"))


@R.query("SELECT p_partkey, coalesce(n_name, 'Unresolved code (' || p_size || ')') AS label FROM part LEFT JOIN nation ON n_nationkey = p_size")
def enum_decode(t: Tables) -> DataFrame:
    names = t.nation.select(F.col("n_nationkey").alias("p_size"), "n_name")
    return t.part.join(names, "p_size", "left").select("p_partkey", F.coalesce("n_name", F.concat(F.lit("Unresolved code ("), "p_size", F.lit(")"))).alias("label"))


@R.query("SELECT p_partkey, 'https://example.org/wiki/' || replace(p_name, ' ', '+') || '?rev=' || p_partkey AS url FROM part")
def url_build(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.concat(F.lit("https://example.org/wiki/"), F.url_encode("p_name"), F.lit("?rev="), "p_partkey").alias("url"))


@R.query("SELECT doc_id, CASE WHEN strlen(text) <= 16384 THEN text ELSE 'too long' END AS body FROM documents")
def render_text(t: Tables) -> DataFrame:
    """Rendered text up to a size in bytes."""
    return t.documents.select("doc_id", F.when(F.octet_length("text") <= 16 * 1024, F.col("text")).otherwise("too long").alias("body"))


@R.query("SELECT n_regionkey, 'Ring ' || (n_regionkey + 1) || ': ' || string_agg(n_name, ', ' ORDER BY n_name) AS label FROM nation GROUP BY 1")
def ring_label(t: Tables) -> DataFrame:
    names = F.array_join(F.array_sort(F.collect_list("n_name")), ", ")
    return t.nation.groupBy("n_regionkey").agg(names.alias("l")).select("n_regionkey", F.concat(F.lit("Ring "), F.col("n_regionkey") + 1, F.lit(": "), "l").alias("label"))


def _findings(t: Tables) -> DataFrame:
    return X.jargon_spans(t.documents.select(F.col("doc_id").alias("id"), "text"))


@R.query()
def jargon_findings(t: Tables) -> DataFrame:
    """Findings of each rule per document."""
    return _findings(t).groupBy(F.col("id").alias("doc_id")).agg(*[F.count_if(F.col("rule") == rule).alias(rule) for rule in X.JARGON])


@R.query()
def jargon_by_source(t: Tables) -> DataFrame:
    found = _findings(t).groupBy(F.col("id").alias("doc_id")).agg(F.count("*").alias("n"))
    rows = t.documents.select("doc_id", "source").join(found, "doc_id", "left")
    return rows.groupBy("source").agg(F.sum(F.coalesce("n", F.lit(0))).alias("findings"), F.count("n").alias("affected"), F.count("*").alias("docs"))


@R.query()
def jargon_by_field(t: Tables) -> DataFrame:
    """Findings per topic, kind, field and rule, with the entities affected and all there are."""
    entities = t.documents.groupBy(F.col("source").alias("topic"), F.col("lang").alias("kind")).agg(F.count("*").alias("entities"))
    fields = F.array(*(F.struct(F.lit(n).alias("field"), F.col(n).alias("text")) for n in ("text", "source")))
    each = t.documents.select("doc_id", F.col("source").alias("topic"), F.col("lang").alias("kind"), F.explode(fields).alias("f"))
    spans = X.jargon_spans(each.select(F.struct("topic", "kind", "f.field", "doc_id").alias("id"), F.col("f.text").alias("text")))
    found = spans.groupBy("id", "rule").agg(F.count("*").alias("n")).groupBy("id.topic", "id.kind", "id.field", "rule")
    return found.agg(F.sum("n").alias("findings"), F.count("*").alias("affected")).join(entities, ["topic", "kind"], "left")


@R.query(
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CASE event_type WHEN 'click' THEN 1 ELSE 2 END || ' ' ELSE event_type END AS text, event_id % 3 = 0 AS raw_enum FROM events"""
)
def jargon_raw_enum(t: Tables) -> DataFrame:
    """A bare integer where a field holds codes is a finding of its own."""
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.when(F.col("event_type") == "click", 1).otherwise(2).cast("string"), F.lit(" "))).otherwise(F.col("event_type"))
    rows = t.events.select(F.col("event_id").alias("id"), text.alias("text"))
    found = X.jargon_spans(rows, coded=F.lit(True)).filter("rule = 'raw_enum'").select("id", F.lit(True).alias("hit"))
    return rows.join(found, "id", "left").select(F.col("id").alias("event_id"), "text", F.coalesce("hit", F.lit(False)).alias("raw_enum"))


@R.query("SELECT p_partkey, regexp_extract('bundles/' || lower(p_brand) || '.bundle#' || p_partkey, '([^/#]+)\\.bundle', 1) AS bundle FROM part")
def bundle_name(t: Tables) -> DataFrame:
    """Name of the bundle in an id."""
    source = F.concat(F.lit("bundles/"), F.lower("p_brand"), F.lit(".bundle#"), "p_partkey")
    return t.part.select("p_partkey", F.regexp_extract(source, r"([^/#]+)\.bundle", 1).alias("bundle"))


@R.query("SELECT p_partkey, rtrim(rtrim(p_name || ' : '), ':') AS label FROM part")
def strip_colon(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.regexp_replace(F.rtrim(F.concat("p_name", F.lit(" : "))), ":+$", "").alias("label"))


@R.query("SELECT o_orderkey, CAST(epoch(CAST(o_orderdate AS TIMESTAMP)) AS BIGINT) AS seconds, TRY_CAST(CASE WHEN o_orderkey % 5 = 0 THEN 'x' ELSE '' END || o_orderkey AS BIGINT) AS build, o_orderkey > 9 AND o_orderkey % 5 <> 0 AS newer_than_9 FROM orders")
def build_ids(t: Tables) -> DataFrame:
    """Unix times as integers; build ids are digits compared as numbers, anything else is none."""
    build = F.concat(F.when(F.col("o_orderkey") % 5 == 0, "x").otherwise(""), "o_orderkey").try_cast("long")
    return t.orders.select("o_orderkey", F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("seconds"), build.alias("build"), F.coalesce(build > 9, F.lit(False)).alias("newer_than_9"))


@R.query("SELECT p_partkey, regexp_replace(p_name, '(red|old|small)', '[\\1]', 'g') AS marked FROM part")
def highlight(t: Tables) -> DataFrame:
    """Names with the matches of a search in brackets."""
    rows = t.part.withColumn("form", X.search_form("p_name"))
    return rows.select("p_partkey", search.highlighted(F.col("p_name"), F.col("form"), "red old small").alias("marked"))


@R.query()
def article_state_pages(t: Tables) -> DataFrame:
    """populated, empty or unavailable, with a reason."""
    return t.pages.select("page_id", X.article_state(F.col("html")).alias("x")).select("page_id", "x.state", "x.reason")


@R.query()
def jargon_spans(t: Tables) -> DataFrame:
    """Findings with places; one that overlaps a finding of an earlier rule is suppressed."""
    return _findings(t)


@R.query()
def normalized_titles(t: Tables) -> DataFrame:
    """Whole texts in compatibility form, folded and with marks stripped, for joins and search."""
    return t.documents.select("doc_id", X.fold("text").alias("folded"))
