"""The queries of this subpackage, one per operator, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.llm import (
    decontaminate, html_text, line_dedup, merkle, packing, pieces, quality, repeats, secret_scan, sharding, simhash, spelling, toxicity,
)
from lodestack.session import table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    back = pieces.decode(pieces.encode(docs).withColumn("ids", F.col("tokens")))
    # U+2581 is the vocabulary's own mark for a space.
    return back.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.col("ids").alias("tokens"),
        F.octet_length("decoded").cast("long").alias("n_bytes"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.xxhash64("decoded") == F.col("th")).alias("round_trip"),
    )


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    text = F.col("main_text")
    return html_text.extract(pages).select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = toxicity.is_held_out(F.col("doc_id"))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", "toxic"))
    return toxicity.score(docs, model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "passages",
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.drop_repeated_lines(docs)
    return out.select(
        "doc_id", "line_dedup.n_lines", "line_dedup.n_dropped", F.sha2("line_dedup.kept", 256).alias("kept_sha256")
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
    )
    return sharding.shard(rows, shards=8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard_place.shard",
        "shard_place.slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    groups = simhash.near_groups(docs, size=4)
    return groups.select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("id").alias("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secret_scan.digest(F.col("base")), 256).alias("base_sha256"),
        secret_scan.digest(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality.quality(docs).select(F.col("id").alias("doc_id"), *names, *quality.FIGURES)


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "first_word")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    told = {c: F.col(c) for c in fields}
    # Wide enough for one more than the largest long.
    more = told | {"n_chars": F.col("n_chars").cast("decimal(38,0)") + 1}
    is_tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    tampered = F.when(is_tampered, merkle.leaf(*more.values()))
    n_chars_null = F.col("n_chars").isNull()
    carry = {"doc_id": F.col("doc_id"), "tampered": F.when(~n_chars_null, tampered)}
    made = merkle.manifest(table(spark, sf_dir, "documents"), merkle.leaf(*told.values()), F.col("lang"), F.col("doc_id"), carry)
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    proof = F.sha2(merkle.proof_text(F.col("path")), 256)
    out = made.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(table(spark, sf_dir, "documents"))
    return spelling.variants(words, shortest=spelling.MIN_CHARS)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pieces_of(packing.pack(table(spark, sf_dir, "documents")))
    return pieces.withColumnRenamed("id", "doc_id")


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_html_extraction": op2_html_extraction,
    "op3_toxicity": op3_toxicity,
    "op4_line_dedup": op4_line_dedup,
    "op5_sharding": op5_sharding,
    "op6_simhash": op6_simhash,
    "op7_secret_scan": op7_secret_scan,
    "op8_quality_rules": op8_quality_rules,
    "op9_repeats": op9_repeats,
    "op10_decontamination": op10_decontamination,
    "op11_merkle": op11_merkle,
    "op12_spelling": op12_spelling,
    "op13_packing": op13_packing,
}

_KEY = (
    "translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),"
    " 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes, bit by bit."""
    bits = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda a, b: {bits}), 4294967295)"


def _leaf(n_chars: str) -> str:
    values = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", n_chars, "text")]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in values) + ")"


_TREE = """SELECT g, lv + 1, i // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY i)) FROM {0} WHERE n > 1 GROUP BY g, lv, i // 2"""
_STEPS = """SELECT {1}.r, {2} + x.lv AS k, x.i % 2 AS slot, coalesce(y.h, '') AS h FROM {1} JOIN {0} x ON x.g = {1}.g AND x.i = {1}.p >> x.lv AND x.n > 1
 LEFT JOIN {0} y ON y.g = x.g AND y.lv = x.lv AND y.i = xor(x.i, 1)"""

ORACLES = {
    "op11_merkle": f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('1' || lang, '0') AS g, {_leaf("n_chars")} AS leaf,
 CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 AND n_chars IS NOT NULL THEN {_leaf("(CAST(n_chars AS HUGEINT) + 1)")} END AS tampered FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY g) AS n FROM d),
t(g, lv, i, n, h) AS (SELECT g, 0, p, n, leaf FROM p UNION ALL {_TREE.format("t")}),
s AS (SELECT g AS name, '' AS g, h, row_number() OVER (ORDER BY g) - 1 AS p, count(*) OVER () AS n FROM t WHERE n = 1),
u(g, lv, i, n, h) AS (SELECT g, 0, p, n, h FROM s UNION ALL {_TREE.format("u")}),
q AS (SELECT p.r, s.g, s.p FROM p JOIN s ON s.name = p.g),
e AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY k) AS step FROM ({_STEPS.format("t", "p", 0)} UNION ALL {_STEPS.format("u", "q", 1000)})),
f(r, step, h) AS (SELECT r, CAST(0 AS BIGINT), coalesce(tampered, leaf) FROM p
 UNION ALL SELECT f.r, e.step, sha256(CASE e.slot WHEN 0 THEN f.h || e.h ELSE e.h || f.h END) FROM f JOIN e ON e.r = f.r AND e.step = f.step + 1),
z AS (SELECT r, arg_max(h, step) AS folded_root FROM f GROUP BY r), w AS (SELECT r, sha256(string_agg(h, '' ORDER BY step)) AS proof FROM e GROUP BY r), o AS (SELECT h AS root FROM u WHERE n = 1)
SELECT doc_id, leaf, s.h AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM p JOIN s ON s.name = p.g JOIN z USING (r) LEFT JOIN w USING (r), o""",
    "op12_spelling": f"""
WITH RECURSIVE runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]{{7,}}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
each AS (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY 1, 2),
h AS (SELECT run, times, {_crc32("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)")} AS h FROM each),
words AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM h),
v AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM words WHERE length(word) >= 7 GROUP BY 1 HAVING sum(times) >= 2),
k AS (SELECT word, n, unnest(range(length(word))) AS i FROM v),
less AS (SELECT DISTINCT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM k),
pairs AS (SELECT a.word AS a, b.word AS b FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
 UNION SELECT l.word, v.word FROM less l JOIN v ON v.word = l.rest UNION SELECT v.word, l.word FROM less l JOIN v ON v.word = l.rest),
near AS (SELECT a AS word, count(*) AS n_near, min(struct_pack(down := -v.n, word := b)) AS best FROM pairs JOIN v ON v.word = b GROUP BY a),
x AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.down >= 10 * v.n THEN best.word END AS form, CASE WHEN -best.down >= 10 * v.n THEN -best.down END AS form_n FROM v LEFT JOIN near USING (word)),
c(word, root, hop) AS (SELECT word, word, 0 FROM x UNION ALL SELECT c.word, x.form, hop + 1 FROM c JOIN x ON x.word = c.root WHERE x.form IS NOT NULL),
r AS (SELECT word, arg_max(root, hop) AS root FROM c GROUP BY 1)
SELECT word, form, root, n, n_near, form_n FROM x JOIN r USING (word)""",
    "op4_line_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
e AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT r, doc_id, pos, line, {_KEY} AS key FROM e),
f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key
      HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 5),
m AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM f.keeper AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r""",
}
