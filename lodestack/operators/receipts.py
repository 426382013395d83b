"""Receipts of owned files: pages of records by key range, each under a byte limit and named by its hash, and their decoder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestack.operators.packing import in_packs
from lodestack.session import cut

RECORD = "struct<sha256:string,bytes:long,allocated:boolean,retained:boolean>"


def _entry(path: Column, record: Column) -> Column:
    """One member of a page: canonical JSON, flags only where they are set."""
    flag = lambda name: F.when(record[name], F.lit(True)).alias(name)
    told = F.struct(flag("allocated"), record["bytes"].alias("bytes"), flag("retained"), record["sha256"].alias("sha256"))
    # to_json leaves nulls out and quotes a text; a list of one gives the quoted path alone.
    quoted = F.to_json(F.array(path))
    return F.concat(F.substring(quoted, F.lit(2), F.length(quoted) - 2), F.lit(":"), F.to_json(told))


def _summary(files: DataFrame) -> Column:
    half = lambda k: F.sum(F.conv(F.substring(F.sha2("entry", 256), 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)")).cast("string")
    return F.sha2(F.concat_ws("|", F.count("*").cast("string"), *(half(k) for k in range(4))), 256)


def encode(files: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """files(path, sha256, bytes, allocated, retained) -> pages(name, first, last, count, bytes, body) and a root of one row.

    A page is a JSON object of its records in order of paths; its name is the
    hash of its bytes, so a page that has not changed is not written again. The
    root has the numbers of files and flags and a sum of all records' hashes.
    """
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("allocated", "retained")]
    rows = files.select(F.col("path").alias("key"), F.struct("sha256", F.col("bytes").cast("long").alias("bytes"), *flags).cast(RECORD).alias("record"))
    rows = rows.withColumn("entry", _entry(F.col("key"), F.col("record")))
    # Braces and commas: one byte more than the entries.
    rows = cut(rows.withColumn("size", (F.octet_length("entry") + 1).cast("long")))
    twice = [r["key"] for r in rows.groupBy("key").count().filter("count > 1").limit(3).collect()]
    if twice:
        raise ValueError(f"owned twice: {twice}")
    packed = in_packs(rows, limit - 1)
    # A page holds what fits the limit.
    body = F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("key", "entry"))), lambda x: x["entry"]), ","), F.lit("}"))
    pages = packed.groupBy("pack", "depth").agg(F.min("key").alias("first"), F.max("key").alias("last"), F.count("*").alias("count"), body.alias("body"))
    pages = pages.select(F.sha2("body", 256).alias("name"), "first", "last", "count", F.octet_length("body").cast("long").alias("bytes"), "body")
    root = rows.agg(
        F.count("*").alias("files"), F.count_if("record.allocated").alias("allocated"), F.count_if("record.retained").alias("retained"), _summary(rows).alias("digest")
    )
    return cut(pages), root


def decode(pages: DataFrame, root: DataFrame) -> DataFrame:
    """The files of a receipt; pages that were changed, overlap or are missing fail the job."""
    records = F.from_json("body", f"map<string,{RECORD}>")
    told = cut(pages.withColumn("records", records))
    keys = F.map_keys("records")
    sound = (
        (F.sha2("body", 256) == F.col("name")) & (F.octet_length("body") == F.col("bytes")) & (F.size("records") == F.col("count"))
        & (F.array_min(keys) == F.col("first")) & (F.array_max(keys) == F.col("last"))
    )
    wrong = [r["name"] for r in told.filter(~F.coalesce(sound, F.lit(False))).limit(3).collect()]
    if wrong:
        raise ValueError(f"changed pages: {wrong}")
    rows = told.select(F.explode("records").alias("key", "record")).withColumn("entry", _entry(F.col("key"), F.col("record")))
    rows = cut(rows)
    seen = rows.agg(
        F.count("*").alias("files"), F.count_if("record.allocated").alias("allocated"), F.count_if("record.retained").alias("retained"), _summary(rows).alias("digest"), F.count_distinct("key").alias("keys")
    ).first()
    if seen["keys"] != seen["files"] or tuple(seen)[:4] != tuple(root.select("files", "allocated", "retained", "digest").first()):
        raise ValueError("the pages are not those of the root")
    is_set = lambda c: F.coalesce(f"record.{c}", F.lit(False)).alias(c)
    return rows.select(F.col("key").alias("path"), "record.sha256", "record.bytes", is_set("allocated"), is_set("retained"))
