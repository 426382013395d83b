"""File sources: inventories, content hashes and nested key-value text."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def inventory(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(path, bytes, modified) of matching files; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(root)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("path"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def hashes(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(path, bytes, sha256) of matching files."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(root)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object per line; a malformed line fails the job with its file."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path).withColumn("source_file", F.col("_metadata.file_path"))


def verified(spark: SparkSession, root: str, pattern: str, manifest: DataFrame) -> DataFrame:
    """manifest(path, bytes, sha256) against the files: (path, state) with state same, changed or missing."""
    there = hashes(spark, root, pattern).select("path", F.col("bytes").alias("b"), F.col("sha256").alias("h"))
    same = (F.col("b") == F.col("bytes")) & (F.col("h") == F.col("sha256"))
    return manifest.join(there, "path", "left").select("path", F.when(F.col("h").isNull(), "missing").when(same, "same").otherwise("changed").alias("state"))


def write_json_lines(df: DataFrame, path: str) -> None:
    """One canonical JSON object per line: keys sorted, nulls kept, no white space."""
    columns = [F.col(c) for c in sorted(df.columns)]
    df.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value")).write.text(path)


def json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Whole-file JSON documents, one row each or one per element of a list."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


MOST_DEPTH = 32


def key_values(text: str) -> list[tuple[str, str]]:
    """(pointer, value) of quoted keys with quoted values or braces around more of them; repeated keys are an error."""
    out: list[tuple[str, str]] = []
    path: list[str] = []
    seen: list[set[str]] = [set()]
    key, at = None, 0
    while at < len(text):
        c = text[at]
        if c.isspace():
            at += 1
        elif c == '"':
            end = text.index('"', at + 1)
            word, at = text[at + 1 : end], end + 1
            if key is None:
                if word in seen[-1]:
                    raise ValueError(f"repeated key {word!r}")
                seen[-1].add(word)
                key = word
            else:
                out.append(("/" + "/".join([*path, key]), word))
                key = None
        elif c == "{" and key is not None and len(path) < MOST_DEPTH:
            path.append(key)
            seen.append(set())
            key, at = None, at + 1
        elif c == "}" and key is None and path:
            path.pop()
            seen.pop()
            at += 1
        else:
            raise ValueError(f"unexpected {c!r} at {at}")
    if path or key is not None:
        raise ValueError("text ends inside a value")
    return out


def parse_key_values(rows: DataFrame) -> DataFrame:
    """rows(id, text) -> (id, pointer, value, error)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made: list[tuple] = []
            for key, text in zip(batch["id"], batch["text"]):
                try:
                    made += [(key, p, v, None) for p, v in key_values(text or "")]
                except ValueError as e:
                    made.append((key, None, None, str(e)))
            yield pd.DataFrame(made, columns=["id", "pointer", "value", "error"])

    return rows.select(F.col("id").cast("long"), "text").mapInPandas(run, "id long, pointer string, value string, error string")
