"""Inverted index for "every word stands somewhere in the text": postings of three-letter grams, stored in order.

A generation is three ordered stores: the rows by id, the grams with their numbers
of rows, and the postings (gram, id) by gram. A search reads the numbers of its
words' grams, takes the rarest gram of each word, reads these postings alone, and
verifies the words in the rows of the ids that all of them have. Changed rows are a
generation of their own; of the generations that hold an id the newest counts, so
nothing that did not change is written again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.session import cut
from lodestack.sources import ordered

GRAM = 3


def grams_of(text: Column) -> Column:
    """Different grams of a text; shorter texts have none."""
    places = F.when(F.length(text) >= GRAM, F.sequence(F.lit(1), F.length(text) - GRAM + 1))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(GRAM))))


def build(rows: DataFrame, folder: str, files: int) -> None:
    """A generation of rows(id, hay, ...); a row with a null hay only hides what older generations have of its id."""
    ordered.write(rows, "id", f"{folder}/rows", files)
    stored = rows.sparkSession.read.parquet(f"{folder}/rows/rows")
    postings = stored.select(F.explode(grams_of(F.col("hay"))).alias("gram"), "id")
    ordered.write(postings, "gram", f"{folder}/postings", files)
    counts = rows.sparkSession.read.parquet(f"{folder}/postings/rows").groupBy("gram").agg(F.count("*").alias("n"))
    ordered.write(counts, "gram", f"{folder}/grams", max(1, files // 16))


def rarest(spark: SparkSession, folder: str, words: list[str]) -> list[str] | None:
    """The rarest gram of each word that has any; None if a word's gram is in no row."""
    wanted = {w: {w[k : k + GRAM] for k in range(len(w) - GRAM + 1)} for w in words if len(w) >= GRAM}
    grams = sorted(set().union(*wanted.values()))
    known = {r["gram"]: r["n"] for r in ordered.by_keys(spark, f"{folder}/grams", "gram", grams).collect()}  # the query's grams
    if any(g not in known for g in grams):
        return None
    return sorted({min(of, key=lambda g: (known[g], g)) for of in wanted.values()})


def _found(spark: SparkSession, folder: str, words: list[str]) -> DataFrame:
    """Rows of one generation that hold every word."""
    whole = spark.read.parquet(f"{folder}/rows/rows")
    holds = reduce(Column.__and__, [F.contains("hay", F.lit(w)) for w in words], F.col("hay").isNotNull())
    if not any(len(w) >= GRAM for w in words):
        return whole.filter(holds)  # words this short are in most rows; they have no postings
    grams = rarest(spark, folder, words)
    if grams is None:
        return whole.filter("false")
    postings = ordered.by_keys(spark, f"{folder}/postings", "gram", grams)
    ids = cut(postings.groupBy("id").agg(F.count("*").alias("n")).filter(F.col("n") == len(grams)).select("id"))
    few = [r["id"] for r in ids.limit(ordered.MOST_KEYS + 1).collect()]
    if len(few) <= ordered.MOST_KEYS:
        return ordered.by_keys(spark, f"{folder}/rows", "id", few).filter(holds)
    return whole.join(ids, "id", "left_semi").filter(holds)


def search(spark: SparkSession, generations: list[str], words: list[str]) -> DataFrame:
    """Rows that hold every word; generations from the oldest to the newest."""
    words = [w for w in dict.fromkeys(words) if w]
    found = None
    for folder in generations:
        here = _found(spark, folder, words)
        if found is not None:
            found = found.join(spark.read.parquet(f"{folder}/rows/rows").select("id"), "id", "left_anti")
        found = here if found is None else found.unionByName(here)
    return found
