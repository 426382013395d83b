"""Registration of named queries: a Spark plan and, where SQL can say it, the oracle's SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestack.session import table

TABLES = frozenset("region nation customer supplier part orders lineitem events documents pages conversations".split())
Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """The tables of one directory, read when named."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        """Spark SQL over tables and frames named in braces."""
        named = {n for n in re.findall(r"\{(\w+)\}", text) if n in TABLES and n not in frames}
        return self.spark.sql(text, **frames, **{n: getattr(self, n) for n in named})


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, oracle: str | None = None, name: str | None = None) -> Callable:
        """Register a function of Tables."""

        def add(plan: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
            key = name or plan.__name__
            self.queries[key] = lambda spark, sf_dir: plan(Tables(spark, sf_dir))
            if oracle:
                self.oracles[key] = oracle
            return plan

        return add

    def sql(self, name: str, text: str, oracle: str | None = None) -> None:
        """Register Spark SQL; without an oracle of its own the text is plain enough for both engines."""
        self.queries[name] = lambda spark, sf_dir: Tables(spark, sf_dir).sql(text)
        self.oracles[name] = oracle or re.sub(r"\{(\w+)\}", r"\1", text)
