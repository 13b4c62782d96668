"""Parquet table access by name."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


class ParquetTables:
    """Lazy reader: ``tables["orders"]`` -> DataFrame over ``<dir>/orders.parquet``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self._cache: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return os.path.join(self.root, f"{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(self.path(name))
        return self._cache[name]
