"""Loading the given parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; column pruning and filter pushdown are left to Catalyst."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
