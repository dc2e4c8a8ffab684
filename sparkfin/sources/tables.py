"""Driver tables: one parquet file per table under an sf folder."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

DEFAULT_SF = "/root/testdata/sf0.001"


def table_path(sf_dir: str, name: str) -> str:
    p = os.path.join(sf_dir, f"{name}.parquet")
    return p if os.path.exists(p) or "://" in sf_dir else os.path.join(sf_dir, name)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    if name not in TABLES:
        raise KeyError(name)
    return spark.read.parquet(table_path(sf_dir, name))
