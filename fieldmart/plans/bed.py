"""Collects queries with their DuckDB twins."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Bed:
    def __init__(self) -> None:
        self.entries: list = []

    def query(self, sql: str | None) -> Callable:
        def keep(fn: Callable) -> Callable:
            self.entries.append((fn.__name__, fn, sql))
            return fn

        return keep


class Tables:
    """The driver's tables by name; timestamps come as TIMESTAMP_NTZ, since no value has a zone."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder under spark.checkpoint.dir; where that is unset a local session takes a temporary one, a cluster has to name it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir is unset: it has to name a folder that all machines share")
        root = tempfile.mkdtemp(prefix="fieldmart-")
    return f"{root}/{what}-{uuid.uuid4().hex}"
