"""Helpers that the text operators share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")
_own_root: dict[str, str] = {}
_made: list[str] = []
_cache: dict[object, object] = {}


def _give_back() -> None:
    """Freed memory goes back to the machine, where the C library can do that."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def worker_cache(owner: object, make: Callable[[], T]) -> T:
    """What one operator keeps in a Python worker between tasks. A worker serves many stages: the next owner's takes its place."""
    if owner not in _cache:
        if _cache:
            _cache.clear()
            _give_back()
        _cache[owner] = make()
    return _cache[owner]  # type: ignore[return-value]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share. Where that is unset a local session takes a temporary one (tests); a cluster has to name it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir is unset: it has to name a folder that all machines share")
        app = spark.sparkContext.applicationId
        root = _own_root.get(app) or _own_root.setdefault(app, tempfile.mkdtemp(prefix="fieldmart-"))
    _made.append(f"{root}/{what}-{uuid.uuid4().hex}")
    return _made[-1]


def made_since(number: int = 0) -> list[str]:
    """Shared folders that this process has named, from a number on; files that executors fetch are left out."""
    return [path for path in _made if not path.rpartition("/")[2].startswith("file-")][number:]


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Removes shared folders that nothing reads any more."""
    for path in paths:
        system, target = _file_system(spark, path)
        system.delete(target, True)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def to_shared_folder(spark: SparkSession, file: str) -> str:
    """Moves a file of the driver into the shared folder."""
    path = f"{shared_folder(spark, 'file')}/{file.rpartition('/')[2]}"
    system, target = _file_system(spark, path)
    system.copyFromLocalFile(True, True, spark._jvm.org.apache.hadoop.fs.Path(f"file://{file}"), target)
    return path


def kept(df: DataFrame, what: str) -> DataFrame:
    """df written to the shared folder and read again: cuts lineage and survives the loss of executors."""
    path = shared_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one operator, removed when what it returns no longer reads them."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame, what: str) -> DataFrame:
        path = shared_folder(self.spark, what)
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        remove(self.spark, self.paths)
        self.paths = []


def parts_of(docs: DataFrame, bytes_each: int) -> int:
    """Parts to deal docs to: as many as its size asks for, spark.sql.shuffle.partitions at least."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(size // bytes_each if size < 1 << 60 else 0, 1_000_000))  # Spark does not know the size of every plan


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns; others, whatever their names, can't clash with what an operator adds."""
    return df.select(*columns)
