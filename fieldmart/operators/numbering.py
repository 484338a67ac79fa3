"""Numbers in an order, without all rows in one task."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_ROW_BITS = 33  # of monotonically_increasing_id


def ready_checkpoints(spark: SparkSession) -> None:
    """Checkpoints go to spark.checkpoint.dir. Where that is unset, a session whose executors are the driver takes a temporary folder; any other has to name one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if root := spark.conf.get("spark.checkpoint.dir", None):
            context.setCheckpointDir(root)
        elif context.master == "local" or context.master.startswith("local["):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="fieldmart-"))
        else:
            raise ValueError("spark.checkpoint.dir is unset: it has to name a folder that all machines share")


def numbered(df: DataFrame, order: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """df with dense numbers in order, from start on.

    Ranges of the order are sorted side by side, each in a task, and only their counts are summed up. The ranges are drawn
    from a sample, so the rows are checkpointed: numbers and counts come from the same ranges. Rows that are equal in all
    of `order` are in one range; give a column that tells them apart where they may be many.
    """
    ready_checkpoints(df.sparkSession)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_id", _ROW_BITS)
    counts = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_c"))
    before = counts.select("_part", F.coalesce(F.sum("_c").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))  # one row for each range
    place = F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + F.lit(start)
    return ranged.join(before, part == F.col("_part")).select(*df.columns, place.alias(name))
