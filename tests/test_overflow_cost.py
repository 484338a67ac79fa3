"""The overflow text is taken apart once a row, whatever the number of its keys."""

import pytest
from pyspark.sql import functions as F

from fieldmart.sources import kv


@pytest.mark.parametrize("text, want", [(None, {}), ("", {}), ("=1|b", {}), ("a=1 | b = x=y |a=2", {"a": "2", "b": "x=y"}), ("k=|k= | j=1", {"k": "", "j": "1"})])
def test_last_of_equal_keys_counts(spark, text, want):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(kv.parse_kv(F.col("v")).alias("m")).first().m == want


def test_text_is_split_once(spark):
    """In what Spark evaluates the pattern of the bars stands once: it stood three times, one of them evaluated again for each key."""
    df = spark.createDataFrame([("a=1",)], "v string").select(kv.parse_kv(F.col("v")).alias("m"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
