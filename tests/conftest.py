import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.environment["PYTHONPATH"] = ROOT
    yield session


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{DATA}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con
