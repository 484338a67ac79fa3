from pyspark.sql import functions as F

from fieldmart.llm.common import table
from fieldmart.llm.suffixdedup import without_repeats


def op11_suffix_array(spark, sf_dir):
    found = without_repeats(table(spark, sf_dir, "documents"), length=200)
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + (r["end"] - r["start"]))
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = [("op11_suffix_array", op11_suffix_array, None)]
