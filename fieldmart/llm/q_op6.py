from fieldmart.llm.common import table
from fieldmart.llm.prefixhash import fingerprints


def op6_prefix_hash(spark, sf_dir):
    return fingerprints(table(spark, sf_dir, "documents"))


QUERIES = [("op6_prefix_hash", op6_prefix_hash, None)]
