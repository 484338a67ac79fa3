from pyspark.sql import functions as F

from fieldmart.llm.common import table
from fieldmart.llm.semicrf import personal_data


def op7_personal_data(spark, sf_dir):
    found = personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


QUERIES = [("op7_personal_data", op7_personal_data, None)]
