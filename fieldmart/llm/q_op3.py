from fieldmart.llm.common import table
from fieldmart.llm.gru import languages_of


def op3_language(spark, sf_dir):
    return languages_of(table(spark, sf_dir, "documents"))


QUERIES = [("op3_language", op3_language, None)]
