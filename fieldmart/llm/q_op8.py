import public_tokenizers

from fieldmart.llm.common import shared_folder, table
from fieldmart.llm.orcids import layout, write_ids


def op8_orc_ids(spark, sf_dir):
    path = shared_folder(spark, "ids")
    write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return layout(spark, path)


QUERIES = [("op8_orc_ids", op8_orc_ids, None)]
