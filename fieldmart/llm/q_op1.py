import public_tokenizers

from fieldmart.llm.bpe import round_trip
from fieldmart.llm.common import table

VOCABULARY = "word_bpe_49k.json"


def op1_bpe(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


QUERIES = [("op1_bpe", op1_bpe, None)]
