import public_tokenizers

from fieldmart.llm.alignment import alignment
from fieldmart.llm.common import table


def op12_alignment(spark, sf_dir):
    return alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = [("op12_alignment", op12_alignment, None)]
