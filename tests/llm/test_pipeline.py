"""The pipeline against a brute-force version of its stages."""

import corpus_pipeline
from fieldmart.llm import gru, semicrf
from tests.conftest import DATA
from tests.llm.test_operators import VOCABULARY, _base, _classes


def test_pipeline(spark):
    import hashlib

    from tokenizers import Tokenizer

    from fieldmart.llm.wumanber import words_of

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    items = [words_of(r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 10]) for w in items for i in range(len(w) - 9)}
    known = {r.doc_id for r in gru.languages_of(docs).where("lang_pred <> 'und'").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in known}
    texts = {d: texts[d] for d, (_, root) in _classes(list(texts.items()), 5, 80).items() if d == root}
    clean = {}
    for d, text in texts.items():
        words = words_of(text)
        if not any(tuple(words[i : i + 10]) in windows for i in range(len(words) - 9)):
            clean[d] = text
    assert 0 < len(clean) < len(texts)
    library = Tokenizer.from_file(VOCABULARY)
    model = semicrf.SemiCrf()
    model.weights = semicrf.trained()
    want = {}
    for d, text in clean.items():
        _, spans = semicrf.all_spans(text, model)
        if not _base(text):
            assert spans == []
        at, out = 0, ""
        for kind, start, end in spans:
            if end > at:
                out, at = out + (text[at:start] + f"[{kind.upper()}]" if start >= at else ""), end
        ids = library.encode(out + text[at:], add_special_tokens=False).ids
        want[d] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, DATA).collect()}
    assert got == want


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(30)
    for empty in (docs, docs.limit(0)):
        df = empty
        for _, stage in corpus_pipeline.STAGES[:-1]:
            df = stage(spark, df, DATA)
            assert df.columns == docs.columns
