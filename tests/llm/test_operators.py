"""Each operator against a brute-force version, an exact round trip, or held-out accuracy; edge cases of every one."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fieldmart.llm import bpe, gru, minhash, orcids, prefixhash, quotes, secrets, semicrf, transducer, treemodel, wumanber
from fieldmart.llm.components import components
from tests.conftest import DATA
from tests.helpers import same

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = ["Hello  World's 123 éà́ <|endoftext|> ok<|startoftext|>x Σας İ \x1c a 日本語 €…", "", " ", "it's we'll x'RE ŒUVRE \x85 n", "a" * 700, "a\x1fb", "²½ ª Ⅷ", "<|", "1.2.3.4.5", "🙂"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns with clashing names."""
    rows = [(i, t, "en" if i % 2 else None, None, None) for i, t in enumerate(ODD)] + [(100, None, None, None, None), (None, "word " * 30_000, "fr", "s", 1), (None, None, None, None, None), (5, "a\x1fb", "en", None, None), (5, "a\x1fb", "en", None, None)]
    return spark.createDataFrame(rows, DOCS).withColumns({"node": F.lit(1), "ids": F.lit("x"), "label": F.lit(2), "bucket": F.lit(3), "blob": F.lit("b")})


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]


@pytest.mark.parametrize("name", ["op4_secrets", "op5_quotation_linking", "op9_decontamination", "op10_minhash"])
def test_oracles(spark, duck, name):
    from fieldmart.llm.registry import registered

    query, sql = next((q, s) for n, q, s in registered() if n == name)
    same(query(spark, DATA), duck, sql)


# --- 1 -----------------------------------------------------------------------------------------------------------


def test_transducer_is_exact_and_minimal(tmp_path):
    r = random.Random(4)
    words = {"".join(r.choice("abc") for _ in range(r.randint(1, 7))).encode(): [i, i + 1][: 1 + i % 2] for i in range(400)}
    built = transducer.Transducer.build(words)
    built.save(f"{tmp_path}/t")
    mapped = transducer.Transducer.map(f"{tmp_path}/t")
    numbers = mapped.numbers(list(words))
    assert [mapped.get(n) for n in numbers] == list(words.values()) and len(set(numbers.tolist())) == len(words)
    absent = [w for w in (b"", b"zz", b"abcabcabcabc", b"c" * 9) if w not in words]
    assert (mapped.numbers(absent) == -1).all()
    rights = {}  # states with the same right language would be one
    for w in words:
        for i in range(len(w) + 1):
            rights.setdefault(w[:i], frozenset(x[i:] for x in words if x.startswith(w[:i])))
    assert len(mapped.final) == len(set(rights.values()))


def test_bpe_equals_library(spark, docs, odd, empty):
    library = Tokenizer.from_file(VOCABULARY)
    for df in (docs, odd):
        got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(df, VOCABULARY, most=500).collect()}
        want = set()
        for r in df.collect():
            ids = library.encode(r.text or "", add_special_tokens=False).ids
            want.add((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
        assert got == want
    assert bpe.round_trip(empty, VOCABULARY).count() == 0
    some = bpe.decode(bpe.encode(docs.limit(5).select("doc_id", "text"), VOCABULARY, 100), VOCABULARY).first()
    assert some.decoded == library.decode(some.ids, skip_special_tokens=False)


def test_long_words_merge_alike():
    merges, r = bpe.Merges(VOCABULARY), random.Random(1)
    words = ["".join(r.choice("thonera'9é") for _ in range(r.randint(1, 80))).encode() for _ in range(60)]
    assert merges.merge(words) == [merges.merge_long(w) for w in words]


# --- 2 -----------------------------------------------------------------------------------------------------------


def test_tree_marginals_are_exact():
    """Sum-product marginals equal sums over all labellings."""
    from itertools import product
    from math import exp

    model = treemodel.TreeModel()
    model.unary.update({"tag p": 0.7, "tag nav": -1.3, "bias": 0.2, "tag #text": -0.4})
    model.pair.update({(0, 0, False): 0.5, (1, 1, False): 0.9, (1, 1, True): 1.1, (0, 1, True): -0.6})
    dom = treemodel.parse("<div><nav>a</nav><p>b<i>c</i></p></div>")
    names = treemodel.features(dom)
    got, _ = model.marginals(dom, names)
    n, total, sums = len(dom.tag), 0.0, [0.0] * len(dom.tag)
    for labels in product((0, 1), repeat=n):
        score = sum(model.unary.get(x, 0) for i in range(n) if labels[i] for x in names[i]) + sum(model.pair.get((labels[dom.parent[i]], labels[i], dom.tag[i] == "#text"), 0) for i in range(1, n))
        total += exp(score)
        for i in range(n):
            sums[i] += exp(score) * labels[i]
    assert np.allclose(got, [s / total for s in sums])


def test_extraction(spark):
    model = treemodel.TreeModel()
    model.unary, model.pair = treemodel.trained()
    wrong = n = 0
    for dom, labels in treemodel.labelled_pages(60, seed=99):
        p, _ = model.marginals(dom, treemodel.features(dom))
        for i, tag in enumerate(dom.tag):
            if tag == "#text" and dom.tag[dom.parent[i]] not in treemodel.NEVER:
                wrong, n = wrong + ((p[i] >= 0.5) != labels[i]), n + 1
    assert wrong <= 0.01 * n
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    got = {r.page_id: r for r in treemodel.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        blocks = (re.sub(r"\s+", " ", treemodel.entities.unescape(re.sub("<[^>]*>", " ", b))).strip() for b in re.split(r"</?(?:p|h1)>", article))
        assert got[r.page_id].text == "\n".join(b for b in blocks if b) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_extraction_edges(spark):
    rows = [(1, None, None), (2, "u", ""), (None, "u", "<p>a &amp; b<p>c<br>d"), (4, "u", "no markup"), (5, "u", "<" * 500), (6, "u", "<div>" * 3000 + "<p>deep enough text in here"), (7, "u", "<!-- open <p>x"), (7, "u", "<script>var x='</p>'")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    out = treemodel.extract(df).collect()
    assert len(out) == len(rows) and all(r.text is not None and r.n_chars == len(r.text) for r in out)
    assert [r.text for r in out if r.page_id in (1, 2)] == ["", ""]
    assert treemodel.extract(df.limit(0)).count() == 0


# --- 3 -----------------------------------------------------------------------------------------------------------


def test_gradient():
    net = gru.Gru(3, 4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    pieces, labels = [b"abc", b"hello", b"x"], np.array([0, 2, 1])
    table, mask = gru.padded(pieces)

    def loss():
        logp, _ = net.positions(table, mask)
        return -(logp[:, np.arange(3), labels] * mask).sum() / mask.sum()

    for k, g in net.gradient(table, mask, labels).items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept = net.p[k][at]
        net.p[k][at] = kept + 1e-3
        up = loss()
        net.p[k][at] = kept - 1e-3
        down = loss()
        net.p[k][at] = kept
        assert abs((up - down) / 2e-3 - g[at]) < 1e-3 + 0.05 * abs(g[at])


def test_every_byte_is_labelled_once():
    """Sums over windows are those of the network run over windows one by one; texts of any length, many or one at a time."""
    net, r = gru.Gru(3, 4), np.random.default_rng(1)
    texts = [bytes(r.integers(0, 256, n).astype(np.uint8)) for n in (1, 5, 95, 96, 97, 500, 2, 1300)]
    want = []
    for text in texts:
        total = np.zeros(3)
        for at in range(0, len(text), gru.SPAN):
            low, high = max(0, at - gru.CONTEXT), min(len(text), at + gru.SPAN + gru.CONTEXT)
            logp, _ = net.positions(*gru.padded([text[low:high]]))
            total += logp[at - low : min(at + gru.SPAN, len(text)) - low, 0].sum(axis=0)
        want.append(total)
    assert np.allclose(list(net.documents(texts)), want, atol=1e-2, rtol=1e-4)
    assert np.allclose([next(iter(net.documents([t]))) for t in texts], want, atol=1e-2, rtol=1e-4)


def test_language(spark, odd, empty):
    import unicodedata

    letter = lambda t: any(unicodedata.category(c).startswith("L") for c in t or "")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "lang").join(gru.languages_of(docs, sample=500), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    marks = spark.createDataFrame([(i, t, "en", None, None) for i, t in enumerate(["½ ² ", "١٢", "ª", "ʰ", "中", "_ 1", "Ⅷ", "\u0301"])], DOCS)
    known = odd.select("doc_id", "text", "lang", "source", "n_chars").union(marks)
    out = gru.languages_of(known).collect()
    assert len(out) == known.count()
    assert all((r.lang_pred == "und") == (not letter(t)) for r, t in zip(out, [x.text for x in known.collect()], strict=True))
    assert gru.languages_of(empty).count() == 0
    kept = gru.with_language(odd).collect()
    assert len(kept) == sum(map(letter, [x.text for x in odd.collect()]))
    assert all(r.lang in ("en", "fr") for r in kept) and gru.with_language(odd).columns == odd.columns


# --- 4 -----------------------------------------------------------------------------------------------------------


def _secret_spans(text):
    found = []
    for place, rule in enumerate(secrets.RULES):
        found += [(m.start(), place, rule.kind, m.end()) for m in re.finditer(rule.pattern, text, re.ASCII) if len(m[rule.group]) >= rule.least]
    return sorted(found)


def test_secrets(spark, docs, odd, empty, tmp_path):
    r = random.Random(3)
    made = ["".join(r.choice(["token", "=", ":", " ", '"', "abcd1234", "API_KEY", "AKIA", "ABCDEFGH1234", "é", "0123456789abcdef", "\n"]) for _ in range(r.randint(0, 14))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    secrets.scan(df, f"{tmp_path}/a")
    got = {x.doc_id: [tuple(f) for f in x.findings] for x in secrets.findings(df, f"{tmp_path}/a").collect()}
    assert got == {i: [(s, p, k, e) for s, p, k, e in _secret_spans(t)] for i, t in enumerate(made)}
    secrets.scan(odd, f"{tmp_path}/b")
    assert secrets.findings(odd, f"{tmp_path}/b").count() == odd.count()
    secrets.scan(empty, f"{tmp_path}/c")
    assert secrets.findings(empty, f"{tmp_path}/c").count() == 0


def test_ledger_is_incremental(spark, tmp_path):
    ledger, rows = f"{tmp_path}/ledger", [(1, "password=abcdefgh1"), (2, "password=abcdefgh1"), (3, None), (4, "clean")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert secrets.scan(df, ledger).count() == 3  # distinct blobs
    assert secrets.scan(df, ledger).count() == 3  # nothing new
    more = df.union(spark.createDataFrame([(5, "token: 12345678")], df.schema))
    assert secrets.scan(more, ledger).count() == 4
    newer = (*secrets.RULES, secrets.Rule("word", 1, "clean", 0, 1))
    assert secrets.scan(more, ledger, newer).count() == 8  # the new rule alone
    assert spark.read.parquet(ledger).where("array_contains(rules, 'word@1')").select(F.max(F.size("rules"))).first()[0] == 1
    assert {(r.doc_id, r.n) for r in secrets.findings(more, ledger, newer).select("doc_id", F.size("findings").alias("n")).collect()} == {(1, 1), (2, 1), (3, 0), (4, 1), (5, 1)}


# --- 5 -----------------------------------------------------------------------------------------------------------


def test_quotes(spark):
    rows = [(1, 0, "user", "Hello There\nHow are you?"), (1, 1, "assistant", "> how  are you?\nFine."), (1, 2, "user", "> > hello there\n> > how are you?\n> fine.\nGood"), (1, 3, "a", ">> hello there\nx"), (2, 0, "user", None), (None, 1, "u", "> x"), (1, 4, None, "> fine.\n"), (1, 4, None, "> fine.\n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("key", F.lit("clash"))
    got = [(r.conv_id, r.turn, r.reply_to, r.body) for r in quotes.chat(df).collect()]
    assert got == [(None, 1, None, ""), (1, 0, None, "Hello There\nHow are you?"), (1, 1, 0, "Fine."), (1, 3, 0, "x"), (1, 2, 1, "Good"), (1, 4, 1, ""), (1, 4, 1, ""), (2, 0, None, "")]
    assert quotes.chat(df.limit(0)).count() == 0


# --- 6 -----------------------------------------------------------------------------------------------------------


def test_prefix_hashes():
    r = random.Random(1)
    for _ in range(80):
        a, b = ("".join(r.choice("ab€") for _ in range(r.randint(0, 60))) for _ in range(2))
        one, two = prefixhash.PrefixHashes(a), prefixhash.PrefixHashes(b)
        for _ in range(6):
            i, j = r.randint(0, len(a)), r.randint(0, len(b))
            size = r.randint(0, min(len(a) - i, len(b) - j))
            assert (one.span(i, i + size) == two.span(j, j + size)) == (a[i : i + size] == b[j : j + size])
            same_ = next((k for k in range(min(len(a) - i, len(b) - j)) if a[i + k] != b[j + k]), min(len(a) - i, len(b) - j))
            assert one.extension(i, two, j) == same_


def _print(text):
    """A fingerprint by evaluating each span's polynomial on its own."""

    def value(span, base):
        h = 0
        for c in span:
            h = (h * base + ord(c) + 1) % prefixhash.PRIME
        return h

    size = min(prefixhash.SPAN, len(text))
    spans = {text[i : i + size] for i in range(len(text) - size + 1)} if text else set()
    mixed = sorted({(value(s, prefixhash.BASES[0]) * 0x9E3779B97F4A7C15 % 2**64) >> 32 for s in spans})[: prefixhash.SKETCH]
    return f"{len(text):x}." + "".join(f"{value(text, b):08x}" for b in prefixhash.BASES) + "." + "".join(f"{x:08x}" for x in mixed)


def test_fingerprints(spark, docs, texts, odd, empty):
    got = {r.doc_id: r for r in prefixhash.fingerprints(docs, buckets=7).collect()}
    assert len(got) == len(texts)
    for k, (doc, text) in enumerate(texts):
        other = texts[(k + 1) % len(texts)][1]
        changed = prefixhash.edited(text, other)
        r, own, new = got[doc], prefixhash.fingerprint(text), prefixhash.fingerprint(changed)
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(text), hashlib.sha256(changed.encode()).hexdigest(), own, new)
        assert (own, new) == (_print(text), _print(changed)) or len(text) > 3000
        assert (r.prefix_edited, r.prefix_next) == tuple(len(os.path.commonprefix([text, x])) for x in (changed, other)) and r.prefix_edited >= len(text) - len(text) // 2
        assert r.near_edited == prefixhash.likeness(own, new) and r.near_next == prefixhash.likeness(own, prefixhash.fingerprint(other))
    assert np.median([r.near_edited for r in got.values()]) > 0.4 > 0.2 > np.median([r.near_next for r in got.values()])
    assert prefixhash.fingerprints(odd).count() == odd.count() and prefixhash.fingerprints(empty).count() == 0
    sole = prefixhash.fingerprints(docs.limit(1)).first()
    assert sole.near_next == 1.0


# --- 7 -----------------------------------------------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _base(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = "".join(c for c in m[0] if c in "0123456789")
            if kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) or kind == "card" and 12 <= len(digits) <= 19 and semicrf.luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15:
                found.append((kind, m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], semicrf.KINDS.index(s[0])))


def test_base_spans(texts):
    r = random.Random(1)
    for text in ["".join(r.choice("0123459999..@@ab +-() 1") for _ in range(r.randint(0, 60))) for _ in range(5000)] + [t for _, t in texts]:
        assert semicrf.base_spans(text) == _base(text)
    assert semicrf.base_spans("a" * 200_000 + "@" + "9" * 100_000) == []


def test_segments_are_found():
    model = semicrf.SemiCrf()
    model.weights = semicrf.trained()
    hit = extra = missed = 0
    for text, spans in semicrf.labelled_sentences(100, seed=99):
        found, true = set(model.spans(text)), set(spans)
        hit, extra, missed = hit + len(found & true), extra + len(found - true), missed + len(true - found)
    assert hit >= 0.97 * (hit + missed) and extra <= 0.03 * hit
    text = "thon 12 ere"
    tokens, segments = model.posteriors(text, 0, len(text))
    assert all(0 <= s[-1] <= 1 for s in segments)


def test_best_segmentation():
    """The most probable segmentation equals the best of all, tried one by one; its score is the greatest."""
    from itertools import product

    model, r = semicrf.SemiCrf(), random.Random(5)
    model.weights.update({("step", a + b): r.uniform(-1, 1) for a in "OE" for b in "OE"})
    for text in ("12 3", "a 1.2 b", "9-8 7", "x@y 4"):
        lattice = model._scored(text, 0, len(text))
        for _, _, kind, keys in lattice[1]:
            for key in keys:
                model.weights.setdefault(key, r.uniform(-1, 1))
        lattice = model._scored(text, 0, len(text))
        tokens, segments, by_end, _, step = lattice
        score = {k: s for ways in by_end.values() for _, s, k in ways}
        best, chosen = -1e9, None
        for take in product((0, 1), repeat=len(segments)) if len(segments) <= 15 else []:
            own = sorted([k for k, t in enumerate(take) if t], key=lambda k: segments[k][0])
            if any(segments[a][1] > segments[b][0] for a, b in zip(own, own[1:], strict=False)):
                continue
            at, last, total = 0, "O", 0.0
            for k in own:
                while at < segments[k][0]:
                    total, last, at = total + step[last, "O"], "O", at + 1
                total, last, at = total + step[last, "E"] + score[k], "E", segments[k][1]
            while at < len(tokens):
                total, last, at = total + step[last, "O"], "O", at + 1
            if total > best:
                best, chosen = total, own
        if chosen is not None:
            assert model._best(*lattice) == chosen


def test_segments_of_another_text():
    """Sentences built otherwise than those of the training: other words, cues, countries and number shapes."""
    model, r = semicrf.SemiCrf(), random.Random(7)
    model.weights = semicrf.trained()
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    right = extra = n = 0
    for _ in range(150):
        phone = r.choice((f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}"))
        text = r.choice(("Please ring {} before noon.", "Office: {} (weekdays)", "You can reach us at {}, thanks")).format(phone)
        at = text.index(phone)
        found = model.spans(text)
        right, n = right + any(s == at and e == at + len(phone) for _, s, e in found), n + 1
        clean = r.choice((f"In {r.randint(1900, 2030)} some {d(2)} of {d(3)} items", f"Version {r.randint(1, 9)}.{d(1)}.{d(1)} came out on {d(2)}/{d(2)}", f"a ratio of {d(1)}.{d(2)} to {d(1)}, {d(2)} % in all", f"pages {d(2)}-{d(2)}, room {d(3)}"))
        extra += bool(model.spans(clean))
    assert right >= 0.9 * n and extra <= 0.03 * n


def test_dense_digits_take_linear_time():
    import time

    model = semicrf.SemiCrf()
    model.weights = semicrf.trained()
    began = time.time()
    base, every = semicrf.all_spans("1 23-45 6.7 " * 3_000, model)
    assert time.time() - began < 60 and len(every) >= len(base)


def test_personal_data(spark, docs, odd, empty):
    rows = {r.doc_id: r for r in semicrf.personal_data(docs).collect()}
    for r in docs.collect():
        base = _base(r.text)
        assert rows[r.doc_id].base == ",".join(f"{k}:{s}:{e}" for k, s, e in base) and rows[r.doc_id].n_email == sum(k == "email" for k, _, _ in base)
        assert set(filter(None, rows[r.doc_id].base.split(","))) <= set(rows[r.doc_id].spans.split(","))
    assert semicrf.personal_data(odd).count() == odd.count() and semicrf.personal_data(empty).count() == 0
    out = semicrf.redacted(docs)
    assert out.columns == docs.columns and not [r for r in out.collect() if _base(r.text or "")]
    clean = spark.createDataFrame([(1, "a b.c 12", None, None, 8)], DOCS)
    assert semicrf.redacted(clean).first().text == "a b.c 12"


# --- 8 -----------------------------------------------------------------------------------------------------------


def test_orc_ids(spark, docs, texts, odd, empty, tmp_path):
    library = Tokenizer.from_file(VOCABULARY)
    orcids.write_ids(docs, VOCABULARY, f"{tmp_path}/a")
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in orcids.layout(spark, f"{tmp_path}/a").collect()}
    at = 0
    for doc, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, orcids.END_ID]
        assert got[doc] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    some = orcids.read_ids(spark, f"{tmp_path}/a", [texts[3][0], texts[9][0]])
    assert [r.ids[-1] for r in some.collect()] == 2 * [orcids.END_ID] and "In(doc_id" in some._jdf.queryExecution().toString()
    import pyarrow.orc

    file = next(p for p in (tmp_path / "a").glob("*.orc") if pyarrow.orc.ORCFile(p).nrows)
    assert pyarrow.orc.ORCFile(file).row_index_stride == orcids.INDEX_ROWS
    orcids.write_ids(odd, VOCABULARY, f"{tmp_path}/b")
    back = {(r.doc_id, tuple(r.ids)) for r in orcids.read_ids(spark, f"{tmp_path}/b").collect()}
    assert back == {(r.doc_id, (*library.encode(r.text or "", add_special_tokens=False).ids, orcids.END_ID)) for r in odd.collect()}
    orcids.write_ids(empty, VOCABULARY, f"{tmp_path}/c")
    assert orcids.layout(spark, f"{tmp_path}/c").count() == 0


# --- 9 -----------------------------------------------------------------------------------------------------------


def test_wu_manber():
    r = random.Random(5)
    for _ in range(200):
        items = [(i, [r.choice([b"a", b"b", b"c"]) for _ in range(r.randint(0, 6))]) for i in range(r.randint(0, 5))]
        words = [r.choice([b"a", b"b", b"c"]) for _ in range(r.randint(0, 40))]
        spans, found = wumanber.Searcher(items, 4).search(words)
        want, of = set(), set()
        for i, item in items:
            for window in [item[k : k + 4] for k in range(max(len(item) - 4, 0) + 1)] if item else []:
                for at in range(len(words) - len(window) + 1):
                    if words[at : at + len(window)] == window:
                        want.add((at, at + len(window)))
                        of.add(i)
        assert set(spans) == want and found == of
        assert wumanber._covered(spans) == len({p for a, b in want for p in range(a, b)})


def test_blocks_of_items_agree(spark, docs, odd, empty):
    items = spark.read.parquet(f"{DATA}/benchmark.parquet")
    key = lambda df: sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r.items)) for r in df.collect())
    assert key(wumanber.contamination(docs, items)) == key(wumanber.contamination(docs, items, items_at_once=9))
    holes = items.union(spark.createDataFrame([(None, "a b"), (900, None), (901, ""), (902, "hello world")], items.schema))
    assert wumanber.contamination(odd, holes).count() == odd.count() and wumanber.contamination(odd, holes.limit(0)).where("contaminated").count() == 0
    assert wumanber.contamination(empty, items).count() == 0


# --- 10 ----------------------------------------------------------------------------------------------------------


def _classes(texts, size, percent):
    sets = {}
    for doc, text in texts:
        words = (text or "").encode().lower().split()
        sets[doc] = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]) and root(a) != root(b):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {d: (len(sets[d]), root(d)) for d in ids}


def test_near_copies_of_copies(spark):
    """A base with copies further from each other than the threshold, chains, a second cluster, and exact copies."""
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    base = [word() for _ in range(120)]
    texts = [" ".join(base)]
    for _ in range(70):
        copy = list(base)
        for _ in range(r.choice((1, 2, 3, 4, 6, 9))):
            copy[r.randrange(len(copy))] = word()
        texts.append(" ".join(copy))
    step = list(base)
    for i in range(0, 110, 4):
        step[i] = word()
        texts.append(" ".join(step))
    texts += texts[5:9] + ["", "  ", "one two", "ONE  two", "three"]
    rows = list(enumerate(texts))
    r.shuffle(rows)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 80).collect()}
    assert got == _classes(rows, 4, 80)


def test_near_duplicates_of_documents(docs, texts, odd, empty):
    got = minhash.near_duplicates(docs, 5, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _classes(texts, 5, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    out = minhash.near_duplicates(odd).collect()
    assert len(out) == odd.count() and all(r.kept for r in out if r.doc_id is None)
    assert minhash.near_duplicates(empty).count() == 0
    assert minhash.first_of_each(docs).count() == sum(r.kept for r in got)


def test_components(spark):
    chain = [(i + 1, i) for i in range(40)] + [(100, 101), (7, 7)]
    got = {(r.node, r.label) for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(41)} | {(100, 100), (101, 100)}
