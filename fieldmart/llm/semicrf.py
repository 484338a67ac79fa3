"""Personal data: a semi-Markov conditional random field over candidate segments, beside base patterns that always stay."""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "id")
BASE_KINDS = KINDS[:4]
MOST_TOKENS, MOST_CHARS = 14, 64
"""Bounds of one entity in the dynamic programme."""
SURE = 0.9
"""Posterior probability from which the model adds a span."""

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    doubled = [int(d) for d in digits[::-1]]
    return (sum(doubled[::2]) + sum(2 * d - 9 * (d > 4) for d in doubled[1::2])) % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each base kind that pass its test, without retries inside a failing match; linear in the text."""
    found = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            found.append(("email", start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if "." in text:
        for m in _DOTTED.finditer(text):
            parts, pos = m[0].split("."), m.start()
            for i in range(0, len(parts) - 3, 4):
                four = parts[i : i + 4]
                length = sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                    found.append(("ip", pos, pos + length))
                pos += length + 1
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


# --- the model ---------------------------------------------------------------------------------------------------

_TOKEN = re.compile(r"[A-Za-z0-9]+|[^A-Za-z0-9\s]")
_SITE = re.compile(r"[0-9@]")
_CUES = ("phone", "tel", "call", "fax", "mobile", "card", "visa", "ssn", "social", "id", "passport", "mail", "email", "contact", "ip", "host", "order", "invoice", "version", "page", "year", "total")


def windows(text: str) -> list[tuple[int, int]]:
    """Stretches around digits and @ signs, with room for context; everything else can't hold an entity."""
    out: list[tuple[int, int]] = []
    for m in _SITE.finditer(text):
        low, high = max(0, m.start() - MOST_CHARS), min(len(text), m.end() + MOST_CHARS)
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return out


def _shape(s: str) -> str:
    return re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]+", lambda m: f"{min(len(m[0]), 9)}", s))[:32]


def _features(text: str, start: int, end: int) -> list[str]:
    s = text[start:end]
    digits = _digits(s)
    before = text[max(0, start - 24) : start].lower()
    names = [f"shape {_shape(s)}", f"digits {min(len(digits), 20)}", f"at {s.count('@')}", f"dots {min(s.count('.'), 4)}", f"plus {s[0] == '+'}", f"paren {'(' in s and ')' in s}", "bias"]
    names.append(f"left {'a' if start and text[start - 1].isalnum() else text[start - 1 : start]}")
    names.append(f"right {'a' if text[end : end + 1].isalnum() else text[end : end + 1]}")
    if 12 <= len(digits) <= 19:
        names.append(f"luhn {luhn(digits)}")
    parts = s.split(".")
    if len(parts) == 4 and all(p.isdigit() and len(p) <= 3 for p in parts):
        names.append(f"octets {all(int(p) <= 255 for p in parts)}")
    words = re.findall(r"[a-z]+", before)
    names += [f"cue {w}" for w in words[-2:] if w in _CUES]
    return names


def candidates(text: str, tokens: list[tuple[int, int]]) -> list[list[int]]:
    """For each token, the ends (in tokens) of the segments that may be an entity from there."""
    out: list[list[int]] = []
    for i, (start, _) in enumerate(tokens):
        ends: list[int] = []
        out.append(ends)
        if not (text[start].isalnum() or text[start] in "+("):
            continue
        digit = at = letter = False
        for j in range(i, min(i + MOST_TOKENS, len(tokens))):
            a, b = tokens[j]
            gap = text[tokens[j - 1][1] : a] if j > i else ""
            if gap not in ("", " ") or b - start > MOST_CHARS:
                break
            if gap and (at or letter):  # an address has no spaces
                break
            c = text[a]
            digit |= any("0" <= x <= "9" for x in text[a:b])
            letter |= any(x.isalpha() for x in text[a:b])
            at |= c == "@"
            if not c.isalnum() and c not in "@._%+-()":
                break
            if c.isalnum() and (at or (digit and not letter)) and not (j + 1 < len(tokens) and tokens[j + 1][0] == b and text[b].isalnum()):
                ends.append(j + 1)
    return out


def _log_add(values: list[float]) -> float:
    most = max(values)
    return most + math.log(sum(math.exp(v - most) for v in values)) if most > -math.inf else most


class SemiCrf:
    """P(segmentation | text) over O tokens and typed segments; weights are indexed by (kind, feature of the whole span) and (last, next) class."""

    def __init__(self) -> None:
        self.weights: dict[tuple[str, str], float] = defaultdict(float)

    def _lattice(self, text: str, low: int, high: int):
        tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text, low, high)]
        segments = []  # (first token, end token, kind, feature keys)
        for i, ends in enumerate(candidates(text, tokens)):
            for j in ends:
                names = _features(text, tokens[i][0], tokens[j - 1][1])
                segments += [(i, j, kind, [(kind, n) for n in names]) for kind in KINDS]
        return tokens, segments

    def _scored(self, text: str, low: int, high: int):
        """tokens, segments, and the segments by end and by start as (other end, score, number); scores of steps between classes."""
        tokens, segments = self._lattice(text, low, high)
        w = self.weights
        step = {(c, d): w.get(("step", f"{c}{d}"), 0.0) for c in "OE" for d in "OE"}
        by_end, by_start = defaultdict(list), defaultdict(list)
        for k, (i, j, _, keys) in enumerate(segments):
            score = sum(w.get(key, 0.0) for key in keys)
            by_end[j].append((i, score, k))
            by_start[i].append((j, score, k))
        return tokens, segments, by_end, by_start, step

    def posteriors(self, text: str, low: int, high: int):
        """tokens, and (first, end, kind, keys, probability) of each segment: forward and backward sums, a constant number of segments per token."""
        return self._sums(*self._scored(text, low, high))

    @staticmethod
    def _sums(tokens, segments, by_end, by_start, step):
        n = len(tokens)
        ahead = [{"O": -math.inf, "E": -math.inf} for _ in range(n + 1)]
        ahead[0]["O"] = 0.0
        for j in range(1, n + 1):
            ahead[j]["O"] = _log_add([ahead[j - 1][c] + step[c, "O"] for c in "OE"])
            if by_end[j]:
                ahead[j]["E"] = _log_add([ahead[i][c] + step[c, "E"] + s for i, s, _ in by_end[j] for c in "OE"])
        back = [{"O": -math.inf, "E": -math.inf} for _ in range(n + 1)]
        back[n] = {"O": 0.0, "E": 0.0}
        for i in range(n - 1, -1, -1):
            for c in "OE":
                back[i][c] = _log_add([step[c, "O"] + back[i + 1]["O"]] + [step[c, "E"] + s + back[j]["E"] for j, s, _ in by_start[i]])
        total = _log_add(list(ahead[n].values()))
        out = []
        for j, ways in by_end.items():
            for i, s, k in ways:
                inside = _log_add([ahead[i][c] + step[c, "E"] for c in "OE"]) + s + back[j]["E"] - total
                out.append((*segments[k], math.exp(min(0.0, inside))))
        return tokens, out

    @staticmethod
    def _best(tokens, segments, by_end, by_start, step) -> list[int]:
        """Numbers of the segments of the most probable segmentation: boundaries and kinds are chosen together, entities are bounded."""
        n = len(tokens)
        score = [{"O": -math.inf, "E": -math.inf} for _ in range(n + 1)]
        back: list[dict] = [{} for _ in range(n + 1)]
        score[0]["O"] = 0.0
        for j in range(1, n + 1):
            ways = [(score[j - 1][c] + step[c, "O"], c) for c in "OE"]
            score[j]["O"], before = max(ways)
            back[j]["O"] = (j - 1, before, None)
            for i, s, k in by_end[j]:
                for c in "OE":
                    if (value := score[i][c] + step[c, "E"] + s) > score[j]["E"]:
                        score[j]["E"], back[j]["E"] = value, (i, c, k)
        found, at, c = [], n, max("OE", key=lambda x: score[n][x])
        while at > 0:
            at, c, k = back[at][c]
            if k is not None:
                found.append(k)
        return found[::-1]

    def decode(self, text: str, low: int, high: int) -> list[tuple[str, int, int]]:
        """The entities of the most probable segmentation of a stretch."""
        lattice = self._scored(text, low, high)
        tokens, segments = lattice[:2]
        return [(segments[k][2], tokens[segments[k][0]][0], tokens[segments[k][1] - 1][1]) for k in self._best(*lattice)]

    def fit(self, labelled: list[tuple[str, list[tuple[str, int, int]]]], epochs: int = 6, rate: float = 0.5) -> "SemiCrf":
        """Gradient ascent on the likelihood of labelled texts: features of the true segments less the expected ones."""
        squared: dict = defaultdict(lambda: 1e-6)
        for _ in range(epochs):
            for text, spans in labelled:
                true = {(s, e, k) for k, s, e in spans}
                slope: dict = defaultdict(float)
                tokens, segments = self.posteriors(text, 0, len(text))
                for i, j, kind, keys, p in segments:
                    gap = ((tokens[i][0], tokens[j - 1][1], kind) in true) - p
                    if abs(gap) > 1e-4:
                        for key in keys:
                            slope[key] += gap
                for key, g in slope.items():
                    squared[key] += g * g
                    self.weights[key] += rate * g / math.sqrt(squared[key]) - 1e-4 * self.weights[key]
        return self

    def spans(self, text: str, least: float = SURE) -> list[tuple[str, int, int]]:
        """Entities of the most probable segmentation whose own posterior is `least` or more."""
        out = []
        for low, high in windows(text):
            lattice = self._scored(text, low, high)
            if not lattice[1]:
                continue
            chosen = {lattice[1][k][:3] for k in self._best(*lattice)}
            tokens, segments = self._sums(*lattice)
            out += [(kind, tokens[i][0], tokens[j - 1][1]) for i, j, kind, _, p in segments if p >= least and (i, j, kind) in chosen]
        return out


def labelled_sentences(n: int = 400, seed: int = 11) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Invented sentences with marked entities and with numbers that are none (dates, prices, versions, times, measures)."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(("th", "er", "on", "an", "re", "de", "la", "ou", "st", "ing", "mi", "ka")) for _ in range(r.randint(1, 4)))
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))

    def card() -> str:
        body = r.choice("3456") + d(14)
        number = next(body + c for c in "0123456789" if luhn(body + c))
        return number if r.random() < 0.6 else r.choice(" -").join(number[i : i + 4] for i in range(0, 16, 4))

    make = {
        "email": lambda: f"{word()}{r.choice(('', '.', '_'))}{d(2)}@{word()}.{r.choice(('com', 'org', 'example.net'))}",
        "ip": lambda: ".".join(str(r.randint(1, 255)) for _ in range(4)),
        "card": card,
        "phone": lambda: r.choice((f"+{r.randint(1, 99)} ({d(3)}) {d(3)}-{d(4)}", f"+{r.randint(1, 99)} {d(3)} {d(3)} {d(4)}", f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}")),
        "id": lambda: f"{d(3)}-{d(2)}-{d(4)}",
    }
    decoys = (lambda: f"{r.randint(1900, 2099)}-{d(2)}-{d(2)}", lambda: f"{d(2)}.{d(2)}.{d(4)}", lambda: f"{d(r.randint(1, 3))}.{d(2)}", lambda: f"{r.randint(0, 9)}.{r.randint(0, 20)}.{r.randint(0, 9)}", lambda: f"{d(2)}:{d(2)}", lambda: d(r.randint(1, 18)), lambda: f"{d(3)}-{d(3)}", lambda: f"{d(2)}-{d(2)}", lambda: f"{d(4)} {d(4)}", lambda: f"{r.randint(300, 999)}.{d(3)}.{d(3)}.{d(3)}", lambda: f"({d(2)}) {d(2)}")
    out = []
    for _ in range(n):
        text, spans = word(), []
        for _ in range(r.randint(3, 6)):
            text += " " + word() + r.choice(("", "", ".", ","))
            if r.random() < 0.5:
                kind = r.choice(KINDS)
                text += " "
                entity = make[kind]()
                spans.append((kind, len(text), len(text) + len(entity)))
                text += entity + r.choice(("", "", ".", ","))
            elif r.random() < 0.6:
                text += " " + r.choice(decoys)() + r.choice(("", "", ".", ","))
        out.append((text + " " + word(), spans))
    return out


@lru_cache(maxsize=2)
def trained(n: int = 400, seed: int = 11) -> dict[tuple[str, str], float]:
    return dict(SemiCrf().fit(labelled_sentences(n, seed)).weights)


def all_spans(text: str | None, model: SemiCrf) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and these with what the model adds where no base span is."""
    if not text or not re.search(r"[0-9@+]", text):
        return [], []
    base = base_spans(text)
    every, reached, at = list(base), 0, 0
    for kind, start, end in model.spans(text):  # in order, and apart from each other
        while at < len(base) and base[at][1] < end:
            reached, at = max(reached, base[at][2]), at + 1
        if reached <= start:
            every.append((kind, start, end))
    return base, sorted(every, key=lambda s: (s[1], KINDS.index(s[0])))


def _flat(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _found(weights: dict):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = SemiCrf()
        model.weights = weights
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                base, every = all_spans(text, model)
                out.append((doc, *(sum(k == kind for k, _, _ in base) for kind in BASE_KINDS), _flat(base), _flat(every)))
            yield pd.DataFrame(out, columns=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "spans"]).astype({"doc_id": "Int64"})

    return run


def personal_data(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone (base spans), base and spans as kind:start:end lists (code points, end exclusive).

    Null or empty texts have none; rows are independent, so ties, repeated rows and null ids don't matter. The work is
    linear in a text, also in one dense in digits: a token starts a bounded number of candidates.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(_found(trained()), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")


def _redacted(weights: dict):
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = SemiCrf()
        model.weights = weights
        for batch in texts:
            out = []
            for text in batch:
                _, spans = all_spans(text, model)
                at, parts = 0, []
                for kind, start, end in spans:
                    if end > at:  # base spans of two kinds may overlap
                        if start >= at:
                            parts += [text[at:start], f"[{kind.upper()}]"]
                        at = end
                out.append("".join(parts) + text[at:] if spans else text)
            yield pd.Series(out, dtype=object)

    return run


def redacted(docs: DataFrame) -> DataFrame:
    """docs with every span of personal data in text replaced by its kind in brackets; n_chars follows where it is a column."""
    out = docs.withColumn("text", F.pandas_udf(_redacted(trained()), "string")("text"))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
