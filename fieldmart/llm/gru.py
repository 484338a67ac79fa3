"""Language identification: a bidirectional gated recurrent network over bytes labels every position; documents pool the positions."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_DOCUMENTS = 1_500
"""Bound of the labelled sample that the network is fitted on (documents, those of the smallest hashed ids)."""
PIECES, PIECE = 4, 64
"""Stretches of a sampled document that reach the driver, from its start to its end, and their code points."""
SPAN, CONTEXT = 96, 16
"""Bytes that one window labels, and bytes on either side of them that the network reads before."""
HIDDEN = 8
UNKNOWN = "und"
_WINDOWS = 3_072
_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    """Whether any character is of a letter category of Unicode."""
    return bool(_ASCII_LETTER.search(text)) or not text.isascii() and any(map(str.isalpha, text))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Gru:
    """Two recurrent passes, h = (1 - z) * h + z * tanh(candidate), over the bytes of a sequence; a softmax layer on both labels each position."""

    def __init__(self, n_labels: int, hidden: int = HIDDEN, seed: int = 5) -> None:
        r = np.random.default_rng(seed)
        init = lambda *shape: r.normal(0, 1 / np.sqrt(shape[-2]), shape).astype(np.float32)
        # for each direction: input rows by byte, recurrent weights for (update, reset), recurrent weights for the candidate
        self.p = {f"{d}{k}": v for d in "fb" for k, v in (("x", r.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)), ("u", init(hidden, 2 * hidden)), ("c", init(hidden, hidden)))}
        self.p["out"] = init(2 * hidden, n_labels)
        self.p["bias"] = np.zeros(n_labels, np.float32)
        self.hidden = hidden

    def _pass(self, d: str, bytes_: np.ndarray, mask: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States (time, sequence, hidden); a step outside of a text leaves its state as it was."""
        h, x, u, c = self.hidden, self.p[d + "x"], self.p[d + "u"], self.p[d + "c"]
        state = np.zeros((bytes_.shape[1], h), x.dtype)
        states = np.empty((*bytes_.shape, h), x.dtype)
        order = range(len(bytes_)) if d == "f" else range(len(bytes_) - 1, -1, -1)
        for t in order:
            rows = x[bytes_[t]]
            gates = _sigmoid(rows[:, : 2 * h] + state @ u)
            z, r = gates[:, :h] * mask[t][:, None], gates[:, h:]
            gated = r * state
            cand = np.tanh(rows[:, 2 * h :] + gated @ c)
            if trace is not None:
                trace.append((t, state, gates, gated, cand))
            states[t] = state = state + z * (cand - state)
        return states

    def positions(self, bytes_: np.ndarray, mask: np.ndarray, traces: tuple | None = None):
        """Log-probabilities (time, sequence, label) of every position, and the states."""
        both = np.concatenate([self._pass("f", bytes_, mask, traces and traces[0]), self._pass("b", bytes_, mask, traces and traces[1])], axis=2)
        scores = both @ self.p["out"] + self.p["bias"]
        scores -= scores.max(axis=2, keepdims=True)
        return scores - np.log(np.exp(scores).sum(axis=2, keepdims=True)), both

    def gradient(self, bytes_: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Backpropagation through time of the mean cross-entropy over all positions."""
        traces: tuple = ([], [])
        logp, both = self.positions(bytes_, mask, traces)
        d_scores = np.exp(logp)
        d_scores[:, np.arange(len(labels)), labels] -= 1
        d_scores *= mask[:, :, None] / mask.sum()
        flat = both.reshape(-1, both.shape[2])
        g = {"out": flat.T @ d_scores.reshape(len(flat), -1), "bias": d_scores.sum(axis=(0, 1))}
        d_both = d_scores @ self.p["out"].T
        h = self.hidden
        order = np.argsort(bytes_, axis=None, kind="stable")
        firsts = np.flatnonzero(np.diff(bytes_.ravel()[order], prepend=-1))
        for d, trace, d_states in (("f", traces[0], d_both[:, :, :h]), ("b", traces[1], d_both[:, :, h:])):
            u, c = self.p[d + "u"], self.p[d + "c"]
            g |= {d + k: np.zeros_like(self.p[d + k]) for k in "xuc"}
            d_rows = np.empty((*bytes_.shape, 3 * h), both.dtype)
            carried = np.zeros_like(d_states[0])
            for t, state, gates, gated, cand in reversed(trace):
                dh = d_states[t] + carried
                m = mask[t][:, None]
                z, r = gates[:, :h] * m, gates[:, h:]
                d_cand = dh * z * (1 - cand * cand)
                d_z = dh * (cand - state) * m * gates[:, :h] * (1 - gates[:, :h])
                d_gated = d_cand @ c.T
                d_r = d_gated * state * r * (1 - r)
                d_gates = np.concatenate([d_z, d_r], axis=1)
                g[d + "c"] += gated.T @ d_cand
                g[d + "u"] += state.T @ d_gates
                d_rows[t, :, : 2 * h], d_rows[t, :, 2 * h :] = d_gates, d_cand
                carried = dh * (1 - z) + d_gated * r + d_gates @ u.T
            sums = np.add.reduceat(d_rows.reshape(-1, 3 * h)[order], firsts, axis=0)
            g[d + "x"][bytes_.ravel()[order][firsts]] = sums
        return g

    def fit(self, pieces: list[bytes], labels: np.ndarray, epochs: int = 6, batch: int = 512, rate: float = 0.02, seed: int = 5) -> "Gru":
        """Adam over shuffled batches of labelled pieces."""
        r, step = np.random.default_rng(seed), 0
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        batch = max(16, min(batch, len(pieces) // 8))
        for _ in range(epochs):
            order = r.permutation(len(pieces))
            for at in range(0, len(order), batch):
                part = order[at : at + batch]
                grads, step = self.gradient(*padded([pieces[i] for i in part]), labels[part]), step + 1
                for k, g in grads.items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    self.p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def _states(self, d: str, bytes_: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """The states of _pass without their trace: gates in arrays of their own, exponentials for both activations."""
        h, x, u, c = self.hidden, self.p[d + "x"], self.p[d + "u"], self.p[d + "c"]
        xs = [np.ascontiguousarray(-x[:, :h]), np.ascontiguousarray(-x[:, h : 2 * h]), np.ascontiguousarray(2 * x[:, 2 * h :])]
        us = [np.ascontiguousarray(-u[:, :h]), np.ascontiguousarray(-u[:, h:]), 2 * c]
        shape = (bytes_.shape[1], h)
        z, r, cand, product = (np.empty(shape, np.float32) for _ in range(4))
        states = np.empty((*bytes_.shape, h), np.float32)
        state = np.zeros(shape, np.float32)

        def one_over(into: np.ndarray, k: int, t: int, left: np.ndarray) -> None:
            """1 / (1 + exp(input rows of byte t + left @ recurrent weights))"""
            np.take(xs[k], bytes_[t], axis=0, out=into, mode="clip")
            np.dot(left, us[k], out=product)
            np.add(into, product, out=into)
            np.exp(into, out=into)
            np.add(into, 1, out=into)
            np.reciprocal(into, out=into)

        whole = mask.all(axis=1)
        for t in range(len(bytes_)) if d == "f" else range(len(bytes_) - 1, -1, -1):
            one_over(z, 0, t, state)
            one_over(r, 1, t, state)
            np.multiply(r, state, out=r)
            one_over(cand, 2, t, r)
            np.multiply(cand, -2, out=cand)
            np.add(cand, 1, out=cand)
            np.subtract(cand, state, out=cand)
            np.multiply(cand, z, out=cand)
            if not whole[t]:
                np.multiply(cand, mask[t][:, None], out=cand)
            np.add(state, cand, out=states[t])
            state = states[t]
        return states

    def sums(self, bytes_: np.ndarray, mask: np.ndarray, labelled: slice) -> np.ndarray:
        """(sequence, label): sums of log-probabilities over the real positions of a slice of the time."""
        h, out = self.hidden, self.p["out"].astype(np.float32)
        with np.errstate(over="ignore"):
            ahead, back = (self._states(d, bytes_, mask)[labelled].reshape(-1, h) for d in "fb")
        scores = out[:h].T @ ahead.T + out[h:].T @ back.T + self.p["bias"].astype(np.float32)[:, None]
        scores -= scores.max(axis=0)
        scores -= np.log(np.exp(scores).sum(axis=0))
        real = mask[labelled]
        return np.einsum("ltw,tw->wl", scores.reshape(len(scores), *real.shape), real.astype(np.float32))

    def documents(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """For each text the sum over all its positions of their log-probabilities, by label.

        Texts lie behind each other and are cut into windows of SPAN bytes, each with the CONTEXT bytes around it; windows
        of many texts, or parts of one long text, go through the network together.
        """
        waiting: list[bytes] = []
        windows = 0
        for text in texts:
            waiting.append(text)
            windows += -(-len(text) // SPAN)
            if windows >= _WINDOWS:
                yield from self._together(waiting)
                waiting, windows = [], 0
        if waiting:
            yield from self._together(waiting)

    def _together(self, texts: list[bytes]) -> np.ndarray:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        flat = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum(sizes)
        counts = -(-sizes // SPAN)
        of = np.repeat(np.arange(len(texts)), counts)
        starts = (ends - sizes)[of] + SPAN * (np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts))
        out = np.zeros((len(texts), len(self.p["bias"])))
        step = -(-len(of) // max(1, round(len(of) / _WINDOWS)))
        for at in range(0, len(of), step):
            part = slice(at, at + step)
            places = starts[part][None, :] + np.arange(-CONTEXT, SPAN + CONTEXT)[:, None]
            mask = (places >= (ends - sizes)[of[part]]) & (places < ends[of[part]])
            bytes_ = flat[np.clip(places, 0, len(flat) - 1)]
            np.add.at(out, of[part], self.sums(bytes_, mask, slice(CONTEXT, CONTEXT + SPAN)))
        return out


def padded(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte matrix (time, piece), padded on the right, and the mask of real bytes."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    wide = int(lengths.max(initial=1))
    flat = np.frombuffer(b"".join(p.ljust(wide, b"\0") for p in pieces), np.uint8).reshape(len(pieces), wide)
    return np.ascontiguousarray(flat.T), (np.arange(wide)[:, None] < lengths[None, :]).astype(np.float32)


def trained(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> tuple[list[str], Gru | None]:
    """The labels and the network, fitted on the text and lang of at most `sample` documents whose crc32(doc_id) mod 3 is not 1.

    The documents of the smallest hashed ids are taken, of each PIECES stretches of PIECE code points, so that what reaches
    the driver is bounded; then as many stretches of each label as of any other.
    """
    labelled = docs.where("lang is not null").where(~held_out()).select("doc_id", "lang", "text", F.xxhash64("doc_id").alias("h"))
    n = labelled.count()
    share = min(1.0, 1.2 * sample / max(n, 1))  # the hashes are even, so a share of their range holds about that share of the rows
    few = labelled.where(F.col("h") <= min(2**63 - 1, -(2**63) + int(share * 2**64))).where("text is not null")
    stretches = F.array_distinct(F.expr(f"transform(sequence(0, {PIECES - 1}), i -> substring(text, 1 + cast(i * greatest(length(text) - {PIECE}, 0) / {PIECES - 1} as int), {PIECE}))"))
    rows = few.select("h", "doc_id", "lang", stretches.alias("pieces")).orderBy("h", "doc_id", "pieces", "lang").limit(sample).collect()
    languages = sorted({r.lang for r in rows})
    if not languages:
        return [], None
    by: dict[str, list[bytes]] = {k: [] for k in languages}
    for r in rows:
        by[r.lang] += [raw for p in r.pieces if (raw := p.encode().lower())]
    pieces, labels, rng = [], [], np.random.default_rng(3)
    most = max(map(len, by.values()))
    for k, language in enumerate(languages):
        if own := by[language]:
            take = rng.permutation(np.resize(np.arange(len(own)), min(most, 2 * len(own))))
            pieces += [own[i] for i in take]
            labels += [k] * len(take)
    if not pieces:
        return [], None
    return languages, Gru(len(languages)).fit(pieces, np.array(labels))


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _labels(model: tuple[list[str], Gru | None], texts: list[str | None]) -> list[tuple[str, float]]:
    """(label, score) of each text: the label of the greatest geometric mean of all positions' probabilities, and its share."""
    languages, network = model
    out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
    if network is None:
        return out
    known = [(i, t.encode().lower()) for i, t in enumerate(texts) if t and has_letter(t)]
    for (i, raw), total in zip(known, network.documents([raw for _, raw in known]), strict=True):
        pooled = np.exp((total - total.max()) / len(raw))
        best = int(pooled.argmax())
        out[i] = (languages[best], float(pooled[best] / pooled.sum()))
    return out


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _predicted(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            out = _labels(sent.value, batch.column("text").to_pylist())
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array([x for x, _ in out], pa.string()), pa.array([y for _, y in out], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    return run


def languages_of(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score (pooled probability, 0 to 1).

    `und` and 0 where the text is null, has no letter, or nothing could be learned. Only text is used to predict. A null
    doc_id is not held out. Repeated rows get the same result. All bytes of a text, white space too, are labelled.
    """
    sent = docs.sparkSession.sparkContext.broadcast(trained(docs, sample))  # a few tens of kB, whatever the input
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_predicted(sent), "doc_id long, held_out boolean, lang_pred string, score double")


def _kept(sent, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            out = _labels(sent.value, batch.column("text").to_pylist())
            if "lang" in batch.schema.names:
                at = batch.schema.get_field_index("lang")
                own = batch.column(at)
                batch = batch.set_column(at, batch.schema.field(at), pc.coalesce(own, pa.array([x for x, _ in out], own.type)))
            yield batch.filter(pa.array([x != UNKNOWN and y >= least for x, y in out], pa.bool_()))

    return run


def with_language(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS, least: float = 0.0) -> DataFrame:
    """docs whose language is found: texts that are null or without letters go, and those of a score under `least`; a null lang becomes the predicted one.

    Clean texts of one short word have scores down to 0.4, so `least` is 0 by default. Rows are judged one by one, so
    repeated rows and null ids stay or go by their text; other columns stay as they are.
    """
    sent = docs.sparkSession.sparkContext.broadcast(trained(docs, sample))
    return docs.mapInArrow(_kept(sent, least), docs.schema)
