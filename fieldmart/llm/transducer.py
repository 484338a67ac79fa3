"""Minimal acyclic transducer: a shared-suffix automaton from words to numbers, and through these to lists of ids."""

from __future__ import annotations

import json

import numpy as np


class Transducer:
    """Arrays of the automaton; they may be memory-mapped. Outputs on the arcs sum up to the number of a word."""

    FIELDS = ("arcs", "targets", "outputs", "final", "offsets", "ids")

    def __init__(self, **fields: np.ndarray) -> None:
        for name in self.FIELDS:
            setattr(self, name, fields[name])

    @classmethod
    def build(cls, words: dict[bytes, list[int]]) -> "Transducer":
        """Words go in in order; a state whose right language is known is replaced by its equal (incremental minimisation)."""
        ordered = sorted(words)
        known: dict[tuple, int] = {}
        children: list[dict[int, int]] = [{}]
        final = [False]
        path = [0]  # states along the last word

        def settle(depth: int) -> None:
            while len(path) > depth + 1:
                state = path.pop()
                key = (final[state], tuple(children[state].items()))
                same = known.setdefault(key, state)
                if same != state:
                    above = children[path[-1]]
                    above[next(reversed(above))] = same

        last = b""
        for word in ordered:
            common = 0
            while common < min(len(word), len(last)) and word[common] == last[common]:
                common += 1
            settle(common)
            for byte in word[common:]:
                children.append({})
                final.append(False)
                children[path[-1]][byte] = len(children) - 1
                path.append(len(children) - 1)
            final[path[-1]] = True
            last = word
        settle(0)

        number, order, stack = {}, [], [0]  # states that are left, parents first
        while stack:
            state = stack.pop()
            if state not in number:
                number[state] = len(order)
                order.append(state)
                stack += children[state].values()
        through: dict[int, int] = {}

        def words_from(state: int) -> int:
            todo = [state]
            while todo:
                s = todo[-1]
                waiting = [c for c in children[s].values() if c not in through]
                if waiting:
                    todo += waiting
                    continue
                through[s] = final[s] + sum(through[c] for c in children[s].values())
                todo.pop()
            return through[state]

        words_from(0)
        arcs, targets, outputs = [], [], []
        for state in order:
            skipped = int(final[state])
            for byte, child in children[state].items():
                arcs.append(number[state] << 8 | byte)
                targets.append(number[child])
                outputs.append(skipped)
                skipped += through[child]
        rank = np.argsort(np.array(arcs, np.int64), kind="stable")
        ids = [words[w] for w in ordered]
        return cls(
            arcs=np.array(arcs, np.int64)[rank], targets=np.array(targets, np.int64)[rank], outputs=np.array(outputs, np.int64)[rank], final=np.array([final[s] for s in order], np.int64),
            offsets=np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)]).astype(np.int64), ids=np.array([i for x in ids for i in x], np.int64),
        )

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 where it isn't in the lexicon; all words step through the automaton together."""
        out = np.full(len(words), -1, np.int64)
        if not len(self.arcs) or not words:
            return out
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        longest = 64  # no longer words are compiled
        rows = np.flatnonzero((lengths <= longest) & (lengths > 0))
        if not len(rows):
            return out
        wide = int(lengths[rows].max())
        table = np.frombuffer(b"".join(words[i].ljust(wide, b"\0") for i in rows), np.uint8).reshape(len(rows), wide)
        state, total, size = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64), lengths[rows]
        live = np.arange(len(rows))
        for t in range(wide):
            key = state[live] << 8 | table[live, t]
            at = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            hit = self.arcs[at] == key
            live, at = live[hit], at[hit]
            state[live] = self.targets[at]
            total[live] += self.outputs[at]
            done = size[live] == t + 1
            ended = live[done]
            ended = ended[self.final[state[ended]] == 1]
            out[rows[ended]] = total[ended]
            live = live[~done]
            if not len(live):
                break
        return out

    def get(self, number: int) -> list[int]:
        return self.ids[self.offsets[number] : self.offsets[number + 1]].tolist()

    def save(self, path: str) -> None:
        head = json.dumps({n: len(getattr(self, n)) for n in self.FIELDS}).encode().ljust(512)
        with open(path, "wb") as f:
            f.write(head)
            for name in self.FIELDS:
                f.write(np.ascontiguousarray(getattr(self, name), np.int64).tobytes())

    @classmethod
    def map(cls, path: str) -> "Transducer":
        """The saved automaton, memory-mapped: all workers of a machine share its pages."""
        with open(path, "rb") as f:
            sizes = json.loads(f.read(512))
        fields, at = {}, 512
        for name in cls.FIELDS:
            fields[name] = np.memmap(path, np.int64, "r", at, (sizes[name],)) if sizes[name] else np.empty(0, np.int64)
            at += 8 * sizes[name]
        return cls(**fields)
