"""Suffix arrays with common-prefix values by external induced sorting.

Suffixes that are smaller than the next one though the one before them is larger (S*) are named by the text between
them, the string of names is sorted by recursion, and their order then induces that of all others in two scans. What a
scan finds it hands to a priority queue as tuples (place, common prefix with the tuple before): the key is the first
character, and among equal ones tuples leave in the order in which they came, so a queue is a run of blocks for each
character. Queues beyond a memory limit go to disk, and so do the text of names and the arrays that span it; what stays
in memory are blocks. Prefixes are compared up to `cap` characters only: beyond it the order of suffixes is any.
"""

from __future__ import annotations

import tempfile
from collections import defaultdict
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 18
"""Tuples that are worked on at once."""
_TUPLE = np.dtype([("place", "<i8"), ("prefix", "u1")])


def on_disk(n: int, dtype: type, limit: int) -> np.ndarray:
    """An array of zeros, in a file without a name where it is larger than the limit: nothing is left of it when the task ends, however it ends."""
    if n * np.dtype(dtype).itemsize <= limit:
        return np.zeros(n, dtype)
    with tempfile.TemporaryFile() as file:
        file.truncate(n * np.dtype(dtype).itemsize)
        return np.memmap(file, dtype, "r+", shape=(n,))


class Queue:
    """Disk-backed priority queue of (place, prefix) by character; equal characters leave first in, first out."""

    def __init__(self, limit: int) -> None:
        self.limit, self.held, self.file, self.size = limit, 0, None, 0
        self.blocks: dict[int, list] = defaultdict(list)  # arrays, or (offset, number) of what is in the file
        self.spilled = 0

    def push(self, character: int, places: np.ndarray, prefixes: np.ndarray) -> None:
        if len(places):
            self.blocks[character].append((places, prefixes))
            self.held += 9 * len(places)
            self.size += len(places)
            if self.held > self.limit:
                self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for blocks in self.blocks.values():
            first = next((i for i, b in enumerate(blocks) if isinstance(b[0], np.ndarray)), len(blocks))
            own = blocks[first:]
            if own:
                rows = np.empty(sum(len(p) for p, _ in own), _TUPLE)
                rows["place"], rows["prefix"] = np.concatenate([p for p, _ in own]), np.concatenate([x for _, x in own])
                blocks[first:] = [(self.file.tell(), len(rows))]
                rows.tofile(self.file)
                self.spilled += len(rows)
        self.held = 0

    def _read(self, offset: int, number: int) -> tuple[np.ndarray, np.ndarray]:
        self.file.seek(offset)
        rows = np.fromfile(self.file, _TUPLE, number)
        return rows["place"].copy(), rows["prefix"].copy()

    def take(self, character: int, backwards: bool = False, keep: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What a character has, in blocks, in order or from the last to the first; it leaves the queue unless it is kept."""
        blocks = list(self.blocks.get(character, ())) if keep else self.blocks.pop(character, [])
        if not keep:
            self.held -= 9 * sum(len(b[0]) for b in blocks if isinstance(b[0], np.ndarray))
        joined: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for block in reversed(blocks) if backwards else blocks:
            for part in self._parts(block, backwards):
                joined.append(part)
                size += len(part[0])
                if size >= BLOCK:
                    yield _one(joined, backwards)
                    joined, size = [], 0
        if joined:
            yield _one(joined, backwards)

    def _parts(self, block: tuple, backwards: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        held = isinstance(block[0], np.ndarray)
        cuts = range(0, len(block[0]) if held else block[1], BLOCK)
        for at in reversed(cuts) if backwards else cuts:
            yield (block[0][at : at + BLOCK], block[1][at : at + BLOCK]) if held else self._read(block[0] + at * _TUPLE.itemsize, min(BLOCK, block[1] - at))


def _one(parts: list[tuple[np.ndarray, np.ndarray]], backwards: bool) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    parts = parts[::-1] if backwards else parts
    return np.concatenate([p for p, _ in parts]), np.concatenate([x for _, x in parts])


def _minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low..high], both included, for many ranges: tables of runs of 1, 2, 4, ... values."""
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    out = np.empty(len(low), values.dtype)
    table, size = values, 1
    for k in range(int(level.max(initial=-1)) + 1):
        own = np.flatnonzero(level == k)
        out[own] = np.minimum(table[low[own]], table[high[own] - size + 1])
        table, size = np.minimum(table[:-size], table[size:]) if len(table) > size else table, 2 * size
    return out


class _Scan:
    """One scan over the suffixes in order, from character to character, that hands their predecessors on to a queue."""

    def __init__(self, queue: Queue, characters: int, cap: int) -> None:
        self.queue, self.cap = queue, cap
        self.least = np.zeros(characters, np.uint8)  # common prefix of all tuples since the last one handed on to a character
        self.touched = np.empty(0, np.int64)

    def next_character(self) -> None:
        self.least[self.touched] = 0
        self.touched = np.empty(0, np.int64)

    def block(self, places: np.ndarray, prefixes: np.ndarray, before: np.ndarray, chosen: np.ndarray) -> None:
        """Hands places - 1 of the chosen tuples on to the queue of the character before each."""
        at = np.flatnonzero(chosen)
        targets = before[at]
        small = targets.astype(np.uint8) if len(self.least) <= 256 else targets
        order = np.argsort(small, kind="stable")
        at, targets = at[order], targets[order]
        first = np.concatenate([[True], targets[1:] != targets[:-1]]) if len(at) else np.empty(0, bool)
        heads = np.flatnonzero(first)
        prior = np.concatenate([[-1], at[:-1]])[: len(at)]
        prior[first] = -1
        least = _minima(prefixes, prior + 1, at)
        least[first] = np.minimum(least[first], self.least[targets[first]])
        prefix = np.minimum(least.astype(np.int64) + 1, self.cap).astype(np.uint8)
        own = targets[heads]
        if len(self.touched):
            self.least[self.touched] = np.minimum(self.least[self.touched], prefixes.min(initial=255))
        ends = np.concatenate([heads[1:], [len(at)]])[: len(heads)]
        for c, p, q in zip(own.tolist(), heads.tolist(), ends.tolist(), strict=True):
            self.queue.push(c, places[at[p:q]] - 1, prefix[p:q])
        last = at[ends - 1] if len(heads) else ends
        rest = np.minimum.accumulate(prefixes[::-1])[::-1]
        self.least[own] = np.where(last + 1 < len(rest), rest[np.minimum(last + 1, len(rest) - 1)], 255)
        self.touched = np.union1d(self.touched, own)


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes a and b, up to `most` of each."""
    length = np.zeros(len(a), np.int64)
    open_ = np.flatnonzero((most > 0) & (np.maximum(a, b) < len(text)))
    while len(open_):
        open_ = open_[text[a[open_] + length[open_]] == text[b[open_] + length[open_]]]
        length[open_] += 1
        open_ = open_[(length[open_] < most[open_]) & (np.maximum(a[open_], b[open_]) + length[open_] < len(text))]
    return length


def _smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (type S). The empty suffix is the smallest of all."""
    n = len(text)
    small = np.zeros(n, bool)
    for end in range(n, 0, -BLOCK):
        low = max(0, end - BLOCK)
        here = text[low:end].astype(np.int64)
        after = np.concatenate([here[1:], [text[end] if end < n else -1]])
        differs = np.flatnonzero(here != after)  # each decides for the equal characters before it
        decided = int(differs[-1]) + 1 if len(differs) else 0
        small[low : low + decided] = np.repeat(here[differs] < after[differs], np.diff(differs, prepend=-1))
        small[low + decided : end] = small[end] if end < n else False
    return small


def _refined(group: np.ndarray, open_: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Cuts the groups of the members in open_ by their words. A group's number is the place of its first member in the order, so numbers of other groups stay. Returns which members still share their group."""
    g = group[open_]
    wide = int(word.max(initial=0)) + 2  # words are -1 at least
    if int(g.max(initial=0)) < (1 << 62) // wide:
        by = np.argsort(g * wide + (word + 1))  # one key for both
    else:
        by = np.lexsort((word, g))
    g, w = g[by], word[by]
    new_group = np.concatenate([[True], g[1:] != g[:-1]])
    head = np.flatnonzero(new_group | np.concatenate([[True], w[1:] != w[:-1]]))
    first = np.flatnonzero(new_group)
    size = np.diff(head, append=len(g))
    group[open_[by]] = g + np.repeat(head, size) - np.repeat(first, np.diff(first, append=len(g)))
    shared = np.empty(len(open_), bool)
    shared[by] = np.repeat(size > 1, size)
    return shared


def _named(text: np.ndarray, small: np.ndarray, starts: np.ndarray, limit: int) -> tuple[np.ndarray, int]:
    """The rank of the text from each S* place to the next (both included), and the number of different ranks.

    Characters with their types are packed into words; words are compared one after the other, among those still equal.
    Places are dealt to a queue by their first character, and what one character has is sorted at a time.
    """
    bits = max(int(text.max(initial=0)) * 2 + 2, 1).bit_length()
    per_word = max(1, 63 // bits)
    symbols = on_disk(len(text) + per_word, np.int32, limit)  # zeros behind the text
    for at in range(0, len(text), BLOCK):
        end = min(at + BLOCK, len(text))
        symbols[at:end] = text[at:end].astype(np.int32) * 2 + small[at:end] + 1
    stops = np.concatenate([starts[1:] + 1, [len(text)]])
    dealt, heads = Queue(limit), text[starts]
    order = np.argsort(heads, kind="stable")
    cuts = np.flatnonzero(np.concatenate([[True], heads[order][1:] != heads[order][:-1]])) if len(order) else order
    for p, q in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)], strict=False):
        dealt.push(int(heads[order[p]]), order[p:q], np.zeros(q - p, np.uint8))
    ranks, many = on_disk(len(starts), np.int64, limit), 0
    for c in sorted(dealt.blocks):
        own = np.concatenate([p for p, _ in dealt.take(c)])
        group, offset, open_ = np.zeros(len(own), np.int64), 0, np.arange(len(own))
        while len(open_):
            word = np.zeros(len(open_), np.int64)
            place, stop = starts[own[open_]] + offset, stops[own[open_]]
            for k in range(per_word):
                word <<= bits
                word |= symbols[place + k]
            beyond = np.maximum(per_word - (stop - place), 0) * bits  # bits of symbols from the stop on
            word = word >> beyond << beyond
            shared = _refined(group, open_, word)
            offset += per_word
            open_ = open_[shared & (place + per_word < stop)]
        heads_of = np.zeros(len(own), np.int64)
        heads_of[group] = 1
        dense = np.cumsum(heads_of) - 1
        ranks[own] = many + dense[group]
        many += int(dense[-1]) + 1
    return ranks, many


def _doubled(names: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes of a string of ranks that fits into memory, and common prefixes with the one before, by doubling up to cap. Only suffixes that still share their place are sorted again."""
    n = len(names)
    counts = np.bincount(names)
    group = (np.cumsum(counts) - counts)[names]
    ranks = lambda: np.append(group, -1).astype(np.int32)  # noqa: E731  # behind the end: smaller than all
    levels, size = [ranks()], 1
    open_ = np.flatnonzero(counts[names] > 1)
    while size < cap and len(open_):
        word = levels[-1][np.minimum(open_ + size, n)]
        open_ = open_[_refined(group, open_, word)]
        levels.append(ranks())
        size *= 2
    order = np.empty(n, np.int64)
    order[group] = np.arange(n)  # a group's number is its first place
    if len(open_):
        tied = open_[np.argsort(group[open_], kind="stable")]
        g = group[tied]
        head = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        order[g + np.arange(len(g)) - np.repeat(head, np.diff(head, append=len(g)))] = tied
    last = levels.pop()[order]
    differ = np.flatnonzero(last[1:] != last[:-1]) + 1  # the others share `size` names, and that is the cap or more
    prefix = np.full(n, cap, np.int64)
    prefix[:1] = 0
    first = order[differ]
    a, b = first.copy(), order[differ - 1]
    for level in range(len(levels) - 1, -1, -1):
        step = (levels[level][a] == levels[level][b]).astype(np.int64) << level
        a += step
        b += step
    prefix[differ] = np.minimum(a - first, cap)
    return order, prefix


def sorted_suffixes(text: np.ndarray, cap: int = 200, limit: int = 48 << 20, most_names: int = 1 << 22) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (places, common prefix with the suffix before, up to cap) in the order of suffixes; cap is at most 254.

    `limit` bounds the bytes that each queue holds in memory. A string of up to `most_names` names is sorted in memory, a
    longer one by recursion, whose work goes up by a step for each name. An empty text has no suffixes.
    """
    n = len(text)
    if not n:
        return
    characters = int(text.max()) + 1
    small = _smaller_than_next(text)
    starts = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    seeds = Queue(limit)
    if len(starts):
        names, many = _named(text, small, starts, limit)
        deep = cap // 2 + 1  # names span two characters or more
        if many == len(starts):
            order = np.argsort(names, kind="stable")
            found = iter([(order, np.zeros(len(order), np.int64))])
        elif len(names) <= most_names:
            found = iter([_doubled(names, deep)])
        else:
            found = sorted_suffixes(names, deep, limit, most_names)
        prior = None
        for order, equal in found:
            for at in range(0, len(order), BLOCK):
                own, same = order[at : at + BLOCK], equal[at : at + BLOCK].astype(np.int64)
                before = np.concatenate([[own[0] if prior is None else prior], own[:-1]])
                prior = own[-1]
                last = np.minimum(np.maximum(own, before) + same, len(starts)) >= len(starts)
                same = np.where(last, len(starts) - np.maximum(own, before) - 1, same)  # compared from the last name's place on
                shared = starts[own + same] - starts[own]
                prefix = np.minimum(shared + _common(text, starts[own + same], starts[before + same], np.maximum(cap - shared, 0)), cap).astype(np.uint8)
                heads = text[starts[own]]
                cuts = [0, *(np.flatnonzero(heads[1:] != heads[:-1]) + 1).tolist(), len(own)]
                for p, q in zip(cuts[:-1], cuts[1:], strict=True):
                    seeds.push(int(heads[p]), starts[own[p:q]], prefix[p:q])
        del names
    yield from _induced(text, characters, seeds, cap, limit)


def _rounds(text: np.ndarray, scan: _Scan, character: int, limit: int, onward) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of a character's own part of a scan. Suffixes that start with one more of the character follow those that they come from, round by round."""
    now, many, seen = scan.queue, 0, False
    while True:
        again = Queue(limit)
        own, first = _Scan(again, 2, scan.cap), True
        for places, prefixes in now.take(character if now is scan.queue else 1):
            if first:
                prefixes = prefixes.copy()
                prefixes[0] = min(many, scan.cap) if seen else 0
            before = np.where(places > 0, text[places - 1].astype(np.int64), -1)
            scan.block(places, prefixes, before, onward(before, character))
            own.block(places, prefixes, (before == character).astype(np.int64), before == character)
            first = False
            seen = True
            yield places, prefixes
        if not again.size:
            return
        now, many = again, many + 1


def _induced(text: np.ndarray, characters: int, seeds: Queue, cap: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    n = len(text)
    one = lambda a, b: int(_common(text, np.array([a]), np.array([b]), np.array([cap]))[0])
    larger, found = Queue(limit), Queue(limit)
    scan = _Scan(found, characters, cap)
    found.push(int(text[n - 1]), np.array([n - 1]), np.zeros(1, np.uint8))
    ends: dict[int, tuple[int, int]] = {}  # first and last place of a character's larger part
    for c in range(characters):
        scan.next_character()
        last = None
        for places, prefixes in _rounds(text, scan, c, limit, lambda before, c: before > c):
            larger.push(c, places, prefixes)
            ends[c] = (ends.get(c, (int(places[0]), 0))[0], int(places[-1]))
            last = int(places[-1])
        first = True
        for places, prefixes in seeds.take(c):
            if first:
                prefixes = prefixes.copy()
                prefixes[0] = one(last, int(places[0])) if last is not None else 0
                first = False
            before = text[places - 1].astype(np.int64)  # never the first place of the text: a larger suffix is before it
            scan.block(places, prefixes, before, before > c)
    smaller, found = Queue(limit), Queue(limit)
    scan = _Scan(found, characters, cap)
    least: dict[int, int] = {}  # the smallest suffix of a character's smaller part
    for c in range(characters - 1, -1, -1):
        scan.next_character()
        for places, prefixes in _rounds(text, scan, c, limit, lambda before, c: (before < c) & (before >= 0)):
            smaller.push(c, places, prefixes)
            least[c] = int(places[-1])
        carried = one(least[c], ends[c][1]) if c in least and c in ends else 0
        for places, prefixes in larger.take(c, backwards=True, keep=True):
            places, shifted = places[::-1], np.concatenate([[carried], prefixes[::-1][:-1]]).astype(np.uint8)
            carried = int(prefixes[0])
            before = np.where(places > 0, text[places - 1].astype(np.int64), -1)
            scan.block(places, shifted, before, (before < c) & (before >= 0))
    for c in range(characters):
        yield from larger.take(c)
        carried = one(least[c], ends[c][1]) if c in least and c in ends else 0
        for places, prefixes in smaller.take(c, backwards=True):
            yield places[::-1], np.concatenate([[carried], prefixes[::-1][:-1]]).astype(np.uint8)
            carried = int(prefixes[0])
