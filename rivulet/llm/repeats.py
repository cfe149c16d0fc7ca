"""Removal of byte strings that repeat across documents.

A byte goes if a string of `LEAST` bytes around it also starts in a document with a
smaller id. Where long strings may repeat is found by winnowing: of the `LEAST` bytes
at each place the hash of one short gram, the least, is the place's key, so equal
strings have equal keys. Keys of a single document are done with. The others bring
their surroundings together by key, and there a Burrows-Wheeler transform decides:
breadth-first backward extension visits the intervals of all strings by growing
length and sets a common prefix between neighbours when it first separates them.
It stops at `LEAST`: what is not separated by then repeats. A hot key, one whose
surroundings are too many for a transform, is split: its single strings of `LEAST`
bytes are dealt out by a hash, and a transform decides among those that meet there.
Hashes only bring bytes together; that two runs are equal is told by their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.chunks import answer, array_of, ask, by_part, expand, pack_chunks, part_count, squeeze, with_replies
from rivulet.llm.common import mapped
from rivulet.llm.subwords import span_hashes

LEAST = 50
GRAM = 20
PLACES = LEAST - GRAM + 1
_POSITION_BITS = np.uint64(24)
_NO_ID = np.iinfo(np.int64).max
_NONE = np.uint64(2**64 - 1)
# Text that one transform holds.
TRANSFORM_BYTES = 1_000_000
# A key with more distinct runs, which one transform could not hold, is hot.
HOT_RUNS = TRANSFORM_BYTES // (LEAST + PLACES - 1)


# Places that are worked on at once: what they need fits a core's cache.
BLOCK = 1 << 14


def _mixed(x: np.ndarray) -> np.ndarray:
    """`x` itself, mixed."""
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    return x


def _hashed(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The hash of a gram from its eight bytes at 0, 8 and 12; `a` is used up."""
    a = _mixed(a)
    a += b
    a = _mixed(a)
    a += c
    return _mixed(a)


def _gram_hashes(data: np.ndarray, places: np.ndarray | None = None) -> np.ndarray:
    """A hash of the `GRAM` bytes at each of these places, or at all that have so many."""
    places = np.arange(len(data) - GRAM + 1) if places is None else places
    if not len(places):
        return np.zeros(0, np.uint64)
    eights = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1))
    return _hashed(*(eights[places + k].view("<u8").ravel() for k in (0, 8, 12)))


def _chosen(data: np.ndarray) -> np.ndarray:
    """For each place with `LEAST` bytes the place of its least gram, the first of equal ones."""
    n = len(data) - LEAST + 1
    chosen = np.empty(n, dtype=np.int32 if n < 2**31 else np.int64)
    loaded, numbers = np.empty(BLOCK + 64, dtype="<u8"), np.arange(BLOCK + 64, dtype=np.uint64)
    for begin in range(0, n, BLOCK):
        end = min(begin + BLOCK, n)
        size = end - begin + PLACES - 1
        own = data[begin : end + LEAST - 1]
        for k in range(8):
            some = own[k : k + (len(own) - k) // 8 * 8].view("<u8")
            loaded[k : k + 8 * len(some) : 8] = some
        hashes = _hashed(loaded[:size].copy(), loaded[8 : 8 + size], loaded[12 : 12 + size])
        hashes >>= _POSITION_BITS
        hashes <<= _POSITION_BITS
        hashes |= numbers[:size]
        for step in (1, 2, 4, 8):
            hashes = np.minimum(hashes[:-step], hashes[step:])
        least = np.minimum(hashes[: end - begin], hashes[PLACES - 16 : PLACES - 16 + end - begin])
        least &= np.uint64(2**24 - 1)
        chosen[begin:end] = least
        chosen[begin:end] += begin
    return chosen


class Runs:
    """Runs of neighbouring places with one key: key, document, places [first, last].

    `marks`, from an earlier look at the same bytes, say where the runs are.
    """

    def __init__(self, data: np.ndarray, lengths: np.ndarray, marks: bytes | None = None):
        self.data = data
        self.first, self.last, chosen = _unmarked(marks) if marks is not None else self._found(data, lengths)
        self.key = _gram_hashes(data, chosen)
        self.doc = np.repeat(np.arange(len(lengths)), np.diff(np.searchsorted(self.first, np.cumsum(lengths)), prepend=0))
        self._chosen = chosen

    @staticmethod
    def _found(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first place, last place, place of the key's gram) of each run."""
        ends = np.cumsum(lengths)
        begins = ends - lengths
        n = len(data) - LEAST + 1
        if n <= 0:
            return (np.zeros(0, np.int64),) * 3
        valid = np.zeros(len(data) + 1, dtype=np.int8)
        long = lengths >= LEAST
        np.add.at(valid, begins[long], 1)
        np.add.at(valid, ends[long] - LEAST + 1, -1)
        valid = np.cumsum(valid[:n], dtype=np.int8) > 0
        chosen = _chosen(data)
        edge = np.ones(n + 1, dtype=bool)  # the end is one too
        edge[1:-1] = (chosen[1:] != chosen[:-1]) | ~valid[:-1]
        edge[begins[begins < n]] = True
        edge[:n] |= ~valid
        stop = np.flatnonzero(edge)
        begin = np.flatnonzero(valid[stop[:-1]])
        firsts = stop[begin]
        return firsts, stop[begin + 1] - 1, chosen[firsts].astype(np.int64)

    def marks(self) -> bytes:
        """Where the runs are, without their keys: gaps before them, their sizes, and how far the key's gram lies in them."""
        gaps = self.first - np.append(0, self.last[:-1] + 1)[: len(self.first)]
        sizes, offsets = self.last - self.first + 1, self._chosen - self.first
        return squeeze(gaps.astype("<u4").tobytes() + sizes.astype(np.uint8).tobytes() + offsets.astype(np.uint8).tobytes())

    def whole(self, which: np.ndarray) -> np.ndarray:
        """A hash of all bytes that the strings of each of these runs cover."""
        return span_hashes(self.data, self.first[which], self.last[which] + LEAST) ^ self.key[which]


def _unmarked(marks: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = expand(marks)
    n = len(raw) // 6
    gaps, sizes = np.frombuffer(raw, "<u4", n).astype(np.int64), np.frombuffer(raw, np.uint8, n, 4 * n).astype(np.int64)
    last = np.cumsum(gaps + sizes) - 1
    first = last - sizes + 1
    return first, last, first + np.frombuffer(raw, np.uint8, n, 5 * n)


def _marks(data: bytes, lengths: list[int]) -> bytes:
    return Runs(np.frombuffer(data, np.uint8), np.array(lengths, dtype=np.int64)).marks()


def _read(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.array([_NO_ID if i is None else i for i in row["doc_id"]], dtype=np.int64)
    return np.frombuffer(expand(row["data"]), dtype=np.uint8), np.array(row["lengths"], dtype=np.int64), ids


def _grouped(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, where each group begins in sorted order, and the values in that order."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(keys) else np.zeros(0, np.int64)
    return ordered[starts], starts, *[v[order] for v in values]


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Whether the spans at `a` and `b` hold the same bytes; each has eight bytes at least."""
    same = size_a == size_b
    if not len(same):
        return same
    eights = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1))
    for at in range(0, int(size_a.max()), 8):
        going = np.flatnonzero(same & (size_a > at))
        here = np.minimum(at, size_a[going] - 8)  # the last eight end with the span
        same[going] = (eights[a[going] + here].view(np.uint64) == eights[b[going] + here].view(np.uint64)).ravel()
    return same


def _alike(data: np.ndarray, names: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of spans in which equal ones stand together, and where each group begins.

    Their hashes `names` sort them; neighbours are compared by their bytes.
    """
    order = np.argsort(names, kind="stable")
    new = np.ones(len(order), dtype=bool)
    new[1:] = names[order[1:]] != names[order[:-1]]
    old = np.flatnonzero(~new)
    here, back = order[old], order[old - 1]
    unlike = old[~_equal(data, first[here], first[back], size[here], size[back])]
    if len(unlike):  # different bytes under one hash: sorted by the bytes
        group = np.cumsum(new)
        rows = np.flatnonzero(np.isin(group, group[unlike]))
        named = sorted((int(group[r]), data[first[i] : first[i] + size[i]].tobytes(), int(i)) for r, i in zip(rows, order[rows]))
        order[rows] = [i for _, _, i in named]
        new[rows] = [k == 0 or named[k][:2] != named[k - 1][:2] for k in range(len(named))]
    return order, np.flatnonzero(new)


def _ranges(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, number) of every number in the range [left, right) of each owner."""
    hits = right - left
    return np.repeat(np.arange(len(hits)), hits), np.arange(int(hits.sum())) - np.repeat(np.cumsum(hits) - hits - left, hits)


def _strings(data: np.ndarray, runs: Runs, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, document) of every string of these runs."""
    count = runs.last[which] - runs.first[which] + 1
    place = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count - runs.first[which], count)
    return span_hashes(data, place, place + LEAST), place, np.repeat(runs.doc[which], count)


def _ask_keys(parts: int):
    """Per part: distinct keys, whether two documents of the chunk share one, and how many
    distinct runs more than one a key has in the chunk, where it has more."""

    def requests(row: dict) -> Iterator[tuple[int, bytes]]:
        data, lengths, ids = _read(row)
        runs = Runs(data, lengths, row.get("marks"))
        keys, starts, doc, which = _grouped(runs.key, runs.doc, np.arange(len(runs.key)))
        if not len(keys):
            return
        shared = np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)
        # Only a key with several runs can have several distinct ones.
        often = np.diff(np.append(starts, len(which)))
        many = which[np.repeat(often > 1, often)]
        _, sample = np.unique(runs.whole(many), return_index=True)
        extra = np.where(often > 1, np.bincount(np.searchsorted(keys, runs.key[many[sample]]), minlength=len(keys)) - 1, 0)
        order, found, cuts = by_part(keys, parts)
        for part, a, b in zip(found.tolist(), cuts[:-1], cuts[1:]):
            own = order[a:b]
            more = np.flatnonzero(extra[own] > 0)
            counted = np.stack([more, extra[own][more]]).astype("<u4").tobytes()
            yield part, np.array([len(own)], "<i8").tobytes() + keys[own].tobytes() + np.packbits(shared[own]).tobytes() + counted

    return requests


def _answer_keys(blocks: list[bytes]) -> tuple[list[bytes], list[int]]:
    """Per block the keys that more than one document has, and those of them that are hot."""
    sizes = [int(np.frombuffer(b, "<i8", 1)[0]) for b in blocks]
    keys = np.concatenate([np.frombuffer(b, "<u8", n, 8) for b, n in zip(blocks, sizes)])
    tails = [(b[8 + 8 * n : 8 + 8 * n + (n + 7) // 8], b[8 + 8 * n + (n + 7) // 8 :]) for b, n in zip(blocks, sizes)]
    shared = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=n) for (t, _), n in zip(tails, sizes)]).astype(bool)
    runs = np.ones(len(keys), dtype=np.int64)
    for (_, counted), start in zip(tails, np.cumsum([0, *sizes])):
        more, extra = np.frombuffer(counted, "<u4").reshape(2, -1).astype(np.int64)
        runs[start + more] += extra
    order = np.argsort(keys, kind="stable")
    equal = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(keys), dtype=bool)
    again[order[1:]] |= equal
    again[order[:-1]] |= equal
    again |= shared
    # As many distinct runs as a key can have in all chunks together.
    begins = np.flatnonzero(np.append(True, ~equal))
    hot = np.empty(len(keys), dtype=bool)
    hot[order] = np.repeat(np.add.reduceat(runs[order], begins) > HOT_RUNS, np.diff(np.append(begins, len(keys))))
    hot &= again
    cuts = np.cumsum([0, *sizes])
    return [squeeze(np.packbits(np.append(again[a:b], hot[a:b])).tobytes()) for a, b in zip(cuts[:-1], cuts[1:])], []


def _ask_surroundings(parts: int):
    """Per part: distinct runs of repeated keys, and distinct strings of hot ones, each with
    the least and greatest id in the chunk."""

    def requests(row: dict) -> Iterator[tuple[int, bytes]]:
        data, lengths, ids = _read(row)
        runs = Runs(data, lengths, row.get("marks"))
        keys = np.unique(runs.key)
        order, found, cuts = by_part(keys, parts)
        bits = {r["part"]: r["reply"] for r in row["replies"] or ()}
        again, hot = np.zeros((2, len(keys)), dtype=bool)
        for part, a, b in zip(found.tolist(), cuts[:-1], cuts[1:]):
            again[order[a:b]], hot[order[a:b]] = np.unpackbits(array_of(bits[part], "u1"), count=2 * (b - a)).astype(bool).reshape(2, -1)
        at = np.searchsorted(keys, runs.key)
        own = np.flatnonzero(again[at] & ~hot[at])
        order, starts = _alike(data, runs.whole(own), runs.first[own], runs.last[own] - runs.first[own] + LEAST)
        low, high = _ends(ids[runs.doc[own[order]]], starts)
        sample = own[order[starts]]
        key, first, size = runs.key[sample], runs.first[sample], runs.last[sample] - runs.first[sample] + LEAST
        line, place, doc = _strings(data, runs, np.flatnonzero(hot[at]))
        order, starts = _alike(data, line, place, np.full(len(line), LEAST))
        line_low, line_high = _ends(ids[doc[order]], starts)
        line, place = line[order[starts]], place[order[starts]]
        runs_of, lines_of = _dealt(key, parts), _dealt(line, parts)
        none = np.zeros(0, np.int64)
        for part in sorted({*runs_of, *lines_of}):
            at, lines = runs_of.get(part, none), lines_of.get(part, none)
            total = int(size[at].sum())
            offsets = np.cumsum(size[at]) - size[at]
            take = np.arange(total) - np.repeat(offsets - first[at], size[at])
            head = np.array([len(at), len(lines)], dtype="<i8").tobytes()
            head += line_low[lines].tobytes() + line_high[lines].tobytes() + place[lines].astype("<u4").tobytes()
            head += data[place[lines][:, None] + np.arange(LEAST)].tobytes()
            body = key[at].tobytes() + low[at].tobytes() + high[at].tobytes() + first[at].astype("<u4").tobytes()
            yield part, squeeze(head + body + size[at].astype(np.uint8).tobytes() + data[take].tobytes())

    return requests


def _ends(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest value of each group."""
    if not len(starts):
        return values[:0], values[:0]
    return np.minimum.reduceat(values, starts), np.maximum.reduceat(values, starts)


def _dealt(keys: np.ndarray, parts: int) -> dict[int, np.ndarray]:
    """Where the keys of each part are."""
    part = (keys % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    found, cuts = np.unique(part[order], return_index=True)
    return {p: order[a:b] for p, a, b in zip(found.tolist(), cuts, np.append(cuts[1:], len(order)))}


def prefix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of `text` (numbers below 512) sorted by their first `depth` signs at least; the
    order of those that share more is left open."""
    n = len(text)
    padded = np.concatenate([text.astype(np.int64), np.zeros(7, np.int64)])
    key = padded[:n].copy()
    for i in range(1, 7):
        key = (key << 9) | padded[i : n + i]
    reach = 7
    while True:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.append(0, ordered[1:] != ordered[:-1]))
        if reach >= depth:
            return order
        follows = np.zeros(n, dtype=np.int64)
        follows[: max(n - reach, 0)] = rank[reach:] + 1
        key = rank * (n + 1) + follows
        reach *= 2


def separated(text: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """Whether each suffix, in sorted order, shares fewer than `least` signs with the one before.

    Intervals of all strings of one length are extended to the left by one sign at a
    time. The string's right neighbour in the order shares one sign less than the
    string is long, unless a shorter string has separated the two; only an interval that
    separates for the first time is extended further.
    """
    n = len(text)
    before = text[order - 1].astype(np.uint16)  # the transform; the first sign follows the last
    moved = np.empty(n, dtype=np.int64)
    moved[np.argsort(before, kind="stable")] = np.arange(n)
    head = text[order]
    known = np.zeros(n + 1, dtype=bool)
    known[0] = known[n] = True
    low, high = np.zeros(1, np.int64), np.full(1, n - 1)
    for _ in range(least):
        sizes = high - low + 1
        if not len(sizes):
            break
        starts = np.cumsum(sizes) - sizes
        rows = np.arange(int(sizes.sum())) - np.repeat(starts - low, sizes)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        to = moved[rows]
        if len(rows) < n:
            by = np.argsort(to)
            to, owner = to[by], owner[by]
        else:
            back = np.empty(n, dtype=np.int64)
            back[to] = owner
            to, owner = np.arange(n), back
        new = np.append(True, (owner[1:] != owner[:-1]) | (head[to[1:]] != head[to[:-1]]))
        begin = np.flatnonzero(new)
        low, high = to[begin], to[np.append(begin[1:], len(to)) - 1]
        fresh = ~known[high + 1]
        known[high[fresh] + 1] = True
        low, high = low[fresh], high[fresh]
    return known[:n]


def least_ids(segments: list[np.ndarray], ids: np.ndarray, least: int = LEAST) -> list[np.ndarray]:
    """For each place of each segment, the least id of a segment with the same `least` bytes."""
    sizes = np.array([len(s) for s in segments])
    text = np.zeros(int(sizes.sum()) + len(sizes), dtype=np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    inside = np.ones(len(text), dtype=bool)
    inside[starts + sizes] = False
    text[inside] = np.concatenate(segments).astype(np.int64) + 1
    whole = np.zeros(len(text) + 1, dtype=np.int64)
    np.add.at(whole, starts, 1)
    np.add.at(whole, starts + sizes - least + 1, -1)
    owner = np.repeat(ids, sizes + 1)
    owner = np.where(np.cumsum(whole[:-1]) > 0, owner, _NO_ID)
    order = prefix_order(text, least)
    groups = np.flatnonzero(separated(text, order, least))
    lowest = np.minimum.reduceat(owner[order], groups)
    found = np.empty(len(text), dtype=np.int64)
    found[order] = np.repeat(lowest, np.diff(np.append(groups, len(text))))
    return [found[s : s + n - least + 1] for s, n in zip(starts.tolist(), sizes.tolist())]


def _batches(sizes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of whole groups, of `TRANSFORM_BYTES` at most unless one group has more."""
    total = np.append(0, np.cumsum(sizes))
    begin = 0
    for a, b in zip(starts, np.append(starts[1:], len(sizes))):
        if a > begin and total[b] - total[begin] > TRANSFORM_BYTES:
            yield begin, a
            begin = a
    if len(sizes) > begin:
        yield begin, len(sizes)


def _decide_strings(strings: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each single string (a row of `LEAST` bytes) the least id among its equals."""
    least = ids.copy()
    name = span_hashes(strings.ravel(), np.arange(len(strings)) * LEAST, np.arange(1, len(strings) + 1) * LEAST)
    order = np.argsort(name, kind="stable")
    new = np.append(True, name[order[1:]] != name[order[:-1]])
    met = ~(new & np.append(new[1:], True))  # others have no string to be equal to
    order, starts = order[met], np.flatnonzero(new[met])
    for a, b in _batches(np.full(len(order), LEAST), starts):
        own = order[a:b]
        least[own] = np.concatenate(least_ids(list(strings[own]), ids[own]))
    return least


def _answer_surroundings(blocks: list[bytes]) -> tuple[list[bytes], list[int]]:
    """Per block: for each of its runs, which places a document with a smaller id has too;
    then the strings of hot keys that such a document has."""
    columns: list[list[np.ndarray]] = [[], [], [], [], []]
    texts, counts, lines = [], [], []
    for block in blocks:
        raw = expand(block)
        n, n_lines = np.frombuffer(raw, "<i8", 2).tolist()
        at = 16 + 20 * n_lines
        ends = np.frombuffer(raw, "<i8", 2 * n_lines, 16).reshape(2, -1)
        lines.append((*ends, np.frombuffer(raw, "<u4", n_lines, at - 4 * n_lines), np.frombuffer(raw, np.uint8, LEAST * n_lines, at).reshape(-1, LEAST)))
        at += LEAST * n_lines
        for i, kind in enumerate(("<u8", "<i8", "<i8", "<u4", "u1")):
            columns[i].append(np.frombuffer(raw, kind, n, at))
            at += n * columns[i][-1].itemsize
        texts.append(np.frombuffer(raw, np.uint8, -1, at))
        counts.append(n)
    key, low, high, asked, size = (np.concatenate(c) for c in columns)
    size = size.astype(np.int64)
    text = np.concatenate(texts)
    line_low, line_high, line_asked, strings = (np.concatenate(c) for c in zip(*lines))
    line_least = _decide_strings(strings, line_low) if len(strings) else line_low
    start = np.cumsum(size) - size
    order, groups = _alike(text, span_hashes(text, start, start + size) ^ key, start, size)
    first = order[groups]
    lowest, highest = _ends(low[order], groups)[0], _ends(high[order], groups)[1]
    inverse = np.empty(len(order), dtype=np.int64)
    inverse[order] = np.repeat(np.arange(len(first)), np.diff(np.append(groups, len(order))))
    order = np.argsort(key[first], kind="stable")
    ordered = key[first][order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    alone = new & np.append(new[1:], True)[: len(new)]
    # Answers per distinct run: (first place, last place, least id).
    run_of, place_a, place_b, least_id = [], [], [], []
    order, alone, new = order[~alone], order[alone], new[~alone]  # alone: nothing but equal runs under the key
    run_of.append(alone)
    place_a.append(np.zeros(len(alone), np.int64))
    place_b.append(size[first[alone]] - LEAST)
    least_id.append(lowest[alone])

    def decide(members: np.ndarray) -> None:
        segments = [text[start[first[m]] : start[first[m]] + size[first[m]]] for m in members]
        found = least_ids(segments, lowest[members])
        many = np.concatenate(found)
        owner = np.repeat(members, [len(f) for f in found])
        place = np.concatenate([np.arange(len(f)) for f in found])
        new = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (many[1:] != many[:-1])))
        last = np.append(new[1:], len(many)) - 1
        run_of.append(owner[new])
        place_a.append(place[new])
        place_b.append(place[last])
        least_id.append(many[new])

    for i, j in _batches(size[first[order]], np.flatnonzero(new)):
        decide(order[i:j])
    run, a, b, least = (np.concatenate(c) for c in (run_of, place_a, place_b, least_id))
    useful = least < highest[run]
    run, a, b, least = run[useful], a[useful].astype(np.uint8), b[useful].astype(np.uint8), least[useful]
    by = np.argsort(run, kind="stable")
    run, a, b, least = run[by], a[by], b[by], least[by]
    replies, cuts = [], np.cumsum([0, *counts])
    line_cuts = np.cumsum([0, *[len(x[0]) for x in lines]])
    for i, j, k, m in zip(cuts[:-1], cuts[1:], line_cuts[:-1], line_cuts[1:]):
        own, at = _ranges(np.searchsorted(run, inverse[i:j]), np.searchsorted(run, inverse[i:j], side="right"))
        mine = least[at] < high[i:j][own]
        own, at = own[mine], at[mine]
        use = line_least[k:m] < line_high[k:m]
        head = np.array([len(own), use.sum()], dtype="<i8").tobytes() + line_asked[k:m][use].tobytes() + line_least[k:m][use].tobytes()
        replies.append(squeeze(head + asked[i:j][own].tobytes() + least[at].tobytes() + a[at].tobytes() + b[at].tobytes()))
    return replies, []


def _covered(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(data, lengths, removed mask) of a chunk with its answers."""
    data, lengths, ids = _read(row)
    runs = Runs(data, lengths, row.get("marks"))
    columns: list[list[np.ndarray]] = [[], [], [], []]
    lines = []
    for reply in row["replies"] or ():
        raw = expand(reply["reply"])
        n, n_lines = np.frombuffer(raw, "<i8", 2).tolist()
        lines.append((np.frombuffer(raw, "<u4", n_lines, 16), np.frombuffer(raw, "<i8", n_lines, 16 + 4 * n_lines)))
        at = 16 + 12 * n_lines
        for i, kind in enumerate(("<u4", "<i8", "u1", "u1")):
            columns[i].append(np.frombuffer(raw, kind, n, at))
            at += n * columns[i][-1].itemsize
    change = np.zeros(len(data) + 1, dtype=np.int32)
    if lines:
        place, least, a, b = (np.concatenate(c).astype(np.int64) for c in columns)
        whole, size = runs.whole(np.arange(len(runs.key))), runs.last - runs.first + LEAST
        sample = np.searchsorted(runs.first, place)
        order = np.argsort(whole[sample], kind="stable")
        sample, least, a, b = sample[order], least[order], a[order], b[order]
        run, at = _ranges(np.searchsorted(whole[sample], whole), np.searchsorted(whole[sample], whole, side="right"))
        smaller = least[at] < ids[runs.doc[run]]
        run, at = run[smaller], at[smaller]
        same = _equal(data, runs.first[run], runs.first[sample[at]], size[run], size[sample[at]])
        run, at = run[same], at[same]
        np.add.at(change, runs.first[run] + a[at], 1)
        np.add.at(change, runs.first[run] + b[at] + LEAST, -1)
        asked, least = (np.concatenate(c).astype(np.int64) for c in zip(*lines))
        # Equal strings have equal keys.
        keys = np.unique(runs.key[np.searchsorted(runs.first, asked, side="right") - 1])
        own, place, doc = _strings(data, runs, np.flatnonzero(np.isin(runs.key, keys)))
        line = span_hashes(data, asked, asked + LEAST)
        order = np.argsort(line, kind="stable")
        line, asked, least = line[order], asked[order], least[order]
        string, at = _ranges(np.searchsorted(line, own), np.searchsorted(line, own, side="right"))
        gone = least[at] < ids[doc[string]]
        string, at = string[gone], at[gone]
        every = np.full(len(at), LEAST)
        gone = place[string[_equal(data, place[string], asked[at], every, every)]]
        np.add.at(change, gone, 1)
        np.add.at(change, gone + LEAST, -1)
    return data, lengths, np.cumsum(change[:-1], dtype=np.int32) > 0


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep_text: bool = False) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and, if
    asked for, `kept`, the remaining bytes).

    Strings are judged on the input. NULL text is empty. NULL ids count as greater than
    all others. Rows that share an id do not remove each other's bytes. An empty table
    gives an empty result; other columns are not looked at.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    chunks = pack_chunks(rows, marks=_marks)  # runs are looked for once
    parts = part_count(chunks)
    texts = chunks.select("chunk", "doc_id", "lengths", "data", "marks")
    found = answer(ask(texts, _ask_keys(parts)), _answer_keys)
    around = answer(ask(with_replies(texts, found), _ask_surroundings(parts)), _answer_surroundings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                data, lengths, gone = _covered(row)
                out, at = [], 0
                for doc_id, n in zip(row["doc_id"], lengths.tolist()):
                    own, mask = data[at : at + n], gone[at : at + n]
                    at += n
                    spans = int(np.count_nonzero(mask[1:] & ~mask[:-1])) + int(n > 0 and mask[0])
                    kept = own[~mask].tobytes()
                    out.append((doc_id, n, int(mask.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
                columns = list(zip(*out)) if out else [[]] * 6
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
                width = 6 if keep_text else 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns[:width], kinds)], names=schema.names)

    schema = T.StructType()
    for name in ("doc_id", "n_bytes", "n_removed", "n_spans"):
        schema.add(name, T.LongType())
    schema.add("kept_sha256", T.StringType())
    if keep_text:
        schema.add("kept", T.BinaryType())
    return mapped(with_replies(texts, around), run, schema)
