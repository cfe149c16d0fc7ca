"""Personal data: exact base patterns, and a boosted model over wider candidates.

Generators of high recall propose overlapping spans (masked or spaced addresses,
numbers in unusual grouping). Boosted trees judge their format and context; the
scores are calibrated, and a threshold per kind, set for precision on rows that were
not trained on, selects what is added to the base spans.

All documents are learned from. Spark counts equal training rows once by their features
and once more by the bins of these; each level of a tree is then a sum over those rows,
added up by Spark as whole numbers, so the order in which they come changes nothing.

There are no labels for spans. Base spans and rewritten forms of them are positive;
negative are base spans broken on purpose (check digit, range of parts, a number for a
host) and numbers that are clearly something else. Other candidates apart from base
spans may be personal data in another form, so they have no label.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import filled, mapped, slices, stored

KINDS = ("email", "ip", "card", "phone")
# `drawn_rows` takes at most so many rows of one document.
DOCUMENT_ROWS = 60
FEATURES = 22
HELD_ROWS = 50_000  # distinct training rows that a task holds before it hands them on
FIXED = 1 << 20  # gradients are added up as whole multiples of 1 / FIXED
# Scores that set calibration and thresholds are counted by steps of 1 / FINE, up to FARTHEST either way.
FINE, FARTHEST = 64, 32
PRECISION = 0.98
# The threshold of a kind with fewer than `LEAST_ROWS` rows to set it by.
FALLBACK, LEAST_ROWS = 0.95, 20
CONTEXT = 32

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each address has its first @ after a run of local signs, so it is found from there."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """Spans of the exact patterns, by kind, then start."""
    out = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NO_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return out


_AT = re.compile(r"@|[\[({]\x20?at\x20?[\])}]", re.I)
_BEFORE = re.compile(r"[\w.%+-]{1,64}\x20?$")
_AFTER = re.compile(r"\x20?[\w-]{1,63}(?:\x20?(?:\.|[\[({]\x20?dot\x20?[\])}])\x20?[\w-]{1,63}){1,8}", re.I)
_GENERATORS = (
    (1, re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\x20?\.\x20?|\[\.\])[0-9]{1,3}){3}(?![0-9])")),
    (2, re.compile(r"(?<![0-9])[0-9](?:[\x20._/-]{0,2}[0-9]){15,18}(?![0-9])")),
    (3, re.compile(r"(?<![0-9])(?:\+|00)?\x20?\(?[0-9](?:[\x20()./-]{0,3}[0-9]){6,14}(?![0-9])")),
)


def candidates(text: str) -> list[Span]:
    """What may be personal data; spans may overlap. Letters next to an @, or digits."""
    out = []
    if "@" in text or "at" in text or "AT" in text:
        for m in _AT.finditer(text):
            before = _BEFORE.search(text[max(0, m.start() - 65) : m.start()])
            after = _AFTER.match(text, m.end())
            if before and after:
                out.append((0, m.start() - len(before[0]), after.end()))
    if _DIGIT.search(text):
        for kind, pattern in _GENERATORS:
            out.extend((kind, m.start(), m.end()) for m in pattern.finditer(text))
    return out


_HINTS = (
    re.compile(r"mail|contact|write", re.I),
    re.compile(r"\bip\b|host|server|address", re.I),
    re.compile(r"card|visa|payment|credit", re.I),
    re.compile(r"phone|tel|call|fax|mobile", re.I),
)


def features(text: str, span: Span) -> list[float]:
    """Format and context of a candidate."""
    kind, start, end = span
    body = text[start:end]
    digits = _NO_DIGIT.sub("", body)
    parts = [len(p) for p in re.findall(r"[0-9]+", body)] or [0]
    numbers = [int(p) for p in re.findall(r"[0-9]+", body)][:8] or [0]
    before, after = text[max(0, start - 1) : start], text[end : end + 1]
    near = text[max(0, start - CONTEXT) : start]
    return [
        float(kind),
        float(len(body)),
        float(len(digits)),
        float(sum(c.isalpha() for c in body)),
        float(len(set(digits))),
        float(luhn(digits)) if digits else 0.0,
        float(min(max(numbers), 10_000)),
        float(len(parts)),
        float(parts[0]),
        float(parts[-1]),
        float(max(parts)),
        float("+" in body),
        float("@" in body),
        float("(" in body or "[" in body),
        float(body.count(".")),
        float(body.count(" ")),
        float(body.count("-")),
        float(before.isalnum()),
        float(after.isalnum()),
        float(before in "$€#.,=/"),
        float(bool(_HINTS[kind].search(near))),
        float(sum(c.isdigit() for c in near)),
    ]


def _rewritten(kind: int, body: str) -> list[tuple[str, int]]:
    """Other forms of a base span: (text, 1 if it still is personal data)."""
    digits = _NO_DIGIT.sub("", body)
    if kind == 0:
        name, _, host = body.partition("@")
        masked = [(f"{name} [at] {host.replace('.', ' [dot] ')}", 1), (f"{name}(at){host}", 1), (f"{name} @ {host}", 1)]
        return [*masked, (f"{name} @ {len(name)}.50", 0), (f"{name} (at) {len(host)}.30", 0)]
    if kind == 1:
        parts = body.split(".")
        return [("[.]".join(parts), 1), (" . ".join(parts), 1), (".".join(["9" + parts[0].zfill(2), *parts[1:]]), 0)]
    if kind == 2:
        wrong = digits[:-1] + str((int(digits[-1]) + 3) % 10)
        dotted = [".".join(d[i : i + 4] for i in range(0, len(d), 4)) for d in (digits, wrong)]
        return [(dotted[0], 1), (dotted[0].replace(".", "/"), 1), (dotted[1], 0), (wrong, 0)]
    return [(body.lstrip("+"), 1), ("00" + body.lstrip("+"), 1), (digits, 0), (digits[:4] + "." + digits[4:], 0)]


_DATE = re.compile(r"(?:19|20)[0-9]{2}[-./][0-9]{1,2}[-./][0-9]{1,2}(?![0-9])|[0-9]{1,2}[-./][0-9]{1,2}[-./](?:19|20)[0-9]{2}(?![0-9])")
_DECIMAL = re.compile(r"[0-9]+\.[0-9]+")


def _something_else(text: str, span: Span) -> bool:
    """Whether a candidate clearly is no personal data: its numbers cannot be those of its kind."""
    kind, start, end = span
    body = text[start:end]
    if kind == 0:
        return re.split(r"[^\w-]+", body.rstrip(" ])}"))[-1].isdecimal()
    if kind == 1:
        return any(int(n) > 255 for n in re.findall(r"[0-9]+", body))
    if kind == 2:
        return not luhn(_NO_DIGIT.sub("", body))
    around = text[max(0, start - 1) : start] + text[end : end + 1]
    return bool(_DATE.match(body) or _DECIMAL.fullmatch(body)) or any(c.isalpha() or c in "$€£_#%=" for c in around)


def training_rows(text: str) -> Iterator[tuple[list[float], int]]:
    base = base_spans(text)
    for span in candidates(text):
        touching = [k for k, s, e in base if s < span[2] and span[1] < e]
        if not touching:
            if _something_else(text, span):
                yield features(text, span), 0
        elif span in base:
            yield features(text, span), 1
    for (kind, start, end) in base:
        left, right = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
        for body, good in _rewritten(kind, text[start:end]):
            changed = left + body + right
            for span in candidates(changed):
                if span[0] == kind and span[1] < len(left) + len(body) and len(left) < span[2]:
                    exact = span[1] >= len(left) and span[2] <= len(left) + len(body) + 1
                    yield features(changed, span), int(good and exact)


def drawn_rows(text: str) -> list[tuple[tuple[list[float], int], int]]:
    """`DOCUMENT_ROWS` of a document's training rows at most, each with a random number."""
    rows, rng = list(training_rows(text)), np.random.default_rng(zlib.crc32(text.encode()))
    drawn = rng.permutation(len(rows))[:DOCUMENT_ROWS]
    return [(rows[i], p) for i, p in zip(drawn.tolist(), rng.integers(0, 2**62, len(drawn)).tolist())]


Count = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _row(x: list[float]) -> tuple[bytes, bool]:
    """The features of a row, all small whole numbers, and whether it is kept from training."""
    packed = np.minimum(x, 65_535).astype("<u2").tobytes()
    return packed, zlib.crc32(packed) % 4 == 3


def _binned(edges: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """Bins of the features; the kind comes last, as it is."""
    columns = [np.searchsorted(e, c, side="right") for e, c in zip(edges, x.T)]
    return np.stack([*columns, x[:, 0]], axis=1).astype(np.int64)


class ListedRows:
    """Training rows of a list, equal ones counted."""

    def __init__(self, rows: list[tuple[list[float], int]]):
        seen = Counter((*_row(x), int(y)) for x, y in rows)
        self.x = np.frombuffer(b"".join(x for x, _, _ in seen), "<u2").reshape(-1, FEATURES).astype(np.int64)
        self.held = np.array([h for _, h, _ in seen], bool)
        self.y, self.n = np.array([y for _, _, y in seen], np.int64), np.array(list(seen.values()), np.int64)

    def total(self, count: Count) -> np.ndarray:
        """The sum of `count(x, y, n, held)` over all rows."""
        return count(self.x, self.y, self.n, self.held)

    def binned(self, edges: list[np.ndarray]) -> ListedRows:
        made = ListedRows([])
        made.x, made.y, made.n, made.held = _binned(edges, self.x), self.y, self.n, self.held
        return made


class CountedRows:
    """The same as a table of Spark (x, held, y, n), whose features are numbers of `kind`."""

    def __init__(self, df: DataFrame, kind: str = "<u2", width: int = FEATURES):
        self.df, self.kind, self.width = df, kind, width

    def total(self, count: Count) -> np.ndarray:
        kind, width = self.kind, self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = sum(count(*_arrays(b, kind, width)) for b in batches if b.num_rows)
            cells = np.flatnonzero(sums) if isinstance(sums, np.ndarray) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(sums[cells] if len(cells) else cells)], names=["cell", "n"])

        table = mapped(self.df, run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        sums = count(*(np.zeros(shape, np.int64) for shape in ((0, width), 0, 0)), np.zeros(0, bool))
        sums[table.column("cell").to_numpy()] = table.column("n").to_numpy()
        return sums

    def binned(self, edges: list[np.ndarray]) -> CountedRows:
        kind, width = self.kind, self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _binned(edges, _arrays(batch, kind, width)[0]).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), *batch.columns[1:]], names=batch.schema.names)

        return CountedRows(_summed(mapped(self.df, run, self.df.schema)), "u1", width + 1)


def _arrays(batch: pa.RecordBatch, kind: str, width: int) -> tuple[np.ndarray, ...]:
    x = np.frombuffer(b"".join(batch.column("x").to_pylist()), kind).reshape(-1, width).astype(np.int64)
    held = batch.column("held").to_numpy(zero_copy_only=False)
    return x, batch.column("y").to_numpy().astype(np.int64), batch.column("n").to_numpy(), held


def _summed(rows: DataFrame) -> DataFrame:
    return stored(rows.groupBy("x", "held", "y").agg(F.sum("n").alias("n")), "pii-rows")


def _outcomes(x: np.ndarray, y: np.ndarray, n: np.ndarray, held: np.ndarray) -> np.ndarray:
    return np.bincount(y + 2 * held, n, 4).astype(np.int64)


def _values(x: np.ndarray, y: np.ndarray, n: np.ndarray, held: np.ndarray) -> np.ndarray:
    """How often each feature has each value, in the rows to train on."""
    cells = np.arange(FEATURES) * 65_536 + x[~held]
    return np.bincount(cells.ravel(), np.repeat(n[~held], FEATURES), FEATURES * 65_536).astype(np.int64)


class Boosted:
    """Gradient-boosted regression trees on the logistic loss, of fixed depth, over binned features."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32):
        self.trees, self.depth, self.rate, self.bins = trees, depth, rate, bins

    def fit(self, rows: ListedRows | CountedRows) -> tuple[Boosted, ListedRows | CountedRows]:
        """Learns from the rows that are not held; returns itself, and all rows by their bins."""
        self.edges = [self._edges(c) for c in rows.total(_values).reshape(FEATURES, -1)]
        rows = rows.binned(self.edges)
        bad, good = rows.total(_outcomes)[:2]
        mean = good / max(good + bad, 1)
        self.start, self.forest = float(np.log((mean + 1e-6) / (1 - mean + 1e-6))), []
        for _ in range(self.trees):
            self.forest.append(self._grow(rows))
        return self, rows

    def _edges(self, often: np.ndarray) -> np.ndarray:
        """Between all values of a feature if they are few, else at its quantiles."""
        values = np.flatnonzero(often)
        if len(values) <= self.bins:
            return values[1:].astype(float)
        below = np.cumsum(often[values])
        return np.unique(values[np.searchsorted(below, below[-1] * np.linspace(0, 1, self.bins + 1)[1:-1])]).astype(float)

    def _grow(self, rows: ListedRows | CountedRows) -> list:
        """Splits level by level; a tree is a list of levels of (feature, bin) per node, then leaf values."""
        levels, width = [], self.bins + 1
        for level in range(self.depth):
            sums = rows.total(partial(self._sums, levels))
            many, cells = sums[: 2**level], sums[2**level :].reshape(2, 2**level, FEATURES, width) / FIXED
            splits, leaves = [], []
            for at in range(2**level):
                g_all, h_all = cells[:, at, 0].sum(axis=1)
                best, left = (1e-9, 0, width), (g_all, h_all)
                if many[at] >= 20:
                    g, h = np.cumsum(cells[:, at], axis=2)[..., :-1]
                    gain = g**2 / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all**2 / (h_all + 1)
                    f, cut = divmod(int(gain.argmax()), width - 1)
                    if gain[f, cut] > best[0]:
                        best, left = (float(gain[f, cut]), f, cut), (g[f, cut], h[f, cut])
                splits.append(best[1:])
                leaves += [left[0] / (left[1] + 1), (g_all - left[0]) / (h_all - left[1] + 1)]
            levels.append(np.array(splits))
        return [levels, self.rate * np.array(leaves)]

    def _sums(self, levels: list, x: np.ndarray, y: np.ndarray, n: np.ndarray, held: np.ndarray) -> np.ndarray:
        """Rows per node below these levels; gradients and curvatures per node, feature and bin."""
        x, y, n = x[~held], y[~held], n[~held]
        p = 1 / (1 + np.exp(-self.binned_score(x)))
        node, width = np.zeros(len(x), dtype=np.int64), self.bins + 1
        for splits in levels:
            node = self._descend(node, splits, x)
        nodes = 2 ** len(levels)
        cells = ((node[:, None] * FEATURES + np.arange(FEATURES)) * width + x[:, :FEATURES]).ravel()
        sums = [np.bincount(node, n, nodes)]
        for value in (y - p, p * (1 - p)):
            sums.append(np.bincount(cells, np.repeat(np.rint(value * FIXED) * n, FEATURES), nodes * FEATURES * width))
        return np.concatenate(sums).astype(np.int64)

    @staticmethod
    def _descend(node: np.ndarray, splits: np.ndarray, binned: np.ndarray) -> np.ndarray:
        return node * 2 + (binned[np.arange(len(node)), splits[node, 0]] > splits[node, 1])

    def _apply(self, tree: list, binned: np.ndarray) -> np.ndarray:
        node = np.zeros(len(binned), dtype=np.int64)
        for splits in tree[0]:
            node = self._descend(node, splits, binned)
        return tree[1][node]

    def binned_score(self, binned: np.ndarray) -> np.ndarray:
        return self.start + sum((self._apply(t, binned) for t in self.forest), np.zeros(len(binned)))

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.binned_score(_binned(self.edges, x))

    def held_scores(self, x: np.ndarray, y: np.ndarray, n: np.ndarray, held: np.ndarray) -> np.ndarray:
        """Held rows by kind, outcome and step of their score."""
        x, y, n = x[held], y[held], n[held]
        step = np.rint(np.clip(self.binned_score(x), -FARTHEST, FARTHEST) * FINE).astype(np.int64) + FARTHEST * FINE
        size = 2 * FARTHEST * FINE + 1
        return np.bincount((x[:, -1] * 2 + y) * size + step, n, len(KINDS) * 2 * size).astype(np.int64)


class Detector:
    """The trained model with its calibration and a threshold per kind (2: adds nothing)."""

    def __init__(self, rows: list[tuple[list[float], int]] | ListedRows | CountedRows):
        rows = ListedRows(rows) if isinstance(rows, list) else rows
        self.model, self.thresholds = None, [2.0] * len(KINDS)
        counts = rows.total(_outcomes).reshape(2, 2)
        if counts.sum() < 200 or not counts[0].all() or not counts.sum(axis=0).all():
            return
        self.model, rows = Boosted().fit(rows)
        held = rows.total(self.model.held_scores).reshape(len(KINDS), 2, -1)
        steps = np.arange(-FARTHEST * FINE, FARTHEST * FINE + 1) / FINE
        self.slope, self.shift = self._calibrate(steps, *held.sum(axis=0).astype(float))
        least = 1 / (1 + np.exp(-np.clip(self.slope * (steps - 0.5 / FINE) + self.shift, -50, 50)))
        for kind, (bad, good) in enumerate(held):
            if (bad + good).sum() < LEAST_ROWS:
                self.thresholds[kind] = FALLBACK
                continue
            here = np.flatnonzero(bad + good)
            order = here[np.argsort(-least[here], kind="stable")]
            precise = order[np.cumsum(good[order]) >= PRECISION * np.cumsum((bad + good)[order])]
            if len(precise):
                self.thresholds[kind] = max(float(least[precise[-1]]), 0.5)

    @staticmethod
    def _calibrate(score: np.ndarray, bad: np.ndarray, good: np.ndarray) -> tuple[float, float]:
        """Logistic regression of the outcome on the score, by Newton steps over counted scores."""
        w = np.array([1.0, 0.0])
        x = np.stack([score, np.ones_like(score)], axis=1)
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
            hessian = x.T @ (x * (p * (1 - p) * (bad + good))[:, None]) + 1e-3 * np.eye(2)
            w = w + np.linalg.solve(hessian, x.T @ (good - p * (bad + good)) - 1e-3 * (w - [1.0, 0.0]))
        return float(w[0]), float(w[1])

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.model.score(x) + self.shift, -50, 50)))

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Candidates over the threshold that touch no base span and no better candidate."""
        if self.model is None:
            return []
        found = candidates(text)
        if not found:
            return []
        # Base spans of one kind never overlap, so per kind a neighbour search is enough.
        taken = [sorted((s, e) for k, s, e in base if k == kind) for kind in range(len(KINDS))] + [[]]
        free = [c for c in found if not any(_touches(t, c[1], c[2]) for t in taken)]
        if not free:
            return []
        p = self.probability(np.array([features(text, c) for c in free]))
        out = []
        for at in np.lexsort(([c[1] for c in free], -p)):
            kind, start, end = free[at]
            if p[at] >= self.thresholds[kind] and not _touches(taken[-1], start, end):
                insort(taken[-1], (start, end))
                out.append(free[at])
        return out


def _touches(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether one of these sorted, disjoint spans overlaps [start, end)."""
    at = bisect_left(spans, (end,))
    return at > 0 and spans[at - 1][1] > start


def training_counts(docs: DataFrame) -> CountedRows:
    """The training rows of all documents of (doc_id, text), equal ones counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def made():
            columns = [pa.array([k[i] for k in seen], t) for i, t in enumerate((pa.binary(), pa.bool_(), pa.int32()))]
            return pa.RecordBatch.from_arrays([*columns, pa.array(list(seen.values()), pa.int64())], names=["x", "held", "y", "n"])

        for batch in slices(batches, "text"):
            for text in batch.column("text"):
                for x, y in training_rows(text.as_py()):
                    seen[*_row(x), y] += 1
                    if len(seen) > HELD_ROWS:
                        yield made()
                        seen.clear()
        if seen:
            yield made()

    return CountedRows(_summed(mapped(docs, run, "x binary, held boolean, y int, n long")))


def train_detector(docs: DataFrame) -> Detector:
    """From (doc_id, text): all documents, each row of them counted, repeated ones too."""
    return Detector(training_counts(docs))


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def find_personal_data(docs: DataFrame, detector: Detector) -> DataFrame:
    """One row per row of (doc_id, text): n_email, n_ip, n_card, n_phone (base spans),
    base_sha256, spans (base and added ones), n_added.

    NULL text is empty: no spans. Positions are code points, ends exclusive.
    """

    schema = T.StructType([docs.schema["doc_id"]])
    for name, kind in [*[(f"n_{k}", T.LongType()) for k in KINDS], ("base_sha256", T.StringType()), ("spans", T.StringType()), ("n_added", T.LongType())]:
        schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts, hashes, listed, more = [], [], [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                extra = detector.added(text, base)
                counts.append([sum(k == kind for k, _, _ in base) for kind in range(len(KINDS))])
                hashes.append(hashlib.sha256(_listed(base).encode()).hexdigest())
                listed.append(_listed(base + extra))
                more.append(len(extra))
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))]
            columns = [batch.column("doc_id"), *columns, pa.array(hashes), pa.array(listed), pa.array(more, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return mapped(docs, run, schema)


def personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`find_personal_data` over all rows with a detector trained on all of them."""
    rows = docs.select(F.col(id_column).alias("doc_id"), filled(text_column).alias("text"))
    return find_personal_data(rows, train_detector(rows))


def redacted(text: str, spans: str) -> str:
    """The text with each span replaced by its kind in brackets."""
    listed = sorted(((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans.split(",") if x)), reverse=True)
    edge = len(text)
    for start, end, kind in listed:
        if end <= edge:
            text, edge = f"{text[:start]}[{kind}]{text[end:]}", start
    return text
