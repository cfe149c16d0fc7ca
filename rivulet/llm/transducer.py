"""One pass of a finite-state machine over UTF-8 bytes, and what five filters make of it.

The machine has five states: between words, in a word, and in a word with one, two or
three bytes of a character to come. Each byte belongs to one of nine classes, and a
table gives, by state and class, the next state and what happens there: a word starts,
a word ended, a code point, a capital, a symbol. Many stretches of the bytes are run in
step, one table look-up for all of them at a time; a stretch starts four bytes early,
after which its state no longer depends on where it began.

The word spans of the pass go into an open-addressing hash table. A slot holds a span;
a word that meets a taken slot is compared byte by byte with the word in it, so equal
hashes never make two words one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import filled, mapped, slices, stored

BETWEEN, WORD = 0, 1
WHITE, CAPITAL, SYMBOL, PLAIN, TRAIL, LEAD2, LEAD3, LEAD4, EDGE = range(9)
STARTS, ENDS, POINT, IS_CAPITAL, IS_SYMBOL = 1, 2, 4, 8, 16
EDGE_BYTE = 0xFF  # in no UTF-8 text; stands between documents
STRETCH = 256
WARM_UP = 4
# Bytes worked on at a time; a longer text goes through in such pieces.
PIECE_BYTES = 1_000_000
SYMBOLS = b"#$%&*|"


def _byte_classes() -> np.ndarray:
    table = np.full(256, PLAIN, dtype=np.uint8)
    table[[0x20, *range(0x09, 0x0E)]] = WHITE
    table[ord("A") : ord("Z") + 1] = CAPITAL
    table[list(SYMBOLS)] = SYMBOL
    table[0x80:0xC0], table[0xC0:0xE0], table[0xE0:0xF0], table[0xF0:0xF8] = TRAIL, LEAD2, LEAD3, LEAD4
    table[EDGE_BYTE] = EDGE
    return table


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(next state times 9, what happens) by state times 9 plus class."""
    following, happens = np.zeros((5, 9), dtype=np.uint8), np.zeros((5, 9), dtype=np.uint8)
    for state in range(5):
        for kind in range(9):
            pause = kind in (WHITE, EDGE)
            if pause:
                after = BETWEEN
            elif kind in (LEAD2, LEAD3, LEAD4):
                after = WORD + kind - LEAD2 + 1
            else:
                after = state - 1 if kind == TRAIL and state > WORD else WORD
            following[state, kind] = after * 9
            if pause and state != BETWEEN:
                happens[state, kind] |= ENDS
            if not pause and state == BETWEEN:
                happens[state, kind] |= STARTS
            if kind not in (TRAIL, EDGE):
                happens[state, kind] |= POINT
            happens[state, kind] |= {CAPITAL: IS_CAPITAL, SYMBOL: IS_SYMBOL}.get(kind, 0)
    return following.ravel(), happens.ravel()


CLASSES = _byte_classes()
FOLLOWING, HAPPENS = _tables()


def transduce(data: np.ndarray) -> np.ndarray:
    """What happens at each byte; before the first one lies an edge."""
    lanes = max(1, -(-len(data) // STRETCH))
    padded = np.full(WARM_UP + lanes * STRETCH, EDGE, dtype=np.uint8)
    padded[WARM_UP : WARM_UP + len(data)] = CLASSES[data]
    grid = np.empty((WARM_UP + STRETCH, lanes), dtype=np.uint8)
    grid[WARM_UP:] = padded[WARM_UP:].reshape(lanes, STRETCH).T
    for i in range(WARM_UP):
        grid[i] = padded[i::STRETCH][:lanes]
    out = np.empty((STRETCH, lanes), dtype=np.uint8)
    state = np.zeros(lanes, dtype=np.uint8)
    for i, kinds in enumerate(grid):
        cell = state + kinds
        if i >= WARM_UP:
            np.take(HAPPENS, cell, out=out[i - WARM_UP])
        state = FOLLOWING[cell]
    return out.T.reshape(-1)[: len(data)]


class WordTable:
    """An open-addressing hash table of word spans in `data`, each under an owner number."""

    def __init__(self, data: np.ndarray):
        # Eight bytes can be read from every place.
        self.data = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
        self.start = np.zeros(0, dtype=np.int64)
        self.length = np.zeros(0, dtype=np.int64)
        self.owner = np.zeros(0, dtype=np.int64)
        self.hash = np.zeros(0, dtype=np.uint64)
        self.slots = np.full(1 << 12, -1, dtype=np.int64)

    def _eight(self, at: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Eight bytes from each place as a number, those beyond `left` as zero."""
        found = self.data[at[:, None] + np.arange(8)].view(np.uint64).ravel()
        spare = np.clip(8 - left, 0, 7).astype(np.uint64) * np.uint64(8)
        return found << spare

    def _hashes(self, start: np.ndarray, length: np.ndarray, owner: np.ndarray) -> np.ndarray:
        out = (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ length.astype(np.uint64)
        going = np.flatnonzero(length <= 64)
        for at in range(0, 64, 8):
            going = going[length[going] > at]
            if not len(going):
                break
            mixed = (out[going] ^ self._eight(start[going] + at, length[going] - at)) * np.uint64(0xFF51AFD7ED558CCD)
            out[going] = mixed ^ (mixed >> np.uint64(32))
        for i in np.flatnonzero(length > 64).tolist():
            out[i] ^= np.uint64(xxhash.xxh3_64_intdigest(self.data[start[i] : start[i] + length[i]].data))
        out *= np.uint64(0xC4CEB9FE1A85EC53)
        return out ^ (out >> np.uint64(29))

    def _equal(self, a: tuple, b: tuple) -> np.ndarray:
        """Whether spans (start, length, owner) are the same word of the same owner."""
        good = (a[1] == b[1]) & (a[2] == b[2])
        going = np.flatnonzero(good)
        for at in range(0, 64, 8):
            going = going[a[1][going] > at]
            if not len(going):
                return good
            left = a[1][going] - at
            good[going] = self._eight(a[0][going] + at, left) == self._eight(b[0][going] + at, left)
            going = going[good[going]]
        for i in going[a[1][going] > 64].tolist():
            x, y, n = int(a[0][i]), int(b[0][i]), int(a[1][i])
            good[i] = self.data[x : x + n].tobytes() == self.data[y : y + n].tobytes()
        return good

    def _grow(self, more: int) -> None:
        size = len(self.slots)
        while size < 2 * (len(self.start) + more):
            size *= 2
        if size == len(self.slots):
            return
        self.slots = np.full(size, -1, dtype=np.int64)
        pending = np.arange(len(self.start))
        place = (self.hash & np.uint64(size - 1)).astype(np.int64)
        while len(pending):  # all are different words: only free slots count
            free = self.slots[place[pending]] < 0
            self.slots[place[pending[free]]] = pending[free]
            pending = pending[self.slots[place[pending]] != pending]
            place[pending] = (place[pending] + 1) & (size - 1)

    def insert(self, start: np.ndarray, end: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Whether each span is the first of its word; those are kept."""
        length = end - start
        self._grow(len(start))
        base, mask = len(self.start), len(self.slots) - 1
        hashed = self._hashes(start, length, owner)
        spans = [np.concatenate(pair) for pair in ((self.start, start), (self.length, length), (self.owner, owner))]
        place = (hashed & np.uint64(mask)).astype(np.int64)
        new, pending = np.zeros(len(start), dtype=bool), np.arange(len(start))
        while len(pending):
            free = pending[self.slots[place[pending]] < 0]
            self.slots[place[free]] = base + free
            held = self.slots[place[pending]]
            own = held == base + pending
            new[pending[own]] = True
            pending, held = pending[~own], held[~own]
            mine = tuple(column[base + pending] for column in spans)
            differ = ~self._equal(mine, tuple(column[held] for column in spans))
            pending = pending[differ]
            place[pending] = (place[pending] + 1) & mask
        # Slots name kept spans by their final number.
        kept = np.flatnonzero(new)
        self.slots[place[kept]] = base + np.arange(len(kept))
        self.start, self.length, self.owner = (np.concatenate([c[:base], c[base + kept]]) for c in spans)
        self.hash = np.concatenate([self.hash, hashed[kept]])
        return new


FIGURES = ("words", "distinct_words", "capitals", "code_points", "symbols")


def figures(texts: pa.StringArray) -> np.ndarray:
    """A row of `FIGURES` per text; NULL counts as empty."""
    lengths = texts.cast(pa.binary()).fill_null(b"")
    offsets = np.frombuffer(lengths.buffers()[1], dtype=np.int32)[lengths.offset : lengths.offset + len(lengths) + 1].astype(np.int64)
    whole = np.frombuffer(lengths.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    # Every text is followed by an edge.
    data = np.insert(whole, offsets[1:], EDGE_BYTE)
    edges = offsets[1:] + np.arange(len(texts))
    out = np.zeros((len(texts), len(FIGURES)), dtype=np.int64)
    table, open_start = WordTable(data), -1
    carry = np.zeros(0, dtype=np.uint8)
    for at in range(0, len(data), PIECE_BYTES):
        piece = data[at : at + PIECE_BYTES]
        # The state before a piece follows from the bytes before it.
        happens = transduce(np.concatenate([carry, piece]))[len(carry) :]
        carry = piece[-WARM_UP:]
        # The texts that lie in this piece, and where each begins there.
        low, high = np.searchsorted(edges, [at, at + len(piece) - 1])
        begins = np.concatenate([[0], edges[low:high] + 1 - at])
        for column, bit in ((2, IS_CAPITAL), (3, POINT), (4, IS_SYMBOL)):
            out[low : high + 1, column] += np.add.reduceat((happens & bit) > 0, begins, dtype=np.int64)
        starts, ends = at + np.flatnonzero(happens & STARTS), at + np.flatnonzero(happens & ENDS)
        if open_start >= 0:
            starts = np.append(open_start, starts)
        open_start = -1
        if len(starts) > len(ends):
            open_start, starts = starts[-1], starts[:-1]
        # A word belongs to the text in which it ends; its end stands before the edge or at it.
        per_text = np.add.reduceat((happens & ENDS) > 0, begins, dtype=np.int64)
        owner = np.repeat(np.arange(low, high + 1), per_text)
        out[low : high + 1, 0] += per_text
        new = table.insert(starts, ends, owner)
        out[low : high + 1, 1] += np.bincount(owner[new] - low, minlength=high + 1 - low)
    return out


def with_figures(docs: DataFrame) -> DataFrame:
    """`docs` without its `text`, with `FIGURES` as columns."""
    keep = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE_BYTES):
            found = figures(batch.column("text"))
            columns = [batch.column(c) for c in keep] + [pa.array(found[:, i]) for i in range(len(FIGURES))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *FIGURES])

    schema = docs.select(*keep).schema
    for name in FIGURES:
        schema = schema.add(name, "long")
    return mapped(docs, run, schema)


FILTERS = "ABCDE"


def _mask() -> Column:
    """Bit i is set where filter i fails; E comes later."""
    fails = [
        F.col("words") < 50,
        100 * F.col("distinct_words") < 65 * F.col("words"),
        100 * F.col("capitals") > 5 * F.col("code_points"),
        F.col("symbols") > 0,
    ]
    return sum(F.when(fail, 1 << i).otherwise(0) for i, fail in enumerate(fails))


def failure_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the set of filters they fail.

    Documents with one text, part, label and failure set are one row before anything is
    joined, so copies of a text cost no more than one.
    """
    rows = docs.select("doc_id", filled("source").alias("part"), filled("text").alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    masked = with_figures(rows).select("doc_id", "part", "digest", _mask().alias("mask"))
    each = stored(masked.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n")), "filter-rows")
    marked = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    kinds = ["part", "mask", "good", "toxic"]
    # Rows without an id have no label, are later than no other row, and make none later.
    nameless = each.filter(F.col("doc_id").isNull()).groupBy("part", "mask").agg(F.sum("n").alias("n"))
    nameless = nameless.select("part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"), "n")
    known = each.filter(F.col("doc_id").isNotNull()).join(marked, "doc_id", "left")
    known = known.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    texts = known.groupBy("digest", *kinds).agg(
        F.min(F.struct("doc_id", "n")).alias("first"), F.sum("n").alias("n")
    )
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    first = F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0)
    split = texts.withColumn("firsts", first).select(
        "part", "good", "toxic",
        F.explode(
            F.array(
                F.struct(F.col("mask"), F.col("firsts").alias("n")),
                F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("firsts")).alias("n")),
            )
        ).alias("c"),
    )
    cells = split.select("part", "good", "toxic", "c.mask", "c.n").filter("n > 0").unionByName(nameless)
    of = lambda flag: F.sum(F.when(F.col(flag), F.col("n")).otherwise(0))
    return cells.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("good").alias("good"), of("toxic").alias("toxic"))


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What five filters remove in each of their 120 orders, by part of the corpus.

    One row per part (source; NULL is the empty string), order and step. A NULL text is
    empty. E compares whole texts, by SHA-256, with those of smaller doc_ids in all
    parts; rows of one doc_id do not fail each other, and a row without doc_id neither
    fails E nor makes others fail it. A document is good (toxic) when any of its label
    rows says so, so repeated labels count once. Repeated rows count each. An empty
    table gives an empty result; other columns are not looked at.
    """
    parts = failure_cells(docs, labels).groupBy("part").agg(
        F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")  # 32 at most
    )
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = parts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.array(*map(F.lit, range(1, 6)))))
    bit_of = lambda letter: F.call_function("shiftleft", F.lit(1), F.ascii(letter) - ord("A"))

    def bits(text: Column) -> Column:
        return F.aggregate(F.split(text, ""), F.lit(0), lambda acc, c: acc + F.when(c == "", 0).otherwise(bit_of(c)).cast("int"))

    own = bit_of(F.substring("filter_order", F.col("step"), F.lit(1)))
    before = bits(F.substring("filter_order", F.lit(1), F.col("step") - 1))
    steps = steps.withColumns({"own": own.cast("int"), "before": before})

    def count(column: str, condition) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda acc, c: acc + F.when(condition(c["mask"]), c[column]).otherwise(0))

    fails = lambda m: (m.bitwiseAND(F.col("own"))) != 0
    gone = lambda m: (m.bitwiseAND(F.col("before"))) != 0
    removed = count("n", lambda m: fails(m) & ~gone(m))
    counted = steps.select(
        "part", "filter_order", "step", "own",
        count("n", lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        removed.alias("removed"),
        count("n", lambda m: fails(m) & gone(m)).alias("redundant"),
        count("n", lambda m: m == F.col("own")).alias("unique_fails"),
        count("good", lambda m: fails(m) & ~gone(m)).alias("good_lost"),
        count("toxic", lambda m: fails(m) & ~gone(m)).alias("toxic_lost"),
    )
    return counted.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "own"))).drop("own")
