"""Language-model scores: causal self-attention over subwords, next to a word baseline.

The model is one attention layer with a class output: the next subword's class is
predicted from the last subword and what attention gathers from a window, the subword
from its class, the subword before and that one's class. Its statistics (subword counts,
classes, emissions, pairs) come from the counts of neighbouring subwords in all training
documents, added up by Spark. Its weights are trained in rounds: each task of a round
takes numpy steps over all windows of its training documents, and the weighted
mean of what the tasks learned begins the next round; every document is in one round.
Whole texts are scored in windows that overlap; each subword is scored in exactly one of
them. `score` is a probability over subword sequences, with case and white space.

Texts are encoded once, equal spans of a slice of texts by one call; their ids are stored
and read by all later passes. The baseline
needs the count of every word in all training documents. Spark adds these up by the word
itself; the most frequent words, a bounded table, are known to every task, and what a
document has of all others is joined to their counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import filled, mapped, slices, stored, text_id_crc
from rivulet.llm.subwords import Subwords, bytes_of, in_parts, joined, spans_of, subwords

FOLDS, HELD_OUT = 5, 1
VOCABULARY, START = 50_257, 50_256  # the last id stands before a text and ends it
SIGNS = 24  # random signs that stand for a neighbour
# Training: every document is in one of the rounds with all its windows. A step takes `BATCH` windows,
# or more, up to `MOST_BATCH`, where there are enough for `STEPS` steps all the same. What gives few
# steps is gone over again, but not often.
ROUNDS, BATCH, MOST_BATCH, STEPS, LEAST_STEPS, MOST_PASSES = 4, 32, 512, 320, 128, 15
TRAIN_SUBWORDS = 4_000_000  # what a task takes its steps over before it hands on what it learned
HELD_PAIRS = 2_000_000  # distinct pairs that a task holds before it hands them on
FIXED = 1 << 16  # weights are added up as whole multiples of 1 / FIXED, so in any order
WINDOW, OVERLAP = 32, 8
BLOCK = 32  # windows that are worked on at once: what they need fits a core's cache
CLASSES, WIDTH, HEAD = 32, 24, 8
ASKS = 2 * HEAD + 2  # where the question begins in what a place gives
# Pairs of subwords whose counts every task knows: the most frequent ones, no more than this many. What a
# document has of others is joined to their counts.
KEPT_PAIRS = 1_000_000
PAIR_STRENGTH = 1.0  # and one for each known follower: the more there are, the likelier is a new one
# Words whose counts every task knows, and the longest of them.
HOT_WORDS, HOT_BYTES = 100_000, 64
HELD_WORDS = 300_000  # distinct words that a task holds before it hands them on
SLICE_BYTES = 12_000_000  # text whose words and subwords are told apart at once
SAFE = 60.0  # scores within this need no care for their exponential in 32 bits
END_WORD = b" "  # the end of a text; no word has a blank


def windows_of(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, scored) of all windows over sequences laid end to end.

    A window has `OVERLAP` places of context and `WINDOW - OVERLAP` that it scores; the
    next one begins where the scored part of this one ends. Before a sequence stands
    its start (place -1).
    """
    step = WINDOW - OVERLAP
    count = -(-lengths // step)
    owner = np.repeat(np.arange(len(lengths)), count)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    begins = np.cumsum(lengths) - lengths
    inside = (number * step - OVERLAP)[:, None] + np.arange(WINDOW)
    valid = (inside >= 0) & (inside < lengths[owner][:, None])
    return np.where(valid, begins[owner][:, None] + inside, -1), valid[:, OVERLAP:]


_MASK = np.where(np.tril(np.ones((WINDOW, WINDOW), bool)), 0.0, -1e9).astype(np.float32)[OVERLAP:]


def _most(rows: np.ndarray, at: np.ndarray) -> float:
    """No sum of one of `rows` and one of `at` is longer."""
    return float(np.linalg.norm(rows, axis=1).max() + np.linalg.norm(at, axis=1).max())


@lru_cache(maxsize=2)
def _buffers(block: int, kind: np.dtype) -> list[np.ndarray]:
    """What a step of training writes for each block of windows; new memory would cost more than the arithmetic."""
    scored = WINDOW - OVERLAP
    x, w, s, z, d = (WINDOW, ASKS + HEAD + CLASSES), (scored, WINDOW), (scored, HEAD + 1), (scored, HEAD), (scored, CLASSES)
    return [np.empty((block, *shape), kind) for shape in (x, w, s, z, d, z, s, w)]


class AttentionModel:
    """Statistics of the corpus, and parameters; after training folded into tables by subword."""

    def __init__(self, count: np.ndarray, around: np.ndarray, seed: int = 3):
        """`count` and `around` by subword: how often it comes, and the signs of its neighbours added up."""
        self.rng = np.random.default_rng(seed)
        self._classes(count.astype(np.float64), around.astype(np.float32), self.rng)

    def _classes(self, count: np.ndarray, around: np.ndarray, rng) -> None:
        """Classes by k-means over the neighbours of each subword."""
        seen = np.flatnonzero(count)
        points = around[seen] / np.maximum(np.linalg.norm(around[seen], axis=1, keepdims=True), 1e-6)
        self.features = np.zeros((VOCABULARY, 48), dtype=np.float32)
        self.features[seen] = points
        heavy = seen[np.argsort(-count[seen], kind="stable")[:CLASSES]]
        centres = self.features[heavy].copy()
        if len(centres) < CLASSES:
            centres = np.concatenate([centres, rng.standard_normal((CLASSES - len(centres), 48)).astype(np.float32)])
        weight = np.sqrt(count[seen])
        for _ in range(12):
            own = (points @ centres.T).argmax(axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, own, points * weight[:, None].astype(np.float32))
            norm = np.linalg.norm(sums, axis=1, keepdims=True)
            centres = np.where(norm > 0, sums / np.maximum(norm, 1e-6), centres)
        # Subwords that no training document has are spread over the classes.
        self.class_of = (np.arange(VOCABULARY) % CLASSES).astype(np.int64)
        self.class_of[seen] = (points @ centres.T).argmax(axis=1)
        smooth = count + 0.01
        in_class = smooth / np.bincount(self.class_of, smooth, CLASSES)[self.class_of]
        self.in_class = in_class

    def emissions(self, classes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """From how often each subword follows each class: P(subword | its class, class before)."""
        pairs = np.zeros((CLASSES, VOCABULARY))
        pairs[classes, ids] = counts
        total = np.stack([np.bincount(self.class_of, p, CLASSES) for p in pairs])
        strength = 20.0
        emit = (pairs + strength * self.in_class) / (total[:, self.class_of] + strength)
        self.emit = emit.astype(np.float32)

    def keep_pairs(self, before: np.ndarray, ids: np.ndarray, counts: np.ndarray, others: tuple | None = None) -> None:
        """Counts of neighbours that sharpen the emissions after a known subword.

        `others` are (cell, counts added up, how many) of all pairs that are not kept.
        """
        key = before.astype(np.int64) * VOCABULARY + ids
        order = np.argsort(key)
        self.pair, self.pair_count = key[order], counts[order].astype(np.float32)
        cell = self.cell(before, ids)
        often, many = np.bincount(cell, counts, VOCABULARY * CLASSES), np.bincount(cell, minlength=VOCABULARY * CLASSES)
        if others:
            often[others[0]] += others[1]
            many[others[0]] += others[2]
        self.pair_class, self.spare = often.astype(np.float32), (PAIR_STRENGTH + many).astype(np.float32)

    def cell(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """One number for the subword before and the class of the next."""
        return before.astype(np.int64) * CLASSES + self.class_of[ids]

    def gained(self, before: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """What the counts of pairs that are not kept add to the log10 of `emitted`."""
        wide = self.spare[self.cell(before, ids)] * self.emit[self.class_of[before], ids].astype(np.float64)
        return np.log10((counts + wide) / wide)

    def emitted(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """P(subword | its class, the subword before), as if a pair that is not kept were not there
        (see `gained`); over the subwords of a class it adds up to one."""
        key = before * VOCABULARY + ids
        at = np.minimum(np.searchsorted(self.pair, key), max(len(self.pair) - 1, 0))
        often = np.where(self.pair[at] == key, self.pair_count[at], 0) if len(self.pair) else np.zeros(len(key))
        cell = self.cell(before, ids)
        wide = self.emit[self.class_of[before], ids].astype(np.float64)
        return (often + self.spare[cell] * wide) / (self.pair_class[cell] + self.spare[cell])

    def untrained(self) -> dict:
        rng = self.rng
        near = rng.standard_normal((2 * SIGNS, WIDTH)) / np.sqrt(2 * SIGNS)
        scale = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        return {
            "e": (self.features @ near).astype(np.float32),
            "at": scale(WINDOW, WIDTH) * np.float32(0.1),
            "q": scale(WIDTH, HEAD),
            "k": scale(WIDTH, HEAD),
            "v": scale(WIDTH, HEAD),
            "a": scale(WIDTH, CLASSES),
            "b": scale(HEAD, CLASSES),
            "c": np.zeros(CLASSES, np.float32),
        }

    def fold(self, p: dict) -> None:
        e, at = p["e"], p["at"]
        ask = np.concatenate([p["q"] / np.float32(np.sqrt(HEAD)), p["a"]], axis=1)
        self.asks, self.asks_at = e @ ask, (at @ ask)[OVERLAP:]
        self.asks_at[:, HEAD:] += p["c"]
        reply = np.concatenate([p["k"], p["v"]], axis=1)
        self.replies, self.replies_at, self.mix = e @ reply, at @ reply, p["b"]
        del self.features, self.in_class, self.rng

    @classmethod
    def learn(cls, p: dict, class_of: np.ndarray, sequences: list[np.ndarray], number: int, seed: int) -> tuple[np.ndarray, np.ndarray, dict]:
        """(subwords, how often each is read, parameters with these rows of `e`) after the
        steps of round `number` over all windows of these sequences, in drawn order."""
        inputs, targets = _shifted(sequences)
        places, scored = windows_of(np.array([len(x) for x in sequences], dtype=np.int64))
        size = max(BATCH, min(MOST_BATCH, len(places) // STEPS))
        inputs, targets = np.append(inputs, START), class_of[np.append(targets, START)]
        often = np.bincount(inputs, minlength=VOCABULARY)
        own = np.flatnonzero(often)
        often, number_of = often[own], np.zeros(VOCABULARY, np.uint16)  # numbers of 16 bits are sorted fastest
        number_of[own] = np.arange(len(own))
        inputs = number_of[inputs]
        p = {n: x.copy() for n, x in p.items()} | {"e": p["e"][own]}
        first = {n: np.zeros_like(x) for n, x in p.items()}
        second = {n: np.zeros_like(x) for n, x in p.items()}
        spare = {n: np.empty_like(x) for n, x in p.items()}
        rng = np.random.default_rng(seed)
        batches = -(-len(places) // size)
        steps = batches * min(MOST_PASSES, -(-LEAST_STEPS // batches))
        for step in range(1, steps + 1):
            at = (step - 1) % batches
            if at == 0:
                order = rng.permutation(len(places))
            rows = order[at * size : (at + 1) * size]
            where, use = places[rows], scored[rows].astype(np.float32)
            grads = cls._gradients(p, inputs[where], targets[where[:, OVERLAP:]], use)
            rate = 0.01 * min(1.0, step / 20) * (1.0 - 0.9 * (number + step / steps) / ROUNDS)
            # Running means of the gradients and of their squares, held 10 and 100 times as large.
            young = (1 - 0.99**step) ** 0.5
            for n, g in grads.items():
                first[n] *= 0.9
                first[n] += g
                second[n] *= 0.99
                second[n] += np.multiply(g, g, out=spare[n])
                move = np.sqrt(second[n], out=spare[n])
                move += 1e-7 * young
                np.divide(first[n], move, out=move)
                move *= rate * young / (1 - 0.9**step)
                p[n] -= move
        return own, often, p

    @staticmethod
    def _gradients(p: dict, tokens: np.ndarray, classes: np.ndarray, use: np.ndarray) -> dict:
        """What the loss gains by each parameter, over these windows.

        All that a place gives is linear in its row of `e`, so it is worked out once for each distinct
        subword, and what comes back is added up by subword before it goes on to the parameters.
        """
        kind, root = p["e"].dtype, np.sqrt(HEAD).astype(p["e"].dtype)
        order = np.argsort(tokens, axis=None, kind="stable")
        ordered = tokens.ravel()[order]
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        own, number = ordered[first], np.empty(tokens.size, np.int64)
        number[order] = np.repeat(np.arange(len(first)), np.diff(first, append=len(order)))
        number = number.reshape(tokens.shape)
        e = p["e"][own]
        # By place: key, value, a one (it adds up the weights), nothing, question, scores of the classes.
        linear = np.concatenate([p["k"], p["v"], np.zeros((WIDTH, 2), kind), p["q"] / root, p["a"]], axis=1)
        given, given_at = e @ linear, p["at"] @ linear
        given[:, 2 * HEAD] = 1
        given_at[:, ASKS + HEAD :] += p["c"]
        share = (use / max(use.sum(), 1)).astype(kind)
        ones, mask, held = np.ones(CLASSES, kind), _MASK.astype(kind, copy=False), _buffers(BLOCK, kind)
        begins = np.arange(BLOCK * (WINDOW - OVERLAP)) * CLASSES
        calm = _most(given[:, ASKS : ASKS + HEAD], given_at[:, ASKS : ASKS + HEAD]) * _most(given[:, :HEAD], given_at[:, :HEAD]) < SAFE
        back, mixed = np.empty((*tokens.shape, linear.shape[1]), kind), np.zeros_like(p["b"])
        flat = lambda y: y.reshape(-1, y.shape[-1])
        for i in range(0, len(tokens), BLOCK):
            part, to = share[i : i + BLOCK].ravel(), back[i : i + BLOCK]
            x, w, s, z, d, dz, g, ds = (x[: len(to)] for x in held)
            np.take(given, number[i : i + BLOCK], axis=0, out=x, mode="clip")
            x += given_at
            k, v, q = x[..., :HEAD], x[..., HEAD : 2 * HEAD + 1], x[:, OVERLAP:, ASKS : ASKS + HEAD]  # only what is scored asks
            np.matmul(q, k.transpose(0, 2, 1), out=w)
            safe = calm or (w.max() < SAFE and w.min() > -SAFE)
            w += mask
            if not safe:
                w -= w.max(axis=-1, keepdims=True)
            np.exp(w, out=w)
            np.matmul(w, v, out=s)
            np.divide(s[..., :HEAD], s[..., HEAD:], out=z)
            np.matmul(flat(z), p["b"], out=flat(d))
            d += x[:, OVERLAP:, ASKS + HEAD :]
            if not (d.max() < SAFE and d.min() > -SAFE):
                d -= d.max(axis=-1, keepdims=True)
            np.exp(d, out=d)
            rows = flat(d)
            rows *= (part / (rows @ ones))[:, None]
            rows.ravel()[begins[: len(rows)] + classes[i : i + BLOCK].ravel()] -= part
            mixed += flat(z).T @ rows
            np.matmul(rows, p["b"].T, out=flat(dz))
            # A weight gains what its value does, less the mean of that over all weights.
            np.divide(dz, s[..., HEAD:], out=g[..., :HEAD])
            np.einsum("nij,nij->ni", g[..., :HEAD], z, out=g[..., HEAD])
            np.negative(g[..., HEAD], out=g[..., HEAD])
            np.matmul(g, v.transpose(0, 2, 1), out=ds)
            ds *= w
            np.matmul(ds.transpose(0, 2, 1), q, out=to[..., :HEAD])
            np.matmul(w.transpose(0, 2, 1), g[..., :HEAD], out=to[..., HEAD : 2 * HEAD])
            to[..., 2 * HEAD : ASKS] = 0
            to[:, :OVERLAP, ASKS:] = 0
            np.matmul(ds, k, out=to[:, OVERLAP:, ASKS : ASKS + HEAD])
            to[:, OVERLAP:, ASKS + HEAD :] = d
        # Two numbers are added at a time, as the parts of a complex one.
        by_own = np.add.reduceat(flat(back).take(order, axis=0).view(np.result_type(kind, np.complex64)), first, axis=0).view(kind)
        by_place = back.sum(axis=0)
        de = np.zeros_like(p["e"])
        de[own] = by_own @ linear.T
        to_linear = e.T @ by_own + p["at"].T @ by_place
        return {
            "e": de,
            "at": by_place @ linear.T,
            "q": to_linear[:, ASKS : ASKS + HEAD] / root,
            "k": to_linear[:, :HEAD],
            "v": to_linear[:, HEAD : 2 * HEAD],
            "a": to_linear[:, ASKS + HEAD :],
            "b": mixed,
            "c": by_place[:, ASKS + HEAD :].sum(axis=0),
        }

    def token_logs(self, sequences: list[np.ndarray], block: int = 64) -> np.ndarray:
        """log10 probability of every subword of all sequences, end to end."""
        inputs, targets = _shifted(sequences)
        lengths = np.array([len(s) for s in sequences], dtype=np.int64)
        places, scored = windows_of(lengths)
        inputs, own = np.append(inputs, START), np.append(self.class_of[targets], 0)
        own_class = np.empty(len(inputs), dtype=np.float32)
        step = WINDOW - OVERLAP
        # Buffers that every block uses again: new memory would cost more than the arithmetic.
        shapes = {"a": (step, HEAD + CLASSES), "r": (WINDOW, 2 * HEAD), "s": (step, WINDOW), "z": (step, HEAD), "l": (step, CLASSES)}
        held = {n: np.empty((block, *shape), np.float32) for n, shape in shapes.items()}
        ones, begins = np.ones(CLASSES, np.float32), np.arange(block * step) * CLASSES
        calm = _most(self.asks[:, :HEAD], self.asks_at[:, :HEAD]) * _most(self.replies[:, :HEAD], self.replies_at[:, :HEAD]) < SAFE
        for i in range(0, len(places), block):
            at = places[i : i + block]
            a, r, s, z, l = (held[n][: len(at)] for n in "arszl")
            t, put = inputs[at], at[:, OVERLAP:]
            np.take(self.asks, t[:, OVERLAP:], axis=0, out=a, mode="clip")
            a += self.asks_at
            np.take(self.replies, t, axis=0, out=r, mode="clip")
            r += self.replies_at
            np.matmul(a[..., :HEAD], r[..., :HEAD].transpose(0, 2, 1), out=s)
            safe = calm or (s.max() < SAFE and s.min() > -SAFE)
            s += _MASK
            if not safe:
                s -= s.max(axis=-1, keepdims=True)
            np.exp(s, out=s)
            np.matmul(s, r[..., HEAD:], out=z)
            z /= (s.reshape(-1, WINDOW) @ ones[:WINDOW]).reshape(len(at), step, 1)
            flat = l.reshape(-1, CLASSES)
            np.matmul(z.reshape(-1, HEAD), self.mix, out=flat)
            l += a[..., HEAD:]
            if l.max() > SAFE or l.min() < -SAFE:
                l -= l.max(axis=-1, keepdims=True)
            chosen = flat.ravel()[begins[: len(flat)] + own[put].ravel()]
            np.exp(l, out=l)
            chosen -= np.log(flat @ ones)
            use = scored[i : i + block].ravel()
            own_class[put.ravel()[use]] = chosen[use]
        # Emissions are looked up once for equal pairs.
        pairs = pa.array(inputs[:-1] * VOCABULARY + targets).dictionary_encode()
        found = pairs.dictionary.to_numpy()
        emitted = np.log10(self.emitted(found // VOCABULARY, found % VOCABULARY))
        return own_class[:-1].astype(np.float64) / np.log(10) + emitted[pairs.indices.to_numpy()]


def _shifted(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """What is read and what comes next, of all sequences end to end."""
    targets = np.concatenate([np.zeros(0, np.int64), *sequences]).astype(np.int64)
    inputs = np.empty_like(targets)
    inputs[1:] = targets[:-1]
    starts = np.cumsum([0, *[len(s) for s in sequences]])[:-1]
    inputs[starts[starts < len(inputs)]] = START
    return inputs, targets


def with_end(ids: np.ndarray) -> np.ndarray:
    return np.append(ids.astype(np.int64), START)


def _ids(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Subwords of each document of a batch of encoded rows, with its end."""
    return [np.frombuffer(x.as_buffer(), dtype="<u2").astype(np.int64) for x in batch.column("ids")]


def _training(encoded: DataFrame) -> DataFrame:
    return encoded.filter(~F.col("held_out"))


def tallied(found: Iterator[tuple], most: int) -> Iterator[list[pa.Array]]:
    """[values, counts] of all these added up, handed on when there are more than `most` values."""
    held, size = [], 0

    def added_up() -> pa.Table:
        return pa.concat_tables(held).group_by("value", use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})

    def columns(table: pa.Table) -> list[pa.Array]:
        return [table.column(c).combine_chunks() for c in ("value", "n")]

    for value, n in found:
        held.append(pa.table({"value": value, "n": n}))
        size += len(value)
        if size > 2 * most:
            held = [added_up()]
            size = held[0].num_rows
            if size > most:
                yield columns(held[0])
                held, size = [], 0
    if held:
        yield columns(added_up())


def pair_counts(encoded: DataFrame) -> DataFrame:
    """(before, subword, n): how often two subwords are neighbours in all training documents, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for value, n in tallied(map(found, slices(batches, "ids", 4_000_000)), HELD_PAIRS):
            keys = value.to_numpy()
            columns = [pa.array((keys // VOCABULARY).astype(np.int32)), pa.array((keys % VOCABULARY).astype(np.int32)), n]
            yield pa.RecordBatch.from_arrays(columns, names=["before", "subword", "n"])

    def found(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        inputs, targets = _shifted(_ids(batch))
        return np.unique(inputs * VOCABULARY + targets, return_counts=True)

    pairs = mapped(_training(encoded).select("ids"), run, "before int, subword int, n long")
    return stored(pairs.groupBy("before", "subword").agg(F.sum("n").alias("n")), "subword-pairs")


def least_count(counts: DataFrame, most: int) -> int:
    """The smallest n of `counts` that no more than about `most` rows reach, from rows by powers of two."""
    power = F.floor(F.log2("n")).cast("int")
    rows = counts.filter("n > 0").groupBy(power.alias("power")).agg(F.count("*").alias("rows")).collect()
    left, least = most, 62
    for row in sorted(rows, key=lambda r: -r.power):
        left -= row.rows
        if left < 0:
            break
        least = row.power
    return 1 << least


def _neighbours(pairs: DataFrame, own: str, other: str) -> tuple[np.ndarray, np.ndarray]:
    """By subword: how often it is there, and the signs of what stands beside it added up."""
    sign = [F.lit(1) - 2 * F.shiftrightunsigned(F.xxhash64(other), k).bitwiseAND(F.lit(1)) for k in range(SIGNS)]
    sums = [F.sum(F.col("n") * x).alias(f"s{k}") for k, x in enumerate(sign)]
    table = pairs.groupBy(own).agg(F.sum("n").alias("n"), *sums).toArrow()  # a row per subword at most
    count, around = np.zeros(VOCABULARY, np.int64), np.zeros((VOCABULARY, SIGNS), np.int64)
    ids = table.column(own).to_numpy()
    count[ids] = table.column("n").to_numpy()
    around[ids] = np.stack([table.column(f"s{k}").to_numpy() for k in range(SIGNS)], axis=1)
    return count, around


def _as_rows(p: dict) -> np.ndarray:
    """All parameters as rows of `WIDTH`; a row per subword comes first."""
    flat = np.concatenate([p[n].ravel() for n in p if n != "e"])
    return np.concatenate([p["e"], np.append(flat, np.zeros(-len(flat) % WIDTH, flat.dtype)).reshape(-1, WIDTH)])


def _from_rows(rows: np.ndarray, like: dict) -> dict:
    out, flat, at = {"e": rows[:VOCABULARY]}, rows[VOCABULARY:].ravel(), 0
    for n, x in like.items():
        if n != "e":
            out[n], at = flat[at : at + x.size].reshape(x.shape), at + x.size
    return out


def train_model(encoded: DataFrame, pairs: DataFrame | None = None) -> AttentionModel:
    """From encoded rows: the model of all their training documents, whose `pair_counts` are `pairs`."""
    pairs = pair_counts(encoded) if pairs is None else pairs
    count, left = _neighbours(pairs, "subword", "before")
    _, right = _neighbours(pairs, "before", "subword")
    model = AttentionModel(count, np.concatenate([left, right], axis=1))
    class_of = model.class_of

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before = pa.array(class_of[batch.column("before").to_numpy()].astype(np.int32))
            yield pa.RecordBatch.from_arrays([before, batch.column("subword"), batch.column("n")], names=["class", "subword", "n"])

    followed = mapped(pairs, classed, "class int, subword int, n long").groupBy("class", "subword").agg(F.sum("n").alias("n"))
    followed = followed.toArrow()  # CLASSES x VOCABULARY cells at most
    model.emissions(*(followed.column(c).to_numpy() for c in ("class", "subword", "n")))
    model.least = least_count(pairs, KEPT_PAIRS)
    kept = pairs.filter(F.col("n") >= model.least).toArrow()  # KEPT_PAIRS rows at most

    def by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = batch.column("before").to_numpy().astype(np.int64) * CLASSES + class_of[batch.column("subword").to_numpy()]
            yield pa.RecordBatch.from_arrays([pa.array(cell), batch.column("n")], names=["cell", "n"])

    others = None
    if model.least > 1:
        cells = mapped(pairs.filter(F.col("n") < model.least), by_cell, "cell long, n long").groupBy("cell")
        others = cells.agg(F.sum("n").alias("n"), F.count("*").alias("many")).toArrow()  # CLASSES x VOCABULARY cells at most
        others = tuple(others.column(c).to_numpy() for c in ("cell", "n", "many"))
    model.keep_pairs(*(kept.column(c).to_numpy() for c in ("before", "subword", "n")), others)
    p = model.untrained()
    for number in range(ROUNDS):
        p = _round(encoded, p, class_of, number)
    model.fold(p)
    return model


def _round(encoded: DataFrame, p: dict, class_of: np.ndarray, number: int) -> dict:
    """The mean of what the tasks of one round make of `p`, weighted by their subwords."""
    begun = encoded.sparkSession.sparkContext.broadcast((p, class_of))
    columns = [f"v{k}" for k in range(WIDTH)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seed = [], 0, 0

        def made():
            own, often, learned = AttentionModel.learn(*begun.value, held, number, seed)
            rows = _as_rows(learned)
            ids = np.append(own, np.arange(VOCABULARY, VOCABULARY + len(rows) - len(own)))
            weight = np.append(often, np.full(len(rows) - len(own), often.sum()))
            values = np.rint(rows.astype(np.float64) * FIXED).astype(np.int64) * weight[:, None]
            arrays = [pa.array(ids.astype(np.int32)), pa.array(weight), *[pa.array(np.ascontiguousarray(v)) for v in values.T]]
            return pa.RecordBatch.from_arrays(arrays, names=["id", "weight", *columns])

        for batch in slices(batches, "ids", TRAIN_SUBWORDS):
            for ids in _ids(batch):
                held.append(ids)
                size += len(ids)
            if size >= TRAIN_SUBWORDS:
                yield made()
                held, size, seed = [], 0, seed + 1
        if held:
            yield made()

    turn = _training(encoded).filter(F.pmod(F.xxhash64("row"), F.lit(ROUNDS)) == number).select("ids")
    schema = ", ".join(["id int", "weight long", *[f"{c} long" for c in columns]])
    sums = mapped(turn, run, schema).groupBy("id").agg(*[F.sum(c).alias(c) for c in ["weight", *columns]])
    table = sums.toArrow()  # a row per subword, and some for the other weights
    rows = _as_rows(p).astype(np.float32)
    values = np.stack([table.column(c).to_numpy() for c in columns], axis=1)
    rows[table.column("id").to_numpy()] = values / FIXED / table.column("weight").to_numpy()[:, None]
    return _from_rows(rows, p)


def rare_gains(encoded: DataFrame, rare: DataFrame, model: Broadcast) -> DataFrame:
    """(row, gained): what the counts of `rare` pairs, those that not every task knows, add to a document's score."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value.pair
        for batch in slices(batches, "ids", 1_000_000):
            sequences = _ids(batch)
            inputs, targets = _shifted(sequences)
            keys = pa.array(inputs * VOCABULARY + targets).dictionary_encode()
            found, own = keys.dictionary.to_numpy(), np.repeat(np.arange(len(sequences)), [len(x) for x in sequences])
            at = np.minimum(np.searchsorted(known, found), max(len(known) - 1, 0))
            number = keys.indices.to_numpy()
            some = np.flatnonzero((known[at] != found)[number] if len(known) else np.ones(len(number), bool))
            one, times = np.unique(own[some] * max(len(found), 1) + number[some], return_counts=True)
            text, number = np.divmod(one, max(len(found), 1))
            columns = [batch.column("row").take(pa.array(text)), pa.array(found[number]), pa.array(times)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "pair", "times"])

    def worth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before, ids, counts = (batch.column(c).to_numpy().astype(np.int64) for c in ("before", "subword", "n"))
            gained = model.value.gained(before, ids, counts)
            yield pa.RecordBatch.from_arrays([pa.array(before * VOCABULARY + ids), pa.array(gained)], names=["pair", "gained"])

    rare = mapped(rare, worth, "pair long, gained double")
    here = mapped(encoded.select("row", "ids"), met, "row long, pair long, times long")
    return here.join(rare, "pair").groupBy("row").agg(F.sum(F.col("times") * F.col("gained")).alias("gained"))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts, how many each text has); A-Z in lower case."""
    data, bounds = bytes_of(texts)
    low = np.frombuffer(data.tobytes().lower(), dtype=np.uint8)
    inside = (low != 0x20) & (low - 9 > 4)  # 9 to 13 are white space
    begins = np.ones(len(low) + 1, dtype=bool)
    begins[1:] = ~inside
    begins[bounds] = True
    begins = begins[:-1]
    counts = np.diff(np.searchsorted(np.flatnonzero(inside & begins), bounds))
    held = low[inside]
    return joined(held, np.append(np.flatnonzero(begins[inside]), len(held))), counts


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n): occurrences in all training documents, and the end of each as a word; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = 0

        def found():
            nonlocal documents
            for batch in slices(batches, "text", SLICE_BYTES):
                documents += batch.num_rows
                for texts in in_parts(batch.column("text")):
                    yield words_of(texts)[0].value_counts().flatten()

        for columns in tallied(found(), HELD_WORDS):
            yield pa.RecordBatch.from_arrays(columns, names=["word", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([END_WORD], pa.binary()), pa.array([documents], pa.int64())], names=["word", "n"])

    words = mapped(_training(rows).select("text"), run, "word binary, n long")
    return stored(words.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def _measured(texts: pa.Array, encoder: Subwords, known: tuple[pa.Array, np.ndarray]) -> tuple:
    """(ids, words, words known, base of these) by text, and (text, word, times) of all other words.

    `known` are words and what each adds to the base. What the texts have many times is
    encoded and looked up once.
    """
    spans, counts = spans_of(texts)
    spans = spans.dictionary_encode()
    place, spans, owner = spans.indices.to_numpy(), spans.dictionary, np.repeat(np.arange(len(texts)), counts)
    ids, bounds = bytes_of(encoder.encode_spans(spans).take(pa.array(place)))
    ids = joined(ids, bounds[np.append(0, np.cumsum(counts))])
    # No word goes beyond its span: what the words of a span give is added up by text.
    words, n_words = words_of(spans)
    words = words.dictionary_encode()
    word, words, span = words.indices.to_numpy(), words.dictionary, np.repeat(np.arange(len(spans)), n_words)
    hot_word, log10 = known
    number = pc.index_in(words, value_set=hot_word).fill_null(len(hot_word)).to_numpy()
    hot, log = number < len(hot_word), np.append(log10, 0.0)[number]
    added = [n_words, np.bincount(span, hot[word], len(spans)), np.bincount(span, log[word], len(spans))]
    n_tokens, n_known, base = (np.bincount(owner, x[place], len(texts)) for x in added)
    # The other words: those of each span lie end to end in `word`.
    word, often = word[~hot[word]], np.bincount(span[~hot[word]], minlength=len(spans))
    first = np.cumsum(often) - often
    some = often[place] > 0
    place, owner = place[some], owner[some]
    often = often[place]
    at = np.repeat(first[place] - np.cumsum(often) + often, often) + np.arange(often.sum())
    pairs, times = np.unique(np.repeat(owner, often) * max(len(words), 1) + word[at], return_counts=True)
    text, word = np.divmod(pairs, max(len(words), 1))
    return ids, n_tokens.astype(np.int64), n_known.astype(np.int64), base, text, words.take(pa.array(word)), times


def encoded_rows(rows: DataFrame, tokenizer: str, known: dict[bytes, int], total: int, distinct: int) -> DataFrame:
    """Per document: its ids with the end, its tokens, what the `known` words give, and all other
    words with how often they come; stored, each with a `row` of its own."""
    schema = T.StructType([rows.schema["doc_id"], rows.schema["held_out"]])
    schema = schema.add("ids", "binary").add("n_tokens", "long").add("n_known", "long").add("base", "double")
    schema = schema.add("rare", T.ArrayType(T.BinaryType())).add("rare_n", T.ArrayType(T.LongType()))
    shared = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, counts = subwords(tokenizer), shared.value
        scale = total + 0.5 * (distinct + 1)
        hot = pa.array(list(counts), pa.binary()), np.log10((np.array(list(counts.values()), np.int64) + 0.5) / scale)
        ends = counts.get(END_WORD, 0)
        for batch in slices(batches, "text", SLICE_BYTES):
            n = batch.num_rows
            made = [_measured(texts, encoder, hot) for texts in in_parts(batch.column("text"))]
            ids, *figures = zip(*made)
            ids = ids[0] if len(made) == 1 else pa.array([b"".join(x[0].as_py() for x in ids)], pa.binary())
            n_tokens, n_known, base = (np.sum(x, axis=0) for x in figures[:3])
            text, word, often = np.concatenate(figures[3]), pa.concat_arrays(figures[4]), np.concatenate(figures[5])
            if ends:
                n_known, base = n_known + 1, base + np.log10((ends + 0.5) / scale)
            else:
                text, often = np.append(text, np.arange(n)), np.append(often, np.ones(n, np.int64))
                word = pa.concat_arrays([word, pa.array([END_WORD] * n, pa.binary())])
            order = np.argsort(text, kind="stable")
            bounds = pa.array(np.append(0, np.cumsum(np.bincount(text, minlength=n))).astype(np.int32))
            rare = pa.ListArray.from_arrays(bounds, word.take(pa.array(order)))
            rare_n = pa.ListArray.from_arrays(bounds, pa.array(often[order]))
            ids = pc.binary_join_element_wise(ids, np.array([START], "<u2").tobytes(), b"")
            arrays = [ids, *(pa.array(x) for x in (n_tokens + 1, n_known, base)), rare, rare_n]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *arrays], names=schema.names)

    return stored(mapped(rows, run, schema).withColumn("row", F.monotonically_increasing_id()), "encoded")


def score_documents(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score (log10, the attention model's own).

    NULL text is empty: only the end is scored. A NULL id counts as the empty text for
    the fold. Without any training document every count is 0 and the model is the
    untrained one. Repeated rows count each. A text is held whole, with its ids and some
    hundred bytes for each of its distinct words. Other columns are not looked at.
    """
    held_out = F.pmod(text_id_crc(id_column), F.lit(FOLDS)) == HELD_OUT
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), held_out.alias("held_out"), filled(text_column).alias("text"))
    counts = word_counts(rows)
    figures = counts.agg(F.count("*").alias("v"), F.sum("n").alias("n")).first()
    distinct, total = int(figures.v or 0), int(figures.n or 0)
    short = counts.filter(F.octet_length("word") <= HOT_BYTES)
    known = short.filter(F.col("n") >= least_count(short, HOT_WORDS)).collect()  # HOT_WORDS rows at most
    encoded = encoded_rows(rows, tokenizer, {bytes(r.word): r.n for r in known}, total, distinct)
    pairs = pair_counts(encoded)
    trained = train_model(encoded, pairs)
    model = rows.sparkSession.sparkContext.broadcast(trained)  # its size is fixed by the vocabulary
    # Words that are not everywhere known: joined with their counts, and added up by document.
    rare = encoded.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("w")).select("row", F.col("w.rare").alias("word"), F.col("w.rare_n").alias("often"))
    found = rare.join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    log = F.log10((F.col("n") + 0.5) / (total + 0.5 * (distinct + 1)))
    added = found.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("often")).otherwise(0)).alias("more_known"), F.sum(F.col("often") * log).alias("more_base")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids", 1_000_000):
            sequences = _ids(batch)
            logs = model.value.token_logs(sequences)
            own = np.repeat(np.arange(len(sequences)), [len(x) for x in sequences])
            columns = [batch.column(c) for c in ("doc_id", "held_out", "n_tokens", "n_known", "base", "row")]
            columns.append(pa.array(np.bincount(own, logs, len(sequences))))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "base", "row", "score"])

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, row long, score double"
    scored = mapped(encoded.select("doc_id", "held_out", "ids", "n_tokens", "n_known", "base", "row"), run, schema)
    if trained.least > 1:  # there are pairs that not every task knows
        scored = scored.join(rare_gains(encoded, pairs.filter(F.col("n") < trained.least), model), "row", "left")
        scored = scored.withColumn("score", F.col("score") + F.coalesce("gained", F.lit(0.0)))
    return scored.join(added, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        "score",
    )
