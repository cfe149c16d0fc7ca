"""Best-two-fit packing of tokenised documents into sequences.

A sequence is filled greedily with the longest pieces that fit; then its smallest
piece gives way to two others if these fill the widened gap better. All that counts
is how many pieces there are of each length, so the packing is planned on that
histogram, which never holds more than one number per possible length: a plan is a
list of fillings, each with how often it is used. Pieces of a length are numbered
in parallel, and the number says which sequence and place a piece gets.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import mapped, slices, stored
from rivulet.llm.subwords import subwords

CAPACITY = 1024
END = 2
SALTS = 512


def piece_bounds(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity or capacity
    return [(0, first), *[(start, capacity) for start in range(first, length, capacity)]]


def tokenized_pieces(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text",
    capacity: int = CAPACITY, end: int = END, keep_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, salt) and, if asked for, the ids as binary.

    `salt` deals out the pieces evenly, equal ones too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, count = subwords(tokenizer), 0
        for batch in slices(batches, "text"):
            ids = batch.column("doc_id")
            rows, pieces = [], []
            for at, own in enumerate(encoder.encode([t or "" for t in batch.column("text").to_pylist()])):
                own = np.append(own, np.uint32(end)).astype("<u4")
                for number, (start, length) in enumerate(piece_bounds(len(own), capacity)):
                    piece = own[start : start + length].tobytes()
                    rows.append((at, number, start, length, zlib.crc32(piece), count % SALTS))
                    count += 1
                    if keep_ids:
                        pieces.append(piece)
            at, number, start, length, crc, salt = (np.array(c) for c in zip(*rows))
            columns = [
                ids.take(pa.array(at)),
                pa.array(number, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
                pa.array(salt, pa.int32()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "salt"]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(pieces, pa.binary())] * keep_ids, names=names + ["ids"] * keep_ids)

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kinds = [("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long"), ("salt", "integer")]
    schema = T.StructType([rows.schema["doc_id"]])
    for name, kind in kinds + [("ids", "binary")] * keep_ids:
        schema = schema.add(name, kind)
    return mapped(rows, run, schema)


def _fill(counts: np.ndarray, capacity: int) -> list[int]:
    """One sequence's lengths, longest first, from what is left of each length."""
    left, gap, chosen = counts, capacity, []
    used = np.zeros_like(counts)
    while gap:
        fits = np.flatnonzero((left - used)[: gap + 1] > 0)
        if not len(fits):
            break
        chosen.append(int(fits[-1]))
        used[fits[-1]] += 1
        gap -= chosen[-1]
    if not gap or not chosen:
        return chosen
    smallest, room = chosen[-1], gap + chosen[-1]
    free = left - used
    free[smallest] += 1
    for total in range(room, smallest, -1):
        half = free[: total + 1] > 0
        pairs = np.flatnonzero(half & half[::-1])
        pairs = pairs[(pairs * 2 != total) | (free[pairs] > 1)]
        if len(pairs):
            x = int(pairs[-1])
            return sorted([*chosen[:-1], x, total - x], reverse=True)
    return chosen


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """Fillings and how often each is used; every piece of the histogram has one place."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in histogram.items():
        counts[length] = count
    plan = []
    while counts.any():
        chosen = _fill(counts, capacity)
        lengths, need = np.unique(chosen, return_counts=True)
        times = int((counts[lengths] // need).min())
        counts[lengths] -= need * times
        plan.append((times, chosen))
    return plan


def _places(plan: list[tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """Per length, rows (first number, first sequence, pieces per sequence, offset)."""
    places: dict[int, list] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for times, chosen in plan:
        offset = 0
        for length in sorted(set(chosen), reverse=True):
            each = chosen.count(length)
            places.setdefault(length, []).append((taken.get(length, 0), sequence, each, offset))
            taken[length] = taken.get(length, 0) + times * each
            offset += each * length
        sequence += times
    return {length: np.array(rows, dtype=np.int64) for length, rows in places.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` (with length and salt, stored) plus sequence_id and offset, without salt.

    The histogram that comes to the driver has at most `capacity` rows.
    """
    cells = stored(pieces.groupBy("length", "salt").agg(F.count("*").alias("count")), "pack-cells")
    histogram = {r.length: r["sum(count)"] for r in cells.groupBy("length").sum("count").collect()}
    places = _places(plan_sequences(histogram, capacity))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    inner = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    numbered = pieces.withColumn("_inner", inner).join(starts, ["length", "salt"])
    numbered = numbered.withColumn("_number", F.col("_before") + F.col("_inner") - 1)
    keep = [c for c in pieces.columns if c != "salt"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, numbers = (batch.column(c).to_numpy() for c in ("length", "_number"))
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths):
                own = lengths == length
                rows = places[int(length)]
                row = rows[np.searchsorted(rows[:, 0], numbers[own], side="right") - 1]
                at = numbers[own] - row[:, 0]
                sequence[own] = row[:, 1] + at // row[:, 2]
                offset[own] = row[:, 3] + at % row[:, 2] * length
            columns = [*[batch.column(c) for c in keep], pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "sequence_id", "offset"])

    schema = T.StructType([pieces.schema[c] for c in keep]).add("sequence_id", "long").add("offset", "long")
    return mapped(numbered.select(*keep, "_number"), place, schema)


def packed_documents(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, keep_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids), sequence_id, offset.

    A NULL or empty text is one piece of one token, the end. Repeated rows are packed
    each. An empty table gives an empty result; other columns are not looked at.
    """
    pieces = tokenized_pieces(docs, tokenizer, id_column, text_column, capacity, keep_ids=keep_ids)
    return pack(stored(pieces, "pack-pieces"), capacity)
