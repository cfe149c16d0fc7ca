"""Documents packed into chunks, and a request-and-reply exchange between chunks.

Work on whole texts with array operations needs many documents at a time. A chunk is
one row with about `CHUNK_BYTES` of text. What chunks must know about all others (is
this fingerprint elsewhere, how often is this word there) goes by keys: each chunk
sends one small block of its distinct keys to each part of the key space, a part
answers each block, and a join brings a chunk its answers. A key is sent once per
chunk, however often it occurs, so no key is hot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import mapped, slices, stored

CHUNK_BYTES = 2_000_000
# Text per part of the key space.
PART_BYTES = 16_000_000
LEAST_PARTS = 64


@lru_cache(maxsize=1)
def _codec() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """Made once in a process: to make them takes longer than a small block does."""
    return zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def squeeze(data: bytes) -> bytes:
    return _codec()[0].compress(data)


def expand(data: bytes) -> bytes:
    return _codec()[1].decompress(data)


def array_of(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(expand(data), dtype=kind)


def pack_chunks(docs: DataFrame, more: tuple[str, ...] = (), marks: Callable[[bytes, list[int]], bytes] | None = None) -> DataFrame:
    """(chunk, ids, .., lengths, data) of (doc_id, text, ..), stored; data is compressed UTF-8.

    NULL text is empty. A text longer than a chunk is a chunk. A column `marks` holds what
    that function makes of the bytes of a chunk and their lengths.
    """
    columns = ["doc_id", *more]
    arrays = [T.StructField(c, T.ArrayType(docs.schema[c].dataType)) for c in columns]
    schema = T.StructType([T.StructField("chunk", T.LongType()), *arrays])
    schema.add("lengths", T.ArrayType(T.LongType())).add("bytes", T.LongType()).add("data", T.BinaryType())
    if marks:
        schema.add("marks", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0

        def emit():
            nonlocal number, held, size
            texts = [t.encode() for b in held for t in b.column("text").fill_null("").to_pylist()]
            lists = [pa.array([[v for b in held for v in b.column(c).to_pylist()]], pa.list_(held[0].schema.field(c).type)) for c in columns]
            data = b"".join(texts)
            lengths = [len(t) for t in texts]
            out = [pa.array([number], pa.int64()), *lists, pa.array([lengths], pa.list_(pa.int64()))]
            out += [pa.array([len(data)], pa.int64()), pa.array([squeeze(data)], pa.binary())]
            out += [pa.array([marks(data, lengths)], pa.binary())] if marks else []
            number, held, size = number + 1, [], 0
            return pa.RecordBatch.from_arrays(out, names=schema.names)

        for batch in slices(batches, "text", CHUNK_BYTES):
            own = batch.nbytes
            if held and size + own > CHUNK_BYTES:
                yield emit()
            held.append(batch)
            size += own
        if held:
            yield emit()

    return stored(mapped(docs.select(*columns, "text"), run, schema), "chunks")


def part_count(chunks: DataFrame) -> int:
    total = chunks.agg(F.sum("bytes").alias("bytes")).first().bytes or 0
    return max(LEAST_PARTS, -(-total // PART_BYTES))


def ask(chunks: DataFrame, requests: Callable[[dict], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """(chunk, part, request): what `requests` makes of each chunk, a block per part."""
    columns = chunks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in columns}
                made = list(requests(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["chunk"]] * len(made), pa.int64()), pa.array([p for p, _ in made], pa.int64()), pa.array([b for _, b in made], pa.binary())],
                    names=["chunk", "part", "request"],
                )

    return mapped(chunks, run, "chunk long, part long, request binary")


def answer(asked: DataFrame, replies: Callable[[list[bytes]], tuple[list[bytes], list[int]]]) -> DataFrame:
    """(chunk, reply, figure..): `replies` gets the blocks of one part and answers each.

    `figures` are numbers about the part as a whole; they stand on its first row.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        made, figures = replies(table.column("request").to_pylist())
        first = [figures] + [[0] * len(figures)] * (table.num_rows - 1)
        return pa.table(
            {"chunk": table.column("chunk"), "part": table.column("part"), "reply": pa.array(made, pa.binary()), "figures": pa.array(first, pa.list_(pa.int64()))}
        )

    grouped = asked.groupBy("part").applyInArrow(run, "chunk long, part long, reply binary, figures array<long>")
    return stored(grouped, "replies")


def with_replies(chunks: DataFrame, replies: DataFrame) -> DataFrame:
    """Chunks with their `replies`: an array of (part, reply), empty where there is none."""
    lists = replies.groupBy("chunk").agg(F.collect_list(F.struct("part", "reply")).alias("replies"))
    return chunks.join(lists, "chunk", "left")


def by_part(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parts that occur, cuts) that sort distinct keys into parts."""
    part = (keys % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((keys, part))
    found, cuts = np.unique(part[order], return_index=True)
    return order, found, np.append(cuts, len(keys))
