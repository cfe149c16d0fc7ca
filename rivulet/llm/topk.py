"""Exact top-k search by aggregation over sorted lists, without random access.

Every dimension is a list of the candidates sorted by that component, made once for a
shard of candidates. A query reads its lists from the end that favours it, all to
the same depth. What has been read of a candidate adds to its lower
bound (the rest at the lists' far ends) and lowers its upper bound (the rest at the
depth reached). What cannot reach the k-th best lower bound is out, the candidates that
no list has shown yet among them; when few are left, their final scores are resolved.

A block of queries meets the shards of a lane one after the other, and the k-th best
score so far goes with it as a bar, so later shards are read less deep. A lane returns
k rows per query. The bounds of all queries of a block are worked out together, as
products of the queries with what the lists have shown.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import mapped, stored

SHARD_ROWS = 4096
BLOCK_ROWS = 256
# Shards that a block of queries meets are dealt to so many tasks.
LANES = 4
# Places of each list that are read before bounds are first compared; then twice as many each time.
FIRST_DEPTH = 16
EXACT = 2.0**53  # whole numbers below this are exact in double precision


class Lists:
    """A shard: candidates as rows, and for each component their numbers in rising order."""

    def __init__(self, values: np.ndarray, ids: np.ndarray, order: np.ndarray):
        self.values, self.ids, self.order = values, ids, order.astype(np.int64)
        self.sorted = np.take_along_axis(values, self.order.T, axis=0).T

    @staticmethod
    def sort(values: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(np.argsort(values, axis=0, kind="stable").T)


def exact_scores(values: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Whole products, by Python's own numbers where double precision could round."""
    most = float(np.abs(values).max(initial=0)) * float(np.abs(query).max(initial=0)) * max(1, len(query))
    if most < EXACT:
        return (values.astype(float) @ query.astype(float)).astype(np.int64)
    made = values.astype(object) @ query.astype(object)
    if any(abs(x) >= 2**63 for x in made):
        raise OverflowError("a score does not fit in 64 bits")
    return made.astype(np.int64)


def nra(
    shard: Lists, queries: np.ndarray, query_ids: np.ndarray, k: int, bars: np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray, float]]:
    """(query, ids, scores, part of the lists read) of each query's k best candidates with another id.

    Ties go to the smaller id. Candidates that score less than the query's bar may be left
    out. The bounds of all queries still reading are products over what has been read.
    """
    n, size = shard.values.shape
    values, ordered = shard.values.astype(float), shard.sorted.T.astype(float)
    rank = np.empty((n, size), dtype=np.int64)
    np.put_along_axis(rank, shard.order.T, np.arange(n)[:, None], axis=0)
    positive, negative = np.maximum(queries, 0).astype(float), np.minimum(queries, 0).astype(float)
    lowest = positive @ ordered[0] + negative @ ordered[-1]
    # Bounds are doubles; what rounding may add to one must not throw out a candidate.
    slack = 1e-9 + 1e-12 * np.abs(queries).astype(float) @ np.abs(values).max(axis=0)
    reading, depth = np.arange(len(queries)), min(FIRST_DEPTH, n)
    while len(reading):
        up, down = positive[reading], negative[reading]
        seen_top, seen_bottom = rank >= n - depth, rank < depth
        # A component that a list has shown counts for itself, any other by its bound.
        low = lowest[reading][:, None] + up @ np.where(seen_top, values - ordered[0], 0.0).T
        low += down @ np.where(seen_bottom, values - ordered[-1], 0.0).T
        high = up @ np.where(seen_top, values, ordered[n - depth]).T
        high += down @ np.where(seen_bottom, values, ordered[depth - 1]).T
        own = shard.ids[None, :] == query_ids[reading][:, None]
        low[own] = -np.inf
        # The k-th best lower bound here, or the bar brought along; what cannot reach it is out.
        least = np.partition(low, n - k, axis=1)[:, n - k] if n > k else np.full(len(low), -np.inf)
        least = np.maximum(least, bars[reading]) - slack[reading]
        alive = (high + slack[reading][:, None] >= least[:, None]) & ~own
        done = (alive.sum(axis=1) <= max(4 * k, n // 64)) | (depth >= n)
        for at in np.flatnonzero(done):
            rest = np.flatnonzero(alive[at])
            scores = exact_scores(shard.values[rest], queries[reading[at]])
            best = np.lexsort((shard.ids[rest], -scores))[:k]
            yield int(reading[at]), shard.ids[rest][best], scores[best], depth / n
        reading = reading[~done]
        depth = min(n, depth * 2)


def _packed(rows: DataFrame, size: int, name: str, number: str) -> DataFrame:
    """(dim, parts, part, ids, numbers, data): about `size` vectors of one dimension in a row, as arrays."""
    count = F.greatest(F.ceil(F.col("n") / size), F.lit(1))
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n")).select("dim", count.cast("long").alias("parts"))
    part = F.pmod(F.xxhash64("vec_id", "vector", number), F.col("parts"))
    return (
        rows.join(sizes, "dim")
        .withColumn("part", part)
        .groupBy("dim", "parts", "part")
        .agg(
            F.collect_list("vec_id").alias(f"{name}_ids"),
            F.collect_list(number).alias(f"{name}_numbers"),
            F.flatten(F.collect_list("vector")).alias(name),
        )
    )


def _with_order(shards: DataFrame) -> DataFrame:
    """Shards with `order`, the sorted list of each component as 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for i in range(batch.num_rows):
                values = batch.column("vectors")[i].values.to_numpy(zero_copy_only=False)
                made.append(Lists.sort(values.reshape(-1, batch.column("dim")[i].as_py())).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=[*batch.schema.names, "order"])

    return mapped(shards, run, T.StructType([*shards.schema.fields, T.StructField("order", T.BinaryType())]))


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int, id_column: str = "vec_id", vector_column: str = "embedding", scale: float = 256.0,
    with_depth: bool = False,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner products.

    Components become floor(scale * x). A vector that is NULL or empty, or holds a NULL
    or non-finite component, takes no part, nor does a NULL id; vectors meet those
    of their own length. Rows with the query's id are not its candidates. Repeated
    candidate rows are each a candidate; a repeated query is asked once per distinct
    vector, and each of these has ranks of its own. Fewer candidates than k give fewer
    rows. Scores are exact; a component or score beyond 64 bits is an error. With
    `with_depth`, `depth` is the part of the lists that was read for the query.
    """

    def whole(rows: DataFrame) -> DataFrame:
        x = F.col(vector_column)
        bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        good = rows.filter(F.col(id_column).isNotNull() & x.isNotNull()).filter((F.size(x) > 0) & ~bad)

        def component(v):
            scaled = F.floor(v.cast("double") * scale)
            fits = F.abs(v.cast("double") * scale) < 2.0**63
            return F.when(fits, scaled.cast("long")).otherwise(F.raise_error(F.lit("a component does not fit in 64 bits")).cast("long"))

        plain = good.select(F.col(id_column).cast("long").alias("vec_id"), F.size(x).alias("dim"), F.transform(x, component).alias("vector"))
        return plain.groupBy("vec_id", "dim", "vector").agg(F.count("*").alias("copies"))

    # Of equal rows, no more than k can be among the best k.
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k).cast("long"))))
    shards = _packed(whole(vectors).withColumn("copy", copies), SHARD_ROWS, "vectors", "copy").drop("parts", "vectors_numbers")
    shards = stored(_with_order(shards), "vector-shards")
    asked = stored(whole(queries).withColumn("query", F.monotonically_increasing_id()), "queries")
    blocks = stored(_packed(asked, BLOCK_ROWS, "queries", "query"), "query-blocks")
    # Each shard once per block of queries of its dimension; those of a lane follow each other.
    per_dim = blocks.select("dim", "parts").distinct()
    visits = shards.join(per_dim, "dim").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    asking = blocks.select("dim", F.col("part").alias("block"), "queries_ids", "queries_numbers", "queries")
    meetings = visits.drop("parts").join(asking, ["dim", "block"]).withColumn("lane", F.pmod("part", F.lit(LANES)))
    tasks = max(1, blocks.count() * LANES)
    lanes = meetings.repartition(tasks, "dim", "block", "lane").sortWithinPartitions("dim", "block", "lane", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, best = None, {}

        def found():
            rows = [(number, query, i, s, depth / shards) for (number, query), (ids, scores, depth, shards) in best.items() for i, s in zip(ids.tolist(), scores.tolist())]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            return pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)], names=["query", "query_id", "vec_id", "score", "depth"]
            )

        for batch in batches:
            for i in range(batch.num_rows):
                at = tuple(batch.column(c)[i].as_py() for c in ("dim", "block", "lane"))
                if at != place:
                    if best:
                        yield found()
                    place, best = at, {}
                v, v_ids, q, q_ids, numbers = (
                    batch.column(c)[i].values.to_numpy(zero_copy_only=False)
                    for c in ("vectors", "vectors_ids", "queries", "queries_ids", "queries_numbers")
                )
                order = np.frombuffer(batch.column("order")[i].as_buffer(), dtype="<u4").reshape(at[0], -1)
                shard = Lists(v.reshape(-1, at[0]), v_ids, order)
                nothing = v_ids[:0], np.zeros(0, np.int64), 0.0, 0
                held = [best.get(x, nothing) for x in zip(numbers.tolist(), q_ids.tolist())]
                bars = np.array([float(scores[-1]) if len(scores) == k else -np.inf for _, scores, _, _ in held])
                for at_query, new, more, read in nra(shard, q.reshape(-1, at[0]), q_ids, k, bars):
                    ids, scores, depth, met = held[at_query]
                    ids, scores = np.append(ids, new), np.append(scores, more)
                    top = np.lexsort((ids, -scores))[:k]
                    best[int(numbers[at_query]), int(q_ids[at_query])] = ids[top], scores[top], depth + read, met + 1
        if best:
            yield found()

    columns = lanes.select("dim", "block", "lane", "vectors", "vectors_ids", "order", "queries", "queries_ids", "queries_numbers")
    found = mapped(columns, run, "query long, query_id long, vec_id long, score long, depth double")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    every = Window.partitionBy("query_id", "query")
    ranked = found.withColumns({"rank": F.row_number().over(order), "depth": F.avg("depth").over(every)}) if with_depth else found.withColumn("rank", F.row_number().over(order))
    ranked = ranked.filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", *["depth"][: int(with_depth)])
