"""Near-duplicate vectors by a join of leaves within reach.

Vectors of length one are rotated at random, and their space is cut into leaves. Each
vector goes to its own leaf and no other; the vectors of a leaf are packed into rows of
some megabytes, each with the box that they fill. Packs whose boxes are within the
distance that the cosine allows meet, each two of them once: a product says which of
their vectors may be near, and these are held against the exact cosine.

Packs meet in a product of the stored rows with themselves, so no vector is written once
for each meeting: what lies on disk goes by the vectors, what is computed by the meetings.
Nothing grows with the square of a crowd of like vectors: equal vectors are one node
with a number of copies, and vectors that lie so near one pivot that all of them must
be linked are counted, not compared. Pairs never leave a task; what does is how many
links each node has there, and one link per node that joins its component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import mapped, stored
from rivulet.llm.near import connected

COSINE = 0.95
# Nodes that a leaf should hold, and bytes that a pack takes in a task, its vectors and their directions.
LEAF_NODES = 65_536
PART_BYTES = 8_000_000
# The sample that leaves and pivots are fitted on; every vector is then dealt by them.
SAMPLE_NODES = 8192
SAMPLE_BYTES = 16_000_000
# A pivot has one in so many vectors of the sample near it.
PIVOT_SHARE = 500
# A vector with more than one row in so many copies is hot: there are fewer of them.
HOT_SHARE = 500
SLACK = 1e-5
# Of each side of a product, so that what it gives fits a core's cache.
ROWS_AT_ONCE, COLUMNS_AT_ONCE = 512, 512
# Pairs of two equal crowds that are looked at and dropped; where there are more, they are not looked at.
CROWD_PAIRS = 65_536


@lru_cache(maxsize=4)
def rotation(size: int) -> np.ndarray:
    """A random orthogonal matrix, the same for each size."""
    q, r = np.linalg.qr(np.random.default_rng(size).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def budget(cosine: float) -> float:
    """Squared distance that two linked vectors of length one may have."""
    return 2 - 2 * cosine + SLACK


@dataclass
class Leaves:
    """Boxes that fill the space."""

    low: np.ndarray
    high: np.ndarray

    @classmethod
    def fitted(cls, points: np.ndarray, count: int) -> Leaves:
        """`count` boxes (or fewer) with about equally many of `points` in each, halved along the widest spread."""
        size = points.shape[1]
        todo, done = [(np.full(size, -np.inf), np.full(size, np.inf), points)], []
        while todo:
            low, high, own = todo.pop()
            axis = int(own.std(axis=0).argmax()) if len(own) else 0
            middle = float(np.median(own[:, axis])) if len(own) else 0.0
            below = own[:, axis] < middle
            if len(own) <= max(1, len(points) / max(1, count)) * 1.5 or not below.any():
                done.append((low, high))
                continue
            upper, lower = low.copy(), high.copy()
            upper[axis] = lower[axis] = middle
            todo += [(low, lower, own[below]), (upper, high, own[~below])]
        return cls(np.array([x for x, _ in done]), np.array([y for _, y in done]))

    def dealt(self, points: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(home of each point; point and leaf for each leaf of smaller number within squared distance `reach`)."""
        home = np.zeros(len(points), dtype=np.int64)
        rows, leaves = [], []
        inside = [((points >= a) & (points < b)).all(axis=1) for a, b in zip(self.low, self.high)]
        for leaf, own in enumerate(inside):
            home[own] = leaf
        for leaf, (a, b) in enumerate(zip(self.low, self.high)):
            later = np.flatnonzero(home > leaf)
            apart = np.maximum(np.maximum(a - points[later], points[later] - b), 0.0)
            near = later[(apart * apart).sum(axis=1) <= reach]
            rows.append(near)
            leaves.append(np.full(len(near), leaf))
        return home, np.concatenate(rows), np.concatenate(leaves)


def crowd_radius(cosine: float) -> float:
    """Vectors within this distance of one point are all linked with each other."""
    return (2 - 2 * cosine) ** 0.5 / 2 * (1 - 1e-4)


def fitted_pivots(sample: np.ndarray, cosine: float) -> np.ndarray:
    """Centres of crowds, in the order of their size."""
    radius, left, out = crowd_radius(cosine), sample.astype(np.float64), []
    least = max(8, len(sample) / PIVOT_SHARE)
    while len(left) >= least:
        counts = np.zeros(len(left), dtype=np.int64)
        for at in range(0, len(left), ROWS_AT_ONCE):
            counts[at : at + ROWS_AT_ONCE] = (2 - 2 * left[at : at + ROWS_AT_ONCE] @ left.T <= radius**2).sum(axis=1)
        if counts.max() < least:
            break
        middle = counts.argmax()
        out.append(left[2 - 2 * left @ left[middle] <= radius**2].mean(axis=0))
        stays = ((left - out[-1]) ** 2).sum(axis=1) > radius**2
        stays[middle] = False
        left = left[stays]
    return np.array(out).reshape(len(out), sample.shape[1])


def _prepared(kind: str):
    """Rows (id, key, size, data): what a vector is named by, and its components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, data = [], [], []
            for scalar in batch.column("vector"):
                values = scalar.values
                usable = values is not None and len(values) > 0 and values.null_count == 0
                vector = values.to_numpy(zero_copy_only=False).astype(kind) if usable else None
                usable = usable and bool(np.isfinite(vector).all()) and bool(vector.any())
                if usable:
                    # By a power of two near one, so that no square overflows or vanishes.
                    vector = np.ldexp(vector, -np.frexp(np.abs(vector).max())[1]) + 0.0
                    data.append(vector.astype(kind).tobytes())
                    keys.append(hashlib.sha256(data[-1]).digest())
                    sizes.append(len(vector))
                else:
                    for column in (keys, sizes, data):
                        column.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(data, pa.binary())],
                names=["vec_id", "key", "size", "data"],
            )

    return run


def _matrix(column: pa.ChunkedArray | pa.Array, kind: str, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, size)


def _directions(data: np.ndarray) -> np.ndarray:
    wide = data.astype(np.float64)
    return wide / np.linalg.norm(wide, axis=1)[:, None]


def _turned(data: np.ndarray) -> np.ndarray:
    """Rotated directions."""
    return (_directions(data) @ rotation(data.shape[1])).astype("<f4")


def _placed(kind: str, fits: dict, cosine: float):
    """A row (size, leaf, crowd, key, data, copies, least) per distinct vector of a batch of rows (vec_id, vector)."""
    radius, prepared = crowd_radius(cosine), _prepared(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in prepared(batches):
            table = pa.table({"key": batch.column("key"), "vec_id": batch.column("vec_id"), "at": pa.array(np.arange(batch.num_rows))})
            table = table.filter(pc.is_valid(table.column("key"))).group_by("key", use_threads=False)
            table = table.aggregate([("at", "min"), ("at", "count"), ("vec_id", "min")])
            own = batch.take(table.column("at_min").combine_chunks())
            sizes = own.column("size").to_numpy()
            leaf, crowd = np.zeros(len(sizes), np.int32), np.full(len(sizes), -1, np.int32)
            for size in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == size)
                points = _turned(_matrix(own.column("data").take(pa.array(mine)), kind, size)).astype(np.float64)
                leaves, pivots = fits.get(size, (None, np.zeros((0, size))))
                if len(pivots):
                    apart = np.stack([((points - p) ** 2).sum(axis=1) for p in pivots], axis=1)
                    crowd[mine] = np.where(apart.min(axis=1) <= radius**2, apart.argmin(axis=1), -1)
                if leaves:
                    leaf[mine] = leaves.dealt(points, -1.0)[0]
            columns = [own.column("size"), pa.array(leaf), pa.array(crowd), own.column("key"), own.column("data")]
            columns += [table.column(c).combine_chunks() for c in ("at_count", "vec_id_min")]
            yield pa.RecordBatch.from_arrays(columns, names=["size", "leaf", "crowd", "key", "data", "copies", "least"])

    return run


PLACED = "size int, leaf int, crowd int, key binary, data binary, copies long, least long"
PACK = (
    "pack long, size int, first long, only int, box array<struct<low: float, high: float>>, "
    "crowd binary, copies binary, data binary, keys binary, least array<long>"
)


def _packs(kind: str):
    """Packs of sorted placed rows, equal ones as one node: a leaf's nodes, numbered from `first` on, by crowd."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = node = TaskContext.get().partitionId() << 33
        held: list[pa.Table] = []
        count = 0

        def pack() -> pa.RecordBatch:
            nonlocal number, node, held, count
            table, size = pa.concat_tables(held).combine_chunks(), held[0].column("size")[0].as_py()
            data, crowd = _matrix(table.column("data"), kind, size), table.column("crowd").to_numpy()
            turned = _turned(data)
            box = [{"low": a, "high": b} for a, b in zip(turned.min(axis=0).tolist(), turned.max(axis=0).tolist())]
            row = {"pack": number, "size": size, "first": node, "only": int(crowd[0]) if crowd[0] == crowd[-1] else -1, "box": box}
            row |= {"crowd": crowd.astype("<i4").tobytes(), "copies": table.column("copies").to_numpy().astype("<i8").tobytes()}
            row |= {"data": data.tobytes(), "keys": b"".join(table.column("key").to_pylist()), "least": table.column("least").to_pylist()}
            number, node, held, count = number + 1, node + table.num_rows, [], 0
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.struct([("low", pa.float32()), ("high", pa.float32())]))]
            kinds += [pa.binary()] * 4 + [pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), kinds)], names=list(row))

        def added(table: pa.Table) -> Iterator[pa.RecordBatch]:
            """Distinct nodes; packs that are full or whose leaf is over."""
            nonlocal count
            size, leaf = (table.column(c).to_numpy() for c in ("size", "leaf"))
            new = np.flatnonzero((size[1:] != size[:-1]) | (leaf[1:] != leaf[:-1])) + 1
            for a, b in zip([0, *new.tolist()], [*new.tolist(), len(size)]):
                if held and (held[-1].column("size")[0].as_py(), held[-1].column("leaf")[0].as_py()) != (int(size[a]), int(leaf[a])):
                    yield pack()
                room = max(1, PART_BYTES // (8 * int(size[a])))
                while a < b:
                    some = min(b - a, room - count)
                    held.append(table.slice(a, some))
                    count, a = count + some, a + some
                    if count >= room:
                        yield pack()

        rest: pa.Table | None = None  # the last node, of which more may come
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = (pa.concat_tables([rest, table]) if rest is not None else table).combine_chunks()
            key = table.column("key").chunk(0)
            starts = np.append(0, np.flatnonzero(pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)) + 1)
            if len(starts) < table.num_rows:
                group = pa.array(np.repeat(np.arange(len(starts)), np.diff(np.append(starts, table.num_rows))))
                sums = table.select(["copies", "least"]).append_column("group", group).group_by("group", use_threads=False)
                sums = sums.aggregate([("copies", "sum"), ("least", "min")])
                table = table.take(pa.array(starts))
                for c, name in (("copies", "copies_sum"), ("least", "least_min")):
                    table = table.set_column(table.schema.get_field_index(c), c, sums.column(name))
            rest = table.slice(table.num_rows - 1)
            yield from added(table.slice(0, table.num_rows - 1)) if table.num_rows > 1 else ()
        if rest is not None:
            yield from added(rest)
            if held:
                yield pack()

    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row (node, size, crowd, key, copies, least) per node of packs."""
    for batch in batches:
        for i in range(batch.num_rows):
            crowd, copies = np.frombuffer(batch.column("crowd")[i].as_buffer(), "<i4"), np.frombuffer(batch.column("copies")[i].as_buffer(), "<i8")
            keys = batch.column("keys")[i].as_py()
            first, n = batch.column("first")[i].as_py(), len(crowd)
            size = np.full(n, batch.column("size")[i].as_py(), np.int32)
            columns = [np.arange(first, first + n), size, crowd, [keys[32 * k : 32 * k + 32] for k in range(n)], copies]
            columns = [*map(pa.array, columns), batch.column("least")[i].values]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "size", "crowd", "key", "copies", "least"])


NODE = "node long, size int, crowd int, key binary, copies long, least long"


def _lowest(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the classes of linked a and b in `label`, where each row names a row of its class."""
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return
        least = np.minimum(x, y)
        np.minimum.at(label, x, least)
        np.minimum.at(label, y, least)
        while (label[label] != label).any():
            label[:] = label[label]


class _Side:
    """A pack in a task."""

    def __init__(self, batch: pa.RecordBatch, i: int, side: str, kind: str):
        one = lambda name: batch.column(f"{side}_{name}")[i]
        self.pack, self.first, size = one("pack").as_py(), one("first").as_py(), one("size").as_py()
        self.crowd, self.copies = np.frombuffer(one("crowd").as_buffer(), "<i4"), np.frombuffer(one("copies").as_buffer(), "<i8")
        self.data = np.frombuffer(one("data").as_buffer(), kind).reshape(-1, size)
        self.ways = _directions(self.data)
        self.turned = (self.ways @ rotation(size)).astype("<f4")
        self.ways = self.ways.astype("<f4")
        self.low, self.high = self.turned.min(axis=0), self.turned.max(axis=0)

    def near(self, other: _Side, reach: float) -> np.ndarray:
        """Its nodes within reach of the other's box."""
        apart = np.maximum(np.maximum(other.low - self.turned, self.turned - other.high), np.float32(0))
        return np.flatnonzero((apart * apart).sum(axis=1) <= reach)


def _candidates(a: _Side, b: _Side, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(node of a, node of b) that may be linked, each pair once, those of one crowd left out."""
    alike, size = a.pack == b.pack, a.data.shape[1]
    reach, least = budget(cosine) + 1e-4, np.float32(cosine - SLACK - 1e-7 * size)
    left, right = (np.arange(len(a.crowd)),) * 2 if alike else (a.near(b, reach), b.near(a, reach))
    if not len(left) or not len(right):
        return
    x, y, crowd, other = a.ways[left], b.ways[right], a.crowd[left], b.crowd[right]
    # Nodes stand by crowd. What a large crowd has on both sides is passed over.
    cuts = np.flatnonzero(np.append(True, crowd[1:] != crowd[:-1]))
    segments: list[tuple[int, int, list[tuple[int, int]]]] = []
    for begin, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(crowd)]):
        low, high = (int(np.searchsorted(other, crowd[begin], side)) for side in ("left", "right"))
        if crowd[begin] >= 0 and (high - low) * (end - begin) > CROWD_PAIRS:
            segments.append((begin, end, [(0, low), (high, len(other))]))
        elif segments and segments[-1][1] == begin and segments[-1][2] == [(0, len(other))]:
            segments[-1] = (segments[-1][0], end, segments[-1][2])
        else:
            segments.append((begin, end, [(0, len(other))]))
    for begin, end, ranges in segments:
        for at in range(begin, end, ROWS_AT_ONCE):
            rows = x[at : min(at + ROWS_AT_ONCE, end)]
            for low, high in ranges:
                for start in range(max(low, at) if alike else low, high, COLUMNS_AT_ONCE):
                    found = rows @ y[start : min(start + COLUMNS_AT_ONCE, high)].T
                    if found.max() < least:
                        continue
                    i, j = np.nonzero(found >= least)
                    i, j = i + at, j + start
                    met = (crowd[i] < 0) | (crowd[i] != other[j])
                    if alike:
                        met &= i < j
                    yield left[i[met]], right[j[met]]


def _compared(kind: str, cosine: float):
    """(node, links, joined) of pairs of packs: of each node the copies it links with here, and a node of its component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = None
        for batch in batches:
            for row in range(batch.num_rows):
                if a is None or a.pack != batch.column("a_pack")[row].as_py():
                    a = _Side(batch, row, "a", kind)
                b = a if a.pack == batch.column("b_pack")[row].as_py() else _Side(batch, row, "b", kind)
                n, m = len(a.crowd), 0 if b is a else len(b.crowd)
                links, label, to = np.zeros(n + m, dtype=np.int64), np.arange(n + m), 0 if b is a else n
                for left, right in _candidates(a, b, cosine):
                    for start in range(0, len(left), 16 * ROWS_AT_ONCE):
                        i, j = left[start : start + 16 * ROWS_AT_ONCE], right[start : start + 16 * ROWS_AT_ONCE]
                        u, v = a.data[i].astype(np.float64), b.data[j].astype(np.float64)
                        norms = np.sqrt((u * u).sum(axis=1)) * np.sqrt((v * v).sum(axis=1))
                        good = (u * v).sum(axis=1) / norms >= cosine
                        i, j = i[good], j[good]
                        np.add.at(links, i, b.copies[j])
                        np.add.at(links, to + j, a.copies[i])
                        _lowest(label, i, to + j)
                some = np.flatnonzero(links)
                node = np.concatenate([a.first + np.arange(n), b.first + np.arange(m)])
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (node[some], links[some], node[label[some]])], names=["node", "links", "joined"])

    return run


def _meetings(packs: DataFrame, cosine: float) -> DataFrame:
    """Each two packs within reach once, and each with itself; a product of the stored rows, no shuffle."""
    columns = ["pack", "size", "first", "only", "box", "crowd", "copies", "data"]
    a, b = (packs.select([F.col(c).alias(f"{side}_{c}") for c in columns]) for side in "ab")
    gap = lambda x, y: F.greatest(x["low"] - y["high"], y["low"] - x["high"], F.lit(0.0).cast("float")).cast("double")
    apart = F.aggregate(F.zip_with("a_box", "b_box", gap), F.lit(0.0), lambda total, x: total + x * x)
    # Of two different packs the one or the other asks, so that all tasks have as much to do.
    odd = F.xxhash64("a_pack").bitwiseXOR(F.xxhash64("b_pack")).bitwiseAND(F.lit(1)) == 1
    turn = F.when(F.col("a_pack") < F.col("b_pack"), odd).otherwise((F.col("a_pack") == F.col("b_pack")) | ~odd)
    crowd: Column = (F.col("a_only") >= 0) & (F.col("a_only") == F.col("b_only"))
    # Sizes are compared as a range: an equality would be a join by a shuffle to one task for each size.
    alike = (F.col("a_size") <= F.col("b_size")) & (F.col("a_size") >= F.col("b_size"))
    met = a.join(b, alike & turn & ~crowd & (apart <= budget(cosine) + 1e-4))
    return met.drop("a_only", "b_only", "a_box", "b_box")


def _fits(prepared: DataFrame, ids: DataFrame, kind: str, cosine: float) -> dict:
    """{size: (leaves, pivots)}, fitted on a bounded sample of each size."""
    fits = {}
    for size, count in ids.filter("key IS NOT NULL").groupBy("size").agg(F.approx_count_distinct("key")).collect():
        rows = max(64, min(SAMPLE_NODES, SAMPLE_BYTES // (4 * size)))
        drawn = F.pmod(F.xxhash64("key"), F.lit(max(1, count))) < rows
        sample = prepared.filter((F.col("size") == size) & drawn).groupBy("key").agg(F.first("data").alias("data"))
        data = b"".join(bytes(r.data) for r in sample.orderBy("key").limit(2 * rows).select("data").collect())
        points = _turned(np.frombuffer(data, kind).reshape(-1, size)).astype(np.float64)
        fits[size] = Leaves.fitted(points, -(-count // LEAF_NODES)), fitted_pivots(points, cosine)
    return fits


def near_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """One row per row of `vectors`: vec_id, n_links, component_id, kept.

    Rows whose vectors have a cosine of at least `cosine`, in double precision, are
    linked, repeated rows too; vectors of different lengths never are. A vector that is
    NULL, empty, zero or holds NULL or non-finite components is alone. A component is
    named after its smallest id; without any id its name is NULL. An empty table gives
    an empty result; other columns are not looked at.
    """
    element = vectors.schema[vector_column].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    array = F.col(vector_column).cast("array<float>" if kind == "<f4" else "array<double>")
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), array.alias("vector"))
    prepared = mapped(rows, _prepared(kind), "vec_id long, key binary, size int, data binary")
    ids = stored(prepared.select("vec_id", "key", "size"), "vector-ids")
    fits = _fits(prepared, ids, kind, cosine)
    total = ids.agg(F.count("*").alias("n"), F.sum(F.col("size").cast("long") * 8).alias("bytes")).first()
    place = ["size", "leaf", "crowd", "key"]
    placed = mapped(rows, _placed(kind, fits, cosine), PLACED)
    placed = placed.repartitionByRange(max(1, -(-(total.bytes or 0) // PART_BYTES)), *place).sortWithinPartitions(*place)
    packs = stored(mapped(placed, _packs(kind), PACK), "vector-packs")
    found = stored(mapped(_meetings(packs, cosine), _compared(kind, cosine), "node long, links long, joined long"), "vector-links")
    nodes = mapped(packs.select("first", "size", "crowd", "copies", "keys", "least"), _unpacked, NODE)
    crowds = nodes.filter("crowd >= 0").select("size", "crowd", "node", "copies")
    sums = crowds.groupBy("size", "crowd").agg(F.sum("copies").alias("crowded"), F.min("node").alias("joined"))
    crowds = crowds.join(F.broadcast(sums), ["size", "crowd"])  # a crowd has a share of its own, so there are few
    crowds = stored(crowds.select("node", (F.col("crowded") - F.col("copies")).alias("links"), "joined"), "crowds")
    every = found.unionByName(crowds)
    classes = connected(every.filter("node <> joined").select(F.col("node").alias("a"), F.col("joined").alias("b")))
    per_node = nodes.select("node", "copies", "least").join(every.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
    per_node = per_node.join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))
    per_node = stored(per_node.withColumn("n_links", F.coalesce("links", F.lit(0).cast("long")) + F.col("copies") - 1), "vector-classes")
    least = per_node.groupBy("class").agg(F.min("least").alias("component_id"))
    named = per_node.join(least, "class").join(nodes.select("node", "key"), "node")
    named = stored(named.select("key", "copies", "n_links", "component_id"), "vector-names")
    # Few vectors can have so many copies; they are joined without moving their rows.
    limit = F.col("copies") > max(1000, total.n / HOT_SHARE)
    hot = [bytes(r.key) for r in named.filter(limit).select("key").collect()]
    ids = ids.select("vec_id", "key")
    result = ids.filter(F.col("key").isNotNull() & ~F.col("key").isin(hot) if hot else F.col("key").isNotNull()).join(named, "key")
    if hot:
        result = result.unionByName(ids.filter(F.col("key").isin(hot)).join(F.broadcast(named.filter(limit)), "key"))
    alone = ids.filter(F.col("key").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    result = result.select("vec_id", "n_links", "component_id").unionByName(alone)
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
