"""Near-duplicates by ProbMinHash signatures.

Shingles of five words, weighted by how often they occur. Each shingle is a Poisson
process whose rate is its weight; its arrivals fall into random registers, and a
register keeps the shingle that came first. Two documents agree in a register with
the probability of their probability Jaccard similarity. Arrivals are drawn only until none
can come before the slowest register. Bands of registers give buckets; candidates are
checked by the exact similarity of their shingles; links become classes.

Buckets are never expanded into all their pairs: texts with the same words are one
node, and every other member of a bucket is compared with the bucket's centre. Only
where members then still lie in different classes are they compared with each other,
inside tasks over small blocks that return no more links than join classes. So no
link inside a bucket is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import WORD, filled, mapped, slices, stored
from rivulet.llm.subwords import span_hashes

SHINGLE = 5
SIMILARITY = Fraction(4, 5)
REGISTERS = 128
BAND_ROWS = 5
# Members of a bucket that are compared at a time.
BLOCK = 512


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(text number, shingle, count) of all distinct shingles, sorted, and a digest of each text's words.

    Words are split at ASCII white space and compared in lower case. A text of fewer
    words is one shingle; one without words has none, and an empty digest.
    """
    encoded = [t.lower().encode() for t in texts]
    lengths = np.array([len(e) for e in encoded], dtype=np.int64)
    data = np.frombuffer(b" ".join(encoded), dtype=np.uint8)
    white = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate([[True], white, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    words = span_hashes(data, starts, ends)
    begins = np.cumsum(lengths + 1) - lengths - 1
    owner = np.searchsorted(begins, starts, side="right") - 1
    count = np.bincount(owner, minlength=len(texts))
    # Each word begins a shingle but for the last ones of its text.
    first = np.cumsum(count) - count
    place = np.arange(len(words)) - first[owner]
    width = np.minimum(count, size)[owner]
    at = np.flatnonzero(place <= count[owner] - width)
    rolled = np.zeros(len(at), dtype=np.uint64)
    for i in range(size):
        within = i < width[at]
        word = words[np.minimum(at + i, max(len(words) - 1, 0))]
        rolled = np.where(within, _mix(rolled + word + np.uint64(i + 1)), rolled)
    order = np.lexsort((rolled, owner[at]))
    text, key = owner[at][order], rolled[order]
    new = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (key[1:] != key[:-1]))) if len(key) else at
    # The sequence of exact words, one blank between them.
    digests = [hashlib.blake2b(b" ".join(e.split()), digest_size=16).digest() if n else b"" for e, n in zip(encoded, count.tolist())]
    return text[new], key[new], np.diff(np.append(new, len(key))), digests


def _weighted(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(shingles, counts) of each text."""
    owner, keys, counts, _ = shingles(texts)
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [(keys[a:b], counts[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def _terms(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(numerators, denominators), whole numbers, of what each common shingle adds to the similarity."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    x, y = a[1][i].astype(np.int64), b[1][j].astype(np.int64)
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    # Where j comes after i in this order, a_j / a_i is the greater one; before, b_j / b_i.
    later = a[1].sum() - np.cumsum(x) + x
    earlier = b[1].sum() - y.sum() + np.cumsum(y) - y
    return x * y, later * y + earlier * x


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Similarity: sum over common i of 1 / sum over j of max(a_j / a_i, b_j / b_i)."""
    over, under = _terms(a, b)
    return float((over / under).sum())


def similar(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> bool:
    """Whether the similarity is `SIMILARITY` or more; where rounding could decide, by exact fractions."""
    over, under = _terms(a, b)
    rounded = float((over / under).sum())
    if abs(rounded - float(SIMILARITY)) > 1e-9:
        return rounded > SIMILARITY
    # Shingles with one ratio of weights add equal parts of their weights, so few fractions are left.
    divisor = np.gcd(over, under)
    parts, counts = np.unique(np.stack([over // divisor, under // divisor]), axis=1, return_counts=True)
    return sum(int(n) * Fraction(int(x), int(y)) for x, y, n in zip(*parts, counts)) >= SIMILARITY


def signatures(owner: np.ndarray, keys: np.ndarray, weights: np.ndarray, texts: int, registers: int = REGISTERS) -> np.ndarray:
    """The first shingle to arrive in each register, for many texts at once.

    The n-th arrival of a shingle depends on the shingle and n alone. A shingle is
    dropped once its arrivals come later than the slowest register's first one.
    """
    best = np.full(texts * registers, np.inf)
    holder = np.zeros(texts * registers, dtype=np.uint64)
    rates, times, step = weights.astype(float), np.zeros(len(keys)), 0
    while len(keys):
        step += 1
        drawn = _mix(keys + np.uint64((step * 0x9E3779B97F4A7C15) % 2**64))
        uniform = ((drawn >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)
        times = times - np.log(uniform) / rates
        slots = owner * registers + (_mix(drawn ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(best, slots, times)
        won = times == best[slots]
        holder[slots[won]] = keys[won]
        going = times < best.reshape(texts, registers).max(axis=1)[owner]
        owner, keys, rates, times = owner[going], keys[going], rates[going], times[going]
    return holder.reshape(texts, registers)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bands = REGISTERS // BAND_ROWS
    for batch in slices(batches, "text", 1_000_000):
        texts = batch.column("text").to_pylist()
        owner, keys, counts, digests = shingles(texts)
        held = signatures(owner, keys, counts, len(texts))[:, : bands * BAND_ROWS].reshape(len(texts), bands, BAND_ROWS)
        band = np.tile(np.arange(bands, dtype=np.uint64), (len(texts), 1))
        for i in range(BAND_ROWS):
            band = _mix(band * np.uint64(31) + held[:, :, i])
        lists = pa.array([b if d else None for b, d in zip(band.view(np.int64).tolist(), digests)], pa.list_(pa.int64()))
        words = pa.array([d or None for d in digests], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), words, lists], names=["doc_id", "row", "words", "bands"])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text_b", 1_000_000):
        a, left = batch.column("a").to_pylist(), batch.column("text_a").to_pylist()
        new = [i for i in range(len(a)) if i == 0 or a[i] != a[i - 1]]  # rows come by a
        firsts = dict(zip((a[i] for i in new), _weighted([left[i] for i in new])))
        good = [similar(firsts[x], y) for x, y in zip(a, _weighted(batch.column("text_b").to_pylist()))]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(good, pa.bool_())], names=["a", "b", "similar"])


def _joined(table: pa.Table) -> pa.Table:
    """Links that join classes among the members of two blocks of one bucket.

    Every pair across classes is compared, unless links found here have joined them or
    an earlier band has the pair as well.
    """
    node, label, block, band = (table.column(c).to_numpy() for c in ("node", "class", "block", "band"))
    bands = np.array(table.column("bands").to_pylist(), dtype=np.int64)
    sets = _weighted(table.column("text").to_pylist())
    head = {c: c for c in label.tolist()}

    def root(c: int) -> int:
        while head[c] != c:
            head[c] = c = head[head[c]]
        return c

    left, right = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
    links: list[tuple[int, int]] = []
    one = table.column("one")[0].as_py()
    if not one and block.min() == block.max():  # the other block is empty
        left = left[:0]
    for i in left.tolist():
        others = right[right > i] if one else right
        earlier = (bands[others] == bands[i])[:, : int(band[i])].any(axis=1)
        others = others[~earlier & (label[others] != label[i])]
        for j in others.tolist():
            x, y = root(int(label[i])), root(int(label[j]))
            if x != y and similar(sets[i], sets[j]):
                head[x] = y
                links.append((min(node[i], node[j]), max(node[i], node[j])))
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def connected(links: DataFrame) -> DataFrame:
    """(node, class) of all nodes of (a, b) links: the smallest node that can be reached.

    Every node points at the smallest class around it, then at that one's own class;
    each round is stored. Paths shrink by more than half per round.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both.distinct(), "edges")
    label = stored(edges.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("class")), "classes")
    while True:
        seen = edges.join(label.select(F.col("node").alias("b"), F.col("class").alias("near")), "b")
        # A node's old class must follow it, so the class of its class takes part too.
        hooks = seen.join(label.select(F.col("node").alias("a"), F.col("class").alias("own")), "a").select(
            F.col("own").alias("node"), F.col("near").alias("class")
        )
        lowered = label.unionByName(hooks).groupBy("node").agg(F.min("class").alias("class"))
        lowered = stored(lowered, "classes")
        jump = lowered.select(F.col("node").alias("class"), F.col("class").alias("far"))
        new = stored(
            lowered.join(jump, "class").select("node", F.least("class", "far").alias("class")), "classes"
        )
        old = label.select("node", F.col("class").alias("before"))
        if new.join(old, "node").filter(F.col("class") != F.col("before")).isEmpty():
            return new
        label = new


def _checked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b) pairs that are similar; the text of each side is fetched by a join."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    checked = mapped(joined, _similar, "a long, b long, similar boolean")
    return checked.filter("similar").select("a", "b")


def _links(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b) links among nodes (node, first, bands); with transitivity they give the classes.

    A bucket's centre is the member that shares most buckets with others, so copies of
    one text meet that text. What its centres leave apart is compared block by block.
    """
    every = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    crowded = every.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = stored(every.join(crowded, "bucket"), "near-members")
    weight = members.groupBy("node").agg(F.sum("n").alias("weight"))
    centre = F.max(F.struct("weight", F.xxhash64("node").alias("h"), "node")).alias("c")
    centres = members.join(weight, "node").groupBy("bucket").agg(centre).select("bucket", F.col("c.node").alias("centre"))
    stars = members.join(stored(centres, "near-centres"), "bucket").filter(F.col("node") != F.col("centre"))
    stars = stars.select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    # Texts of the nodes that share a bucket, by the row each stands for.
    wanted = members.select("node").distinct().join(nodes.select("node", "first"), "node")
    keyed = docs.withColumn("row", F.xxhash64("text"))
    same_row = F.col("d.doc_id").eqNullSafe(F.col("w.first.doc_id")) & (F.col("d.row") == F.col("w.first.row"))
    texts = keyed.alias("d").join(wanted.alias("w"), same_row).select("w.node", "d.text").dropDuplicates(["node"])
    texts = stored(texts, "near-texts")
    links = stored(_checked(stored(stars, "near-pairs"), texts), "near-links")
    # Buckets of three and more whose members are still apart: what the centres did not settle.
    named = members.filter("n > 2").join(connected(links), "node", "left").withColumn("class", F.coalesce("class", "node"))
    apart = named.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high")
    rest = stored(named.join(apart.select("bucket"), "bucket", "left_semi"), "near-apart")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    meetings = rest.withColumn("block", block).withColumn("other", other)
    meetings = meetings.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    full = meetings.join(nodes.select("node", "bands"), "node").join(texts, "node")
    full = full.withColumn("one", F.col("low") == F.col("high")).select(
        "bucket", "low", "high", "one", "node", "class", "block", "band", "bands", "text"
    )
    more = full.groupBy("bucket", "low", "high").applyInArrow(_joined, "a long, b long")
    return links.unionByName(stored(more.distinct(), "near-links"))


def near_classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, class_id, class_size, kept, row (xxhash64 of the text).

    The class is named after its smallest doc_id; that document (one of its rows, if
    repeated) is kept. NULL ids come last. Texts with the same words are of one class;
    texts without words, NULL or empty, are each alone. Links are transitive. An empty
    table gives an empty result; other columns are not looked at.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), filled(text_column).alias("text"))
    sketched = mapped(
        rows.withColumn("row", F.xxhash64("text")), _sketches, "doc_id long, row long, words binary, bands array<long>"
    )
    sketched = stored(sketched, "near-rows")
    by_row = sketched.groupBy("doc_id", "row", "words").agg(F.count("*").alias("copies"))
    # One node per distinct sequence of words, with a number of its own.
    owner = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    nodes = sketched.filter(F.col("words").isNotNull()).groupBy("words").agg(
        F.min(owner).alias("first"), F.first("bands").alias("bands"), F.count("*").alias("copies")
    )
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    classes = connected(_links(nodes, rows))
    named = nodes.select("node", "words", "first", "copies").join(classes, "node", "left")
    named = stored(named.withColumn("class", F.coalesce("class", "node")), "near-named")
    sizes = named.groupBy("class").agg(F.min("first").alias("owner"), F.sum("copies").alias("class_size"))
    per_text = stored(named.select("words", "class").join(stored(sizes, "near-classes"), "class"), "near-classes")
    each = stored(by_row, "near-rows").alias("r").join(per_text.alias("c"), "words", "left")
    alone = F.col("c.class").isNull()
    kept = alone | (F.col("r.doc_id").eqNullSafe(F.col("c.owner.doc_id")) & (F.col("r.row") == F.col("c.owner.row")))
    each = each.select(
        F.col("r.doc_id").alias("doc_id"),
        F.when(alone, F.col("r.doc_id")).otherwise(F.col("c.owner.doc_id")).alias("class_id"),
        F.when(alone, F.lit(1).cast("long")).otherwise(F.col("c.class_size")).alias("class_size"),
        kept.alias("_kept"),
        alone.alias("_alone"),
        F.col("r.row").alias("row"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("r.copies"))).alias("_copy"),
    )
    return each.select(
        "doc_id", "class_id", "class_size", (F.col("_kept") & (F.col("_alone") | (F.col("_copy") == 1))).alias("kept"), "row"
    )


def keep_one_of_near(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs`, all its columns, with one row of each class of near-duplicates."""
    has_words = filled(text_column).rlike(WORD)
    stays = near_classes(docs, id_column, text_column).filter("kept").select(
        F.col("doc_id").alias("_rv_id"), F.col("row").alias("_rv_row")
    )
    keyed = docs.withColumn("_rv_x", F.xxhash64(filled(text_column)))
    match = F.col(id_column).cast("long").eqNullSafe(F.col("_rv_id")) & (F.col("_rv_x") == F.col("_rv_row"))
    kept = keyed.filter(has_words).join(stays, match, "left_semi").dropDuplicates([id_column, "_rv_x"])
    return kept.unionByName(keyed.filter(~has_words)).select(*docs.columns)
