"""How far the sources of a language stray from each other and from the whole.

A term of a language has a number; of each group (language, source) and each count there
is a bitmap of the terms that occur so often in the group. For two groups, AND of two
bitmaps and a count of its bits says how many terms have this count here and that
count there; times the divergence of the two counts, summed over all pairs of counts,
this is the divergence of the groups. Pairs with a zero are never stored: how many terms
have a count here and none there is what is left of the bitmap, and terms that neither
has are the rest of the vocabulary.

Numbers go by falling frequency, so terms of one 64-bit word of a bitmap have like
counts, and rare terms, which are nearly all, fall into few bitmaps. Words are dealt
out in small blocks over all tasks; a block holds a bounded number of terms, and the
sources of a language are cut into sets that meet pair by pair.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import filled, mapped, slices, stored

# Fixed value: the runs of letters and of bytes beyond ASCII, after lowering A-Z.
TERM = re.compile(rb"[a-z\x80-\xff]+")
LEAST_DOCUMENTS = 10
SCALE = 1_000_000_000
TOP = 10
# 64-bit words of a bitmap in a block, sources that meet in a task, cells of a table held at once.
BLOCK_WORDS = 16
SOURCE_SET = 256
MEETING_CELLS = 2_000_000
# Distinct (group, term) entries that a task holds before it passes them on.
HELD_TERMS = 200_000
SALTS = 32


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) partial counts, and a row without a term for each group."""
    held: dict[tuple[str, str], dict[bytes, list[int]]] = {}
    size = 0

    def emit() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in held.items():
            rows = len(terms) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * rows, pa.string()),
                    pa.array([source] * rows, pa.string()),
                    pa.array([None, *terms], pa.binary()).cast(pa.string()),
                    pa.array([0, *(x for x, _ in terms.values())], pa.int64()),
                    pa.array([0, *(y for _, y in terms.values())], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )

    for batch in slices(batches, "text"):
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, text in zip(langs, sources, batch.column("text").cast(pa.binary())):
            terms = held.setdefault((lang, source), {})
            before = len(terms)
            low = text.as_buffer().to_pybytes().lower()
            found = TERM.findall(low) if len(low) < 1_000_000 else (m.group() for m in TERM.finditer(low))
            for term, n in Counter(found).items():
                cell = terms.get(term)
                if cell is None:
                    terms[term] = [n, 1]
                else:
                    cell[0] += n
                    cell[1] += 1
            size += len(terms) - before
            if size > HELD_TERMS:
                yield from emit()
                held, size = {}, 0
    yield from emit()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; term NULL: the group occurs."""
    rows = docs.select(*(filled(c).alias(c) for c in ("lang", "source", "text")))
    partial = mapped(rows, _count_terms, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), in whole numbers that cannot overflow."""
    over = f"cast({SCALE} as decimal(10,0)) * cast({count} + 2 as decimal(20,0))"
    return F.expr(f"1 + ({over}) div cast({total} + 2 * {terms} as decimal(20,0))")


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); p and q lie below 2^31.5, so the square fits."""
    apart = p - q
    return apart * apart // (p + q)


def _sums(values: np.ndarray, groups: np.ndarray, count: int) -> np.ndarray:
    """Sums of rows by their sorted group number."""
    out = np.zeros((count, values.shape[1]), dtype=np.int64)
    if len(groups):
        first = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
        out[groups[first]] = np.add.reduceat(values, first, axis=0)
    return out


def _against_none(entries: dict[str, np.ndarray], own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """What terms of each own group add if the other group had none of them, by (own, other)."""
    out = np.zeros((len(own), len(other)), dtype=np.int64)
    step = max(1, MEETING_CELLS // max(1, len(other)))
    for at in range(0, len(entries["p"]), step):
        group, p, size = (entries[c][at : at + step] for c in ("group", "p", "size"))
        more = divergence(p[:, None], other[None, :]) - divergence(own[group][:, None], other[None, :])
        out += _sums(size[:, None] * more, group, len(own))
    return out


def _joint(left: dict[str, np.ndarray], right: dict[str, np.ndarray], zl: np.ndarray, zr: np.ndarray) -> np.ndarray:
    """Correction for terms that both groups have: AND of bitmaps, bits counted, by (left, right)."""
    out = np.zeros(len(zl) * len(zr), dtype=np.int64)
    for word in np.intersect1d(left["word"], right["word"]):
        mine, theirs = np.flatnonzero(left["word"] == word), np.flatnonzero(right["word"] == word)
        step = max(1, MEETING_CELLS // len(theirs))
        for at in range(0, len(mine), step):
            some = mine[at : at + step]
            both = np.bitwise_count(left["bits"][some][:, None] & right["bits"][theirs][None, :])
            x, y = np.nonzero(both)
            count, x, y = both[x, y].astype(np.int64), some[x], theirs[y]
            p, q, gl, gr = left["p"][x], right["p"][y], left["group"][x], right["group"][y]
            more = divergence(p, q) - divergence(p, zr[gr]) - divergence(zl[gl], q) + divergence(zl[gl], zr[gr])
            np.add.at(out, gl * len(zr) + gr, count * more)
    return out.reshape(len(zl), len(zr))


def _meeting(table: pa.Table) -> pa.Table:
    """(lang, a, b, value) of all pairs of groups of two sets, for the terms of one block."""
    low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    lang, block = table.column("lang")[0].as_py(), table.column("block")[0].as_py()

    def side(number: int):
        own = table.filter(pa.compute.equal(table.column("set"), number))
        none = own.filter(pa.compute.is_null(own.column("word"))).sort_by("source")
        names = none.column("source").to_pylist()
        zero = none.column("zero").to_numpy()
        some = own.filter(pa.compute.is_valid(own.column("word"))).sort_by("source")
        index = pa.compute.index_in(some.column("source"), value_set=none.column("source").combine_chunks())
        bits = some.column("bits").to_numpy().astype(np.int64).view(np.uint64)
        entries = {"group": index.to_numpy().astype(np.int64), "word": some.column("word").to_numpy(), "bits": bits}
        entries |= {"p": some.column("p").to_numpy(), "size": np.bitwise_count(bits).astype(np.int64)}
        return names, zero, entries, none.column("terms").to_numpy()

    left_names, zl, left, terms = side(low)
    right_names, zr, right, _ = side(high) if high != low else (left_names, zl, left, terms)
    if block < 0:  # terms that no group has
        value = terms[0] * divergence(zl[:, None], zr[None, :])
    else:
        value = _against_none(left, zl, zr) + _against_none(right, zr, zl).T + _joint(left, right, zl, zr)
    x, y = np.triu_indices(len(zl), 1) if low == high else map(np.ravel, np.indices(value.shape))
    names = pa.array(left_names, pa.string()), pa.array(right_names, pa.string())
    return pa.table(
        {
            "lang": pa.array([lang] * len(x), pa.string()),
            "a": names[0].take(pa.array(x)),
            "b": names[1].take(pa.array(y)),
            "value": pa.array(value[x, y], pa.int64()),
        }
    )


def _pairs(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs of groups of a language."""
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("id").bitwiseAND(63).cast("int")))
    bitmaps = cells.groupBy("lang", "source", "set", "sets", "p", F.shiftright("id", 6).alias("word")).agg(bits.alias("bits"))
    bitmaps = stored(bitmaps.withColumn("block", F.floor(F.col("word") / BLOCK_WORDS)), "count-bitmaps")
    # Each block hears of all groups, those without a term in it too; dealt by salt, as one language may have nearly all blocks.
    blocks = bitmaps.select("lang", "block").distinct().unionByName(groups.select("lang", F.lit(-1).cast("long").alias("block")).distinct())
    blocks = blocks.withColumn("salt", F.pmod("block", F.lit(SALTS)))
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    none = blocks.join(salted, ["lang", "salt"]).select("lang", "block", "source", "set", "sets", "zero", "terms")
    rows = bitmaps.unionByName(none, allowMissingColumns=True)
    other = F.explode(F.sequence(F.lit(0), F.col("sets") - 1))
    meetings = rows.withColumn("other", other).withColumns({"low": F.least("set", "other"), "high": F.greatest("set", "other")})
    met = meetings.groupBy("lang", "block", "low", "high").applyInArrow(_meeting, "lang string, a string, b string, value long")
    once = stored(met.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "divergences")
    there = once.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value")
    return there.unionByName(once.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))


def audit_sources(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source strays, from which and by what.

    Part `pair` ranks all other sources of the language by the divergence summed over its
    kept terms (in `least_documents` documents); part `term` gives the `top` kept terms
    that the source has more of than the language. NULL text, lang and source are empty
    strings. A source without terms, and a language without kept ones, has its pairs all
    the same. Repeated rows count each; an empty table gives an empty result; other
    columns are not looked at. Ties go to the smaller item in UTF-8.
    """
    counts = stored(term_counts(docs), "term-counts")
    real = counts.filter(F.col("term").isNotNull())
    kept = real.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = kept.filter(F.col("docs") >= least_documents).drop("docs")
    ordered = kept.repartitionByRange("lang", F.desc("lang_n"), "term").sortWithinPartitions("lang", F.desc("lang_n"), "term")
    terms = stored(ordered.withColumn("id", F.monotonically_increasing_id()), "terms")
    own = stored(real.join(terms, ["lang", "term"]).select("lang", "source", "term", "id", "n", "lang_n"), "term-cells")
    occurring = counts.groupBy("lang", "source").count().drop("count")
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    sizes = occurring.groupBy("lang").agg(F.ceil(F.count("*") / SOURCE_SET).cast("int").alias("sets"))
    groups = occurring.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").join(sizes, "lang")
    groups = groups.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("total", "terms", "lang_total")})
    groups = groups.withColumns(
        {
            "none": F.lit(0).cast("long"),
            "set": F.pmod(F.xxhash64("source"), "sets").cast("int"),
        }
    ).withColumn("zero", F.when(F.col("terms") > 0, share("none", "total", "terms")).otherwise(1))
    groups = stored(groups.drop("none"), "groups")
    cells = own.join(groups, ["lang", "source"]).withColumn("p", share("n", "total", "terms"))
    cells = cells.withColumn("q", share("lang_n", "lang_total", "terms"))
    pairs = _pairs(cells, groups)
    p, q = F.col("p"), F.col("q")
    value = F.expr("((p - q) * (p - q)) div (p + q)")
    more = cells.filter(p > q).select("lang", "source", F.col("term").alias("item"), value.alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    first = pairs.withColumns({"part": F.lit("pair"), "rank": F.row_number().over(order)})
    second = more.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).withColumn("part", F.lit("term"))
    return first.select(*columns).unionByName(second.select(*columns))
