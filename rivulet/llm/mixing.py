"""Mixing sources to target weights by weighted random order.

Every document draws an exponential key divided by its quality weight; within its
source, documents in the order of their keys are a weighted sample without
replacement of any length (Efraimidis and Spirakis). Whole epochs are taken first;
the rest of a source's target is filled by the documents with the smallest keys.

No source is sorted as a whole: keys are counted in fine buckets, the buckets are
summed up, and only the bucket in which the budget ends is looked at document by
document. What remains is one threshold per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import WORD, filled, same, stored

SHARE = 1.5
MOST_EPOCHS = 2
WEIGHTS = (5.0, 2.0, 1.0)
BUCKETS = 4096
SEED = 17


def words(text: Column | str) -> Column:
    return F.regexp_count(filled(text), F.lit(WORD)).cast("long")


def quality(text: Column | str, size: Column) -> Column:
    """Between 0.25 and 1: high for texts with words of ordinary length."""
    mean = F.length(filled(text)) / F.greatest(size, F.lit(1))
    return F.greatest(F.lit(0.25), F.lit(1.0) - F.abs(mean - 6.0) / 12.0)


def sampling_key(id_column: str, source: str, text: str, weight: Column) -> Column:
    """The exponential key; the same for a row on every run."""
    hashed = F.xxhash64(F.lit(SEED), F.col(id_column), F.col(source), F.col(text))
    uniform = (F.shiftrightunsigned(hashed, 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(uniform) / weight


def bucket(key: Column) -> Column:
    """Rank of the fine bucket of a key; keys grow with it."""
    return F.floor((F.lit(1.0) - F.exp(-key / 2)) * BUCKETS).cast("int")


def source_targets(sizes: DataFrame, share: float = SHARE) -> DataFrame:
    """(source, source_size) to (.., target): `share` of all words by weight, none above
    `MOST_EPOCHS` times its size.

    Resharing what is cut off until none is above raises one water level: a source
    gets its limit or its weight times the level. Sources in the order of their
    limit per weight; the first that the level does not reach fixes it. There is one
    row per source here.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(rank - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    limit = F.col("source_size") * float(MOST_EPOCHS)
    ranked = sizes.withColumn("_rank", rank).withColumn("weight", weight).withColumn("_limit", limit)
    ranked = ranked.withColumn("_reach", F.col("_limit") / F.col("weight"))
    before = Window.orderBy("_reach", "_rank").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("_reach", "_rank").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_rows = Window.orderBy("_reach", "_rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(all_rows) * share - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))
    levels = ranked.withColumn("_level", left / F.sum("weight").over(after))
    fixed = F.min(F.when(F.col("_level") <= F.col("_reach"), F.struct("_reach", "_rank", "_level"))).over(all_rows)
    level = F.coalesce(fixed["_level"], F.lit(float("inf")))
    target = F.least(F.col("_limit"), F.col("weight") * level)
    return levels.withColumn("target", target).select("source", "source_size", "weight", "target")


def mixing_plan(sized: DataFrame, share: float = SHARE) -> DataFrame:
    """From (source, size, key): one row per source with target, epochs and threshold.

    A document is taken `epochs` times, and once more if its key is at most the
    threshold. The document at which the budget ends is taken if more than half of
    it fits, so a source misses its target by half a document at most (equal keys,
    as of repeated rows, go together).
    """
    per_bucket = stored(
        sized.groupBy("source", bucket(F.col("key")).alias("bucket")).agg(F.sum("size").alias("words")), "mix-buckets"
    )
    targets = source_targets(per_bucket.groupBy("source").agg(F.sum("words").alias("source_size")), share)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("epochs", epochs.cast("int"))
    targets = targets.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    targets = stored(targets, "mix-targets")
    t, p = targets.alias("t"), per_bucket.alias("p")
    so_far = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    ends = (
        p.withColumn("upto", so_far)
        .alias("p")
        .join(t, same(F.col("p.source"), F.col("t.source")))
        .filter(F.col("p.upto") >= F.col("t.rest"))
        .groupBy(F.col("t.source").alias("source"))
        .agg(F.min(F.struct("p.bucket", (F.col("p.upto") - F.col("p.words")).alias("before"), "t.rest")).alias("end"))
    )
    inside = (
        sized.alias("s")
        .join(ends.alias("e"), same(F.col("s.source"), F.col("e.source")) & (bucket(F.col("s.key")) == F.col("e.end.bucket")))
        .groupBy(F.col("s.source").alias("source"), F.col("s.key").alias("key"), F.col("e.end").alias("end"))
        .agg(F.sum("s.size").alias("words"))
    )
    upto = F.col("end.before") + F.sum("words").over(Window.partitionBy("source").orderBy("key"))
    fits = inside.withColumn("upto", upto).filter(F.col("upto") - F.col("words") / 2 <= F.col("end.rest"))
    last = fits.groupBy("source").agg(F.max("key").alias("last"))
    # Keys of the buckets before the last one; a key may stand on a bucket's edge, so the bucket itself decides.
    return (
        t.join(ends.alias("e"), same(F.col("t.source"), F.col("e.source")), "left")
        .join(last.alias("l"), same(F.col("t.source"), F.col("l.source")), "left")
        .select("t.*", F.col("e.end.bucket").alias("end_bucket"), F.col("l.last").alias("last_key"))
    )


def times_taken(key: Column) -> Column:
    """How often a document is taken, next to the columns of its source's plan."""
    inside = bucket(key)
    more = (inside < F.col("end_bucket")) | ((inside == F.col("end_bucket")) & (key <= F.col("last_key")))
    return F.col("epochs") + F.coalesce(more & (F.col("rest") > 0), F.lit(False)).cast("int")


def _keyed(docs: DataFrame, id_column: str, source: str, text: str) -> dict[str, Column]:
    size = words(text)
    return {"size": size, "key": sampling_key(id_column, source, text, quality(text, size))}


def mix(docs: DataFrame, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, source, size, source_size, target, times, taken.

    Size counts words; NULL text has size 0. The NULL source is a source, the last.
    A source of size 0 has target 0. Repeated rows share a key and are taken alike.
    An empty table gives an empty result; other columns are not looked at.
    """
    columns = _keyed(docs, id_column, source_column, text_column)
    sized = docs.select(
        F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), *[c.alias(n) for n, c in columns.items()]
    )
    sized = stored(sized, "mix-sizes")
    plan = stored(mixing_plan(sized), "mix-plan").alias("p")
    joined = sized.alias("s").join(plan, same(F.col("s.source"), F.col("p.source")))
    times = times_taken(F.col("s.key"))
    return joined.select(
        "s.doc_id", "s.source", "s.size", "p.source_size", "p.target", times.alias("times"), (times * F.col("s.size")).alias("taken")
    )


def mixed_documents(docs: DataFrame, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text") -> DataFrame:
    """`docs`, all its columns, each row as often as the mix takes it."""
    columns = _keyed(docs, id_column, source_column, text_column)
    sized = stored(docs.select(F.col(source_column).alias("source"), *[c.alias(n) for n, c in columns.items()]), "mix-sizes")
    plan = stored(mixing_plan(sized), "mix-plan")
    plan = plan.select(F.struct("epochs", "rest", "end_bucket", "last_key").alias("_rv_plan"), F.col("source").alias("_rv_source"))
    keyed = docs.withColumn("_rv_key", columns["key"])
    joined = keyed.join(plan, same(F.col(source_column), F.col("_rv_source")))
    inside = bucket(F.col("_rv_key"))
    end, last = F.col("_rv_plan.end_bucket"), F.col("_rv_plan.last_key")
    more = (F.col("_rv_plan.rest") > 0) & ((inside < end) | ((inside == end) & (F.col("_rv_key") <= last)))
    times = F.col("_rv_plan.epochs") + F.coalesce(more, F.lit(False)).cast("int")
    repeated = joined.withColumn("_rv_copy", F.explode(F.sequence(F.lit(1), F.lit(MOST_EPOCHS))))
    return repeated.filter(F.col("_rv_copy") <= times).select(*docs.columns)
