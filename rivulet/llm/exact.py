"""Exact dedup by block naming.

A text without its white space is cut into blocks of fixed size. Equal blocks get
the same integer name by sorting all blocks; then equal pairs of adjacent names get
one name by sorting all pairs, and so on until every document has one name. Two
names of a level are equal only if all bytes below them are, so no hash decides.

Naming ships each block once: rows are dealt out by block, sorted, and a block is
called after the place of its first row. Blocks that fill more than a small share of
all rows would crowd one task; these few (at most `HOT_SHARE`) are named from a small
table that is broadcast instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import WHITE, filled, same, stored

BLOCK_BYTES = 2048
# A key with more than one row in so many is hot, so there are fewer hot keys than this.
HOT_SHARE = 500
_NO_RIGHT = -(1 << 62)


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """`rows` with a `name` that is equal exactly where `keys` are; without the keys."""
    rest = [c for c in rows.columns if c not in keys]
    hashed = rows.withColumn("_hash", F.xxhash64(*keys))
    counts = hashed.groupBy("_hash").count()
    total = rows.count()
    hot = [r["_hash"] for r in counts.filter(F.col("count") > max(100, total / HOT_SHARE)).select("_hash").collect()]
    cold = hashed.filter(~F.col("_hash").isin(hot)) if hot else hashed
    first = F.min("_row").over(Window.partitionBy(*keys))
    named = (
        cold.repartition(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("name", first)
        .select(*rest, "name")
    )
    if not hot:
        return named
    crowded = hashed.filter(F.col("_hash").isin(hot))
    order = Window.orderBy(*keys)  # over fewer rows than HOT_SHARE, but for hashes that collide
    few = crowded.select(*keys).distinct().withColumn("name", -F.row_number().over(order).cast("long"))
    return named.unionByName(crowded.join(F.broadcast(few), keys).select(*rest, "name"))


def name_documents(docs: DataFrame, id_column: str, text_column: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, text_sha256, level, name): one row per distinct (id, normalised text).

    (level, name) is equal exactly where normalised texts are. NULL text is empty;
    an empty text is one empty block.
    """
    plain = docs.select(
        F.col(id_column).alias("doc_id"), F.regexp_replace(filled(text_column), WHITE, "").cast("binary").alias("_bytes")
    )
    count = F.greatest(F.ceil(F.octet_length("_bytes") / block_bytes), F.lit(1)).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.substring(F.col("_bytes"), i * block_bytes + 1, F.lit(block_bytes))
    )
    blocks = plain.select(
        "doc_id", F.sha2("_bytes", 256).alias("text_sha256"), count.alias("left"), F.posexplode(cut).alias("at", "block")
    )
    names = stored(_named(blocks, ["block"]), "block-names")
    level, finished = 0, []
    while True:
        finished.append(names.filter(F.col("left") == 1).withColumn("level", F.lit(level)))
        open_names = names.filter(F.col("left") > 1)
        if open_names.isEmpty():
            break
        even = F.pmod(F.col("at"), F.lit(2)) == 0
        pairs = open_names.groupBy(
            "doc_id", "text_sha256", F.ceil(F.col("left") / 2).cast("int").alias("left"), F.floor(F.col("at") / 2).cast("int").alias("at")
        ).agg(
            F.max(F.when(even, F.col("name"))).alias("first"),
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(_NO_RIGHT)).alias("second"),
        )
        names = stored(_named(stored(pairs, "pairs"), ["first", "second"]), "pair-names")
        level += 1
    every = reduce(DataFrame.unionByName, finished)
    return every.groupBy("doc_id", "text_sha256").agg(F.first("level").alias("level"), F.first("name").alias("name"))


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256, n_chars.

    Texts are equal when they are after deleting ASCII white space. The row with the
    most code points stays, then the smallest id (NULL ids last), then one of repeated
    rows. NULL text is the empty text; all empty texts are one group. An empty table
    gives an empty result; other columns are not looked at.
    """
    rows = stored(
        docs.select(
            F.col(id_column).alias("doc_id"),
            F.length(filled(text_column)).alias("n_chars"),
            F.sha2(F.regexp_replace(filled(text_column), WHITE, "").cast("binary"), 256).alias("text_sha256"),
        )
        .groupBy("doc_id", "n_chars", "text_sha256")
        .agg(F.count("*").alias("_copies")),
        "dedup-rows",
    )
    names = name_documents(docs, id_column, text_column).alias("n")
    joined = rows.alias("r").join(
        names, same(F.col("r.doc_id"), F.col("n.doc_id")) & (F.col("r.text_sha256") == F.col("n.text_sha256"))
    )
    joined = stored(joined.select("r.*", "n.level", "n.name"), "dedup-named")
    order = F.struct((-F.col("n_chars")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("c"))
    groups = stored(
        joined.groupBy("level", "name").agg(F.min(order).alias("_best"), F.sum("_copies").alias("group_size")), "dedup-groups"
    )
    best = (F.col("n_chars") == -F.col("_best.a")) & same(F.col("doc_id"), F.col("_best.c"))
    copies = F.sequence(F.lit(1).cast("long"), F.col("_copies"))
    return joined.join(groups, ["level", "name"]).select(
        "doc_id",
        F.col("_best.c").alias("keep_id"),
        "group_size",
        "text_sha256",
        "n_chars",
        best.alias("_kept"),
        F.explode(copies).alias("_copy"),
    ).select("doc_id", "keep_id", "group_size", (F.col("_kept") & (F.col("_copy") == 1)).alias("kept"), "text_sha256", "n_chars")


def keep_one_of_equals(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs`, all its columns, with one row of each group of equal texts."""
    stays = exact_groups(docs, id_column, text_column).filter("kept").select(
        F.col("doc_id").alias("_rv_id"), F.col("n_chars").alias("_rv_chars"), F.col("text_sha256").alias("_rv_sha")
    )
    keyed = docs.withColumns(
        {
            "_rv_l": F.length(filled(text_column)),
            "_rv_s": F.sha2(F.regexp_replace(filled(text_column), WHITE, "").cast("binary"), 256),
        }
    )
    match = (
        same(F.col(id_column), F.col("_rv_id"))
        & (F.col("_rv_l") == F.col("_rv_chars"))
        & (F.col("_rv_s") == F.col("_rv_sha"))
    )
    kept = keyed.join(stays, match, "left_semi")
    return kept.dropDuplicates([id_column, "_rv_l", "_rv_s"]).select(*docs.columns)
