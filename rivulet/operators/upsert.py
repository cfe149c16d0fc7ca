"""Upsert as a relational operator: match by key, update all, insert all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators.latest import latest_per_key


def merge_upsert(target: DataFrame, source: DataFrame, key: str, order: Sequence[str] | None = None) -> DataFrame:
    """The target, unique on `key`, after merging `source` into it.

    A NULL key matches nothing, so such rows of either side are all kept. They go
    straight to the result: no join and no shuffle gathers them in one task.

    Without `order` the source, which must be unique too, replaces the target
    rows it matches. With `order` the greatest tuple wins, among the source's own
    rows as well. Only the source and the target rows it matches take part in
    that contest: when the source's keys are small enough for Spark to broadcast,
    the target is never shuffled. The source is read once for its keys and once
    for its rows; persist it if it is dear to compute.
    """
    # Distinct keys: a repeated one is folded before the shuffle, and the joins
    # below use the partitioning this leaves behind.
    has_key = F.col(key).isNotNull()
    keys = source.filter(has_key).select(key).distinct()
    known = target.filter(has_key)
    untouched = known.join(keys, key, "left_anti").select(*target.columns).unionByName(target.filter(~has_key))
    if order is None:
        return untouched.unionByName(source)
    matched = known.join(keys, key, "left_semi").select(*target.columns)
    contest = latest_per_key(matched.unionByName(source.filter(has_key)), key, order)
    return untouched.unionByName(contest).unionByName(source.filter(~has_key))


def merge_joined(target: DataFrame, source: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """What `merge_upsert` gives with `order`, by one full outer join.

    For a target that is bucketed by the key and a source whose keys are too many to be
    broadcast: the target is not shuffled, and the source once. The target must be unique
    on `key`. A NULL key matches nothing, so such rows of either side stay; those of the
    source have no latest one and are all kept.
    """
    has_key = F.col(key).isNotNull()
    newest = latest_per_key(source.filter(has_key), key, order)
    columns = target.columns
    old, new = F.struct(*[F.col(f"old.{c}") for c in order]), F.struct(*[F.col(f"new.{c}") for c in order])
    # NULLs come first in the order of structs, so they lose here as everywhere.
    wins = F.col("old._there").isNull() | (F.col("new._there").isNotNull() & (new >= old))
    there = F.lit(True).alias("_there")
    joined = target.select(*columns, there).alias("old").join(
        newest.select(*columns, there).alias("new"), F.col(f"old.{key}") == F.col(f"new.{key}"), "full"
    )
    merged = joined.select(*[F.when(wins, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in columns])
    return merged.unionByName(source.filter(~has_key).select(*columns))
