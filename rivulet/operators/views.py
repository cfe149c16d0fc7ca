"""Inspection views."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivulet.schemas import BRONZE_PARTITIONS
from rivulet.sources.files import read_bronze, read_bronze_since, read_merged_bronze

EARLIEST = date(1970, 1, 1)


def latest_rows(df: DataFrame, newest_by: str, tie_break: Sequence[str], n: int = 20) -> DataFrame:
    """The `n` newest rows, ties broken so that the answer is repeatable.

    Sort plus limit plans as a per-task top-n and one small merge.
    """
    return df.orderBy(F.col(newest_by).desc(), *[F.col(c).desc() for c in tie_break]).limit(n)


def latest_bronze(bronze: DataFrame, n: int = 20) -> DataFrame:
    ties = [F.col("partition").try_cast("int").desc(), F.col("offset").try_cast("bigint").desc()]
    return bronze.orderBy(F.col("_raw_insert_timestamp").desc(), *ties).limit(n)


def newest_bronze(spark: SparkSession, bronze: str, n: int = 20, today: date | None = None, merge: bool = False) -> DataFrame:
    """`latest_bronze` of a bronze folder, from the newest of its date and hour folders.

    A row's folder follows from its ingest time, so once the newest folders hold `n` rows
    together no other folder can have one of the newest. Dates are looked at backwards
    from `today`, twice as many each time; older ones are not even listed, and rows are
    counted by the files' footers. `merge` is that of `read_bronze_since`.
    """
    first, step = today or datetime.now(timezone.utc).date(), 1
    while True:
        rows = read_bronze_since(spark, bronze, first) if first > EARLIEST else read_bronze(spark, bronze)
        newest_first = [F.col(c).desc() for c in BRONZE_PARTITIONS]
        # No folder is without rows, so the newest `n` folders are enough.
        folders = rows.groupBy(*BRONZE_PARTITIONS).agg(F.count(F.lit(1)).alias("n")).orderBy(*newest_first).limit(n)
        so_far = F.sum("n").over(Window.orderBy(*newest_first))
        needed = folders.withColumn("so_far", so_far).filter(F.col("so_far") - F.col("n") < n).collect()
        if first <= EARLIEST or sum(r.n for r in needed) >= n:
            break
        first = EARLIEST if step > 20_000 else max(EARLIEST, first - timedelta(days=step))
        step *= 2
    if not needed:
        return latest_bronze(read_merged_bronze(spark, bronze) if merge else rows, n)
    day, hour = needed[-1]["_raw_insert_date"], needed[-1]["_raw_insert_hour"]
    late_enough = (F.col("_raw_insert_date") > day) | ((F.col("_raw_insert_date") == day) & (F.col("_raw_insert_hour") >= hour))
    return latest_bronze(read_bronze_since(spark, bronze, day, merge).filter(late_enough), n)


def latest_silver(silver: DataFrame, n: int = 20) -> DataFrame:
    return latest_rows(silver, "_processed_insert_timestamp", ["TransactionId"], n)
