"""Silver as a folder per batch, where no table format with MERGE is at hand.

    base/TransactionDate=2024-01-30/...                                what a compaction wrote, if any
    batch/_source=<query id>/_batch=7/TransactionDate=2024-01-31/...   latest rows of one batch

An upsert writes only the batch, never the table: readers merge. A batch that runs
again overwrites its own folder. A compaction writes the merged rows as the base of
another root and leaves this one as it is.

These are plain Parquet folders with Spark's own committer. A reader that lists a
batch while it is being written may miss some of its rows, and one that is reading a
batch while it runs again may fail; neither sees anything wrong afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from rivulet.functions.morton import morton, place
from rivulet.operators.latest import latest_per_key
from rivulet.operators.upsert import merge_joined, merge_upsert
from rivulet.schemas import KEY, ORDER, SILVER, SILVER_PARTITION, SILVER_ROW
from rivulet.sources.files import read_table

PROCESSED = "_processed_insert_timestamp"


class SilverLog:
    """`order_guard` decides which row of a key counts: the greatest order tuple
    (default), or, without it, the one processed last. `base_table` is the base as a
    catalog table that `compact_to_table` has written."""

    def __init__(self, spark: SparkSession, root: str, order_guard: bool = True, base_table: str | None = None):
        self.base_table = base_table
        self.spark = spark
        self.root = root.rstrip("/")
        self.order_guard = order_guard
        self.order = [*ORDER, PROCESSED] if order_guard else [PROCESSED, *ORDER]

    def upsert(self, rows: DataFrame, source: str, batch_id: int) -> None:
        """Adds one batch, unique by key, in place of what (source, batch_id) wrote before."""
        # Rebalancing gathers a date's rows into few files, and splits a date
        # that is too large for one task.
        balanced = rows.to(SILVER_ROW).hint("rebalance", SILVER_PARTITION)
        folder = f"{self.root}/batch/_source={source}/_batch={batch_id}"
        balanced.write.mode("overwrite").partitionBy(SILVER_PARTITION).parquet(folder)

    def _read(self, part: str) -> DataFrame:
        return read_table(self.spark, f"{self.root}/{part}", SILVER_ROW).select(*SILVER_ROW.names)

    def _base(self) -> DataFrame:
        return self.spark.table(self.base_table).select(*SILVER_ROW.names) if self.base_table else self._read("base")

    def _merged(self, fixed_dates: bool = False) -> DataFrame:
        base, batches = self._base(), self._read("batch")
        if self.base_table:
            return merge_joined(base, batches, KEY, self.order)
        if fixed_dates:
            return latest_per_key(base.unionByName(batches), [SILVER_PARTITION, KEY], self.order)
        return merge_upsert(base, batches, KEY, self.order)

    def snapshot(self, fixed_dates: bool = False) -> DataFrame:
        """The table now: one row per transaction id.

        Without batches since the compaction this is a plain scan: Spark drops the
        joins with a part that is not there. With `fixed_dates`, the caller's word
        that no transaction ever changes its date, the date is part of the key and a
        filter on it prunes partitions.
        """
        return self._merged(fixed_dates).select(*SILVER.names)

    def _amount_ends(self) -> DataFrame:
        """Least and greatest amount of all that is stored, so of the merged rows too.

        A scan of one column. Rows that the merge leaves out can only widen the range.
        """
        stored = self._base().unionByName(self._read("batch"))
        return stored.agg(F.min("Amount").alias("low"), F.max("Amount").alias("high"))

    def compact(self, root: str) -> SilverLog:
        """Writes the table, clustered by amount and time within the date, as the base of a new root.

        Returns silver at that root. Stop the job that upserts, compact, and let it go
        on at the new root: what it writes to the old one in between is not taken over.
        Amount and time of day are interleaved bit by bit, so files and row groups cover a
        small range of both, and a filter on either skips most of a date. The range split
        ends with the key, which is unique, so neither a hot date nor a common amount can
        fill one task.
        """
        compacted = SilverLog(self.spark, root, self.order_guard)
        merged = self._merged()
        ends = self._amount_ends().first()
        time = F.col("TransactionDateTime").cast("timestamp")
        since = F.unix_micros(time) - F.unix_micros(F.date_trunc("day", time))
        near = morton(place(F.col("Amount"), F.lit(ends.low), F.lit(ends.high)), place(since, F.lit(0), F.lit(86_400_000_000)))
        clustered = (
            merged.withColumn("_near", near)
            .repartitionByRange(SILVER_PARTITION, "_near", KEY)
            .sortWithinPartitions(SILVER_PARTITION, "_near")
            .drop("_near")
        )
        clustered.write.partitionBy(SILVER_PARTITION).parquet(f"{compacted.root}/base")
        return compacted

    def compact_to_table(self, root: str, table: str, buckets: int) -> SilverLog:
        """The same with the base as a catalog table in `buckets` buckets by transaction id.

        Merging then never shuffles the base, however many keys the batches have: they
        are shuffled into its buckets. In return it is not clustered by amount, and its
        files are not split by date. Take as many buckets as keep each in a task's memory.
        """
        writer = self._merged().repartition(buckets, KEY).write.format("parquet").bucketBy(buckets, KEY).sortBy(KEY)
        writer.option("path", f"{root.rstrip('/')}/base").saveAsTable(table)
        return SilverLog(self.spark, root, self.order_guard, table)
