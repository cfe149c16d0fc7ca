"""Silver in a catalog table whose format has MERGE (Delta, Iceberg, ...).

Needs the format's package and catalog on the session. Same interface as
`SilverLog`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.schemas import KEY, ORDER, SILVER, SILVER_PARTITION, SILVER_ROW


class CatalogTable:
    """`fixed_dates` is the caller's word that no transaction ever changes its date.
    The date is then part of the match, and a merge reads only the dates of its batch;
    without it every merge scans the keys of the whole table."""

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        provider: str = "delta",
        order_guard: bool = True,
        fixed_dates: bool = False,
    ):
        self.spark = spark
        self.name = name
        self.provider = provider
        self.order_guard = order_guard
        self.fixed_dates = fixed_dates

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def _newer(self) -> Column:
        target = self.name.split(".")[-1]
        source_tuple = F.struct(*[F.col(f"source.{c}") for c in ORDER])
        target_tuple = F.struct(*[F.col(f"{target}.{c}") for c in ORDER])
        return source_tuple > target_tuple

    def _match(self, rows: DataFrame) -> Column:
        target = self.name.split(".")[-1]
        match = F.col(f"source.{KEY}") == F.col(f"{target}.{KEY}")
        if not self.fixed_dates:
            return match
        day = F.col(f"{target}.{SILVER_PARTITION}")
        # Literals, so that the format can leave out partitions before it reads any.
        span = rows.agg(F.min(SILVER_PARTITION).alias("low"), F.max(SILVER_PARTITION).alias("high")).first()
        within = day.isNull() | day.between(F.lit(span.low), F.lit(span.high))
        return match & day.eqNullSafe(F.col(f"source.{SILVER_PARTITION}")) & within

    def upsert(self, rows: DataFrame, source: str, batch_id: int) -> None:
        """Merges one batch, unique by key. The merge is keyed, so repeating it is harmless."""
        rows = rows.to(SILVER_ROW)
        if not self.exists():
            rows.writeTo(self.name).using(self.provider).partitionedBy(F.col(SILVER_PARTITION)).create()
            return
        merge = rows.alias("source").mergeInto(self.name, self._match(rows))
        matched = merge.whenMatched(self._newer()) if self.order_guard else merge.whenMatched()
        matched.updateAll().whenNotMatched().insertAll().merge()

    def snapshot(self) -> DataFrame:
        return self.spark.table(self.name).select(*SILVER.names)

    def compact(self) -> None:
        """Delta's own clustering command; other formats have their own."""
        if self.provider != "delta":
            raise ValueError(f"{self.provider} tables are compacted with the format's own procedures")
        self.spark.sql(f"OPTIMIZE {self.name} ZORDER BY (Amount)")
