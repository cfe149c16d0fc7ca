"""Synthetic transaction documents, one per seed row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the input format.
LOCATIONS = ["New York", "London", "Tokyo", "Sydney", "Paris"]
RESULTS = ["Success", "Failure"]
MAX_ID = 100
MAX_AMOUNT_CENTS = 100_000
DECLARATION = '<?xml version="1.0" ?>'


def generate_documents(seeds: DataFrame, seed: str = "id", salt: int = 0, at: Column | None = None) -> DataFrame:
    """Adds `xml`: a document of three to five transactions drawn from the seed.

    Values are hashes of (seed, position, field, salt), not random numbers, so
    a task that is run again writes the same documents.
    """
    at = F.current_timestamp() if at is None else at
    locations, results = (F.array(*map(F.lit, names)) for names in (LOCATIONS, RESULTS))

    def draw(field: str, position: Column, n: int) -> Column:
        return F.pmod(F.xxhash64(F.col(seed), position, F.lit(field), F.lit(salt)), F.lit(n)).cast("int")

    def transaction(i: Column) -> Column:
        return F.struct(
            (draw("TransactionId", i, MAX_ID) + 1).alias("TransactionId"),
            (draw("Amount", i, MAX_AMOUNT_CENTS + 1) / F.lit(100)).cast("decimal(6,2)").alias("Amount"),
            (draw("CustomerId", i, MAX_ID) + 1).alias("CustomerId"),
            F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("DateTime"),
            F.get(locations, draw("Location", i, len(LOCATIONS))).alias("Location"),
            F.get(results, draw("Result", i, len(RESULTS))).alias("Result"),
        )

    count = draw("count", F.lit(0), 3) + 3
    transactions = F.transform(F.sequence(F.lit(1), count), transaction)
    document = F.to_xml(F.struct(transactions.alias("Transaction")), {"rowTag": "Data"})
    return seeds.withColumn("xml", F.concat_ws("\n", F.lit(DECLARATION), document))


def document_stream(spark: SparkSession, documents_per_second: int = 1, salt: int = 0) -> DataFrame:
    """An endless stream of documents at a steady rate."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", documents_per_second).load()
    return generate_documents(rate, seed="value", salt=salt, at=F.col("timestamp")).select("value", "timestamp", "xml")
