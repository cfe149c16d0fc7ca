"""File sources: landed documents, bronze, tables that may not exist yet."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.schemas import BRONZE, CORRUPT, FILE_ROW, TOPIC, TRANSACTION
from rivulet.session import many_files


# Spark passes over a file whose time lies more than `maxFileAge` behind the newest one
# seen. Files arrive late and out of order here, so none is ever too old.
NO_FILE_TOO_OLD = {"maxFileAge": "36500d"}


def stream_files(spark: SparkSession, directory: str, **options: str) -> DataFrame:
    """Every file that lands in `directory`, once per checkpoint, as one row.

    Useful options: `pathGlobFilter`, `maxFilesPerTrigger`, `maxBytesPerTrigger`,
    `recursiveFileLookup`. Zero-length files and names that begin with "_" or
    "." give no row. No file is passed over for its age; what that costs is a map of
    all files seen, on the driver, as long as they lie in the folder. Bound it with
    `cleanSource=archive`, or with a `maxFileAge` of your own where none comes late.
    """
    many_files(spark)
    options = {**NO_FILE_TOO_OLD, **options}
    return spark.readStream.format("binaryFile").schema(FILE_ROW).options(**options).load(directory)


def stream_bronze(spark: SparkSession, bronze: str, since: date | None = None, **options: str) -> DataFrame:
    """Bronze rows as they are appended, partition columns as DATE and "HH" text.

    Spark lists the whole folder for every batch, which gets slow as bronze
    grows. `since` leaves out the dates before it. It must not be later than the
    oldest date that may hold files the query has not read.
    """
    stream = spark.readStream.schema(BRONZE).options(**{**NO_FILE_TOO_OLD, **options})
    if since is None:
        return stream.parquet(bronze)
    return stream.option("basePath", bronze).parquet(f"{bronze}/_raw_insert_date={{{','.join(dates_from(since))}}}")


def dates_from(first: date) -> list[str]:
    """Path patterns that match `first` and every later ISO date, with no end.

    A later date agrees with the first up to some digit, has a greater one there,
    and may be anything after it.
    """
    day = first.isoformat()
    later = [
        f"{day[:i]}[{int(digit) + 1}-9]{''.join('-' if c == '-' else '?' for c in day[i + 1:])}"
        for i, digit in enumerate(day)
        if digit.isdigit() and digit != "9"
    ]
    return [day, *later]


def stream_topic_log(spark: SparkSession, directory: str, **options: str) -> DataFrame:
    """Messages of the file-based topic (see `sinks.topic_log`)."""
    options = {**NO_FILE_TOO_OLD, "recursiveFileLookup": "true", **options}
    return spark.readStream.schema(TOPIC).options(**options).parquet(directory)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table whose files may have grown columns over time."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def read_merged_bronze(spark: SparkSession, bronze: str) -> DataFrame:
    """Bronze with every column that any of its files has grown, after the declared ones."""
    try:
        found = read_merged(spark, bronze).schema
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return read_bronze(spark, bronze)
    grown = [field for field in found if field.name not in BRONZE.names]
    return read_table(spark, bronze, T.StructType(BRONZE.fields + grown))


def read_bronze(spark: SparkSession, bronze: str) -> DataFrame:
    return read_table(spark, bronze, BRONZE)


def read_bronze_since(spark: SparkSession, bronze: str, first: date, merge: bool = False) -> DataFrame:
    """Bronze from a date on. Only the folders of these dates are listed.

    With `merge`, the columns that their files have grown come after the declared ones.
    """
    dates = f"{bronze}/_raw_insert_date={{{','.join(dates_from(first))}}}"

    def read(schema: T.StructType) -> DataFrame:
        try:
            return spark.read.schema(schema).option("basePath", bronze).parquet(dates)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    if not merge or not read(BRONZE).inputFiles():
        return read(BRONZE)
    found = spark.read.option("basePath", bronze).option("mergeSchema", "true").parquet(dates).schema
    return read(T.StructType(BRONZE.fields + [f for f in found if f.name not in BRONZE.names]))


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table with a known schema; empty while its folder does not exist."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # Known to be empty when the plan is made, so joins with it fall away.
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        return spark.range(1).filter(F.lit(False)).select(*nothing)


_ROW_SCHEMA = T.StructType(TRANSACTION.fields + [T.StructField(CORRUPT, T.StringType())])


def _row_options(**options: str) -> dict[str, str]:
    return {"rowTag": "Transaction", "columnNameOfCorruptRecord": CORRUPT, **options}


def read_transactions(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Transactions straight from XML files, for documents too large for one row.

    One root element per file: the reader stops after the first root and leaves
    a corrupt row, so always look at the rows whose `_corrupt_record` is set.
    """
    return spark.read.format("xml").schema(_ROW_SCHEMA).options(**_row_options(**options)).load(path)


def stream_transactions(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """`read_transactions` as a stream."""
    return spark.readStream.format("xml").schema(_ROW_SCHEMA).options(**_row_options(**options)).load(path)
