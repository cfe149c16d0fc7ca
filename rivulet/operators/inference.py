"""Schema inference for documents nobody has described yet."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def infer_document_schema(documents: DataFrame, **options: str) -> T.StructType:
    """The schema of a one-column DataFrame of documents, inferred on the executors.

    One distributed pass merges the types of all documents. `samplingRatio` makes it
    cheaper. The reader that takes text is called with a dataset of strings, which
    Python's own signature does not offer; so no document passes through Python.
    """
    if len(documents.columns) != 1:
        raise ValueError(f"expected one column of documents, got {documents.columns}")
    spark, text = documents.sparkSession, F.col(documents.columns[0])
    texts = documents.filter(text.isNotNull()).select(text.cast("string"))
    strings = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    inferred = spark.read.options(**options)._jreader.xml(strings).schema()
    return T.StructType.fromJson(json.loads(inferred.json()))


def schema_of_document(spark, document: str, **options: str) -> str:
    """DDL of one literal document."""
    row = spark.range(1).select(F.schema_of_xml(F.lit(document), options).alias("ddl")).first()
    return row.ddl


def schema_rows(schema: T.DataType, prefix: str = "") -> list[tuple[str, str]]:
    """(field path, type) pairs of a schema, arrays marked with []."""
    if isinstance(schema, T.ArrayType):
        return schema_rows(schema.elementType, f"{prefix}[]")
    if isinstance(schema, T.StructType):
        nested = [schema_rows(f.dataType, f"{prefix}.{f.name}" if prefix else f.name) for f in schema.fields]
        return [pair for pairs in nested for pair in pairs]
    return [(prefix, schema.simpleString())]
