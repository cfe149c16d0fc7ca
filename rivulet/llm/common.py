"""What several of these operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.session import work_dir

WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to the shared folder and read back: computed once, with no lineage
    behind it, and safe when executors are lost."""
    path = work_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def filled(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def text_id_crc(column: str) -> Column:
    """crc32 of an id written as text; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes of text at most; one longer text stays whole."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
        start, size = 0, 0
        for i, n in enumerate(lengths):
            if i > start and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if batch.num_rows > start:
            yield batch.slice(start)


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def _ship(spark) -> None:
    """Gives this package to the Python workers of a session, once."""
    context = spark.sparkContext
    if getattr(context, "_rivulet_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="rivulet-code-"), "rivulet.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(root.rglob("*.py")):
            out.write(module, module.relative_to(root.parent))
    context.addPyFile(archive)
    context._rivulet_shipped = True


def mapped(df: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """`mapInArrow` with functions of this package."""
    _ship(df.sparkSession)
    return df.mapInArrow(run, schema)
