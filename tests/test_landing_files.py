"""Documents as many small files: whole, alone in their folder, read by few tasks."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from rivulet.sinks.documents import write_document_files
from rivulet.streaming.common import DRAIN
from rivulet.streaming.landing import land_to_log


def test_a_file_per_row_and_nothing_beside_them(spark, tmp_path):
    texts = spark.createDataFrame([("a",), ("a",), ("ä\nb",), (None,), ("",)], "text string")
    broken = spark.range(1).select(F.unhex(F.lit("61FF62")).cast("string").alias("text"))
    for folder in (str(tmp_path / "plain"), f"file://{tmp_path}/named"):
        write_document_files(texts.union(broken).repartition(3), folder)
        path = folder.removeprefix("file://")
        names = os.listdir(path)
        assert all(name.startswith("part-") and name.endswith(".txt") for name in names), names
        contents = sorted(open(f"{path}/{name}", "rb").read() for name in names)
        assert contents == sorted([b"a\n", b"a\n", "ä\nb\n".encode(), b"\n", b"\n", b"a\xffb\n"])


def test_many_small_files_are_landed_by_few_tasks(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    n = 64 * cores
    documents = spark.range(n).select(F.concat(F.lit("<Data>"), "id", F.lit("</Data>")).alias("xml"))
    write_document_files(documents, str(tmp_path / "landing"))
    land_to_log(spark, str(tmp_path / "landing"), str(tmp_path / "topic"), "t", str(tmp_path / "ck"), DRAIN).awaitTermination()
    topic = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "topic"))
    assert topic.select("key").distinct().count() == n
    assert topic.select("partition").distinct().count() <= cores + 1
