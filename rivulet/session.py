"""Session and shared-folder conventions."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What the jobs rely on. Sizes (shuffle partitions, memory) are the cluster's.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}
# Spark lists the files of a streaming batch with one task per file, up to this many.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
MAX_LISTING_TASKS = 10_000
# What opening a file counts as, in bytes, when small files are gathered into tasks.
OPEN_COST = "spark.sql.files.openCostInBytes"
OPEN_COST_BYTES = 128 * 1024


def many_files(spark: SparkSession) -> None:
    """Readies a session for folders of many small files, where it has no settings of its own.

    By Spark's defaults 10,000 tasks list the files of a batch, and a task reads 32 files at
    most. A task costs more than that many small files, so tasks go by cores and by bytes.
    """
    own = {
        LISTING: min(MAX_LISTING_TASKS, 8 * spark.sparkContext.defaultParallelism),
        OPEN_COST: OPEN_COST_BYTES,
    }
    set_before = spark.conf.getAll
    for name, value in own.items():
        if name not in set_before:
            spark.conf.set(name, value)


def build_session(app_name: str, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    many_files(spark)
    return spark


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder that every executor can reach.

    Lies under `spark.checkpoint.dir`. Only a local-mode session without that
    setting gets a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="rivulet-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def dealt(scan: DataFrame, tasks: int | None = None) -> DataFrame:
    """The scan as it is, or dealt out anew over a number of tasks that the caller names.

    For work that costs far more than moving its input, such as parsing a few large
    splits. Nothing is decided from the size of the input or of the cluster.
    """
    return scan if tasks is None else scan.repartition(tasks)
