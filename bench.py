"""Times the pipeline's stages and the headline queries; prints one JSON line.

    BENCH_SF_DIR   tables to use (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default all)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.audit import batch_time
from rivulet.functions.envelope import decode_envelope
from rivulet.operators.documents import explode_transactions, parse_documents
from rivulet.operators.topic import project_topic
from rivulet.plans import inputs
from rivulet.plans.catalog import QUERIES
from rivulet.plans.refine import refine, silver_rows
from rivulet.session import build_session, work_dir
from rivulet.sinks.bronze import append_bronze
from rivulet.sinks.silver_log import SilverLog
from rivulet.streaming.silver import start_silver
from rivulet.zones import Zones

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
WARM_DIR = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))

# Batch queries are run three times, streaming ones (they write) once.
BATCH = [
    "envelope_roundtrip",
    "bronze_partitions",
    "bronze_dedup_offsets",
    "document_classes",
    "flatten_transactions",
    "clean_amounts",
    "reject_rows",
    "latest_per_key",
    "latest_by_user",
    "merge_upsert",
    "latest20_bronze",
    "generate_documents",
    "large_document_rows",
]
WRITING = [
    "stream_landing",
    "stream_bronze",
    "malformed_rows",
    "merge_order_guard",
    "fold_batches",
    "compacted_silver",
    "stream_silver",
    "dlq_replay",
    "end_to_end",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work: Callable[[], object], repeat: int = 1) -> float:
    seconds = []
    for _ in range(repeat):
        begin = time.perf_counter()
        work()
        seconds.append(time.perf_counter() - begin)
    return statistics.median(seconds)


def stages(spark: SparkSession, sf_dir: str) -> tuple[dict[str, float], dict[str, int]]:
    """The stages one by one, on bronze that is already there."""
    zones = Zones(work_dir(spark, "bench"))
    append_bronze(project_topic(inputs.event_bronze(spark, sf_dir)), zones.bronze, batch_time())
    dirty_zones = Zones(work_dir(spark, "bench-dirty"))
    messages = project_topic(inputs.event_bronze(spark, sf_dir))
    cut = F.when(F.pmod(F.col("offset").cast("bigint"), F.lit(10)) == 0, "<cut").otherwise(F.col("value"))
    append_bronze(messages.withColumn("value", cut), dirty_zones.bronze, batch_time())
    bronze = spark.read.parquet(zones.bronze)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = events.agg(F.sum(F.pmod("event_id", F.lit(4)) + 1)).first()[0]

    def parse():
        parsed = parse_documents(decode_envelope(bronze)).select("key", "parsed", "_doc_reason")
        run(explode_transactions(parsed))

    def drain(zones: Zones) -> Callable[[], object]:
        return lambda: start_silver(spark, zones, SilverLog(spark, zones.silver)).awaitTermination()

    seconds = {
        "parse": timed(parse, 3),
        "clean_and_dedup": timed(lambda: run(silver_rows(refine(bronze), 0, batch_time())), 3),
        "drain": timed(drain(zones)),
        "drain_10pct_malformed": timed(drain(dirty_zones)),
    }

    # Batches that hit 1, 10 and 100 percent of the keys of a compacted table.
    base = inputs.event_silver(spark, sf_dir)
    for percent in (1, 10, 100):
        log = SilverLog(spark, Zones(work_dir(spark, f"bench-upsert-{percent}")).silver)
        log.upsert(base, "base", 0)
        log = log.compact(work_dir(spark, f"bench-compacted-{percent}"))
        batch = base.filter(F.pmod(F.xxhash64("TransactionId"), F.lit(100)) < percent)

        def upsert_and_read(log=log, batch=batch):
            log.upsert(batch, "batch", 1)
            run(log.snapshot())

        seconds[f"upsert_{percent}pct"] = timed(upsert_and_read)
    return seconds, {"transactions": rows, "documents": events.count()}


def main() -> None:
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{CPUS}]",
            inputs.TASKS_SETTING: str(CPUS),
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.sql.shuffle.partitions": str(CPUS),
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    if os.path.isdir(WARM_DIR):
        stages(spark, WARM_DIR)
        for name in BATCH:
            run(QUERIES[name](spark, WARM_DIR))
    seconds, sizes = stages(spark, SF_DIR)
    for name in BATCH:
        seconds[name] = timed(lambda: run(QUERIES[name](spark, SF_DIR)), 3)
        print(name, round(seconds[name], 3), file=sys.stderr)
    for name in WRITING:
        seconds[name] = timed(lambda: run(QUERIES[name](spark, SF_DIR)))
        print(name, round(seconds[name], 3), file=sys.stderr)
    result = {
        "metric": "total seconds of all stages and headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(s, 3) for name, s in seconds.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": CPUS,
        "rows": sizes,
        "rows_per_sec": {
            "parse": round(sizes["transactions"] / seconds["parse"]),
            "clean_and_dedup": round(sizes["transactions"] / seconds["clean_and_dedup"]),
            "drain": round(sizes["transactions"] / seconds["drain"]),
        },
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
