"""Command line: `python -m rivulet <job> --root <folder>`, or `spark-submit job.py ...`."""

from __future__ import annotations

import argparse
import logging
from contextlib import nullcontext
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators.generate import document_stream, generate_documents
from rivulet.operators.views import latest_silver, newest_bronze
from rivulet.session import build_session
from rivulet.sinks.catalog_table import CatalogTable
from rivulet.sinks.documents import start_document_files, write_document_files
from rivulet.sinks.silver_log import SilverLog
from rivulet.sources.files import stream_topic_log
from rivulet.sources.kafka import stream_kafka
from rivulet.streaming.bronze import start_bronze
from rivulet.streaming.common import DRAIN, EVERY_MINUTE
from rivulet.streaming.landing import land_records_to_log, land_to_kafka, land_to_log
from rivulet.streaming.outcomes import OutcomeLog
from rivulet.streaming.silver import replay_failed_batches, start_silver
from rivulet.streaming.supervise import run_with_restarts
from rivulet.zones import Zones


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="rivulet", description=__doc__)
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--root", required=True, help="folder of all zones, e.g. hdfs://host:9000")
    parser.add_argument("--kafka", help="broker address; without it a Parquet folder serves as the topic")
    parser.add_argument("--topic", default="transactions")
    parser.add_argument("--table", help="catalog table with MERGE for silver; without it a folder per batch")
    parser.add_argument("--silver", help="folder of silver, say one that compact has written (default: below the root)")
    parser.add_argument("--to", help="new folder that compact writes silver to")
    parser.add_argument("--no-order-guard", action="store_true", help="last processed wins, however old")
    parser.add_argument("--fixed-dates", action="store_true", help="no transaction changes its date (--table)")
    parser.add_argument("--drain", action="store_true", help="stop when the source is read to its end")
    parser.add_argument("--attempts", type=int, help="attempts before giving up (silver: 3, others: no limit)")
    parser.add_argument("--documents", type=int, help="generate this many documents, then stop")
    parser.add_argument("--rate", type=int, default=1, help="documents per second to generate without --documents")
    parser.add_argument("--files", type=int, help="most bronze files per batch")
    parser.add_argument("--since", type=date.fromisoformat, help="first bronze date that silver looks at")
    parser.add_argument("--max-bytes", help="most bytes of one silver batch")
    parser.add_argument("--large-files", action="store_true", help="land a message per transaction, not per file (without --kafka)")
    parser.add_argument("--once-within", help="silver passes over messages read before within this time, e.g. '7 days'")
    parser.add_argument("--max-probes", type=int, default=200, help="silver looks for the bad messages of a failing batch, and warns beyond so many probes (0: batch goes whole)")
    parser.add_argument("--outcomes", action="store_true", help="keep a row per batch and run in the outcomes folder")
    return parser.parse_args(argv)


def _silver_table(spark: SparkSession, args: argparse.Namespace, zones: Zones) -> SilverLog | CatalogTable:
    guard = not args.no_order_guard
    if args.table:
        return CatalogTable(spark, args.table, order_guard=guard, fixed_dates=args.fixed_dates)
    return SilverLog(spark, args.silver or zones.silver, order_guard=guard)


def generate(spark: SparkSession, args: argparse.Namespace, zones: Zones) -> None:
    if args.documents is not None:
        write_document_files(generate_documents(spark.range(args.documents)).select("xml"), zones.landing)
        return
    documents = document_stream(spark, args.rate).select("xml")
    run_with_restarts(
        lambda: start_document_files(documents, zones.landing, zones.checkpoint("generate")), args.attempts
    )


def land(spark: SparkSession, args: argparse.Namespace, zones: Zones) -> None:
    checkpoint, trigger = zones.checkpoint("landing"), DRAIN if args.drain else None
    if args.kafka:
        run_with_restarts(
            lambda: land_to_kafka(spark, zones.landing, args.kafka, args.topic, checkpoint, trigger), args.attempts
        )
    else:
        land_files = land_records_to_log if args.large_files else land_to_log
        run_with_restarts(
            lambda: land_files(spark, zones.landing, zones.topic_log, args.topic, checkpoint, trigger),
            args.attempts,
        )


def bronze(spark: SparkSession, args: argparse.Namespace, zones: Zones) -> None:
    def records() -> DataFrame:
        if args.kafka:
            return stream_kafka(spark, args.kafka, args.topic)
        return stream_topic_log(spark, zones.topic_log)

    trigger = DRAIN if args.drain else EVERY_MINUTE
    run_with_restarts(
        lambda: start_bronze(records(), zones.bronze, zones.bronze_failed, zones.checkpoint("raw"), trigger, args.files),
        args.attempts,
    )


def silver(spark: SparkSession, args: argparse.Namespace, zones: Zones) -> None:
    limit = {"maxBytesPerTrigger": args.max_bytes} if args.max_bytes else {}
    table = _silver_table(spark, args, zones)
    options = {"since": args.since, "once_within": args.once_within, "max_probes": args.max_probes, **limit}
    run_with_restarts(lambda: start_silver(spark, zones, table, **options), args.attempts or 3)


def compact(spark: SparkSession, args: argparse.Namespace, zones: Zones) -> None:
    table = _silver_table(spark, args, zones)
    if isinstance(table, CatalogTable):
        table.compact()
    elif args.to:
        table.compact(args.to)
    else:
        raise SystemExit("compact needs --to, a new folder; give it to later jobs as --silver")


def replay(spark: SparkSession, args: argparse.Namespace, zones: Zones) -> None:
    print(replay_failed_batches(spark, zones, _silver_table(spark, args, zones)))


def show(spark: SparkSession, args: argparse.Namespace, zones: Zones) -> None:
    newest_bronze(spark, zones.bronze, merge=True).show(20, truncate=False)
    latest_silver(_silver_table(spark, args, zones).snapshot()).show(20)


JOBS = {
    "generate": generate,
    "land": land,
    "bronze": bronze,
    "silver": silver,
    "compact": compact,
    "replay": replay,
    "show": show,
}


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    args = arguments(argv)
    spark, zones = build_session(f"rivulet-{args.job}"), Zones(args.root)
    with OutcomeLog(spark, zones.outcomes) if args.outcomes else nullcontext():
        JOBS[args.job](spark, args, zones)


if __name__ == "__main__":
    main()
