"""Copies of messages, bad messages in good batches, large files, newest rows, outcomes."""

import os
import threading
from datetime import date, datetime, timezone

import pytest
from documents import data, transaction
from helpers import bronze, envelope, message, topic
from pyspark.sql import functions as F

from rivulet.functions.audit import batch_time
from rivulet.functions.envelope import decode_envelope, wrap_files
from rivulet.operators.documents import parse_documents
from rivulet.operators.views import latest_bronze, newest_bronze
from rivulet.plans.refine import refine
from rivulet.schemas import FAILED_BATCH, MALFORMED, OUTCOME, REJECTED
from rivulet.sinks.bronze import append_bronze
from rivulet.sinks.silver_log import SilverLog
from rivulet.sources.files import read_bronze, read_bronze_since, read_table
from rivulet.sources.records import read_records, record_files, stream_records
from rivulet.streaming.common import DRAIN
from rivulet.streaming import isolate as isolating
from rivulet.streaming.isolate import isolate
from rivulet.streaming.outcomes import OutcomeLog, read_outcomes
from rivulet.streaming.silver import replay_failed_batches, start_silver


def append(spark, zones, messages, hour=0, day=31):
    append_bronze(topic(spark, messages), zones.bronze, batch_time(datetime(2024, 1, day, hour, tzinfo=timezone.utc)))


def letters(spark, zones):
    paths = [(zones.malformed, MALFORMED), (zones.rejected, REJECTED), (zones.failed_batches, FAILED_BATCH)]
    return [read_table(spark, path, schema).count() for path, schema in paths]


# Copies


MESSAGES = [message(envelope(x), i) for i, x in enumerate([data(transaction(str(1))), "<Data><Transaction>", data(transaction("x"))])]


def run_silver(spark, zones, log, counts, **job):
    query = start_silver(spark, zones, log, report=lambda _, c: counts.append(c), once_within="1 day", **job)
    query.awaitTermination()
    assert query.exception() is None


def test_a_message_counts_once_over_batches_and_restarts(spark, zones):
    log, counts = SilverLog(spark, zones.silver), []
    append(spark, zones, [*MESSAGES, MESSAGES[1]])  # a copy within the batch
    run_silver(spark, zones, log, counts)
    append(spark, zones, MESSAGES, hour=1)
    append(spark, zones, [*MESSAGES, message(envelope(data(transaction(str(2)))), 3)], hour=2)
    run_silver(spark, zones, log, counts)  # a new run, from the checkpoint
    assert [sum(c[name] for c in counts) for name in ("documents", "malformed", "rejected", "valid")] == [4, 1, 1, 2]
    assert letters(spark, zones) == [1, 1, 0]
    assert sorted(r.TransactionId for r in log.snapshot().collect()) == [1, 2]


def test_messages_without_a_place_in_the_topic_are_no_copies_of_each_other(spark, zones):
    log, counts = SilverLog(spark, zones.silver), []
    rows = [(*message(envelope(data(transaction(str(i)))), 0)[:4], None, *message("", 0)[5:]) for i in (1, 2)]
    append(spark, zones, rows)
    run_silver(spark, zones, log, counts)
    assert log.snapshot().count() == 2 and counts[0].documents == 2


def test_old_messages_are_not_late(spark, zones):
    log, counts = SilverLog(spark, zones.silver), []
    append(spark, zones, MESSAGES[:1], day=31)
    run_silver(spark, zones, log, counts)
    append(spark, zones, [message(envelope(data(transaction(str(9)))), 77)], day=1)  # an older date
    run_silver(spark, zones, log, counts)
    assert sorted(r.TransactionId for r in log.snapshot().collect()) == [1, 9]


def test_silver_of_a_stream_with_state_has_few_files_per_date(spark, zones):
    times = [f"2024-01-{d:02d}T00:00:00" for d in range(1, 11)]
    texts = [data(transaction(str(i), time=times[i % 10])) for i in range(80)]
    append(spark, zones, [message(envelope(x), i) for i, x in enumerate(texts)])
    log, settings = SilverLog(spark, zones.silver), []
    adaptive = lambda rows: (settings.append(rows.sparkSession.conf.get("spark.sql.adaptive.enabled")), refine(rows))[1]
    start_silver(spark, zones, log, once_within="1 day", refine_rows=adaptive).awaitTermination()
    assert settings == ["true"] and log.snapshot().count() == 80
    files = [f for _, _, names in os.walk(zones.silver) for f in names if f.endswith(".parquet")]
    assert len(files) <= 20  # 10 dates; a file for each task and date would be nearly 80


# Bad messages


def poisoned(*bad):
    def run(rows):
        poison = F.raise_error(F.lit("poisoned")).cast("string")
        return refine(rows.withColumn("value", F.when(F.col("offset").isin(*map(str, bad)), poison).otherwise(F.col("value"))))

    return run


def many(n):
    return [message(envelope(data(transaction(str(i + 1)))), i) for i in range(n)]


@pytest.mark.parametrize("bad", [(17,), (0, 1, 63)])
def test_bad_messages_are_found_in_few_probes(spark, tmp_path, bad):
    parts = isolate(bronze(spark, many(64)).repartition(3), str(tmp_path / "work"), poisoned(*bad), 1000)
    assert sorted(int(r.offset) for r in parts.bad.collect()) == list(bad)
    assert parts.good.count() == 64 - len(bad) and parts.complete
    assert parts.probes <= 2 + len(bad) * 2 * 10  # about twice the binary logarithm for each


def test_a_limit_on_probes_takes_neighbours_along(spark, tmp_path):
    bad = range(0, 64, 2)
    parts = isolate(bronze(spark, many(64)), str(tmp_path / "work"), poisoned(*bad), 6)
    found = {int(r.offset) for r in parts.bad.collect()}
    assert set(bad) <= found and not parts.complete and parts.probes <= 8
    assert parts.good.count() + len(found) == 64


@pytest.mark.parametrize("bad", [(1, 2, 7, 11), range(12)])
def test_beyond_the_limit_the_search_goes_on_to_its_end(spark, tmp_path, bad):
    parts = isolate(bronze(spark, many(12)), str(tmp_path / "work"), poisoned(*bad), 3)
    assert sorted(int(r.offset) for r in parts.bad.collect()) == list(bad)
    assert sorted(int(r.offset) for r in parts.good.collect()) == sorted(set(range(12)) - set(bad))
    assert parts.probes <= 3 and parts.beyond > 0 and not parts.complete


def test_ranges_of_a_level_are_probed_at_once(spark, tmp_path, monkeypatch):
    running, most, lock, fails = 0, 0, threading.Lock(), isolating._fails

    def counted(*of):
        nonlocal running, most
        with lock:
            running += 1
            most = max(most, running)
        try:
            return fails(*of)
        finally:
            with lock:
                running -= 1

    monkeypatch.setattr(isolating, "_fails", counted)
    bad = (1, 9, 22, 40, 41, 63)
    parts = isolate(bronze(spark, many(64)), str(tmp_path / "work"), poisoned(*bad), 1000)
    assert sorted(int(r.offset) for r in parts.bad.collect()) == list(bad) and parts.complete
    assert most >= 2


def test_a_batch_that_can_be_refined_has_no_bad_messages(spark, tmp_path):
    assert isolate(bronze(spark, many(4)), str(tmp_path / "work"), refine, 10) is None


def test_good_messages_of_a_failing_batch_reach_silver(spark, zones):
    log = SilverLog(spark, zones.silver)
    append(spark, zones, [*many(20), message("no envelope", 20)])
    start_silver(spark, zones, log, refine_rows=poisoned(5), max_probes=50).awaitTermination()
    assert letters(spark, zones) == [1, 0, 1]
    failed = read_table(spark, zones.failed_batches, FAILED_BATCH).first()
    assert failed.offset == "5" and "poisoned" in failed.error_message
    assert sorted(r.TransactionId for r in log.snapshot().collect()) == [i for i in range(1, 21) if i != 6]
    replay_failed_batches(spark, zones, log)  # the fault is mended
    assert log.snapshot().count() == 20


class Unwritable(SilverLog):
    def upsert(self, rows, source, batch_id):
        raise OSError("disk full")


def test_a_fault_of_the_sink_sends_the_whole_batch(spark, zones):
    append(spark, zones, many(3))
    start_silver(spark, zones, Unwritable(spark, zones.silver), max_probes=50).awaitTermination()
    assert letters(spark, zones) == [0, 0, 3]


# Large files


def one(i, opening="<Transaction>"):
    return transaction(str(i)).replace("<Transaction>", opening)


CASES = {
    "roots.xml": data(one(1)) + "\n" + data(one(2), one(3)) + data(),
    "self-closed.xml": data("<Transaction/>", one(4)),
    "attributes.xml": data(one(5, '<Transaction no="1">'), one(6, "<Transaction\n>")),
    "comment.xml": data("<!-- <Transaction> -->", one(7)),
    "whole-comment.xml": data(f"<!-- {one(8)} -->", one(9)),
    "truncated.xml": data(one(10)) + "<Data>" + one(11).removesuffix("</Transaction>"),
    "no-root-end.xml": "<Data>" + one(12),
    "other-case.xml": data(one(13).replace("Transaction>", "transaction>"), one(14)),
    "none.xml": data(),
}


def write(folder, files):
    os.makedirs(folder, exist_ok=True)
    for name, content in files.items():
        with open(f"{folder}/{name}", "w") as file:
            file.write(content)


def parsed(rows):
    return parse_documents(decode_envelope(wrap_files(rows)))


def ids(rows):
    kept = parsed(rows).filter("_doc_reason IS NULL").select(F.explode("parsed.Transaction.TransactionId").alias("id"))
    return sorted(int(r.id) for r in kept.collect() if r.id)


def test_files_of_any_shape_are_accounted_for(spark, tmp_path):
    write(str(tmp_path), CASES)
    rows = record_files(read_records(spark, str(tmp_path)))
    assert ids(rows) == [1, 2, 3, 4, 5, 6, 7, 9, 10, 12, 14]
    bad = parsed(rows).filter("_doc_reason IS NOT NULL").select(F.element_at(F.split("key", "/"), -1).alias("name")).collect()
    assert sorted(r.name for r in bad) == ["other-case.xml", "self-closed.xml", "truncated.xml", "whole-comment.xml", "whole-comment.xml"]


def test_records_stream_as_they_are_read(spark, zones):
    from rivulet.streaming.landing import land_records_to_log

    for part in (dict(list(CASES.items())[:4]), dict(list(CASES.items())[4:])):
        write(zones.landing, part)
        land_records_to_log(spark, zones.landing, zones.topic_log, "t", zones.checkpoint("landing"), DRAIN).awaitTermination()
    log = spark.read.option("recursiveFileLookup", "true").parquet(zones.topic_log)
    whole = wrap_files(record_files(read_records(spark, zones.landing)))
    assert sorted(r.value for r in log.collect()) == sorted(r.value for r in whole.collect())
    assert stream_records(spark, zones.landing).isStreaming


def test_one_file_of_over_100_mb_feeds_many_tasks(spark, tmp_path):
    each = [one(i) for i in range(1, 1001)]
    block = data(*each) + "\n"
    repeats = 110_000_000 // len(block) + 1
    with open(tmp_path / "large.xml", "w") as file:
        for _ in range(repeats):
            file.write(block)
    assert os.path.getsize(tmp_path / "large.xml") > 100_000_000
    records = read_records(spark, str(tmp_path))
    assert records.rdd.getNumPartitions() >= 4
    rows = record_files(records)
    assert rows.count() == 1000 * repeats
    last = parsed(rows.filter(F.contains(F.col("content").cast("string"), F.lit("<TransactionId>1000<"))))
    assert last.count() == repeats and last.filter("_doc_reason IS NOT NULL").count() == 0


# Newest rows


def test_newest_rows_come_from_the_newest_folders_alone(spark, zones):
    for day, hour, first in ((1, 3, 0), (20, 5, 10), (20, 7, 20), (21, 0, 30)):
        append(spark, zones, [message("x", first + i) for i in range(8)], hour, day)
    for n, folders in ((5, {"21"}), (10, {"20", "21"}), (20, {"20", "21"}), (30, {"01", "20", "21"}), (99, {"01", "20", "21"})):
        found = newest_bronze(spark, zones.bronze, n)
        assert found.collect() == latest_bronze(read_bronze(spark, zones.bronze), n).collect()
        assert {f.split("_raw_insert_date=2024-01-")[1][:2] for f in found.inputFiles()} <= folders
    assert newest_bronze(spark, zones.bronze, 10).filter("_raw_insert_hour = '05'").count() == 0


def test_newest_rows_of_no_bronze(spark, zones):
    assert newest_bronze(spark, zones.bronze).count() == 0
    assert newest_bronze(spark, zones.bronze, merge=True).count() == 0


def test_newest_rows_of_the_future_and_with_grown_columns(spark, zones):
    append(spark, zones, [message("x", 1)])
    grown = topic(spark, [message("y", 2)]).withColumn("headers", F.lit("h"))
    append_bronze(grown, zones.bronze, batch_time(datetime(2024, 1, 31, tzinfo=timezone.utc)))
    found = newest_bronze(spark, zones.bronze, 20, date(2023, 1, 1), merge=True)
    assert sorted((r.offset, r.headers) for r in found.collect()) == [("1", None), ("2", "h")]
    assert read_bronze_since(spark, zones.bronze, date(2024, 2, 1)).count() == 0


# Outcomes


def test_outcomes_tell_of_batches_and_failures(spark, zones, tmp_path):
    append(spark, zones, many(3))
    with OutcomeLog(spark, zones.outcomes) as log:
        good = start_silver(spark, zones, SilverLog(spark, zones.silver))
        good.awaitTermination()
        assert log.settled(good)
        write(str(tmp_path / "in"), {"a.json": '{"a": 1}'})
        bad = spark.readStream.schema("a int").json(str(tmp_path / "in")).select(F.raise_error(F.lit("broken")))
        failing = bad.writeStream.format("noop").option("checkpointLocation", zones.checkpoint("bad")).start()
        with pytest.raises(Exception, match="broken"):
            failing.awaitTermination()
        assert log.settled(failing)
    rows = read_outcomes(spark, zones.outcomes).collect()
    assert sorted((r.event, r.batch_id) for r in rows if r.query_id == str(good.id)) == [("batch", 0), ("ended", None)]
    failed = [r for r in rows if r.query_id == str(failing.id)]
    assert [r.event for r in failed] == ["failed"] and "broken" in failed[0].error
    assert set(rows[0].asDict()) == set(OUTCOME.names)
