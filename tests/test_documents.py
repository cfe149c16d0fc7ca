import base64
import json
from datetime import datetime

import pytest
from documents import CASES, SAMPLE, data, transaction
from helpers import bronze, documents, envelope, message
from pyspark.sql import functions as F

from rivulet.operators import documents as operators
from rivulet.functions.envelope import decode_envelope, wrap_files
from rivulet.operators.documents import document_class, explode_transactions, first_of_document, parse_documents
from rivulet.operators.transactions import amount_invalid, is_valid_row
from rivulet.plans import inputs
from rivulet.plans.refine import batch_counts, refine, silver_rows
from rivulet.schemas import ENVELOPE, FILE_ROW, SILVER_ROW


@pytest.fixture(scope="module")
def case_bronze(spark):
    rows = [message(envelope(text), key=name) for name, (text, *_) in CASES.items()]
    return bronze(spark, rows)


@pytest.fixture(scope="module")
def refined(case_bronze):
    rows = refine(case_bronze).cache()
    yield rows
    rows.unpersist()


def test_document_classes(case_bronze):
    parsed = parse_documents(decode_envelope(case_bronze)).select("key", document_class(), "_doc_reason")
    found = {key: (cls, reason) for key, cls, reason in parsed.collect()}
    assert found == {name: (cls, reason) for name, (_, cls, reason, _, _) in CASES.items()}


def test_rows_of_each_case(spark):
    named = [message(envelope(c[0]), key=name, offset=i) for i, (name, c) in enumerate(CASES.items())]
    rows = refine(bronze(spark, named))
    found = rows.groupBy("_topic_offset").agg(
        F.count_if(first_of_document()), F.count_if(is_valid_row()), F.count_if(F.col("_row_reason").isNotNull())
    )
    names = list(CASES)
    assert {names[r[0]]: tuple(r)[1:] for r in found.collect()} == {n: (1, c[3], c[4]) for n, c in CASES.items()}


def test_batch_counts_add_up(refined):
    counts = batch_counts(refined).first()
    assert counts.documents == len(CASES)
    assert counts.malformed == sum(c[1] == "malformed" for c in CASES.values())
    assert counts.empty == sum(c[1] == "empty" for c in CASES.values())
    assert counts.valid == sum(c[3] for c in CASES.values())
    assert counts.rejected == sum(c[4] for c in CASES.values())


def test_sample_document_last_occurrence_wins(spark):
    rows = silver_rows(refine(documents(spark, SAMPLE)), 3, F.current_timestamp()).orderBy("TransactionId").collect()
    found = [
        (r.TransactionId, str(r.Amount), r.CustomerId, r.Location, r.Status, str(r.TransactionDate), r._batch_id)
        for r in rows
    ]
    assert found == [
        (77, "640.00", 12, "OSLO", "SUCCESS", "2022-03-01", 3),
        (501, "20.10", 9, "BERN", "SUCCESS", "2022-02-28", 3),
    ]


def test_silver_schema(refined):
    silver = silver_rows(refined, 0, F.current_timestamp())
    assert [(f.name, f.dataType) for f in silver.schema] == [(f.name, f.dataType) for f in SILVER_ROW]


def test_amounts(spark):
    texts = ["12.30", "12,5", "123456789.999", "", None, "0", "-4.005", " 7.1 "]
    rows = documents(spark, data(*[transaction(str(i), amount=t) for i, t in enumerate(texts)]))
    silver = silver_rows(refine(rows), 0, F.current_timestamp()).orderBy("TransactionId")
    amounts = [None if r.Amount is None else str(r.Amount) for r in silver.collect()]
    assert amounts == ["12.30", None, None, None, None, "0.00", "-4.01", "7.10"]
    raw = spark.createDataFrame([(t,) for t in texts], "t string")
    invalid = [r[0] for r in raw.select(amount_invalid(F.col("t"))).collect()]
    assert [bool(x) for x in invalid] == [False, True, True, False, False, False, False, False]


def test_times_keep_micros_and_honour_offsets(spark):
    times = ["2024-01-31T04:08:41.123456", "2024-01-31T04:08:41+02:00", "2024-01-31T00:30:00+01:00"]
    rows = documents(spark, data(*[transaction(str(i), time=t) for i, t in enumerate(times)]))
    silver = silver_rows(refine(rows), 0, F.current_timestamp()).orderBy("TransactionId")
    assert [(str(r.TransactionDateTime), str(r.TransactionDate)) for r in silver.collect()] == [
        ("2024-01-31 04:08:41.123456", "2024-01-31"),
        ("2024-01-31 02:08:41", "2024-01-31"),
        ("2024-01-30 23:30:00", "2024-01-30"),
    ]


@pytest.mark.parametrize(
    "value, reason",
    [
        (None, "bad_envelope"),
        ("", "bad_envelope"),
        ("no json", "bad_envelope"),
        ('{"path":"a"}', "bad_envelope"),
        ('{"path":"a","content":"QQ=="', "bad_envelope"),
        ('{"path":"a","content":"####"}', "bad_base64"),
        (envelope(b"\xff\xfe<Data/>"), "bad_utf8"),
    ],
)
def test_undecodable_messages(spark, value, reason):
    parsed = parse_documents(decode_envelope(bronze(spark, [message(value)])))
    row = parsed.select("_decode_reason", "_doc_reason", "xml_content").first()
    assert (row._decode_reason, row._doc_reason, row.xml_content) == (reason, reason, None)


def test_envelope_roundtrip_of_any_bytes(spark):
    payloads = [b"", bytes(range(256)), "äöü €".encode()]
    rows = [(f"/in/{i}", datetime(2024, 1, 1), len(p), bytearray(p)) for i, p in enumerate(payloads)]
    messages = wrap_files(spark.createDataFrame(rows, FILE_ROW))
    decoded = decode_envelope(messages).orderBy("key").collect()
    assert [bytes(r.decoded_content) for r in decoded] == payloads
    assert [r.json_data.length for r in decoded] == [str(len(p)) for p in payloads]
    assert decode_envelope(messages).schema["json_data"].dataType == ENVELOPE


def test_base64_may_be_wrapped(spark):
    """MIME line breaks inside the content are no fault."""
    document = data(*[transaction(str(i)) for i in range(9)])
    wrapped = base64.encodebytes(document.encode()).decode()
    value = json.dumps({"path": "a", "content": wrapped})
    assert decode_envelope(bronze(spark, [message(value)])).first().xml_content == document


def test_white_space_after_the_padding_is_trimmed_where_there_is_some(spark):
    ends = ["", " ", "\n", "\r\n", "\t", " \n\t\r "]
    values = [json.dumps({"path": "a", "content": base64.b64encode(b"<Data/>").decode() + end}) for end in ends]
    decoded = decode_envelope(bronze(spark, [message(v, i) for i, v in enumerate(values)])).select("xml_content", "_decode_reason")
    assert {tuple(r) for r in decoded.collect()} == {("<Data/>", None)}
    plan = decoded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("rtrim(") + plan.count("trim(TRAILING") <= plan.lower().count("case when (((endswith(")


def test_a_cheap_count_is_enough_where_no_tag_is_unread(spark):
    """It is never below the exact one, whatever the letters, and the same in documents as they come."""
    tags = ["<Transaction>", "</Transaction>", "<a:TRANSACTION/>", "</a:transaction>", "<TransactionId>", "transaction ", "<", "/", "\u0130", "x"]
    texts = ["".join(tags[(i >> k * 3) % len(tags)] for k in range(5)) for i in range(0, 1 << 15, 37)]
    texts += [SAMPLE, data(), data(transaction("1"), transaction("2")), "<Data><Trans\u0131ction/></Data>"]
    counts = spark.createDataFrame([(t,) for t in texts], "xml string").select(
        "xml", operators.transactions_at_most(F.col("xml")).alias("most"), operators.transactions_written(F.col("xml")).alias("exact")
    )
    rows = {r.xml: r for r in counts.collect()}
    assert all(r.most >= r.exact for r in rows.values())
    assert all(rows[t].most == rows[t].exact for t in texts[-4:])


def test_the_default_timestamp_type_does_not_matter(spark):
    rows = documents(spark, data(transaction("1", time="2024-01-31T04:08:41+02:00")))
    spark.conf.set("spark.sql.timestampType", "TIMESTAMP_NTZ")
    try:
        found = silver_rows(refine(rows), 0, F.current_timestamp()).select("TransactionDateTime").first()[0]
    finally:
        spark.conf.unset("spark.sql.timestampType")
    assert str(found) == "2024-01-31 02:08:41"


def test_explode_drops_or_keeps_empty_documents(spark):
    parsed = parse_documents(decode_envelope(documents(spark, data(), data(transaction(), transaction()))))
    slim = parsed.select("key", "parsed")
    assert [r._position for r in explode_transactions(slim).orderBy("_position").collect()] == [0, 1]
    kept = explode_transactions(slim, keep_empty=True).select("key", "_position").orderBy("key", "_position").collect()
    assert [tuple(r) for r in kept] == [("/in/0.xml", None), ("/in/1.xml", 0), ("/in/1.xml", 1)]


def test_parse_once(spark, tmp_path):
    """However often a column is used, text is parsed once per document."""
    documents(spark, SAMPLE).write.parquet(f"{tmp_path}/b")
    plan = silver_rows(refine(spark.read.parquet(f"{tmp_path}/b")), 0, F.current_timestamp())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json(") == 1
    assert text.count("from_xml(") == 1
    assert "WindowGroupLimit" in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_documents_of_a_table_in_one_split_are_made_by_many_tasks(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id").alias("event_id"), F.lit("x").alias("event_type"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    spread = inputs.spread_table(spark, str(tmp_path), "events", "event_id")
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1000 and len(sizes) >= spark.sparkContext.defaultParallelism
    rows.repartition(100).write.parquet(f"{tmp_path}/many.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:  # enough splits: no shuffle
        many = inputs.spread_table(spark, str(tmp_path), "many", "event_id")
        assert "Exchange" not in many._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
