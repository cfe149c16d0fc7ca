"""Document parsing: XML text to transactions, with nothing lost in silence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.schemas import CORRUPT, DOCUMENT

_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
# Comments and CDATA sections may quote tags that are no elements.
_QUOTED = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>"
# An opening tag, self-closed ones and ones with a prefix too. The parser does not mind case.
_TRANSACTION = r"(?i)<(?:[\w.-]+:)?Transaction(?=[\s/>])"
# In lower case: whatever may be one, and more. Found several times as fast, as it begins with fixed letters.
_PERHAPS = r"transaction(?=[\s/>])(?<!</transaction)"


def parse_documents(df: DataFrame, xml: str = "xml_content") -> DataFrame:
    """Adds `parsed` (the document) and `_doc_reason` (NULL when all is well).

    Expects `_decode_reason` from the envelope if the text came from one.
    Reasons: the decode reason, `no_document` for NULL text, `bad_xml`, or
    `unread_transactions` when the text holds more transactions than the parser
    delivers (a second root element, a foreign namespace, deeper nesting). Such
    a document keeps the transactions that were read *and* has a reason.
    """
    parsed = df.withColumn("parsed", F.from_xml(xml, DOCUMENT, _OPTIONS))
    # A column of its own, so that the counts below share it.
    unquoted = F.when(F.contains(xml, F.lit("<!")), F.regexp_replace(xml, _QUOTED, "")).otherwise(F.col(xml))
    reason = _doc_reason(F.col(xml), "_decode_reason" in df.columns)
    return parsed.withColumn("_elements", unquoted).withColumn("_doc_reason", reason).drop("_elements")


def _doc_reason(xml: Column, from_envelope: bool) -> Column:
    decode_reason = F.col("_decode_reason") if from_envelope else F.lit(None).cast("string")
    read = F.greatest(F.coalesce(F.size("parsed.Transaction"), F.lit(0)), F.lit(0))
    unread = (transactions_at_most(F.col("_elements")) > read) & (_opening_tags(F.col("_elements")) > read)
    return (
        F.when(decode_reason.isNotNull(), decode_reason)
        .when(xml.isNull(), "no_document")
        .when(F.col(f"parsed.{CORRUPT}").isNotNull(), "bad_xml")
        .when(unread, "unread_transactions")
    )


def _opening_tags(elements: Column) -> Column:
    return F.regexp_count(elements, F.lit(_TRANSACTION))


def transactions_at_most(elements: Column) -> Column:
    """No fewer than the text opens once its comments are gone, mostly as many, and cheaper to count."""
    return F.regexp_count(F.lower(elements), F.lit(_PERHAPS))


def transactions_written(xml: Column) -> Column:
    """How many transactions the text opens, whatever their case or namespace prefix."""
    return _opening_tags(F.when(F.contains(xml, F.lit("<!")), F.regexp_replace(xml, _QUOTED, "")).otherwise(xml))


def document_class() -> Column:
    """`malformed`, `empty` (well-formed, no transaction) or `valid`."""
    return (
        F.when(F.col("_doc_reason").isNotNull(), "malformed")
        .when(F.coalesce(F.size("parsed.Transaction"), F.lit(0)) <= 0, "empty")
        .otherwise("valid")
    )


def explode_transactions(parsed: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per transaction, with its `_position` in the document.

    With `keep_empty`, a document without transactions still yields one row,
    with NULL position, so that documents can be counted and dead-lettered
    from the same row stream.

    Always the outer explode: for the inner one Spark infers a size check on the
    array and pushes it below the parse, which then runs twice.
    """
    rest = [c for c in parsed.columns if c != "parsed"]
    rows = parsed.select(*rest, F.posexplode_outer("parsed.Transaction").alias("_position", "_transaction"))
    return rows if keep_empty else rows.filter(F.col("_position").isNotNull())


def first_of_document() -> Column:
    """True on exactly one row per document of `explode_transactions(keep_empty=True)`."""
    return F.coalesce(F.col("_position"), F.lit(0)) == 0
