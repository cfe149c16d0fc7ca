"""Flattening and cleaning of single transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions import values


def clean_transactions(rows: DataFrame) -> DataFrame:
    """Replaces `_transaction` by typed columns and `_row_reason`.

    `_row_reason` is NULL for a good row, `null_key` without a transaction id,
    `bad_type` when an id or the time is present but unreadable. An unreadable
    amount is no reason: the row stays, its amount NULL. The raw transaction is
    kept, as `_rejected`, only where there is a reason.
    """
    tx = F.col("_transaction")
    rest = [c for c in rows.columns if c != "_transaction"]
    typed = rows.select(
        *rest,
        tx,
        values.identifier(tx.TransactionId).alias("TransactionId"),
        values.amount(tx.Amount).alias("Amount"),
        values.identifier(tx.CustomerId).alias("CustomerId"),
        values.event_time(tx.DateTime).alias("TransactionDateTime"),
        values.label(tx.Location).alias("Location"),
        values.label(tx.Result).alias("Status"),
    )
    return (
        typed.withColumn("TransactionDate", F.to_date("TransactionDateTime"))
        .withColumn("_row_reason", _row_reason(tx))
        .withColumn("_rejected", F.when(F.col("_row_reason").isNotNull(), tx))
        .drop("_transaction")
    )


def _row_reason(tx: Column) -> Column:
    def unreadable(text: Column, typed: str) -> Column:
        return values.present(text).isNotNull() & F.col(typed).isNull()

    return (
        F.when(tx.isNull(), None)
        .when(values.present(tx.TransactionId).isNull(), "null_key")
        .when(
            unreadable(tx.TransactionId, "TransactionId")
            | unreadable(tx.CustomerId, "CustomerId")
            | unreadable(tx.DateTime, "TransactionDateTime"),
            "bad_type",
        )
    )


def is_valid_row() -> Column:
    return F.col("_position").isNotNull() & F.col("_row_reason").isNull()


def amount_invalid(raw_amount: Column) -> Column:
    """True where an amount was given but could not be read."""
    return values.present(raw_amount).isNotNull() & values.amount(raw_amount).isNull()
