"""Bucketed storage of the billing tables, so that their usual joins need no shuffle."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duesmith import schema
from duesmith.functions.times import moment, window
from duesmith.sources.tables import Tables

# The column that most joins and sums of a table use; other tables stay unbucketed.
BUCKET_KEYS = {
    "tx_invoice": "tx_invoice_id",
    "tx_transaction": "tx_invoice_id",
    "invoice_request": "invoice_request_id",
    "invoice_request_item": "invoice_request_id",
    "payment_request": "invoice_request_id",
    "payment_request_item": "payment_request_id",
    "tx_payment": "tx_payment_id",
    "payment_process_request": "tx_payment_id",
    "payment_process_response": "payment_process_request_id",
    "member_agreement": "member_agreement_id",
    "member_agreement_item": "member_agreement_id",
    "party_role": "party_role_id",
}


def save_bucketed(T: Tables, database: str, root: str, buckets: int, tables=tuple(BUCKET_KEYS), skewed=()) -> None:
    """Store tables as external bucketed tables of ``database`` under ``root``.

    Tables that are joined with each other share one bucket count.  Shuffling by the key into
    as many partitions first gives one file for each bucket.  A table named in ``skewed`` is
    rebalanced instead, which splits a hot key over several tasks and files.
    """
    for name in tables:
        key = BUCKET_KEYS[name]
        dealt = T[name].hint("rebalance", key) if name in skewed else T[name].repartition(buckets, key)
        (
            dealt.write.bucketBy(buckets, key)
            .sortBy(key)
            .option("path", f"{root}/{name}")
            .saveAsTable(f"{database}.{name}")
        )


def save_by_month(df: DataFrame, date: str, path: str) -> None:
    """Store rows in one folder for each month of ``date``, so that a window reads only its months.

    A month is split over several tasks and files where it is large.
    """
    month = F.date_format(date, "yyyy-MM")
    df.withColumn("month", month).hint("rebalance", "month").write.partitionBy("month").parquet(path)


def read_months(spark: SparkSession, path: str, date: str, from_date: datetime | str, to_date: datetime | str) -> DataFrame:
    """Rows of ``save_by_month`` with ``date`` in ``[from_date, to_date)``."""
    first, last = (moment(edge).strftime("%Y-%m") for edge in (from_date, to_date))
    rows = spark.read.parquet(path).where(F.col("month").between(first, last) & window(date, from_date, to_date))
    return rows.drop("month")


def from_catalog(spark: SparkSession, database: str) -> Tables:
    """The bundle over tables of a catalog database."""
    return Tables(lambda name: spark.table(f"{database}.{name}"), schema.TABLES)
