"""Guarded removal of invoices: guard, plan, before-images, and the result."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duesmith.functions.relations import keys_of
from duesmith.operators.cascade import key_of
from duesmith.operators.changes import ChangeSet, apply_all
from duesmith.schema import TX_PAYMENT, TX_SALE
from duesmith.sources.tables import Tables
from duesmith.sources.workspace import stored

# Table, what happens to its rows, and the column a clearing step empties; in order.
ACTIONS = (
    ("payment_request_item", "clear", "tx_transaction_id"),
    ("payment_request", "clear", "tx_payment_id"),
    ("invoice_request_item", "clear", "tx_transaction_id"),
    ("invoice_request", "clear", "tx_invoice_id"),
    ("activity_transaction", "delete", None),
    ("activity", "delete", None),
    ("payment_process_request", "delete", None),
    ("tx_payment", "delete", None),
    ("member_rental", "delete", None),
    ("tx_transaction", "delete", None),
    ("tx_invoice", "delete", None),
)


class _Targets:
    """Invoices to remove with their ledger lines and payments, stored once for all branches."""

    def __init__(self, T: Tables, targets: DataFrame, lines: DataFrame, payments: DataFrame):
        self.T, self.invoices, self.lines, self.payments = T, targets, lines, payments

    @classmethod
    def of(cls, T: Tables, invoices: DataFrame) -> _Targets:
        targets = stored(keys_of(invoices, "tx_invoice_id"), "removal-targets")
        lines = stored(
            T.tx_transaction.select("tx_transaction_id", "tx_invoice_id", "tx_type_id", "item_id").join(
                targets, "tx_invoice_id", "left_semi"
            ),
            "removal-lines",
        )
        payments = (
            lines.where(F.col("tx_type_id") == TX_PAYMENT)
            .select(F.col("item_id").alias("tx_payment_id"), "tx_invoice_id")
            .distinct()
            .join(T.tx_payment.select("tx_payment_id"), "tx_payment_id", "left_semi")
        )
        return cls(T, targets, lines, stored(payments, "removal-payments"))

    def without(self, invoices: DataFrame) -> _Targets:
        """The same less some invoices."""
        parts = (self.invoices, self.lines, self.payments)
        return _Targets(self.T, *[part.join(invoices, "tx_invoice_id", "left_anti") for part in parts])

    def sales(self) -> DataFrame:
        return self.lines.where(F.col("tx_type_id") == TX_SALE)

    def keys(self, table: str) -> DataFrame:
        """Keys of the rows of ``table`` that depend on the invoices."""
        column, parents = {
            "payment_request_item": ("tx_transaction_id", self.lines),
            "payment_request": ("tx_payment_id", self.payments),
            "invoice_request_item": ("tx_transaction_id", self.lines),
            "invoice_request": ("tx_invoice_id", self.invoices),
            "activity": ("tx_transaction_id", self.sales()),
            "payment_process_request": ("tx_payment_id", self.payments),
            "tx_payment": ("tx_payment_id", self.payments),
            "member_rental": ("tx_transaction_id", self.lines),
            "tx_transaction": ("tx_transaction_id", self.lines),
            "tx_invoice": ("tx_invoice_id", self.invoices),
        }.get(table) or ("activity_id", self.keys("activity").withColumnRenamed("row_key", "activity_id"))
        named = keys_of(parents, column)
        if table == "tx_transaction":  # the lines are rows of the table already
            return named.select(F.col(column).alias("row_key"))
        return self.T[table].join(named, column, "left_semi").select(F.col(key_of(table)).alias("row_key"))

    def blocked(self) -> DataFrame:
        """Invoices that a request or payment request refers to, and from where.

        Referring rows are reduced to what they name before they meet the invoices, so a payment
        over many invoices and with many requests makes one row for each invoice.
        """
        parts = []
        for table, column, parents in (
            ("payment_request_item", "tx_transaction_id", self.lines),
            ("payment_request", "tx_payment_id", self.payments),
            ("invoice_request_item", "tx_transaction_id", self.lines),
            ("invoice_request", "tx_invoice_id", self.invoices),
        ):
            # Only what refers to a target is sorted out by key, not all that refers to anything.
            named = keys_of(self.T[table].join(keys_of(parents, column), column, "left_semi"), column)
            hit = keys_of(parents.join(named, column, "left_semi"), "tx_invoice_id")
            parts.append(hit.select("tx_invoice_id", F.lit(table).alias("referrer")))
        return reduce(DataFrame.unionByName, parts)


def blocked_invoices(T: Tables, invoices: DataFrame) -> DataFrame:
    """Invoices that a request or payment request still refers to, and from where."""
    return _Targets.of(T, invoices).blocked()


def removal_plan(T: Tables, invoices: DataFrame, protect: bool = True) -> DataFrame:
    """(step, table, key, action) of every row that removing the invoices changes.

    With ``protect`` blocked invoices are left out whole, so nothing has to be
    cleared; without it references are cleared.  The plan is the dry run: nothing
    is written until it is applied.
    """
    targets = _Targets.of(T, invoices)
    if protect:
        targets = targets.without(stored(keys_of(targets.blocked(), "tx_invoice_id"), "blocked-invoices"))
    parts = [
        targets.keys(table).select(
            F.lit(n).alias("step"), F.lit(table).alias("table_name"), "row_key", F.lit(action).alias("action")
        )
        for n, (table, action, _) in enumerate(ACTIONS, start=1)
        if not (protect and action == "clear")
    ]
    return reduce(DataFrame.unionByName, parts)


def _planned(plan: DataFrame, table: str) -> DataFrame:
    return plan.where(F.col("table_name") == table).select(F.col("row_key").alias(key_of(table)))


def run_label(started: datetime) -> str:
    """Folder name of a removal run, from its start to the second."""
    return f"invoice_removal_{started:%Y_%m_%d_%H_%M_%S}"


def run_label_of(started: Column) -> Column:
    """The same for a column of starts."""
    return F.date_format(started, "'invoice_removal_'yyyy_MM_dd_HH_mm_ss")


def before_images(
    T: Tables, plan: DataFrame, run_folder: str, tables: Sequence[str] = tuple(table for table, _, _ in ACTIONS)
) -> dict[str, DataFrame]:
    """Copy every row the plan touches to ``run_folder/<table>`` and read it back.

    Store the plan by ``table_name``, so that each table reads its own keys only.

    A folder that exists already stops the run, so no image is ever overwritten.
    """
    images = {}
    for table in tables:
        path = f"{run_folder}/{table}"
        rows = T[table].join(_planned(plan, table), key_of(table), "left_semi").select(*T[table].columns)
        rows.write.mode("errorifexists").parquet(path)
        images[table] = plan.sparkSession.read.schema(rows.schema).parquet(path)
    return images


def apply_removal(T: Tables, plan: DataFrame) -> Tables:
    """The bundle after clearing references and deleting rows."""
    cleared, survivors = [], {}
    for table, action, column in ACTIONS:
        keys = _planned(plan, table)
        if action == "clear":
            nothing = F.lit(None).cast(T[table].schema[column].dataType).alias(column)
            cleared.append(ChangeSet(table, key_of(table), keys.select(key_of(table), nothing)))
        else:
            survivors[table] = T[table].join(keys, key_of(table), "left_anti")
    return apply_all(T, *cleared).replace(**survivors)
