"""Repairs of the defects, each returning the change sets it would write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duesmith.functions.relations import keys_of, live, number_within, one_per_key
from duesmith.functions.text import token_label
from duesmith.operators.changes import ChangeSet
from duesmith.schema import (
    DO_NOT_PROCESS, LINK_INVOICE_REQUEST, LINK_INVOICE_REQUEST_ITEM, LINK_PAYMENT_REQUEST_ITEM, TX_PAYMENT,
)
from duesmith.sources.tables import Tables
from duesmith.sources.workspace import stored

KEYS = {"invoice_request": "invoice_request_id", "payment_request": "payment_request_id"}


def mark_do_not_process(
    T: Tables,
    table: str,
    keys: DataFrame,
    key: str | None = None,
    unpaid_only: bool = False,
    unmarked_only: bool = False,
) -> ChangeSet:
    """Soft-delete the requests that the key list names.

    ``key`` may be a parent's key: payment requests can be named by invoice request.
    """
    row_key = KEYS[table]
    key = key or row_key
    rows = T[table]
    if unpaid_only:
        rows = rows.where(F.col("tx_payment_id").isNull())
    if unmarked_only:
        rows = rows.where(F.col("process_type").isNull())
    rows = rows.join(keys_of(keys, key), key, "left_semi")
    return ChangeSet(table, row_key, rows.select(row_key, F.lit(DO_NOT_PROCESS).alias("process_type")))


def stop_duplicates(T: Tables, ranked: DataFrame, reference_mode: bool = False) -> ChangeSet:
    """Keep the first of each duplicate group and stop the unpaid others.

    ``reference_mode`` stops the first and keeps the others, as the original did.
    """
    place = F.col("position") == 1 if reference_mode else F.col("position") > 1
    doomed = ranked.where(place & F.col("tx_payment_id").isNull())
    return mark_do_not_process(T, "payment_request", doomed, unpaid_only=True)


def stop_bad_installments(T: Tables, problems: DataFrame) -> ChangeSet:
    """Stop every unmarked, unpaid payment request of the problem agreements."""
    requests = T.invoice_request.join(keys_of(problems, "member_agreement_id"), "member_agreement_id", "left_semi")
    return mark_do_not_process(
        T, "payment_request", requests, key="invoice_request_id", unpaid_only=True, unmarked_only=True
    )


def _day(df: DataFrame) -> DataFrame:
    return df.withColumn("_day", F.to_date("bill_date"))


def detach_requests(T: Tables, missing: DataFrame) -> ChangeSet:
    """Stop the live requests of the listed agreements and days and clear their
    invoice links."""
    days = keys_of(_day(missing), "member_agreement_id", "_day")
    rows = _day(T.invoice_request.where(live())).join(days, ["member_agreement_id", "_day"], "left_semi")
    table = T.invoice_request.schema
    return ChangeSet(
        "invoice_request",
        "invoice_request_id",
        rows.select(
            "invoice_request_id",
            F.lit(None).cast(table["tx_invoice_id"].dataType).alias("tx_invoice_id"),
            F.lit(None).cast(table["primary_tx_invoice_id"].dataType).alias("primary_tx_invoice_id"),
            F.lit(DO_NOT_PROCESS).alias("process_type"),
        ),
    )


def request_pairs(T: Tables, missing: DataFrame) -> DataFrame:
    """Stopped requests of the missing list next to the live ones that replaced them.

    On each agreement and day the first stopped request meets the first live one and
    so on; a request without a counterpart is left alone.
    """

    def numbered(rows: DataFrame) -> DataFrame:
        keyed = rows.withColumn("_part", F.struct("member_agreement_id", "_day"))
        return number_within(keyed, key="_part", leading="bill_date", row_id="invoice_request_id", out="_place")

    listed = _day(missing).select("invoice_request_id", "member_agreement_id", "bill_date", "_day", "tx_invoice_id")
    stopped = T.invoice_request.where(F.col("process_type") == DO_NOT_PROCESS).select("invoice_request_id")
    old = numbered(listed.join(stopped, "invoice_request_id", "left_semi")).select(
        "member_agreement_id", "_day", "_place",
        F.col("invoice_request_id").alias("old_request_id"), F.col("tx_invoice_id").alias("old_invoice_id"),
    )
    replacements = (
        _day(T.invoice_request.where(live()))
        .select("invoice_request_id", "member_agreement_id", "bill_date", "_day")
        .join(keys_of(listed, "member_agreement_id", "_day"), ["member_agreement_id", "_day"], "left_semi")
    )
    new = numbered(replacements).select(
        "member_agreement_id", "_day", "_place", F.col("invoice_request_id").alias("new_request_id")
    )
    return old.join(new, ["member_agreement_id", "_day", "_place"]).select(
        "old_request_id", "new_request_id", "old_invoice_id"
    )


@dataclass(frozen=True)
class Relink:
    requests: ChangeSet
    request_items: ChangeSet
    invoices: ChangeSet
    transactions: ChangeSet


def relink(T: Tables, missing: DataFrame, pairs: DataFrame | None = None) -> Relink:
    """Move invoice, item and link references from stopped requests to their replacements."""
    pairs = request_pairs(T, missing) if pairs is None else pairs
    items = T.invoice_request_item.select(
        "invoice_request_item_id", "invoice_request_id", "member_agreement_item_id", "tx_transaction_id"
    )
    old_items = items.select(
        F.col("invoice_request_id").alias("old_request_id"),
        "member_agreement_item_id",
        F.col("invoice_request_item_id").alias("old_item_id"),
        F.col("tx_transaction_id").alias("old_transaction_id"),
    )
    new_items = items.select(
        F.col("invoice_request_id").alias("new_request_id"),
        "member_agreement_item_id",
        F.col("invoice_request_item_id").alias("new_item_id"),
    )
    # Either side is reduced to its smallest item before it meets the other, so a
    # request that lists one agreement item many times is never paired with itself.
    request_pair = pairs.select("old_request_id", "new_request_id")
    old_items = old_items.join(request_pair, "old_request_id")
    new_items = new_items.join(request_pair, "new_request_id")
    same_item = ["old_request_id", "new_request_id", "member_agreement_item_id"]
    by_item = new_items.join(
        old_items.groupBy(*same_item).agg(
            F.min_by("old_transaction_id", "old_item_id").alias("old_transaction_id")
        ),
        same_item,
    )
    by_old_item = old_items.join(
        new_items.groupBy(*same_item).agg(F.min("new_item_id").alias("new_item_id")), same_item
    ).select(F.col("old_item_id").alias("link_id"), "new_item_id")
    invoices = T.tx_invoice.where(F.col("link_type_id") == LINK_INVOICE_REQUEST).select("tx_invoice_id", "link_id")
    transactions = T.tx_transaction.where(F.col("link_type_id") == LINK_INVOICE_REQUEST_ITEM).select(
        "tx_transaction_id", "link_id"
    )
    by_old_request = pairs.select(F.col("old_request_id").alias("link_id"), "new_request_id")
    return Relink(
        ChangeSet(
            "invoice_request",
            "invoice_request_id",
            pairs.select(
                F.col("new_request_id").alias("invoice_request_id"),
                F.col("old_invoice_id").alias("tx_invoice_id"),
                F.col("old_invoice_id").alias("primary_tx_invoice_id"),
            ),
        ),
        ChangeSet(
            "invoice_request_item",
            "invoice_request_item_id",
            by_item.select(
                F.col("new_item_id").alias("invoice_request_item_id"),
                F.col("old_transaction_id").alias("tx_transaction_id"),
            ),
        ),
        ChangeSet(
            "tx_invoice",
            "tx_invoice_id",
            invoices.join(by_old_request, "link_id").select("tx_invoice_id", F.col("new_request_id").alias("link_id")),
        ),
        ChangeSet(
            "tx_transaction",
            "tx_transaction_id",
            transactions.join(by_old_item, "link_id").select(
                "tx_transaction_id", F.col("new_item_id").alias("link_id")
            ),
        ),
    )


@dataclass(frozen=True)
class CreatedTransactions:
    inserts: DataFrame
    items: ChangeSet
    statuses: ChangeSet


def create_missing_tx(T: Tables, missing: DataFrame, style: str = "card") -> CreatedTransactions:
    """The payment transactions that dangling payment-request items point to.

    ``missing`` names one gateway request and sale for each item.  Each item gets one
    transaction.  New ids start above the largest id and keep the
    distance between item ids, so no task has to number all rows.  ``style`` chooses
    the description: "card" names the tender and last digits, "plain" only the date.

    The list and the new transactions are stored: the invoices' lines are then counted in a stage of
    their own, which does not hold the tables that the list comes from, and both change sets start
    from what was found.
    """
    missing = stored(missing, "missing-transactions")
    lines = T.tx_transaction.join(keys_of(missing, "tx_invoice_id"), "tx_invoice_id", "left_semi")
    counts = lines.groupBy("tx_invoice_id").agg(F.count("*").alias("lines"))
    top = T.tx_transaction.agg(F.max("tx_transaction_id").alias("top")).scalar()
    payment = F.concat(F.lit("ID: "), F.col("tx_payment_id").cast("string"))
    if style == "card":
        description = F.concat(
            payment, F.lit(" | "), token_label(F.col("token")), F.lit(" | Payment request due:"),
            F.date_format("target_date", "MM/dd/yyyy"),
        )
    else:
        description = F.concat(
            payment, F.lit("| Payment request due: "), F.date_format("target_date", "yyyy-MM-dd")
        )
    values = {
        "tx_transaction_id": top + 1 + F.col("payment_request_item_id"),
        "tx_invoice_id": F.col("tx_invoice_id"),
        "tx_type_id": F.lit(TX_PAYMENT),
        "group_id": F.col("group_id"),
        "item_id": F.col("tx_payment_id"),
        "amount": F.col("payment_amount"),
        "is_accounting_credit": F.lit(True),
        "link_type_id": F.lit(LINK_PAYMENT_REQUEST_ITEM),
        "link_id": F.col("payment_request_item_id"),
        "description": description,
        "display_order": F.col("lines") + 1,
        "target_date": F.col("target_date"),
        "target_date_utc": F.col("target_date_utc"),
        "target_business_unit_id": F.col("target_business_unit_id"),
        "target_date_zone_format": F.col("target_date_zone_format"),
        "quantity": F.lit(None),
        "unit_price": F.lit(None),
        "comments": F.lit(""),
        "work_unit_id": F.lit(0),
        "price_id": F.lit(0),
    }
    target = T.tx_transaction.schema
    inserts = missing.join(counts, "tx_invoice_id").select(
        *[values[field.name].cast(field.dataType).alias(field.name) for field in target]
    )
    inserts = stored(inserts, "created-transactions")
    items = inserts.select(F.col("link_id").alias("payment_request_item_id"), "tx_transaction_id")
    roles = T.tx_invoice.join(keys_of(inserts, "tx_invoice_id"), "tx_invoice_id", "left_semi")
    statuses = (
        T.party_role_status.select("party_role_id")
        .join(keys_of(roles, "party_role_id"), "party_role_id", "left_semi")
        .select("party_role_id", F.lit(1).alias("account_status"))
    )
    return CreatedTransactions(
        inserts,
        ChangeSet("payment_request_item", "payment_request_item_id", items),
        ChangeSet("party_role_status", "party_role_id", statuses),
    )


def repoint_requests(mispointed: DataFrame) -> ChangeSet:
    """Point each request to the invoice its payment was booked on."""
    rows = one_per_key(mispointed, "invoice_request_id", "paying_invoice_id")
    return ChangeSet(
        "invoice_request", "invoice_request_id", rows.withColumnRenamed("paying_invoice_id", "tx_invoice_id")
    )


def repoint_items(mispointed: DataFrame) -> ChangeSet:
    """Point each request item to the sale transaction of its invoice."""
    rows = one_per_key(mispointed, "invoice_request_item_id", "sale_transaction_id")
    return ChangeSet(
        "invoice_request_item",
        "invoice_request_item_id",
        rows.withColumnRenamed("sale_transaction_id", "tx_transaction_id"),
    )
