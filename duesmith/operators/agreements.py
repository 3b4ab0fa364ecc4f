"""Drill-downs from agreements to their schedule, items and activities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duesmith.functions.relations import keys_of, live
from duesmith.schema import BILLED
from duesmith.sources.tables import Tables

PARTS = (
    "agreement", "items", "invoice_requests", "invoice_request_items", "payment_requests",
    "payment_request_items",
)


def billing_details(T: Tables, agreements: DataFrame, parts: Sequence[str] = PARTS) -> dict[str, DataFrame]:
    """The chosen parts of the agreements' live billing schedule."""
    keys = keys_of(agreements, "member_agreement_id")
    requests = T.invoice_request.where(live()).join(keys, "member_agreement_id", "left_semi")
    request_keys = requests.select("invoice_request_id", "member_agreement_id")
    payments = T.payment_request.join(request_keys, "invoice_request_id")
    payment_keys = payments.select("payment_request_id", "member_agreement_id")
    every = {
        "agreement": lambda: T.member_agreement.join(keys, "member_agreement_id", "left_semi"),
        "items": lambda: T.member_agreement_item.join(keys, "member_agreement_id", "left_semi"),
        "invoice_requests": lambda: requests,
        "invoice_request_items": lambda: T.invoice_request_item.join(request_keys, "invoice_request_id"),
        "payment_requests": lambda: payments,
        "payment_request_items": lambda: T.payment_request_item.join(payment_keys, "payment_request_id"),
    }
    return {part: every[part]() for part in parts}


def agreement_items(T: Tables, agreements: DataFrame) -> DataFrame:
    """Items of the agreements with their perpetual price rows, where they have any."""
    items = T.member_agreement_item.join(keys_of(agreements, "member_agreement_id"), "member_agreement_id", "left_semi")
    return items.join(T.member_agreement_item_perpetual, "member_agreement_item_id", "left")


def counted_perpetual_agreements(T: Tables, status: int) -> DataFrame:
    """Agreements in a status whose perpetual price row has a bill count."""
    return (
        T.member_agreement_item_perpetual.where(F.col("bill_count").isNotNull())
        .join(T.member_agreement_item, "member_agreement_item_id")
        .join(T.member_agreement.where(F.col("status") == status), "member_agreement_id")
        .join(T.party_role.select("party_role_id", "role_id"), "party_role_id")
        .select("member_agreement_id", "bill_count", "status", "role_id")
    )


def billed_requests(T: Tables, agreements: DataFrame) -> DataFrame:
    """Invoice requests of the agreements that were billed to an invoice."""
    return T.invoice_request.where((F.col("status") == BILLED) & F.col("tx_invoice_id").isNotNull()).join(
        keys_of(agreements, "member_agreement_id"), "member_agreement_id", "left_semi"
    )


def agreement_activities(T: Tables, agreements: DataFrame) -> DataFrame:
    """Activities bought through the billed requests of the agreements.

    An activity appears once for each agreement that reaches it, next to that
    agreement's start date.
    """
    invoices = keys_of(billed_requests(T, agreements), "member_agreement_id", "tx_invoice_id")
    tx = T.tx_transaction.select("tx_transaction_id", "tx_invoice_id")
    return (
        T.activity.join(tx, "tx_transaction_id")
        .join(invoices, "tx_invoice_id")
        .join(T.member_agreement.select("member_agreement_id", "start_date"), "member_agreement_id")
        .select("member_agreement_id", "start_date", "activity_id", "tx_transaction_id", "item_id", "start_time_utc")
    )
