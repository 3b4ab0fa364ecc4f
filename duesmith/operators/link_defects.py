"""Defects in the links between requests, invoices, transactions and payments."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duesmith.functions.money import money
from duesmith.functions.relations import keys_of, not_in
from duesmith.functions.times import in_window
from duesmith.operators.ledger import invoice_balance, lines_of
from duesmith.schema import LINK_INVOICE_REQUEST, LINK_SPONSOR, TX_PAYMENT, TX_SALE
from duesmith.sources.tables import Tables
from duesmith.sources.workspace import stored


def missing_payment_tx(T: Tables, reference_mode: bool = False) -> DataFrame:
    """Payment-request items whose transaction does not exist, with the payment, its
    gateway request and the sale transaction of the invoice.

    An item without any transaction id is not missing one.  Each item shows the
    earliest gateway request and sale and how many there are; both are reduced before
    the join.  ``reference_mode`` lists every item with every request and sale.
    """
    dangling = not_in(
        T.payment_request_item.select("payment_request_item_id", "payment_request_id", "tx_transaction_id"),
        "tx_transaction_id",
        T.tx_transaction,
    )
    requests = T.payment_request.where(F.col("tx_payment_id").isNotNull()).select(
        "payment_request_id", "invoice_request_id", "tx_payment_id"
    )
    invoices = T.invoice_request.where(F.col("tx_invoice_id").isNotNull()).select(
        "invoice_request_id", "tx_invoice_id"
    )
    # Stored, because its payments and invoices choose the gateway requests and sales that are summed.
    dangling = stored(
        dangling.join(requests, "payment_request_id").join(invoices, "invoice_request_id"), "dangling-items"
    )
    gateway = T.payment_process_request.select("tx_payment_id", "payment_process_request_id", "token")
    payments = T.tx_payment.select(
        "tx_payment_id", "target_date", "target_date_utc", "target_date_zone_format",
        F.col("amount").alias("payment_amount"), "target_business_unit_id",
    )
    sales = T.tx_transaction.where(F.col("tx_type_id") == TX_SALE).select(
        F.col("tx_transaction_id").alias("sale_transaction_id"), "tx_invoice_id", "group_id"
    )
    gateway = gateway.join(keys_of(dangling, "tx_payment_id"), "tx_payment_id", "left_semi")
    sales = sales.join(keys_of(dangling, "tx_invoice_id"), "tx_invoice_id", "left_semi")
    if not reference_mode:
        gateway = gateway.groupBy("tx_payment_id").agg(
            F.min("payment_process_request_id").alias("payment_process_request_id"),
            F.min_by("token", "payment_process_request_id").alias("token"),
            F.count("*").alias("gateway_requests"),
        )
        sales = sales.groupBy("tx_invoice_id").agg(
            F.min("sale_transaction_id").alias("sale_transaction_id"),
            F.min_by("group_id", "sale_transaction_id").alias("group_id"),
            F.count("*").alias("sales"),
        )
    return (
        dangling.join(payments, "tx_payment_id")
        .join(gateway, "tx_payment_id")
        .join(sales, "tx_invoice_id")
    )


def multi_linked(T: Tables, from_date: datetime | str, to_date: datetime | str) -> DataFrame:
    """Invoice requests that several invoices of ``[from, to]`` link to."""
    linked = (
        in_window(T.dated("tx_invoice"), "target_date", from_date, to_date, closed=True)
        .where(F.col("link_type_id") == LINK_INVOICE_REQUEST)
        .groupBy(F.col("link_id").alias("invoice_request_id"))
        .agg(F.count("*").alias("invoice_count"))
        .where(F.col("invoice_count") > 1)
    )
    agreements = T.member_agreement.select("member_agreement_id", "party_role_id")
    return (
        linked.join(T.invoice_request.select("invoice_request_id", "member_agreement_id"), "invoice_request_id")
        .join(agreements, "member_agreement_id")
        .join(T.party_role.select("party_role_id", "role_id"), "party_role_id")
        .select("role_id", "invoice_request_id", "member_agreement_id", "invoice_count")
    )


def linked_invoices(T: Tables, multi: DataFrame) -> DataFrame:
    """Invoices of any date that link to the suspect requests."""
    return (
        T.tx_invoice.where(F.col("link_type_id") == LINK_INVOICE_REQUEST)
        .select("tx_invoice_id", F.col("link_id").alias("invoice_request_id"))
        .join(keys_of(multi, "invoice_request_id"), "invoice_request_id", "left_semi")
        .select("tx_invoice_id")
    )


def sponsor_tx(T: Tables, multi: DataFrame) -> DataFrame:
    """Sponsor payments booked on the linked invoices."""
    return T.tx_transaction.where(
        (F.col("tx_type_id") == TX_PAYMENT) & (F.col("link_type_id") == LINK_SPONSOR)
    ).join(linked_invoices(T, multi), "tx_invoice_id", "left_semi")


def _unsponsored(T: Tables, multi: DataFrame) -> DataFrame:
    return linked_invoices(T, multi).join(
        sponsor_tx(T, multi).select("tx_invoice_id"), "tx_invoice_id", "left_anti"
    )


def mispointed_requests(T: Tables, multi: DataFrame) -> DataFrame:
    """Requests on a suspect invoice whose payment item points to a transaction that
    is not a sponsor's, with the invoice of that transaction."""
    requests = T.invoice_request.select(
        "invoice_request_id", "member_agreement_id", "tx_invoice_id"
    ).join(_unsponsored(T, multi), "tx_invoice_id", "left_semi")
    payments = T.payment_request.select("payment_request_id", "invoice_request_id")
    items = T.payment_request_item.where(F.col("tx_transaction_id").isNotNull()).select(
        "payment_request_id", "tx_transaction_id"
    )
    # A transaction without a link type fails "<> sponsor", as in SQL.
    paying = T.tx_transaction.where(F.col("link_type_id") != LINK_SPONSOR).select(
        "tx_transaction_id", F.col("tx_invoice_id").alias("paying_invoice_id")
    )
    return (
        requests.join(payments, "invoice_request_id")
        .join(items, "payment_request_id")
        .join(paying, "tx_transaction_id")
        .select("invoice_request_id", "member_agreement_id", "tx_invoice_id", "tx_transaction_id", "paying_invoice_id")
    )


def mispointed_items(T: Tables, multi: DataFrame) -> DataFrame:
    """Request items whose transaction differs from a sale transaction of the suspect
    invoice their request points to.

    One row for each item, with the smallest differing sale transaction and how many
    differ.  The two smallest sales of an invoice answer that for all its items, so
    items and sales are never paired.
    """
    suspects = keys_of(_unsponsored(T, multi), "tx_invoice_id")
    requests = T.invoice_request.select("invoice_request_id", "tx_invoice_id").join(
        suspects, "tx_invoice_id", "left_semi"
    )
    items = T.invoice_request_item.where(F.col("tx_transaction_id").isNotNull()).select(
        "invoice_request_item_id", "invoice_request_id", "tx_transaction_id"
    )
    sales = (
        T.tx_transaction.where(F.col("tx_type_id") == TX_SALE)
        .select("tx_transaction_id", "tx_invoice_id")
        .join(suspects, "tx_invoice_id", "left_semi")
    )
    smallest = sales.groupBy("tx_invoice_id").agg(
        F.min("tx_transaction_id").alias("first_sale"), F.count("*").alias("sales")
    )
    second = (
        sales.join(smallest, "tx_invoice_id")
        .where(F.col("tx_transaction_id") > F.col("first_sale"))
        .groupBy("tx_invoice_id")
        .agg(F.min("tx_transaction_id").alias("second_sale"))
    )
    is_sale = F.col("own_sale").isNotNull()
    return (
        items.join(requests, "invoice_request_id")
        .join(smallest, "tx_invoice_id")
        .join(second, "tx_invoice_id", "left")
        .join(sales.withColumn("own_sale", F.lit(True)), ["tx_invoice_id", "tx_transaction_id"], "left")
        .select(
            "invoice_request_item_id",
            "invoice_request_id",
            "tx_invoice_id",
            "tx_transaction_id",
            F.when(F.col("first_sale") != F.col("tx_transaction_id"), F.col("first_sale"))
            .otherwise(F.col("second_sale"))
            .alias("sale_transaction_id"),
            (F.col("sales") - is_sale.cast("int")).alias("differing_sales"),
        )
        .where(F.col("differing_sales") > 0)
    )


def removable_invoices(T: Tables, multi: DataFrame) -> DataFrame:
    """Linked suspect invoices without a sponsor payment that no request points back to."""
    return keys_of(
        _unsponsored(T, multi).join(
            T.invoice_request.select("tx_invoice_id").dropna(), "tx_invoice_id", "left_anti"
        ),
        "tx_invoice_id",
    )


def multi_invoice_exposure(T: Tables, min_balance: Decimal | str | None = None) -> DataFrame:
    """Invoices touched by a payment that covers several invoices, with member, payment
    amount, balance and the request they link to."""
    payments = T.tx_payment.where("is_multi_invoice").select(
        F.col("tx_payment_id").alias("item_id"), F.col("amount").alias("payment_amount")
    )
    touched = (
        T.tx_transaction.where(F.col("tx_type_id") == TX_PAYMENT)
        .select("item_id", "tx_invoice_id")
        .join(payments, "item_id")
        .select("tx_invoice_id", "payment_amount")
        .distinct()
    )
    invoices = T.tx_invoice.select(
        "tx_invoice_id", "party_role_id",
        F.when(F.col("link_type_id") == LINK_INVOICE_REQUEST, F.col("link_id")).alias("invoice_request_id"),
    )
    exposed = (
        touched.join(invoices, "tx_invoice_id")
        .join(invoice_balance(lines_of(T.tx_transaction, touched)), "tx_invoice_id", "left")
        .join(T.party_role.select("party_role_id", "role_id", "created_date"), "party_role_id")
        .select(
            "tx_invoice_id", "party_role_id", "role_id", "created_date", "payment_amount", "balance",
            "invoice_request_id",
        )
    )
    return exposed if min_balance is None else exposed.where(F.col("balance") >= money(F.lit(str(min_balance))))


def exposed_requests(T: Tables, exposure: DataFrame) -> DataFrame:
    """Process marks of the invoice requests behind the exposed invoices."""
    return T.invoice_request.select("invoice_request_id", "process_type").join(
        keys_of(exposure, "invoice_request_id"), "invoice_request_id", "left_semi"
    )


def exposed_payment_requests(T: Tables, exposure: DataFrame) -> DataFrame:
    """Unmarked payment requests behind the exposed invoices."""
    requests = exposed_requests(T, exposure).select("invoice_request_id")
    return (
        T.payment_request.where(F.col("process_type").isNull())
        .select("payment_request_id", "invoice_request_id", "process_type")
        .join(requests, "invoice_request_id", "left_semi")
    )
