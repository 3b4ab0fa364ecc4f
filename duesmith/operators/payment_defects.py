"""Defects in payments: over-payment, cash over-credit, repeated declines, rebills."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duesmith.functions.money import money, sum_where
from duesmith.functions.relations import keys_of
from duesmith.functions.text import like
from duesmith.functions.times import from_on, moment, ts
from duesmith.operators.ledger import lines_of
from duesmith.schema import ACTIVE, ROLE_MEMBER, TX_PAYMENT
from duesmith.sources.tables import Tables
from duesmith.sources.workspace import stored


def overpaid_invoices(T: Tables) -> DataFrame:
    """Invoices with both an unlinked credit payment and a linked payment, where the
    charges stay below the credits.

    One aggregate over the ledger answers all four questions about an invoice.
    """
    credit, payment = F.col("is_accounting_credit"), F.col("tx_type_id") == TX_PAYMENT
    linked = F.col("link_type_id").isNotNull()
    return (
        T.tx_transaction.groupBy("tx_invoice_id")
        .agg(
            F.max(payment & ~linked & credit).alias("has_unlinked"),
            F.max(payment & linked).alias("has_linked"),
            sum_where(~credit).alias("due_amount"),
            sum_where(credit).alias("paid_amount"),
        )
        .where("has_unlinked AND has_linked AND due_amount < paid_amount")
        .select("tx_invoice_id", money("due_amount").alias("due_amount"), money("paid_amount").alias("paid_amount"))
    )


def overpaid(T: Tables, include_orgs: bool = False, ordered: bool = False) -> DataFrame:
    """Over-paid invoices with the primary party's member name and the unit.

    With ``include_orgs``, accounts held by organisations stay and the organisation's
    name stands in for the first name.  ``ordered`` sorts by invoice date and id.
    """
    holders = T.client_account_party.where("primary_party").select("client_account_id", "party_id")
    invoices = T.tx_invoice.select(
        "tx_invoice_id", "client_account_id", "target_date",
        F.col("target_business_unit_id").alias("business_unit_id"),
    )
    found = (
        overpaid_invoices(T)
        .select("tx_invoice_id")
        .join(invoices, "tx_invoice_id")
        .join(T.client_account.select("client_account_id"), "client_account_id", "left_semi")
        .join(holders, "client_account_id")
        .join(T.business_unit.select("business_unit_id", F.col("name").alias("unit_name")), "business_unit_id")
    )
    members = T.member_list.select("party_id", F.col("party_role_id").alias("m_role_id"), "first_name", "last_name")
    if include_orgs:
        organizations = T.organization_list.select("party_id", "organization_name")
        named = (
            found.join(members, "party_id", "left")
            .join(organizations, "party_id", "left")
            .join(T.party_role.select("party_id", "role_id"), "party_id", "left")
            .withColumn("first_name", F.coalesce("first_name", "organization_name"))
        )
    else:
        roles = T.party_role.select(F.col("party_role_id").alias("m_role_id"), "role_id")
        named = found.join(members, "party_id").join(roles, "m_role_id")
    rows = named.select("role_id", "first_name", "last_name", "tx_invoice_id", "target_date", "unit_name")
    return rows.orderBy("target_date", "tx_invoice_id") if ordered else rows


def overpaid_by_account(T: Tables) -> DataFrame:
    """Number of over-paid invoices of each client account."""
    return (
        T.tx_invoice.select("tx_invoice_id", "client_account_id")
        .join(overpaid_invoices(T).select("tx_invoice_id"), "tx_invoice_id")
        .join(T.client_account.select("client_account_id"), "client_account_id", "left_semi")
        .groupBy("client_account_id")
        .agg(F.count("*").alias("invoices"))
    )


def cash_overcredited(T: Tables, interfaces: Sequence[int]) -> DataFrame:
    """Invoices paid through cash-type tenders on a linked payment whose net is a credit."""
    cash = T.tender_type.where(F.col("tender_interface_id").isin(*interfaces)).select("tender_type_id")
    payments = T.tx_payment.select(F.col("tx_payment_id").alias("item_id"), "tender_type_id").join(
        cash, "tender_type_id", "left_semi"
    )
    paid_in_cash = (
        T.tx_transaction.where((F.col("tx_type_id") == TX_PAYMENT) & F.col("link_type_id").isNotNull())
        .select("item_id", "tx_invoice_id")
        .join(payments, "item_id", "left_semi")
    )
    net = F.col("amount") * (F.col("is_accounting_credit").cast("int") * 2 - 1)
    credited = (
        lines_of(T.tx_transaction, paid_in_cash)
        .groupBy("tx_invoice_id")
        .agg(money(F.sum(net)).alias("amt"))
        .where(F.col("amt") > 0)
    )
    return (
        credited.join(T.tx_invoice.select("tx_invoice_id", "party_role_id"), "tx_invoice_id")
        .join(T.party_role.select("party_role_id", "role_id"), "party_role_id")
        .select("role_id", "tx_invoice_id", "amt")
    )


def repeat_declines(
    T: Tables,
    aging: DataFrame | Callable[[DataFrame], DataFrame],
    card_like: str = "%VISA%",
    sponsor_like: str = "%Sponsor%",
    min_past_due: Decimal | str = "1",
    status: int = ACTIVE,
    ignore_case: bool = False,
) -> DataFrame:
    """Declines of members who were declined repeatedly on a card and are past due.

    A funnel: invoices with a decline row for the card; party roles with more than
    one decline row on such invoices; their unsponsored declines under an active
    agreement; members with more than one of those; members past due.  ``aging`` is a snapshot, or
    what gives the aging rows of the few roles (``party_role_id``) that are left by then.
    """
    declines = T.tx_transaction.where(
        (F.col("tx_type_id") == TX_PAYMENT) & ~F.col("is_accounting_credit")
    ).select("tx_transaction_id", "tx_invoice_id", "description", "link_type_id")
    first = keys_of(declines.where(like("description", card_like, ignore_case)), "tx_invoice_id")
    invoices = T.tx_invoice.select("tx_invoice_id", "party_role_id", "billing_status", "tx_invoice_status_id")
    # Few rows, and read by every later step.
    on_card = stored(declines.join(first, "tx_invoice_id", "left_semi").join(invoices, "tx_invoice_id"), "declines")
    repeated = on_card.groupBy("party_role_id").agg(F.count("*").alias("n")).where(F.col("n") > 1)

    repeated = stored(repeated.select("party_role_id"), "declined-roles")
    agreements = (
        T.member_agreement.where(F.col("status") == status)
        .join(repeated, "party_role_id", "left_semi")
        .groupBy("party_role_id")
        .agg(F.count("*").alias("agreements"))
    )
    third = (
        on_card.where(~like("description", sponsor_like, ignore_case))
        .join(repeated, "party_role_id", "left_semi")
        .join(T.party_role.select("party_role_id", "role_id"), "party_role_id")
        .join(agreements, "party_role_id")
    )
    third = stored(third, "declines")
    # Each decline counts once for every active agreement, as the original join repeats it.
    fourth = third.groupBy("role_id").agg(F.sum("agreements").alias("n")).where(F.col("n") > 1)
    left = T.party_role.where(F.col("party_role_type_id") == ROLE_MEMBER).join(
        fourth.select("role_id"), "role_id", "left_semi"
    )
    left = stored(left.select("party_role_id", "role_id"), "declined-members")
    rows = aging(left) if callable(aging) else aging
    past_due = keys_of(rows.where(F.col("total_past_due") > money(F.lit(str(min_past_due)))), "party_role_id")
    members = keys_of(left.join(past_due, "party_role_id", "left_semi"), "role_id")
    return (
        third.join(members, "role_id", "left_semi")
        .select("role_id", "tx_invoice_id", "billing_status", "tx_invoice_status_id", "description", "link_type_id")
        .distinct()
    )


def rebill_candidates(
    T: Tables,
    unit: int | Sequence[int],
    billing_date: datetime | str,
    min_days: int = 7,
    max_days: int = 60,
) -> DataFrame:
    """Declined payments not rebilled yet whose decline reason allows another attempt,
    dated at least ``max_days`` back at most and more than ``min_days`` back."""
    billing_date = moment(billing_date)
    units = [unit] if isinstance(unit, int) else list(unit)
    oldest, newest = billing_date - timedelta(days=max_days), billing_date - timedelta(days=min_days)
    responses = T.payment_process_response.where(F.col("rebill_payment_process_request_id").isNull()).select(
        "payment_process_request_id", "reference_id", "rebill_payment_process_request_id"
    )
    requests = T.payment_process_request.select(
        "payment_process_request_id", "payment_process_batch_id", "tx_payment_id"
    )
    batches = T.payment_process_batch.where(F.col("business_unit_id").isin(*units)).select("payment_process_batch_id")
    # The dates stand on the literal side, so both bounds can reach the scan.
    payments = from_on(T.dated("tx_payment"), "target_date_utc", oldest).where(
        F.col("is_declined") & (F.col("target_date") < ts(newest))
    ).select(
        "tx_payment_id", "client_account_id", "party_role_id", "target_date", "target_date_utc",
        "target_date_zone_format", "tender_type_id", "link_type_id", "link_id",
        F.col("decline_reason_id").alias("reason_id"),
    )
    reasons = T.decline_reason.select(
        F.col("decline_reason_id").alias("reason_id"), "do_not_reprocess",
        F.col("decline_reason_id").alias("decline_reason_id"),
    )
    return (
        requests.join(payments, "tx_payment_id")
        .join(batches, "payment_process_batch_id", "left_semi")
        .join(responses, "payment_process_request_id")
        .join(reasons, "reason_id", "left")
        .where(F.col("do_not_reprocess").isNull() | ~F.col("do_not_reprocess"))
        .select(
            "payment_process_request_id", "payment_process_batch_id", "tx_payment_id", "client_account_id",
            "party_role_id", "target_date", "target_date_utc", "target_date_zone_format", "tender_type_id",
            "link_type_id", "link_id", "decline_reason_id", "reference_id", "rebill_payment_process_request_id",
        )
    )
