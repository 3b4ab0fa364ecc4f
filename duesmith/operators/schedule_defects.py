"""Defects in the billing schedule: double bills, duplicates, orphans, missing requests."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duesmith.functions.relations import keys_of, live, number_within
from duesmith.functions.times import in_window, ts
from duesmith.schema import ACTIVE, ENTITY_AGREEMENT
from duesmith.sources.tables import Tables
from duesmith.sources.workspace import stored


def double_billed(T: Tables, from_date: datetime | str, to_date: datetime | str) -> DataFrame:
    """Member, agreement, bill date and item billed more than once in ``[from, to)``."""
    requests = in_window(T.dated("invoice_request"), "bill_date", from_date, to_date).where(live()).select(
        "invoice_request_id", "member_agreement_id", "bill_date"
    )
    # Counting by agreement first leaves one row for each group to meet the member tables.
    repeated = (
        T.invoice_request_item.select("invoice_request_id", "member_agreement_item_id")
        .join(requests, "invoice_request_id")
        .groupBy("member_agreement_id", "bill_date", "member_agreement_item_id")
        .agg(F.count("*").alias("times_billed"))
        .where(F.col("times_billed") > 1)
    )
    agreement = T.member_agreement.select(
        "member_agreement_id", "party_role_id", "business_unit_id", "start_date"
    )
    return (
        repeated.join(agreement, "member_agreement_id")
        .join(T.party_role.select("party_role_id", "role_id"), "party_role_id")
        .select(
            "role_id", "member_agreement_id", "business_unit_id", "start_date", "bill_date",
            "member_agreement_item_id", "times_billed",
        )
    )


def surplus_requests(
    T: Tables, doubled: DataFrame, from_date: datetime | str, to_date: datetime | str
) -> DataFrame:
    """Live requests of the doubled agreements not invoiced yet, numbered by bill date
    and id; the second and later ones are surplus."""
    open_requests = (
        in_window(T.dated("invoice_request"), "bill_date", from_date, to_date)
        .where(live() & F.col("tx_invoice_id").isNull())
        .select("member_agreement_id", "invoice_request_id", "bill_date")
    )
    candidates = open_requests.join(keys_of(doubled, "member_agreement_id"), "member_agreement_id", "left_semi")
    return number_within(
        candidates, key="member_agreement_id", leading="bill_date", row_id="invoice_request_id", out="row"
    ).where(F.col("row") > 1)


def unpaid_payment_requests(T: Tables, requests: DataFrame) -> DataFrame:
    """Payment requests of the given invoice requests that no payment has settled."""
    return T.payment_request.where(F.col("tx_payment_id").isNull()).join(
        keys_of(requests, "invoice_request_id"), "invoice_request_id", "left_semi"
    )


def dup_payment_requests(payment_requests: DataFrame) -> DataFrame:
    """(invoice request, due date) groups that hold several unmarked payment requests."""
    return (
        payment_requests.where(F.col("process_type").isNull())
        .groupBy("invoice_request_id", "due_date_utc", "process_type")
        .agg(F.count("invoice_request_id").alias("copies"))
        .where(F.col("copies") != 1)
    )


def rank_duplicates(
    payment_requests: DataFrame, duplicates: DataFrame, reference_mode: bool = False
) -> DataFrame:
    """Position of each affected payment request by status and id.

    By default only members of a duplicate group are ranked, within that group.
    ``reference_mode`` ranks every payment request of the invoice request.
    """
    columns = ["payment_request_id", "invoice_request_id", "due_date_utc", "status", "tx_payment_id"]
    if reference_mode:
        # The duplicate list repeats an invoice request once for each of its due dates.
        groups = duplicates.groupBy("invoice_request_id").agg(F.count("*").alias("_groups"))
        affected = (
            payment_requests.select(*columns)
            .join(groups, "invoice_request_id")
            .withColumn("_part", F.col("invoice_request_id"))
        )
        ranked = number_within(affected, key="_part", leading="status", row_id="payment_request_id", out="_place")
        # rank() counts the repeats of all earlier rows, and every row repeats equally often.
        position = (F.col("_place") - 1) * F.col("_groups") + 1
        return ranked.withColumn("position", position.cast("bigint")).select("position", *columns)
    groups = duplicates.select(
        F.col("invoice_request_id").alias("_request"), F.col("due_date_utc").alias("_due")
    )
    # Requests without a due date are duplicates of each other, as in the grouping.
    same = (F.col("invoice_request_id") == F.col("_request")) & F.col("due_date_utc").eqNullSafe(F.col("_due"))
    affected = (
        payment_requests.where(F.col("process_type").isNull())
        .select(*columns)
        .join(groups, same, "left_semi")
        .withColumn("_part", F.struct("invoice_request_id", "due_date_utc"))
    )
    return number_within(
        affected, key="_part", leading="status", row_id="payment_request_id", out="position"
    ).select("position", *columns)


def orphan_items(T: Tables) -> DataFrame:
    """Live payment-request items that point to no invoice-request item."""
    alive = T.payment_request_item.join(
        T.payment_request.where(live()).select("payment_request_id"), "payment_request_id", "left_semi"
    )
    linked = keys_of(T.invoice_request_item, "invoice_request_item_id")
    return alive.join(linked, "invoice_request_item_id", "left_anti")


def bad_installments(T: Tables) -> DataFrame:
    """Agreements whose request carries more unmarked payment requests than the
    installment plan allows (the initial payment plus the installments)."""
    counted = (
        T.payment_request.where(F.col("process_type").isNull())
        .groupBy("invoice_request_id")
        .agg(F.count("*").alias("calc_count"))
    )
    plans = T.member_agreement_item_pay_source.where(F.col("payment_installments") > 1).select(
        "member_agreement_item_id",
        (F.col("payment_installments") + 1).cast("bigint").alias("installment_count"),
    )
    return (
        T.invoice_request_item.select("invoice_request_id", "member_agreement_item_id")
        .join(plans, "member_agreement_item_id")
        .join(counted, "invoice_request_id")
        .where(F.col("installment_count") < F.col("calc_count"))
        .join(T.invoice_request.select("invoice_request_id"), "invoice_request_id", "left_semi")
        .join(
            T.member_agreement_item.select("member_agreement_item_id", "member_agreement_id"),
            "member_agreement_item_id",
        )
        .select("member_agreement_id", "installment_count", "calc_count")
    )


def missing_payment_requests(T: Tables, from_date: datetime | str, to_date: datetime | str) -> DataFrame:
    """Active agreements with a live invoice request billed in ``[from, to]`` that has
    no live payment request."""
    requests = in_window(T.dated("invoice_request"), "bill_date", from_date, to_date, closed=True).where(live())
    requests = requests.join(T.payment_request.where(live()).select("invoice_request_id"), "invoice_request_id", "left_anti")
    agreements = T.member_agreement.where(F.col("status") == ACTIVE).select(
        "member_agreement_id", "party_role_id", "start_date"
    )
    return (
        requests.join(agreements, "member_agreement_id")
        .join(T.party_role.select("party_role_id", "role_id"), "party_role_id")
        .select(
            "role_id", "member_agreement_id", "start_date", "bill_date", "invoice_request_id",
            "tx_invoice_id", "primary_tx_invoice_id",
        )
    )


def cancelled_agreements(T: Tables, cutoff: datetime | str) -> DataFrame:
    """Agreements with a cancellation dated before the cutoff."""
    return keys_of(
        T.cancellation.where(
            (F.col("entity_id_type") == ENTITY_AGREEMENT) & (F.col("cancel_date") < ts(cutoff))
        ).select(F.col("entity_id").alias("member_agreement_id")),
        "member_agreement_id",
    )


def exclude_legitimate(missing: DataFrame, T: Tables, cutoff: datetime | str) -> DataFrame:
    """Missing requests less those of agreements that owe nothing: zero-priced, fully
    sponsored, cancelled before the cutoff, or billed to a zero-amount invoice."""
    missing = stored(missing, "missing-requests")
    items = T.member_agreement_item.select("member_agreement_item_id", "member_agreement_id").join(
        keys_of(missing, "member_agreement_id"), "member_agreement_id", "left_semi"
    )

    def owners(rows: DataFrame) -> DataFrame:
        return rows.select("member_agreement_item_id").join(items, "member_agreement_item_id").select("member_agreement_id")

    zero_priced = owners(T.member_agreement_item_perpetual.where(F.col("price") == 0))
    sponsored = owners(
        T.member_agreement_item_pay_source.where(F.col("from_foreign") & (F.col("payment_value") == 1))
    )
    zero_invoices = (
        T.tx_transaction.join(keys_of(missing, "tx_invoice_id"), "tx_invoice_id", "left_semi")
        .groupBy("tx_invoice_id")
        .agg(F.sum("amount").alias("total"))
        .where(F.col("total") == 0)
    )
    zero_billed = missing.join(zero_invoices, "tx_invoice_id", "left_semi").select("member_agreement_id")
    excused = (
        zero_priced.unionByName(sponsored)
        .unionByName(cancelled_agreements(T, cutoff))
        .unionByName(zero_billed)
    )
    return missing.join(keys_of(excused, "member_agreement_id"), "member_agreement_id", "left_anti")


def sync_worklist(
    missing: DataFrame, T: Tables, cutoff: datetime | str, command: str, ordered: bool = False
) -> DataFrame:
    """Agreements still to re-sync by unit, with the command text that would do it.

    ``ordered`` sorts by unit and agreement.  ``command`` holds ``{unit}`` and ``{agreement}``; nothing is executed.
    """
    head, rest = command.split("{unit}")
    middle, tail = rest.split("{agreement}")
    work = (
        T.member_agreement.select("business_unit_id", "member_agreement_id")
        .join(keys_of(missing, "member_agreement_id"), "member_agreement_id", "left_semi")
        .join(cancelled_agreements(T, cutoff), "member_agreement_id", "left_anti")
        .distinct()
        .withColumn(
            "command",
            F.concat(
                F.lit(head), F.col("business_unit_id").cast("string"), F.lit(middle),
                F.col("member_agreement_id").cast("string"), F.lit(tail),
            ),
        )
    )
    return work.orderBy("business_unit_id", "member_agreement_id") if ordered else work
