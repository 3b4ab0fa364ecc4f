"""The billing summary: one row for each billed transaction of a time window."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duesmith.functions.money import money, sum_where
from duesmith.functions.relations import keys_of, left_join_sparse
from duesmith.functions.times import day_crossings, in_window, moment, to_utc, to_utc_by, ts, undated
from duesmith.operators.ledger import first_sale_item
from duesmith.schema import (
    CARD_INTERFACES, ROLE_MEMBER, ROLE_ORGANIZATION, TX_FEE, TX_PAYMENT, TX_SALE, TX_TAX, TX_TENDER,
)
from duesmith.sources.tables import Tables


def billing_base(
    tx: DataFrame,
    zone: str,
    from_local: datetime | str,
    to_local: datetime | str,
    batched_only: bool = False,
    gateway_batch: int | None = None,
) -> DataFrame:
    """Billing-service transactions in ``[from, to)`` of a unit's local time.

    With ``gateway_batch`` that batch is selected instead of a window.  The bounds
    are folded to UTC literals, so the filter reaches the scan and, where ``tx`` is
    stored by month (``Tables.dated``), the choice of folders.
    """
    if gateway_batch is not None:
        tx = undated(tx.where(F.col("gateway_batch_id") == gateway_batch))
    else:
        tx = in_window(tx, "target_date_utc", to_utc(ts(from_local), zone), to_utc(ts(to_local), zone))
    if batched_only:
        tx = tx.where(F.col("payment_process_batch_id").isNotNull())
    return tx


def billing_base_of_units(
    T: Tables, from_local: datetime | str, to_local: datetime | str, gap: str = "forward", overlap: str = "earlier"
) -> DataFrame:
    """Billing-service transactions in ``[from, to)`` of each unit's own local time.

    Each row carries its unit's window in UTC.  Rows without a unit, or of one without a zone, are in
    no window.  ``gap`` and ``overlap`` as for ``times.to_utc_by``.
    """
    edges = {"window_start": from_local, "window_end": to_local}
    windows = T.business_unit.select(
        "business_unit_id",
        *[to_utc_by(ts(edge), F.col("time_zone_name"), gap, overlap).alias(name) for name, edge in edges.items()],
    )
    # Zones lie between 12 hours behind UTC and 14 before it: that much is known to the scan.
    earliest, latest = moment(from_local) - timedelta(hours=14), moment(to_local) + timedelta(hours=12)
    tx = in_window(T.dated("billing_service_tx"), "target_date_utc", earliest, latest)
    date = F.col("target_date_utc")
    inside = tx.join(windows, "business_unit_id").where((date >= F.col("window_start")) & (date < F.col("window_end")))
    return inside.select(*tx.columns, *edges)


def _reportable_of_units(base: DataFrame, T: Tables) -> DataFrame:
    """``keep_reportable`` for rows that carry their own window."""
    dated = T.tx_payment.select("tx_payment_id", F.col("target_date_utc").alias("paid_on"))
    asked = base.where(F.col("is_payment_declined") & F.col("decline_tx_payment_id").isNull())
    asked = asked.select(F.col("tx_payment_id").alias("decline_tx_payment_id"), "window_start", "window_end").distinct()
    excused = (
        T.payment_process_response.select("payment_process_request_id", "decline_tx_payment_id")
        .join(asked, "decline_tx_payment_id")
        .join(T.payment_process_request.select("payment_process_request_id", "tx_payment_id"), "payment_process_request_id")
        .join(dated, "tx_payment_id")
        .where((F.col("paid_on") >= F.col("window_start")) & (F.col("paid_on") < F.col("window_end")))
        .select(F.struct(F.col("decline_tx_payment_id").alias("tx_payment_id"), "window_start").alias("_asked"))
        .distinct()
        .withColumn("_in_window", F.lit(True))
    )
    asks = F.when(F.col("tx_payment_id").isNotNull(), F.struct("tx_payment_id", "window_start"))
    return (
        left_join_sparse(base.withColumn("_asked", asks), excused, "_asked", "tx_transaction_id")
        .where(
            ~F.col("is_payment_declined")
            | F.col("decline_tx_payment_id").isNotNull()
            | F.coalesce("_in_window", F.lit(False))
        )
        .select(*base.columns)
    )


def keep_reportable(base: DataFrame, T: Tables, from_utc: Column, to_utc_: Column) -> DataFrame:
    """Drop declined rows whose decline is neither booked nor due to a payment dated
    in the window."""
    dated = in_window(T.dated("tx_payment"), "target_date_utc", from_utc, to_utc_).select("tx_payment_id")
    requests = T.payment_process_request.select("payment_process_request_id", "tx_payment_id")
    responses = T.payment_process_response.select("payment_process_request_id", "decline_tx_payment_id")
    excused = keys_of(
        responses.where(F.col("decline_tx_payment_id").isNotNull())
        .join(requests, "payment_process_request_id")
        .join(dated, "tx_payment_id", "left_semi"),
        "decline_tx_payment_id",
    ).select(F.col("decline_tx_payment_id").alias("tx_payment_id"), F.lit(True).alias("_in_window"))
    return (
        left_join_sparse(base, excused, "tx_payment_id", "tx_transaction_id")
        .where(
            ~F.col("is_payment_declined")
            | F.col("decline_tx_payment_id").isNotNull()
            | F.coalesce("_in_window", F.lit(False))
        )
        .select(*base.columns)
    )


def _current(to_utc_: Column) -> Column:
    return F.abs(day_crossings("due_date_utc", to_utc_)) <= 30


def _currency_columns(to_utc_: Column, copies: Column) -> list[Column]:
    payment = F.col("tx_type_id") == TX_PAYMENT
    columns = []
    for name, near in (("current", _current(to_utc_)), ("past_due", ~_current(to_utc_))):
        test = payment & near
        counted = F.when(test & F.col("tx_payment_id").isNotNull(), copies).otherwise(0)
        columns += [
            F.sum(counted).cast("bigint").alias(f"count_{name}_payments"),
            money(F.sum(F.when(test, F.col("amount") * copies).otherwise(0))).alias(f"sum_{name}_payments"),
        ]
    return columns


def payment_currency_split(
    base: DataFrame, to_utc_: Column, keys: Sequence[str] = ("tx_invoice_id",)
) -> DataFrame:
    """Payments due within 30 days of the window's end, and the others."""
    return base.groupBy(*keys).agg(*_currency_columns(to_utc_, F.lit(1)))


def property_holders(
    T: Tables,
    type_id: int,
    equals: Sequence[str] | None = None,
    like: str | None = None,
    dates: tuple[str, str] | None = None,
    positive: bool = False,
) -> DataFrame:
    """Party roles whose free-text property of a type passes the chosen test."""
    value = F.col("value")
    tests = [F.col("type_id") == type_id]
    if equals is not None:
        tests.append(value.isin(*equals))
    if like is not None:
        tests.append(value.like(like))
    if dates is not None:
        day = value.try_cast("date")
        tests.append((day >= F.lit(dates[0]).cast("date")) & (day <= F.lit(dates[1]).cast("date")))
    if positive:
        tests.append(value.try_cast("decimal(12,2)") > 0)
    rows = T.party_property
    for test in tests:
        rows = rows.where(test)
    return keys_of(rows, "party_role_id")


def _directory(T: Tables, base: DataFrame) -> DataFrame:
    """Names of the party roles in ``base``, joined once before the ledger meets them."""
    billed = keys_of(base, "party_role_id")
    members = T.member_list.select(
        "party_role_id", F.col("role_id").alias("m_role"), "first_name", "last_name", F.lit(True).alias("is_m")
    )
    organizations = T.organization_list.select(
        "party_role_id", F.col("role_id").alias("o_role"), "organization_name"
    )
    kind = F.col("party_role_type_id")
    roles = T.party_role.select("party_role_id", "party_role_type_id").join(billed, "party_role_id", "left_semi")
    members, organizations = (rows.join(billed, "party_role_id", "left_semi") for rows in (members, organizations))
    as_member = members.withColumn("party_role_type_id", F.lit(ROLE_MEMBER))
    as_organization = organizations.withColumn("party_role_type_id", F.lit(ROLE_ORGANIZATION))
    is_member = F.col("is_m").isNotNull()
    return (
        roles.join(as_member, ["party_role_id", "party_role_type_id"], "left")
        .join(as_organization, ["party_role_id", "party_role_type_id"], "left")
        .select(
            "party_role_id",
            is_member.alias("is_member"),
            F.when(is_member, F.col("m_role")).otherwise(F.col("o_role")).alias("member_id"),
            F.when(is_member, F.col("first_name")).otherwise(F.col("organization_name")).alias("first_name"),
            F.when(is_member, F.col("last_name")).otherwise(F.lit("")).alias("last_name"),
        )
    )


def _group_amounts(base: DataFrame) -> DataFrame:
    """Distinct sale and fee amounts of each (invoice, group): their sum and number."""
    kind = F.col("tx_type_id")
    distinct = (
        base.where(kind.isin(TX_SALE, TX_FEE))
        .select("tx_invoice_id", "group_id", "tx_type_id", money("amount").alias("amount"))
        .distinct()
    )
    columns = []
    for name, tx_type in (("sale", TX_SALE), ("fee", TX_FEE)):
        columns += [
            sum_where(kind == tx_type).alias(name),
            F.count(F.when(kind == tx_type, 1)).alias(f"{name}_rows"),
        ]
    return distinct.groupBy("tx_invoice_id", "group_id").agg(*columns)


def billing_summary(
    T: Tables,
    from_local: datetime | str,
    to_local: datetime | str,
    zone: str | None = "UTC",
    units: Sequence[int] | None = None,
    division: int | None = None,
    tenders: Sequence[int] | None = None,
    member_role: str | None = None,
    name_like: str | None = None,
    holders: DataFrame | None = None,
    batched_only: bool = False,
    gateway_batch: int | None = None,
    reference_mode: bool = False,
    ordered: bool = False,
) -> DataFrame:
    """Who was billed for what in the window, with tax, tender, decline and payment.

    ``ordered`` sorts by invoice, group and transaction.  Without a ``zone`` the window is read in
    each unit's own local time, so that one job bills units of different zones.

    A group may hold several distinct sale or tax amounts.  By default each row sees
    their sum once.  ``reference_mode`` reproduces the original result, in which
    every pair of them repeats the row; the repeats are counted, never built.
    """
    if zone is None:
        if gateway_batch is not None:
            raise ValueError("a gateway batch is no window, so it needs a zone to date its declines")
        end = F.col("window_end")
        base = billing_base_of_units(T, from_local, to_local)
        if batched_only:
            base = base.where(F.col("payment_process_batch_id").isNotNull())
        kept = _reportable_of_units(base, T)
    else:
        start, end = to_utc(ts(from_local), zone), to_utc(ts(to_local), zone)
        base = billing_base(T.dated("billing_service_tx"), zone, from_local, to_local, batched_only, gateway_batch)
        kept = keep_reportable(base, T, start, end)
    if tenders is not None:
        kept = kept.where(F.col("tender_type_id").isin(*tenders))

    unit = T.business_unit.select(
        "business_unit_id", F.col("name").alias("bu_name"), "division_id", "division_name"
    )
    if units is not None:
        unit = unit.where(F.col("business_unit_id").isin(*units))
    if division is not None:
        unit = unit.where(F.col("division_id") == division)
    directory = _directory(T, base)
    if holders is not None:
        directory = directory.where("is_member").join(keys_of(holders, "party_role_id"), "party_role_id", "left_semi")
    if member_role is not None:
        directory = directory.where(F.col("is_member") & (F.col("member_id") == member_role))
    if name_like is not None:
        hit = (
            F.col("first_name").like(name_like)
            | F.col("last_name").like(name_like)
            | (F.col("member_id") == name_like)
        )
        directory = directory.where(F.col("is_member") & hit)
    ledger_code = T.general_ledger_code.select(
        F.col("general_ledger_code_id").alias("gl_id"),
        F.col("code").alias("gl_code"),
        F.col("description").alias("gl_description"),
    )
    card = T.credit_card_type.select("credit_card_type_id", F.col("description").alias("card"))

    first_item = first_sale_item(T, base).withColumnRenamed("sale_item_id", "first_item_id")
    rows = (
        kept.join(unit, "business_unit_id", "left" if units is None and division is None else "inner")
        .join(ledger_code, "gl_id", "left")
        .join(card, "credit_card_type_id", "left")
        .join(directory, "party_role_id")
        .join(_group_amounts(base), ["tx_invoice_id", "group_id"], "left")
        .join(first_item, ["tx_invoice_id", "group_id"], "left")
    )
    one = F.lit(1)
    if reference_mode:
        sale_rows = F.greatest(F.coalesce("sale_rows", one), one)
        fee_rows = F.greatest(F.coalesce("fee_rows", one), one)
    else:
        sale_rows = fee_rows = one
    copies = sale_rows * fee_rows
    # What a row that is not itself a sale (or tax) shows for its group.
    group_sales = F.coalesce("sale", F.lit(0)) * fee_rows
    group_tax = F.coalesce("fee", F.lit(0)) * sale_rows
    amount, kind = F.col("amount"), F.col("tx_type_id")
    own = amount * copies

    def own_or(types: Sequence[int], other: Column) -> Column:
        return money(F.sum(F.when(kind.isin(*types) & amount.isNotNull(), own).otherwise(other)))

    paid = kind.isin(TX_PAYMENT, TX_TENDER)
    tender = F.when(F.col("tender_interface_id").isin(*CARD_INTERFACES), F.col("card")).otherwise(
        F.col("tender_type_name")
    )
    report = rows.groupBy("tx_transaction_id", "tx_invoice_id", "group_id").agg(
        F.max("division_id").alias("division_id"),
        F.max("division_name").alias("division_name"),
        F.max(F.when(F.col("bu_name").isNotNull(), F.col("business_unit_id"))).alias("business_unit_id"),
        F.max("bu_name").alias("bu_name"),
        F.max("member_id").alias("member_id"),
        F.max("first_name").alias("first_name"),
        F.max("last_name").alias("last_name"),
        F.max("member_agreement_id").alias("member_agreement_id"),
        F.max("target_date_utc").alias("bill_date"),
        F.max("due_date").alias("due_date"),
        F.max("first_item_id").alias("sale_item_id"),
        F.max("sale_item_code").alias("sale_item_code"),
        F.max("sale_item").alias("sale_item"),
        F.max("description").alias("line_item"),
        F.max(F.when(paid, F.col("target_date"))).alias("payment_date"),
        F.max("gl_id").alias("gl_id"),
        F.max("gl_code").alias("gl_code"),
        F.max("gl_description").alias("gl_description"),
        own_or((TX_SALE, TX_FEE), group_sales).alias("sales"),
        own_or((TX_TAX,), group_tax).alias("tax"),
        own_or((TX_SALE, TX_TAX, TX_FEE), group_sales + group_tax).alias("sales_tax_total"),
        F.max("tender_type_id").alias("tender_type_id"),
        F.coalesce(F.max(tender), F.lit("Cash")).alias("tender_type"),
        F.max("tender_interface_id").alias("tender_type_interface_id"),
        F.max("credit_card_type_id").alias("credit_card_type_id"),
        F.max(F.col("is_payment_declined").cast("int")).alias("is_declined"),
        money(F.sum(F.when(paid, own).otherwise(0))).alias("payment"),
        *_currency_columns(end, copies),
    )
    return report.orderBy("tx_invoice_id", "group_id", "tx_transaction_id") if ordered else report
