"""Receivables aging: ranges per account, snapshots, and due buckets per party."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duesmith.functions.money import money, signed, sum_where
from duesmith.functions.relations import keys_of, left_join_sparse
from duesmith.functions.times import day_crossings, moment, to_utc, ts
from duesmith.operators.ledger import accounts_of, invoice_balance, invoice_charges, lines_of
from duesmith.schema import LINK_INVOICE_REQUEST, LINK_PAYMENT_REQUEST_ITEM, ROLE_MEMBER, TX_PAYMENT, TX_TENDER
from duesmith.sources.tables import Tables
from duesmith.sources.workspace import stored

BUCKETS = (
    "aging_current", "aging_30", "aging_60", "aging_90", "aging_120", "aging_over_120",
    "total_due", "total_past_due",
)

# How far each range's recent edge is moved past the older edge of its neighbour.
_OVERLAP = {
    "strict": timedelta(milliseconds=1),
    "inclusive_1m": timedelta(minutes=1),
    "half_open": timedelta(0),
}


def _ranges(date: Column, as_of: datetime, cutoff: Column | None, bounds: str):
    """Label, recent edge, older edge and membership test of every range."""
    step = _OVERLAP[bounds]

    def inside(older: datetime | None, recent: datetime | None) -> Column:
        tests = []
        if older is not None:
            at_or_after = date >= ts(older)
            after = date > ts(older)
            # The newest range is open on its older side even with inclusive bounds.
            inclusive = bounds == "half_open" or (bounds == "inclusive_1m" and recent is not None)
            tests.append(at_or_after if inclusive else after)
        if recent is not None:
            inclusive = bounds == "inclusive_1m" and older is not None
            tests.append(date <= ts(recent) if inclusive else date < ts(recent))
        elif cutoff is not None:
            tests.append(date < cutoff)
        test = tests[0]
        for extra in tests[1:]:
            test = test & extra
        return test

    back = [as_of - timedelta(days=days) for days in (30, 60, 90)]
    edges = [
        ("30 Day", None, back[0]),
        ("60 Day", back[0] + step, back[1]),
        ("90 Day", back[1] + step, back[2]),
        ("90+", back[2] + step, None),
    ]
    return [(label, recent, older, inside(older, recent)) for label, recent, older in edges]


def account_aging(
    T: Tables,
    parties: DataFrame | None,
    as_of: datetime | str,
    date_col: str = "target_date_utc",
    bounds: str = "strict",
    zero_fill: bool = False,
) -> DataFrame:
    """Charges, payments and balance of each account in four age ranges and in total.

    By target date the newest range also ends at the cutoff, read as local time of
    the invoice's unit; by due date neither the unit nor the cutoff plays a part.
    One pass over the ledger fills all five ranges.
    """
    as_of = moment(as_of)
    by_target = date_col == "target_date_utc"
    invoices = T.tx_invoice.select(
        "tx_invoice_id", "client_account_id", "target_business_unit_id", F.col(date_col).alias("aged_on")
    )
    cutoff = None
    if by_target:
        units = T.business_unit.select(
            F.col("business_unit_id").alias("target_business_unit_id"),
            to_utc(ts(as_of), F.col("time_zone_name")).alias("cutoff_utc"),
            F.lit(True).alias("has_unit"),
        )
        invoices = invoices.join(units, "target_business_unit_id", "left")
        cutoff = F.col("cutoff_utc")

    ranges = _ranges(F.col("aged_on"), as_of, cutoff, bounds)
    sums = []
    for n, (_, _, _, test) in enumerate(ranges):
        if by_target:
            test = F.col("has_unit") & test
        sums += [sum_where(test, side).alias(f"{side}_{n}") for side in ("charges", "payments")]
    sums += [F.sum(side).alias(f"{side}_{len(ranges)}") for side in ("charges", "payments")]

    accounts = accounts_of(T, parties)
    tx = T.tx_transaction
    if parties is not None:
        invoices = invoices.join(accounts, "client_account_id", "left_semi")
        tx = lines_of(tx, invoices)
    per_account = invoices.join(invoice_charges(tx), "tx_invoice_id").groupBy("client_account_id").agg(*sums)
    long = []
    for n, (label, recent, older) in enumerate([(r[0], r[1], r[2]) for r in ranges] + [("Total", None, None)]):
        charges, payments = F.col(f"charges_{n}"), F.col(f"payments_{n}")
        if zero_fill:
            charges, payments = F.coalesce(charges, F.lit(0)), F.coalesce(payments, F.lit(0))
        no_date = F.lit(None).cast("timestamp_ntz")
        long.append(
            F.struct(
                F.lit(label).alias("range"),
                (no_date if recent is None else ts(recent)).alias("from_date"),
                (no_date if older is None else ts(older)).alias("to_date"),
                money(charges).alias("charges"),
                money(payments).alias("payments"),
                money(charges - payments).alias("balance"),
            )
        )
    return (
        accounts.join(per_account, "client_account_id", "left")
        .select(F.col("client_account_id").alias("account_id"), F.explode(F.array(*long)).alias("r"))
        .select("r.range", "r.from_date", "r.to_date", "account_id", "r.charges", "r.payments", "r.balance")
    )


def ar_aging(
    T: Tables,
    as_of: datetime | str,
    business_unit: int | None = None,
    party: int | None = None,
    account: int | None = None,
    party_roles: DataFrame | None = None,
) -> DataFrame:
    """Open amounts by days past due for each unit, account, party, agreement and role.

    Only invoices with a positive net enter the buckets; negative nets add up to
    the account credit, which stays NULL where there is none.  ``party_roles`` (``party_role_id``)
    asks for the rows of some roles, at the cost of their invoices.
    """
    invoices = T.tx_invoice.where(F.col("target_date") < ts(as_of))
    roles = T.party_role.select("party_role_id", "party_id")
    if business_unit is not None:
        invoices = invoices.where(F.col("target_business_unit_id") == business_unit)
    if account is not None:
        invoices = invoices.where(F.col("client_account_id") == account)
    if party is not None:
        roles = roles.where(F.col("party_id") == party)
        invoices = invoices.join(roles, "party_role_id", "left_semi")
    if party_roles is not None:
        invoices = invoices.join(keys_of(party_roles, "party_role_id"), "party_role_id", "left_semi")
    tx = T.tx_transaction
    if (business_unit, party, account, party_roles) != (None, None, None, None):
        tx = lines_of(tx, invoices)

    requests = T.invoice_request.select(
        F.col("invoice_request_id").alias("request_id"), "member_agreement_id"
    )
    open_items = (
        invoices.select(
            F.col("target_business_unit_id").alias("business_unit_id"),
            "client_account_id",
            "party_role_id",
            "tx_invoice_id",
            F.when(F.col("link_type_id") == LINK_INVOICE_REQUEST, F.col("link_id")).alias("request_id"),
            day_crossings(F.coalesce("payment_due_date", "target_date"), ts(as_of)).alias("age"),
        )
        .join(invoice_balance(tx), "tx_invoice_id")
        .transform(left_join_sparse, requests, "request_id", "tx_invoice_id")
        .join(roles, "party_role_id")
    )
    age, net = F.col("age"), F.col("balance")
    owed = net > 0

    def bucket(test: Column) -> Column:
        return F.coalesce(sum_where(owed & test, net), F.lit(0))

    keys = ["business_unit_id", "client_account_id", "party_id", "member_agreement_id", "party_role_id"]
    return (
        open_items.groupBy(*keys)
        .agg(
            bucket(age <= 0).alias("aging_current"),
            bucket(age.between(1, 30)).alias("aging_30"),
            bucket(age.between(31, 60)).alias("aging_60"),
            bucket(age.between(61, 90)).alias("aging_90"),
            bucket(age.between(91, 120)).alias("aging_120"),
            bucket(age > 120).alias("aging_over_120"),
            bucket(F.lit(True)).alias("total_due"),
            bucket(age > 0).alias("total_past_due"),
            (-sum_where(net < 0, net)).alias("acct_credit"),
        )
        .select(*keys, *[money(name).alias(name) for name in (*BUCKETS, "acct_credit")])
    )


def zero_rows(aging: DataFrame, T: Tables) -> DataFrame:
    """All-zero rows for member roles with an account and an agreement but no aging
    row in their own unit."""
    aged = keys_of(aging, "party_role_id", "business_unit_id")
    return (
        T.party_role.where(F.col("party_role_type_id") == ROLE_MEMBER)
        .join(aged, ["party_role_id", "business_unit_id"], "left_anti")
        .join(T.client_account_party.select("client_account_id", "party_id"), "party_id")
        .join(T.member_agreement.select("member_agreement_id", "party_role_id"), "party_role_id")
        .select(
            "business_unit_id",
            "client_account_id",
            "party_id",
            "member_agreement_id",
            "party_role_id",
            *[money(F.lit(0)).alias(name) for name in BUCKETS],
            money(F.lit(None)).alias("acct_credit"),
        )
    )


def zero_fill(aging: DataFrame, T: Tables) -> DataFrame:
    """The aging rows plus ``zero_rows``.

    ``aging`` is read twice, so pass a stored table rather than a plan.
    """
    return aging.unionByName(zero_rows(aging, T))


def due_invoices(
    T: Tables, as_of: datetime | str, parties: DataFrame | None = None, external: DataFrame | None = None
) -> DataFrame:
    """Invoices before the cutoff on accounts that the parties hold as primary ones.

    ``external`` names accounts (``client_account_id``) that are to be left out.
    """
    holders = T.client_account_party.where("primary_party").select("party_id", "client_account_id")
    if external is not None:
        holders = holders.join(keys_of(external, "client_account_id"), "client_account_id", "left_anti")
    invoices = T.tx_invoice.where(F.col("target_date") < ts(as_of)).select(
        "tx_invoice_id",
        "client_account_id",
        F.col("target_business_unit_id").alias("business_unit_id"),
        F.col("target_date_utc"),
    )
    if parties is None:
        return invoices.join(holders, "client_account_id")
    holders = holders.join(keys_of(parties, "party_id"), "party_id", "left_semi")
    return stored(invoices.join(holders, "client_account_id"), "due-invoices")


def transactions_due(
    T: Tables, as_of: datetime | str, parties: DataFrame | None = None, invoices: DataFrame | None = None
) -> DataFrame:
    """Signed amount of every transaction of the parties' accounts before the cutoff.

    ``invoices`` are those of ``due_invoices`` where a caller has them already.
    """
    tx = T.tx_transaction
    if invoices is None:
        invoices = due_invoices(T, as_of, parties)
    if parties is not None:
        tx = lines_of(tx, invoices)
    tx = tx.select("tx_transaction_id", "tx_invoice_id", "link_type_id", "link_id", signed().alias("due_amount"))
    return tx.join(invoices, "tx_invoice_id").select(
        "party_id", "tx_transaction_id", money("due_amount").alias("due_amount"), "target_date_utc",
        "link_type_id", "link_id", "business_unit_id", "tx_invoice_id",
    )


def _schedule(T: Tables, invoices: DataFrame | None = None) -> DataFrame:
    """What the payment-request items say is due on each invoice and date.

    ``scheduled`` sums the items that carry an amount; ``unpriced`` counts the rows
    that leave the transaction's own amount in force.  With ``invoices`` the schedule of
    these alone: their keys are stored and go from table to table, so that every row that is
    sorted or summed belongs to one of them.
    """
    linked = T.invoice_request.where(F.col("tx_invoice_id").isNotNull()).select("invoice_request_id", "tx_invoice_id")
    requests = T.payment_request.select("payment_request_id", "invoice_request_id", "due_date_utc")
    items = T.payment_request_item.select("payment_request_item_id", "payment_request_id", "fixed_amount")
    paying = T.tx_transaction.where(
        (F.col("link_type_id") == LINK_PAYMENT_REQUEST_ITEM) & F.col("tx_type_id").isin(TX_PAYMENT, TX_TENDER)
    ).select(F.col("link_id").alias("payment_request_item_id"), signed().alias("amount"))
    if invoices is not None:
        linked = stored(linked.join(keys_of(invoices, "tx_invoice_id"), "tx_invoice_id", "left_semi"), "due-requests")
        requests = requests.join(keys_of(linked, "invoice_request_id"), "invoice_request_id", "left_semi")
        requests = stored(requests, "due-payment-requests")
        items = stored(items.join(requests.select("payment_request_id"), "payment_request_id", "left_semi"), "due-items")
        paying = paying.join(items.select("payment_request_item_id"), "payment_request_item_id", "left_semi")
    paid = paying.groupBy("payment_request_item_id").agg(F.sum("amount").alias("paid"))
    values = items.join(paid, "payment_request_item_id", "left").select(
        "payment_request_id", (F.col("fixed_amount") + F.coalesce("paid", F.lit(0))).alias("value")
    )
    return (
        linked.join(requests, "invoice_request_id", "left")
        .join(values, "payment_request_id", "left")
        .groupBy("tx_invoice_id", "due_date_utc")
        .agg(
            money(F.sum("value")).alias("scheduled"),
            (F.count("*") - F.count("value")).alias("unpriced"),
        )
    )


def _rebased(due: DataFrame, T: Tables, copies: Column, invoices: DataFrame | None) -> DataFrame:
    """Due rows on the amounts and dates of their schedule; rows of unknown units stay as they are."""
    units = T.business_unit.select("business_unit_id", F.lit(True).alias("known"))
    schedule = _schedule(T, invoices).withColumnRenamed("tx_invoice_id", "scheduled_invoice")
    joined = (
        due.join(units, "business_unit_id", "left")
        .withColumn("scheduled_invoice", F.when(F.col("known"), F.col("tx_invoice_id")))
        .transform(left_join_sparse, schedule, "scheduled_invoice", "tx_invoice_id")
    )
    planned = F.coalesce(F.col("scheduled"), F.lit(0)) * copies + F.col("unpriced") * F.col("due_amount")
    return joined.withColumn(
        "due_amount", F.when(F.col("unpriced").isNull(), F.col("due_amount")).otherwise(planned)
    ).withColumn("target_date_utc", F.coalesce("due_date_utc", "target_date_utc"))


def rebase_due(due: DataFrame, T: Tables, invoices: DataFrame | None = None) -> DataFrame:
    """``due`` with the amounts and dates of its payment-request items in place of its own.

    A transaction whose schedule names several dates has a row for each of them.  Where ``due`` is of
    some parties, ``invoices`` are theirs (``due_invoices``), and no others' schedule is summed.
    """
    keys = [column for column in due.columns if column != "due_amount"]
    return (
        _rebased(due, T, F.lit(1), invoices)
        .groupBy(*keys)
        .agg(money(F.sum("due_amount")).alias("due_amount"))
        .select(*due.columns)
    )


def party_due_buckets(
    due: DataFrame, T: Tables, as_of: datetime | str, invoices: DataFrame | None = None
) -> DataFrame:
    """Re-based due amounts of each party in four age buckets and in total.

    Transactions of one invoice and date share their schedule, so they are summed
    before they meet it: the join never pairs every transaction with every item.  ``invoices``
    as for ``rebase_due``.
    """
    as_of = moment(as_of)
    merged = due.groupBy("party_id", "tx_invoice_id", "business_unit_id", "target_date_utc").agg(
        F.sum("due_amount").alias("due_amount"), F.count("*").alias("copies")
    )
    rows = _rebased(merged, T, F.col("copies"), invoices)
    date, tick = F.col("target_date_utc"), timedelta(milliseconds=1)
    back30, back60, back90 = (as_of - timedelta(days=days) for days in (30, 60, 90))

    def bucket(test: Column) -> Column:
        return money(sum_where(test, "due_amount"))

    return rows.groupBy("party_id").agg(
        bucket((date < ts(as_of)) & (date > ts(back30))).alias("zero_to_thirty"),
        bucket((date < ts(back30 - tick)) & (date > ts(back60))).alias("thirty_one_to_sixty"),
        bucket((date < ts(back60 + tick)) & (date > ts(back90))).alias("sixty_one_to_ninety"),
        bucket(date < ts(back90 + tick)).alias("older"),
        bucket(date < ts(as_of)).alias("balance"),
    )


def buckets_of_parties(
    T: Tables, as_of: datetime | str, parties: DataFrame, external: DataFrame | None = None
) -> DataFrame:
    """Due buckets of the given parties, at the cost of their own invoices; without ``external`` accounts."""
    invoices = due_invoices(T, as_of, parties, external)
    return party_due_buckets(transactions_due(T, as_of, parties, invoices), T, as_of, invoices)
