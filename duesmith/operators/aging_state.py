"""Aging snapshots kept up to date by what has changed since the last one.

An aging row changes only if the ledger or an invoice behind it did, or if one of its invoices enters
or crosses into the next age bucket.  The state, two tables of a book, follows from that: a calendar
of the open items, stored by the day of their next crossing (its month, while that is far off), and
the sums of each aging row with the number of items behind it.  A refresh reads the days up to its
cutoff, and the items of changed invoices; what these held is taken from the sums, what they hold now
is added.  Neither the ledger of other invoices nor the items of later days are read.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duesmith.functions.money import money
from duesmith.functions.relations import keys_of, left_join_sparse
from duesmith.functions.times import day_crossings, moment, ts
from duesmith.operators.ledger import invoice_balance, lines_of
from duesmith.schema import LINK_INVOICE_REQUEST
from duesmith.sources.book import Book, Layout
from duesmith.sources.tables import Tables
from duesmith.sources.workspace import stored

KEYS = ["business_unit_id", "client_account_id", "party_id", "member_agreement_id", "party_role_id"]
#: The buckets of an open amount and the ages, in days past due, at which the second and later ones begin.
OPEN_BUCKETS = ("aging_current", "aging_30", "aging_60", "aging_90", "aging_120", "aging_over_120")
EDGES = (1, 31, 61, 91, 121)
ITEMS, SUMS, CUTOFF = "aging_item", "aging_sum", "aging_cutoff"
#: Days from the cutoff on which the calendar has a slot for each day; beyond, one for each month.
HORIZON = 40
#: Buckets of the accounts that the sums are stored by.
SUM_BUCKETS = 64


def open_items(T: Tables, invoices: DataFrame | None = None) -> DataFrame:
    """What each invoice, or each of ``invoices``, adds to which aging row, whatever the date."""
    rows, tx = T.tx_invoice, T.tx_transaction
    if invoices is not None:
        rows = rows.join(keys_of(invoices, "tx_invoice_id"), "tx_invoice_id", "left_semi")
        tx = lines_of(tx, rows)
    requests = T.invoice_request.select(F.col("invoice_request_id").alias("request_id"), "member_agreement_id")
    return (
        rows.select(
            F.col("target_business_unit_id").alias("business_unit_id"),
            "client_account_id",
            "party_role_id",
            "tx_invoice_id",
            F.when(F.col("link_type_id") == LINK_INVOICE_REQUEST, F.col("link_id")).alias("request_id"),
            F.col("target_date").alias("entered"),
            F.coalesce("payment_due_date", "target_date").alias("due"),
        )
        .join(invoice_balance(tx), "tx_invoice_id")
        .transform(left_join_sparse, requests, "request_id", "tx_invoice_id")
        .join(T.party_role.select("party_role_id", "party_id"), "party_role_id")
        .select("tx_invoice_id", *KEYS, "entered", "due", "balance")
    )


def _aged(items: DataFrame, as_of: datetime) -> DataFrame:
    """Items with their bucket at the cutoff (none before they enter), and when and in which slot it changes."""
    age = day_crossings("due", ts(as_of))
    bucket: Column = F.lit(0)
    crossing: Column = F.lit(None).cast("timestamp_ntz")
    for place, edge in enumerate(EDGES, start=1):
        bucket = F.when(age >= edge, place).otherwise(bucket)
    for edge in reversed(EDGES):
        crossing = F.when(age < edge, F.date_add(F.to_date("due"), edge).cast("timestamp_ntz")).otherwise(crossing)
    entered = F.col("entered") < ts(as_of)
    change = F.when(F.col("entered") >= ts(as_of), F.col("entered")).when(entered, crossing)
    near = F.date_format(change, "yyyy-MM-dd"), F.date_format(change, "yyyy-MM")
    slot = F.when(change < ts(as_of + timedelta(days=HORIZON)), near[0]).otherwise(near[1])
    return items.select(
        "tx_invoice_id", *KEYS, "entered", "due", "balance", F.when(entered, bucket).alias("bucket"),
        F.coalesce(slot, F.lit("none")).alias("slot"),
    )


def _sums(items: DataFrame, sign: Column) -> DataFrame:
    """Sums by aging row of items that have entered, each counted ``sign`` times."""
    owed, counted = F.col("balance") > 0, F.col("bucket").isNotNull()
    amount = F.col("balance") * sign

    def total(test: Column, value: Column, kind: str, name: str) -> Column:
        return F.sum(F.when(counted & test, value).otherwise(0)).cast(kind).alias(name)

    buckets = [total(owed & (F.col("bucket") == n), amount, "decimal(28,2)", name) for n, name in enumerate(OPEN_BUCKETS)]
    credit = F.col("balance") < 0
    return items.groupBy(*KEYS).agg(
        *buckets,
        total(credit, -amount, "decimal(28,2)", "credit"),
        total(credit, sign, "bigint", "credit_items"),
        total(F.lit(True), sign, "bigint", "items"),
    )


def _added(sums: DataFrame) -> DataFrame:
    """Sums of one aging row put together; rows without items are gone."""
    added = [F.sum(name).cast(sums.schema[name].dataType).alias(name) for name in sums.columns if name not in KEYS]
    return sums.groupBy(*KEYS).agg(*added).where(F.col("items") != 0)


def _cutoff(T: Tables, as_of: datetime) -> DataFrame:
    return T.business_unit.sparkSession.range(1).select(ts(as_of).alias("as_of"))


def begin(book: Book, T: Tables, as_of: datetime | str, run: str) -> int:
    """Build the state for the first time, from all invoices."""
    as_of = moment(as_of)
    items = stored(_aged(open_items(T), as_of), "aging-items")
    edit = book.edit(run)
    edit.replace(ITEMS, items, Layout.by_value("slot"))
    edit.replace(SUMS, _added(_sums(items, F.lit(1))), Layout.bucketed("client_account_id", SUM_BUCKETS))
    edit.replace(CUTOFF, _cutoff(T, as_of), Layout.bucketed("as_of", 1))
    return edit.publish()


def due_slots(slots: Iterable[str], as_of: datetime | str) -> list[str]:
    """The calendar's slots in which something may change up to the cutoff: days, and months begun by then."""
    last = moment(as_of).date().isoformat()
    return [slot for slot in slots if slot != "none" and slot <= last]


def refresh(book: Book, T: Tables, as_of: datetime | str, run: str, changed: DataFrame | None = None) -> int:
    """Move the state on to a later cutoff.

    ``T`` holds the tables as they are now; ``changed`` names every invoice (``tx_invoice_id``) that
    was added, removed or altered since the last refresh, be it in its own row, its ledger lines, its
    request or its role.
    """
    as_of = moment(as_of)
    edit = book.edit(run)
    if edit.done:
        return edit.publish()
    before = edit.tables[CUTOFF].first()["as_of"]
    if as_of < before:
        raise ValueError(f"the state stands at {before}, after {as_of}")
    slots = due_slots(edit.state[ITEMS].units, as_of)
    old = edit.rows_in(ITEMS, slots)
    others: list[str] = []
    fresh = old
    if changed is not None:
        changed = stored(keys_of(changed, "tx_invoice_id"), "changed-invoices")
        others = [slot for slot in edit.units_of(ITEMS, "tx_invoice_id", changed) if slot not in slots]
        altered = edit.rows_in(ITEMS, others).join(changed, "tx_invoice_id", "left_semi").select(*old.columns)
        fresh = old.join(changed, "tx_invoice_id", "left_anti").select(*old.columns)
        old = old.unionByName(altered)
    fresh = _aged(fresh, as_of)
    if changed is not None:
        fresh = fresh.unionByName(_aged(open_items(T, changed), as_of))
    moved = stored(
        old.withColumn("sign", F.lit(-1)).unionByName(fresh.withColumn("sign", F.lit(1))), "aging-moves", by=["sign"]
    )
    if others:
        edit.rewrite(ITEMS, others, lambda rows: rows.join(changed, "tx_invoice_id", "left_anti").select(*rows.columns))
    edit.swap(ITEMS, slots, moved.where("sign = 1").drop("sign"))
    edit.combine(SUMS, _sums(moved, F.col("sign")), _added)
    edit.replace(CUTOFF, _cutoff(T, as_of))
    return edit.publish()


def snapshot(book: Book, version: int | None = None) -> DataFrame:
    """The aging rows of the state, as ``aging.ar_aging`` gives them for its cutoff."""
    rows = book.tables(version)[SUMS]
    past = sum((F.col(name) for name in OPEN_BUCKETS[2:]), F.col(OPEN_BUCKETS[1]))
    return rows.select(
        *KEYS,
        *[money(name).alias(name) for name in OPEN_BUCKETS],
        money(past + F.col(OPEN_BUCKETS[0])).alias("total_due"),
        money(past).alias("total_past_due"),
        money(F.when(F.col("credit_items") > 0, F.col("credit"))).alias("acct_credit"),
    )
