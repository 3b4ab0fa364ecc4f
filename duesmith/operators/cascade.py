"""Cascade delete of agreements: which rows go, what is left, what is re-priced."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duesmith.functions.money import money, signed
from duesmith.functions.relations import keys_of, union_all
from duesmith.operators.changes import ChangeSet, apply_all
from duesmith.operators.ledger import lines_of
from duesmith.schema import (
    ENTITY_AGREEMENT, ENTITY_INVOICE, ROLE_MEMBER, SUSPENSION_OF_AGREEMENT, TX_PAYMENT, TX_TENDER,
)
from duesmith.sources.book import Book
from duesmith.sources.tables import Tables
from duesmith.sources.workspace import side_by_side, stored


@dataclass(frozen=True)
class Step:
    """Rows of ``table`` go when ``link`` names a key of ``parent`` that goes."""

    table: str
    parent: str
    link: str

    @property
    def key(self) -> str:
        return key_of(self.table)


def key_of(table: str) -> str:
    return f"{table}_id"


# In deletion order.  Parents named "@..." are key sets of the Cascade.
STEPS = (
    Step("activity_time_log", "activity_transaction", "activity_transaction_id"),
    Step("activity_transaction", "activity", "activity_id"),
    Step("activity", "@item_transactions", "tx_transaction_id"),
    Step("tx_transaction", "@invoices", "tx_invoice_id"),
    Step("payment_process_validation", "payment_process_request", "payment_process_request_id"),
    Step("payment_process_response", "payment_process_request", "payment_process_request_id"),
    Step("payment_process_request", "@payments", "tx_payment_id"),
    Step("payment_process_error", "@empty_batches", "payment_process_batch_id"),
    Step("payment_process_batch", "@empty_batches", "payment_process_batch_id"),
    Step("tx_payment", "@emptied_payments", "tx_payment_id"),
    Step("tx_invoice", "@invoices", "tx_invoice_id"),
    Step("fc_tx_transaction", "fc_tx_invoice", "fc_tx_invoice_id"),
    Step("fc_tx_payment", "@payments", "original_tx_payment_id"),
    Step("fc_tx_invoice", "@invoices", "original_tx_invoice_id"),
    Step("suspension_end_date", "suspension", "suspension_id"),
    Step("suspension", "@suspensions", "suspension_id"),
    Step("cancellation_detail", "cancellation", "cancellation_id"),
    Step("cancellation", "@cancellations", "cancellation_id"),
    Step("member_agreement_sales_adviser", "@agreements", "member_agreement_id"),
    Step("payment_request_item", "payment_request", "payment_request_id"),
    Step("payment_request", "@requests", "invoice_request_id"),
    Step("invoice_request_item", "@requests", "invoice_request_id"),
    Step("invoice_request", "@agreements", "member_agreement_id"),
    Step("member_agreement_item_perpetual_pay_source", "member_agreement_item_perpetual",
         "member_agreement_item_perpetual_id"),
    Step("member_agreement_item_pay_source", "member_agreement_item", "member_agreement_item_id"),
    Step("member_agreement_item_perpetual", "member_agreement_item", "member_agreement_item_id"),
    Step("member_agreement_group_restriction_agreements", "member_agreement_group_restriction",
         "member_agreement_group_restriction_id"),
    Step("member_agreement_group_restriction_promotions", "member_agreement_group_restriction",
         "member_agreement_group_restriction_id"),
    Step("member_agreement_group_restriction", "@groups", "member_agreement_group_id"),
    Step("member_agreement_group_role", "@groups", "member_agreement_group_id"),
    Step("member_agreement_group_rule", "@groups", "member_agreement_group_id"),
    Step("member_agreement_group", "@groups", "member_agreement_group_id"),
    Step("member_agreement_item", "@agreements", "member_agreement_id"),
    Step("member_agreement_payment_plan_item", "member_agreement_payment_plan", "member_agreement_payment_plan_id"),
    Step("member_agreement_payment_plan", "@agreements", "member_agreement_id"),
    Step("promotion_effect_application", "promotion_effect", "promotion_effect_id"),
    Step("promotion_effect", "member_agreement_promotion", "member_agreement_promotion_id"),
    Step("member_agreement_promotion", "@agreements", "member_agreement_id"),
    Step("member_agreement", "@agreements", "member_agreement_id"),
)
PROMOTION_TABLES = ("promotion_effect_application", "promotion_effect", "member_agreement_promotion")
_STEP_OF = {step.table: step for step in STEPS}


def agreements_of_members(T: Tables, role_ids: DataFrame) -> DataFrame:
    """Agreements of the members with the given role ids."""
    roles = T.party_role.where(F.col("party_role_type_id") == ROLE_MEMBER).join(
        keys_of(role_ids, "role_id"), "role_id", "left_semi"
    )
    return T.member_agreement.join(keys_of(roles, "party_role_id"), "party_role_id", "left_semi").select(
        "member_agreement_id"
    )


#: What sets carry besides their keys.
_EXTRAS = {"tx_invoice_id": "bigint", "staying": "bigint", "net": "decimal(18,2)"}


@dataclass(frozen=True)
class _Set:
    """Rows with the column that is their key, and what else is kept of them."""

    rows: DataFrame
    key: str
    extras: tuple[str, ...] = ()

    def tagged(self, name: str) -> DataFrame:
        """The columns of every set, so that sets can be stored together; one projection, one analysis."""
        extras = [
            (F.col(extra) if extra in self.extras else F.lit(None)).cast(kind).alias(extra)
            for extra, kind in _EXTRAS.items()
        ]
        return self.rows.select(F.col(self.key).cast("bigint").alias("row_key"), *extras, F.lit(name).alias("belongs"))


class Cascade:
    """The rows that go with some agreements, all taken from the tables as they stand.

    Tables hang on each other in levels.  One job for each level finds the keys of all its tables and
    of the key sets that steps start from ("@..."), and stores them in one folder, tagged by where
    they belong; the next level reads what it needs from there.  So no branch computes a set again,
    and a lost executor costs no more than its own tasks.  Nothing is computed before it is asked for.
    """

    def __init__(self, T: Tables, agreements: DataFrame, promotions: bool = True):
        self.T = T
        self._agreements = agreements
        # The oldest form of the cascade knew no promotion tables.
        self.steps = STEPS if promotions else tuple(s for s in STEPS if s.table not in PROMOTION_TABLES)
        #: The level that holds the rows of a table or set.
        self._found: dict[str, int] = {}
        self._levels: list[DataFrame] = []

    # --- the sets that steps start from ---

    def _sets(self) -> dict[str, tuple[tuple[str, ...], Callable[[], _Set]]]:
        """For each set what it needs, and its rows."""
        return {
            "@agreements": ((), lambda: _Set(keys_of(self._agreements, "member_agreement_id"), "member_agreement_id")),
            "@item_transactions": (("invoice_request",), self._item_transactions),
            "@touched": (("@item_transactions",), self._touched),
            "@payments": (("@touched", "@item_transactions"), self._payments),
            "@batches": (("@payments",), self._batches),
            "@empty_batches": (("@batches", "@payments"), self._empty_batches),
            "@suspensions": (("@agreements",), self._suspensions),
            "@cancellations": (("@agreements", "@item_transactions"), self._cancellations),
            "@groups": (("@agreements",), self._groups),
        }

    def _item_transactions(self) -> _Set:
        """Existing transactions of the agreements' request items, with their invoice."""
        requests = self._keys("invoice_request", "invoice_request_id")
        items = self.T.invoice_request_item.join(requests, "invoice_request_id", "left_semi")
        rows = self.T.tx_transaction.select("tx_transaction_id", "tx_invoice_id").join(
            keys_of(items, "tx_transaction_id"), "tx_transaction_id", "left_semi"
        )
        return _Set(rows, "tx_transaction_id", ("tx_invoice_id",))

    def _invoices(self) -> DataFrame:
        return keys_of(self._rows("@item_transactions"), "tx_invoice_id")

    def _paying(self) -> DataFrame:
        return self.T.tx_transaction.where(F.col("tx_type_id").isin(TX_PAYMENT, TX_TENDER))

    def _touched(self) -> _Set:
        return _Set(keys_of(lines_of(self._paying(), self._invoices()), "item_id"), "item_id")

    def _payments(self) -> _Set:
        """Each touched payment with the count and signed net of its rows that stay.

        A payment may cover invoices that stay, so its lines are taken by payment, not by invoice.
        """
        going = self._invoices().withColumn("going", F.lit(True))
        stays = F.col("going").isNull()
        state = (
            self._paying()
            .join(self._keys("@touched", "item_id"), "item_id", "left_semi")
            .join(going, "tx_invoice_id", "left")
            .groupBy("item_id")
            .agg(F.count(F.when(stays, 1)).alias("staying"), money(F.sum(F.when(stays, signed()))).alias("net"))
        )
        return _Set(state, "item_id", ("staying", "net"))

    def _batches(self) -> _Set:
        payments = self._keys("@payments", "tx_payment_id")
        touched = self.T.payment_process_request.join(payments, "tx_payment_id", "left_semi")
        return _Set(keys_of(touched, "payment_process_batch_id"), "payment_process_batch_id")

    def _empty_batches(self) -> _Set:
        """Existing batches that lose a request and keep none."""
        going = self._keys("@payments", "tx_payment_id").withColumn("going", F.lit(True))
        key = "payment_process_batch_id"
        emptied = (
            self.T.payment_process_request.select(key, "tx_payment_id")
            .join(self._keys("@batches", key), key, "left_semi")
            .join(going, "tx_payment_id", "left")
            .groupBy(key)
            .agg(F.count("*").alias("requests"), F.count("going").alias("going"))
            .where(F.col("going") == F.col("requests"))
        )
        return _Set(self.T.payment_process_batch.join(emptied, key, "left_semi"), key)

    def _suspensions(self) -> _Set:
        rows = self.T.suspension.where(F.col("target_entity_id_type") == SUSPENSION_OF_AGREEMENT)
        return _Set(rows.join(self._keys("@agreements", "target_entity_id"), "target_entity_id", "left_semi"), "suspension_id")

    def _cancellations(self) -> _Set:
        agreements = self._keys("@agreements", "entity_id").withColumn("entity_id_type", F.lit(ENTITY_AGREEMENT))
        invoices = self._invoices().select(
            F.col("tx_invoice_id").alias("entity_id"), F.lit(ENTITY_INVOICE).alias("entity_id_type")
        )
        named = agreements.unionByName(invoices)
        return _Set(self.T.cancellation.join(named, ["entity_id", "entity_id_type"], "left_semi"), "cancellation_id")

    def _groups(self) -> _Set:
        """Groups that one of the agreements owns."""
        owned = self.T.member_agreement_group_role.where(F.col("role_type") == 1).join(
            self._keys("@agreements", "member_agreement_id"), "member_agreement_id", "left_semi"
        )
        return _Set(keys_of(owned, "member_agreement_group_id"), "member_agreement_group_id")

    # --- levels ---

    def _needs(self, name: str) -> tuple[str, ...]:
        if name in _STEP_OF:
            parent = _STEP_OF[name].parent
            return ({"@emptied_payments": "@payments", "@invoices": "@item_transactions"}.get(parent, parent),)
        return self._sets()[name][0]

    def _build(self, name: str) -> _Set:
        if name not in _STEP_OF:
            return self._sets()[name][1]()
        step = _STEP_OF[name]
        if step.parent == "@invoices":
            parents = self._invoices().withColumnRenamed("tx_invoice_id", step.link)
        elif step.parent == "@emptied_payments":
            parents = self._rows("@payments").where(F.col("staying") == 0).select(F.col("row_key").alias(step.link))
        else:
            parents = self._keys(step.parent, step.link)
        return _Set(self.T[name].join(parents, step.link, "left_semi"), step.key)

    def _rows(self, name: str) -> DataFrame:
        if name == "@requests":  # the doomed requests under another name
            name = "invoice_request"
        if name not in self._found:
            self.find(name)
        rows = self._levels[self._found[name]]
        return rows.where(F.col("belongs") == name)

    def _keys(self, name: str, column: str) -> DataFrame:
        return self._rows(name).select(F.col("row_key").alias(column))

    def find(self, *names: str) -> None:
        """Store the rows of these tables and sets, and of all that they need, level by level."""
        level: dict[str, int] = {}

        def place(name: str) -> int:
            if name == "@requests":
                name = "invoice_request"
            if name in self._found:
                return 0
            if name not in level:
                level[name] = 1 + max((place(parent) for parent in self._needs(name)), default=0)
            return level[name]

        for name in names:
            place(name)
        for n in range(1, max(level.values(), default=0) + 1):
            here = [name for name, at in level.items() if at == n]
            tagged = [self._build(name).tagged(name) for name in here]
            self._levels.append(stored(union_all(tagged), f"cascade-level-{n}", by=["belongs"]))
            self._found |= dict.fromkeys(here, len(self._levels) - 1)

    # --- results ---

    @property
    def empty_batches(self) -> DataFrame:
        return self._keys("@empty_batches", "payment_process_batch_id")

    def doomed(self, table: str) -> DataFrame:
        """Keys of the rows of ``table`` that go."""
        return self._keys(table, key_of(table))

    def plan(self) -> DataFrame:
        """(step, table, key) of every row to delete, in dependency order."""
        self.find(*[step.table for step in self.steps])
        places = F.create_map(*[F.lit(part) for n, step in enumerate(STEPS, start=1) for part in (step.table, n)])
        names = [step.table for step in self.steps]
        parts = [
            rows.where(F.col("belongs").isin(*names)).select(
                places[F.col("belongs")].alias("step"), F.col("belongs").alias("table_name"), "row_key"
            )
            for rows in self._levels
        ]
        return union_all(parts)

    def repriced_payments(self) -> ChangeSet:
        """Amount and reversal flag of touched payments that keep transactions."""
        rows = self._rows("@payments").where(F.col("staying") > 0).select(
            F.col("row_key").alias("tx_payment_id"),
            F.abs("net").alias("amount"),
            F.when(F.col("net") < 0, False).otherwise(True).alias("is_reversal"),
        )
        return ChangeSet("tx_payment", "tx_payment_id", rows)

    def apply(self) -> Tables:
        """The bundle after the deletes and the re-pricing, from the stored levels."""
        self.find(*[step.table for step in self.steps])
        left = apply_all(self.T, self.repriced_payments())
        survivors = {
            step.table: left[step.table].join(self.doomed(step.table), step.key, "left_anti") for step in self.steps
        }
        return left.replace(**survivors)

    def apply_in(self, book: Book, run: str) -> int:
        """The same in a book: only the units that hold a row in question are written, and all tables
        change at once.  The cascade must be of the book's tables."""
        edit = book.edit(run)
        if not edit.done:
            self.find(*[step.table for step in self.steps])
            repriced = self.repriced_payments()

            def change(step: Step) -> None:
                if step.table == repriced.table:
                    edit.update(repriced)
                edit.delete(step.table, self.doomed(step.table), step.key)

            side_by_side(book.spark, change, self.steps)
        return edit.publish()
