"""Balances over the transaction ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duesmith.functions.money import money, signed, sum_where
from duesmith.functions.relations import keys_of
from duesmith.schema import ROLE_MEMBER, TX_SALE
from duesmith.sources.tables import Tables


def invoice_charges(tx: DataFrame) -> DataFrame:
    """Charges and credits of each invoice.

    Summing here, before any join, lets the map side collapse invoices that hold
    very many transactions.
    """
    credit = F.col("is_accounting_credit")
    return tx.groupBy("tx_invoice_id").agg(
        sum_where(~credit).alias("charges"), sum_where(credit).alias("payments")
    )


def invoice_balance(tx: DataFrame) -> DataFrame:
    """Signed net of each invoice: charges count up, credits down."""
    return tx.groupBy("tx_invoice_id").agg(money(F.sum(signed())).alias("balance"))


def lines_of(tx: DataFrame, invoices: DataFrame) -> DataFrame:
    """Ledger lines of the given invoices alone, for sums that need no others."""
    return tx.join(keys_of(invoices, "tx_invoice_id"), "tx_invoice_id", "left_semi")


def accounts_of(T: Tables, parties: DataFrame | None = None) -> DataFrame:
    """Client accounts held by the parties; by default, of every member."""
    if parties is None:
        parties = T.party_role.where(F.col("party_role_type_id") == ROLE_MEMBER)
    held = T.client_account_party.join(keys_of(parties, "party_id"), "party_id", "left_semi")
    return keys_of(held, "client_account_id")


def account_total(T: Tables, parties: DataFrame | None = None) -> DataFrame:
    """All charges less all credits of each account."""
    accounts = accounts_of(T, parties)
    invoices, tx = T.tx_invoice.select("tx_invoice_id", "client_account_id"), T.tx_transaction
    if parties is not None:
        invoices = invoices.join(accounts, "client_account_id", "left_semi")
        tx = lines_of(tx, invoices)
    totals = (
        invoices.join(invoice_charges(tx), "tx_invoice_id")
        .groupBy("client_account_id")
        .agg(F.sum("charges").alias("charges"), F.sum("payments").alias("payments"))
    )
    return accounts.join(totals, "client_account_id", "left").select(
        F.col("client_account_id").alias("account_id"),
        money("charges").alias("charges"),
        money("payments").alias("payments"),
        money(F.col("charges") - F.col("payments")).alias("balance"),
    )


def amounts_by_group(base: DataFrame, tx_type: int) -> DataFrame:
    """Distinct (invoice, group, amount) of one transaction type."""
    return (
        base.where(F.col("tx_type_id") == tx_type)
        .select("tx_invoice_id", "group_id", money("amount").alias("amount"))
        .distinct()
    )


def first_sale_item(T: Tables, groups: DataFrame | None = None) -> DataFrame:
    """Item of the earliest sale transaction in each (invoice, group), or of those in ``groups``."""
    sales = T.tx_transaction.where(F.col("tx_type_id") == TX_SALE)
    if groups is not None:
        keys = ["tx_invoice_id", "group_id"]
        sales = sales.join(keys_of(groups, *keys), keys, "left_semi")
    first = (
        sales.groupBy("tx_invoice_id", "group_id")
        .agg(F.min_by("item_id", "tx_transaction_id").alias("sale_item_id"))
    )
    item = T.item.select(
        F.col("item_id").alias("sale_item_id"),
        F.col("upc").alias("sale_item_code"),
        F.col("name").alias("sale_item"),
    )
    return first.join(item, "sale_item_id", "left").select(
        "tx_invoice_id", "group_id", "sale_item_id", "sale_item_code", "sale_item"
    )


def active_agreement_count(agreements: DataFrame, statuses: Sequence[int]) -> DataFrame:
    """How many agreements count as active."""
    return agreements.where(F.col("status").isin(*statuses)).agg(F.count("*").alias("active"))
