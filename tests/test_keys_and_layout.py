"""Rows that joins could lose, key lists below the sums, stored layouts and work folders."""

from __future__ import annotations

import glob
import os
import re

import pytest
from frames import as_set, bundle, tx

from duesmith.functions.relations import key_list
from duesmith.operators import aging, ledger, link_defects, payment_defects, removal, schedule_defects, summary
from duesmith.schema import ROLE_MEMBER
from duesmith.sources import layout, snapshots, workspace

AS_OF = "2014-04-01 00:00:00"


def _due(spark):
    return bundle(
        spark,
        client_account_party=[dict(client_account_id=1, party_id=7, primary_party=True)],
        business_unit=[dict(business_unit_id=1, name="one", time_zone_name="UTC")],
        tx_invoice=[
            dict(tx_invoice_id=i, client_account_id=1, target_business_unit_id=unit, target_date="2014-03-20",
                 target_date_utc="2014-03-20")
            for i, unit in ((1, 1), (2, 99), (3, None))
        ],
        tx_transaction=[tx(i, i, amount=10 * i) for i in (1, 2, 3)],
        invoice_request=[dict(invoice_request_id=i, tx_invoice_id=i) for i in (1, 2, 3)],
        payment_request=[
            dict(payment_request_id=i, invoice_request_id=i, due_date_utc="2014-01-10") for i in (1, 2, 3)
        ],
        payment_request_item=[
            dict(payment_request_item_id=i, payment_request_id=i, fixed_amount=5) for i in (1, 2, 3)
        ],
    )


def test_due_rows_of_unknown_units_keep_amount_and_date(spark):
    T = _due(spark)
    due = aging.transactions_due(T, AS_OF)
    rebased = aging.rebase_due(due, T)
    assert rebased.columns == due.columns
    rows = {r["tx_transaction_id"]: (float(r["due_amount"]), str(r["target_date_utc"])[:10]) for r in rebased.collect()}
    assert rows == {1: (5.0, "2014-01-10"), 2: (20.0, "2014-03-20"), 3: (30.0, "2014-03-20")}
    (bucket,) = aging.party_due_buckets(due, T, AS_OF).collect()
    assert (bucket["zero_to_thirty"], bucket["sixty_one_to_ninety"], bucket["balance"]) == (50, 5, 55)


def test_duplicates_without_a_due_date_are_ranked(spark):
    T = bundle(
        spark,
        payment_request=[
            dict(payment_request_id=i, invoice_request_id=1 + i // 3, status=1, due_date_utc=None) for i in (1, 2, 3)
        ],
    )
    found = schedule_defects.dup_payment_requests(T.payment_request)
    ranked = schedule_defects.rank_duplicates(T.payment_request, found)
    assert as_set(ranked, "payment_request_id", "position") == {(1, 1), (2, 2)}


def _snapshot_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "business_unit_id int, client_account_id bigint")


def test_partial_refresh_keeps_what_it_does_not_name(spark, tmp_path):
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    snapshots.refresh_snapshot(first, _snapshot_rows(spark, (1, 10), (2, 20), (None, 30)), AS_OF)
    later = _snapshot_rows(spark, (1, 11), (1, 12), (2, 99))
    got = snapshots.refresh_snapshot(second, later, "2014-05-01", previous=first, units=[1])
    assert as_set(got, "business_unit_id", "client_account_id") == {(1, 11), (1, 12), (2, 20), (None, 30)}
    assert {os.path.basename(p) for p in glob.glob(f"{second}/rows/business_unit_id=*")} == {"business_unit_id=1"}
    third = snapshots.refresh_snapshot(
        str(tmp_path / "third"), later.limit(0), "2014-06-01", previous=second, units=[1, 2]
    )
    assert as_set(third, "business_unit_id", "client_account_id") == {(None, 30)}
    with pytest.raises(ValueError):
        snapshots.refresh_snapshot(str(tmp_path / "fourth"), later, AS_OF, units=[1])


def _ledger_is_reduced_first(df) -> bool:
    """Whether every sum or first value over the ledger stands above a semi-join of it."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()

    def depth(line):
        return len(line) - len(line.lstrip(" :+-"))

    for n, line in enumerate(lines):
        if "Relation" in line and "is_accounting_credit" in line:
            above = []
            for before in reversed(lines[:n]):
                if not above and depth(before) < depth(line) or above and depth(before) < depth(above[-1]):
                    above.append(before)
            kinds = [x.strip(" :+-") for x in above]
            aggregates = [i for i, x in enumerate(kinds) if x.startswith("Aggregate") and re.search(r"sum\(|min_?by\(", x)]
            joins = [i for i, x in enumerate(kinds) if x.startswith("Join LeftSemi")]
            if aggregates and not (joins and joins[0] < aggregates[0]):
                return False
    return True


def test_key_lists_reach_the_ledger_before_it_is_summed(small, spark, tmp_path):
    from duesmith.sources.tables import Tables

    names = ("tx_transaction", "tx_invoice", "client_account_party", "party_role", "business_unit", "invoice_request",
             "tx_payment", "tender_type")
    for name in names:
        small[name].write.parquet(f"{tmp_path}/{name}")
    T = Tables.from_parquet(spark, str(tmp_path))
    parties = T.party_role.where(f"party_role_type_id = {ROLE_MEMBER} AND party_id % 7 = 0")
    assert _ledger_is_reduced_first(aging.account_aging(T, parties, "2000-01-01"))
    assert _ledger_is_reduced_first(ledger.account_total(T, parties))
    assert _ledger_is_reduced_first(aging.ar_aging(T, "2000-01-01", account=40))
    assert _ledger_is_reduced_first(link_defects.multi_invoice_exposure(T))
    assert _ledger_is_reduced_first(payment_defects.cash_overcredited(T, (1, 2)))
    assert _ledger_is_reduced_first(ledger.first_sale_item(T.replace(item=small.item), T.tx_transaction.limit(5)))
    assert not _ledger_is_reduced_first(ledger.account_total(T, None))


def test_removal_of_a_payment_over_many_invoices_makes_no_pairs(spark):
    n = 1000
    T = bundle(
        spark,
        tx_payment=[dict(tx_payment_id=1)],
        tx_invoice=[dict(tx_invoice_id=i) for i in range(n)],
        tx_transaction=[tx(i, i, kind=4, item_id=1) for i in range(n)],
        payment_request=[dict(payment_request_id=i, tx_payment_id=1) for i in range(n)],
        payment_process_request=[dict(payment_process_request_id=i, tx_payment_id=1) for i in range(n)],
    )
    plan = removal.removal_plan(T, T.tx_invoice, protect=False)
    counts = {r["table_name"]: r["count"] for r in plan.groupBy("table_name").count().collect()}
    assert counts == {"payment_request": n, "payment_process_request": n, "tx_payment": 1, "tx_transaction": n, "tx_invoice": n}
    blocked = removal.blocked_invoices(T, T.tx_invoice)
    assert blocked.count() == n
    assert removal.removal_plan(T, T.tx_invoice).count() == 0


def test_one_file_for_each_bucket(spark, small, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.sql("CREATE DATABASE IF NOT EXISTS bucket_files")
    try:
        layout.save_bucketed(small, "bucket_files", str(tmp_path), 4, tables=("tx_invoice",))
        assert len(glob.glob(f"{tmp_path}/tx_invoice/part-*")) == 4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.sql("DROP DATABASE bucket_files CASCADE")


def test_a_window_reads_its_months_only(spark, small, tmp_path):
    path = str(tmp_path / "months")
    layout.save_by_month(small.tx_invoice, "target_date", path)
    window = "1998-02-10 00:00:00", "1998-04-03 00:00:00"
    rows = layout.read_months(spark, path, "target_date", *window)
    expected = small.tx_invoice.where(f"target_date >= '{window[0]}' AND target_date < '{window[1]}'")
    assert as_set(rows, "tx_invoice_id") == as_set(expected, "tx_invoice_id")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_literal_keys(spark, small):
    assert as_set(key_list(spark, "party_id", [3, 3, 5]), "party_id") == {(3,), (5,)}
    got = ledger.account_total(small, key_list(spark, "party_id", [14]))
    assert got.count() == ledger.accounts_of(small, key_list(spark, "party_id", [14])).count()


def test_results_in_order_on_request(small):
    rows = payment_defects.overpaid(small, ordered=True).collect()
    keys = [(r["target_date"], r["tx_invoice_id"]) for r in rows]
    assert keys == sorted(keys)
    ordered = summary.billing_summary(small, "1998-01-01 00:00:00", "1999-01-01 00:00:00", ordered=True)
    plan = ordered._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Sort")


def test_work_folders_are_deleted_on_request(spark):
    kept = workspace.stored(spark.range(3), "kept")
    path = workspace._made[spark.sparkContext.applicationId][-1].removeprefix("file:")
    assert kept.count() == 3 and os.path.isdir(path)
    workspace.clear_work(spark)
    assert not os.path.exists(path)
