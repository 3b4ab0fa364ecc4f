from __future__ import annotations

from decimal import Decimal

import pytest
from duesmith.operators import aging, ledger, summary
from duesmith.sources import snapshots
from duesmith.sources.workspace import new_folder
from frames import as_set, bundle, tx
from pyspark.sql import functions as F

AS_OF = "2014-04-01 00:00:00"
ROLE = dict(party_role_id=2, party_id=2, role_id="m", party_role_type_id=1, business_unit_id=1)
UNIT = dict(business_unit_id=1, name="u", time_zone_name="UTC")
HOLDER = dict(client_account_id=7, party_id=2, primary_party=True)


def invoice(id_, date, due=None, **more):
    return dict(
        tx_invoice_id=id_, client_account_id=7, party_role_id=2, target_business_unit_id=1,
        target_date=date, target_date_utc=date, payment_due_date=due, **more,
    )


def books(spark, *dates, **more):
    return bundle(
        spark, party_role=[ROLE], business_unit=[UNIT], client_account_party=[HOLDER],
        tx_invoice=[invoice(n, date, date) for n, date in enumerate(dates)],
        tx_transaction=[tx(n, n) for n, _ in enumerate(dates)], **more,
    )


def charges(df):
    return {row["range"]: row.charges for row in df.collect()}


@pytest.mark.parametrize(
    ("bounds", "date_col", "counts"),
    [
        # 30 days back exactly lies in no strict range, in one half-open range, in one inclusive range.
        ("strict", "target_date_utc", (None, None)),
        ("half_open", "target_date_utc", (Decimal(10), None)),
        ("inclusive_1m", "payment_due_date", (None, Decimal(10))),
    ],
)
def test_bucket_edges(spark, bounds, date_col, counts):
    T = books(spark, "2014-03-02 00:00:00")
    found = charges(aging.account_aging(T, None, AS_OF, date_col, bounds))
    strict_second = Decimal(10) if bounds == "strict" else counts[1]
    # The 1 ms shift lets the second strict range reach the edge itself.
    assert (found["30 Day"], found["60 Day"]) == (counts[0], strict_second)


def test_inclusive_ranges_overlap_by_a_minute(spark):
    T = books(spark, "2014-03-02 00:00:30")
    found = charges(aging.account_aging(T, None, AS_OF, "payment_due_date", "inclusive_1m"))
    assert found["30 Day"] == found["60 Day"] == 10


def test_half_open_ranges_are_complete_and_disjoint(spark):
    T = books(spark, "2014-03-02 00:00:00", "2014-01-31 00:00:00", "2014-01-01 00:00:00", "2010-01-01 00:00:00")
    found = charges(aging.account_aging(T, None, AS_OF, bounds="half_open", zero_fill=True))
    assert sum(found[label] for label in ("30 Day", "60 Day", "90 Day", "90+")) == found["Total"] == 40


def test_cutoff_follows_the_unit_zone(spark):
    late = dict(UNIT, time_zone_name="America/New_York")
    T = books(spark, "2014-04-01 03:00:00").replace(
        business_unit=bundle(spark, business_unit=[late]).business_unit
    )
    assert charges(aging.account_aging(T, None, AS_OF))["30 Day"] == 10
    assert charges(aging.account_aging(books(spark, "2014-04-01 03:00:00"), None, AS_OF))["30 Day"] is None


def test_one_sided_balance_is_null_unless_filled(spark):
    T = books(spark, "2014-03-20 00:00:00")
    total = aging.account_aging(T, None, AS_OF).where("range = 'Total'").first()
    assert (total.charges, total.payments, total.balance) == (10, None, None)
    filled = aging.account_aging(T, None, AS_OF, zero_fill=True).where("range = 'Total'").first()
    assert filled.balance == 10


def test_accounts_without_invoices_still_answer(spark):
    T = books(spark)
    assert aging.account_aging(T, None, AS_OF).count() == 5
    assert as_set(ledger.account_total(T), "account_id", "balance") == {(7, None)}


def test_only_the_asked_parties(spark):
    other = spark.createDataFrame([(99,)], "party_id long")
    assert aging.account_aging(books(spark, "2014-03-20 00:00:00"), other, AS_OF).count() == 0


def test_aging_buckets_and_credit(spark):
    T = books(spark, "2014-03-31 00:00:00", "2014-02-20 00:00:00", "2013-01-01 00:00:00").replace(
        tx_transaction=bundle(
            spark, tx_transaction=[tx(1, 0, amount=5), tx(2, 1, amount=7), tx(3, 2, amount=4, credit=True)]
        ).tx_transaction
    )
    row = aging.ar_aging(T, AS_OF).first()
    assert (row.aging_30, row.aging_60, row.aging_over_120) == (5, 7, 0)
    assert (row.total_due, row.total_past_due, row.acct_credit, row.member_agreement_id) == (12, 12, 4, None)


def test_zero_fill_is_by_home_unit(spark):
    T = books(spark, "2014-03-31 00:00:00").replace(
        member_agreement=bundle(
            spark, member_agreement=[dict(member_agreement_id=1, party_role_id=2)]
        ).member_agreement
    )
    aged = aging.ar_aging(T, AS_OF)
    assert aging.zero_fill(aged, T).count() == 1
    elsewhere = aged.withColumn("business_unit_id", F.lit(8))
    assert aging.zero_fill(elsewhere, T).count() == 2


def test_snapshot_replaces_named_units_even_by_nothing(spark, small):
    aged = aging.ar_aging(small, "2000-01-01")
    first, second = new_folder(spark, "snap"), new_folder(spark, "snap")
    old = snapshots.refresh_snapshot(first, aged, "2000-01-01")
    units = sorted(row[0] for row in old.select("business_unit_id").distinct().collect())
    gone, kept = units[0], units[1:]
    new = snapshots.refresh_snapshot(
        second, aged.where(F.col("business_unit_id") != gone), "2000-02-01", previous=first, units=units[:2]
    )
    assert sorted(row[0] for row in new.select("business_unit_id").distinct().collect()) == kept
    stamps = {row[0]: str(row[1]) for row in new.select("business_unit_id", "aged_date").distinct().collect()}
    assert stamps[units[1]] == "2000-02-01" and stamps[units[2]] == "2000-01-01"
    with pytest.raises(Exception, match="(?i)already exists"):
        snapshots.refresh_snapshot(first, aged, "2000-01-01")


def test_due_buckets_match_item_by_item_rebase(small):
    as_of = "2000-01-01 00:00:00"
    due = aging.transactions_due(small, as_of)
    by_party = aging.party_due_buckets(due, small, as_of).agg(F.sum("balance")).first()[0]
    one_by_one = (
        aging.rebase_due(due, small).where(F.col("target_date_utc") < as_of).agg(F.sum("due_amount")).first()[0]
    )
    assert by_party == one_by_one


def test_decline_rules(spark):
    rows = [
        dict(tx_transaction_id=1, tx_payment_id=1, is_payment_declined=False),
        dict(tx_transaction_id=2, tx_payment_id=2, is_payment_declined=True, decline_tx_payment_id=9),
        dict(tx_transaction_id=3, tx_payment_id=3, is_payment_declined=True),
        dict(tx_transaction_id=4, tx_payment_id=4, is_payment_declined=True),
        dict(tx_transaction_id=5, tx_payment_id=None, is_payment_declined=None),
    ]
    T = bundle(
        spark,
        billing_service_tx=rows,
        tx_payment=[dict(tx_payment_id=30, target_date_utc="2014-01-15 00:00:00"),
                    dict(tx_payment_id=40, target_date_utc="2015-01-15 00:00:00")],
        payment_process_request=[dict(payment_process_request_id=1, tx_payment_id=30),
                                 dict(payment_process_request_id=2, tx_payment_id=40)],
        payment_process_response=[dict(payment_process_request_id=1, decline_tx_payment_id=3),
                                  dict(payment_process_request_id=2, decline_tx_payment_id=4)],
    )
    start, end = F.lit("2014-01-01").cast("timestamp_ntz"), F.lit("2014-02-01").cast("timestamp_ntz")
    kept = summary.keep_reportable(T.billing_service_tx, T, start, end)
    assert as_set(kept, "tx_transaction_id") == {(1,), (2,), (3,)}


def test_property_tests_survive_bad_text(spark):
    T = bundle(spark, party_property=[
        dict(party_role_id=1, type_id=2, value="12.50"),
        dict(party_role_id=2, type_id=2, value="n/a"),
        dict(party_role_id=3, type_id=2, value="-4"),
        dict(party_role_id=4, type_id=3, value="2013-06-26"),
        dict(party_role_id=5, type_id=3, value="soon"),
    ])
    assert as_set(summary.property_holders(T, 2, positive=True), "party_role_id") == {(1,)}
    assert as_set(summary.property_holders(T, 3, dates=("2013-06-26", "2013-06-27")), "party_role_id") == {(4,)}
    assert as_set(summary.property_holders(T, 2, like="%a%"), "party_role_id") == {(2,)}
    assert as_set(summary.property_holders(T, 2, equals=["-4"]), "party_role_id") == {(3,)}


def test_billing_base_by_batch(spark):
    T = bundle(spark, billing_service_tx=[
        dict(tx_transaction_id=1, gateway_batch_id=5, payment_process_batch_id=1),
        dict(tx_transaction_id=2, gateway_batch_id=5),
        dict(tx_transaction_id=3, gateway_batch_id=6, payment_process_batch_id=1),
    ])
    base = summary.billing_base(T.billing_service_tx, "UTC", AS_OF, AS_OF, batched_only=True, gateway_batch=5)
    assert as_set(base, "tx_transaction_id") == {(1,)}


def test_results_do_not_depend_on_partition_count(spark, small):
    def answer():
        rows = aging.party_due_buckets(aging.transactions_due(small, "2000-01-01"), small, "2000-01-01").collect()
        return sorted(map(str, rows))

    first = answer()
    spark.conf.set("spark.sql.shuffle.partitions", "33")
    try:
        assert answer() == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_tables_from_parquet_keep_the_declared_schema(spark, small):
    from duesmith.sources.tables import Tables

    root = new_folder(spark, "books")
    for name in ("tx_transaction", "tx_invoice"):
        small[name].write.parquet(f"{root}/{name}")
    T = Tables.from_parquet(spark, root)
    assert T.tx_transaction.columns == small.tx_transaction.columns
    assert ledger.invoice_balance(T.tx_transaction).exceptAll(ledger.invoice_balance(small.tx_transaction)).count() == 0
    with pytest.raises(KeyError):
        T["no_such_table"]


def test_bucketed_ledger_sums_and_joins_without_a_shuffle(spark, small):
    from duesmith.sources.layout import from_catalog, save_bucketed

    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed_books")
    try:
        save_bucketed(small, "bucketed_books", new_folder(spark, "buckets"), 4, ("tx_invoice", "tx_transaction"))
        T = from_catalog(spark, "bucketed_books")
        joined = ledger.invoice_balance(T.tx_transaction).join(T.tx_invoice, "tx_invoice_id")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = joined._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        expected = ledger.invoice_balance(small.tx_transaction)
        assert ledger.invoice_balance(T.tx_transaction).exceptAll(expected).count() == 0
    finally:
        spark.sql("DROP DATABASE bucketed_books CASCADE")
