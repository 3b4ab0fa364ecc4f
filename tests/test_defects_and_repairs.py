from __future__ import annotations

from duesmith.operators import changes, error_log, link_defects, payment_defects, repairs, schedule_defects
from duesmith.plans import defects as plans
from frames import as_set, bundle, tx
from pyspark.sql import functions as F

FROM, TO = "2014-02-01 00:00:00", "2014-03-01 00:00:00"


def request(id_, agreement=1, date="2014-02-05 00:00:00", **more):
    return dict(invoice_request_id=id_, member_agreement_id=agreement, bill_date=date, **more)


def test_double_bill_leaves_the_only_open_request(spark):
    # One invoiced and one open request, two items each: the open one is first, not surplus.
    T = bundle(
        spark,
        invoice_request=[request(1, tx_invoice_id=10), request(2)],
        invoice_request_item=[
            dict(invoice_request_item_id=i, invoice_request_id=1 + i // 2, member_agreement_item_id=i % 2) for i in range(4)
        ],
        member_agreement=[dict(member_agreement_id=1, party_role_id=2)],
        party_role=[dict(party_role_id=2, role_id="m")],
    )
    doubled = schedule_defects.double_billed(T, FROM, TO)
    assert doubled.count() == 2
    assert schedule_defects.surplus_requests(T, doubled, FROM, TO).count() == 0


def test_surplus_is_ordered_by_date_then_id(spark):
    T = bundle(spark, invoice_request=[
        request(3, date="2014-02-02 00:00:00"), request(1), request(2), request(4, date="2014-02-28 12:00:00"),
        request(5, date="2014-03-01 00:00:00"), request(6, process_type=1), request(7, agreement=2),
    ])
    doubled = spark.createDataFrame([(1,)], "member_agreement_id long")
    found = schedule_defects.surplus_requests(T, doubled, FROM, TO)
    # The last day counts in full and the window's end does not.
    assert as_set(found, "invoice_request_id", "row") == {(1, 2), (2, 3), (4, 4)}


def payment_request(id_, request_id, due="2014-02-05 00:00:00", status=0, paid=None, mark=None):
    return dict(payment_request_id=id_, invoice_request_id=request_id, due_date_utc=due, status=status,
                tx_payment_id=paid, process_type=mark)


def test_duplicates_keep_the_first_and_the_reference_stops_it(spark):
    T = bundle(spark, payment_request=[
        payment_request(1, 9, status=1), payment_request(2, 9, status=0), payment_request(3, 9, status=1, paid=5),
        payment_request(4, 9, due="2014-06-01 00:00:00"), payment_request(5, 8),
        payment_request(6, 9, mark=1),
    ])
    duplicates = schedule_defects.dup_payment_requests(T.payment_request)
    ranked = schedule_defects.rank_duplicates(T.payment_request, duplicates)
    assert as_set(ranked, "payment_request_id", "position") == {(2, 1), (1, 2), (3, 3)}
    assert as_set(repairs.stop_duplicates(T, ranked).rows, "payment_request_id") == {(1,)}
    written = schedule_defects.rank_duplicates(T.payment_request, duplicates, reference_mode=True)
    assert as_set(written, "payment_request_id", "position") == {(2, 1), (4, 2), (6, 3), (1, 4), (3, 5)}
    assert as_set(repairs.stop_duplicates(T, written, reference_mode=True).rows, "payment_request_id") == {(2,)}


def test_marking_twice_changes_nothing_more(small):
    marks = plans.surplus
    change = repairs.mark_do_not_process(small, "invoice_request", marks(small))
    after = small.replace(invoice_request=change.apply(small))
    again = repairs.mark_do_not_process(after, "invoice_request", change.rows).apply(after)
    assert again.exceptAll(after.invoice_request).count() == 0


def test_orphans_and_their_deletion(small):
    orphans = schedule_defects.orphan_items(small)
    left = changes.delete_by_keys(small.payment_request_item, orphans, "payment_request_item_id")
    assert orphans.count() > 0
    assert schedule_defects.orphan_items(small.replace(payment_request_item=left)).count() == 0


def missing_books(spark):
    return bundle(
        spark,
        payment_request_item=[
            dict(payment_request_item_id=1, payment_request_id=1, tx_transaction_id=999),
            dict(payment_request_item_id=2, payment_request_id=1, tx_transaction_id=None),
            dict(payment_request_item_id=3, payment_request_id=1, tx_transaction_id=50),
            dict(payment_request_item_id=4, payment_request_id=1, tx_transaction_id=998),
        ],
        payment_request=[dict(payment_request_id=1, invoice_request_id=1, tx_payment_id=6)],
        tx_payment=[dict(tx_payment_id=6, target_date="2014-03-05 10:00:00", amount=12)],
        payment_process_request=[
            dict(payment_process_request_id=1, tx_payment_id=6, token="MD777123"),
            dict(payment_process_request_id=2, tx_payment_id=6, token="MD777123"),
        ],
        invoice_request=[request(1, tx_invoice_id=5)],
        tx_transaction=[tx(50, 5), tx(51, 5), tx(52, 5, kind=2)],
        tx_invoice=[dict(tx_invoice_id=5, party_role_id=2)],
        party_role_status=[dict(party_role_id=2, account_status=0), dict(party_role_id=3, account_status=0)],
    )


def test_missing_transactions_are_created_once_for_each_item(spark):
    T = missing_books(spark)
    missing = link_defects.missing_payment_tx(T)
    assert as_set(missing, "payment_request_item_id", "gateway_requests", "sales") == {(1, 2, 2), (4, 2, 2)}
    assert link_defects.missing_payment_tx(T, reference_mode=True).count() == 2 * 2 * 2
    created = repairs.create_missing_tx(T, missing)
    rows = created.inserts.orderBy("link_id").collect()
    assert [(r.tx_transaction_id, r.link_id, r.display_order, r.amount) for r in rows] == [(54, 1, 4, 12), (57, 4, 4, 12)]
    assert rows[0].description == "ID: 6 | MC:7123 | Payment request due:03/05/2014"
    plain = repairs.create_missing_tx(T, missing, "plain").inserts.first()
    assert plain.description == "ID: 6| Payment request due: 2014-03-05"
    assert as_set(created.statuses.preview(T), "party_role_id", "new_account_status") == {(2, 1)}
    after = changes.apply_all(T, created.items, created.statuses).replace(
        tx_transaction=T.tx_transaction.unionByName(created.inserts)
    )
    assert link_defects.missing_payment_tx(after).count() == 0


def test_created_transactions_are_found_once_for_all_change_sets(spark):
    T = missing_books(spark)
    created = repairs.create_missing_tx(T, link_defects.missing_payment_tx(T))
    for rows in (created.inserts, created.items.rows):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan


def relink_books(spark):
    return bundle(
        spark,
        invoice_request=[
            request(1, process_type=1), request(2, tx_invoice_id=None),
            request(3, agreement=7, process_type=1), request(4, agreement=8),
        ],
        invoice_request_item=[
            dict(invoice_request_item_id=10, invoice_request_id=1, member_agreement_item_id=5, tx_transaction_id=100),
            dict(invoice_request_item_id=20, invoice_request_id=2, member_agreement_item_id=5),
            dict(invoice_request_item_id=21, invoice_request_id=2, member_agreement_item_id=6),
        ],
        tx_invoice=[dict(tx_invoice_id=50, link_type_id=4, link_id=1), dict(tx_invoice_id=51, link_type_id=2, link_id=1)],
        tx_transaction=[tx(100, 50, link_type_id=2, link_id=10), tx(101, 50, link_type_id=3, link_id=10)],
    )


def test_relink_moves_only_matched_pairs(spark):
    T = relink_books(spark)
    missing = spark.createDataFrame(
        [(1, 1, 50), (3, 7, 60)], "invoice_request_id long, member_agreement_id long, tx_invoice_id long"
    ).withColumn("bill_date", F.lit("2014-02-05 09:00:00").cast("timestamp_ntz"))
    moved = repairs.relink(T, missing)
    assert as_set(moved.requests.rows, "invoice_request_id", "tx_invoice_id") == {(2, 50)}
    assert as_set(moved.request_items.rows, "invoice_request_item_id", "tx_transaction_id") == {(20, 100)}
    assert as_set(moved.invoices.rows, "tx_invoice_id", "link_id") == {(50, 2)}
    assert as_set(moved.transactions.rows, "tx_transaction_id", "link_id") == {(100, 20)}
    after = changes.apply_all(T, moved.requests, moved.request_items, moved.invoices, moved.transactions)
    assert repairs.relink(after, missing).invoices.rows.count() == 0
    for change in (moved.requests, moved.request_items, moved.invoices, moved.transactions):
        assert change.repeated_keys().count() == 0


def test_repoints_write_one_row_for_each_key(small):
    multi = link_defects.multi_linked(small, "1995-01-01", "2002-01-01")
    for change in (
        repairs.repoint_requests(link_defects.mispointed_requests(small, multi)),
        repairs.repoint_items(link_defects.mispointed_items(small, multi)),
    ):
        assert change.rows.count() > 0
        assert change.repeated_keys().count() == 0
        assert change.apply(small).count() == small[change.table].count()


def test_mispointed_item_takes_the_smallest_other_sale(spark):
    T = bundle(
        spark,
        tx_invoice=[dict(tx_invoice_id=5, link_type_id=4, link_id=1)],
        invoice_request=[request(1, tx_invoice_id=5)],
        invoice_request_item=[
            dict(invoice_request_item_id=i, invoice_request_id=1, tx_transaction_id=target)
            for i, target in enumerate([50, 51, 99, None])
        ],
        tx_transaction=[tx(50, 5), tx(51, 5), tx(52, 5), tx(40, 5, kind=2)],
    )
    multi = spark.createDataFrame([(1,)], "invoice_request_id long")
    found = link_defects.mispointed_items(T, multi)
    assert as_set(found, "invoice_request_item_id", "sale_transaction_id", "differing_sales") == {
        (0, 51, 2), (1, 50, 2), (2, 50, 3),
    }


def test_exposure_keeps_cents_and_filters_only_on_demand(spark):
    T = bundle(
        spark,
        tx_payment=[dict(tx_payment_id=1, is_multi_invoice=True, amount=9)],
        tx_transaction=[tx(1, 5, amount="10.55"), tx(2, 5, 4, "3.20", True, item_id=1), tx(3, 6, 4, "3", True, item_id=1)],
        tx_invoice=[dict(tx_invoice_id=5, party_role_id=2, link_type_id=4, link_id=8), dict(tx_invoice_id=6, party_role_id=2)],
        party_role=[dict(party_role_id=2, role_id="m")],
    )
    assert {str(row[0]) for row in link_defects.multi_invoice_exposure(T).select("balance").collect()} == {"7.35", "-3.00"}
    assert as_set(link_defects.multi_invoice_exposure(T, min_balance=0), "tx_invoice_id") == {(5,)}


def test_overpaid_needs_both_kinds_of_payment(spark):
    T = bundle(spark, tx_transaction=[
        tx(1, 1, amount=5), tx(2, 1, 4, 4, True), tx(3, 1, 4, 4, True, link_type_id=3),   # over-paid
        tx(4, 2, amount=5), tx(5, 2, 4, 9, True),                                          # no linked payment
        tx(6, 3, 4, 9, True), tx(7, 3, 4, 9, True, link_type_id=3),                        # no charge
    ])
    assert as_set(payment_defects.overpaid_invoices(T), "tx_invoice_id", "due_amount") == {(1, 5)}


def test_error_windows_may_overlap_and_shift_by_zone(spark):
    T = bundle(spark, error_log=[
        dict(error_id=1, time_utc="2013-10-22 12:00:00", type="T", source="S", message="m"),
        dict(error_id=2, time_utc="2013-10-22 12:00:00", type="T", source=None, message="m"),
    ])
    window = ("2013-10-22 00:00:00", "2013-10-22 12:00:00")
    found = error_log.error_window(T.error_log, [window, window], exclude_source="P")
    assert as_set(found, "window_no", "error_id") == {(0, 1), (1, 1)}
    shifted = error_log.error_by_message(T.error_log, "m", window, -4).first()
    zoned = error_log.error_by_message(T.error_log, "m", window, zone="America/New_York").first()
    assert shifted.local_time == zoned.local_time
