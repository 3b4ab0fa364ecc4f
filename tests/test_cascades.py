from __future__ import annotations

from datetime import datetime

from duesmith.operators import link_defects, removal
from duesmith.operators.cascade import STEPS, Cascade, key_of
from duesmith.sources.workspace import new_folder
from frames import as_set, bundle, tx
from pyspark.sql import functions as F


def test_plan_and_survivors_split_every_table(small):
    agreements = small.member_agreement.where(F.col("status") != 5)
    cascade = Cascade(small, agreements)
    planned = {row.table_name: row.n for row in cascade.plan().groupBy("table_name").agg(F.count("*").alias("n")).collect()}
    after = cascade.apply()
    assert len(STEPS) == 39
    assert planned["tx_transaction"] > 0
    for table in ("member_agreement", "invoice_request", "tx_transaction", "tx_payment", "payment_process_request",
                  "activity_time_log", "member_agreement_group"):
        assert after[table].count() + planned.get(table, 0) == small[table].count()


def test_cascading_twice_finds_nothing(small):
    agreements = small.member_agreement.where(F.col("status") == 7)
    after = Cascade(small, agreements).apply()
    assert Cascade(after, agreements).plan().count() == 0


def test_shared_payment_is_repriced_and_sole_payment_goes(spark):
    T = bundle(
        spark,
        member_agreement=[dict(member_agreement_id=1), dict(member_agreement_id=2)],
        invoice_request=[dict(invoice_request_id=1, member_agreement_id=1)],
        invoice_request_item=[dict(invoice_request_item_id=1, invoice_request_id=1, tx_transaction_id=10)],
        tx_transaction=[
            tx(10, 1), tx(11, 1, 4, 6, True, item_id=70), tx(12, 1, 4, 6, True, item_id=71),
            tx(13, 2, 4, 9, True, item_id=70), tx(14, 1, 4, 6, True, item_id=72), tx(15, 2, 4, 2, False, item_id=72),
        ],
        tx_payment=[dict(tx_payment_id=i, amount=99, is_reversal=True) for i in (70, 71, 72)],
        payment_process_request=[
            dict(payment_process_request_id=1, payment_process_batch_id=1, tx_payment_id=70),
            dict(payment_process_request_id=2, payment_process_batch_id=2, tx_payment_id=71),
            dict(payment_process_request_id=3, payment_process_batch_id=2, tx_payment_id=80),
        ],
        payment_process_batch=[dict(payment_process_batch_id=1), dict(payment_process_batch_id=2)],
    )
    cascade = Cascade(T, spark.createDataFrame([(1,)], "member_agreement_id long"))
    after = cascade.apply()
    # A negative net is an ordinary payment, anything else a reversal.
    assert as_set(after.tx_payment, "tx_payment_id", "amount", "is_reversal") == {(70, 9, False), (72, 2, True)}
    assert as_set(cascade.empty_batches, "payment_process_batch_id") == {(1,)}
    assert as_set(after.tx_transaction, "tx_transaction_id") == {(13,), (15,)}
    assert as_set(after.member_agreement, "member_agreement_id") == {(2,)}


def removal_books(spark):
    return bundle(
        spark,
        tx_invoice=[dict(tx_invoice_id=1), dict(tx_invoice_id=2), dict(tx_invoice_id=3)],
        tx_transaction=[tx(10, 1), tx(11, 1, 4, 5, True, item_id=70), tx(20, 2), tx(30, 3)],
        tx_payment=[dict(tx_payment_id=70)],
        payment_request=[dict(payment_request_id=5, tx_payment_id=70)],
        activity=[dict(activity_id=1, tx_transaction_id=20)],
        activity_transaction=[dict(activity_transaction_id=1, activity_id=1)],
    )


def test_guard_blocks_and_unprotected_removal_clears(spark):
    T = removal_books(spark)
    targets = spark.createDataFrame([(1,), (2,)], "tx_invoice_id long")
    assert as_set(removal.blocked_invoices(T, targets), "tx_invoice_id", "referrer") == {(1, "payment_request")}
    guarded = removal.removal_plan(T, targets)
    assert as_set(guarded.where("table_name = 'tx_invoice'"), "row_key") == {(2,)}
    open_plan = removal.removal_plan(T, targets, protect=False)
    after = removal.apply_removal(T, open_plan)
    assert as_set(after.tx_invoice, "tx_invoice_id") == {(3,)}
    assert as_set(after.payment_request, "payment_request_id", "tx_payment_id") == {(5, None)}
    assert after.activity_transaction.count() == after.tx_payment.count() == 0


def test_before_images_restore_the_tables(spark, small):
    multi = link_defects.multi_linked(small, "1995-01-01", "2002-01-01")
    plan = removal.removal_plan(small, link_defects.linked_invoices(small, multi), protect=False)
    images = removal.before_images(small, plan, new_folder(spark, "images"))
    after = removal.apply_removal(small, plan)
    for table, action, _ in removal.ACTIONS:
        key = key_of(table)
        untouched = after[table].join(images[table].select(key), key, "left_anti").select(*small[table].columns)
        restored = untouched.unionByName(images[table])
        assert images[table].schema == small[table].schema or images[table].columns == small[table].columns
        assert restored.exceptAll(small[table]).count() == small[table].exceptAll(restored).count() == 0


def test_old_form_leaves_promotions(spark):
    T = bundle(
        spark,
        member_agreement=[dict(member_agreement_id=1)],
        member_agreement_promotion=[dict(member_agreement_promotion_id=5, member_agreement_id=1)],
    )
    agreements = spark.createDataFrame([(1,)], "member_agreement_id long")
    assert as_set(Cascade(T, agreements).plan(), "step", "table_name", "row_key") == {
        (38, "member_agreement_promotion", 5), (39, "member_agreement", 1),
    }
    assert as_set(Cascade(T, agreements, promotions=False).plan(), "table_name") == {("member_agreement",)}


def test_run_label():
    assert removal.run_label(datetime(2014, 9, 19, 7, 5, 3)) == "invoice_removal_2014_09_19_07_05_03"
