"""Changes in a stored book: which files they touch, what a broken edit leaves, what a version shows."""

from __future__ import annotations

import glob
import os

import pytest
from frames import as_set, bundle, tx
from oracle import spark_rows

from duesmith.functions.relations import key_list
from duesmith.functions.times import in_window
from duesmith.operators import summary
from duesmith.operators.cascade import STEPS, Cascade
from duesmith.operators.changes import ChangeSet
from duesmith.sources.book import Book, Conflict, Damaged, Layout
from duesmith.sources.layout import BUCKET_KEYS


def _files(book: Book, table: str) -> dict[str, int]:
    found = glob.glob(f"{book.root}/{table}/**/*.parquet", recursive=True)
    return {path: os.stat(path).st_mtime_ns for path in found}


def _marks(spark, *keys, mark=1):
    rows = spark.createDataFrame([(key, mark) for key in keys], "invoice_request_id long, process_type int")
    return ChangeSet("invoice_request", "invoice_request_id", rows)


@pytest.fixture
def requests(spark, small, tmp_path):
    book = Book(spark, str(tmp_path / "book"))
    book.create("first", small, {"invoice_request": Layout.bucketed("invoice_request_id", 16)})
    return book


def test_an_update_writes_its_buckets_only(spark, small, requests):
    before = _files(requests, "invoice_request")
    folders = requests.folders("invoice_request")
    edit = requests.edit("mark")
    marks = _marks(spark, 4, 8, 10**9)
    edit.update(marks)
    assert edit.publish() == 2
    assert edit.counts[0]["changed"] == 2
    after = requests.folders("invoice_request")
    moved = {unit for unit in folders if folders[unit] != after[unit]}
    assert 1 <= len(moved) <= 3
    files = _files(requests, "invoice_request")
    assert {path: files[path] for path in before} == before  # old files keep their names and times
    assert spark_rows(requests.tables().invoice_request) == spark_rows(marks.apply(small))
    assert spark_rows(requests.tables(1).invoice_request) == spark_rows(small.invoice_request)


def test_deletes_inserts_and_counts(spark, small, requests):
    edit = requests.edit("change")
    keys = key_list(spark, "invoice_request_id", [1, 2, 3, 10**9])
    gone = small.invoice_request.join(keys, "invoice_request_id", "left_semi").select(*small.invoice_request.columns)
    n = gone.count()
    assert edit.delete("invoice_request", keys, "invoice_request_id") == n
    edit.insert("invoice_request", gone)
    edit.insert("invoice_request", gone.withColumn("invoice_request_id", gone.invoice_request_id + 10**8))
    edit.publish()
    total = small.invoice_request.count()
    assert requests.row_count("invoice_request") == total + n == requests.tables().invoice_request.count()
    assert requests.row_count("invoice_request", 1) == total
    with pytest.raises(KeyError):
        requests.tables(9)


def test_rows_found_by_another_key_than_the_buckets(spark, small, tmp_path):
    book = Book(spark, str(tmp_path / "book"))
    book.create("first", small, {"tx_transaction": Layout.bucketed("tx_invoice_id", 16)})
    before = book.folders("tx_transaction")
    keys = small.tx_transaction.where("tx_invoice_id = 7").select("tx_transaction_id")
    edit = book.edit("delete")
    assert edit.delete("tx_transaction", keys, "tx_transaction_id") == keys.count() > 0
    edit.publish()
    after = book.folders("tx_transaction")
    assert sum(before[unit] != after.get(unit) for unit in before) == 1
    assert book.tables().tx_transaction.where("tx_invoice_id = 7").count() == 0


def test_a_changed_date_moves_its_row_to_another_month(spark, tmp_path):
    T = bundle(spark, invoice_request=[
        dict(invoice_request_id=i, bill_date=date) for i, date in ((1, "2014-01-05"), (2, "2014-02-05"), (3, "2014-01-09"), (4, None))
    ])
    book = Book(spark, str(tmp_path / "book"))
    book.create("first", T, {"invoice_request": Layout.monthly("bill_date")})
    moves = T.invoice_request.where("invoice_request_id = 1").selectExpr(
        "invoice_request_id", "CAST('2014-02-07 00:00:00' AS timestamp_ntz) AS bill_date"
    )
    edit = book.edit("move")
    edit.update(ChangeSet("invoice_request", "invoice_request_id", moves))
    edit.publish()
    assert set(book.folders("invoice_request")) == {"2014-01", "2014-02", "none"}
    assert len(book.folders("invoice_request")["2014-02"]) == 2
    dated = book.tables().dated("invoice_request")
    assert as_set(in_window(dated, "bill_date", "2014-02-01", "2014-03-01"), "invoice_request_id") == {(1,), (2,)}
    assert as_set(book.tables().invoice_request, "invoice_request_id") == {(1,), (2,), (3,), (4,)}
    book.compact("compact", most=1)
    assert all(len(folders) == 1 for folders in book.folders("invoice_request").values())
    assert as_set(in_window(book.tables().dated("invoice_request"), "bill_date", "2014-02-01", "2014-03-01"), "invoice_request_id") == {(1,), (2,)}


def test_an_edit_that_breaks_off_is_repeated_to_the_same_result(spark, small, tmp_path, monkeypatch):
    layouts = {"tx_payment": Layout.bucketed("tx_payment_id", 8), "payment_request": Layout.bucketed("invoice_request_id", 8)}
    book = Book(spark, str(tmp_path / "book"))
    book.create("first", small, layouts)
    keys = small.tx_payment.where("tx_payment_id % 5 = 0").select("tx_payment_id")

    def run(book):
        edit = book.edit("remove")
        edit.delete("payment_request", keys, "tx_payment_id")
        edit.delete("tx_payment", keys, "tx_payment_id")
        return edit.publish()

    from duesmith.sources import book as module

    write, calls = module.Edit._write, []

    def breaks(self, *args, **named):
        calls.append(args[0])
        if len(calls) == 2:
            write(self, *args, **named)
            raise OSError("the driver is gone")
        return write(self, *args, **named)

    monkeypatch.setattr(module.Edit, "_write", breaks)
    with pytest.raises(OSError):
        run(book)
    assert calls == ["payment_request", "tx_payment"]
    assert book.versions() == [1]  # neither table has changed
    for name in layouts:
        assert spark_rows(book.tables()[name]) == spark_rows(small[name])
    monkeypatch.setattr(module.Edit, "_write", write)
    assert run(book) == 2
    assert run(book) == 2 and book.versions() == [1, 2]  # done before: nothing is written
    assert spark_rows(book.tables().tx_payment) == spark_rows(small.tx_payment.where("tx_payment_id % 5 <> 0"))
    left = small.payment_request.where("tx_payment_id IS NULL OR tx_payment_id % 5 <> 0")
    assert spark_rows(book.tables().payment_request) == spark_rows(left)


def test_of_two_edits_of_one_version_one_is_published(spark, requests):
    one, two = requests.edit("one"), requests.edit("two")
    one.update(_marks(spark, 4))
    two.update(_marks(spark, 8))
    assert one.publish() == 2
    with pytest.raises(Conflict):
        two.publish()
    again = requests.edit("two")
    again.update(_marks(spark, 8))
    assert again.publish() == 3
    marked = requests.tables().invoice_request.where("invoice_request_id IN (4, 8) AND process_type = 1")
    assert marked.count() == 2


def test_a_change_that_names_a_key_twice_is_refused(spark, small, requests):
    edit = requests.edit("twice")
    with pytest.raises(Damaged):
        edit.update(_marks(spark, 4, 4))
    assert requests.versions() == [1]


def test_nothing_to_change_publishes_nothing(spark, requests):
    edit = requests.edit("none")
    edit.update(_marks(spark))
    edit.delete("invoice_request", key_list(spark, "invoice_request_id", [10**9]).limit(0), "invoice_request_id")
    assert edit.publish() == 1
    with pytest.raises(ValueError):
        requests.edit("a/b")


def test_a_table_may_become_empty_and_full_again(spark, small, requests):
    edit = requests.edit("all")
    edit.delete("invoice_request", small.invoice_request, "invoice_request_id")
    edit.publish()
    assert requests.row_count("invoice_request") == 0 == requests.tables().invoice_request.count()
    edit = requests.edit("again")
    edit.insert("invoice_request", small.invoice_request)
    edit.publish()
    assert spark_rows(requests.tables().invoice_request) == spark_rows(small.invoice_request)


def test_old_versions_go_and_their_files_with_them(spark, requests):
    for n in range(3):
        edit = requests.edit(f"mark-{n}")
        edit.update(_marks(spark, 4, mark=n))
        edit.publish()
    expected = spark_rows(requests.tables().invoice_request)
    files = len(_files(requests, "invoice_request"))
    requests.vacuum()
    assert requests.versions() == [4]
    assert len(_files(requests, "invoice_request")) < files
    assert spark_rows(requests.tables().invoice_request) == expected


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_choose_the_folders_that_are_read(spark, small, tmp_path):
    book = Book(spark, str(tmp_path / "book"))
    book.create("first", small, {"billing_service_tx": Layout.monthly("target_date_utc"), "tx_payment": Layout.monthly("target_date_utc"),
                                 "invoice_request": Layout.monthly("bill_date")})
    T = book.tables()
    window = "1998-01-01 00:00:00", "1999-01-01 00:00:00"
    base = summary.billing_base(T.dated("billing_service_tx"), "America/New_York", *window)
    assert base.columns == small.billing_service_tx.columns
    assert "PartitionFilters: [isnotnull(month_of_target_date_utc" in _plan(base)
    plain = summary.billing_base(small.billing_service_tx, "America/New_York", *window)
    assert spark_rows(base) == spark_rows(plain)
    assert spark_rows(summary.billing_base(T.dated("billing_service_tx"), "UTC", *window, gateway_batch=1))[0] == sorted(base.columns)
    mixed = T.replace(**{name: small[name] for name in ("payment_process_request", "payment_process_response", "business_unit")})
    assert mixed.dated("billing_service_tx").columns == small.billing_service_tx.columns


def test_a_cascade_changes_a_book_in_one_version(spark, small, tmp_path):
    book = Book(spark, str(tmp_path / "book"))
    tables = ("tx_transaction", "tx_invoice", "tx_payment", "member_agreement")
    names = {step.table: step.key for step in STEPS}
    book.create("first", small, {name: Layout.bucketed(names[name], 4) for name in names})
    doomed = key_list(spark, "member_agreement_id", [4, 8, 12, 16, 100])
    T = small.replace(**{name: book.tables()[name] for name in names})
    assert Cascade(T, doomed).apply_in(book, "cascade") == 2
    expected = Cascade(small, doomed).apply()
    for name in tables:
        assert spark_rows(book.tables()[name]) == spark_rows(expected[name])
    assert Cascade(T, doomed).apply_in(book, "cascade") == 2


def test_a_cascade_takes_one_job_for_each_level(small, monkeypatch):
    from duesmith.operators import cascade

    labels = []

    def counted(df, label, by=()):
        labels.append(label)
        return cascade_stored(df, label, by)

    cascade_stored = cascade.stored
    monkeypatch.setattr(cascade, "stored", counted)
    Cascade(small, small.member_agreement.limit(3)).plan().count()
    assert len(labels) <= 8


def test_ledger_lines_of_a_payment_over_kept_invoices_stay(spark):
    T = bundle(
        spark,
        member_agreement=[dict(member_agreement_id=1), dict(member_agreement_id=2)],
        invoice_request=[dict(invoice_request_id=i, member_agreement_id=i) for i in (1, 2)],
        invoice_request_item=[dict(invoice_request_item_id=i, invoice_request_id=i, tx_transaction_id=10 * i) for i in (1, 2)],
        tx_invoice=[dict(tx_invoice_id=i) for i in (1, 2)],
        tx_payment=[dict(tx_payment_id=5, amount=30), dict(tx_payment_id=6, amount=7)],
        tx_transaction=[tx(10, 1, amount=9), tx(20, 2, amount=9), tx(11, 1, kind=4, item_id=5, amount=10, credit=True),
                        tx(21, 2, kind=4, item_id=5, amount=20, credit=True), tx(22, 2, kind=4, item_id=6, amount=7, credit=True)],
    )
    cascade = Cascade(T, key_list(spark, "member_agreement_id", [1]))
    assert as_set(cascade.doomed("tx_payment"), "tx_payment_id") == set()
    assert {(r["tx_payment_id"], int(r["amount"])) for r in cascade.repriced_payments().rows.collect()} == {(5, 20)}


@pytest.mark.parametrize("most, parts, join", [(1 << 20, 1, "BroadcastHashJoin"), (200, 4, None), (0, 4, None)])
def test_a_delete_writes_rows_where_they_are_read_as_far_as_its_keys_fit(spark, small, tmp_path, monkeypatch, most, parts, join):
    from duesmith.sources import book as module

    book = Book(spark, str(tmp_path / "book"))
    book.create("first", small, {"tx_transaction": Layout.bucketed("tx_invoice_id", 4)})
    keys = small.tx_transaction.where("tx_invoice_id % 3 = 0").select("tx_transaction_id")
    write, written = module.Edit._write, []

    def seen(self, name, table, rows, replaced, expected=None, in_place=False):
        written.append((_plan(rows), in_place))
        return write(self, name, table, rows, replaced, expected, in_place)

    monkeypatch.setattr(module.Edit, "_write", seen)
    monkeypatch.setattr(module, "KEYS_AT_ONCE", most)
    edit = book.edit("delete")
    assert edit.delete("tx_transaction", keys, "tx_transaction_id") == keys.count() > 200
    assert edit.publish() == 2
    assert len(written) == parts
    if join:
        assert all(join in plan and "hashpartitioning" not in plan and in_place for plan, in_place in written)
    if not most:
        assert not any(in_place for _, in_place in written)
    assert spark_rows(book.tables().tx_transaction) == spark_rows(small.tx_transaction.where("tx_invoice_id % 3 <> 0"))


def test_units_go_together_as_far_as_their_keys_fit():
    from duesmith.sources.book import _together

    assert _together({"1": 3, "2": 2, "3": 9, "4": 1, "5": 4}, 5) == [["1", "2"], ["3"], ["4", "5"]]
    assert _together({}, 5) == []


def test_tables_are_derived_from_the_copies_of_their_sources(small):
    one = small.activity.selectExpr("min(activity_id)").first()[0]
    few = small.rebase(tx_transaction=small.tx_transaction.where(f"tx_transaction_id = {one}"))
    assert as_set(few.activity, "activity_id") == {(one,)} and few.activity_transaction.count() == 2
    assert spark_rows(small.rebase(tx_transaction=small.tx_transaction).activity) == spark_rows(small.activity)
    assert few.replace(activity=small.activity).rebase(tx_invoice=small.tx_invoice).tx_invoice is small.tx_invoice


def test_deleted_keys_that_are_not_there_and_repeated_ones(spark, small, tmp_path, monkeypatch):
    from duesmith.sources import book as module

    monkeypatch.setattr(module, "KEYS_AT_ONCE", 5)
    book = Book(spark, str(tmp_path / "book"))
    book.create("first", small, {"tx_payment": Layout.bucketed("tx_payment_id", 8), "payment_request": Layout.bucketed("invoice_request_id", 8)})
    keys = spark.createDataFrame([(k,) for k in [5, 5, 10, 10**9, None, *range(40, 60)]], "tx_payment_id bigint")
    edit = book.edit("remove")
    left = {name: small[name].join(keys, "tx_payment_id", "left_anti").select(*small[name].columns) for name in book.tables()._known}
    for name in left:
        assert edit.delete(name, keys, "tx_payment_id") == small[name].count() - left[name].count() > 0
    edit.publish()
    for name in left:
        assert spark_rows(book.tables()[name]) == spark_rows(left[name])
    assert spark.conf.get(module.OPEN_UNITS[0], None) in (None, "0")  # put back
