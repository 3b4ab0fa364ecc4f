"""Aging kept up to date, windows from tables, local times of many zones, keys that reach sums first."""

from __future__ import annotations

import datetime
import random
import re
from zoneinfo import ZoneInfo

import pytest
from frames import as_set, bundle, tx
from oracle import spark_rows

from duesmith.functions.relations import key_list
from duesmith.functions.times import to_utc_by
from duesmith.operators import aging, aging_state, error_log, intervals, link_defects, removal, summary
from duesmith.operators.cascade import Cascade
from duesmith.schema import ROLE_MEMBER
from duesmith.sources import snapshots
from duesmith.sources.book import Book, Layout
from duesmith.sources.tables import Tables
from pyspark.sql import functions as F

# --- aging by calendar ---


def _ledger(spark, due, amounts, target="2014-01-01"):
    return bundle(
        spark,
        business_unit=[dict(business_unit_id=1, name="one", time_zone_name="UTC")],
        party_role=[dict(party_role_id=1, party_id=1, party_role_type_id=ROLE_MEMBER, business_unit_id=1)],
        tx_invoice=[
            dict(tx_invoice_id=i, client_account_id=i % 2 or None, target_business_unit_id=1, party_role_id=1,
                 target_date=target, payment_due_date=date)
            for i, date in enumerate(due)
        ],
        tx_transaction=[tx(i, i, amount=abs(a), credit=a < 0) for i, a in enumerate(amounts)],
    )


def test_every_day_of_half_a_year_equals_the_full_computation(spark, tmp_path):
    due = ["2014-01-10", "2014-01-31", "2014-02-28", None, "2013-06-01", "2014-03-15", "2014-01-10", "2014-05-20"]
    T = _ledger(spark, due, [10, 20, 30, 40, 50, -6, 0, 80])
    book = Book(spark, str(tmp_path / "state"))
    start = datetime.datetime(2014, 1, 1)
    aging_state.begin(book, T, start, "day-0")
    for days in (0, 1, 9, 10, 11, 40, 41, 71, 100, 131, 200):
        as_of = start + datetime.timedelta(days=days, hours=days % 3)
        aging_state.refresh(book, T, as_of, f"day-{days}-on")
        assert spark_rows(aging_state.snapshot(book)) == spark_rows(aging.ar_aging(T, as_of)), days
    with pytest.raises(ValueError):
        aging_state.refresh(book, T, start, "back")
    versions = book.versions()
    assert aging_state.refresh(book, T, as_of, "day-200-on") == versions[-1]  # done before


def test_changed_invoices_are_taken_back_and_added(spark, tmp_path):
    before = _ledger(spark, ["2014-01-10"] * 6, [10, 20, 30, -6, 50, 60])
    after = _ledger(spark, ["2014-01-10", "2013-05-01", "2014-01-10", "2014-01-10", "2014-01-10"], [10, 20, -30, 6, 50])
    after = after.replace(tx_transaction=after.tx_transaction.where("tx_invoice_id <> 4"))
    book = Book(spark, str(tmp_path / "state"))
    aging_state.begin(book, before, "2014-01-05", "first")
    changed = key_list(spark, "tx_invoice_id", [1, 2, 3, 4, 5, 77])
    aging_state.refresh(book, after, "2014-02-20", "second", changed)
    assert spark_rows(aging_state.snapshot(book)) == spark_rows(aging.ar_aging(after, "2014-02-20"))
    # Nothing is left of an aging row whose last item is gone.
    none = after.replace(tx_transaction=after.tx_transaction.limit(0))
    aging_state.refresh(book, none, "2014-02-20", "third", none.tx_invoice)
    assert aging_state.snapshot(book).count() == 0


def test_a_refresh_reads_the_days_in_between(spark, small, tmp_path, monkeypatch):
    book = Book(spark, str(tmp_path / "state"))
    aging_state.begin(book, small, "1996-05-01", "first")
    from duesmith.sources import book as module

    read = []
    rows_in = module.Edit.rows_in
    monkeypatch.setattr(module.Edit, "rows_in", lambda self, name, units: read.append((name, sorted(units))) or rows_in(self, name, units))
    before = book.folders(aging_state.ITEMS)
    aging_state.refresh(book, small, "1996-05-03", "next")
    slots = dict(read)[aging_state.ITEMS]
    assert slots and set(slots) <= {"1996-05-01", "1996-05-02", "1996-05-03"}
    after = book.folders(aging_state.ITEMS)
    assert all(set(before[slot]) <= set(after[slot]) for slot in before if slot not in slots)
    assert spark_rows(aging_state.snapshot(book)) == spark_rows(aging.ar_aging(small, "1996-05-03"))


# --- windows of a table ---


def _moments(spark, values):
    rows = [(i, v and datetime.datetime.fromisoformat(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "error_id long, time_utc timestamp_ntz")


def _windows(spark, rows):
    stamp = lambda v: v and datetime.datetime.fromisoformat(v)
    return spark.createDataFrame([(n, stamp(a), stamp(b)) for n, a, b in rows], "window_no long, start timestamp_ntz, end timestamp_ntz")


def test_windows_of_all_lengths(spark):
    rng = random.Random(4)
    base = datetime.datetime(1969, 12, 31, 23)
    times = [(base + datetime.timedelta(seconds=rng.randint(0, 10**rng.randint(1, 8)))).isoformat() for _ in range(400)]
    windows = []
    for n in range(150):
        start = base + datetime.timedelta(seconds=rng.randint(-100, 10**rng.randint(1, 8)), microseconds=rng.randint(0, 999_999))
        windows.append((n, start.isoformat(), (start + datetime.timedelta(seconds=rng.choice([0, 1, 60, 4000, 10**6, 10**8, -5]))).isoformat()))
    windows += [(900, None, times[0]), (901, times[0], None), (902, times[1], times[1]), (903, times[1], times[1])]
    rows, table = _moments(spark, [*times, None]), _windows(spark, windows)
    got = as_set(intervals.in_windows(rows, "time_utc", table), "error_id", "window_no")
    expected = {(i, n) for i, t in enumerate(times) for n, a, b in windows if a and b
                and datetime.datetime.fromisoformat(a) <= datetime.datetime.fromisoformat(t) <= datetime.datetime.fromisoformat(b)}
    assert got == expected
    assert intervals.in_windows(rows, "time_utc", table.limit(0)).count() == 0


def test_ten_thousand_windows_make_no_nested_loop(spark, small, tmp_path):
    log = small.error_log
    start = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 7 * cast(id AS int))")
    table = spark.range(10_000).select(F.col("id").alias("window_no"), start.alias("start"), (start + F.expr("INTERVAL 4 MINUTE")).alias("end"))
    found = error_log.errors_in_windows(log, table)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    either = log.join(table, F.col("time_utc").between(F.col("start"), F.col("end"))).select("window_no", *log.columns)
    assert spark_rows(found) == spark_rows(either)
    book = Book(spark, str(tmp_path / "book"))
    book.create("first", small, {"error_log": Layout.monthly("time_utc")})
    few = table.where("window_no < 20")
    stored = error_log.errors_in_windows(book.tables().dated("error_log"), few)
    assert "month_of_time_utc" in re.search(r"PartitionFilters: \[[^\]]*", stored._jdf.queryExecution().executedPlan().toString())[0]
    assert spark_rows(stored) == spark_rows(error_log.errors_in_windows(log, few))


def test_rows_of_one_time_under_many_windows_are_dealt_out(spark):
    hour = F.expr("timestamp_ntz'2024-01-01 00:00:00'")
    rows = spark.range(1_000).coalesce(1).select(F.col("id").alias("error_id"), (hour + F.expr("make_dt_interval(0, 0, 0, id / 1000)")).alias("time_utc"))
    first = hour - F.expr("make_dt_interval(0, 0, cast(id AS int))")
    table = spark.range(2_500).select(F.col("id").alias("window_no"), first.alias("start"), (first + F.expr("INTERVAL 3 DAY")).alias("end"))
    found = intervals.in_windows(rows, "time_utc", table)
    assert {tuple(row) for row in found.groupBy("window_no").count().select("count").distinct().collect()} == {(1_000,)}
    tasks = [row["count"] for row in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 2_500_000 and max(tasks) <= sum(tasks) / spark.sparkContext.defaultParallelism / 2


@pytest.mark.parametrize("values", [0, 1 << 22])
@pytest.mark.parametrize("named", ["'w'", "map('k', window_no)", "named_struct('n', nullif(window_no, 3))", "nullif(window_no, 3)"])
def test_windows_in_lists_hold_what_a_plain_join_does(spark, monkeypatch, values, named):
    monkeypatch.setattr(intervals, "VALUES_AT_ONCE", values)
    monkeypatch.setattr(intervals, "LIST", 4)
    base = datetime.datetime(1969, 12, 31, 23, 59)
    times = [(base + datetime.timedelta(seconds=3 * n)).isoformat() for n in range(60)]
    windows = [(n, times[n % 50], times[n % 50 + n % 11]) for n in range(80)] + [(3, times[3], times[9])] * 20 + [(None, times[0], times[-1])]
    rows, table = _moments(spark, [*times, times[5], times[5], None]), _windows(spark, windows).selectExpr("*", f"{named} AS `a.name`")
    found = intervals.in_windows(rows, "time_utc", table)
    plain = rows.join(table, F.col("time_utc").between(F.col("start"), F.col("end")))
    assert found.columns == plain.columns and found.dtypes == plain.dtypes
    assert spark_rows(found) == spark_rows(plain)


# --- local times ---


def test_local_times_around_clock_changes(spark):
    zones = ["America/New_York", "Europe/Berlin", "Australia/Lord_Howe", "America/Phoenix", "UTC", "Asia/Kathmandu", "Pacific/Apia"]
    days = ["2014-03-09", "2014-11-02", "2014-03-30", "2014-10-26", "2014-04-06", "2014-10-05", "2014-07-01"]
    locals_ = [datetime.datetime.fromisoformat(f"{day} 00:00:00") + datetime.timedelta(minutes=15 * n) for day in days for n in range(20)]
    rows = spark.createDataFrame([(zone, local) for zone in zones for local in locals_], "zone string, local timestamp_ntz")
    for gap in ("forward", "backward"):
        for overlap in ("earlier", "later"):
            got = rows.select("zone", "local", to_utc_by(F.col("local"), F.col("zone"), gap, overlap).alias("utc")).collect()
            for row in got:
                zone = ZoneInfo(row["zone"])
                utc = [row["local"].replace(tzinfo=zone, fold=fold).astimezone(datetime.UTC).replace(tzinfo=None) for fold in (0, 1)]
                back = [u.replace(tzinfo=datetime.UTC).astimezone(zone).replace(tzinfo=None) for u in utc]
                exists = row["local"] in back
                # In a gap fold 0 uses the offset before it, which moves the time on.
                expected = (utc[0] if overlap == "earlier" else utc[1]) if exists else (utc[0] if gap == "forward" else utc[1])
                assert row["utc"] == expected, (row, gap, overlap)
    with pytest.raises(ValueError):
        to_utc_by(F.col("local"), F.col("zone"), gap="sideways")


def test_units_of_three_zones_are_billed_in_one_job(small):
    window = "1998-04-05 00:00:00", "1998-10-25 12:00:00"
    together = summary.billing_summary(small, *window, zone=None)
    zones = {row["time_zone_name"]: [] for row in small.business_unit.collect()}
    for row in small.business_unit.collect():
        zones[row["time_zone_name"]].append(row["business_unit_id"])
    apart = []
    for zone, units in zones.items():
        apart += spark_rows(summary.billing_summary(small, *window, zone=zone, units=units))[1]
    assert len(zones) >= 3 and spark_rows(together)[1] == sorted(apart)
    with pytest.raises(ValueError):
        summary.billing_summary(small, *window, zone=None, gateway_batch=3)


# --- keys before sums ---


def _sums_follow_keys(df, table_column: str) -> bool:
    """Whether every sum over the table with this column stands above a semi-join of its rows."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()

    def depth(line):
        return len(line) - len(line.lstrip(" :+-"))

    seen = False
    for n, line in enumerate(lines):
        if not ("Relation" in line and table_column in line):
            continue
        above, at = [], depth(line)
        for before in reversed(lines[:n]):
            if depth(before) < at:
                above.append(before.strip(" :+-"))
                at = depth(before)
        sums = [i for i, x in enumerate(above) if x.startswith("Aggregate") and re.search(r"sum\(|min_?by\(|min\(|count\(", x)]
        joins = [i for i, x in enumerate(above) if x.startswith("Join LeftSemi")]
        if sums:
            seen = True
            if not (joins and joins[0] < sums[0]):
                return False
    return seen


@pytest.fixture(scope="module")
def kept(spark, small, tmp_path_factory):
    """Stored tables, so that a plan shows where each is read."""
    root = tmp_path_factory.mktemp("tables")
    names = ("tx_transaction", "tx_invoice", "tx_payment", "payment_request", "payment_request_item", "invoice_request",
             "invoice_request_item", "payment_process_request", "payment_process_batch", "client_account_party", "party_role",
             "business_unit", "member_agreement")
    for name in names:
        small[name].write.parquet(f"{root}/{name}")
    return Tables.from_parquet(spark, str(root))


def test_due_buckets_of_a_party_sum_its_own_schedule(kept):
    parties = kept.party_role.where(f"party_role_type_id = {ROLE_MEMBER} AND party_id % 7 = 0")
    buckets = aging.buckets_of_parties(kept, "2000-01-01", parties)
    assert _sums_follow_keys(buckets, "is_accounting_credit")
    whole = aging.party_due_buckets(aging.transactions_due(kept, "2000-01-01", parties), kept, "2000-01-01")
    assert not _sums_follow_keys(whole, "is_accounting_credit")
    assert spark_rows(buckets) == spark_rows(whole)


def test_missing_transactions_sum_their_own_gateway_requests_and_sales(kept):
    found = link_defects.missing_payment_tx(kept)
    assert _sums_follow_keys(found, "is_accounting_credit")
    assert _sums_follow_keys(found, "token")


def test_cascades_sum_touched_payments_and_batches(kept, monkeypatch):
    from duesmith.operators import cascade

    plans = {}
    stored = cascade.stored

    def keep(df, label, by=()):
        plans[label] = df
        return stored(df, label, by)

    monkeypatch.setattr(cascade, "stored", keep)
    found = Cascade(kept, kept.member_agreement.limit(20))
    found.find("@empty_batches")
    payments = [df for df in plans.values() if "staying" in df._jdf.queryExecution().optimizedPlan().toString() and _sums_follow_keys(df, "is_accounting_credit")]
    batches = [df for df in plans.values() if _sums_follow_keys(df, "payment_process_batch_id")]
    assert payments and batches


def test_the_removal_guard_sorts_out_what_refers_to_its_targets(kept):
    guard = removal.blocked_invoices(kept, kept.tx_invoice.limit(10))
    plan = guard._jdf.queryExecution().optimizedPlan().toString()
    for line, above in zip(plan.splitlines()[1:], plan.splitlines()):
        assert not (line.strip(" :+-").startswith("Relation") and above.strip(" :+-").startswith("Aggregate"))


def test_names_are_looked_up_for_billed_roles(small):
    plan = summary.billing_summary(small, "1998-01-01", "1999-01-01")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") >= 3


# --- counts from the write ---


def test_a_refresh_counts_what_it_writes(spark, tmp_path):
    rows = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (None, 30)], "business_unit_id int, client_account_id bigint")
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    snapshots.refresh_snapshot(first, rows, "2014-04-01")
    assert snapshots.published_count(spark, first) == 4
    snapshots.refresh_snapshot(second, rows.limit(1), "2014-05-01", previous=first, units=[1, 2])
    kept_rows = snapshots.read_snapshot(spark, second, snapshots.read_snapshot(spark, first, rows.select(F.lit(None).cast("date").alias("aged_date"), "*")))
    assert snapshots.published_count(spark, second) == kept_rows.count() == 2
    third = str(tmp_path / "third")
    snapshots.compact_snapshot(spark, second, third, kept_rows)
    assert spark_rows(snapshots.read_snapshot(spark, third, kept_rows)) == spark_rows(kept_rows)
    assert {row["version"] for row in spark.read.parquet(f"{third}/units").collect()} == {third}
    assert snapshots.published_count(spark, third) == 2
