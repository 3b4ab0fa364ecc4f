from __future__ import annotations

import random

import pytest

from duesmith.functions.relations import left_join_sparse, not_in, number_within, one_per_key
from duesmith.functions.text import like, token_label
from duesmith.functions.times import day_crossings, to_utc, ts
from frames import as_set
from pyspark.sql import Window
from pyspark.sql import functions as F


def test_not_in_drops_null_keys(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    keys = spark.createDataFrame([(2,), (None,)], "k long")
    assert as_set(not_in(rows, "k", keys), "k") == {(1,)}


def test_number_within_equals_a_window_for_hot_and_null_keys(spark):
    rng = random.Random(7)
    rows = [(0 if rng.random() < 0.5 else rng.randrange(20), rng.choice([None, 1, 2, 3]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, o int, id long").repartition(5)
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("o", "id")).cast("bigint"))
    chunked = number_within(df, "k", "o", "id", "n", chunk=50)
    assert chunked.columns == plain.columns
    assert as_set(chunked, "k", "o", "id", "n") == as_set(plain, "k", "o", "id", "n")


def test_left_join_sparse_equals_a_left_join(spark):
    left = spark.createDataFrame([(i, i % 3 if i % 4 else None) for i in range(40)], "id long, k long")
    right = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c")], "k long, v string")
    sparse = left_join_sparse(left, right, "k", "id", ways=8)
    assert sorted(map(tuple, sparse.select("id", "k", "v").collect()), key=str) == sorted(
        map(tuple, left.join(right, "k", "left").select("id", "k", "v").collect()), key=str
    )


@pytest.mark.parametrize("wide", [200, 1 << 40])
def test_number_within_with_ids_spread_over_64_bits(spark, wide):
    rng = random.Random(3)
    rows = [(i % 3 or None, i % 5, rng.randrange(1 << 62) if i % 2 else i) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, o long, id long")
    window = Window.partitionBy("k").orderBy("o", "id")
    expected = df.withColumn("n", F.row_number().over(window).cast("bigint"))
    got = number_within(df, "k", "o", "id", "n", chunk=50, wide=wide)
    assert got.columns == expected.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def test_one_per_key_takes_the_smallest(spark):
    df = spark.createDataFrame([(1, 5, 0), (1, 3, 9), (2, 7, 1)], "k long, v long, w long")
    assert as_set(one_per_key(df, "k", "v", "w"), "k", "v", "w") == {(1, 3, 9), (2, 7, 1)}


def test_day_crossings_count_midnights(spark):
    row = spark.range(1).select(
        day_crossings(ts("2014-01-01 23:59:59"), ts("2014-01-02 00:00:01")).alias("d")
    ).first()
    assert row.d == 1


def test_to_utc_in_gap_and_overlap(spark):
    row = spark.range(1).select(
        to_utc(ts("2014-03-09 02:30:00"), "America/New_York").cast("string").alias("gap"),
        to_utc(ts("2014-11-02 01:30:00"), "America/New_York").cast("string").alias("twice"),
        to_utc(ts("2014-07-01 00:00:00"), "America/New_York").cast("string").alias("plain"),
    ).first()
    assert (row.gap, row.twice, row.plain) == (
        "2014-03-09 07:30:00", "2014-11-02 05:30:00", "2014-07-01 04:00:00",
    )


def test_times_do_not_follow_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        row = spark.range(1).select(to_utc(ts("2014-07-01 00:00:00"), "America/Chicago").cast("string").alias("t")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.t == "2014-07-01 05:00:00"


def test_like_case_rule(spark):
    df = spark.createDataFrame([("Visa card",), ("VISA card",)], "s string")
    assert df.where(like("s", "%VISA%")).count() == 1
    assert df.where(like("s", "%VISA%", ignore_case=True)).count() == 2


def test_token_labels(spark):
    tokens = [("VC123456",), ("BC123456",), ("ZZ123456",)]
    df = spark.createDataFrame(tokens, "t string").select("t", token_label(F.col("t")).alias("label"))
    assert as_set(df, "t", "label") == {
        ("VC123456", "VISA:3456"), ("BC123456", "Bank Draft(US):456"), ("ZZ123456", None),
    }
