"""Small relational helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CHUNK = 65_536
CHUNK_WIDE = 1 << 40


def live(process_type: Column | str = "process_type") -> Column:
    """Not marked "do not process"; an unset mark counts as live."""
    process_type = F.col(process_type) if isinstance(process_type, str) else process_type
    return F.coalesce(process_type, F.lit(0)) != 1


def key_list(spark: SparkSession, column: str, ids: Sequence[int]) -> DataFrame:
    """Ids given one by one, as the key list that operators take."""
    return spark.createDataFrame([(i,) for i in ids], f"{column} bigint")


def keys_of(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct non-null keys."""
    return df.select(*columns).dropna().distinct()


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Frames of the same columns put together, in halves: each is analysed a few times, not once for every other."""
    if len(frames) == 1:
        return frames[0]
    middle = len(frames) // 2
    return union_all(frames[:middle]).union(union_all(frames[middle:]))


def not_in(df: DataFrame, column: str, keys: DataFrame, key: str | None = None) -> DataFrame:
    """SQL ``NOT IN`` against a null-free list.

    Rows whose own key is NULL drop out.  A plain anti join keeps any side
    shuffle-able, where Spark's null-aware one must broadcast the list.
    """
    key = key or column
    return df.where(F.col(column).isNotNull()).join(
        keys.select(F.col(key).alias(column)).dropna(), column, "left_anti"
    )


def left_join_sparse(df: DataFrame, other: DataFrame, key: str, spread_by: str, ways: int = 256) -> DataFrame:
    """Left join on a key that is often NULL.

    NULL keys match nothing but would all hash to one task; a second key column
    spreads them by another column of the same row.
    """
    salt = F.when(F.col(key).isNull(), F.pmod(F.hash(spread_by), F.lit(ways))).otherwise(0)
    return (
        df.withColumn("_salt", salt)
        .join(other.withColumn("_salt", F.lit(0)), [key, "_salt"], "left")
        .drop("_salt")
    )


def one_per_key(df: DataFrame, key: str | Sequence[str], *values: str) -> DataFrame:
    """One row for each key: the smallest value tuple wins."""
    keys = [key] if isinstance(key, str) else list(key)
    if len(values) == 1:
        return df.groupBy(*keys).agg(F.min(values[0]).alias(values[0]))
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*values)).alias("_least"))
        .select(*keys, *[F.col(f"_least.{value}").alias(value) for value in values])
    )


def number_within(
    df: DataFrame, key: str, leading: str, row_id: str, out: str, chunk: int = CHUNK, wide: int = CHUNK_WIDE
) -> DataFrame:
    """``row_number() over (partition by key order by leading, row_id)`` for hot keys.

    One window task per key would hold a hot key whole.  Rows are numbered in chunks of
    ``(leading, row_id div chunk)``, which keep the order.  A chunk's offset is the count of the
    chunks before it in its wide chunk (``row_id div wide``) plus that of all wide chunks before:
    two running sums, so that ids spread over 64 bits, which make every row a chunk of its own,
    still leave no task more than ``wide / chunk`` or ``2**63 / wide`` counts for each leading value.
    """
    wides, slots = [key, leading, "_wide"], [key, leading, "_wide", "_slot"]
    chunked = df.withColumn("_slot", F.expr(f"{row_id} div {chunk}")).withColumn("_wide", F.expr(f"{row_id} div {wide}"))
    counts = chunked.groupBy(*slots).agg(F.count("*").alias("_rows"))

    def running(counts: DataFrame, parts: Sequence[str], order: Sequence[str]) -> Column:
        frame = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_rows").over(frame), F.lit(0))

    def named(df: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
        return df.withColumnsRenamed({column: f"{prefix}{n}" for n, column in enumerate(columns)})

    def matches(columns: Sequence[str], prefix: str) -> Column:
        test = F.lit(True)
        for n, column in enumerate(columns):
            test = test & F.col(column).eqNullSafe(F.col(f"{prefix}{n}"))
        return test

    wide_counts = counts.groupBy(*wides).agg(F.sum("_rows").alias("_rows"))
    wide_offsets = wide_counts.select(*wides, running(wide_counts, [key], [leading, "_wide"]).alias("_before_wide"))
    offsets = counts.select(*slots, running(counts, wides, ["_slot"]).alias("_before"))
    inside = Window.partitionBy(*slots).orderBy(row_id)
    numbered = (
        chunked.withColumn("_nth", F.row_number().over(inside))
        .join(named(offsets, slots, "_s"), matches(slots, "_s"))
        .join(named(wide_offsets, wides, "_w"), matches(wides, "_w"))
        .withColumn(out, (F.col("_nth") + F.col("_before") + F.col("_before_wide")).cast("bigint"))
    )
    return numbered.select(*df.columns, out)
