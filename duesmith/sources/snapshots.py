"""The cached aging snapshot, published as immutable versions.

A version is a folder with the rows that it replaced, by unit, and a list that names for every unit
the version that holds its rows.  A refresh of some units writes these and a new list; the rows of
all other units stay where they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from duesmith.functions.relations import keys_of
from duesmith.functions.times import moment
from duesmith.sources.tables import Tables

UNIT = "business_unit_id"


def _named(units: Sequence[int]):
    return F.coalesce(F.col(UNIT).isin(*units), F.lit(False))


def of_known_units(aging: DataFrame, T: Tables) -> DataFrame:
    """Aging rows of the units that exist, which are the ones a refresh publishes."""
    return aging.join(keys_of(T.business_unit, UNIT), UNIT, "left_semi").select(*aging.columns)


def refresh_snapshot(
    path: str,
    aging: DataFrame,
    as_of: datetime | str,
    previous: str | None = None,
    units: Sequence[int] | None = None,
) -> DataFrame:
    """Write a snapshot version stamped with the local cutoff date and read it back.

    Without ``units`` the version replaces every unit.  With ``units`` those are replaced, even by
    nothing, and all others, rows without a unit among them, come over from ``previous``.
    """
    if units is not None and previous is None:
        raise ValueError("a refresh of some units needs the previous version for the others")
    spark = aging.sparkSession
    stamped = aging.select(F.lit(moment(as_of).date().isoformat()).cast("date").alias("aged_date"), "*")
    if units is not None:
        stamped = stamped.where(_named(units))
    written = _write(stamped, path)
    if units is not None:
        written = written.unionByName(spark.read.parquet(f"{previous}/units").where(~_named(units)))
    written.coalesce(1).write.parquet(f"{path}/units")  # one row for each unit
    return read_snapshot(spark, path, stamped)


def _write(rows: DataFrame, path: str) -> DataFrame:
    """Write a version's rows and give its units with their rows, read off the files' footers.

    The rows are also counted while they are written; the two counts must agree.
    """
    seen = Observation()
    # Few files for each unit; a large unit is split over several tasks and files.
    dealt = rows.hint("rebalance", UNIT).observe(seen, F.count("*").alias("rows"))
    dealt.write.partitionBy(UNIT).parquet(f"{path}/rows")
    written = _rows(rows.sparkSession, path, rows).groupBy(UNIT).agg(F.count("*").alias("rows"))
    written = written.select(UNIT, F.lit(path).alias("version"), "rows")
    found, kept = seen.get.get("rows", 0), _total(written)
    if found != kept:
        raise RuntimeError(f"{found} rows were computed, {kept} written to {path}")
    return written


def _total(units: DataFrame) -> int:
    return units.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()["rows"]


def _rows(spark: SparkSession, version: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(f"{version}/rows").select(*like.columns)


def read_snapshot(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """All units of a version, each from the folder that its list names."""
    listed: dict[str, list[int | None]] = {}
    for row in spark.read.parquet(f"{path}/units").collect():
        listed.setdefault(row["version"], []).append(row[UNIT])
    parts = []
    for version, units in sorted(listed.items()):
        numbers = [unit for unit in units if unit is not None]
        wanted = _named(numbers) if numbers else F.lit(False)
        if None in units:
            wanted = wanted | F.col(UNIT).isNull()
        parts.append(_rows(spark, version, like).where(wanted))
    return reduce(DataFrame.unionByName, parts) if parts else _rows(spark, path, like)


def listed_count(spark: SparkSession, path: str) -> DataFrame:
    """Row count of a version, as its list of units has known it since they were written."""
    units = spark.read.parquet(f"{path}/units")
    return units.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("row_count"))


def published_count(spark: SparkSession, path: str) -> int:
    return listed_count(spark, path).first()["row_count"]


def compact_snapshot(spark: SparkSession, path: str, target: str, like: DataFrame) -> DataFrame:
    """The rows of a version in a folder of its own, so that readers need no earlier versions."""
    _write(read_snapshot(spark, path, like), target).coalesce(1).write.parquet(f"{target}/units")
    return _rows(spark, target, like)


def snapshot_count(snapshot: DataFrame) -> DataFrame:
    """Row count of the published snapshot."""
    return snapshot.agg(F.count("*").alias("row_count"))
