"""Change sets: what a repair would write, kept as data until it is applied."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duesmith.sources.tables import Tables


@dataclass(frozen=True)
class ChangeSet:
    """New column values by key for one table.

    ``rows`` holds the key and the new values under the table's own column names,
    at most one row for each key.
    """

    table: str
    key: str
    rows: DataFrame

    @property
    def columns(self) -> list[str]:
        return [name for name in self.rows.columns if name != self.key]

    def _new(self) -> DataFrame:
        return self.rows.select(
            self.key, F.lit(True).alias("_changed"), *[F.col(name).alias(f"new_{name}") for name in self.columns]
        )

    def preview(self, T: Tables) -> DataFrame:
        """Key with old and new values of the rows that would change."""
        old = T[self.table].select(self.key, *[F.col(name).alias(f"old_{name}") for name in self.columns])
        pairs = [column for name in self.columns for column in (f"old_{name}", f"new_{name}")]
        return old.join(self._new(), self.key).select(self.key, *pairs)

    def merge(self, table: DataFrame, mark: str | None = None) -> DataFrame:
        """Rows of the table with the new values in place; ``mark`` names a column that tells changed ones."""
        kept = [
            F.when(F.col("_changed"), F.col(f"new_{name}")).otherwise(F.col(name)).alias(name)
            if name in self.columns
            else F.col(name)
            for name in table.columns
        ]
        marked = [] if mark is None else [F.col("_changed").isNotNull().alias(mark)]
        return table.join(self._new(), self.key, "left").select(*kept, *marked)

    def apply(self, T: Tables) -> DataFrame:
        """The whole table with the new values in place."""
        return self.merge(T[self.table])

    def repeated_keys(self) -> DataFrame:
        """Keys that break the one-row rule; empty for every repair of this package."""
        return self.rows.groupBy(self.key).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def apply_all(T: Tables, *changes: ChangeSet) -> Tables:
    """The bundle with every change set applied, in order."""
    for change in changes:
        T = T.replace(**{change.table: change.apply(T)})
    return T


def delete_by_keys(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows that survive deleting the given keys."""
    return table.join(keys.select(key).dropna(), key, "left_anti").select(*table.columns)
