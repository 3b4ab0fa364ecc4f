"""The bundle of billing tables that operators take as ``T``."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from duesmith import schema
from duesmith.sources import billing_views


class Tables:
    """Named DataFrames, resolved on first use: ``T.tx_invoice``."""

    def __init__(self, resolve: Callable[[str], DataFrame], known: Iterable[str]):
        self._resolve = resolve
        self._known = frozenset(known)
        self._frames: dict[str, DataFrame] = {}
        self._derive: Callable[[Mapping[str, DataFrame]], Tables] | None = None

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name not in self._known:
                raise KeyError(f"unknown billing table: {name}")
            self._frames[name] = self._resolve(name)
        return self._frames[name]

    def dated(self, name: str) -> DataFrame:
        """A table for ``times.in_window``; stored ones bring the months of their folders along."""
        return self[name]

    def __contains__(self, name: str) -> bool:
        return name in self._known

    def replace(self, **frames: DataFrame) -> Tables:
        """A new bundle with some tables swapped, e.g. for repaired versions."""
        return Tables(lambda name: frames[name] if name in frames else self[name], self._known | set(frames))

    def rebase(self, **frames: DataFrame) -> Tables:
        """The same with copies of some tables, from which those that are derived from them are derived, too."""
        return self.replace(**frames) if self._derive is None else self._derive(frames)

    @classmethod
    def of(cls, frames: Mapping[str, DataFrame]) -> Tables:
        return cls(frames.__getitem__, frames)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> Tables:
        """Billing tables stored as ``root/<table>``, read with declared schemas."""

        def resolve(name: str) -> DataFrame:
            return spark.read.schema(schema.TABLES[name]).parquet(f"{root}/{name}")

        return cls(resolve, schema.TABLES)

    @classmethod
    def from_test_data(cls, spark: SparkSession, sf_dir: str, given: Mapping[str, DataFrame] | None = None) -> Tables:
        """Billing tables derived from the TPC-H-like test files in ``sf_dir``; ``given`` ones are taken as they are."""
        given = given or {}

        def resolve(name: str) -> DataFrame:
            if name in given:
                return given[name]
            if name in billing_views.TEST_TABLES:
                return spark.read.parquet(f"{sf_dir}/{name}.parquet")
            sql = billing_views.VIEWS[name]
            parents = {parent: bundle[parent] for parent in billing_views._references(sql)}
            return spark.sql(billing_views.render(sql, "spark"), **parents)

        bundle = cls(resolve, [*billing_views.TEST_TABLES, *billing_views.VIEWS])
        bundle._derive = lambda frames: cls.from_test_data(spark, sf_dir, {**given, **frames})
        return bundle
