"""The registered queries: each pairs a Spark plan with SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from duesmith.sources.tables import Tables


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    check: str | None = None  # DuckDB SQL; ``{name}`` refers to a billing view


def catalog() -> dict[str, Query]:
    from duesmith.plans import cascades, defects, receivables, repairs

    merged: dict[str, Query] = {}
    for module in (receivables, defects, repairs, cascades):
        merged.update(module.QUERIES)
    return merged
