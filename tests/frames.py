"""Hand-made billing tables: rows as dicts, columns not named are NULL."""

from __future__ import annotations

import datetime
from decimal import Decimal

from pyspark.sql import types as T

from duesmith import schema
from duesmith.sources.tables import Tables


def _value(value, kind: T.DataType):
    if value is None:
        return None
    if isinstance(kind, T.DecimalType):
        return Decimal(str(value))
    if isinstance(kind, T.TimestampNTZType) and isinstance(value, str):
        return datetime.datetime.fromisoformat(value)
    return value


def table(spark, name: str, *rows: dict):
    kinds = T._parse_datatype_string(schema.TABLES[name])
    data = [tuple(_value(row.get(f.name), f.dataType) for f in kinds) for row in rows]
    return spark.createDataFrame(data, kinds)


def bundle(spark, **rows: list[dict]) -> Tables:
    """Every billing table, empty unless rows are given."""
    frames: dict = {}

    def resolve(name: str):
        if name not in frames:
            frames[name] = table(spark, name, *rows.get(name, []))
        return frames[name]

    return Tables(resolve, schema.TABLES)


def as_set(df, *columns):
    return {tuple(row) for row in df.select(*columns).collect()}


def tx(id_, invoice, kind=1, amount=10, credit=False, **more):
    base = dict(
        tx_transaction_id=id_, tx_invoice_id=invoice, tx_type_id=kind, amount=amount, is_accounting_credit=credit,
        group_id=1, display_order=1,
    )
    return {**base, **more}
