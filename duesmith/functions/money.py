"""Money arithmetic: decimals only, so that sums do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast(MONEY)


def signed(amount: Column | str = "amount", credit: Column | str = "is_accounting_credit") -> Column:
    """Charges count up, credits count down."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    credit = F.col(credit) if isinstance(credit, str) else credit
    return F.when(credit, -amount).otherwise(amount)


def sum_where(condition: Column, amount: Column | str = "amount") -> Column:
    """Sum over the matching rows; NULL when none match, as SQL's SUM."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.sum(F.when(condition, amount))
