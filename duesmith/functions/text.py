"""Text helpers: card labels and LIKE with a chosen case rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First two characters of a payment token and the tender they stand for.
TOKEN_TENDERS = {
    "AC": "AMEX",
    "VC": "VISA",
    "VD": "VISA",
    "MC": "MC",
    "MD": "MC",
    "BC": "Bank Draft(US)",
    "DC": "DISC",
}
BANK_DRAFT = "BC"


def token_label(token: Column) -> Column:
    """``VISA:1234``; a bank draft shows three digits; unknown prefixes give NULL."""
    prefix = F.substring(token, 1, 2)
    tender = F.lit(None).cast("string")
    for code, name in TOKEN_TENDERS.items():
        tender = F.when(prefix == code, name).otherwise(tender)
    digits = F.when(prefix == BANK_DRAFT, F.right(token, F.lit(3))).otherwise(F.right(token, F.lit(4)))
    return F.concat(tender, F.lit(":"), digits)


def like(column: Column | str, pattern: str, ignore_case: bool = False) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    if ignore_case:
        column = F.collate(column, "UTF8_LCASE")
    return column.like(pattern)
