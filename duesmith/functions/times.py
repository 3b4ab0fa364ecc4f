"""Wall-clock and UTC handling on timestamps without time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: A stored table may carry the month of a date as its folders; the column's name begins so.
MONTH_OF = "month_of_"


def moment(value: datetime | str) -> datetime:
    return datetime.fromisoformat(value) if isinstance(value, str) else value


def ts(value: datetime | str) -> Column:
    """A timestamp literal that does not depend on the session time zone."""
    return F.lit(moment(value).isoformat(sep=" ")).cast("timestamp_ntz")


def to_utc(local: Column, zone: Column | str) -> Column:
    """Local wall-clock time in an IANA zone to UTC."""
    return F.convert_timezone(F.lit(zone) if isinstance(zone, str) else zone, F.lit("UTC"), local)


def to_utc_by(local: Column, zone: Column, gap: str = "forward", overlap: str = "earlier") -> Column:
    """Local wall-clock time in each row's own zone to UTC, by stated rules where a clock change is near.

    A time that the clocks skip moves on (``forward``) or back by the length of the gap; of the two
    moments of a repeated time the ``earlier`` or the ``later`` one counts.  The offsets a day before
    and a day after tell which case it is.
    """
    if gap not in ("forward", "backward") or overlap not in ("earlier", "later"):
        raise ValueError(f"no such rule: {gap}, {overlap}")
    utc, day = F.lit("UTC"), F.expr("INTERVAL 1 DAY")

    def by_offset_at(probe: Column) -> Column:
        return local - (F.convert_timezone(utc, zone, probe) - probe)

    before, after = by_offset_at(local - day), by_offset_at(local + day)
    before_holds = F.convert_timezone(utc, zone, before) == local
    after_holds = F.convert_timezone(utc, zone, after) == local
    chosen = F.least(before, after) if overlap == "earlier" else F.greatest(before, after)
    return (
        F.when(before_holds & after_holds, chosen)
        .when(before_holds, before)
        .when(after_holds, after)
        .otherwise(before if gap == "forward" else after)
    )


def day_crossings(start: Column | str, end: Column | str) -> Column:
    """Midnights between two timestamps (not elapsed 24-hour spans)."""
    return F.datediff(end, start)


def window(column: Column | str, start: datetime | str, end: datetime | str) -> Column:
    """Half-open ``[start, end)``."""
    column = F.col(column) if isinstance(column, str) else column
    return (column >= ts(start)) & (column < ts(end))


def in_window(
    df: DataFrame, column: str, start: Column | datetime | str, end: Column | datetime | str, closed: bool = False
) -> DataFrame:
    """Rows with ``column`` in ``[start, end)``, or with ``closed`` in ``[start, end]``.

    Where the table is stored by the column's month, the window also becomes a test of its folders,
    so that files of other months are not read.
    """
    start, end = (edge if isinstance(edge, Column) else ts(edge) for edge in (start, end))
    date, month = F.col(column), f"{MONTH_OF}{column}"
    if month in df.columns:
        first, last = (F.date_format(edge, "yyyy-MM") for edge in (start, end))
        df = df.where(F.col(month).between(first, last))
    df = df.where((date >= start) & ((date <= end) if closed else (date < end)))
    return undated(df)


def from_on(df: DataFrame, column: str, start: datetime | str) -> DataFrame:
    """Rows with ``column`` at ``start`` or later; folders of earlier months are not read."""
    month = f"{MONTH_OF}{column}"
    if month in df.columns:
        df = df.where(F.col(month) >= F.date_format(ts(start), "yyyy-MM"))
    return undated(df.where(F.col(column) >= ts(start)))


def undated(df: DataFrame) -> DataFrame:
    """The table without the months of its folders."""
    return df.drop(*[name for name in df.columns if name.startswith(MONTH_OF)])
