"""Scalar column expressions used by the marts. All are built-in Spark functions (JVM side, codegen'd)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillgrid.schemas import INCENTIVE_RATE, MONEY

# Text formats of the month key and of ledger timestamps.
MONTH_FORMAT = "yyyy-MM"
STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_key(date_col: str | Column) -> Column:
    """``yyyy-MM`` text of a DATE/TIMESTAMP column (first 7 characters of the ISO date)."""
    return F.date_format(_c(date_col), MONTH_FORMAT)


def month_key_of_text(text_col: str | Column) -> Column:
    """Month key of a date already held as ISO text."""
    return F.substring(_c(text_col), 1, 7)


def full_name(first: str | Column, last: str | Column) -> Column:
    """``first || ' ' || last``; NULL when either part is NULL."""
    return F.concat(_c(first), F.lit(" "), _c(last))


def top_rank_incentive(rank_col: str | Column, total_col: str | Column) -> Column:
    """Rank 1 earns ``round(total * 1 %, 2)``; every other rank earns 0."""
    rate = F.lit(INCENTIVE_RATE).cast("decimal(3,2)")
    pay = F.round(_c(total_col) * rate, 2).cast(MONEY)
    return F.when(_c(rank_col) == 1, pay).otherwise(F.lit(0).cast(MONEY))


def incentive_from_max(total_col: str | Column, max_col: str | Column) -> Column:
    """The same incentive as ``top_rank_incentive`` computed from the group maximum instead of a rank.

    ``rank() ... ORDER BY total DESC`` is 1 exactly for the rows whose total equals the group's maximum; when all totals
    of the group are NULL every row ranks 1 and the incentive is NULL.
    """
    rate = F.lit(INCENTIVE_RATE).cast("decimal(3,2)")
    total, top = _c(total_col), _c(max_col)
    pay = F.round(total * rate, 2).cast(MONEY)
    return (
        F.when(top.isNull(), pay)
        .when(total == top, pay)
        .otherwise(F.lit(0).cast(MONEY))
    )


def pack_columns(columns: Sequence[str | Column], sep: str = ",") -> Column:
    """Pack extra columns into one text column; NULL parts are skipped, no extras gives NULL."""
    if not columns:
        return F.lit(None).cast("string")
    return F.concat_ws(sep, *[_c(c).cast("string") for c in columns])


def stamp_text(ts_col: str | Column) -> Column:
    """Timestamp as ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.date_format(_c(ts_col), STAMP_FORMAT)


def epoch_millis(ts_col: str | Column) -> Column:
    """Epoch milliseconds at second resolution (the run-prefix key).

    A TIMESTAMP is an instant; a TIMESTAMP_NTZ is read as UTC wall time, so the key does not depend on the
    session time zone.
    """
    return F.unix_timestamp(_c(ts_col)).cast("long") * F.lit(1000)
