"""Calendar helpers: week starts, labels, coercions, formatted shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def week_monday(ts: Column | str) -> Column:
    """Monday of the week (weeks end on Sunday); null stays null."""
    return F.to_date(F.date_trunc("week", _c(ts)))


def week_sunday(ts: Column | str) -> Column:
    """Sunday that starts the week (SQL view convention)."""
    d = F.to_date(_c(ts))
    return F.date_sub(d, F.dayofweek(d) - 1)


def label_day_month(d: Column | str) -> Column:
    """'08 Dec'."""
    return F.date_format(_c(d), "dd MMM")


def label_board_week(d: Column | str) -> Column:
    """'Sem 08 Dec'."""
    return F.concat(F.lit("Sem "), label_day_month(d))


def label_iso(d: Column | str) -> Column:
    return F.date_format(_c(d), "yyyy-MM-dd")


def label_stamp(ts: Column | str) -> Column:
    """'dd/mm/YYYY HH:MM' (the dashboard's update stamp)."""
    return F.date_format(_c(ts), "dd/MM/yyyy HH:mm")


def first_number(label: Column | str) -> Column:
    """First run of digits of a label, as int."""
    return F.regexp_extract(_c(label), r"(\d+)", 1).cast("int")


def coerce_timestamp(col: str, dtype: T.DataType) -> Column:
    """Timestamp coercion with bad text -> null."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.col(col).cast(T.TimestampType())
    if isinstance(dtype, T.DateType):
        return F.col(col).cast(T.TimestampType())
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(F.col(col))
    return F.col(col).cast("string").try_cast(T.TimestampType())


def decimal_comma(col: Column | str, strict: bool = True) -> Column:
    """'-34,5' -> -34.5. Strict raises on bad text (ANSI cast); lenient gives null."""
    txt = F.replace(_c(col).cast("string"), F.lit(","), F.lit("."))
    return txt.cast("double") if strict else txt.try_cast("double")


def share_pct(count: Column | str, denominator: Column | str) -> Column:
    """Half-even rounded percentage, computed as (count / denominator) * 100
    in double precision like the source, with a zero denominator read as 1."""
    den = F.when(_c(denominator) == 0, F.lit(1)).otherwise(_c(denominator))
    return F.bround((_c(count).cast("double") / den.cast("double")) * F.lit(100.0), 0).cast("bigint")


def pct_with_count(pct: Column | str, count: Column | str) -> Column:
    """'P% (N)', nulls as 0."""
    return F.format_string("%d%% (%d)", F.coalesce(_c(pct).cast("bigint"), F.lit(0)),
                           F.coalesce(_c(count).cast("bigint"), F.lit(0)))
