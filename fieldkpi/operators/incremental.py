"""Append a landed report to the raw history by high-water mark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K


def rows_after(landed: DataFrame, has_history: bool, mark, ts: str = K.COL_START) -> DataFrame:
    """Rows of ``landed`` strictly later than the stored history's latest date
    ``mark``: all without history, none if the history holds no date."""
    if not has_history:
        return landed
    return landed.where(F.col(ts) > F.lit(mark).cast("timestamp"))


def new_rows(history: DataFrame | None, landed: DataFrame, ts: str = K.COL_START) -> DataFrame:
    """Rows of ``landed`` strictly later than the history's latest date.

    No history (absent or empty): every landed row, null dates included.
    With history, null dates are dropped (a null never compares greater), and
    if every history date is null nothing qualifies - as the source does.
    The mark is a scalar subquery: planned once, no join with the big side.
    """
    if history is None or history.isEmpty():
        return landed
    mark = history.select(F.max(ts)).scalar()
    return landed.where(F.col(ts) > mark)


def append_new(history: DataFrame | None, landed: DataFrame, ts: str = K.COL_START) -> tuple[DataFrame, bool]:
    """(updated history, whether anything was appended).

    Columns align by name; columns missing on either side become null.
    When nothing is new the history is returned unchanged (callers then skip
    rewriting it).
    """
    fresh = new_rows(history, landed, ts)
    if history is None:
        return fresh, True
    if fresh.isEmpty():
        return history, False
    return history.unionByName(fresh, allowMissingColumns=True), True
