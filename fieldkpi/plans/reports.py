"""Sheet reports: unified week x zone summary, one board per zone."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import constants as K
from ..operators import kpi
from ..sources.writers import write_per_zone, write_sheet


def write_reports(rows: DataFrame, out: str, start: str = K.ACCUMULATION_START) -> None:
    """``rows``: the stored daily counts, or clean rows."""
    summary = kpi.summary_order(kpi.weekly_zone_summary(rows, start=start))
    write_sheet(summary, f"{out}/data_por_comuna")
    write_per_zone(kpi.board_sheet(kpi.zone_boards(rows)), f"{out}/tableros")
