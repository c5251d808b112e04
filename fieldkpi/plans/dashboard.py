"""Dashboard data: indicators for zones 1..15 and the total, evolution series
for target zones, written as JSON documents (page rendering is not built)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evolution, kpi
from ..functions.dates import label_stamp
from ..sources.writers import write_payload

TARGETS = [2.0, 14.0]


def dashboard_data(clean: DataFrame, targets: list[float] = TARGETS, persons: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(per-scope indicator documents, per-target chart documents). The charts come
    from the stored person days where ``persons`` gives them."""
    payload = kpi.dashboard_payload(kpi.dashboard_kpis(clean))
    return payload, evolution.chart_document(evolution.zone_evolution(clean if persons is None else persons, targets=targets))


def write_dashboard(clean: DataFrame, out: str, targets: list[float] = TARGETS, persons: DataFrame | None = None) -> None:
    payload, chart = dashboard_data(clean, targets, persons)
    payload = payload.withColumn("actualizado", label_stamp(F.current_timestamp()))
    write_payload(payload, f"{out}/indicators")
    write_payload(chart, f"{out}/evolution")
