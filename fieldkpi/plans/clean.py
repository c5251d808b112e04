"""Weekly clean job: landed report -> typed -> classified -> zoned -> keyed ->
evolution-labelled clean history.

Order differs from the source only where rows do not interact: the agency
filter runs first (so it prunes before any join), the outcome classification
runs before the zone join (so the distinct texts for the fuzzy fallback are
computed from the scan alone). Results are the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.dates import coerce_timestamp, decimal_comma
from ..functions.ids import with_dni
from ..functions.text import with_clean_names
from ..operators.classify import closing_columns
from ..operators.evolution import label_rows
from ..operators.geo import assign_zone, zone_index


def type_report(raw: DataFrame, strict_coordinates: bool = True) -> DataFrame:
    """Optional date columns -> timestamp (bad text -> null); decimal-comma
    coordinates -> double (bad text raises unless ``strict_coordinates`` is False)."""
    types = dict((f.name, f.dataType) for f in raw.schema.fields)
    out = raw
    for c in K.OPTIONAL_DATE_COLS:
        if c in types:
            out = out.withColumn(c, coerce_timestamp(c, types[c]))
    for c in (K.COL_LAT, K.COL_LON):
        if c in types:
            out = out.withColumn(c, decimal_comma(c, strict=strict_coordinates))
    return out


def drop_agencies(df: DataFrame, agencies: list[str] = K.AGENCIES_DROPPED) -> DataFrame:
    """Drop listed agencies; rows with a null agency stay."""
    return df.where(~F.coalesce(F.col(K.COL_AGENCY).isin(agencies), F.lit(False)))


def clean_rows(raw: DataFrame, zones: DataFrame, fuzzy_fallback: bool = True, cell: float = 0.0025) -> DataFrame:
    """Row-wise part of the clean step (no row depends on another)."""
    df = drop_agencies(type_report(raw))
    df = closing_columns(df, fuzzy_fallback=fuzzy_fallback)
    df = assign_zone(df, zones, cell=cell)
    df = with_dni(df)
    return with_clean_names(df, [K.COL_FIRST, K.COL_LAST])


def keyed_rows(raw: DataFrame, zones) -> DataFrame:
    """Row id, date, person key and zone of the same rows: all that the labels
    depend on, without the outcome texts."""
    df = drop_agencies(type_report(raw)).select(K.COL_ROW_ID, K.COL_START, K.COL_LON, K.COL_LAT, K.COL_DNI)
    return with_dni(assign_zone(df, zones), reason=False)


def clean_history(raw: DataFrame, zones: DataFrame, fuzzy_fallback: bool = True,
                  cell: float = 0.0025,
                  diagnostics: dict | None = None, prior: DataFrame | None = None) -> DataFrame:
    """Full clean step over the whole history: one lazy plan, apart from two
    tables that are checkpointed first because their sizes are part of it (the
    scored texts that no rule resolves, and the zone cells).

    With ``diagnostics`` (a dict), two ``Observation`` objects are attached:
    ``zones`` (rows per zone class before de-duplication) and ``kept`` (rows
    after it); they fill in during the job's own action, with no extra pass.
    Use ``clean_diagnostics`` to read them. ``prior`` is passed to the
    evolution labels (incremental runs).
    """
    index = zone_index(zones, cell)
    df = clean_rows(raw, index, fuzzy_fallback)
    if diagnostics is not None:
        z = F.col(K.COL_ZONE)
        diagnostics["zones"] = Observation("zones")
        df = df.observe(diagnostics["zones"], F.count(F.lit(1)).alias("rows"),
                        F.count_if(z == K.ZONE_SPECIAL_14_5).alias("zone_14_5"),
                        F.count_if(z == K.ZONE_SPECIAL_2_5).alias("zone_2_5"),
                        F.count_if(z.between(1, 15)).alias("zones_1_15"),
                        F.count_if(z.isNull()).alias("no_zone"))
    out = label_rows(df, prior=prior, keyed=keyed_rows(raw, index))
    if diagnostics is not None:
        diagnostics["kept"] = Observation("kept")
        out = out.observe(diagnostics["kept"], F.count(F.lit(1)).alias("rows"))
    return out


def clean_diagnostics(diagnostics: dict) -> dict:
    """Counts gathered by the observations (after the clean job's action)."""
    zones = diagnostics["zones"].get
    kept = diagnostics["kept"].get
    return {**zones, "duplicates_removed": zones["rows"] - kept["rows"]}

