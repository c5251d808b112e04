"""Adapters that present the driver tables (``orders``, ``events``) as landed
intervention reports.

The derivations are plain SQL expressions shared verbatim by the Spark side
(``selectExpr``) and by the DuckDB oracles, so both start from identical rows.
Every row of the source table becomes one intervention; nothing is filtered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import constants as K
from ..session import spread

# FIXED VALUES (test fixture design): closing codes by source category and the
# supervisor notes written beside them. In each list the first four resolve
# through the exact or substring rules; the other four are for the fuzzy scorer:
# close to and far from its threshold, empty once cleaned, long, and (with a
# number) many distinct ones.
RESULT_CODES = [
    "01-Traslado efectivo a CIS",
    "12–No se contacta y no se observan pertenencias",
    "11-No se contacta y se observan pertenencias",
    "15-Sin cubrir",
    "16-Desestimado (cartas 911 u otras áreas)",
]
SUPERVISOR_NOTES = [
    ["17 - DIPA Derivación a CIS", "Traslado a CIS", "Acepta CIS pero no hay vacante", "Derivación a SAME",
     "Traslado efectivo al CIS", "Acompañamiento a otro efector", "Deriva a SAME", "Activa protocolo salud mental"],
    ["Rechaza entrevista y se retira", "Rechaza entrevista y se queda", "Imposibilidad de abordaje",
     "Mendicidad",
     "Rechaza la entrevista, se retira", "Imposible abordar por consumo", "Rechaza entrevista, queda en el lugar",
     "Menor mendigando"],
    ["Se realiza entrevista", "Derivación a espacio público", "Protocolo de salud mental",
     "21 - Asesoramiento sobre programas",
     "Entrevista realizada", "Derivación a plaza pública", "No estaba en situación de calle", "xyz"],
    ["-", "SIN DATO", None, "N/A",
     "Seguimiento nro #", "Se recorre la zona junto al equipo de noche, se conversa con vecinos y comerciantes, no se ubica a la "
     "persona indicada por el llamado y se deja constancia para el próximo turno", "!!!", "Sin cobertura"],
    ["(Vacio)", "nan", " ", "No se encuentra en situación de calle",
     "No se contacta, se observan pertenencias", "No se contacta ni se observan pertenencias", "Desestimada por carta 911", "Otra área"],
]
NOTE_NUMBERS = 40  # numbers that stand for the # in a note


def _lit(v: str | None, number: str | None = None) -> str:
    if v is None:
        return "NULL"
    text = "'" + v.replace("'", "''") + "'"
    return f"replace({text}, '#', CAST({number} AS STRING))" if number and "#" in v else text


def _case(index_expr: str, values: list, number: str | None = None) -> str:
    whens = " ".join(f"WHEN {i} THEN {_lit(v, number)}" for i, v in enumerate(values))
    return f"CASE {index_expr} {whens} END"


def _closing_cols(code_idx: str, row: str) -> list[tuple[str, str]]:
    result = _case(code_idx, RESULT_CODES)
    notes = "CASE " + " ".join(
        f"WHEN {code_idx} = {i} THEN {_case(f'({row} + CAST(floor({row} / 32) AS BIGINT)) % 8', vals, f'{row} % {NOTE_NUMBERS}')}" for i, vals in enumerate(SUPERVISOR_NOTES)
    ) + " END"
    return [(K.COL_SUPERVISOR, notes), (K.COL_RESULT, result)]


def _dni_expr(person: str) -> str:
    num = f"CAST(20000000 + {person} * 13 AS STRING)"
    return (
        f"CASE {person} % 20 "
        "WHEN 0 THEN 'No brindó' "
        f"WHEN 1 THEN 'Pasaporte ' || CAST({person} * 7 AS STRING) "
        "WHEN 2 THEN NULL "
        "WHEN 3 THEN 'X-X' "
        "WHEN 4 THEN 'menor de edad' "
        f"WHEN 5 THEN substr({num}, 1, 2) || '.' || substr({num}, 3, 3) || '.' || substr({num}, 6, 3) "
        f"WHEN 6 THEN 'DNI ' || {num} "
        f"WHEN 7 THEN CAST({person} AS STRING) "
        f"WHEN 8 THEN CAST({person} AS STRING) || '000000000' "
        "WHEN 9 THEN 'abab' "
        "WHEN 10 THEN '   ' "
        f"WHEN 11 THEN 'cdi ' || CAST({person} AS STRING) "
        f"WHEN 12 THEN '00' || {num} "
        f"ELSE {num} END"
    )


def _person_cols(person: str, row: str) -> list[tuple[str, str]]:
    return [
        (K.COL_DNI, _dni_expr(person)),
        (K.COL_FIRST, _case(f"{person} % 6", ["José", "María Ñandú", "Straße", "Ana-Lía 2", None, "  Luz  "])),
        (K.COL_LAST, _case(f"{person} % 5", ["Pérez", "Gómez, Jr.", "123", "Müller", "Núñez  Díaz"])),
        (K.COL_AGENCY, _case(f"{row} % 9", ["DIPA I COMBATE", None, "MAPA DE REISGO - SEGUIMIENTO", "RED NORTE",
                                            "RED SUR", "RED NORTE", "SALUD MENTAL", "RED OESTE", "RED SUR"])),
        (K.COL_STATE, f"CASE WHEN {row} % 7 = 0 THEN 'PENDIENTE' ELSE 'CERRADA' END"),
        (K.COL_CARD, f"CASE WHEN {row} % 3 <> 0 THEN 'AUTOMATICA' ELSE 'MANUAL' END"),
    ]


def orders_columns() -> list[tuple[str, str]]:
    """(name, SQL expression) over ``orders``."""
    code = ("CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 "
            "WHEN '4-NOT SPECIFIED' THEN 3 ELSE 4 END")
    return [
        (K.COL_ROW_ID, "o_orderkey"),
        (K.COL_START, "CAST(o_orderdate AS TIMESTAMP)"),
        ("Fecha Fin", "CASE WHEN o_orderkey % 11 = 0 THEN 'pendiente' "
                      "ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 10:30:00' END"),
        (K.COL_LAT, "CASE WHEN o_orderkey % 53 = 0 THEN NULL "
                    "ELSE '-34,' || lpad(CAST(710 - ((o_orderkey * 7) % 197) AS STRING), 3, '0') END"),
        (K.COL_LON, "CASE WHEN o_orderkey % 53 = 0 THEN NULL "
                    "ELSE '-58,' || lpad(CAST(540 - (o_orderkey % 229) AS STRING), 3, '0') END"),
        *_person_cols("o_custkey", "o_orderkey"),
        *_closing_cols(code, "o_orderkey"),
    ]


def events_columns() -> list[tuple[str, str]]:
    """(name, SQL expression) over ``events``: points fall around the special zones."""
    code = ("CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'signup' THEN 2 "
            "WHEN 'purchase' THEN 3 ELSE 4 END")
    return [
        (K.COL_ROW_ID, "event_id"),
        (K.COL_START, "CAST(ts AS TIMESTAMP)"),
        (K.COL_LAT, "'-34,' || lpad(CAST(590 - (event_id % 41) AS STRING), 3, '0')"),
        (K.COL_LON, "'-58,' || lpad(CAST(450 - ((event_id * 3) % 61) AS STRING), 3, '0')"),
        *_person_cols("user_id", "event_id"),
        *_closing_cols(code, "event_id"),
    ]


ADAPTERS = {"orders": orders_columns, "events": events_columns}


def spark_select(columns: list[tuple[str, str]]) -> list[str]:
    return [f"{expr} AS `{name}`" for name, expr in columns]


def duckdb_select(columns: list[tuple[str, str]]) -> str:
    return ",\n  ".join(f'{expr} AS "{name}"' for name, expr in columns)


def interventions(spark: SparkSession, sf_dir: str, table: str = "orders") -> DataFrame:
    """Landed interventions derived from a driver table (whole table)."""
    src = spread(spark.read.parquet(f"{sf_dir}/{table}.parquet"))
    return src.selectExpr(*spark_select(ADAPTERS[table]()))


def interventions_sql(table: str = "orders") -> str:
    """DuckDB SELECT producing the same landed interventions."""
    return f"SELECT\n  {duckdb_select(ADAPTERS[table]())}\nFROM {table}"
