"""Catalog helpers: views over the clean table, restore, required-object check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.contact import contact_case_sql
from .readers import _fs
from .snapshots import read_snapshot
from .writers import replace_table

ENRICHED_VIEW = "vista_intervenciones_enriquecida"
POPULATION_VIEW = "vista_poblacion_semanal"
CLEAN_TABLE = "historico_limpio"


def _list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def enriched_view_sql(table: str = CLEAN_TABLE) -> str:
    return f"SELECT *, {contact_case_sql()} AS Categoria_Contacto FROM {table}"


def population_view_sql(table: str = CLEAN_TABLE) -> str:
    """Sunday weeks; first zone of the week by time (row id breaks ties);
    previous week's zone by LAG; new / recurring / migrant."""
    return f"""
WITH BaseSemanal AS (
  SELECT {K.COL_KEY} AS DNI,
         date_sub(to_date(`{K.COL_START}`), dayofweek(`{K.COL_START}`) - 1) AS Semana,
         min_by({K.COL_ZONE}, struct(`{K.COL_START}`, {K.COL_ROW_ID})) AS Comuna_Semanal
  FROM {table}
  WHERE {K.COL_KEY} NOT IN ({_list(K.VIEW_EXCLUDED_KEYS)})
  GROUP BY 1, 2
),
Historial AS (
  SELECT DNI, Semana, Comuna_Semanal,
         LAG(Comuna_Semanal) OVER (PARTITION BY DNI ORDER BY Semana) AS Comuna_Anterior
  FROM BaseSemanal
)
SELECT DNI, Semana, Comuna_Semanal, Comuna_Anterior,
       CASE WHEN Comuna_Anterior IS NULL THEN '{K.VIEW_NEW}'
            WHEN Comuna_Anterior = Comuna_Semanal THEN '{K.VIEW_RECURRING}'
            ELSE '{K.VIEW_MIGRANT}' END AS Condicion_Poblacion
FROM Historial"""


def create_views(spark: SparkSession, table: str = CLEAN_TABLE, temporary: bool = False) -> None:
    """CREATE OR REPLACE the two views (logical plans, expanded at query time)."""
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {ENRICHED_VIEW} AS {enriched_view_sql(table)}")
    spark.sql(f"CREATE OR REPLACE {kind} {POPULATION_VIEW} AS {population_view_sql(table)}")


def restore(spark: SparkSession, parquet_path: str, table: str = CLEAN_TABLE) -> bool:
    """Stored clean parquet -> table -> views; stops (False) when absent or empty."""
    fs, p = _fs(spark, parquet_path)
    if not fs.exists(p):
        return False
    df = read_snapshot(spark, parquet_path)
    if df.isEmpty():
        return False
    replace_table(df, table)
    create_views(spark, table)
    return True


def missing_objects(spark: SparkSession, required: list[str] = K.REQUIRED_TABLES,
                    database: str | None = None) -> DataFrame:
    """Required tables / views absent from the catalog (anti join)."""
    found = [(t.name, t.tableType) for t in spark.catalog.listTables(database)]
    found_df = spark.createDataFrame(found or [("", "")], "name string, type string")
    req = spark.createDataFrame([(r,) for r in required], "name string")
    return req.join(found_df, "name", "left_anti")
