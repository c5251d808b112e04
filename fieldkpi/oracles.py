"""DuckDB SQL oracles for the registered queries.

These are set-based formulations of the same semantics, written for DuckDB over
the driver's pre-registered views. They are used only for verification (the
driver and the test-suite run them side by side with the Spark queries). Shared
with the operators are the fixture adapter (sources/fixtures.py) and the fixed
values of constants.py (codes, word lists, patterns, baselines). Zone edges are
read from the GeoJSON files by DuckDB, and the labels and types of the published
documents are written out here by hand.
"""

from __future__ import annotations

import os

from . import constants as K
from .sources import fixtures

ASSETS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "assets")


def q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def _re(p: str) -> str:
    return q(p)


# -- scalar rules ------------------------------------------------------------

def name_sql(x: str) -> str:
    s = f"strip_accents(upper(replace({x}, 'ß', 'SS')))"
    s = f"regexp_replace({s}, '[-.,]', ' ', 'g')"
    s = f"regexp_replace({s}, '[^A-Z ]', '', 'g')"
    s = f"trim(regexp_replace({s}, ' +', ' ', 'g'))"
    return f"nullif({s}, '')"


def closing_sql(x: str) -> str:
    s = f"replace(strip_accents(lower(trim({x}, ' ' || chr(9) || chr(10) || chr(13)))), 'ß', 'ss')"
    s = f"regexp_replace({s}, '[^a-z0-9\\s]', ' ', 'g')"
    s = f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"
    return f"coalesce({s}, '')"


# FIXED VALUES: cleaned fixture notes that no rule resolves and whose best label
# reaches the fuzzy threshold (outcome_fuzzy_sql computes the scores)
FUZZY_ACCEPTED = {
    "acompanamiento a otro efector": "derivacion a same",
    "activa protocolo salud mental": "se activa protocolo de salud mental",
    "derivacion a plaza publica": "derivacion a same",
    "desestimada por carta 911": "desestimado (cartas 911 u otras areas)",
    "entrevista realizada": "rechaza entrevista y se retira del lugar",
    "imposible abordar por consumo": "imposibilidad de abordaje por consumo",
    "no estaba en situacion de calle": "no se encuentra en situacion de calle",
    "no se contacta ni se observan pertenencias": "no se contacta y se observan pertenencias",
    "no se contacta se observan pertenencias": "no se contacta y se observan pertenencias",
    "otra area": "desestimado (cartas 911 u otras areas)",
    "rechaza entrevista queda en el lugar": "rechaza entrevista y se queda en el lugar",
    "rechaza la entrevista se retira": "rechaza entrevista y se retira del lugar",
    "se recorre la zona junto al equipo de noche se conversa con vecinos y comerciantes no se ubica a la persona indicada por el llamado y se deja constancia para el proximo turno":
        "traslado efectivo a cis",
    "traslado efectivo al cis": "traslado efectivo a cis",
}


def rule_sql(t: str) -> str:
    """Category by the exact and substring rules, else null."""
    exact = " ".join(f"WHEN {t} = {q(k)} THEN {q(v)}" for k, v in K.EXACT_RULES.items())
    subs = " ".join(f"WHEN contains({t}, {q(p)}) THEN {q(c)}" for p, c in K.SUBSTRING_RULES)
    return f"CASE {exact} {subs} END"


def category_sql(t: str) -> str:
    fuzzy = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in FUZZY_ACCEPTED.items())
    return f"coalesce({rule_sql(t)}, CASE {t} {fuzzy} ELSE {q(K.NO_MATCH)} END)"


def levels_sql(c: str) -> tuple[str, str]:
    lvl = (f"CASE WHEN {c} IN {in_list(K.CATEGORIES_GIVES_DATA)} THEN {q(K.LEVEL_CONTACTS)} "
           f"WHEN {c} IN {in_list(K.CATEGORIES_NO_DATA)} THEN {q(K.LEVEL_CONTACTS)} "
           f"WHEN {c} IN {in_list(K.CATEGORIES_NO_CONTACT)} THEN {q(K.LEVEL_NO_CONTACT)} "
           f"ELSE {q(K.LEVEL_OTHER)} END")
    gives = (f"CASE WHEN {c} IN {in_list(K.CATEGORIES_GIVES_DATA)} THEN {q(K.GIVES_DATA)} "
             f"WHEN {c} IN {in_list(K.CATEGORIES_NO_DATA)} THEN {q(K.GIVES_NO_DATA)} ELSE '' END")
    return lvl, gives


def dni_sql(x: str) -> tuple[str, str]:
    s = f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
    low = f"lower({s})"
    digits = f"regexp_replace({s}, '[^0-9]', '', 'g')"
    conds = [
        (f"{x} IS NULL", q(K.KEY_NOT_GIVEN), K.REASON_NULL),
        (f"{s} = ''", q(K.KEY_NOT_GIVEN), K.REASON_EMPTY),
        (f"regexp_matches({low}, {_re('(?i)' + K.PATTERN_NOT_GIVEN)})", q(K.KEY_NOT_GIVEN), K.REASON_NOT_GIVEN),
        (f"(regexp_matches({s}, {_re(K.PATTERN_SYMBOLS)}) OR regexp_matches({s}, {_re(K.PATTERN_SHORT_LETTERS)}))",
         q(K.KEY_NOT_GIVEN), K.REASON_SYMBOLS),
        (f"(regexp_matches({s}, {_re(K.PATTERN_LETTERS_ONLY)}) AND "
         f"length(list_distinct(string_split({low}, ''))) <= 2)", q(K.KEY_NOT_GIVEN), K.REASON_REPEATED),
        (f"regexp_matches({low}, {_re('(?i)' + K.PATTERN_FOREIGN)})", q(K.KEY_FOREIGN), K.REASON_FOREIGN),
        (f"length({digits}) BETWEEN 6 AND 10", f"CAST(CAST({digits} AS HUGEINT) AS VARCHAR)", K.REASON_VALID),
        (f"(length({digits}) < 6 OR regexp_matches({low}, '[A-Za-z]'))", q(K.KEY_NOT_GIVEN), K.REASON_TEXT_SHORT),
    ]
    value = "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v, _ in conds) + f" ELSE {q(K.KEY_NOT_GIVEN)} END"
    reason = "CASE " + " ".join(f"WHEN {c} THEN {q(r)}" for c, _, r in conds) + f" ELSE {q(K.REASON_REST)} END"
    return value, reason


def contact_plain_sql(state: str = '"Estado"', result: str = '"Resultado"') -> str:
    return (f"CASE WHEN {state} = {q(K.STATE_PENDING)} THEN {q(K.UNCOVERED)} "
            f"WHEN {result} IN {in_list(K.RESULTS_NO_CONTACT)} THEN {q(K.NO_CONTACT)} "
            f"WHEN {result} = {q(K.RESULT_UNCOVERED)} THEN {q(K.UNCOVERED)} ELSE {q(K.CONTACT)} END")


def contact_dash_sql(zone: str, state: str = '"Estado"', result: str = '"Resultado"') -> str:
    exc = f"coalesce(CAST(trunc({zone}) AS INTEGER) IN (2, 14), false)"
    return (f"CASE WHEN {state} = {q(K.STATE_PENDING)} AND NOT {exc} THEN {q(K.UNCOVERED)} "
            f"WHEN {result} IN {in_list(K.RESULTS_NO_CONTACT)} THEN {q(K.NO_CONTACT)} "
            f"WHEN {result} = {q(K.RESULT_UNCOVERED)} THEN {q(K.UNCOVERED)} ELSE {q(K.CONTACT)} END")


def pct_sql(n: str, den: str) -> str:
    return (f"CAST(round_even(CAST({n} AS DOUBLE) / CAST(CASE WHEN {den} = 0 THEN 1 ELSE {den} END AS DOUBLE)"
            f" * 100.0, 0) AS BIGINT)")


def fmt_sql(pct: str, n: str) -> str:
    return f"CAST({pct} AS VARCHAR) || '% (' || CAST({n} AS VARCHAR) || ')'"


# -- clean table ---------------------------------------------------------------

DEMO_LAYERS = [(os.path.join(ASSETS, "demo_zones.geojson"), "zone", None)]
DETAILED_LAYERS = [(os.path.join(ASSETS, "detailed_zones.geojson"), "comuna", None),
                   (os.path.join(ASSETS, "detailed_special.geojson"), None, 14.5)]


def zone_ctes(points: str, layers=None) -> str:
    """CTEs zedges, zhits, zone_of(row_id, zone) for points (row_id, "Longitud",
    "Latitud"). The edges are read from the GeoJSON files here, by DuckDB."""
    feats = "\n  UNION ALL ".join(
        "SELECT " + (f"{fixed}" if fixed is not None else f"CAST(f->'properties'->>'{prop}' AS DOUBLE)") + " AS zone, "
        f"CAST(f->'geometry'->'coordinates' AS DOUBLE[][][]) AS rings "
        f"FROM (SELECT unnest(CAST(CAST(content AS JSON)->'features' AS JSON[])) AS f FROM read_text({q(path)}))"
        for path, prop, fixed in layers or DEMO_LAYERS)
    return f"""zfeat AS (
  {feats}
),
zring AS (SELECT zone, row_number() OVER () AS poly, rings FROM zfeat),
zline AS (SELECT zone, poly, unnest(rings) AS r FROM zring),
zraw AS (
  SELECT zone, poly, unnest(list_transform(range(1, len(r)), lambda i: {{'x1': r[i][1], 'y1': r[i][2], 'x2': r[i + 1][1], 'y2': r[i + 1][2]}})) AS e FROM zline
),
zbox AS (SELECT poly, min(e.x1) AS minx, min(e.y1) AS miny, max(e.x1) AS maxx, max(e.y1) AS maxy FROM zraw GROUP BY poly),
zedges AS (
  SELECT zone, CASE WHEN zone = 2.5 THEN 0 WHEN zone = 14.5 THEN 1 ELSE 2 END AS prio, zraw.poly, minx, miny, maxx, maxy, e.x1 AS x1, e.y1 AS y1, e.x2 AS x2, e.y2 AS y2
  FROM zraw JOIN zbox USING (poly)
),
zcand AS (
  SELECT p.row_id, p."Longitud" AS px, p."Latitud" AS py, e.*
  FROM {points} p JOIN zedges e
    ON p."Longitud" > e.minx AND p."Longitud" < e.maxx AND p."Latitud" > e.miny AND p."Latitud" < e.maxy
),
zin AS (
  SELECT row_id, zone, prio
  FROM zcand
  GROUP BY row_id, zone, prio, poly
  HAVING sum(CASE WHEN (y1 > py) <> (y2 > py) AND px < (x2 - x1) * (py - y1) / (y2 - y1) + x1
                  THEN 1 ELSE 0 END) % 2 = 1
     AND sum(CASE WHEN (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1) = 0
                   AND px BETWEEN least(x1, x2) AND greatest(x1, x2)
                   AND py BETWEEN least(y1, y2) AND greatest(y1, y2) THEN 1 ELSE 0 END) = 0
),
zone_of AS (
  SELECT row_id, arg_min(zone, prio * 1000 + zone) AS zone FROM zin GROUP BY row_id
)"""


def clean_ctes(table: str = "orders") -> str:
    """CTE chain ending in ``clean`` (the clean history) from a driver table."""
    date_cols = [c for c, _ in fixtures.ADAPTERS[table]() if c in K.OPTIONAL_DATE_COLS and c != K.COL_START]
    coerce = ", ".join(f'TRY_CAST("{c}" AS TIMESTAMP) AS "{c}"' for c in date_cols)
    coerce = (coerce + ", ") if coerce else ""
    lvl, gives = levels_sql("categoria_final")
    dval, dreason = dni_sql('"Persona DNI"')
    anon = in_list(K.ANONYMOUS_KEYS)
    return f"""raw AS (
{fixtures.interventions_sql(table)}
),
typed AS (
  SELECT * REPLACE ({coerce}CAST(replace("Latitud", ',', '.') AS DOUBLE) AS "Latitud",
                    CAST(replace("Longitud", ',', '.') AS DOUBLE) AS "Longitud")
  FROM raw
),
kept AS (
  SELECT * FROM typed WHERE NOT coalesce("Agencia" IN {in_list(K.AGENCIES_DROPPED)}, false)
),
blanked AS (
  SELECT * REPLACE (
    CASE WHEN "Cierre Supervisor" IN {in_list(K.EMPTY_MARKERS)} THEN NULL ELSE "Cierre Supervisor" END
      AS "Cierre Supervisor",
    CASE WHEN "Resultado" IN {in_list(K.EMPTY_MARKERS)} THEN NULL ELSE "Resultado" END AS "Resultado")
  FROM kept
),
texts AS (
  SELECT *, coalesce("Cierre Supervisor", "Resultado") AS cierre_texto FROM blanked
),
texts2 AS (
  SELECT *, {closing_sql('cierre_texto')} AS texto_limpio FROM texts
),
cats AS (
  SELECT *, {category_sql('texto_limpio')} AS categoria_final FROM texts2
),
lv AS (
  SELECT *, {lvl} AS contacto, {gives} AS brinda_datos FROM cats
),
{zone_ctes('lv')},
zoned AS (
  SELECT lv.*, zone_of.zone AS comuna_calculada FROM lv LEFT JOIN zone_of USING (row_id)
),
keyed AS (
  SELECT * REPLACE ({name_sql('"Persona Nombre"')} AS "Persona Nombre",
                    {name_sql('"Persona Apellido"')} AS "Persona Apellido"),
         {dval} AS "DNI_Categorizado", {dreason} AS "DNI_Categorizado_motivo",
         CAST(date_trunc('week', "Fecha Inicio") AS DATE) AS wk
  FROM zoned
),
ident AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY wk, "DNI_Categorizado"
                                 ORDER BY "Fecha Inicio" DESC, row_id DESC) AS rn
    FROM keyed WHERE NOT coalesce("DNI_Categorizado" IN {anon}, false) AND wk IS NOT NULL
  ) WHERE rn = 1
),
labelled AS (
  SELECT * EXCLUDE (rn),
    CASE WHEN lag(wk) OVER w IS NULL THEN '{K.EVO_NEW}'
         WHEN lag(comuna_calculada) OVER w IS NOT NULL AND lag(comuna_calculada) OVER w = comuna_calculada
           THEN '{K.EVO_RECURRING}'
         ELSE '{K.EVO_MIGRANT}' END AS "Tipo_Evolucion"
  FROM ident WINDOW w AS (PARTITION BY "DNI_Categorizado" ORDER BY wk)
),
clean AS (
  SELECT * EXCLUDE (wk) FROM labelled
  UNION ALL BY NAME
  SELECT * EXCLUDE (wk), '{K.EVO_UNCLASSIFIED}' AS "Tipo_Evolucion" FROM keyed
  WHERE coalesce("DNI_Categorizado" IN {anon}, false) OR wk IS NULL
)"""


def with_clean(table: str, body: str) -> str:
    return f"WITH {clean_ctes(table)},\n{body}"


# -- reports ---------------------------------------------------------------------

def dashboard_kpis_sql(table: str = "orders") -> str:
    scopes = [f"c{z}" for z in K.DASH_ZONES] + [K.DASH_TOTAL_SCOPE]
    scope_vals = ", ".join(f"('{s}')" for s in scopes)
    zone_vals = ", ".join(f"{float(z)}" for z in K.DASH_ZONES)
    cls = contact_dash_sql("zone")
    counts = ("count(*) AS total, count_if(\"Resultado\" = " + q(K.RESULT_CIS) + ") AS cis, "
              "count_if(\"Tipo Carta\" = 'AUTOMATICA') AS calls, "
              "count_if(\"Tipo Carta\" = 'AUTOMATICA' AND cls = 'Se contacta') AS n_contact, "
              "count_if(\"Tipo Carta\" = 'AUTOMATICA' AND cls = 'No se contacta') AS n_no_contact, "
              "count_if(\"Tipo Carta\" = 'AUTOMATICA' AND cls = 'Sin cubrir') AS n_uncovered")

    def base(i, col, vals):
        return (f"CASE scope WHEN 'c2' THEN {q(K.DASH_BASELINE_ZONE2[i])} WHEN 'c14' THEN "
                f"{q(K.DASH_BASELINE_ZONE14[i])} WHEN 'total' THEN {q(K.DASH_BASELINE_TOTAL[i])} "
                f"ELSE {q(K.DASH_BASELINE_EMPTY[i])} END AS {col}")

    bases = ", ".join(base(i, c, None) for i, c in enumerate(
        ["base_total", "base_cis", "base_calls", "base_contact", "base_no_contact", "base_uncovered"]))
    body = f"""b AS (
  SELECT CAST(date_trunc('week', "Fecha Inicio") AS DATE) AS week, comuna_calculada AS zone,
         "Estado", "Resultado", "Tipo Carta" FROM clean
),
weeks AS (SELECT DISTINCT week FROM b WHERE week IS NOT NULL ORDER BY week DESC LIMIT {K.LAST_WEEKS}),
b8 AS (SELECT *, {cls} AS cls FROM b WHERE week IN (SELECT week FROM weeks)),
agg AS (
  SELECT week, 'c' || CAST(CAST(zone AS INTEGER) AS VARCHAR) AS scope, {counts}
  FROM b8 WHERE zone IN ({zone_vals}) GROUP BY week, zone
  UNION ALL
  SELECT week, 'total' AS scope, {counts} FROM b8 GROUP BY week
),
scopes(scope) AS (VALUES {scope_vals}),
grid AS (SELECT w.week, s.scope FROM weeks w CROSS JOIN scopes s),
filled AS (
  SELECT g.scope, g.week, strftime(g.week, '%d %b') AS week_label,
         CAST(coalesce(a.total, 0) AS BIGINT) AS total, CAST(coalesce(a.cis, 0) AS BIGINT) AS cis,
         CAST(coalesce(a.calls, 0) AS BIGINT) AS calls,
         CAST(coalesce(a.n_contact, 0) AS BIGINT) AS n_contact,
         CAST(coalesce(a.n_no_contact, 0) AS BIGINT) AS n_no_contact,
         CAST(coalesce(a.n_uncovered, 0) AS BIGINT) AS n_uncovered
  FROM grid g LEFT JOIN agg a ON a.week = g.week AND a.scope = g.scope
),
p AS (
  SELECT *, {pct_sql('n_contact', 'n_contact + n_no_contact + n_uncovered')} AS pct_contact,
            {pct_sql('n_no_contact', 'n_contact + n_no_contact + n_uncovered')} AS pct_no_contact,
            {pct_sql('n_uncovered', 'n_contact + n_no_contact + n_uncovered')} AS pct_uncovered
  FROM filled
)
SELECT scope, week, week_label, total, cis, calls, n_contact, pct_contact,
       {fmt_sql('pct_contact', 'n_contact')} AS fmt_contact, n_no_contact, pct_no_contact,
       {fmt_sql('pct_no_contact', 'n_no_contact')} AS fmt_no_contact, n_uncovered, pct_uncovered,
       {fmt_sql('pct_uncovered', 'n_uncovered')} AS fmt_uncovered, {bases}
FROM p"""
    return with_clean(table, body)


def clean_history_sql(table: str = "orders") -> str:
    return with_clean(table, "final AS (SELECT * FROM clean)\nSELECT * FROM final")


def _counts_sql(cis_cond: str) -> str:
    auto = "\"Tipo Carta\" = 'AUTOMATICA'"
    return (f"count(*) AS total, count_if({cis_cond}) AS cis, count_if({auto}) AS calls, "
            f"count_if({auto} AND cls = 'Se contacta') AS n_contact, "
            f"count_if({auto} AND cls = 'No se contacta') AS n_no_contact, "
            f"count_if({auto} AND cls = 'Sin cubrir') AS n_uncovered")


def zone_boards_sql(table: str = "orders") -> str:
    cnt = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in
                    ["total", "cis", "calls", "n_contact", "n_no_contact", "n_uncovered"])
    den = "n_contact + n_no_contact + n_uncovered"

    def base(i, col):
        return (f"CASE WHEN zone = 2.0 THEN {q(K.BOARD_BASELINE_ZONE2[i])} WHEN zone = 14.0 THEN "
                f"{q(K.BOARD_BASELINE_ZONE14[i])} ELSE {q(K.BOARD_BASELINE_CITY[i])} END AS {col}")

    bases = ", ".join(base(i, c) for i, c in enumerate(
        ["base_total", "base_cis", "base_calls", "base_contact", "base_no_contact", "base_uncovered"]))
    body = f"""b AS (
  SELECT comuna_calculada AS zone, CAST(date_trunc('week', "Fecha Inicio") AS DATE) AS week,
         "Resultado", "Tipo Carta", {contact_plain_sql()} AS cls
  FROM clean WHERE comuna_calculada IS NOT NULL AND "Fecha Inicio" IS NOT NULL
),
agg AS (SELECT zone, week, {_counts_sql('"Resultado" = ' + q(K.RESULT_CIS))} FROM b GROUP BY zone, week),
r AS (SELECT *, dense_rank() OVER (PARTITION BY zone ORDER BY week DESC) AS rk FROM agg),
p AS (
  SELECT zone, week, {cnt},
         {pct_sql('n_contact', den)} AS pct_contact, {pct_sql('n_no_contact', den)} AS pct_no_contact,
         {pct_sql('n_uncovered', den)} AS pct_uncovered
  FROM r WHERE rk <= {K.LAST_WEEKS}
)
SELECT zone, week, 'Sem ' || strftime(week, '%d %b') AS week_label, total, cis, calls, n_contact, n_no_contact,
       n_uncovered, pct_contact, pct_no_contact, pct_uncovered,
       {fmt_sql('pct_contact', 'n_contact')} AS fmt_contact, {fmt_sql('pct_no_contact', 'n_no_contact')} AS fmt_no_contact,
       {fmt_sql('pct_uncovered', 'n_uncovered')} AS fmt_uncovered, {bases}
FROM p"""
    return with_clean(table, body)


def _acc_cte(src: str, zone: str, start: str) -> str:
    return f"""acc AS (
  SELECT {zone} AS zone, {_counts_sql('categoria_final = ' + q(K.CATEGORY_CIS))}
  FROM {src} WHERE "Fecha Inicio" >= TIMESTAMP '{start}' AND {zone} IS NOT NULL GROUP BY {zone}
)"""


ACC_RENAMES = [("total", "acum_total"), ("cis", "acum_cis"), ("calls", "acum_llamados"),
               ("n_contact", "Se contacta_y"), ("n_no_contact", "No se contacta_y"),
               ("n_uncovered", "Sin cubrir_y")]


def zone_accumulated_sql(table: str, start: str) -> str:
    sel = ", ".join(f'CAST({a} AS BIGINT) AS "{b}"' for a, b in ACC_RENAMES)
    body = f"""cb AS (SELECT *, {contact_plain_sql()} AS cls FROM clean),
{_acc_cte('cb', 'comuna_calculada', start)}
SELECT zone, {sel} FROM acc"""
    return with_clean(table, body)


def weekly_zone_summary_sql(table: str, start: str) -> str:
    den = "calls"
    acc_sel = ", ".join(f'CAST(coalesce(acc.{a}, 0) AS BIGINT) AS "{b}"' for a, b in ACC_RENAMES)
    body = f"""b AS (
  SELECT CAST(trunc(comuna_calculada) AS DOUBLE) AS z, CAST(date_trunc('week', "Fecha Inicio") AS DATE) AS w,
         "Fecha Inicio", "Tipo Carta", categoria_final, {contact_plain_sql()} AS cls
  FROM clean WHERE comuna_calculada IS NOT NULL
),
weekly AS (
  SELECT w, z, {_counts_sql('categoria_final = ' + q(K.CATEGORY_CIS))} FROM b WHERE w IS NOT NULL GROUP BY w, z
),
{_acc_cte('b', 'z', start)}
SELECT strftime(w, '%Y-%m-%d') AS "Semana", 'Comuna ' || CAST(CAST(weekly.z AS INTEGER) AS VARCHAR) AS "Comuna",
       CAST(weekly.total AS BIGINT) AS "Intervenciones totales", CAST(weekly.cis AS BIGINT) AS "Derivaciones CIS",
       CAST(weekly.calls AS BIGINT) AS "Llamados 108",
       {fmt_sql(pct_sql('weekly.n_contact', 'weekly.calls'), 'weekly.n_contact')} AS "% Se contacta",
       {fmt_sql(pct_sql('weekly.n_no_contact', 'weekly.calls'), 'weekly.n_no_contact')} AS "% No se contacta",
       {fmt_sql(pct_sql('weekly.n_uncovered', 'weekly.calls'), 'weekly.n_uncovered')} AS "% Sin cubrir",
       {acc_sel}
FROM weekly LEFT JOIN acc ON acc.zone = weekly.z"""
    return with_clean(table, body)


def zone_evolution_sql(table: str, targets=(2.0, 14.0)) -> str:
    tv = ", ".join(f"({float(t)})" for t in targets)
    tl = ", ".join(str(float(t)) for t in targets)
    body = f"""b AS (
  SELECT "DNI_Categorizado" AS key, comuna_calculada AS zone, "Fecha Inicio" AS ts, row_id,
         CAST(date_trunc('week', "Fecha Inicio") AS DATE) AS week
  FROM clean WHERE "Fecha Inicio" IS NOT NULL
),
f AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY week, key ORDER BY ts, row_id) AS rn FROM b)
  WHERE rn = 1
),
lab AS (
  SELECT *, lag(week) OVER w IS NULL AS is_first, lag(zone) OVER w AS prev
  FROM f WINDOW w AS (PARTITION BY key ORDER BY week)
),
cnt AS (
  SELECT zone AS target, week, count_if(is_first) AS nuevos,
         count_if(NOT is_first AND prev = zone) AS recurrentes,
         count_if(NOT is_first AND NOT coalesce(prev = zone, false)) AS migratorios
  FROM lab WHERE zone IN ({tl}) GROUP BY zone, week
),
weeks AS (SELECT DISTINCT week FROM b ORDER BY week DESC LIMIT {K.LAST_WEEKS}),
grid AS (SELECT t.target, weeks.week FROM weeks CROSS JOIN (VALUES {tv}) t(target))
SELECT g.target, g.week, strftime(g.week, '%d %b') AS week_label,
       CAST(coalesce(c.nuevos, 0) AS BIGINT) AS nuevos, CAST(coalesce(c.recurrentes, 0) AS BIGINT) AS recurrentes,
       CAST(coalesce(c.migratorios, 0) AS BIGINT) AS migratorios,
       CAST(coalesce(c.nuevos, 0) + coalesce(c.recurrentes, 0) + coalesce(c.migratorios, 0) AS BIGINT) AS total
FROM grid g LEFT JOIN cnt c ON c.target = g.target AND c.week = g.week"""
    return with_clean(table, body)


def population_weekly_sql(table: str) -> str:
    body = f"""b AS (
  SELECT "DNI_Categorizado" AS "DNI",
         CAST("Fecha Inicio" AS DATE) - CAST(dayofweek("Fecha Inicio") AS INTEGER) AS "Semana",
         comuna_calculada, "Fecha Inicio", row_id
  FROM clean WHERE "DNI_Categorizado" NOT IN {in_list(K.VIEW_EXCLUDED_KEYS)}
),
f AS (
  SELECT "DNI", "Semana", comuna_calculada AS "Comuna_Semanal" FROM (
    SELECT *, row_number() OVER (PARTITION BY "DNI", "Semana" ORDER BY "Fecha Inicio", row_id) AS rn FROM b)
  WHERE rn = 1
),
h AS (
  SELECT *, lag("Comuna_Semanal") OVER (PARTITION BY "DNI" ORDER BY "Semana" NULLS FIRST) AS "Comuna_Anterior"
  FROM f
)
SELECT "DNI", "Semana", "Comuna_Semanal", "Comuna_Anterior",
       CASE WHEN "Comuna_Anterior" IS NULL THEN 'Nuevo' WHEN "Comuna_Anterior" = "Comuna_Semanal" THEN 'Recurrente'
            ELSE 'Migratorio' END AS "Condicion_Poblacion"
FROM h"""
    return with_clean(table, body)


def enriched_sql(table: str) -> str:
    return with_clean(table, f"e AS (SELECT *, {contact_plain_sql()} AS \"Categoria_Contacto\" FROM clean)\n"
                             "SELECT * FROM e")


def zone_assignment_sql(table: str, layers=None) -> str:
    return f"""WITH raw AS (
{fixtures.interventions_sql(table)}
),
pts AS (
  SELECT row_id, CAST(replace("Longitud", ',', '.') AS DOUBLE) AS "Longitud",
         CAST(replace("Latitud", ',', '.') AS DOUBLE) AS "Latitud" FROM raw
),
{zone_ctes('pts', layers)}
SELECT pts.row_id, pts."Longitud", pts."Latitud", zone_of.zone AS comuna_calculada
FROM pts LEFT JOIN zone_of USING (row_id)"""


def dni_categories_sql(table: str) -> str:
    val, reason = dni_sql('"Persona DNI"')
    return f"""WITH raw AS (
{fixtures.interventions_sql(table)}
)
SELECT row_id, "Persona DNI", {val} AS "DNI_Categorizado", {reason} AS "DNI_Categorizado_motivo" FROM raw"""


def documents_names_sql() -> str:
    return f"SELECT doc_id, {name_sql('text')} AS name_clean FROM documents"


def documents_closing_sql() -> str:
    return f"SELECT doc_id, {closing_sql('text')} AS closing_clean FROM documents"


def outcome_rules_sql(table: str) -> str:
    lvl, gives = levels_sql("categoria_final")
    return f"""WITH raw AS (
{fixtures.interventions_sql(table)}
),
blanked AS (
  SELECT row_id,
    CASE WHEN "Cierre Supervisor" IN {in_list(K.EMPTY_MARKERS)} THEN NULL ELSE "Cierre Supervisor" END
      AS "Cierre Supervisor",
    CASE WHEN "Resultado" IN {in_list(K.EMPTY_MARKERS)} THEN NULL ELSE "Resultado" END AS "Resultado"
  FROM raw
),
t AS (SELECT *, coalesce("Cierre Supervisor", "Resultado") AS cierre_texto FROM blanked),
t2 AS (SELECT *, {closing_sql('cierre_texto')} AS texto_limpio FROM t),
c AS (SELECT *, {category_sql('texto_limpio')} AS categoria_final FROM t2)
SELECT row_id, "Cierre Supervisor", "Resultado", cierre_texto, texto_limpio, categoria_final,
       {lvl} AS contacto, {gives} AS brinda_datos
FROM c"""


def incremental_append_sql(table: str, history_before: str, landed_from: str) -> str:
    return f"""WITH raw AS (
{fixtures.interventions_sql(table)}
),
hist AS (SELECT * FROM raw WHERE "Fecha Inicio" < TIMESTAMP '{history_before}'),
landed AS (SELECT * FROM raw WHERE "Fecha Inicio" >= TIMESTAMP '{landed_from}')
SELECT * FROM hist
UNION ALL
SELECT * FROM landed WHERE "Fecha Inicio" > (SELECT max("Fecha Inicio") FROM hist)"""


def chart_series_sql(table: str, targets=(2.0, 14.0)) -> str:
    inner = zone_evolution_sql(table, targets)
    return f"""WITH evo AS (
{inner}
)
SELECT target, list(week_label ORDER BY week) AS labels, list(nuevos ORDER BY week) AS nuevos,
       list(recurrentes ORDER BY week) AS recurrentes, list(migratorios ORDER BY week) AS migratorios
FROM evo GROUP BY target"""


def dashboard_payload_sql(table: str = "orders") -> str:
    """Counts are JSON numbers, shares texts; the document is put together from text."""
    def row(label, base, values):
        return f"'{{\"label\":\"{label}\",\"base\":\"' || first({base}) || '\",\"vals\":[' || {values} || ']}}'"

    def numbers(field):
        return f"string_agg(CAST({field} AS VARCHAR), ',' ORDER BY week)"

    def texts(field):
        return f"string_agg('\"' || {field} || '\"', ',' ORDER BY week)"

    rows = " || ',' || ".join([
        row("Intervenciones totales", "base_total", numbers("total")), row("Derivaciones CIS", "base_cis", numbers("cis")),
        row("Llamados 108", "base_calls", numbers("calls")), row("% Se contacta", "base_contact", texts("fmt_contact")),
        row("% No se contacta", "base_no_contact", texts("fmt_no_contact")), row("% Sin cubrir", "base_uncovered", texts("fmt_uncovered"))])
    return f"""WITH k AS (
{dashboard_kpis_sql(table)}
)
SELECT scope, '{{"weeks":[' || {texts('week_label')} || '],"rows":[' || {rows} || ']}}' AS payload
FROM k GROUP BY scope"""


def chart_document_sql(table: str = "orders") -> str:
    def data(label, field, colour):
        return (f"'{{\"label\":\"{label}\",\"data\":[' || string_agg(CAST({field} AS VARCHAR), ',' ORDER BY week) || "
                f"'],\"backgroundColor\":\"{colour}\"}}'")

    sets = " || ',' || ".join([data("Nuevos", "nuevos", "#10B981"), data("Recurrentes", "recurrentes", "#3B82F6"),
                               data("Migratorios", "migratorios", "#F97316")])
    return f"""WITH evo AS (
{zone_evolution_sql(table)}
)
SELECT target, '{{"labels":[' || string_agg('"' || week_label || '"', ',' ORDER BY week) || '],"datasets":[' || {sets} || ']}}' AS chart
FROM evo GROUP BY target"""


def board_sheet_sql(table: str = "orders") -> str:
    rows = [("Intervenciones totales", "base_total", "CAST(total AS VARCHAR)"), ("Derivaciones CIS", "base_cis", "CAST(cis AS VARCHAR)"),
            ("Llamados 108", "base_calls", "CAST(calls AS VARCHAR)"), ("% Contacta", "base_contact", "fmt_contact"),
            ("% No se contacta", "base_no_contact", "fmt_no_contact"), ("% Sin cubrir", "base_uncovered", "fmt_uncovered")]
    cells = "SELECT zone, slot, 0 AS row_no, 'Indicador' AS \"Indicador\", 'Linea base' AS \"Linea base\", week_label AS v FROM n"
    for i, (label, base, value) in enumerate(rows):
        cells += f"\n  UNION ALL SELECT zone, slot, {i + 1}, '{label}', {base}, {value} FROM n"
    slots = ", ".join(f"max(v) FILTER (WHERE slot = {i}) AS s{i}" for i in range(1, 9))
    return f"""WITH b AS (
{zone_boards_sql(table)}
),
n AS (SELECT *, row_number() OVER (PARTITION BY zone ORDER BY week) AS slot FROM b),
cells AS (
  {cells}
)
SELECT zone, row_no, "Indicador", "Linea base", {slots} FROM cells GROUP BY ALL"""


def summary_sheet_sql(table: str, start: str) -> str:
    return f"""WITH s AS (
{weekly_zone_summary_sql(table, start)}
),
o AS (SELECT *, row_number() OVER (ORDER BY "Semana" DESC, CAST(regexp_extract("Comuna", '[0-9]+') AS INTEGER)) AS pos FROM s)
SELECT CAST(COLUMNS(*) AS VARCHAR) FROM o"""


def outcome_fuzzy_sql(table: str = "orders") -> str:
    """The weighted ratio of every unresolved distinct closing text against the
    labels, as set operations. The longest common subsequence of a short and a
    long string is a fold over the long one's characters, each a bit mask of
    its places in the short one."""
    labels = ", ".join(f"({i}, {q(c)})" for i, c in enumerate(K.CATEGORIES_ALL))

    def joined(x: str) -> str:
        return f"array_to_string(list_sort({x}), ' ')"

    def fold(masks: str, n: str) -> str:
        return (f"({n} - bit_count(list_reduce(list_prepend((1::HUGEINT << {n}) - 1, {masks}), "
                f"lambda v, m: ((v + (v & m)) | (v - (v & m))) & ((1::HUGEINT << {n}) - 1))))")

    def masks(of: str, places: str) -> str:
        return (f"list_transform(string_split({of}, ''), lambda c: list_sum(list_transform(range(length({places})), "
                f"lambda i: CASE WHEN substr({places}, CAST(i AS INTEGER) + 1, 1) = c THEN 1::HUGEINT << CAST(i AS INTEGER) ELSE 0::HUGEINT END))::HUGEINT)")

    def windows(m: str, n_short: str, n_long: str) -> str:
        part = f"list_slice({m}, greatest(1, k - {n_short} + 1), least(k, {n_long}))"
        size = f"(least(k, {n_long}) - greatest(1, k - {n_short} + 1) + 1)"
        return f"list_max(list_transform(range(1, {n_long} + {n_short}), lambda k: 200.0 * {fold(part, n_short)} / ({n_short} + {size})))"

    return f"""WITH raw AS (
{fixtures.interventions_sql(table)}
),
blanked AS (
  SELECT coalesce(CASE WHEN "Cierre Supervisor" IN {in_list(K.EMPTY_MARKERS)} THEN NULL ELSE "Cierre Supervisor" END,
                  CASE WHEN "Resultado" IN {in_list(K.EMPTY_MARKERS)} THEN NULL ELSE "Resultado" END) AS raw
  FROM raw
),
vocab AS (SELECT raw, {closing_sql('raw')} AS text FROM (SELECT DISTINCT raw FROM blanked)),
ruled AS (SELECT raw, text, {rule_sql('text')} AS rule FROM vocab),
t AS (SELECT DISTINCT text, string_split(text, ' ') AS w FROM ruled WHERE rule IS NULL),
l(pos, label) AS (VALUES {labels}),
pair AS (
  SELECT text, pos, label, w, string_split(label, ' ') AS u,
         list_distinct(list_filter(w, lambda x: NOT list_contains(string_split(label, ' '), x))) AS dw,
         list_distinct(list_filter(string_split(label, ' '), lambda x: NOT list_contains(w, x))) AS du,
         list_distinct(list_filter(w, lambda x: list_contains(string_split(label, ' '), x))) AS common
  FROM t, l WHERE text <> ''
),
named AS (
  SELECT *, {joined('w')} AS sw, {joined('u')} AS su, {joined('dw')} AS ab, {joined('du')} AS ba, {joined('common')} AS sect FROM pair
),
strs AS (
  SELECT text, pos, 'plain' AS kind, text AS x, label AS y FROM named
  UNION ALL SELECT text, pos, 'sorted', sw, su FROM named
  UNION ALL SELECT text, pos, 'rest', ab, ba FROM named
),
sided AS (
  SELECT text, pos, kind, CASE WHEN length(x) <= length(y) THEN x ELSE y END AS s, CASE WHEN length(x) <= length(y) THEN y ELSE x END AS g
  FROM strs WHERE x <> '' AND y <> ''
),
masked AS (
  SELECT *, length(s) AS ns, length(g) AS ng, {masks('g', 's')} AS m, CASE WHEN length(s) = length(g) THEN {masks('s', 'g')} END AS m2 FROM sided
),
scored AS (
  SELECT text, pos, kind, ns + ng AS total, {fold('m', 'ns')} AS lcs,
         greatest({windows('m', 'ns', 'ng')}, CASE WHEN m2 IS NULL THEN 0 ELSE {windows('m2', 'ng', 'ns')} END) AS part
  FROM masked
),
wide AS (
  SELECT n.*, length(ab) AS la, length(ba) AS lb, length(sect) AS ls,
         200.0 * p.lcs / p.total AS ratio, p.part AS part, 200.0 * s.lcs / s.total AS sort_ratio, s.part AS sort_part,
         coalesce(r.lcs, 0) AS rest_lcs, coalesce(r.part, 0) AS rest_part
  FROM named n
  LEFT JOIN scored p ON p.text = n.text AND p.pos = n.pos AND p.kind = 'plain'
  LEFT JOIN scored s ON s.text = n.text AND s.pos = n.pos AND s.kind = 'sorted'
  LEFT JOIN scored r ON r.text = n.text AND r.pos = n.pos AND r.kind = 'rest'
),
token AS (
  SELECT *, ls + CASE WHEN ls > 0 THEN 1 ELSE 0 END + la AS sab, ls + CASE WHEN ls > 0 THEN 1 ELSE 0 END + lb AS sba,
         greatest(length(text), length(label)) * 1.0 / least(length(text), length(label)) AS len_ratio
  FROM wide
),
final AS (
  SELECT text, pos, label,
    CASE WHEN len_ratio < 1.5 THEN greatest(ratio, 0.95 * CASE
           WHEN ls > 0 AND (la = 0 OR lb = 0) THEN 100.0
           ELSE greatest(sort_ratio,
             CASE WHEN sab + sba > 0 THEN 100.0 - 100.0 * (la + lb - 2 * rest_lcs) / (sab + sba) ELSE 100.0 END,
             CASE WHEN ls > 0 THEN 100.0 - 100.0 * (1 + la) / (ls + sab) ELSE 0 END,
             CASE WHEN ls > 0 THEN 100.0 - 100.0 * (1 + lb) / (ls + sba) ELSE 0 END) END)
    ELSE greatest(ratio, part * CASE WHEN len_ratio < 8 THEN 0.9 ELSE 0.6 END,
           0.95 * CASE WHEN len_ratio < 8 THEN 0.9 ELSE 0.6 END * CASE
             WHEN ls > 0 THEN 100.0
             WHEN len(w) = len(dw) AND len(u) = len(du) THEN sort_part
             ELSE greatest(sort_part, rest_part) END) END AS score
  FROM token
),
best AS (SELECT text, arg_max(label, score * 1000 - pos * 1e-7) AS label, max(score) AS score FROM final GROUP BY text),
known AS (SELECT t.text, coalesce(best.label, {q(K.CATEGORIES_ALL[0])}) AS label, coalesce(best.score, 0.0) AS score FROM t LEFT JOIN best USING (text))
SELECT ruled.raw, ruled.text,
       CASE WHEN rule IS NOT NULL THEN rule WHEN known.score >= {K.FUZZY_ACCEPT} THEN known.label ELSE {q(K.NO_MATCH)} END AS category,
       CASE WHEN rule IS NULL THEN round(known.score, 4) END AS score,
       CASE WHEN rule IS NULL THEN 'fuzzy' ELSE 'rule' END AS method
FROM ruled LEFT JOIN known ON known.text = ruled.text"""
