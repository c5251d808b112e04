"""Fixed values that must equal the source system's for right results.

Everything in this module is a FIXED VALUE (code texts, word lists, lookup
tables, regular expressions, baselines), stated plainly and in natural order.
Logic lives elsewhere.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: column names of the intervention report
# ---------------------------------------------------------------------------
COL_START = "Fecha Inicio"
OPTIONAL_DATE_COLS = ["Fecha Inicio", "Fecha Fin", "Recurso Fecha Liberado",
                      "Recurso Fecha asignacion", "Recurso Arribo"]
COL_LAT = "Latitud"
COL_LON = "Longitud"
COL_DNI = "Persona DNI"
COL_FIRST = "Persona Nombre"
COL_LAST = "Persona Apellido"
COL_AGENCY = "Agencia"
COL_SUPERVISOR = "Cierre Supervisor"
COL_RESULT = "Resultado"
COL_STATE = "Estado"
COL_CARD = "Tipo Carta"

# derived columns
COL_ZONE = "comuna_calculada"
COL_KEY = "DNI_Categorizado"
COL_KEY_REASON = "DNI_Categorizado_motivo"
COL_CLOSING = "cierre_texto"
COL_CLEAN_TEXT = "texto_limpio"
COL_CATEGORY = "categoria_final"
COL_CONTACT_LEVEL = "contacto"
COL_GIVES_DATA = "brinda_datos"
COL_EVOLUTION = "Tipo_Evolucion"
COL_ROW_ID = "row_id"  # our own unique tie-breaker; the source relies on row order
CLEAN_PART = "mes_part"  # storage partition of the clean history: month ('yyyy-MM') of the Monday week

# ---------------------------------------------------------------------------
# FIXED VALUES: status and result codes
# ---------------------------------------------------------------------------
STATE_PENDING = "PENDIENTE"
CARD_AUTOMATIC = "AUTOMATICA"
RESULT_CIS = "01-Traslado efectivo a CIS"
RESULT_UNCOVERED = "15-Sin cubrir"
# Note the first code uses an en dash (U+2013), the others a hyphen.
RESULTS_NO_CONTACT = [
    "12–No se contacta y no se observan pertenencias",
    "11-No se contacta y se observan pertenencias",
    "16-Desestimado (cartas 911 u otras áreas)",
]
CATEGORY_CIS = "traslado efectivo a cis"

# contact classes
CONTACT = "Se contacta"
NO_CONTACT = "No se contacta"
UNCOVERED = "Sin cubrir"

# zones whose pending rows are not forced to "Sin cubrir" in the dashboard rule
PENDING_EXCEPTION_ZONES = [2, 14]

# ---------------------------------------------------------------------------
# FIXED VALUES: cleaning lists
# ---------------------------------------------------------------------------
AGENCIES_DROPPED = ["DIPA I COMBATE", "MAPA DE RIESGO - SEGUIMIENTO", "MAPA DE REISGO - SEGUIMIENTO",
                    "DIPA II ZABALA", "AREA OPERATIVA", "SALUD MENTAL"]
# whole-cell markers of an empty value (None is handled as null)
EMPTY_MARKERS = ["", " ", "-", "N/A", "(Vacio)", "SIN DATO", "nan", "NAN"]
# identity keys that are never classified nor de-duplicated
ANONYMOUS_KEYS = ["NO BRINDO/NO VISIBLE", "NO BRINDO", "NO VISIBLE", "S/D"]
# keys excluded by the SQL population view
VIEW_EXCLUDED_KEYS = ["NO BRINDO/NO VISIBLE", "nan"]

KEY_NOT_GIVEN = "NO BRINDO/NO VISIBLE"
KEY_FOREIGN = "CONTACTO EXTRANJERO"

# ---------------------------------------------------------------------------
# FIXED VALUES: ID cascade patterns (Python syntax, case-insensitive where noted)
# ---------------------------------------------------------------------------
PATTERN_FOREIGN = (r"(extranjero|paraguay|venezol|colombian|uruguay|brasil|chilen|peruano|mexican|"
                   r"español|dominican|dominicana|pasaporte|c\.?d\.?[ie]:?|rnm|cedula|ciudadano\s+extranjero)")
PATTERN_NOT_GIVEN = (r"(no\s*brind|no\s*bri[nm]d|no\s*aporta|no\s*aporto|no\s*indica|no\s*sabe|no\s*recuerda|"
                     r"no\s*recuerd|no\s*tiene|nunca\s*tuvo|sin\s*dni|sin\s*dato|sin\s*inform|ilegible|invisible|"
                     r"no\s*visible|exhib|no\s*lo\s*sabe|menor\s*de\s*edad)")
PATTERN_SYMBOLS = r"^[xX\*\-\.]+$"
PATTERN_SHORT_LETTERS = r"^[A-Za-z]{1,3}$"
PATTERN_LETTERS_ONLY = r"^[A-Za-z]+$"

# reason codes, in cascade order
REASON_NULL = "nan"
REASON_EMPTY = "empty"
REASON_NOT_GIVEN = "patron_no_brindo_genericos"
REASON_SYMBOLS = "simbolos_o_letras_cortas"
REASON_REPEATED = "solo_letras_repetidas"
REASON_FOREIGN = "patron_extranjero"
REASON_VALID = "dni_valido"
REASON_TEXT_SHORT = "texto_o_corto"
REASON_REST = "resto_no_brindo"

# ---------------------------------------------------------------------------
# FIXED VALUES: outcome categories
# ---------------------------------------------------------------------------
CATEGORIES_GIVES_DATA = ["traslado efectivo a cis", "acepta cis pero no hay vacante",
                         "se activa protocolo de salud mental", "derivacion a same",
                         "traslado/acompanamiento a otros efectores", "mendicidad (menores de edad)"]
CATEGORIES_NO_DATA = ["se realiza entrevista", "rechaza entrevista y se retira del lugar",
                      "imposibilidad de abordaje por consumo", "rechaza entrevista y se queda en el lugar",
                      "derivacion a espacio publico", "no se encuentra en situacion de calle"]
CATEGORIES_NO_CONTACT = ["no se contacta y se observan pertenencias", "no se contacta y no se observan pertenencias",
                         "sin cubrir", "desestimado (cartas 911 u otras areas)"]
CATEGORIES_ALL = CATEGORIES_GIVES_DATA + CATEGORIES_NO_DATA + CATEGORIES_NO_CONTACT
NO_MATCH = "sin_match"
FUZZY_ACCEPT = 80.0

LEVEL_CONTACTS = "Contacta"
LEVEL_NO_CONTACT = "No se contacta"
LEVEL_OTHER = "Derivaciones/seguimientos"
GIVES_DATA = "Brinda datos"
GIVES_NO_DATA = "No brinda datos"

# Exact lookup on the cleaned closing text. The source literal repeats the key
# "10 se contacta pero rechaza pp por desconocimiento voluntad etc"; its later
# value wins, so the effective entry is given here at the key's first position.
EXACT_RULES = {
    "17 dipa derivacion a cis": "traslado efectivo a cis",
    "01 positivo traslado a cis hogar 08 positivo derivacion a sas cud cp identidad etc": "traslado efectivo a cis",
    "10 se contacta pero rechaza pp por desconocimiento voluntad etc": "rechaza entrevista y se retira del lugar",
    "21 asesoramiento sobre programas": "se realiza entrevista",
    "16 dipa entrega de insumos servicios 21 asesoramiento sobre programas": "traslado/acompanamiento a otros efectores",
    "16 dipa entrega de insumos servicios 7 positivo entrega de insumos": "traslado/acompanamiento a otros efectores",
    "21 asesoramiento sobre programas 16 dipa entrega de insumos servicios": "traslado/acompanamiento a otros efectores",
    "7 positivo entrega de insumos 16 dipa entrega de insumos servicios": "traslado/acompanamiento a otros efectores",
    "7 positivo entrega de insumos 21 asesoramiento sobre programas": "traslado/acompanamiento a otros efectores",
    "21 asesoramiento sobre programas 7 positivo entrega de insumos": "traslado/acompanamiento a otros efectores",
    "16 dipa entrega de insumos servicios 21 asesoramiento sobre programas 7 positivo entrega de insumos":
        "traslado/acompanamiento a otros efectores",
    "11 se contacta pero rechaza pp por disconformidad egresado": "rechaza entrevista y se retira del lugar",
    "10 se contacta pero rechaza pp por desconocimiento voluntad etc 11 se contacta pero rechaza pp por disconformidad egresado":
        "rechaza entrevista y se retira del lugar",
    "9 se contacta pero rechaza entrevista 21 asesoramiento sobre programas": "rechaza entrevista y se retira del lugar",
    "9 se contacta pero rechaza entrevista 24 persona abandona el lugar por intervencion ep policia":
        "rechaza entrevista y se retira del lugar",
    "21 asesoramiento sobre programas 10 se contacta pero rechaza pp por desconocimiento voluntad etc":
        "rechaza entrevista y se retira del lugar",
    "10 se contacta pero rechaza pp por desconocimiento voluntad etc 21 asesoramiento sobre programas":
        "rechaza entrevista y se retira del lugar",
    "21 asesoramiento sobre programas 9 se contacta pero rechaza entrevista": "rechaza entrevista y se retira del lugar",
    "10 se contacta pero rechaza pp por desconocimiento voluntad etc 9 se contacta pero rechaza entrevista":
        "rechaza entrevista y se retira del lugar",
    "asesoramiento sobre programas rechan entrevista se quedan en el lugar": "rechaza entrevista y se queda en el lugar",
}

# Ordered substring rules, first hit wins. The leading space of " same" is part of it.
SUBSTRING_RULES = [
    ("derivacion a cis", "traslado efectivo a cis"),
    ("traslado a cis", "traslado efectivo a cis"),
    ("acepta cis", "acepta cis pero no hay vacante"),
    ("protocolo de salud mental", "se activa protocolo de salud mental"),
    (" same", "derivacion a same"),
    ("otros efectores", "traslado/acompanamiento a otros efectores"),
    ("mendicidad", "mendicidad (menores de edad)"),
    ("se realiza entrevista", "se realiza entrevista"),
    ("rechaza entrevista y se retira", "rechaza entrevista y se retira del lugar"),
    ("rechaza entrevista y se queda", "rechaza entrevista y se queda en el lugar"),
    ("imposibilidad de abordaje", "imposibilidad de abordaje por consumo"),
    ("espacio publico", "derivacion a espacio publico"),
    ("no se encuentra en situacion de calle", "no se encuentra en situacion de calle"),
    ("sin cubrir", "sin cubrir"),
    ("desestimado", "desestimado (cartas 911 u otras areas)"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: evolution labels
# ---------------------------------------------------------------------------
EVO_NEW = "Nuevos"
EVO_RECURRING = "Recurrentes"
EVO_MIGRANT = "Migratorios"
EVO_UNCLASSIFIED = "No clasificable"
VIEW_NEW = "Nuevo"
VIEW_RECURRING = "Recurrente"
VIEW_MIGRANT = "Migratorio"

# ---------------------------------------------------------------------------
# FIXED VALUES: zone codes of the special layers and their precedence
# (2.5 overwrites 14.5, both win over the regular zones)
# ---------------------------------------------------------------------------
ZONE_SPECIAL_2_5 = 2.5
ZONE_SPECIAL_14_5 = 14.5
ZONE_PRIORITY = {2.5: 0, 14.5: 1}
REGULAR_PRIORITY = 2

# ---------------------------------------------------------------------------
# FIXED VALUES: baselines shown beside the indicators, in indicator order
# (total, CIS, calls, % contact, % no contact, % uncovered)
# ---------------------------------------------------------------------------
INDICATORS = ["Intervenciones totales", "Derivaciones CIS", "Llamados 108",
              "% Se contacta", "% No se contacta", "% Sin cubrir"]
# sheet boards
BOARD_INDICATORS = ["Intervenciones totales", "Derivaciones CIS", "Llamados 108",
                    "% Contacta", "% No se contacta", "% Sin cubrir"]
BOARD_BASELINE_ZONE2 = ["341", "26", "175", "38%", "53%", "9%"]
BOARD_BASELINE_ZONE14 = ["47", "2", "31", "98%", "6%", "3%"]
BOARD_BASELINE_CITY = ["4767", "517", "2972", "48%", "45%", "7%"]
# dashboard
DASH_BASELINE_EMPTY = ["-", "-", "-", "-", "-", "-"]
DASH_BASELINE_ZONE2 = ["341", "26", "175", "38% (66)", "53% (92)", "9% (16)"]
DASH_BASELINE_ZONE14 = ["366", "7", "245", "23% (58)", "31% (76)", "45% (111)"]
DASH_BASELINE_TOTAL = ["4344", "341", "2798", "27% (782)", "25% (717)", "46% (1299)"]

DASH_ZONES = list(range(1, 16))
DASH_TOTAL_SCOPE = "total"
LAST_WEEKS = 8
ACCUMULATION_START = "2025-09-01"

# chart colours of the evolution series
CHART_COLOURS = {"Nuevos": "#10B981", "Recurrentes": "#3B82F6", "Migratorios": "#F97316"}

# catalog objects the checks expect
REQUIRED_TABLES = ["historico_limpio", "vista_intervenciones_enriquecida", "vista_poblacion_semanal"]
