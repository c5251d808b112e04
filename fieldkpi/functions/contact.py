"""Contact, level and population classes as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def contact_class(state: Column | str = K.COL_STATE, result: Column | str = K.COL_RESULT) -> Column:
    """Plain rule (sheet reports): pending -> uncovered; three no-contact codes;
    the uncovered code; everything else (null included) -> contact."""
    st, res = _c(state), _c(result)
    return (F.when(st == K.STATE_PENDING, K.UNCOVERED)
            .when(res.isin(K.RESULTS_NO_CONTACT), K.NO_CONTACT)
            .when(res == K.RESULT_UNCOVERED, K.UNCOVERED)
            .otherwise(K.CONTACT))


def contact_class_dashboard(state: Column | str = K.COL_STATE, result: Column | str = K.COL_RESULT,
                            zone: Column | str = K.COL_ZONE) -> Column:
    """Dashboard rule: as ``contact_class`` but pending rows of zones whose
    integer part is 2 or 14 (so 2.5 and 14.5 too) fall through to the result."""
    st, res, z = _c(state), _c(result), _c(zone)
    zone_int = z.cast("string").try_cast("double").cast("int")
    excepted = F.coalesce(zone_int.isin(K.PENDING_EXCEPTION_ZONES), F.lit(False))
    return (F.when((st == K.STATE_PENDING) & ~excepted, K.UNCOVERED)
            .when(res.isin(K.RESULTS_NO_CONTACT), K.NO_CONTACT)
            .when(res == K.RESULT_UNCOVERED, K.UNCOVERED)
            .otherwise(K.CONTACT))


def contact_case_sql(state: str = "Estado", result: str = "Resultado") -> str:
    """The same plain rule as a SQL CASE (for views)."""
    codes = ", ".join("'" + c.replace("'", "''") + "'" for c in K.RESULTS_NO_CONTACT)
    return (f"CASE WHEN `{state}` = '{K.STATE_PENDING}' THEN '{K.UNCOVERED}' "
            f"WHEN `{result}` IN ({codes}) THEN '{K.NO_CONTACT}' "
            f"WHEN `{result}` = '{K.RESULT_UNCOVERED}' THEN '{K.UNCOVERED}' "
            f"ELSE '{K.CONTACT}' END")


def levels(category: Column | str = K.COL_CATEGORY) -> tuple[Column, Column]:
    """(contact level, gives-data level) of a category; unknown -> other, ''."""
    cat = _c(category)
    level = (F.when(cat.isin(K.CATEGORIES_GIVES_DATA), K.LEVEL_CONTACTS)
             .when(cat.isin(K.CATEGORIES_NO_DATA), K.LEVEL_CONTACTS)
             .when(cat.isin(K.CATEGORIES_NO_CONTACT), K.LEVEL_NO_CONTACT)
             .otherwise(K.LEVEL_OTHER))
    gives = (F.when(cat.isin(K.CATEGORIES_GIVES_DATA), K.GIVES_DATA)
             .when(cat.isin(K.CATEGORIES_NO_DATA), K.GIVES_NO_DATA)
             .otherwise(""))
    return level, gives


def population_class(previous: Column | str, current: Column | str) -> Column:
    """SQL view rule: no previous zone -> new; equal -> recurring; else migrant."""
    prev, cur = _c(previous), _c(current)
    return (F.when(prev.isNull(), K.VIEW_NEW)
            .when(prev == cur, K.VIEW_RECURRING)
            .otherwise(K.VIEW_MIGRANT))


def evolution_class(is_first: Column, previous: Column | str, current: Column | str) -> Column:
    """Row rule: first sighting -> new; previous zone equal (both known) ->
    recurring; otherwise migrant (a null zone is never equal)."""
    prev, cur = _c(previous), _c(current)
    return (F.when(is_first, K.EVO_NEW)
            .when(prev.isNotNull() & (prev == cur), K.EVO_RECURRING)
            .otherwise(K.EVO_MIGRANT))


def is_target_zone(zone: Column | str, target: float) -> Column:
    """Numeric zone equals target; text zones also accept 'N', 'N.0', 'COMUNAN'
    after upper-casing and removing spaces; null is false."""
    z = _c(zone)
    t = float(target)
    t_txt = str(int(t)) if t.is_integer() else str(t)
    texts = [t_txt, f"{t_txt}.0", f"COMUNA{t_txt}"]
    norm = F.regexp_replace(F.upper(z.cast("string")), " ", "")
    numeric = z.cast("string").try_cast("double")
    return F.coalesce(F.when(numeric.isNotNull(), numeric == F.lit(t)).otherwise(norm.isin(texts)),
                      F.lit(False))
