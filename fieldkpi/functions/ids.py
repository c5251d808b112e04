"""Identity-number cascade as one native expression (ordered ``when`` chain)."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .text import PY_SPACE_CLASS


@functools.lru_cache(maxsize=1)
def _decimal_digits() -> tuple[str, str]:
    """Every non-ASCII decimal digit and its ASCII value (by rule)."""
    src, dst = [], []
    for cp in range(0x80, 0x110000):
        ch = chr(cp)
        if unicodedata.category(ch) == "Nd":
            src.append(ch)
            dst.append(str(unicodedata.decimal(ch)))
    return "".join(src), "".join(dst)


def _py_regex(pattern: str) -> str:
    """Python pattern on lower-cased text -> Java pattern with the same \\s."""
    return pattern.replace(r"\s", PY_SPACE_CLASS)


def _cascade(raw: Column, s: Column, low: Column, digits: Column, has_letter: Column) -> Column:
    # Every "not given" and foreign phrase needs an ASCII letter, so rows
    # without one (most valid IDs) skip both alternations (And short-circuits).
    not_given = has_letter & low.rlike(_py_regex(K.PATTERN_NOT_GIVEN))
    symbols = s.rlike(K.PATTERN_SYMBOLS) | s.rlike(K.PATTERN_SHORT_LETTERS)
    repeated = s.rlike(K.PATTERN_LETTERS_ONLY) & (F.size(F.array_distinct(F.split(low, ""))) <= 2)
    foreign = has_letter & low.rlike(_py_regex(K.PATTERN_FOREIGN))
    n_digits = F.length(digits)
    nb = F.lit(K.KEY_NOT_GIVEN)

    def pick(value: Column, reason: str) -> Column:
        return F.struct(value.cast("string").alias("value"), F.lit(reason).alias("reason"))

    return (
        F.when(raw.isNull(), pick(nb, K.REASON_NULL))
        .when(s == "", pick(nb, K.REASON_EMPTY))
        .when(not_given, pick(nb, K.REASON_NOT_GIVEN))
        .when(symbols, pick(nb, K.REASON_SYMBOLS))
        .when(repeated, pick(nb, K.REASON_REPEATED))
        .when(foreign, pick(F.lit(K.KEY_FOREIGN), K.REASON_FOREIGN))
        .when(n_digits.between(6, 10), pick(digits.try_cast("decimal(20,0)"), K.REASON_VALID))
        .when((n_digits < 6) | has_letter, pick(nb, K.REASON_TEXT_SHORT))
        .otherwise(pick(nb, K.REASON_REST))
    )


def _parts(raw: Column) -> tuple[Column, Column, Column, Column]:
    s = F.regexp_replace(raw, f"^{PY_SPACE_CLASS}+|{PY_SPACE_CLASS}+$", "")
    low = F.lower(s)
    # Python's \D keeps any decimal digit and int() reads them all
    digits = F.translate(F.regexp_replace(s, r"[^\p{Nd}]", ""), *_decimal_digits())
    return s, low, digits, low.rlike("[a-z]")


def dni_cascade(col: Column | str) -> Column:
    """Return ``struct(value string, reason string)`` for a raw ID cell.

    Order (first hit wins): null; empty after trimming; a "not given" phrase;
    only ``x * - .`` or 1-3 letters; letters only with at most two distinct ones;
    a foreign-document phrase; 6-10 digits once non-digits are dropped (leading
    zeros lost); under 6 digits or any letter; the rest.
    """
    c = F.col(col) if isinstance(col, str) else col
    raw = c.cast("string")
    return _cascade(raw, *_parts(raw))


def with_dni(df, source: str = K.COL_DNI, out: str = K.COL_KEY, reason: bool = True):
    """Add the categorised key (and its reason) to ``df``.

    The trimmed text, its lower case and its digits are projected once as
    intermediate columns, so the ordered cascade reads them instead of
    recomputing them in every branch.
    """
    raw = F.col(source).cast("string")
    s, low, digits, has_letter = _parts(raw)
    tmp = df.withColumn("__s", s)
    tmp = tmp.withColumn("__low", F.lower("__s")).withColumn(
        "__d", F.translate(F.regexp_replace("__s", r"[^\p{Nd}]", ""), *_decimal_digits()))
    tmp = tmp.withColumn("__l", F.col("__low").rlike("[a-z]"))
    tmp = tmp.withColumn("__dni", _cascade(F.col(source).cast("string"), F.col("__s"), F.col("__low"),
                                            F.col("__d"), F.col("__l")))
    tmp = tmp.withColumn(out, F.col("__dni.value"))
    if reason:
        tmp = tmp.withColumn(f"{out}_motivo", F.col("__dni.reason"))
    return tmp.drop("__s", "__low", "__d", "__l", "__dni")
