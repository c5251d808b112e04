"""Unit cases for the name / closing-text cleaners and the ID cascade (FIXTURES.md §2)."""

import pytest
from pyspark.sql import functions as F

from fieldkpi import constants as K
from fieldkpi.functions.ids import dni_cascade
from fieldkpi.functions.text import clean_closing_text, clean_name

NB = K.KEY_NOT_GIVEN

DNI_CASES = [
    (None, NB, "nan"),
    ("   ", NB, "empty"),
    ("No brindó", NB, "patron_no_brindo_genericos"),
    ("menor de edad", NB, "patron_no_brindo_genericos"),
    ("X-X", NB, "simbolos_o_letras_cortas"),
    ("abc", NB, "simbolos_o_letras_cortas"),
    ("abab", NB, "solo_letras_repetidas"),
    ("Pasaporte 123456", K.KEY_FOREIGN, "patron_extranjero"),
    ("cdi 1234567", K.KEY_FOREIGN, "patron_extranjero"),
    ("12.345.678", "12345678", "dni_valido"),
    ("0012345678", "12345678", "dni_valido"),
    ("AB 1234567", "1234567", "dni_valido"),
    ("12345678.0", "123456780", "dni_valido"),
    ("12345", NB, "texto_o_corto"),
    ("Juan Perez", NB, "texto_o_corto"),
    ("12345678901", NB, "resto_no_brindo"),
    (" 12345678 ", "12345678", "dni_valido"),  # str.strip() removes Unicode spaces
    ("no brinda", NB, "patron_no_brindo_genericos"),  # Python \s is Unicode-aware
    ("٣٤٥٦٧٨٩", "3456789", "dni_valido"),  # int() reads any decimal digit
    ("\U0001d7cf\U0001d7d0\U0001d7d1\U0001d7d2\U0001d7d3\U0001d7d4\U0001d7d5", "1234567", "dni_valido"),  # beyond the first plane
]


def _run(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_dni_cascade(spark):
    got = _run(spark, [c[0] for c in DNI_CASES], dni_cascade("v"))
    for (raw, value, reason), res in zip(DNI_CASES, got):
        assert (res["value"], res["reason"]) == (value, reason), raw


NAME_CASES = [
    ("José  Ñandú-Pérez 3", "JOSE NANDU PEREZ"),
    ("O'Brien", "OBRIEN"),
    ("Straße", "STRASSE"),
    ("123", None),
    (None, None),
    ("Gómez, Jr.", "GOMEZ JR"),
    ("ﬁlo", "FILO"),
    ("Ana\nLía", "ANALIA"),  # newline is neither A-Z nor a space: removed
]


def test_clean_name(spark):
    got = _run(spark, [c[0] for c in NAME_CASES], clean_name("v"))
    assert got == [c[1] for c in NAME_CASES]


CLOSING_CASES = [
    (None, ""),
    ("12–No se contacta y no se observan pertenencias", "12 no se contacta y no se observan pertenencias"),
    ("16-Desestimado (cartas 911 u otras áreas)", "16 desestimado cartas 911 u otras areas"),
    ("  17 - DIPA Derivación a CIS  ", "17 dipa derivacion a cis"),
    ("Straße_Nº 5", "strasse no 5"),
    ("café œuvre", "cafe oeuvre"),
]


def test_clean_closing_text(spark):
    got = _run(spark, [c[0] for c in CLOSING_CASES], clean_closing_text("v"))
    assert got == [c[1] for c in CLOSING_CASES]


@pytest.mark.parametrize("fn", [clean_name, clean_closing_text])
def test_cleaners_idempotent(spark, fn):
    values = [c[0] for c in NAME_CASES + CLOSING_CASES if c[0] is not None]
    once = _run(spark, values, fn("v"))
    twice = _run(spark, [x for x in once], fn("v"))
    expect = [x if x is not None else (None if fn is clean_name else "") for x in once]
    assert twice == expect


def test_closing_text_transliterates_other_scripts_and_signs(spark):
    cases = [("Привет ½ ℃ №1", "privet 1 2 degc no1"), ("Ωμέγα", "omega"), ("㎏ ①", "kg 1"), ("\U0001d400\U0001d41b", "ab"), ("汉字 x", "x")]
    assert _run(spark, [c[0] for c in cases], clean_closing_text("v")) == [c[1] for c in cases]


def test_closing_text_romanises_by_rule(spark):
    import unicodedata
    cases = [("안녕 한국!", "annyeong hangug"), ("각 값 쌀", "gag gabs ssal"), (unicodedata.normalize("NFD", "한글"), "hangeul"), ("가힣", "gahih"),
             ("かな ガギ しち つ", "kana gagi shichi tsu"), ("ｶﾅ カー ん", "kana ka n"), ("שלום", "shlvm"), ("שָׁלוֹם", "shlvm"), ("محمد", "mhmd"), ("پژ گ", "pzh g"),
             ("١٢ ३", "12 3"), ("漢字 한 x", "han x"), ("", ""), (None, "")]
    assert _run(spark, [c[0] for c in cases], clean_closing_text("v")) == [c[1] for c in cases]
    syllables = [chr(cp) for cp in range(0xAC00, 0xD7A4, 7)]
    assert _run(spark, syllables, clean_closing_text("v")) == [unicodedata.name(c).rpartition(" ")[2].lower() for c in syllables]
