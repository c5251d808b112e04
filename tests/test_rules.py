"""Contact classes, categories, fuzzy scorer, shares and week starts."""

import datetime

from pyspark.sql import functions as F

from fieldkpi import constants as K
from fieldkpi.functions import fuzzy
from fieldkpi.functions.contact import contact_class, contact_class_dashboard, is_target_zone, levels
from fieldkpi.functions.dates import pct_with_count, share_pct, week_monday, week_sunday
from fieldkpi.operators.classify import classify_vocabulary, rule_category


def test_contact_classes(spark):
    rows = [("PENDIENTE", None, 5.0), ("PENDIENTE", None, 2.0), ("PENDIENTE", "15-Sin cubrir", 14.5),
            ("CERRADA", "12–No se contacta y no se observan pertenencias", 2.0), (None, None, None),
            ("PENDIENTE", None, 2.5), ("PENDIENTE", None, None)]
    df = spark.createDataFrame(rows, "st string, res string, z double")
    got = df.select(contact_class("st", "res").alias("a"), contact_class_dashboard("st", "res", "z").alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [
        ("Sin cubrir", "Sin cubrir"), ("Sin cubrir", "Se contacta"), ("Sin cubrir", "Sin cubrir"),
        ("No se contacta", "No se contacta"), ("Se contacta", "Se contacta"),
        ("Sin cubrir", "Se contacta"), ("Sin cubrir", "Sin cubrir")]


def test_rule_categories(spark):
    cases = [("17 dipa derivacion a cis", "traslado efectivo a cis"),
             ("10 se contacta pero rechaza pp por desconocimiento voluntad etc",
              "rechaza entrevista y se retira del lugar"),
             ("acepta cis pero no hay vacante", "acepta cis pero no hay vacante"),
             ("16 desestimado cartas 911 u otras areas", "desestimado (cartas 911 u otras areas)"),
             ("same dia", None),  # the rule " same" needs a leading space
             ("derivacion a same", "derivacion a same"),
             ("01 traslado efectivo a cis", None)]
    df = spark.createDataFrame([(c[0],) for c in cases], "t string")
    got = [r[0] for r in df.select(rule_category("t")).collect()]
    assert got == [c[1] for c in cases]


def test_levels(spark):
    df = spark.createDataFrame([("traslado efectivo a cis",), ("se realiza entrevista",), ("sin cubrir",),
                                ("sin_match",)], "c string")
    lv, gv = levels("c")
    got = [(r[0], r[1]) for r in df.select(lv, gv).collect()]
    assert got == [("Contacta", "Brinda datos"), ("Contacta", "No brinda datos"), ("No se contacta", ""),
                   ("Derivaciones/seguimientos", "")]


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def _ratio(a, b):
    return 200 * _lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def _partial(a, b):
    """Best ratio of the shorter text with any window of the other one, by trying them all."""
    if len(a) > len(b):
        a, b = b, a
    n = len(a)
    cuts = [b[i: i + n] for i in range(len(b) - n + 1)] + [b[:k] for k in range(1, n)] + [b[-k:] for k in range(1, n)]
    both = [a[:k] for k in range(1, n)] + [a[-k:] for k in range(1, n)] if len(a) == len(b) else []
    return max([_ratio(a, c) for c in cuts] + [_ratio(b, c) for c in both])


def _weighted(a, b):
    """The public definition, step by step."""
    if not a or not b:
        return 0.0
    ta, tb = a.split(), b.split()
    x, y = " ".join(sorted(ta)), " ".join(sorted(tb))
    shared, own, theirs = (" ".join(sorted(w)) for w in (set(ta) & set(tb), set(ta) - set(tb), set(tb) - set(ta)))
    lens = max(len(a), len(b)) / min(len(a), len(b))
    if lens < 1.5:
        both = [" ".join(filter(None, (shared, w))) for w in (own, theirs)]
        apart = len(both[0]) + len(both[1])
        sets = [100 - 100 * (len(own) + len(theirs) - 2 * _lcs(own, theirs)) / apart]
        if shared:
            sets = [100.0] if not own or not theirs else sets + [_ratio(shared, w) for w in both]
        return max(_ratio(a, b), 0.95 * max(_ratio(x, y), *sets))
    scale = 0.9 if lens < 8 else 0.6
    words = 100.0 if shared else max(_partial(x, y), _partial(own, theirs))
    return max(_ratio(a, b), scale * _partial(a, b), 0.95 * scale * words)


def _best(spark, texts, labels, floor=0.0):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return {r["t"]: r["b"] for r in df.select("t", fuzzy.best_label("t", labels, floor).alias("b")).collect()}


def test_fuzzy_scores(spark):
    got = _best(spark, ["01 traslado efectivo a cis", "12 no se contacta y no se observan pertenencias", "", None], K.CATEGORIES_ALL)
    assert tuple(got["01 traslado efectivo a cis"]) == ("traslado efectivo a cis", 95.0)
    b = got["12 no se contacta y no se observan pertenencias"]
    assert b.label == "no se contacta y no se observan pertenencias" and round(b.score, 1) == 96.7
    assert tuple(got[""]) == (K.CATEGORIES_ALL[0], 0.0) and got[None] is None


def test_weighted_ratio_public_examples(spark):
    def score(a, b):
        return round(_best(spark, [a], [b])[a].score, 2)
    assert score("new york mets", "new york meats") == 96.3  # plain ratio
    assert score("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == 95.0  # same words, other order
    assert score("the wonderful new york mets", "new york mets") == 90.0  # the short side inside the long one
    assert score("no se contacta " + "x" * 150, "sin cubrir") <= 60.0  # very different lengths
    assert round(_weighted("new york mets", "new york meats"), 2) == 96.3


def test_best_label_equals_the_definition(spark):
    import random
    rnd = random.Random(11)
    words = sorted({w for x in K.CATEGORIES_ALL for w in x.split()}) + ["xx", "zap", "1", "no"]
    texts = ["a", "zz", "sin", "no no se se"]
    for _ in range(40):
        texts.append(" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 9))))
        near = list(rnd.choice(K.CATEGORIES_ALL))
        for _ in range(rnd.randint(0, 12)):
            near[rnd.randrange(len(near))] = rnd.choice("abcdeins ")
        texts.append(" ".join("".join(near[:rnd.randint(3, len(near))]).split()) or "b")
        texts.append(" ".join("".join(rnd.choice("qwxz abeins") for _ in range(rnd.randint(1, 90))).split()) or "c")
    want = {t: max(((_weighted(t, x), -i, x) for i, x in enumerate(K.CATEGORIES_ALL))) for t in texts}
    got, kept = _best(spark, texts, K.CATEGORIES_ALL), _best(spark, texts, K.CATEGORIES_ALL, 80.0)
    for t, (score, _, label) in want.items():
        assert got[t].label == label and abs(got[t].score - score) < 1e-9, t
        if score >= 80:
            assert kept[t] == got[t]
        else:
            assert kept[t] is None or kept[t].score < 80


def test_fuzzy_vocabulary(spark):
    df = spark.createDataFrame([("01-Traslado efectivo a CIS",), ("01-Traslado efectivo a CIS",), (None,),
                                ("Acepta CIS pero no hay vacante",), ("zzzz qqqq",)], "r string")
    got = {r["raw"]: (r["category"], r["method"]) for r in classify_vocabulary(df, "r").collect()}
    assert got["01-Traslado efectivo a CIS"] == ("traslado efectivo a cis", "fuzzy")
    assert got[None] == (K.NO_MATCH, "fuzzy")
    assert got["Acepta CIS pero no hay vacante"] == ("acepta cis pero no hay vacante", "rule")
    assert got["zzzz qqqq"][0] == K.NO_MATCH
    assert len(got) == 4


def test_shares_half_even(spark):
    df = spark.createDataFrame([(1, 8), (27, 200), (0, 0), (5, 10)], "n long, d long")
    got = [r[0] for r in df.select(share_pct("n", "d")).collect()]
    assert got == [12, 14, 0, 50]  # 12.5 -> 12, 13.5 -> 14
    assert df.select(pct_with_count(F.lit(12), F.lit(3))).first()[0] == "12% (3)"


def test_week_starts(spark):
    df = spark.createDataFrame([(datetime.datetime(2025, 12, 7, 10, 0),), (None,)], "t timestamp")
    got = df.select(week_monday("t"), week_sunday("t")).collect()
    assert got[0][0] == datetime.date(2025, 12, 1) and got[0][1] == datetime.date(2025, 12, 7)
    assert got[1][0] is None


def test_target_zone(spark):
    df = spark.createDataFrame([(2.0,), (2.5,), (None,), (14.0,)], "z double")
    got = [r[0] for r in df.select(is_target_zone("z", 2)).collect()]
    assert got == [True, False, False, False]
    df2 = spark.createDataFrame([("Comuna 2",), ("2.0",), ("3",)], "z string")
    assert [r[0] for r in df2.select(is_target_zone("z", 2)).collect()] == [True, True, False]


def test_labels(spark):
    from fieldkpi.functions.dates import first_number, label_board_week, label_day_month, label_iso, label_stamp
    df = spark.createDataFrame([(datetime.datetime(2025, 12, 8, 9, 5), "Comuna 14")], "t timestamp, c string")
    r = df.select(label_board_week(F.to_date("t")), label_day_month(F.to_date("t")), label_iso(F.to_date("t")),
                  label_stamp("t"), first_number("c")).first()
    assert tuple(r) == ("Sem 08 Dec", "08 Dec", "2025-12-08", "08/12/2025 09:05", 14)

