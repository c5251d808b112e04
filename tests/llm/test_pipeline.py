import math
import re
from collections import Counter

import duckdb
import pytest
from fixtures import BASE, near_components

import corpus_pipeline as P
from fieldkpi.llm import mixing, quality
from fieldkpi.llm.decontaminate import MIN_SCORE, MIN_SHARE, MIN_WORDS, SPAN
from fieldkpi.llm.queries import quality_model
from fieldkpi.llm.secrets import EXAMPLE_OWNERS

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\W_]+")


def balance(x, y):
    run = best = 0
    for a, b in zip(x, y):
        run = max(run + (1 if a == b else -1), 0)
        best = max(best, run)
    return best


def contaminated(text, items):
    w = WORD.findall((text or "").lower())
    for it in items:
        if len(it) < SPAN:
            if any(w[i: i + len(it)] == it for i in range(len(w))) and (len(it) >= MIN_WORDS or len(it) == len(w)):
                return True
            continue
        least = min(MIN_SCORE, math.ceil(len(it) * MIN_SHARE))
        for shift in range(-len(it) + 1, len(w)):
            if balance(w[max(shift, 0):], it[max(-shift, 0):]) >= least:
                return True
    return False


def found(text):
    kinds = [*BASE, ("token", r"[A-Za-z0-9+/_-]{20,}", 0, 20)]
    for name, p, g, least in kinds:
        for m in re.finditer(p, text or "", re.ASCII):
            v = m[g]
            if len(v) >= least and (name != "token" or all(re.search(c, v) for c in ("[0-9]", "[A-Z]", "[a-z]"))):
                yield m.start(), m.end(), v


def redacted(docs):
    owners = {}
    for d, t, s in docs:
        for _, _, v in found(t):
            owners.setdefault(v, set()).add(s)
    out = {}
    for d, t, s in docs:
        spans, at, new = sorted((a, b) for a, b, v in found(t) if len(owners[v]) < EXAMPLE_OWNERS), 0, ""
        for a, b in spans:
            if a >= at:
                new += t[at:a] + "[SECRET]"
            at = max(at, b)
        out[d] = new + t[at:] if spans else t
    return out


@pytest.fixture(scope="module")
def stages(spark):
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, f in P.STAGES:
        docs = f(spark, docs, SF)
        kept.append(docs.toPandas())
    return kept


def test_stages_equal_brute_force(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    scores = {r.doc_id: r.score for r in quality.score(docs, quality_model(spark, docs, SF)).collect()}
    rows = [r for r in rows if scores[r[0]] >= quality.THRESHOLD]
    assert set(stages[0].doc_id) == {r[0] for r in rows} and 0 < len(rows) < docs.count()
    comp = near_components([r[:2] for r in rows])
    rows = [r for r in rows if comp[r[0]][1] == r[0]]
    assert set(stages[1].doc_id) == {r[0] for r in rows}
    items = [WORD.findall((r.text or "").lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [r for r in rows if not contaminated(r[1], items)]
    assert set(stages[2].doc_id) == {r[0] for r in rows}
    texts = redacted(rows)
    assert dict(zip(stages[3].doc_id, stages[3].text)) == texts
    assert (stages[3].n_chars == stages[3].text.str.len()).all()
    con = duckdb.connect()
    con.register("kept", stages[3])
    want = Counter(con.sql(mixing.mix_sql(table="kept", columns="d.doc_id")).df().doc_id)
    assert Counter(stages[4].doc_id) == want


def test_run_gives_the_last_stage(spark, stages):
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy", "place"]
    assert sorted(zip(stages[4].doc_id, stages[4].copy_ if "copy_" in stages[4] else stages[4]["copy"])) == sorted((r.doc_id, r["copy"]) for r in out.collect())
    assert [n for n, _ in P.STAGES] == ["quality", "near_dedup", "decontamination", "secrets", "mixing"]


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_stages_take_odd_rows(spark, name, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "", "xx", None, 0), (5_000_000, "", None, "s", 0), (5_000_000, "", None, "s", 0),
                                 (5_000_001, "word " * 150_000, "en", "s", 750_000), (5_000_002, "\0 \U0001f600", "en", "t", 3)], docs.schema)
    clash = ["id", "rep", "token", "_y", "_key", "cdf", "_source", "score", "w", "h", "m", "at", "key", "c"]
    both = docs.unionByName(odd).selectExpr("*", *[f"doc_id AS `{c}`" for c in clash])
    out = stage(spark, both, SF)
    added = ["copy", "place"] if name == "mixing" else []
    assert out.columns == both.columns + added
    rows = out.collect()
    assert all(r[c] == r.doc_id for r in rows for c in clash)
    if name in ("near_dedup", "decontamination", "secrets"):  # odd rows are clean: they stay
        assert sum(r.doc_id is None for r in rows) == 2 and sum(r.doc_id == 5_000_000 for r in rows) == 2
        assert any(r.text == "\0 \U0001f600" for r in rows)
    assert stage(spark, both.limit(0), SF).count() == 0
