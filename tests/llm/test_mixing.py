from collections import Counter

import duckdb
import pytest
from fixtures import SCHEMA, rows

from fieldkpi.llm.mixing import mix, mix_sql, rates


def test_equals_sql(spark):
    docs = rows()
    df = spark.createDataFrame(docs, SCHEMA)
    con = duckdb.connect()
    documents = df.toPandas()
    con.register("documents", documents)
    want = con.sql(mix_sql(columns="d.doc_id")).fetchall()
    got = [(r.doc_id, r["copy"], r.place) for r in mix(df).collect()]
    assert len(got) > 0 and sorted((a, b, round(c, 12)) for a, b, c in got) == sorted((a, b, round(c, 12)) for a, b, c in want)


def test_reaches_target_weights_and_is_repeatable(spark):
    docs = [(i, "x", "en", "big" if i % 10 else "small", 1) for i in range(4000)]
    df = spark.createDataFrame(docs, SCHEMA)
    out = mix(df, weights={"big": 1.0, "small": 3.0}, total=8000)
    n = Counter(r.source for r in out.collect())
    assert n["big"] == pytest.approx(2000, rel=0.1) and n["small"] == pytest.approx(6000, rel=0.1)
    again = mix(df.repartition(7), weights={"big": 1.0, "small": 3.0}, total=8000)
    assert sorted((r.doc_id, r["copy"]) for r in again.collect()) == sorted((r.doc_id, r["copy"]) for r in out.collect())
    assert {r._source: round(r.rate, 6) for r in rates(df, weights={"small": 1.0}).collect()} == {"big": 0.0, "small": 10.0}
    big = {r.doc_id: 0 for r in df.collect()}
    for r in mix(df.where("source = 'small'"), total=400 * 900.0).collect():  # a mean where exp(-mean) is 0
        big[r.doc_id] += 1
    drawn = [v for v in big.values() if v]
    assert sum(drawn) / 400 == pytest.approx(900, rel=0.02)


def test_nulls_repeats_clashes_and_empty(spark):
    rows_ = [(None, None, None, 1), (1, "a", None, 2), (1, "a", None, 2), (2, "", "s", 3)]
    df = spark.createDataFrame(rows_, "doc_id long, text string, source string, place int")
    out = mix(df, total=4000.0)
    n = Counter(r.doc_id for r in out.collect())
    assert out.columns == ["doc_id", "text", "source", "copy", "place"]
    assert set(n) == {None, 1, 2} and n[1] % 2 == 0
    assert mix(df.limit(0)).count() == 0
