import random

import numpy as np
from fixtures import prose

from fieldkpi.llm import queries
from fieldkpi.llm.toxicity import BITS, Ftrl, coordinates, score, train

SF = "/root/testdata/sf0.1"


def test_coordinates_stay_inside_documents():
    texts = [b"", b"one", b"Two, words", b"a b c", b"--"]
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    doc, idx = coordinates(np.frombuffer(b"".join(texts), np.uint8), off)
    assert np.bincount(doc, minlength=5).tolist() == [0, 1, 3, 6, 0]
    alone = coordinates(np.frombuffer(b"two WORDS", np.uint8), np.array([0, 9]))[1]
    assert set(idx[doc == 2]) == set(alone)


def test_ftrl_finds_the_coordinates_that_matter():
    rng = np.random.default_rng(0)
    m = Ftrl()
    for _ in range(4000):
        i = rng.choice(500, 20, replace=False)
        m.learn(np.append(i, 1 << BITS), float((i < 10).any()))
    w = m.weights(np.arange(500))
    assert w[:10].min() > 1 and (w[10:] == 0).mean() > 0.5


def test_held_out_accuracy_and_edge_rows(spark):
    got = queries.op10_toxicity(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = got.where("held_out").join(labels, "doc_id").toPandas()
    assert (held.predicted == held.toxic).mean() > 0.95  # 300 toxic texts in four languages to learn from
    assert held[held.toxic == 1].predicted.mean() > 0.65 and held[held.toxic == 0].predicted.mean() < 0.01
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = train(docs, labels, "toxic", max_rows=1500)
    assert train(docs.repartition(3), labels, "toxic", max_rows=1500)[1].tolist() == model[1].tolist()
    df = spark.createDataFrame([(None, None, 1), (1, "", 2), (1, "", 2), (2, prose(random.Random(1), 200_000), 3)], "doc_id long, text string, score int")
    out = score(df, model).collect()
    assert len(out) == 4 and all(0 <= r.score <= 1 for r in out)
    assert score(df.limit(0), model).count() == 0
    assert score(df, train(docs, labels.limit(0), "toxic")).first().score == 0.5
