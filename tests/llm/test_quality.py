import random

import numpy as np
from fixtures import prose

from fieldkpi.llm import queries
from fieldkpi.llm.common import slices, text_array
from fieldkpi.llm.quality import FEATURES, features, fit, keep_good, score, train

SF = "/root/testdata/sf0.1"


def test_learns_tables_and_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no single feature tells
    m = fit(x, y)
    assert ((m.score(x) >= 0.5) == y).mean() > 0.95
    assert any({a, b} == {0, 1} for a, b, *_ in m.pairs)
    assert fit(x[:0], y[:0]).score(x).tolist() == [0.5] * 4000


def test_features_do_not_depend_on_neighbours():
    import pyarrow as pa
    rng = random.Random(1)
    texts = [None, "", "\n", "A!! B!!\nA!! B!!\n", prose(rng, 200), "é", "x" * 5000, prose(rng, 3) + "\n"]
    together = np.vstack([features(d, o) for _, _, d, o in slices(text_array(pa.array(texts)))])
    alone = np.vstack([features(d, o) for t in texts for _, _, d, o in slices(text_array(pa.array([t], pa.string())))])
    assert together.shape == (8, len(FEATURES)) and np.isfinite(together).all()
    assert np.allclose(together, alone)


def test_held_out_accuracy_and_edge_rows(spark):
    got = queries.op4_quality_classifier(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = got.where("held_out").join(labels, "doc_id").toPandas()
    assert ((held.predicted == held.quality).mean()) > 0.97
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    m = train(docs, labels, "quality", max_rows=600)
    odd = spark.createDataFrame([(None, None, 1), (1, "", 2), (1, "", 2), (2, "word " * 300_000, 3)], "doc_id long, text string, score int")
    s = score(odd, m).collect()
    assert len(s) == 4 and all(0 <= r.score <= 1 for r in s)
    kept = keep_good(odd, m, threshold=0.0)
    assert kept.columns == odd.columns and kept.count() == 4
    assert score(odd.limit(0), m).count() == 0 and keep_good(odd.limit(0), m).count() == 0
    assert train(docs, labels.limit(0), "quality").score(np.zeros((1, len(FEATURES)))).tolist() == [0.5]
