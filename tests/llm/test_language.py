import duckdb
import pytest
from pyspark.sql import functions as F

from quire.llm import language as L

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def samples():
    return duckdb.sql(f"select lang, text from '{D}/lang_samples.parquet' order by sample_id").fetchall()


def test_held_out_accuracy(samples):
    train = L.sample_segments([s for i, s in enumerate(samples) if i % 4])
    test = L.sample_segments([s for i, s in enumerate(samples) if i % 4 == 0])
    model = L.fit_model(train)
    best, conf = model.classify([L.words_of(t) for _, t in test])
    right = [b >= 0 and model.names[b] == lang for b, (lang, _) in zip(best, test)]
    wrong = [b >= 0 and model.names[b] != lang for b, (lang, _) in zip(best, test)]
    assert sum(right) / len(test) > 0.9 and sum(wrong) / len(test) < 0.02
    assert ((conf >= 0) & (conf <= 1)).all()


def test_rejection_and_cosine(samples):
    import numpy as np

    model = L.fit_model(L.sample_segments(samples))
    best, _ = model.classify([L.words_of(t) for t in ("QU-6736 / Prakor", "Cluster 0.0.2.5", "12 44 XN-1023", "zzxq qqrw vvkz xxjq", "")])
    assert (best == -1).all()
    words = L.words_of(samples[0][1])
    x = L.dense_counts([words])[0] * model.idf
    assert np.allclose(model.cosines([words])[0], model.centroids @ x / np.linalg.norm(x), atol=1e-4)


def test_wrong_labels(spark):
    model = L.train(spark.read.parquet(f"{D}/lang_samples.parquet"))
    de = "Der Bediener sperrt die Papierbahn, weil der Lieferant nur dienstags kommt."
    en = "The operator locks the paper web, because the supplier delivers only on Tuesdays."
    rows = [(1, de, "DE", 0), (2, de, "English", 0), (3, de, None, 0), (4, f"{en} {de}", "en-GB", 0), (5, "AB-123 99", "xx", 0), (6, None, None, 0), (7, "", "??", 0), (8, en, "English", 0), (9, f'{en[:-1]} ("Die Papierbahn").', "eng", 0), (2, de, "English", 0), (10, (de + " ") * 3000, "fr", 0)]
    df = spark.createDataFrame(rows, "key int, text string, said string, segments int")
    got = sorted((r.key, r.lang) for r in L.wrong_labels(df, "key", "text", "said", model).collect())
    assert got == [(2, "de"), (2, "de"), (3, "de"), (4, "de"), (4, "en"), (10, "de")]
    assert L.wrong_labels(df.limit(0), "key", "text", "said", model).count() == 0
    segs = L.identify(df.where("key = 4"), "key", "text", model).first().segments
    assert [s.lang for s in segs] == ["en", "de"] and all(0 <= s.confidence <= 1 for s in segs)


def test_declared(spark):
    df = spark.createDataFrame([(x,) for x in ("EN", "en-GB", " Deutsch ", "español", "pt_BR", "xx", "", None, "und")], "x string")
    assert [r[0] for r in df.select(L.declared_language(F.col("x"))).collect()] == ["en", "en", "de", "es", "pt", None, None, None, None]
