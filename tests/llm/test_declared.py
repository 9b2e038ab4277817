import random

import numpy as np
import pyarrow as pa

from pledgewise.llm import quality

SCHEMA = "doc_id long, text string, n_chars long"


def tables(spark, wrong):
    """Texts of one kind; ``wrong`` gives the declared length of a poor one from its real one."""
    rng = random.Random(4)
    texts = [" ".join(rng.choices("abcdefgh", k=40)) for _ in range(300)]
    docs = [(i, t, wrong(len(t)) if i % 2 else len(t)) for i, t in enumerate(texts)]
    labels = [(i, 1 - i % 2, 0) for i in range(300)]
    return spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_declared_length_is_learned(spark):
    docs, labels = tables(spark, lambda n: 5 * n)
    held = [r for r in quality.score_texts(docs, labels).collect() if r.held_out]
    poor, good = ([r.score for r in held if r.doc_id % 2 == k] for k in (1, 0))
    assert max(poor) < min(good)


def test_declared_length_that_never_differs_has_no_say(spark):
    docs, labels = tables(spark, lambda n: n)
    model = quality.train(docs, labels, quality.F.lit(True))
    text = pa.array(["a b c d"])
    odds = [model.odds(*model.rows(quality.features(text, np.array([n]))), 1)[0] for n in (7.0, 700.0)]
    assert odds[0] == odds[1]


def test_every_labelled_row_is_learned_from(spark, monkeypatch):
    """Of a class of many rows each is learned from, long texts too, in any number of partitions and shards."""
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choices("abcdefgh" if i % 2 else "efghijkl", k=8 if i else 9000)), None) for i in range(4000)]
    df, labels = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([(i, i % 2, 0) for i in range(4000)], "doc_id long, quality int, toxic int")
    rows = quality.learned_rows(df, labels, quality.F.lit(True))
    assert rows.count() == 4000 and rows.where("statistics[10] > 9").count() == 1
    text, declared = pa.array([t for _, t, _ in docs]), np.full(4000, np.nan)
    found = quality.features(text, declared)
    models = []
    for parts, shard in ((1, 20_000), (7, 20_000), (3, 10_000_000)):
        models.append(quality.train(df.repartition(parts), labels.repartition(parts), quality.F.lit(True), shard=shard))
        assert np.allclose(models[-1].centre, found[3].mean(axis=0), atol=1e-8)
        odds, _ = models[-1].odds(*models[-1].rows(found), 4000)
        assert ((odds > 0) == np.arange(4000) % 2).mean() > 0.95
    assert np.allclose(models[0].weights, models[1].weights, atol=1e-6) and np.allclose(models[0].factors, models[1].factors, atol=1e-6)
    monkeypatch.setattr(quality, "BROADCAST", 0)
    assert quality.learned_rows(df, labels, quality.F.lit(True)).count() == 4000
