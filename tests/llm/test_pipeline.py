import random

import corpus_pipeline
from pledgewise.llm import quality, queries

from . import brute, test_neardup


def written(spark, path, docs, items, labels):
    """The tables that the stages read."""
    rows = [(i, t, "en", "s", None if t is None else len(t), k) for k, (i, t) in enumerate(docs)]
    for name, data, schema in (
        ("documents", rows, "doc_id long, text string, lang string, source string, n_chars long, pos long"),
        ("benchmark", items, "item_id long, text string"),
        ("labels", labels, "doc_id long, quality int, toxic int"),
    ):
        spark.createDataFrame(data, schema).write.parquet(f"{path}/{name}.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


def test_stages(spark, tmp_path, docs):
    """Every stage on what the one before it kept, held against plain versions of the operators."""
    rng = random.Random(2)
    words = ["".join(rng.choices(["ta", "no", "ri", "mel", "dos", "ku"], k=rng.randint(1, 4))) for _ in range(300)]
    good = [(5000 + i, " ".join(rng.choices(words, k=60))) for i in range(150)]
    poor = [(6000 + i, " ".join(w.upper() + "!!" for w in rng.choices(words, k=60))) for i in range(150)]
    labels = [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in poor]
    items = [(1, docs[3][1].split("\n")[0])]
    docs = [*docs, *good, *poor]
    now = written(spark, tmp_path, docs, items, labels)
    judged = quality.score_texts(now, spark.read.parquet(f"{tmp_path}/labels.parquet")).collect()
    rejected = {r.doc_id for r in judged if not r.predicted}
    assert {i for i, _ in poor} <= rejected and not {i for i, _ in good} & rejected
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert now.columns == corpus_pipeline.COLUMNS
            kept.append(sorted(((r.doc_id, r.text) for r in now.collect()), key=repr))
    none = sum(r.predicted for r in judged if r.doc_id is None)
    plain = [(i, t) for i, t in docs if (none if i is None else i not in rejected)]
    assert kept[0] == sorted(plain, key=repr)
    plain = [(i, t) for i, _, _, t in brute.line_dedup_merged(plain)]
    assert kept[1] == sorted(plain, key=repr)
    test_neardup.check(plain, kept[2])
    bad = [d for d, r in zip(kept[2], brute.decontaminate(kept[2], items), strict=True) if r[-1]]
    assert bad and kept[3] == [d for d in kept[2] if d not in bad]
    assert now.count() == len(kept[3]) and now.where("not round_trip").count() == 0


def test_empty_tables(spark, tmp_path):
    written(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
