"""Stages judge each row by itself, whatever its id."""

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in df.collect())


def test_contaminated_rows_without_or_with_shared_ids(spark, tmp_path):
    item = " ".join(f"q{k}" for k in range(20))
    clean = [" ".join(f"{a}{k}" for k in range(30)) for a in "ab"]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = [(None, item), (None, clean[0]), (7, item), (7, clean[1])]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs], SCHEMA)
    got = corpus_pipeline.drop_contaminated(spark, df, str(tmp_path))
    assert got.columns == corpus_pipeline.COLUMNS
    assert rows_of(got) == [(False, 7, clean[1]), (True, 0, clean[0])]


def test_near_copies_without_or_with_shared_ids(spark):
    one, two = (" ".join(f"{a}{k}" for k in range(60)) for a in "ab")
    docs = [(None, one), (None, one + " more"), (None, two), (5, two), (5, two + " more"), (5, "another text under the id")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs], SCHEMA)
    got = rows_of(corpus_pipeline.drop_near_duplicates(spark, df, ""))
    assert len(got) == 3 and sum(none for none, _, _ in got) == 1
    assert (False, 5, "another text under the id") in got
