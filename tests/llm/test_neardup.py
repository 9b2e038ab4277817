import random

import corpus_pipeline
from pledgewise.llm import components, neardup

from . import brute


def shingles(text, n=5):
    words = brute.SPACES.findall(brute.lower(text))
    return frozenset(tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, 1)))


def kept(docs):
    """One row of each group of rows linked by a similarity of 0.8 or more, compared pair by pair."""
    sets, root = [shingles(t) for _, t in docs], list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for k, (i, t) in enumerate(docs):
        groups.setdefault(find(k), []).append((i is None, i, t))
    return groups.values()


def check(docs, got):
    """As many rows as groups, and of each group one of its least id."""
    groups = kept(docs)
    assert len(got) == len(groups)
    for group in groups:
        least = min(((a, i) for a, i, _ in group), key=lambda x: (x[0], x[1] or 0))
        assert sum(got.count(r) for r in {(i, t) for a, i, t in group if (a, i) == least}) >= 1


def run(spark, docs):
    df = spark.createDataFrame([(i, t, "en", "s", None) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    out = corpus_pipeline.drop_near_duplicates(spark, df, "")
    assert out.columns == corpus_pipeline.COLUMNS
    return [(r.doc_id, r.text) for r in out.collect()]


def test_near_copies(spark):
    """Copies with a few changed words in a hundred go; texts that share a third of their words stay."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    shared = rng.choices(words, k=60)
    docs = []
    for k in range(60):
        text = shared + rng.choices(words, k=rng.randint(120, 300))
        docs.append((10 * k, " ".join(text)))
        for c in range(k % 4):
            changed = list(text)
            for _ in range(rng.randint(1, 9)):
                changed[rng.randrange(len(changed))] = rng.choice(words)
            docs.append((10 * k + c + 1, " ".join(changed)))
    got = run(spark, docs)
    assert 60 <= len(got) < len(docs)
    check(docs, got)


def test_odd_texts(spark, docs):
    check(docs, run(spark, docs))


def test_order_of_shingles_changes_nothing(spark, docs_df, monkeypatch):
    def texts():
        return sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in neardup.drop_near_duplicates(docs_df).collect())

    one = texts()
    monkeypatch.setattr(neardup, "frequent", lambda *_: (neardup.np.zeros(0, neardup.np.uint64), neardup.np.zeros(0, neardup.np.int64)))
    assert texts() == one


def test_columns_of_the_caller_keep_their_names_and_values(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(1, text, "MINE", 5, 6.0, 7), (2, text + " more", "other", 1, 2.0, 3), (3, "alone", None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, h string, its_id long, its_h double, c int")
    got = neardup.drop_near_duplicates(df)
    assert got.columns == df.columns and got.schema == df.schema
    assert sorted(tuple(r) for r in got.collect()) == [rows[0], rows[2]]


def crowd(n=90):
    """Texts made mostly of one passage, in different orders of their own words, some of them near copies."""
    rng = random.Random(8)
    passage = [f"p{k}" for k in range(120)]
    docs = []
    for k in range(n):
        own = [f"o{rng.randrange(40)}" for _ in range(rng.choice([10, 25, 60]))]
        docs.append((k, " ".join(own + passage if k % 2 else passage + own)))
    return docs


def test_crowded_shingles_and_tables_past_the_limit_of_broadcasts(spark, monkeypatch):
    docs = crowd()
    check(docs, run(spark, docs))
    monkeypatch.setattr(neardup, "CROWD", 0)
    check(docs, run(spark, docs))
    monkeypatch.setattr(neardup, "frequent", lambda *_: (neardup.np.zeros(0, neardup.np.uint64), neardup.np.zeros(0, neardup.np.int64)))
    check(docs, run(spark, docs))
    monkeypatch.setattr(neardup, "BROADCAST", 0)
    check(docs, run(spark, docs))


def test_one_long_text_with_a_near_copy(spark):
    long = " ".join(f"w{k % 70_000}" for k in range(200_000))
    docs = [(1, "x " + long), (2, long + " y"), (3, "short text of a few words")]
    assert sorted(i for i, _ in run(spark, docs)) == [1, 3]


def test_frequent_shingles_are_counted_over_all_texts(spark):
    """Counts by place are those of all texts, however they are cut and added up."""
    rng = random.Random(8)
    shared = " ".join(f"s{k}" for k in range(9))
    docs = [f"{shared} {shared}" if i % 900 == 7 else " ".join(rng.choices("abcdefghij", k=12)) + f" x{i}" for i in range(9000)]
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(docs)], "doc_id long, text string, h long")
    _, got = neardup.shingle_sets(neardup.pa.array(docs))
    first = neardup.np.uint64(64 - neardup.PLACE_BITS)
    want = neardup.np.bincount((got >> first).astype(int), minlength=1 << neardup.PLACE_BITS)
    for parts in (1, 70):
        places, often = neardup.frequent(df.repartition(parts))
        assert {*neardup.shingle_sets(neardup.pa.array([shared]))[1] >> first} <= {*places}
        assert often.tolist() == want[places.astype(int)].tolist() and len(places) < 1000


def test_few_jobs(spark, docs_df):
    """What the driver keeps grows with the jobs that are started, so no table is read again to be counted."""
    context = spark.sparkContext
    context.setJobGroup("near-duplicates", "")
    try:
        neardup.drop_near_duplicates(docs_df).collect()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(context.statusTracker().getJobIdsForGroup("near-duplicates")) <= 150


def test_classes_and_stars_are_not_read_again(spark, docs_df):
    """Copies name the classes, pairs say where their texts are, and stars are used as they were written: a fifth of the jobs is saved."""
    context = spark.sparkContext
    context.setJobGroup("fewer jobs", "")
    try:
        neardup.drop_near_duplicates(docs_df).collect()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    jobs = len(context.statusTracker().getJobIdsForGroup("fewer jobs"))
    assert 0 < jobs <= 110


def test_stars_are_the_same_by_broadcasts_and_by_shuffles(spark, monkeypatch):
    """A path, a star, a loop and a null: what is sent to all tasks or dealt out changes nothing."""
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3)]
    want = sorted([(i, 0) for i in range(1, 41)] + [(k, 100) for k in range(101, 160)])
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    for most in (0, 1000):
        monkeypatch.setattr(components, "BROADCAST", most)
        found, rows = components.stars(df)
        assert sorted((r.a, r.b) for r in found.collect()) == want and rows == len(want)
