import random

import pytest


def corpus(seed=3, n=160):
    """Small texts with copies, near copies, shared passages and lines, odd bytes, nulls and repeated rows."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "naïve", "日本", "x y", "A.b", "e-mail", "\x00", "\x1c"]
    passage = " ".join(rng.choice(vocabulary) + str(k) for k in range(60))
    lines = [" ".join(rng.choices(vocabulary, k=4)) for _ in range(6)]
    texts = []
    for k in range(n):
        kind = k % 8
        words = rng.choices(vocabulary, k=rng.randint(0, 60))
        text = rng.choice([" ", "\t", "\n"]).join(words)
        if kind == 1 and texts:
            text = rng.choice(texts) or ""
        elif kind == 2 and texts:
            words = (rng.choice(texts) or "").split(" ")
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
            text = " ".join(words)
        elif kind == 3:
            text = text + " " + passage + "\n" + text
        elif kind == 4:
            text = "\n".join(rng.choices(lines, k=rng.randint(1, 9)))
        elif kind == 5:
            text = "\n".join(lines) + "\n" + text + "\n\n\n\n"
        texts.append(text)
    texts += [None, "", " \n\t ", passage.upper(), "one", "one two", "x" * 5000, (passage + " ") * 40]
    docs = [(i, t) for i, t in enumerate(texts)]
    return [*docs, docs[3], docs[11], (None, passage)]


@pytest.fixture(scope="session")
def docs():
    return corpus()


@pytest.fixture(scope="session")
def docs_df(spark, docs):
    rows = [(i, t, None if k % 9 == 0 else "en", f"src{k % 3}", None if t is None else len(t), k, "z") for k, (i, t) in enumerate(docs)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, pos int, h string").repartition(5)


@pytest.fixture(scope="session")
def empty_df(docs_df):
    return docs_df.where("false")
