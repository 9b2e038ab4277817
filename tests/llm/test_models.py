import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pledgewise.llm import language, lm, pieces, quality, sentencepieces, toxicity

from . import brute


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


def make(n, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choices(["ta", "no", "ri", "mel", "dos", "ku"], k=rng.randint(1, 4))) for _ in range(300)]
    bad = ["grotbag", "grotbags", "dimwit"]
    rows = []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(30, 90))
        toxic, good = i % 4 == 0, i % 3 != 0
        if toxic:
            text[::15] = rng.choices(bad, k=len(text[::15]))
        rows.append((i, " ".join(text) if good else " ".join(w.upper() + "!!" for w in text), int(toxic), int(good)))
    return rows


@pytest.fixture(scope="module")
def labelled(spark):
    rows = make(600)
    docs = [(i, t, "xx", "s", len(t)) for i, t, _, _ in rows] + [(900, "", None, None, None), (901, None, None, None, None), (None, "tano", None, None, 3)]
    docs += [(902, " ".join(rows[1][1].split() + ["grotbaags", "dimwwit", "grootbag"] * 3), None, None, None)]
    labels = [(i, q, x) for i, _, x, q in rows] + [(None, 1, 0), (5000, None, None)]
    return rows, spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity(labelled):
    rows, docs, labels = labelled
    got = {r.doc_id: r for r in toxicity.score_texts(docs, labels).collect()}
    assert len(got) == 604 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert all(got[i].held_out == (crc(i, 4) == 2) for i, *_ in rows)
    held = [(got[i].predicted, x) for i, _, x, _ in rows if got[i].held_out]
    assert sum(p == x for p, x in held) > 0.95 * len(held)
    assert got[902].score > got[1].score  # misspellings that were never seen
    assert toxicity.score_texts(docs.where("false"), labels).count() == 0
    assert max(r.score for r in toxicity.score_texts(docs, labels.where("false")).collect()) < 1e-6


def test_toxicity_against_a_plain_score(labelled):
    """Scores of the operator from its own model, text by text and word by word."""
    rows, docs, labels = labelled
    model, _ = toxicity.train(docs, labels, toxicity.F.expr("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2"))
    got = {r.doc_id: r.score for r in toxicity.score_texts(docs, labels).collect()}
    for i, text, _, _ in rows[:20]:
        counts = Counter(text.lower().split())
        bag, weight = np.zeros(toxicity.DIM), sum(math.sqrt(n) for n in counts.values())
        for word, n in counts.items():
            buckets, _ = toxicity.subword_buckets([toxicity.normal(word.encode())], toxicity.BUCKETS)
            bag += math.sqrt(n) / weight * np.mean([model.vectors[b] for b in buckets], axis=0)
        logits = bag * toxicity.SCALE @ model.softmax + model.bias
        assert got[i] == pytest.approx(np.exp(logits[1]) / np.exp(logits).sum(), abs=1e-4)


def test_toxicity_learns_from_few_rows(spark):
    """Words of five toxic rows alone are learned, and misspellings share their n-grams."""
    rng = random.Random(3)
    plain = ["tano", "melri", "dosku", "kuri", "nota", "rimel"]
    docs = [(i, " ".join(rng.choices(plain, k=30) + (["grotbag"] * 3 if i % 8 == 0 else []))) for i in range(40)]
    docs += [(900, " ".join(plain * 4)), (901, " ".join(plain * 4 + ["grotbags"] * 3))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 8 == 0)) for i in range(40)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score_texts(df, labels, held_out=toxicity.F.col("doc_id") >= 900).collect()}
    assert got[901] > 0.5 > 0.3 > got[900]


def test_clashing_columns_and_repeated_rows(spark, labelled):
    """Other columns with the operators' own names change nothing, and each of two equal rows gets a row."""
    _, docs, labels = labelled
    odd = docs.limit(80).selectExpr("*", "text as score", "doc_id as label", "1 as held_out", "'x' as declared", "'y' as words", "2 as h", "3 as size")
    for run in (toxicity.score_texts, quality.score_texts):
        one = sorted((r.doc_id, r.score) for r in run(docs.limit(80), labels).collect())
        two = sorted((r.doc_id, r.score) for r in run(odd.union(odd), labels).collect())
        assert [x for x, _ in two] == sorted([i for i, _ in one] * 2)
    assert language.identify(odd.union(odd)).count() == 160


def test_one_long_text(spark):
    """More than a slice of text in one row, for every operator that scores or encodes."""
    words = [f"w{i % 977}" for i in range(420_000)]
    long = " ".join(words)
    assert len(long) > 1.5 * (1 << 20)
    docs = spark.createDataFrame([(1, long, "en", len(long)), (2, "w1 w2", "en", 5), (3, None, "en", None)], "doc_id long, text string, lang string, n_chars long")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.score_texts(docs, labels).count() == quality.score_texts(docs, labels).count() == language.identify(docs).count() == 3
    got = {r.doc_id: r for r in lm.score_texts(docs, n_hot=100, n_model=50).collect()}
    assert got[1].n_tokens == 420_001 and got[2].n_tokens == 3 and got[3].n_tokens == 1
    assert sentencepieces.encode_and_check(docs).where("not round_trip").count() == 0


def test_statistics_of_texts():
    """The structure features against plain counts."""
    texts = ["Ab 1!|é\nAb Ab", "", None, "x" * 10, "A1 b2\n\nA1"]
    found = quality.features(pa.array(texts, pa.string()), np.array([np.nan, 7, np.nan, 5, 9.0]))[3]
    for row, (text, declared) in enumerate(zip(texts, [None, 7, None, 5, 9], strict=True)):
        raw, words = (text or "").encode(), (text or "").lower().split()
        size, n = max(len(raw), 1), max(len(words), 1)

        def share(test, raw=raw, size=size):
            return sum(map(test, raw)) / size

        symbol = share(lambda b: 32 < b < 127 and not chr(b).isalnum())
        want = [
            share(lambda b: 65 <= b <= 90), share(lambda b: 48 <= b <= 57), symbol, share(lambda b: b == 124), share(lambda b: b > 127), share(lambda b: b == 32), math.log1p(raw.count(10)),
            len(set(words)) / n, sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, sum(len(w.encode()) for w in words) / n, math.log1p(len(raw)), math.log1p(len(words)),
            math.log1p(len(text or "") if declared is None else declared) - math.log1p(len(text or "")),
        ]
        assert np.allclose(found[row], want), quality.STATISTICS


def test_quality(labelled):
    rows, docs, labels = labelled
    got = {r.doc_id: r for r in quality.score_texts(docs, labels).collect()}
    assert len(got) == 604 and all(got[i].held_out == (crc(i, 5) == 0) for i, *_ in rows)
    held = [(got[i].predicted, q) for i, _, _, q in rows if got[i].held_out]
    assert sum(p == q for p, q in held) > 0.97 * len(held)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted}
    assert {r.predicted for r in quality.score_texts(docs, labels.where("false")).collect()} == {1}
    assert quality.score_texts(docs.where("false"), labels).count() == 0


def test_quality_against_a_plain_score(labelled):
    """Scores of the operator from its own model: every pair of a text's features, one by one."""
    rows, docs, labels = labelled
    model = quality.train(docs, labels, F.expr("coalesce(crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0, true)"))
    got = {r.doc_id: r.score for r in quality.score_texts(docs, labels).collect()}
    for i, text, _, _ in rows[:12]:
        _, bucket, value, statistics = quality.features(pa.array([text], pa.string()), np.array([float(len(text))]))
        assert len(bucket) == len(set(bucket.tolist())) and value == pytest.approx([math.sqrt(n / len(text.split())) for n in _by_bucket(text, bucket)])
        x = {int(b): float(v) for b, v in zip(bucket, value, strict=True)}
        x |= {quality.BUCKETS + k: min(max((v - c) / w, -4), 4) for k, (v, c, w) in enumerate(zip(statistics[0], model.centre, model.width, strict=True))}
        odds = model.bias + sum(model.weights[a] * v for a, v in x.items())
        odds += sum(float(model.factors[a] @ model.factors[b]) * x[a] * x[b] for a, b in itertools.combinations(x, 2))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-9)


def _by_bucket(text, buckets):
    """How many words of the text are in each bucket, found word by word."""
    own = Counter()
    for word in text.split():
        own[int(quality.features(pa.array([word], pa.string()), np.array([1.0]))[1][0])] += 1
    return [own[int(b)] for b in buckets]


def test_machine_sums_all_pairs():
    model, rng = quality.Machine(), np.random.default_rng(2)
    model.factors = rng.normal(size=model.factors.shape)
    model.weights = rng.normal(size=model.weights.shape)
    at, x = np.array([3, 10, 500, quality.BUCKETS + 2]), rng.normal(size=4)
    want = model.bias + model.weights[at] @ x + sum(model.factors[at[i]] @ model.factors[at[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    assert model.odds(np.zeros(4, int), at, x, 1)[0][0] == pytest.approx(want)


@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(4)
    sounds = {"en": ["the", "ing", "wh", "ed", "tion"], "fr": ["eau", "que", "oi", "é", "ç"], "de": ["sch", "ung", "ü", "ei", "pf"]}
    rows = []
    for i in range(400):
        name = rng.choice(list(sounds))
        rows.append((i, " ".join("".join(rng.choices(sounds[name], k=rng.randint(1, 4))) for _ in range(rng.randint(3, 40))), name))
    return rows, spark.createDataFrame([*rows, (900, None, "en"), (901, "123 !! ²½①", "fr"), (902, "eau que", None), (None, "the", "en")], "doc_id long, text string, lang string")


def test_language(tongues):
    rows, docs = tongues
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert got[900].lang_pred == got[901].lang_pred == "und" and got[902].lang_pred == "fr" and len(got) == 404
    held = [(got[i].lang_pred, name) for i, _, name in rows if got[i].held_out]
    assert held and sum(a == b for a, b in held) > 0.97 * len(held)
    assert {r.lang_pred for r in language.identify(docs.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()} == {"und"}
    assert language.identify(docs.where("false")).count() == 0


def test_long_texts_and_words_are_learned_from(spark):
    """A language of one long text, and one written without spaces."""
    rng = random.Random(1)
    rows = [(i, " ".join("".join(rng.choices(["the", "ing"], k=3)) for _ in range(20)), "en") for i in range(60)]
    rows += [(1000 + i, "".join(rng.choices("กขคงจ", k=61 + i)), "th") for i in range(30)]
    rows += [(2003, " ".join("".join(rng.choices(["sch", "ung"], k=3)) for _ in range(3000)), "de")]
    rows += [(3000, "schung ungsch", None), (3001, "กขคงจ" * 20, None), (3002, "thething", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert crc(2003, 4) != 2
    got = {r.doc_id: r.lang_pred for r in language.identify(docs, max_chars=500).collect()}
    assert [got[i] for i in (3000, 3001, 3002)] == ["de", "th", "en"]


def test_language_against_a_plain_sum(tongues):
    """Predictions and scores of the operator from its own model, word by word."""
    rows, docs = tongues
    names, prior, probability, vocabulary = language.train(docs, language.F.expr("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2"), pieces.PATH)
    number = {p: n for n, p in enumerate(vocabulary)}
    longest = max(map(len, vocabulary))

    def log_sum(word, k):
        sums = [1.0] + [0.0] * len(word)
        for j in range(1, len(word) + 1):
            sums[j] = sums[j - 1] * language.UNKNOWN + sum(sums[i] * probability[number[word[i:j]], k] for i in range(max(j - longest, 0), j) if word[i:j] in number)
        return math.log(sums[-1])

    got = {r.doc_id: r for r in language.identify(docs).collect()}
    for i, text, _ in rows[:25]:
        odds = np.array([prior[k] + sum(log_sum(f" {w}", k) for w in language.words_of(text)) for k in range(len(names))])
        assert got[i].lang_pred == names[int(odds.argmax())] and got[i].score == pytest.approx(1 / np.exp(odds - odds.max()).sum(), rel=1e-6)


def test_ties_and_repeated_rows_of_languages(spark):
    docs = spark.createDataFrame([(1, "aba", "y"), (1, "aba", "y"), (3, "aba", "x"), (3, "aba", "x"), (4, "aba", None), (4, "aba", None)], "doc_id long, text string, lang string")
    got = [r for r in language.identify(docs, held_out=language.F.col("doc_id") == 4).collect() if r.doc_id == 4]
    assert [(r.lang_pred, round(r.score, 6)) for r in got] == [("x", 0.5)] * 2


def test_letters_outside_the_vocabulary_do_not_hide_what_follows():
    """Sixty letters that no piece holds before a word: the pieces of the word are still learned from."""
    automaton = language.Automaton([" the", "the", "t", "h", "e", " q"])
    fitted = language.fit([" ".join("\u4e00" * 60 + "the" for _ in range(50))], automaton, 6)
    assert fitted[1] > 0.9 and abs(fitted.sum() - 1) < 1e-9


def test_sample_does_not_depend_on_unusable_ids_or_partitions(spark):
    docs = [(i, f"text {i}") for i in range(20)] + [(3, f"other {k}") for k in range(200)] + [(50, ""), (51, None), (52, "x" * 99)]
    labels = [(i, i % 2) for i in range(20)] + [(i, i % 2) for i in range(50, 5050)] + [(4, None), (5, 7)]
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = [toxicity.labelled_sample(docs.repartition(n), labels.repartition(n), "toxic", F.lit(True), {0: 50, 1: 50}, 90) for n in (1, 7)]
    assert got[0] == got[1] and [r.doc_id for r in got[0]] == list(range(20))
    assert len(toxicity.labelled_sample(docs, labels, "toxic", F.lit(True), {0: 5, 1: 3}, 90)) == 8


def test_all_segmentations_are_summed():
    rng = np.random.default_rng(3)
    vocabulary = [" ", "a", "b", "ab", "ba", "aba", " a", "bab"]
    probability = rng.random((len(vocabulary), 2))
    words = ["a", "ab", "abab", "bababa", "axb", "ab" * 40]
    got = language.log_likelihood(words, pieces.Automaton(vocabulary), probability)

    def total(text, k):
        sums = [1.0] + [0.0] * len(text)
        for j in range(1, len(text) + 1):
            sums[j] = sums[j - 1] * language.UNKNOWN + sum(sums[j - len(p)] * probability[n, k] for n, p in enumerate(vocabulary) if text[:j].endswith(p))
        return math.log(sums[-1])

    assert np.allclose(got, [[total(f" {w}", k) for k in range(2)] for w in words])


@pytest.fixture(scope="module")
def encoder():
    return sentencepieces.Encoder(pieces.load())


def test_segmentation_is_best(encoder):
    """Against a dynamic programme that tries every piece at every place of the whole text."""
    v = encoder.vocabulary
    score, ids = dict(zip(v.pieces, v.scores, strict=True)), dict(zip(v.pieces, v.ids.tolist(), strict=True))
    texts = ["Is and retitioning ouen the of,", "  two  spaces ", "日本語☃ né\n\nü", "a" * 40, " ", "\t\x00", "▁x", "é"]
    got, begin = encoder.encode(texts)
    by_id = {i: p for p, i in ids.items()}
    for k, text in enumerate(texts):
        text = f" {text}"
        best = [0.0] + [-math.inf] * len(text)
        for j in range(1, len(text) + 1):
            if text[j - 1] not in score:
                best[j] = best[j - 1] + encoder.missing
            for size in range(1, min(j, 16) + 1):
                if (p := text[j - size : j]) in score:
                    best[j] = max(best[j], best[j - size] + score[p])
        own, n_bytes = got[begin[k] : begin[k + 1]].tolist(), len(text.encode())
        unknown = sum(c not in score for c in text)
        assert sum(score[by_id[i]] for i in own if i in by_id) + unknown * encoder.missing == pytest.approx(best[-1], rel=1e-12)
        assert len(own) <= n_bytes


def test_round_trip(encoder, docs, docs_df, empty_df):
    got = sentencepieces.encode_and_check(docs_df)
    assert got.where("not round_trip").count() == 0 and got.where("ids is null").count() == 1
    assert sorted(map(tuple, sentencepieces.decode(sentencepieces.encode(docs_df)).collect()), key=repr) == sorted(docs, key=repr)
    assert sentencepieces.encode_and_check(empty_df).count() == 0


def test_ids_decode_in_the_public_library(encoder, docs):
    sentencepiece = pytest.importorskip("sentencepiece")
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.PATH)
    texts = [t for _, t in docs if t and "▁" not in t]
    ids, begin = encoder.encode(texts)
    for k, text in enumerate(texts):
        assert model.decode(ids[begin[k] : begin[k + 1]].tolist()) == text


def test_lm_base_scores(docs, docs_df, empty_df):
    for hot in (200_000, 20):
        got = {(r.doc_id, r.n_tokens): r for r in lm.score_texts(docs_df, n_hot=hot, n_model=10).collect()}
        words = {k: brute.SPACES.findall(brute.lower(t)) for k, (_, t) in enumerate(docs)}
        train = [k for k, (i, _) in enumerate(docs) if i is None or crc(i, 5) != 1]
        counts, total = Counter(w for k in train for w in words[k]), sum(len(words[k]) + 1 for k in train)
        below = total + 0.5 * (len(counts) + 1 + 1)
        for k, (i, _) in enumerate(docs):
            r = got[i, len(words[k]) + 1]
            want = sum(math.log10((counts[w] + 0.5) / below) for w in words[k]) + math.log10((len(train) + 0.5) / below)
            assert r.base_score == pytest.approx(want) and r.train_tokens == total
            assert r.n_known == sum(counts[w] > 0 for w in words[k]) + 1 and r.held_out == (i is not None and crc(i, 5) == 1)
    assert lm.score_texts(docs_df).count() == len(docs)
    assert lm.score_texts(empty_df).count() == 0


@pytest.mark.parametrize("hot", [200_000, 30])
def test_lm_against_a_plain_score(docs, docs_df, hot):
    """Scores of the operator from its own model: a softmax over all outputs for every token, and a share of its class for each word outside."""
    texts = docs_df.select("doc_id", "text")
    training = texts.where(~F.coalesce(F.expr("crc32(cast(cast(doc_id as string) as binary)) % 5 = 1"), F.lit(False)))
    vocab = lm.vocabulary(lm.count_words(training).checkpoint(), training.count(), hot, 12)
    parts = lm.train(training, vocab).parts
    train = [t for i, t in docs if i is None or crc(i, 5) != 1]
    counts = Counter(w for t in train for w in brute.SPACES.findall(brute.lower(t)))
    inside = {w.decode(): lm.FIRST + k for k, w in enumerate(vocab.words[:12])}
    mass = Counter({k: 0.5 for k in range(1, lm.FIRST)})
    for w, n in counts.items():
        if w not in inside:
            mass[lm.ending(w.encode())] += n + 0.5
    got = {(r.doc_id, r.n_tokens, round(r.base_score, 6)): r.score for r in lm.score_texts(docs_df, n_hot=hot, n_model=12).collect()}
    below = sum(counts.values()) + len(train)
    below += 0.5 * (len(counts) + 1 + 1)
    for i, t in docs[:40]:
        words, near, far, want = brute.SPACES.findall(brute.lower(t)), vocab.outputs, vocab.outputs, 0.0
        base = sum(math.log10((counts[w] + 0.5) / below) for w in words) + math.log10((len(train) + 0.5) / below)
        for w in [*words, None]:
            out = lm.END if w is None else inside.get(w, lm.ending(w.encode()))
            logits = (parts["near"][near].astype(float) + parts["far"][far]) @ parts["out"].T.astype(float) + parts["bias"][:, 0]
            want += (logits[out] - np.logaddexp.reduce(logits)) / math.log(10)
            if w is not None and w not in inside:
                want += math.log10((counts[w] + 0.5) / mass[out])
            near, far = out, near
        assert got[i, len(words) + 1, round(base, 6)] == pytest.approx(want, abs=1e-3 * (len(words) + 1))


def test_lm_is_normalised_and_learns():
    rng = np.random.default_rng(1)
    model = lm.Bilinear(np.array([0.1, 0.2, 0.3, 0.4]))
    far, near = rng.integers(0, 4, 60_000), rng.integers(0, 4, 60_000)
    for seed in range(3):
        model.learn_all((near + 1) % 4, near, far, seed)
    a, b, w = (x.ravel() for x in np.meshgrid(*[np.arange(4)] * 3, indexing="ij"))
    p = np.exp(model.logits(w, a, b) - model.log_sums()[a, b]).reshape(4, 4, 4)
    assert np.allclose(p.sum(axis=2), 1, atol=1e-4)
    assert min(p[a, b, (a + 1) % 4] for a in range(4) for b in range(4)) > 0.8


def test_lm_shares_of_classes_add_up():
    """All words of a class and one unseen share the class's probability."""
    words = [f"w{i}x".encode() for i in range(400)]
    counts = {w: 1 + i % 7 for i, w in enumerate(words)}
    outside, rest = words[10:], np.zeros((2, lm.ENDINGS))
    for w in outside:
        rest[:, lm.ending(w) - 1] += counts[w], 1
    mass = lm.Vocabulary(words[:10], np.array([counts[w] for w in words[:10]]), 10, 5, 0, 0, rest).mass()
    for k in range(1, lm.FIRST):
        share = sum((counts[w] + 0.5) / mass[k] for w in outside if lm.ending(w) == k) + 0.5 / mass[k]
        assert share == pytest.approx(1)


def test_lm_class_of_a_column(spark):
    words = ["a", "ab", "abc", "é", "日本", "x\x00", "naïve"]
    got = spark.createDataFrame([(w,) for w in words], "word string").select(lm.ending_of(lm.F.col("word")).alias("e")).collect()
    assert [r.e for r in got] == [lm.ending(w.encode()) for w in words]


def test_lm_does_not_depend_on_partitions_and_beats_its_base(spark):
    rng = random.Random(9)
    tongue = {0: ["tabor", "melino", "dosar", "kupit"], 1: ["qwenth", "shrid", "plonk", "vexing"]}
    docs = []
    for i in range(500):
        docs.append((i, " ".join(rng.choice(tongue[i % 2]) + rng.choice(["", "a", "os", str(rng.randrange(50))]) for _ in range(rng.randint(20, 120)))))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = []
    for n in (1, 7, 40):
        rows = {r.doc_id: r for r in lm.score_texts(df.repartition(n, "doc_id"), n_model=20).collect()}
        found.append({i: r.score for i, r in rows.items()})
        held = [r for r in rows.values() if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.05 * sum(r.n_tokens for r in held)
        assert np.mean([r.score > r.base_score for r in held]) > 0.9
    for other in found[1:]:
        assert all(other[i] == pytest.approx(s, abs=1e-3) for i, s in found[0].items())


def test_lm_many_shards(spark, docs_df):
    """Small shards, so that several share a partition and long texts are cut."""
    training = lm.text_column(docs_df)
    vocab = lm.vocabulary(lm.count_words(training), training.count(), 1000, 30)
    a, b = (lm.train(training.repartition(n), vocab, shard_tokens=200) for n in (1, 6))
    assert all(np.allclose(a.parts[k], b.parts[k], atol=1e-5) for k in a.parts) and not np.allclose(a.parts["out"], lm.Bilinear(vocab.unigram()).parts["out"])


def test_word_pattern():
    assert language.words_of("Ab1c-É_x") == ["ab", "c", "é", "x"] and not re.search(language.WORD, "12_ !")
    assert language.words_of("²½①Ⅷ 3") == [] and language.words_of("a²b½ 日本") == ["a", "b", "日本"]
    assert toxicity.words_of(None) == []
