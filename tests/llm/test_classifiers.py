"""The classifiers' parts against plain Python: n-gram sets, kernels, the risk and the samples."""

import random

import numpy as np
from pyspark.sql import functions as F

from conftest import TESTDATA
from terrace.llm import language_id, ngrams, toxicity
from terrace.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string"


def cleaned(text):
    """Lower case, one space for each run of what is no letter, one on either side."""
    out = " "
    for c in text.lower():
        out += c if c.isalpha() else "" if out.endswith(" ") else " "
    return out if out.endswith(" ") else out + " "


def grams(text):
    t = cleaned(text)
    return {t[i : i + n] for n in language_id.SIZES for i in range(len(t) - n + 1)}


def slots_of(text):
    return ngrams.Presence(language_id.SIZES, language_id.SLOT_BITS).slots(ngrams.letters_only(text)[0])


def test_slots_are_those_of_the_distinct_n_grams():
    rng = random.Random(1)
    for _ in range(60):
        text = "".join(rng.choices("abcdéß ..1 ﬁ日本", k=rng.randrange(1, 60)))
        alone = {g: set(slots_of_gram(g)) for g in grams(text)}
        assert set(slots_of(text).tolist()) == set().union(*alone.values())


def slots_of_gram(gram):
    """The one slot of an n-gram, worked out by itself."""
    mask = 0xFFFFFFFF
    hashed = 0
    for c in gram:
        spread = ord(c) * 0x9E3779B1 & mask
        hashed = (hashed * 0x85EBCA6B + (spread ^ spread >> 15)) & mask
    kind = len(gram) * 0x85EBCA6B & mask
    return [(((hashed ^ hashed >> 15) * 0x9E3779B1 + kind) & mask) >> (32 - language_id.SLOT_BITS)]


def kernel(a, b):
    return len(a & b) / np.sqrt(len(a) * len(b)) if a and b else 0.0


def test_scores_equal_ridge_regression_on_explicit_kernels(spark):
    """The folded product against kernels of sets, Nystroem features and a solved ridge, one by one."""
    rng = random.Random(4)
    stock = {"aa": "kaloni mesura tivo banda", "bb": "wrzt grmpf klonk zwei", "cc": "oui eau beau yeux aie"}
    rows = [(i, " ".join(rng.choices(stock[lang].split(), k=6)) + " " + "".join(rng.choices("abcdefgh", k=5)), lang) for i, lang in enumerate(list(stock) * 14)]
    docs = spark.createDataFrame(rows, DOCS)
    model = language_id.fit(docs, size=60, landmarks=9)
    chosen = language_id.sample(docs, F.lit(True), 60)
    assert len(chosen) == len({(r[1], r[2]) for r in rows})
    sets = [frozenset(s.tolist()) for _, s in chosen]
    truth = np.array([sorted(stock).index(lang) for lang, _ in chosen])
    marks = [i for c in range(3) for i in np.flatnonzero(truth == c)[:3]]
    k = np.array([[kernel(sets[i], sets[j]) for j in marks] for i in range(len(sets))])
    values, vectors = np.linalg.eigh(k[marks])
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    features = np.hstack([k @ root, np.ones((len(sets), 1))])
    target = np.where(truth[:, None] == np.arange(3), 1.0, -1.0)
    penalty = language_id.RIDGE * np.eye(features.shape[1])
    penalty[-1, -1] = 0
    solved = np.linalg.solve(features.T @ features + penalty, features.T @ target)
    for text in ["kaloni tivo", "beau klonk yeux", "abcdefgh", "z"]:
        own = frozenset(slots_of(text).tolist())
        want = np.append(np.array([kernel(own, sets[j]) for j in marks]) @ root, 1.0) @ solved
        got = model.scores([np.array(sorted(own), np.int32)])[0]
        assert np.allclose(got, want, atol=1e-4)
        row = spark.createDataFrame([(1, text, None)], DOCS).select(language_id.predict(docs, model).alias("p")).first()["p"]
        assert row["lang_pred"] == sorted(stock)[int(np.argmax(want))]
        assert abs(row["score"] - np.clip((want.max() + 1) / 2, 0, 1)) < 1e-4


def test_samples_are_bounded_whatever_the_ids(spark, monkeypatch):
    """A hot id, copies and junk languages: the driver gets no more than the bounds."""
    monkeypatch.setattr(language_id, "LANGUAGES", 5)
    rows = [(7, f"text number {i} of the hot id", "en") for i in range(900)] + [(i, "a copy", "fr") for i in range(900)]
    rows += [(None, f"without id {i}", "de") for i in range(300)] + [(1, "junk", f"x{i}") for i in range(200)]
    rows += [(2, None, "en"), (3, "", "en"), (4, "12 3", "en")]
    docs = spark.createDataFrame(rows, DOCS).repartition(6)
    chosen = language_id.sample(docs, F.lit(True), 60)
    per = {lang: sum(c[0] == lang for c in chosen) for lang, _ in chosen}
    assert per["en"] <= 12 and per["de"] <= 12 and per["fr"] == 1 and len(per) <= 5
    assert per["en"] >= 6 and per["de"] >= 6
    again = language_id.sample(docs.repartition(3), F.lit(True), 60)
    assert [(c, s.tolist()) for c, s in chosen] == [(c, s.tolist()) for c, s in again]
    drawn = toxicity._sample(docs, 50, "s")
    assert 35 <= len(drawn) <= 50
    assert len(toxicity._sample(docs.where("lang = 'fr'"), 50, "s")) == 1
    assert toxicity._sample(docs.limit(0), 50, "s") == []


def explicit_features(text):
    """Words, their beginnings and the n-grams of runs that are more than words, as Python sees them."""
    out = set()
    for word in cleaned(text).split(" "):
        if not word:
            continue
        out.add(("word", word[: ngrams.LONG_WORD], len(word)))
        for n in toxicity.SIZES:
            if len(word) > n:
                out.add(("begins", word[:n]))
        more = any(low <= ord(c) <= high for c in word for low, high in ngrams.UNSPACED)
        if len(word) > ngrams.LONG_WORD or more:
            out |= {("run", word[i : i + n]) for n in ngrams.RUN_SIZES for i in range(len(word) - n + 1)}
    return out


def test_word_features_see_every_letter():
    presence = ngrams.Presence(toxicity.SIZES, toxicity.SLOT_BITS)

    def slots(texts):
        return [set(s.tolist()) for s in presence.word_slots([ngrams.letters_only(t)[0] for t in texts])]

    rng = random.Random(9)
    texts = ["", "a", "x" * 24, "x" * 25, "ab" * 40 + " cd", "日本語のテキスト", "ไทย abc", "plain words only here"]
    texts += ["".join(rng.choices("abcd 日本é.", k=rng.randrange(1, 90))) for _ in range(80)]
    found = slots(texts)
    for text, own in zip(texts, found):
        assert len(own) <= len(explicit_features(text)) <= len(own) + 2, text
    # Texts differ in their slots when they differ in a feature, in a batch as alone.
    assert found == [slots([t])[0] for t in texts]
    long_a, long_b = "q" * 24 + "abcdef", "q" * 24 + "abcxef"
    assert slots([long_a])[0] != slots([long_b])[0]
    assert slots(["日本語"])[0] & slots(["本語"])[0]


def risk(theta, bias, pos, unl, prior):
    """The two parts of the non-negative risk, text by text."""
    g = lambda s: 1 / (1 + np.exp(-np.clip(theta[s].sum() + bias, -40, 40)))
    positive = prior * np.mean([-np.log(g(s)) for s in pos])
    negative = np.mean([-np.log(1 - g(s)) for s in unl]) - prior * np.mean([-np.log(1 - g(s)) for s in pos])
    return positive, negative


def test_training_lowers_the_non_negative_risk():
    rng = np.random.default_rng(2)
    pos = [np.unique(np.append(rng.integers(50, 400, 12), rng.integers(0, 10, 2))).astype(np.int32) for _ in range(300)]
    unl = [np.unique(np.append(rng.integers(50, 400, 12), rng.integers(0, 10, 2) if rng.random() < 0.1 else [])).astype(np.int32) for _ in range(900)]
    model = toxicity.train(pos, unl, 0.1)
    used = len(model.weights) - 1
    assert 8 <= used <= 14 and set(np.flatnonzero(model.rows < used)) >= set(range(8))
    theta = np.append(model.weights[:-1], 0.0)
    kept = [[model.rows[s][model.rows[s] < used] for s in part] for part in (pos, unl)]
    before, after = risk(np.zeros(used + 1), np.log(0.1 / 0.9), *kept, 0.1), risk(theta, model.bias, *kept, 0.1)
    total = lambda r: r[0] + max(0.0, r[1])
    assert total(after) < 0.6 * total(before)
    # Its slope there, by differences of the risk itself, is flat in every weight that is used.
    step = 1e-4
    for j in range(used):
        moved = []
        for sign in (1, -1):
            other = theta.copy()
            other[j] += sign * step
            moved.append(total(risk(other, model.bias, *kept, 0.1)))
        assert abs(moved[0] - moved[1]) / (2 * step) < 0.02
    scores = model.scores(pos), model.scores(unl)
    assert np.mean(scores[0] > 0.3) > 0.85 and np.mean(scores[1] > 0.3) < 0.2


def test_toxic_words_in_long_runs_and_unspaced_texts(spark):
    rng = random.Random(6)
    plain = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(200)]
    rows, labels = [], []
    for i in range(900):
        words = rng.choices(plain, k=20)
        toxic = i % 6 == 0
        if toxic and i % 12:
            words[3] = "m" * 26 + "vilestuff" + rng.choice("xyz")
        elif toxic:
            words[3] = "".join(rng.choices("天地玄黄宇宙洪荒", k=5)) + "毒話" + "".join(rng.choices("日月盈昃", k=4))
        else:
            words[5] = "".join(rng.choices("天地玄黄宇宙洪荒日月盈昃", k=9)) + " " + "m" * 26 + "".join(rng.choices(plain, k=1)) + rng.choice("xyz")
        rows.append((i, " ".join(words), None))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, DOCS)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.col("doc_id") % 5 != 0)
    held = docs.where("doc_id % 5 = 0").select("doc_id", toxicity.score(docs, model).alias("s")).collect()
    assert all((r["s"] >= 0.3) == (r["doc_id"] % 6 == 0) for r in held)
    odd = spark.createDataFrame([(1, None, None), (1, "", None), (2, "x" * 200_000, None), (None, "a", None)] * 2, DOCS)
    scores = [r["s"] for r in odd.select(toxicity.score(odd, model).alias("s")).collect()]
    assert all(0 <= s <= 1 for s in scores) and len(scores) == 8 and scores[0] == scores[1]
    assert odd.limit(0).select(toxicity.score(odd, model)).count() == 0


def test_queries_score_each_document_as_the_model_does(spark):
    """Held-out marks and predictions of the registered queries, by zlib and by the parts above."""
    import zlib

    for name, folds, out in (("op1_language_id", 5, 0), ("op3_toxicity", 4, 2)):
        rows = QUERIES[name](spark, TESTDATA).collect()
        assert len(rows) == spark.read.parquet(f"{TESTDATA}/documents.parquet").count()
        for r in rows:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == out) and 0 <= r["score"] <= 1
            if name == "op3_toxicity":
                assert r["predicted"] == int(r["score"] >= 0.3)
