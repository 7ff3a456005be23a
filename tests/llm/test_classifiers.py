import inspect
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillage.llm import language_id, quality, toxicity


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def corpus():
    """(doc_id, text, lang, toxic) of an invented vocabulary for each of three languages."""
    rng = np.random.default_rng(12)
    roots = {"en": ["th", "ing", "er", "wh", "ou", "sh"], "de": ["sch", "ei", "ung", "ö", "pf", "zu"], "fr": ["eau", "ç", "oi", "ez", "qu", "è"]}
    rows = []
    for i in range(600):
        lang = ["en", "de", "fr"][i % 3]
        words = ["".join(rng.choice(roots[lang], rng.integers(1, 4))) for _ in range(60)]
        toxic = int(rng.random() < 0.3)
        if toxic:
            words[int(rng.integers(60))] = "vileword"
        rows.append((i, " ".join(words), lang, toxic))
    return rows


def test_language_held_out(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string, lang string, toxic int")
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 50 == 1, None).otherwise(F.col("lang")))
    found = {r.doc_id: r for r in language_id.predict(docs, language_id.train(docs)).collect()}
    out = [i for i, _, _, _ in corpus if held(i)]
    assert np.mean([found[i].lang_pred == corpus[i][2] for i in out]) > 0.98
    assert all(0 <= r.score <= 1 for r in found.values())


def test_held_out_rows_teach_nothing(spark):
    ids = [i for i in range(200) if held(i)]
    docs = spark.createDataFrame([(i, "abc def", "xx") for i in ids], "doc_id long, text string, lang string")
    f = language_id.train(docs)
    assert f.languages == () and {r.lang_pred for r in language_id.predict(docs, f).collect()} == {"und"}


def test_filters_are_exact_up_to_false_positives():
    rng = np.random.default_rng(13)
    grams = {k: rng.integers(0, 1 << 63, 2000).astype(np.uint64) for k in ("a", "b")}
    f = language_id.build(grams, (3,), 4, 12)
    for k, name in enumerate(f.languages):
        assert ((f.masks(grams[name])[:, 0] >> np.uint64(k)) & np.uint64(1)).all()
    other = (f.masks(rng.integers(0, 1 << 63, 50_000).astype(np.uint64))[:, 0] & np.uint64(1)).mean()
    assert abs(other - f.noise[0]) < 0.01


def test_language_of_awkward_rows(awkward, spark, corpus):
    f = language_id.train(spark.createDataFrame(corpus, "doc_id long, text string, lang string, toxic int"))
    got = language_id.predict(awkward, f)
    assert sorted(got.columns) == sorted([*awkward.columns, "lang_pred"])
    rows = got.collect()
    assert len(rows) == 9 and {r.lang_pred for r in rows if r.doc_id in (2, 3, 4)} == {"und"}
    assert all(r.lang_pred in f.languages for r in rows if r.doc_id in (1, 5))
    assert language_id.predict(awkward.limit(0), f).count() == 0


def test_toxicity_held_out(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string, lang string, toxic int")
    labels = docs.select("doc_id", "toxic")
    rows = {r.doc_id: r for r in toxicity.predict(docs.select("doc_id", "text"), toxicity.train(docs, labels)).collect()}
    out = [i for i, _, _, _ in corpus if held(i)]
    assert np.mean([rows[i].predicted == corpus[i][3] for i in out]) > 0.97
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows.values())


def test_toxicity_without_labels(spark, awkward, corpus):
    labels = spark.createDataFrame([(1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    assert toxicity.train(awkward, labels) is None
    docs = spark.createDataFrame(corpus, "doc_id long, text string, lang string, toxic int")
    model = toxicity.train(docs, docs.select("doc_id", "toxic"))
    got = toxicity.predict(awkward, model).collect()
    assert len(got) == 9 and len({r.score for r in got if r.doc_id in (2, 3)}) == 1
    assert toxicity.predict(awkward.limit(0), None).count() == 0


def test_toxicity_sample_is_not_lowered():
    assert inspect.signature(toxicity.train).parameters["per_class"].default >= 6000


def test_toxicity_equals_a_dense_fit(spark, corpus):
    """Scores of the trained model against n-grams of plain strings and a dense regression solved by Newton's method."""
    docs = [r for r in corpus if not held(r[0])][:250]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, toxic int")
    model = toxicity.train(frame, frame.select("doc_id", "toxic"))

    def grams(text):
        t = " " + " ".join(text.lower().split()) + " "
        return {t[i : i + n] for n in (3, 4, 5) for i in range(len(t) - n + 1)}

    sets, y = [grams(t) for _, t, _, _ in docs], np.array([t for *_, t in docs], float)
    n, m = y.sum(), (1 - y).sum()
    columns, ratios = [], []
    for g in sorted(set().union(*sets)):
        has = np.array([g in s for s in sets], float)
        ratio = np.log((has @ y + 1) / (n + 2)) - np.log((has @ (1 - y) + 1) / (m + 2))
        if has.sum() >= 8 and abs(ratio) >= 1:
            columns.append(has * ratio)
            ratios.append(ratio)
    x = np.column_stack([*columns, np.ones(len(docs))])
    w, ridge = np.zeros(x.shape[1]), np.diag([30.0] * len(columns) + [0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(len(w)), x.T @ (p - y) + ridge @ w)
    want = 1 / (1 + np.exp(-x @ w))
    got = model.scores([t for _, t, _, _ in docs])
    assert len(ratios) > 5 and np.abs(got - want).max() < 0.03 and ((got >= 0.5) == (want >= 0.5)).mean() > 0.99


def test_languages_equal_exact_sets(spark, corpus):
    """Filters against sets of plain strings: the same languages, and shares but for false positives."""
    docs = spark.createDataFrame(corpus, "doc_id long, text string, lang string, toxic int")
    f = language_id.train(docs)

    def grams(text):
        out = []
        for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
            w = f" {word} "
            out += [w[i : i + n] for n in (3, 4, 5) for i in range(len(w) - n + 1) if w[i : i + n].strip()]
        return out

    counts = {k: Counter(g for i, t, lang, _ in corpus if lang == k and not held(i) for g in grams(t)) for k in ("de", "en", "fr")}
    share = {k: {g: n / c.total() for g, n in c.items() if n >= max(2, c.total() * 2e-5)} for k, c in counts.items()}
    most = {g: max(s.get(g, 0) for s in share.values()) for s in share.values() for g in s}
    known = {k: {g for g, x in s.items() if x >= 0.2 * most[g]} for k, s in share.items()}
    assert f.languages == ("de", "en", "fr")
    texts = [t for _, t, _, _ in corpus] + ["thing where", "sch eau", "q"]
    want = np.array([[np.mean([g in known[k] for g in grams(t)]) for k in f.languages] for t in texts])
    got, _ = f.shares(texts)
    assert np.abs(got - want).max() < 0.1 and np.abs(got - want).mean() < 0.01
    clear = np.sort(want, 1)[:, -1] - np.sort(want, 1)[:, -2] > 0.1
    assert clear.sum() > 500 and (got.argmax(1) == want.argmax(1))[clear].all()


def test_ratios():
    rows = [np.array([0, 1]), np.array([0]), np.array([1])]
    r = toxicity.log_count_ratio(rows, np.array([1.0, 1.0, 0.0]), 3, 1.0, 1)
    assert np.isclose(r[0], np.log(3 / 4) - np.log(1 / 3)) and r[2] == 0


def test_importance_weights_against_brute_force(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string, lang string, toxic int")
    ratios = quality.fit(docs, docs.where("lang = 'fr'"), buckets=512)
    raw, good = np.zeros(512), np.zeros(512)
    for _, t, lang, _ in corpus:
        f = np.bincount(quality.features(t, 512), minlength=512)
        raw += f
        good += f * (lang == "fr")
    want = np.log((good + 1) / (good.sum() + 512)) - np.log((raw + 1) / (raw.sum() + 512))
    assert np.allclose(ratios, want)
    got = quality.resample(docs, ratios, share=0.3).toPandas().set_index("doc_id")
    assert np.allclose(got.log_weight, [want[quality.features(corpus[i][1], 512)].sum() for i in got.index])
    n = int(np.ceil(0.3 * len(corpus)))
    assert set(got.index[got.selected]) == set(got.gumbel_key.nlargest(n).index)
    noise = got.gumbel_key - got.log_weight
    assert abs(noise.mean() - 0.5772) < 0.2 and abs(noise.std() - 1.2825) < 0.2


def test_resampling_awkward_rows(awkward):
    got = quality.resample(awkward, np.zeros(64), share=0.5).collect()
    assert len(got) == 9 and sum(r.selected for r in got) >= 5
    assert quality.resample(awkward.limit(0), np.zeros(64)).count() == 0
    assert not quality.fit(awkward, awkward.limit(0), buckets=64).any()


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    from tillage.llm.ngrams import text_ngrams, word_ngrams

    rng = np.random.default_rng(15)
    pieces = ["x y", "zed", "", " ", "  lead", "trail \n", "\n", "a", "ab", "né ñ", "\u00a0q", "one two  three"]
    texts = [str(t) for t in rng.choice(pieces, 200)]
    for make in (text_ngrams, word_ngrams):
        h, own = make(texts, (3, 4, 5))[:2]
        for i, t in enumerate(texts):
            assert sorted(h[own == i]) == sorted(make([t], (3, 4, 5))[0]), (make.__name__, i, t)


def test_toxicity_scores_do_not_depend_on_how_rows_lie(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string, lang string, toxic int")
    labels = docs.select("doc_id", "toxic")
    model = toxicity.train(docs, labels)
    other = toxicity.train(docs.repartition(7, "text"), labels.repartition(3))
    assert model.intercept == other.intercept and (model.weights == other.weights).all()
    together = model.scores([t for _, t, _, _ in corpus])
    assert (together == [model.scores([t])[0] for _, t, _, _ in corpus]).all()


def test_repeated_labelled_rows_count_once(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string, lang string, toxic int")
    labels = docs.select("doc_id", "toxic")
    one, two = toxicity.train(docs, labels), toxicity.train(docs.union(docs.where("toxic = 1")), labels.union(labels))
    assert one.intercept == two.intercept and (one.weights == two.weights).all()


def test_sample_has_the_asked_size_in_spite_of_ties(spark):
    docs = spark.createDataFrame([(i % 3 if i % 2 else None, "same words") for i in range(101)], "doc_id long, text string")
    for share in (0.1, 0.5, 0.77, 1.0):
        got = quality.resample(docs, np.zeros(64), share).collect()
        assert len(got) == 101 and sum(r.selected for r in got) == int(np.ceil(share * 101))
        assert min(r.gumbel_key for r in got if r.selected) >= max((r.gumbel_key for r in got if not r.selected), default=-1e300)
