import random

import numpy as np
import pyarrow as pa

from quire.llm import langid, toxicity
from quire.llm.textcore import byte_table


def test_isotonic_is_the_nearest_increasing_function():
    x, y = np.array([1.0, 2, 3, 4, 5, 6]), np.array([0.0, 1, 0, 1, 1, 1])
    xs, ys = toxicity.isotonic(x, y)
    assert (np.diff(ys) >= 0).all() and ((0 < ys) & (ys < 1)).all()
    assert np.interp(1, xs, ys) < np.interp(2.5, xs, ys) < np.interp(5, xs, ys)
    assert len(np.unique(ys)) == 3  # 0 | 1, 0 pooled | 1 1 1


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.4)).astype(int)
    p = toxicity.Trees().fit(x[:1500], y[:1500]).value(x[1500:]) > 0
    assert (p == y[1500:]).mean() > 0.95


def corpus(n, seed):
    rnd = random.Random(seed)
    make = lambda syllables: "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4)))
    rows = []
    for i in range(n):
        lang = rnd.choice(["en", "de", "fr", "es"])
        syllables = {"en": ["th", "ing", "wh", "er", "ou"], "de": ["sch", "ung", "ß", "ein", "er"], "fr": ["eau", "ç", "oi", "ré", "ou"], "es": ["ción", "ñ", "os", "ll", "er"]}[lang]
        words = [make(syllables) for _ in range(rnd.randint(5, 60))]
        toxic = int(rnd.random() < 0.2)
        if toxic:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(["gromf", "gromfish"]) + make(["a", "o"]))
        rows.append((i, " ".join(words), lang, toxic))
    return rows


def test_toxicity(spark, docs):
    rows = corpus(900, 2)
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    model = toxicity.train(spark, d, d.where("doc_id % 5 <> 0").select("doc_id", "toxic"))
    scored = {r.doc_id: r.score for r in toxicity.score(d, model).collect()}
    held = [r for r in rows if r[0] % 5 == 0]
    assert np.mean([(scored[i] >= 0.5) == t for i, _, _, t in held]) > 0.97
    odd = toxicity.score(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    kept = toxicity.clean(d, model)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {i for i, s in scored.items() if s < 0.5}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_toxicity_without_labels(spark, docs):
    none = toxicity.train(spark, docs, spark.createDataFrame([(1, None)], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    one = toxicity.train(spark, docs, spark.createDataFrame([(5, 1), (6, 1)], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.score(docs, one).collect()} == {1.0}


def test_feature_values():
    hidden = toxicity.Features(np.zeros(0, np.uint64), np.zeros(0)).of(pa.array(["You are an IDIOT!!", "id1ot y0u", "calm words only", None]))
    names = toxicity.FEATURES
    at = lambda row, name: hidden[row, names.index(name)]
    assert at(0, "insults") == 0.25 and at(0, "near_second") == 0.25 and at(0, "stress") > 0 and at(0, "shouted") == 0.25
    assert at(1, "hidden_hits") == 0.5 and at(1, "obfuscated") > 0
    assert at(2, "insults") == 0 and not hidden[3].any()


def test_languages(spark, docs):
    rows = corpus(900, 3)
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    model = langid.train(spark, d.where("doc_id % 4 <> 2"))
    assert model.families == ["germanic", "romance"] and set(model.inside["romance"][1]) == {("es", "fr")}
    got = {r.doc_id: r for r in langid.predict(d, model).collect()}
    held = [r for r in rows if r[0] % 4 == 2]
    assert np.mean([got[i].lang_pred == lang for i, _, lang, _ in held]) > 0.97
    odd = langid.predict(docs, model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in odd[:4]] == ["und"] * 4 and all(0 <= r.score <= 1 for r in odd)
    assert odd[7].lang_pred != "und"
    assert {r.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}
    assert langid.train(spark, d.where("lang = 'xx'")) is None


def test_byte_tables_fold_case():
    t = byte_table(b" ")
    assert t[ord("A")] == t[ord("a")] and t[32] == 0 and t[0xC3] != t[0xE3]
