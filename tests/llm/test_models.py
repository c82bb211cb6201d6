"""Quality, toxicity and language: odd rows, bounds of the sample, held-out accuracy on small made texts."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordersight.llm import language_id, quality_model, toxicity
from ordersight.llm.tables import id_remainder
from tests.llm.conftest import odd_rows, prose, table


def labelled(seed, n):
    """(doc_id, text, quality, toxic): poor ones shout, toxic ones insult."""
    draw = random.Random(seed)
    rows = []
    for k in range(n):
        text, quality, toxic = prose(1000 * seed + k, 40 + k % 60), 1, 0
        if k % 4 == 0:
            text, quality = " ".join(w.upper() + "!!" for w in text.split()), 0
        if k % 5 == 0:
            words = text.split(" ")
            words[draw.randrange(len(words))] = draw.choice(["blorgish", "blorgum", "zwatty"])
            text, toxic = " ".join(words), 1
        rows.append((k, text, quality, toxic))
    return rows


@pytest.fixture(scope="module")
def corpus(spark):
    rows = labelled(1, 400)
    docs = table(spark, [(i, t) for i, t, *_ in rows]).cache()
    return rows, docs, spark.createDataFrame([(i, q, t) for i, _, q, t in rows], "doc_id long, quality int, toxic int")


def test_quality_held_out(corpus):
    rows, docs, labels = corpus
    model = quality_model.train(docs, quality_model.quality_labels(labels))
    truth = {i: q for i, _, q, _ in rows}
    scored = quality_model.score_quality(docs, model).where(id_remainder(F.col("row.doc_id"), 5) == 0).collect()
    assert len(scored) > 40
    assert np.mean([(r["score"] >= quality_model.GOOD) == truth[r.row.doc_id] for r in scored]) >= 0.97


def test_quality_odd_rows(odd, empty, corpus, spark):
    _, docs, labels = corpus
    model = quality_model.train(docs, quality_model.quality_labels(labels))
    rows = quality_model.score_quality(odd, model).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality_model.score_quality(odd, model).select("row.*").columns == odd.columns
    assert quality_model.score_quality(empty, model).count() == 0
    assert quality_model.score_quality(odd.drop("n_chars"), model).count() == len(odd_rows())
    none = quality_model.train(docs, quality_model.quality_labels(labels.where("false")))
    assert none == 0.5 and {r["score"] for r in quality_model.score_quality(odd, none).collect()} == {0.5}
    one = quality_model.train(docs, quality_model.quality_labels(labels.where("quality = 1")))
    assert one == 1.0


def test_labels_of_held_out_rows_are_not_learned(corpus):
    labels = corpus[2]
    assert quality_model.quality_labels(labels).where(id_remainder(F.col("doc_id"), 5) == 0).count() == 0


def test_pairwise_identity():
    """Scores in linear time equal the sum over all pairs."""
    draw = np.random.default_rng(3)
    data = np.frombuffer(b"some words of some text and more words", np.uint8)
    x = quality_model.features(data, np.array([0, 20, len(data)]), np.array([20, 18]))
    dims = x.statistics.shape[1]
    words = 1 << quality_model.WORD_BITS
    model = quality_model.Machine(0.3, draw.normal(size=words + dims), draw.normal(size=(words + dims, quality_model.FACTORS)), np.zeros(dims), np.ones(dims))
    for row in range(2):
        slots = x.slots[x.bounds[row] : x.bounds[row + 1]]
        at = np.append(slots, np.arange(words, words + dims))
        values = np.append(np.full(len(slots), 1 / np.sqrt(len(slots))), np.clip(x.statistics[row], -8, 8))
        total = 0.3 + values @ model.weights[at]
        for a in range(len(at)):
            for b in range(a):
                total += values[a] * values[b] * (model.factors[at[a]] @ model.factors[at[b]])
        assert np.isclose(model.score(x)[row], 1 / (1 + np.exp(-total)))


def test_toxicity(corpus, odd, empty):
    rows, docs, labels = corpus
    train = rows[:300]
    known = toxicity.category_labels(labels).where(F.col("doc_id") < len(train))
    models = toxicity.train(docs, known, toxicity.CATEGORIES)
    scored = {r.row.doc_id: r for r in toxicity.score_toxicity(docs, models, toxicity.CATEGORIES).collect()}
    held = rows[300:]
    assert np.mean([(scored[i].p_toxic >= 0.5) == t for i, _, _, t in held]) >= 0.95
    assert np.mean([(scored[i].p_flagged >= 0.5) == bool(t or not q) for i, _, q, t in held]) >= 0.95
    found = toxicity.score_toxicity(odd, models, toxicity.CATEGORIES).collect()
    assert len(found) == len(odd_rows()) and all(0 <= r[f"p_{c}"] <= 1 for r in found for c in toxicity.CATEGORIES)
    assert toxicity.score_toxicity(empty, models, toxicity.CATEGORIES).count() == 0
    none = toxicity.train(docs, known.where("false"), toxicity.CATEGORIES)
    assert none is None and toxicity.score_toxicity(odd, none, toxicity.CATEGORIES).count() == len(odd_rows())


def test_later_categories_learn_from_out_of_fold_probabilities(monkeypatch):
    """No training row's earlier probability comes from a model that saw it."""
    seen = []
    fit = toxicity.fit_linear

    def watched(x, earlier, y, seed=3):
        seen.append((len(y), earlier.shape[1]))
        return fit(x, earlier, y, seed)

    monkeypatch.setattr(toxicity, "fit_linear", watched)
    texts = [t.encode() for _, t, *_ in labelled(2, 60)]
    x = toxicity.features(np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts])))
    labels = np.array([[q == 0, t] for *_, q, t in labelled(2, 60)], int)
    toxicity.fit_chain(x, labels, np.arange(60) % 3)
    assert seen == [(60, 0), (40, 0), (40, 0), (40, 0), (60, 1)]


def languages(n):
    draw = random.Random(7)
    letters = {"aa": "abcde", "bb": "vwxyz", "cc": "éèàùç"}
    return [(k, " ".join("".join(draw.choice(letters[lang]) for _ in range(5)) for _ in range(10 + k % 40)), lang) for k in range(n) for lang in [("aa", "bb", "cc")[k % 3]]]


def test_language(spark, odd, empty):
    rows = languages(300)
    docs = table(spark, rows)
    network = language_id.train(docs.where("doc_id < 200").select("doc_id", "text", "lang"))
    truth = {i: lang for i, _, lang in rows}
    found = language_id.identify_language(docs.where("doc_id >= 200"), network).collect()
    assert np.mean([r.lang_pred == truth[r.row.doc_id] for r in found]) >= 0.97
    strange = {r.row.doc_id: r for r in language_id.identify_language(odd.where("doc_id is not null"), network).collect()}
    assert all(strange[i].lang_pred == "und" and strange[i]["score"] == 0 for i in (2, 3, 4))
    assert strange[8].lang_pred in ("aa", "bb", "cc")
    assert language_id.identify_language(empty, network).count() == 0
    assert language_id.train(docs.where("false").select("doc_id", "text", "lang")) is None
    assert {r.lang_pred for r in language_id.identify_language(odd, None).collect()} == {"und"}


def test_windows_cover_every_byte():
    sizes = [0, 5, 128, 129, 300, 1000]
    data = np.arange(sum(sizes)).astype(np.uint8) | 1
    windows, owners = language_id.cut_windows(data, np.append(0, np.cumsum(sizes)))
    assert [int((owners == k).sum()) for k in range(6)] == [1, 1, 1, 2, 3, 8]
    assert windows[owners == 0].sum() == 0 and (windows[owners == 1][0, 5:] == 0).all()
    assert (windows[owners == 3][1] == data[133 + 1 : 133 + 129]).all()


def test_gradients_are_the_slopes_of_the_loss():
    draw = np.random.default_rng(9)
    network = language_id.ByteNetwork(["x", "y"])
    network.start(draw)
    network.weights = {k: v.astype(float) for k, v in network.weights.items()}
    windows, labels = draw.integers(0, 256, (6, 128)).astype(np.uint8), np.array([0, 1, 0, 1, 1, 0])
    loss = lambda: -np.log(network.probabilities(windows)[np.arange(6), labels]).mean()
    slopes = network.gradients(windows, labels)
    for name in ("out", "filter2", "filter4", "shift3"):
        at = np.unravel_index(np.abs(slopes[name]).argmax(), slopes[name].shape)
        kept = network.weights[name][at]
        network.weights[name][at] = kept + 1e-5
        up = loss()
        network.weights[name][at] = kept - 1e-5
        down = loss()
        network.weights[name][at] = kept
        assert np.isclose((up - down) / 2e-5, slopes[name][at], rtol=1e-3, atol=1e-6)


def test_training_rows_are_bounded_when_one_id_has_many_rows(spark, monkeypatch):
    """10,000 rows of one id: at most the stated number of rows is learned from, one of each id."""
    docs = spark.range(10_000).selectExpr("7L doc_id", "concat('text é number ', id) text", "if(id % 2 = 0, 'aa', 'bb') lang", "id n_chars")
    more = spark.range(20).selectExpr("id + 100 doc_id", "concat('other words ', id) text", "if(id % 2 = 0, 'aa', 'bb') lang", "id n_chars")
    docs = docs.unionAll(more)
    labels = docs.select("doc_id").distinct().selectExpr("doc_id", "cast(doc_id % 2 as int) label", "cast(doc_id % 2 as int) a", "cast(doc_id % 3 = 0 as int) b")
    sizes = []
    monkeypatch.setattr(quality_model, "fit", lambda batches, y: sizes.append(len(y)))
    monkeypatch.setattr(toxicity, "fit_chain", lambda x, y, folds: sizes.append(len(y)))
    monkeypatch.setattr(language_id, "fit", lambda windows, y, names: sizes.append(len(y)))
    quality_model.train(docs, labels, rows=10)
    toxicity.train(docs, labels, ("a", "b"), rows=10)
    language_id.train(docs, rows=10)
    assert sizes == [10, 10, 10]
    sizes.clear()
    quality_model.train(docs, labels)
    toxicity.train(docs, labels, ("a", "b"))
    language_id.train(docs)
    assert sizes == [21, 21, 21]


def test_copies_of_a_text_lie_in_one_fold(spark, monkeypatch):
    docs = spark.range(60).selectExpr("id doc_id", "concat('words of text number ', id % 5) text")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) a", "cast(doc_id % 3 = 0 as int) b")
    found = []
    monkeypatch.setattr(toxicity, "fit_chain", lambda x, y, folds: found.append((x, folds)))
    toxicity.train(docs, labels, ("a", "b"))
    x, folds = found[0]
    copies = {}
    for (a, b), fold in zip(zip(x.bounds, x.bounds[1:]), folds):
        copies.setdefault(x.slots[a:b].tobytes(), set()).add(int(fold))
    assert len(folds) == 60 and len(copies) == 5 and all(len(f) == 1 for f in copies.values())
