from __future__ import annotations

import random
import zlib

import numpy as np

from sensorspan.llm import language
from sensorspan.llm.common import table

from .conftest import SF

WORDS = {
    "en": "the of and to in is that it was for on with house water which would there".split(),
    "fr": "le la les des une est que pour dans avec sur été même où maison eau".split(),
    "de": "der die das und ist nicht mit für über auch schön straße haus wasser".split(),
}


def corpus(n=300):
    draw = random.Random(2)
    return [(i, " ".join(draw.choices(WORDS[lang], k=draw.randint(3, 60))), lang, "s") for i, lang in enumerate(draw.choices(list(WORDS), k=n))]


def test_held_out_accuracy_and_folds(documents):
    rows = corpus()
    odd = [(None, "the house and the water", None, None), (900, None, "en", "s"), (901, "12 34 %% !", "en", "s"), (902, "", "fr", "s"), (903, "le la les des " * 30_000, None, "s"), rows[3]]
    got = language.identify_languages(documents([*rows, *odd])).collect()
    assert len(got) == len(rows) + len(odd)
    truth = {i: lang for i, _, lang, _ in rows}
    for r in got:
        i = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["held_out"] == (zlib.crc32(i.encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (r["doc_id"] in (900, 901, 902))
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert {r["lang_pred"] for r in got if r["doc_id"] == 903} == {"fr"}


def test_held_out_rows_teach_nothing(documents):
    rows = [(i, t, lang, s) for i, t, lang, s in corpus(200)]
    changed = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 5 == 0 else lang, "other") for i, t, lang, s in rows]
    key = lambda rows: sorted(map(tuple, rows))
    assert key(language.identify_languages(documents(rows)).collect()) == key(language.identify_languages(documents(changed)).collect())


def test_no_rows_and_no_labels(documents):
    assert language.identify_languages(documents([])).collect() == []
    got = language.identify_languages(documents([(1, "the house", None, None)])).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)]
    kept = language.keep_certain(documents([(1, "the house", None, None), (2, "!", None, None)]), 0.4).collect()
    assert [r["doc_id"] for r in kept] == [1]


def test_the_given_documents(spark):
    docs = table(spark, SF, "documents")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [r for r in language.identify_languages(docs).collect() if r["held_out"]]
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.9 * len(held)


def test_keep_certain_keeps_columns_and_clean_rows(documents):
    rows = corpus(200)
    docs = documents([*rows, (500, "??", "en", "s"), (501, None, "en", "s")])
    kept = language.keep_certain(docs, 0.4)
    assert kept.columns == docs.columns
    assert len(kept.collect()) >= 0.99 * len(rows)
    assert {500, 501}.isdisjoint(r["doc_id"] for r in kept.collect())


def test_limits_come_from_all_rows(documents, monkeypatch):
    """Also from those that a model is not fitted on, and from copies."""
    monkeypatch.setattr(language, "PER_LANGUAGE", 10)
    rows = corpus(301)
    docs = documents([*rows, *rows[:40], (900, "!", "en", "s"), (901, None, "fr", "s"), (902, "maison", None, "s")])
    known = language.familiar(docs)
    by = {}
    for _, text, lang, _ in [*rows, *rows[:40]]:
        by.setdefault(lang, []).append(language.gram_counts(text))
    for lang, own in by.items():
        assert known.rows[lang] == len(own)
        middle = float(np.median([known.surprise(counts, lang, True) for counts in own]))
        assert known.limit[lang] == middle + (known.strange(lang) - middle) * language.STRANGE
    assert known.limit.keys() == by.keys()
    frequency, documents_ = language.document_frequencies(docs.where("lang is not null").select("text"))
    assert documents_ == known.documents()[1] and (frequency == known.documents()[0]).all()


def test_counts_do_not_depend_on_the_cut(monkeypatch):
    text = "Être ou ne pas être, 42 fois; that IS the question " * 50
    whole = language.gram_counts(text)
    monkeypatch.setattr(language, "CHUNK", 64)
    assert (language.gram_counts(text) == whole).all()


def test_weights_are_sparse_and_the_temperature_lowers_the_loss():
    draw = np.random.default_rng(0)
    samples, labels = [], []
    for i in range(200):
        label = i % 2
        index = np.unique(np.append(draw.integers(0, 4000, 30), 5000 + label))
        samples.append((index, np.full(len(index), len(index) ** -0.5)))
        labels.append(label)
    weights = language.train_ftrl(samples, labels, 2)
    assert 0 < (weights != 0).any(axis=1).sum() < 4500
    scores = [v @ weights[i] + weights[-1] for i, v in samples]
    noisy = [1 - x if i % 10 == 0 else x for i, x in enumerate(labels)]
    t = language.calibrated([s * 20 for s in scores], noisy)
    loss = lambda t: -sum(np.log(language.softmax(s * 20 / t)[x]) for s, x in zip(scores, noisy))
    assert loss(t) < loss(1.0)
