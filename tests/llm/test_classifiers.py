import random

import numpy as np
import pytest

from runweave.llm import line_quality, toxicity
from runweave.llm.labelled import remainder, training_texts
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, score string, toxic string"
INSULTS = ["blockhead", "nitwit", "numbskull", "dunderhead"]


def corpus(seed=2, n=420):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["ta", "re", "mi", "lo", "sen", "du", "ka"]) for _ in range(rng.randrange(1, 4)))
    docs, labels = [], []
    for k in range(n):
        words = [word() for _ in range(rng.randrange(20, 200))]
        bad = k % 3 == 0
        if bad:
            for _ in range(max(2, len(words) // 40)):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        lines = [" ".join(words[a:a + 12]).capitalize() + "." for a in range(0, len(words), 12)]
        junk = k % 4 == 0
        if junk:
            lines = [" ".join(w + "$$$" for w in line.split()) for line in lines]
        docs.append((k, "\n".join(lines), "s", "t"))
        labels.append((k, int(not junk), int(bad)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    n = len(docs)
    docs += [(None, "text without id", "s", "t"), (9001, None, "s", "t"), (9002, "", "s", "t"), (9003, " \n\t", "s", "t"),
             docs[5], (9006, "\n".join(text for k, text, _, _ in docs[:n] if k % 4) * 12, "s", "t"), (9004, "plain words. " * 60_000, "s", "t"), (9005, "plain words. " * 60_000 + "nitwit " * 3, "s", "t")]
    labels += [(None, 1, 1), (7, None, None), labels[5]]
    return (spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def held_out_accuracy(spark, result, labels, label):
    rows = result.where("held_out").join(labels, "doc_id").select("predicted", label).dropna().collect()
    return np.mean([row.predicted == row[label] for row in rows])


def test_toxicity(spark, tables):
    docs, labels = tables
    result = toxicity.toxicity(docs, labels).cache()
    assert held_out_accuracy(spark, result, labels, "toxic") > 0.95
    rows = {row.doc_id: row for row in result.collect()}
    assert result.count() == docs.count() and all(0 <= row.score <= 1 for row in rows.values())
    assert rows[9001].score == rows[9002].score == rows[9003].score and rows[9001].predicted == 0
    assert rows[9004].predicted == 0 and rows[9005].predicted == 1  # three words at the end of a very long text
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == result.where("predicted = 0").count()


def test_misspellings_share_subwords(spark, tables):
    docs, labels = tables
    model = toxicity.fit(training_texts(docs, labels, "toxic", remainder(F.col("doc_id"), 3) != 1, 800, 12_000))
    clean = "ta remi losen duka tami resen lodu kata " * 4
    seen, unseen = model.scores([clean + "blockhead"])[0], model.scores([clean + "blokhead blockheead"])[0]
    assert seen > 0.7 and unseen > 0.7 > model.scores([clean])[0]


def test_few_labels_and_rare_words_are_learned():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["ta", "re", "mi", "lo", "sen", "du", "ka"]) for _ in range(rng.randrange(1, 4)))
    text = lambda *more: " ".join([word() for _ in range(30)] + list(more))
    few = toxicity.fit([(text("blockhead"), 1) for _ in range(12)] + [(text(), 0) for _ in range(12)])
    assert few.scores([text("blockhead")])[0] > few.scores([text()])[0]
    rude = ["%s%s" % (a, b) for a in ("zog", "vix", "quap", "brof") for b in ("ny", "hup", "wix", "gly", "fev", "pob")]
    sample = [(text(rude[k % 24]), 1) for k in range(240)] + [(text(), 0) for _ in range(240)]  # each word in 4 % of a label
    rare = toxicity.fit(sample)
    toxic, clean = rare.scores([text(w) for w in rude]), rare.scores([text() for _ in range(24)])
    assert toxic.min() > clean.max()


def test_words_themselves_and_every_half_passage_count():
    model = toxicity.Model(np.zeros(toxicity.BUCKETS), -4.0)
    buf, starts, ends = toxicity.spread(b"nitwit")
    model.parts[toxicity.word_buckets(buf, starts, ends)[1]] = 2000.0
    around = ["a"] * 43 + ["nitwit"] * 10 + ["a"] * 43  # across the end of the first 48 words
    alone = ["a"] * 10 + ["nitwit"] * 10 + ["a"] * 28
    assert model.scores([" ".join(around)])[0] == pytest.approx(model.scores([" ".join(alone)])[0])


def test_quality(spark, tables):
    docs, labels = tables
    result = line_quality.quality(docs, labels).cache()
    assert held_out_accuracy(spark, result, labels, "quality") > 0.95
    rows = {row.doc_id: row for row in result.collect()}
    assert rows[9001].score == rows[9002].score == rows[9003].score == 0 and rows[9006].predicted == 1


def test_marginals_against_enumeration():
    rng = np.random.default_rng(4)
    unary, pair = rng.normal(size=5), rng.normal(size=(2, 2))
    chains = line_quality.Chains(np.array([0, 0, 0, 0, 2]), 3)  # texts of four, no and one lines
    forward, backward = chains.messages(unary, pair)
    got = 1 / (1 + np.exp(-(unary + forward + backward)))
    total, good = 0.0, np.zeros(4)
    for code in range(16):
        y = [code >> k & 1 for k in range(4)]
        weight = np.exp(sum(unary[k] * y[k] for k in range(4)) + sum(pair[y[k], y[k + 1]] for k in range(3)))
        total, good = total + weight, good + weight * np.array(y)
    assert np.allclose(got[:4], good / total) and np.isclose(got[4], 1 / (1 + np.exp(-unary[4])))


def test_without_labels_or_rows(spark, tables):
    docs, labels = tables
    none = labels.where("doc_id < 0")
    assert toxicity.toxicity(docs, none).where("predicted = 1").count() == 0
    assert line_quality.quality(docs.where("doc_id = 1"), none).first().score == pytest.approx(0.5)
    assert toxicity.toxicity(docs.limit(0), labels).collect() == [] == line_quality.quality(docs.limit(0), labels).collect()


def test_columns_named_like_the_score_stay(spark):
    docs = spark.createDataFrame([(1, "some text", 0.5, 7), (2, None, 0.1, 8)], "doc_id long, text string, score double, _score int")
    labels = spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int")
    out = toxicity.without_toxic(docs, labels)
    assert out.columns == docs.columns and sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)
