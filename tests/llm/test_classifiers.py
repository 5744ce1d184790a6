from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import quality, toxicity
from ledgerlark.llm.labelled import fold_of, sample
from ledgerlark.sources.tables import load
from tests.llm.conftest import sentence

MODULES = [(quality.score_quality, "quality", 5, 0, 0.3), (toxicity.score_toxicity, "toxic", 3, 1, 0.7)]
LABELS = "doc_id bigint, quality int, toxic int, text string"


def labels_of(spark, rows):
    return spark.createDataFrame([(i, x, x, "clash") for i, x in rows], LABELS)


def test_folds_are_crc32_of_the_text(spark):
    ids = [0, 1, -5, 123456789012, None]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id bigint")
    got = {r.doc_id: r.f for r in df.select("doc_id", fold_of("doc_id", 5).alias("f")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 if i is not None else 0 for i in ids}


def test_sample_is_bounded_and_leaves_out(make, spark):
    docs = make([f"text {i}" for i in range(40)])
    labels = labels_of(spark, [(i, i % 2) for i in range(60)] + [(3, 0), (None, 1), (5, None)])
    rows = sample(docs, labels, "toxic", F.col("doc_id") % 4 != 0, per_label=6).collect()
    # Of the labels chosen some have no document here.
    assert 3 <= sum(r.label for r in rows) <= 6 and len(rows) <= 12
    assert all(r.doc_id % 4 and r.doc_id < 40 and r.text == f"text {r.doc_id}" for r in rows)
    assert all(r.label == 0 for r in rows if r.doc_id == 3)


@pytest.mark.parametrize("score, label, folds, held, threshold", MODULES)
def test_learns_and_scores_rows_alike(make, spark, score, label, folds, held, threshold):
    rng = random.Random(1)
    texts = []
    for i in range(240):
        words = sentence(rng, rng.randrange(20, 300)).split()
        if i % 2:
            for _ in range(6):
                words[rng.randrange(len(words))] = rng.choice(["scum!!", "IDIOT!!", "fool!!"])
        texts.append(" ".join(words))
    texts += [texts[1], texts[1], texts[0], ""]
    labels = labels_of(spark, [(i, i % 2) for i in range(240)])
    rows = {r.doc_id: r for r in score(make(texts), labels).collect()}
    assert len(rows) == len(texts)
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % folds == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
    for i, j in ((240, 1), (241, 1), (242, 0)):
        assert abs(rows[i].score - rows[j].score) < 1e-6
    unseen = [r for i, r in rows.items() if r.held_out and i < 240]
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 2) for r in unseen]) > 0.9


@pytest.mark.parametrize("score, label, folds, held, threshold", MODULES)
def test_odd_documents_and_few_labels(odd, nothing, spark, score, label, folds, held, threshold):
    none = spark.createDataFrame([], LABELS)
    assert score(nothing, none).collect() == []
    rows = score(odd, none).collect()
    assert len(rows) == odd.count() and np.ptp([r.score for r in rows]) < 1e-6
    one = score(odd, labels_of(spark, [(i, 1) for i in range(10)])).collect()
    assert all(r.score > 0.5 for r in one)
    two = score(odd, labels_of(spark, [(i, i % 2) for i in range(10)])).collect()
    assert all(0 <= r.score <= 1 for r in two)


@pytest.mark.parametrize("score, label, folds, held, threshold", MODULES)
def test_held_out_accuracy(spark, score, label, folds, held, threshold):
    base = "/root/testdata/sf0.01"
    labels = load(spark, base, "labels")
    rows = score(load(spark, base, "documents"), labels).where("held_out").join(
        labels.select("doc_id", F.col(label).alias("truth")), "doc_id").collect()
    assert len(rows) > 50
    accuracy = np.mean([r.predicted == r.truth for r in rows])
    assert accuracy > max(np.mean([r.truth for r in rows]), 1 - np.mean([r.truth for r in rows]))


def test_keep_clean(odd, spark):
    labels = labels_of(spark, [(i, i % 2) for i in range(10)])
    kept = toxicity.keep_clean(odd, labels, threshold=2.0)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert toxicity.keep_clean(odd, labels, threshold=-1.0).count() == 0


def test_every_byte_and_word_is_seen():
    net = quality.ByteNet()
    net.tables[:] = -1
    net.tables[0, ord("#")] = 50
    net.out[:] = 1
    plain = "a" * 3000
    low = net.scores([plain])[0]
    for at in (0, 255, 256, 1000, 2999):
        # A filter starts at every second byte.
        shown = [net.scores([plain[:i] + "#" + plain[i + 1 :]])[0] for i in (at, at ^ 1)]
        assert max(shown) > low
    words = toxicity.Words(["w " * 1000, "", "a b"])
    seen = set(words.windows[words.windows >= 0].tolist())
    assert seen == set(range(1002)) and words.n_windows.tolist() == [28, 1, 1]


def numeric(loss, table, at, step=1e-3):
    old = table[at]
    table[at] = old + step
    up = loss()
    table[at] = old - step
    down = loss()
    table[at] = old
    return (up - down) / (2 * step)


def test_recurrent_gradients():
    net = toxicity.BiGru()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    texts, y = ["one two three four", "bad word here " * 30, ""], np.array([0.0, 1.0, 0.0])
    grad = net.gradients(toxicity.Words(texts), y)

    def loss():
        logits = net.text_logits(texts).astype(float)
        return np.mean(np.log1p(np.exp(logits)) - y * logits)

    for name, table in net.p.items():
        places = np.argwhere(np.abs(grad[name]) > 1e-3)
        for at in map(tuple, places[:: max(1, len(places) // 3)][:3]):
            assert abs(numeric(loss, table, at) - grad[name][at]) < 2e-3 * abs(grad[name][at]) + 2e-5, name


def test_convolution_gradients():
    net = quality.ByteNet()
    state = {"tables": net.tables, "bias": net.bias, "out": net.out, "shift": net.shift}
    for name in state:
        setattr(net, name, state[name].astype(np.float64))
    texts, y = ["some text " * 30, "OTHER!! " * 50], np.array([0.0, 1.0])
    grads = dict(zip(state, net.gradients(texts, y)))

    def loss():
        p = net.scores(texts)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name, grad in grads.items():
        places = np.argwhere(np.abs(grad) > 1e-3)
        for at in map(tuple, places[:: max(1, len(places) // 4)][:4]):
            assert abs(numeric(loss, getattr(net, name), at, 1e-5) - grad[at]) < 1e-2 * abs(grad[at]) + 1e-5


def test_quality_holds_no_responses_of_a_whole_batch():
    net, texts, y = quality.ByteNet(), ["ab cd " * 500_000, "efg " * 9], np.array([0.0, 1.0], np.float32)
    tracemalloc.start()
    grads = net.gradients(texts, y)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10 * len(texts[0])  # the responses alone are 32 times the text
    assert all(np.isfinite(grad).all() for grad in grads)


def test_quality_trains_on_whole_texts(monkeypatch):
    seen, gradients = [], quality.ByteNet.gradients

    def spy(net, texts, y):
        seen.append(sorted(map(len, texts)))
        return gradients(net, texts, y)

    monkeypatch.setattr(quality.ByteNet, "gradients", spy)
    quality.fit(["a" * 20_000, "b" * 9], [1, 0], epochs=2, least_steps=2)
    assert seen == [[9, 20_000]] * 2
