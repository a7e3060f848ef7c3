import random
import zlib

import pytest

from errata.llm import toxicity as tx


@pytest.fixture
def tables(spark, documents):
    rnd = random.Random(8)
    plain = [f"word{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(600):
        sentences = [" ".join(rnd.choices(plain, k=8)) for _ in range(rnd.randrange(2, 12))]
        toxic = i % 5 == 0
        if toxic:
            sentences.insert(rnd.randrange(len(sentences)), f"you are a {rnd.choice(['Moron', 'scumling', 'scumhead', 'scumbag', 'scumster'])} now")
        rows.append((i, ". ".join(sentences)))
        labels.append((i, 1, int(toxic), "x"))
    rows += [(900, None), (901, ""), (902, "..."), (None, "moron"), (3, rows[3][1])]
    labels += [(900, 1, 0, "x"), (901, None, None, "x"), (None, 1, 1, "x"), (7, 1, 0, "x")]
    return documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string"), rows


def test_held_out_accuracy(tables):
    docs, labels, rows = tables
    got = tx.report(docs, labels).collect()
    assert len(got) == len(rows)
    truth = {i: i % 5 == 0 for i in range(600)}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 3 == 1) for r in got)
    wrong = sum((r.predicted == 1) != truth[r.doc_id] for r in held)
    assert wrong <= 0.05 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert [r.score for r in got if r.doc_id in (900, 901, 902)] == [0.0] * 3


def test_locates_sentences(tables):
    docs, labels, rows = tables
    model = tx.fit(docs, labels)
    found = {(r.doc_id, r.sentence) for r in tx.offending(docs, model).collect() if r.doc_id is not None}
    text = dict(rows)
    assert len({d for d, _ in found}) > 100
    assert all(any(w in (text[d].split(".")[s]).lower() for w in ("moron", "scum")) for d, s in found)


def test_reject_keeps_clean(tables):
    docs, labels, _ = tables
    kept = tx.reject(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {900, 901, 902} <= ids and all(i in ids for i in range(600) if i % 5)


def test_one_kind_of_label_or_none(spark, documents):
    docs = documents([(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in tx.report(docs, none).collect()] == [0.0, 0.0]
    one = spark.createDataFrame([(i, 1, 1) for i in range(9)], "doc_id long, quality int, toxic int")
    assert [r.score for r in tx.report(docs, one).collect()] == [0.0, 0.0]
    assert tx.report(documents([]), one).count() == 0


def test_noisy_or_against_plain_products(tables):
    """A score is 1 - prod(1 - p) over sentences; the fit's loss is at its least there."""
    import math

    import numpy as np

    docs, labels, rows = tables
    model = tx.fit(docs, labels)
    for _, text in rows[:80]:
        left = 1.0
        for words in tx.sentences_of(text):
            z = [model.weights[f] for f in {f for w in words for f in tx.features_of(w)} if f in model.weights]
            left *= 1 - 1 / (1 + math.exp(-model.bias - sum(z))) if z else 1.0
        assert model.score(text) == pytest.approx(1 - left, abs=1e-9)

    bags = [(1, [[0], [1, 2]], 3), (0, [[1]], 5), (1, [[2]], 2), (0, [[0, 1], [2]], 1), (0, [[3]], 4), (1, [[3], [3]], 1)]
    names = [b"a", b"b", b"c", b"d"]

    def loss(theta):
        total = 0.0
        for toxic, sentences, n in bags:
            left = math.prod(1 - 1 / (1 + math.exp(-theta[-1] - sum(theta[f] for f in s))) for s in sentences)
            total -= n * math.log(1 - left if toxic else left)
        return total / sum(n for _, _, n in bags) + 1e-2 / 2 * sum(t * t for t in theta)

    fitted = tx._descend(names, bags, 4000, 0.02, 1e-2)
    theta = [*(fitted.weights[n] for n in names), fitted.bias]
    step = 1e-5
    slopes = [(loss([t + step * (i == k) for k, t in enumerate(theta)]) - loss([t - step * (i == k) for k, t in enumerate(theta)])) / (2 * step) for i in range(5)]
    assert np.abs(slopes).max() < 1e-3


def test_repeated_ids_and_long_texts(spark, documents):
    """An id that repeats with other texts counts once in the sample; a very long text is scored whole."""
    rows = [(i, "scumbag here" if i % 2 else "all fine") for i in range(40)] + [(1, f"other {k}") for k in range(30)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    assert tx.training_rows(documents(rows), labels, 20).count() == 20
    model = tx.fit(documents(rows), labels)
    long = "all fine. " * 50_000
    got = {r.doc_id: r.errata_score for r in tx.scored(documents([(1, long), (2, long + "scumbag here")]), model).collect()}
    assert got[1] < 0.5 < got[2]
