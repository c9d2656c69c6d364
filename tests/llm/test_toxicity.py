import random
import zlib

import numpy as np
import pytest

from tidemark.llm import toxicity as X

WORDS = [a + b for a in ("ba", "ko", "ri", "tul", "men") for b in ("na", "so", "vi", "der", "pak")]
BAD = ["grumph", "zorkle", "Quibbet"]
DOC, LABEL = "doc_id long, text string, score string, held_out int, _y int, _id int, label string", "doc_id long, quality int, toxic int, text string"


def documents(n=1500):
    r = random.Random(2)
    docs, labels = [], []
    for i in range(n):
        ws = r.choices(WORDS, k=r.randint(5, 60))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(r.randint(1, 3)):
                ws.insert(r.randrange(len(ws)), r.choice(BAD))
        docs.append((i, " ".join(ws)))
        if i % 3:
            labels.append((i, 1, int(toxic), "clash"))
    return docs, labels


def run(spark, docs, labels):
    d = spark.createDataFrame([(*x, "s", 1, 2, 3, "l") for x in docs], DOC)
    return X.toxicity(d, spark.createDataFrame(labels, LABEL)).collect()


@pytest.fixture(scope="module")
def out(spark):
    docs, labels = documents()
    docs += [(5000, None), (5001, ""), (None, "grumph zorkle"), (5002, "ba" * 50_000 + " Zorkle"), (5002, "bana")]
    return run(spark, docs, [*labels, (4, 0, None, ""), (None, 1, 1, ""), (99999, 1, 1, ""), labels[0]])


def test_held_out_accuracy(out):
    held = [r for r in out if r.held_out and r.doc_id < 1500]
    truth = np.array([r.doc_id % 4 == 0 for r in held])
    said = np.array([r.predicted == 1 for r in held])
    assert len(held) > 200 and said[truth].mean() > 0.97 and said[~truth].mean() < 0.01


def test_awkward_rows(out):
    assert len(out) == 1505 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    by: dict = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert by[5000][0].score == by[5001][0].score < 0.5
    assert by[None][0].predicted == 1 and by[None][0].held_out is False
    assert sorted(r.predicted for r in by[5002]) == [0, 1]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)


def test_one_class_and_empty(spark):
    assert run(spark, [], []) == []
    assert [r.score for r in run(spark, [(1, "a"), (2, "b")], [])] == [0.0, 0.0]
    assert {r.score for r in run(spark, [(1, "a"), (2, "b")], [(1, 0, 1, ""), (2, 0, 1, ""), (3, 0, 1, "")])} == {1.0}


def test_held_out_labels_are_not_read(spark):
    docs, labels = documents(400)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t, x) for i, q, t, x in labels]
    a, b = (sorted((r.doc_id, r.score) for r in run(spark, docs, y)) for y in (labels, turned))
    assert a == b


def test_scores_do_not_depend_on_neighbours():
    import pyarrow as pa

    r = np.random.default_rng(1)
    slots = np.unique(r.integers(0, X.SLOTS, 200_000)).astype(np.uint32)
    weights = r.normal(size=len(slots))
    texts = ["abc def", "", "é日本 xyz xyz", None, "a", "long " * 400]

    def scored(some):
        (b,) = X.score(slots, weights, 0.1)(iter([pa.record_batch([pa.array(range(len(some))), pa.array(some, pa.string())], names=["doc_id", "_text"])]))
        return b.column("score").to_pylist()

    assert scored(texts) == pytest.approx([scored([t])[0] for t in texts], abs=1e-12)
    weight = dict(zip(slots.tolist(), weights.tolist(), strict=True))
    plain = [0.1 + sum(weight.get(int(s), 0) for s in X.text_slots(t or "")) for t in texts]
    assert scored(texts) == pytest.approx([1 / (1 + np.exp(-x)) for x in plain], abs=1e-9)


def test_long_documents_are_learned_whole(spark):
    """Toxic words far behind the beginning of long texts are learned, and clean long texts stay clean."""
    r = random.Random(6)
    docs, labels = [], []
    for i in range(160):
        ws = r.choices(WORDS, k=9000)  # over 40 000 characters
        if i % 2:
            ws[8500:8500] = [r.choice(BAD) for _ in range(3)]
        docs.append((i, " ".join(ws)))
        labels.append((i, 1, i % 2, ""))
    out = [x for x in run(spark, docs, labels) if x.held_out]
    assert len(out) > 15 and all(x.predicted == x.doc_id % 2 for x in out)


def test_weights_against_a_plain_fit():
    """Log-count ratios and the gradient at the fitted point, from the definitions."""
    r = np.random.default_rng(2)
    toxic = [int(i % 3 == 0) for i in range(90)]
    present = [np.flatnonzero(r.random(12) < np.where(np.arange(12) < 4, 0.2 + 0.5 * y, 0.4)) for y in toxic]
    counts = np.array([[sum(s in p for p, y in zip(present, toxic, strict=True) if y == c) for s in range(12)] for c in (0, 1)], float)
    size = np.array([60.0, 30.0])
    slots, weights, bias = X.train(present, toxic, 1 / 3, np.arange(12), counts)
    ratio = [np.log((counts[1][s] + 1) / 32 / ((counts[0][s] + 1) / 62)) for s in range(12)]
    w = weights / ratio
    p = [1 / (1 + np.exp(-(bias + sum(weights[s] for s in d)))) for d in present]
    error = [(q - y) * (1 / 3 / 30 if y else 2 / 3 / 60) for q, y in zip(p, toxic, strict=True)]
    slope = [sum(e * ratio[s] for e, d in zip(error, present, strict=True) if s in d) + X.RIDGE * w[s] for s in range(12)]
    assert abs(sum(error)) < 2e-3 and np.abs(slope).max() < 2e-3
    assert set(X.choose(np.tile(counts, 1), size)) == set(range(12))
