import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid as G
from tidemark.llm import words as W

SYLLABLES = {"aa": ["ba", "ko", "ri", "na"], "bb": ["sch", "ung", "eit", "ver"], "cc": ["ção", "ão", "lhe", "nho"]}
ROW = "doc_id long, text string, lang string, score string, lang_pred int, letter int, _text int"


def text(lang, r, n=30):
    return " ".join("".join(r.choices(SYLLABLES[lang], k=r.randint(1, 4))) for _ in range(n))


def documents(n=600):
    r = random.Random(1)
    langs = list(SYLLABLES)
    return [(i, text(langs[i % 3], r, r.randint(3, 40)), langs[i % 3]) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], ROW)


@pytest.fixture(scope="module")
def out(spark):
    rows = documents() + [(2000, None, "aa"), (2001, "12 34 !!", "aa"), (2002, "", None), (None, "bakorina ko", None), (2003, "ver" * 20_000, None), (2003, "schung eit", None)]
    return G.languages(frame(spark, rows)).collect()


def test_held_out_accuracy(out):
    truth = {i: lang for i, _, lang in documents()}
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert 100 < len(held) < 200
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in out)


def test_folds_follow_the_checksum(out):
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out if r.doc_id is not None)


def test_awkward_rows(out):
    by: dict = {}
    for r in out:
        by.setdefault(r.doc_id, []).append((r.lang_pred, r.score, r.held_out))
    for i in (2000, 2001, 2002):
        assert by[i][0][:2] == ("und", 0.0)
    assert by[None][0][0] == "aa" and by[None][0][2] is False
    assert sorted(x[0] for x in by[2003]) == ["bb", "bb"]


def test_nothing_to_learn_from(spark):
    assert G.languages(frame(spark, [])).collect() == []
    got = G.languages(frame(spark, [(1, "abc", None)])).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]


def test_labels_of_the_held_out_fold_are_not_read(spark):
    rows = documents(200)
    import zlib

    swapped = [(i, t, "cc" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    a, b = (sorted((r.doc_id, r.lang_pred, r.score) for r in G.languages(frame(spark, x)).collect()) for x in (rows, swapped))
    assert a == b


def test_backpropagation_through_time():
    r = np.random.default_rng(1)
    net = G.Network(3)
    for k in net.p:
        net.p[k] = net.p[k].astype(float)
    x, y, w = r.integers(97, 103, (4, 5)).astype(np.uint8), np.array([0, 1, 2, 1]), np.full(4, 0.25)

    def loss():
        p = net.labels(x)
        return float((-np.log(p[np.arange(4), :, y]).mean(1) * w).sum())

    for k, g in net.gradients(x, y, w).items():
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        net.p[k][i] += 1e-5
        up = loss()
        net.p[k][i] -= 2e-5
        assert g[i] == pytest.approx((up - loss()) / 2e-5, rel=1e-4)
        net.p[k][i] += 1e-5


def test_every_byte_is_labelled_and_the_cache_changes_nothing(monkeypatch):
    net = G.Network(2)
    texts = ["one two two three", "", "x" * 100 + " two", None]
    w = G.segments(W.split(pa.array(texts)))
    assert (w.end - w.start).sum() == sum(len(t.replace(" ", "")) for t in texts if t)
    plain = np.array([net.labels(G.matrix(w, np.array([i]), int(w.end[i] - w.start[i])))[0, 1:-1].sum(0) for i in range(len(w.start))])
    for size in (1000, 1):
        monkeypatch.setattr(G, "CACHE_WORDS", size)
        labels = G.WordLabels(net, 2)
        for _ in range(2):
            assert np.allclose(labels.of(w), plain, atol=1e-4)


def test_sample_counts_the_words_of_whole_texts(spark):
    rows = frame(spark, documents(3000)).withColumn("text", F.concat(F.repeat("text", 100), F.lit(" atthevery end")))
    few = G.sample(rows, "doc_id", "text", "lang", 20, 50)[1]
    assert set(few) == set(SYLLABLES) and max(few.count(x) for x in set(few)) == 50
    words, langs, counts = G.sample(rows, "doc_id", "text", "lang", 20, 5000)
    seen = {(x, w): n for w, x, n in zip(words, langs, counts, strict=True)}
    n_docs = [seen[x, "end"] for x in set(langs)]  # once a document, at its very end
    assert all(10 <= n <= 60 for n in n_docs) and max(counts) >= 100
