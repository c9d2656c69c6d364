"""Language ID: a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read the bytes of a word, one in each direction; both states together label every byte
with a distribution over the languages.  A document's probabilities are the mean over all its labelled bytes.  The
network is trained in numpy by backpropagation through time on a bounded sample of rows (about ``per_lang`` documents
a language, whole texts, which Spark reduces to counts of words, the ``SAMPLE_WORDS`` commonest of each language);
prediction reads whole texts.  A word's labels depend on the word alone, so a worker labels each distinct word once
and remembers up to ``CACHE_WORDS`` of them: the recurrence is over words, not over the running text.

Defined cases: a null text or one without a letter is ``und`` with score 0, and so is everything if no row has a
language; words over ``SEGMENT`` bytes are read in segments; rows with a null id are in no fold; every row is
returned; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.common import KEY, fp_of, key_of, on_workers

HIDDEN, SEGMENT = 16, 24
STEPS, BATCH, RATE = 400, 384, 0.02
CACHE_WORDS = 500_000
PER_LANG, SAMPLE_WORDS = 400, 15_000
EDGE = 32  #: the blank read before and after a word


class Network:
    """Weights by name: input tables ``x``, recurrent ``u``, output ``v`` for both directions, output bias ``c``."""

    def __init__(self, n_langs: int, seed: int = 3):
        r = np.random.default_rng(seed)
        self.p = {"c": np.zeros(n_langs, np.float32)}
        for d in "fb":
            self.p["x" + d] = r.normal(0, 0.3, (256, 3 * HIDDEN)).astype(np.float32)
            self.p["u" + d] = r.normal(0, HIDDEN**-0.5, (HIDDEN, 3 * HIDDEN)).astype(np.float32)
            self.p["v" + d] = r.normal(0, HIDDEN**-0.5, (HIDDEN, n_langs)).astype(np.float32)

    def states(self, d: str, x: np.ndarray, keep: bool = False) -> tuple[list, list]:
        """The state after each byte of the words ``x`` (rows of one length), and what backpropagation needs."""
        table, u = self.p["x" + d], self.p["u" + d]
        h, out, tape = np.zeros((len(x), HIDDEN), np.float32), [], []
        for t in range(x.shape[1]) if d == "f" else range(x.shape[1] - 1, -1, -1):
            a, b = table[x[:, t]], h @ u
            gate = 1 / (1 + np.exp(-(a[:, : 2 * HIDDEN] + b[:, : 2 * HIDDEN])))
            z, r = gate[:, :HIDDEN], gate[:, HIDDEN:]
            new = np.tanh(a[:, 2 * HIDDEN :] + r * b[:, 2 * HIDDEN :])
            if keep:
                tape.append((t, h, z, r, new, b[:, 2 * HIDDEN :]))
            h = new + z * (h - new)
            out.append(h)
        return (out if d == "f" else out[::-1]), tape

    def labels(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (word, byte, language)."""
        f, b = self.states("f", x)[0], self.states("b", x)[0]
        y = np.stack([f[t] @ self.p["vf"] + b[t] @ self.p["vb"] for t in range(x.shape[1])], 1) + self.p["c"]
        y = np.exp(y - y.max(2, keepdims=True))
        return y / y.sum(2, keepdims=True)

    def gradients(self, x: np.ndarray, lang: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted cross-entropy of every byte's label, by backpropagation through time."""
        tapes = {d: self.states(d, x, keep=True) for d in "fb"}
        f, b = tapes["f"][0], tapes["b"][0]
        y = np.stack([f[t] @ self.p["vf"] + b[t] @ self.p["vb"] for t in range(x.shape[1])], 1) + self.p["c"]
        y = np.exp(y - y.max(2, keepdims=True))
        y /= y.sum(2, keepdims=True)
        y[np.arange(len(x)), :, lang] -= 1
        y *= (weight / x.shape[1])[:, None, None]
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["c"] = y.sum((0, 1))
        for d in "fb":
            u, v = self.p["u" + d], self.p["v" + d]
            back = np.zeros((len(x), HIDDEN), np.float32)
            for t, h, z, r, new, un in reversed(tapes[d][1]):
                state = new + z * (h - new)
                g["v" + d] += state.T @ y[:, t]
                back = back + y[:, t] @ v.T
                d_new = back * (1 - z) * (1 - new * new)
                d_z = back * (h - new) * z * (1 - z)
                d_r = d_new * un * r * (1 - r)
                d_b = np.concatenate([d_z, d_r, d_new * r], 1)
                np.add.at(g["x" + d], x[:, t], np.concatenate([d_z, d_r, d_new], 1))
                g["u" + d] += h.T @ d_b
                back = back * z + d_b @ u.T
        return g


def segments(w: W.Words) -> W.Words:
    """Words cut after every SEGMENT bytes."""
    n = -(-(w.end - w.start) // SEGMENT)
    if not len(n) or n.max() == 1:
        return w
    top = np.concatenate([[0], np.cumsum(n)])
    nth = np.arange(top[-1]) - np.repeat(top[:-1], n)
    start = np.repeat(w.start, n) + nth * SEGMENT
    return W.Words(w.data, start, np.minimum(start + SEGMENT, np.repeat(w.end, n)), np.repeat(w.doc, n), top[w.first])


def matrix(w: W.Words, which: np.ndarray, length: int) -> np.ndarray:
    """The bytes of words of one length, with a blank on both sides."""
    x = np.full((len(which), length + 2), EDGE, np.uint8)
    x[:, 1:-1] = w.data[w.start[which][:, None] + np.arange(length)]
    return x


def train(words: list[str], langs: list[str], counts: list[int]) -> tuple[Network, list[str]]:
    """A network and its languages, from words with their language and count; the same for the same rows in the same
    order.  Every language is drawn equally often."""
    names = sorted(set(langs))
    net = Network(len(names))
    w = segments(W.split(pa.array(words, pa.large_string())))
    lang = np.array([names.index(x) for x in langs], int)[w.doc]
    if not len(lang):
        return net, names
    n_seen = np.array(counts, float)[w.doc]
    chance = n_seen / np.bincount(lang, n_seen, minlength=len(names))[lang]
    chance /= chance.sum()
    by_length = [np.flatnonzero(w.end - w.start == n) for n in range(1, SEGMENT + 1)]
    share = np.array([chance[i].sum() for i in by_length])
    r, m, v = np.random.default_rng(33), {}, {}
    for step in range(1, STEPS + 1):
        n = r.choice(SEGMENT, p=share / share.sum())
        i = r.choice(by_length[n], BATCH, p=chance[by_length[n]] / share[n])
        g = net.gradients(matrix(w, i, n + 1), lang[i], np.full(BATCH, 1 / BATCH, np.float32))
        rate = RATE * min(1, 2 * (1 - step / (STEPS + 1)))
        for k, x in g.items():  # Adam
            m[k] = 0.9 * m.get(k, 0) + 0.1 * x
            v[k] = 0.99 * v.get(k, 0) + 0.01 * x * x
            net.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net, names


class WordLabels:
    """Sums of the byte labels of words, remembered by word hash."""

    def __init__(self, net: Network, n_langs: int):
        self.net, self.n = net, n_langs
        self.forget()

    def forget(self) -> None:
        self.known, self.sums = np.zeros(0, np.uint64), np.zeros((0, self.n), np.float32)

    def of(self, w: W.Words) -> np.ndarray:
        h, at, inverse = np.unique(W.word_hashes(w), return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, h)
        found = np.zeros(len(h), bool)
        inside = place < len(self.known)
        found[inside] = self.known[place[inside]] == h[inside]
        sums = np.zeros((len(h), self.n), np.float32)
        sums[found] = self.sums[place[found]]
        new = np.flatnonzero(~found)
        size = (w.end - w.start)[at[new]]
        for n in np.unique(size):
            same = new[size == n]
            for i in range(0, len(same), 4096):
                part = same[i : i + 4096]
                sums[part] = self.net.labels(matrix(w, at[part], int(n)))[:, 1:-1].sum(1)
        if len(self.known) + len(new) > CACHE_WORDS:
            self.forget()
        known = np.concatenate([self.known, h[new]])
        order = np.argsort(known, kind="stable")
        self.known, self.sums = known[order], np.concatenate([self.sums, sums[new]])[order]
        return sums[inverse]


_labels: dict = {}


def predict(net: Network, names: list[str], stamp: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        W.remember("langid", _labels.clear)
        if stamp not in _labels:
            _labels.clear()
            _labels[stamp] = WordLabels(net, len(names))
        for b in (c for big in batches for c in W.chunks(big)):
            w = segments(W.split(b.column("_text")))
            total = np.zeros((b.num_rows + 1, len(names)))
            if len(w.start):
                np.cumsum(np.concatenate([np.zeros((1, len(names))), _labels[stamp].of(w)], dtype=float), axis=0, out=(running := np.empty((len(w.start) + 1, len(names)))))
                total = running[w.first]
            size = np.concatenate([[0], np.cumsum(w.end - w.start)])[w.first]
            mean = np.diff(total, axis=0) / np.diff(size).clip(1)[:, None] if len(w.start) else total[1:]
            best = mean.argmax(1)
            yield pa.RecordBatch.from_arrays([b.column("_row_id"), pa.array([names[i] for i in best], pa.string()), pa.array(mean[np.arange(len(best)), best].clip(0, 1)), b.column("_letter"), *b.columns[3:]], names=["doc_id", "lang_pred", "score", "letter", *b.schema.names[3:]])

    return run


def fold(id_col: str, modulus: int):
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % modulus


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_lang: int, sample_words: int) -> tuple[list[str], list[str], list[int]]:
    """Words, their languages and counts, of the whole texts of about ``1.5 * per_lang`` documents a language, chosen
    by a hash of the id; a language without words has one empty word."""
    lang, text = F.col(f"`{lang_col}`").cast("string"), F.col(f"`{text_col}`").cast("string")
    have = docs.where(lang.isNotNull() & text.isNotNull() & (fold(id_col, 4) != 2))
    counts = {r[0]: r[1] for r in have.groupBy(lang.alias("l")).count().collect()}  # one row a language
    if not counts:
        return [], [], []
    chance = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 1.5 * per_lang / n))])
    order = F.xxhash64(F.lit(3), F.col(f"`{id_col}`"))
    chosen = have.where(F.pmod(order, F.lit(1_000_003)) / 1_000_003 < chance[lang])
    words = chosen.select(lang.alias("l"), F.explode(F.split(text, r"[\x20\x09-\x0D]+")).alias("w")).where("w <> ''").groupBy("l", "w").count()
    best = Window.partitionBy("l").orderBy(F.desc("count"), "w")
    rows = words.withColumn("k", F.row_number().over(best)).where(F.col("k") <= sample_words).orderBy("l", "k").toArrow()
    cells = [rows.column(c).to_pylist() for c in ("w", "l", "count")]
    without = sorted(set(counts) - set(cells[1]))
    return cells[0] + [""] * len(without), cells[1] + without, cells[2] + [1] * len(without)


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = PER_LANG, sample_words: int = SAMPLE_WORDS, carry: bool = False) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row.

    Only rows with a language whose crc32(id as text) mod 4 is not 2 are learned from; ``held_out`` marks that
    remainder.  With ``carry`` the row's ``KEY`` and ``n_langs``, the number of learned languages, come along.
    """
    on_workers(docs.sparkSession)
    learned, langs, counts = sample(docs, id_col, text_col, lang_col, per_lang, sample_words)
    text, key = F.col(f"`{text_col}`").cast("string"), KEY * carry
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_row_id"), text.alias("_text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("_letter"), *[x.alias(k) for x, k in zip((key_of(id_col), fp_of(text)), key)])
    if learned:
        net, names = train(learned, langs, counts)
        stamp = hash(tuple(float(x.sum()) for x in net.p.values()))
        out = rows.mapInArrow(predict(net, names, stamp), ", ".join(["doc_id long, lang_pred string, score double, letter boolean", *[f"{k} long" for k in key]]))
    else:
        out = rows.select(F.col("_row_id").alias("doc_id"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("letter"), *key)
    return out.select(
        "doc_id",
        F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        F.when(F.col("letter"), F.col("lang_pred")).otherwise("und").alias("lang_pred"),
        F.when(F.col("letter"), F.col("score")).otherwise(0.0).alias("score"),
        *key,
        *[F.lit(len(set(langs))).alias("n_langs")] * carry,
    )
