import random
import re
from itertools import permutations

import cases

from tidemark.llm import interactions as I

DOC = "doc_id long, text string, source string, part string, mask int, n long, quality int, toxic int, step int"
LABEL = "doc_id long, quality int, toxic int, text string, source string"


def fails(text):
    ws = cases.WORDS.findall(text)
    return [len(ws) < 200, 100 * len(set(ws)) < 50 * len(ws), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), any(c in text for c in "#$%&*|")]


def brute(docs, labels):
    """Runs every order filter by filter."""
    rows = [(cases.key_of(i), t or "", s or "") for i, t, s in docs]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    marked = [(i, p, {*[x for x, f in zip("ABCD", fails(t), strict=True) if f], *(["E"] if any(j < i and u == t for j, u, _ in rows) else [])}) for i, t, p in rows]
    out = []
    for part in {p for _, p, _ in marked}:
        here = [(i, f) for i, p, f in marked if p == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        some = []
        for order in permutations("ABCDE"):
            left, gone = here, []
            for step, x in enumerate(order, 1):
                now = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                some.append((part, "".join(order), step, len(left), len(now), sum(x in f for _, f in gone), sum(f == {x} for _, f in here), sum(i in good for i, _ in now), sum(i in toxic for i, _ in now), x))
                gone += now
                removed_by[x] += len(now)
        out += [(*r[:-1], removed_by[r[-1]]) for r in some]
    return out


def run(spark, docs, labels):
    d = spark.createDataFrame([(i, t, s, "clash", 1, 2, 0, 0, 9) for i, t, s in docs], DOC)
    out = I.audit(d, spark.createDataFrame([(*x, "t", "s") for x in labels], LABEL))
    return sorted((tuple(r) for r in out.collect()), key=repr)


def documents(n=150):
    r = random.Random(3)
    words = [f"w{i}" for i in range(300)] + ["Ab", "CD", "#1", "a|b"]
    texts = [" ".join(r.choices(words[: r.choice([3, 120, 300, 304])], k=r.choice([0, 1, 199, 200, 260, 400]))) for _ in range(60)] + [None, "", "\t\n", "é" * 49 + "A", "é" * 50 + "A", "long " * 50_000]
    docs = [(i, r.choice(texts), r.choice(["x", "y", "y", "y", "", None])) for i in range(n)]
    docs += [docs[3], docs[3], (None, docs[5][1], "y"), (None, docs[5][1], "y"), (None, "only here", "x"), (7, docs[9][1], "z"), (9, docs[9][1], "z")]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 0, 1, None])) for i in range(0, n, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (99999, 1, 1)]
    return docs, labels


def test_every_order_run_by_hand(spark):
    docs, labels = documents()
    assert run(spark, docs, labels) == sorted(brute(docs, labels), key=repr)


def test_empty_and_unlabelled(spark):
    assert run(spark, [], []) == []
    docs = [(1, "a", None), (2, "a", ""), (3, "#", None)]
    assert run(spark, docs, []) == sorted(brute(docs, []), key=repr)


def test_intervals_cover_each_order_once():
    for mask in range(1, 32):
        mine = [x for x in I.intervals() if x[0] == mask]
        for rank, order in enumerate(I.ORDERS):
            hits = [(step, letter) for _, step, letter, a, b in mine if a <= rank < b]
            want = next((k, x) for k, x in enumerate(order, 1) if mask >> "ABCDE".index(x) & 1)
            assert hits == [want]
