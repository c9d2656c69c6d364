import hashlib
import itertools
import random
import re

import cases
import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import pii as P

DOC = "doc_id long, text string, found string, kind int, base boolean, start long, label int, context string, count long"
PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def by_patterns(text):
    """The patterns as they are written, tried at every place."""
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            total = sum(int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits)))
            if (True, all(int(x) <= 255 for x in m.group().split(".")) if kind == 1 else 0, 16 <= len(digits) <= 19 and total % 10 == 0, 8 <= len(digits) <= 15)[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def card(r):
    head = "".join(r.choices("0123456789", k=15))
    return next(head + d for d in "0123456789" if P.luhn(head + d))


def documents(n=600):
    r = random.Random(4)
    words = ["alpha", "été", "日本", "v1", "4.0.", "10", "x-7", "AKIA5TE3CZ6XYP", "(2024)"]
    docs = []
    for i in range(n):
        ws = r.choices(words, k=r.randint(0, 40))
        for _ in range(r.choice([0, 0, 1, 2])):
            kind = r.randrange(4)
            one = [f"u{r.randrange(10**5)}.x@mail{r.randrange(9)}.example.com", ".".join(str(r.randrange(256)) for _ in range(4)), card(r), f"+1 ({r.randrange(200, 999)}) 555-{r.randrange(10**4):04}"][kind]
            for _ in range(r.choice([1, 2])):
                ws.insert(r.randrange(len(ws) + 1), one + r.choice(["", ".", ","]))
        docs.append((i, r.choice([" ", "\n"]).join(ws)))
    return docs


@pytest.fixture(scope="module")
def model():
    seen: dict = {}
    for b in P.contexts(iter([pa.record_batch([pa.array([t for _, t in documents()])], names=["_text"])])):
        for c in b.column("context").to_pylist():
            seen[c] = seen.get(c, 0) + 1
    return P.train(sorted(seen.items()))


def test_base_spans_are_those_of_the_patterns():
    r = random.Random(7)
    texts = [t for _, t in documents()[:200]] + ["".join(r.choices(alphabet, k=r.randint(0, 60))) for alphabet in ("ab@.-+% ", "012.", "0129 -", "+12 ().-", "a@.1+ -é\n") for _ in range(400)]
    texts += ["a@b@c.d.", "@@a.b", "x@y.z@w.v", "1.2.3.4.5.6.7.8", "0001.2.3.255 1.2.3.256", card(r) + " " + card(r), "+12345678+1234567 8"]
    for t in texts:
        assert P.base_spans(t) == by_patterns(t), t


def test_long_texts_take_linear_time():
    for t in ("a" * 500_000, "1" * 300_000, "+1" + " " * 300_000, "@" * 300_000, "1." * 200_000, "a.b-" * 100_000 + "@", "1 " * 100_000):
        P.field_of(t, P.base_spans(t))


def test_similar_mentions_get_the_label(model):
    def added(text):
        f = P.field_of(text, P.base_spans(text))
        return [(P.KINDS[k], text[a:b]) for k, a, b in P.added_spans([f], model, P.CONFIDENCE)[0]]

    assert added("Call +1 (988) 555-2485 now; later 988-555-2485, (9885552485)!") == [("phone", "988-555-2485"), ("phone", "9885552485")]
    assert added("write u12345.x@mail5.example.com or U12345.x") == [("email", "U12345.x")]
    assert added("Call 988-555-2485 or u12345.x, AKIA5TE3CZ6XYP 2024 4.0. 1.2.3.999") == []
    assert added("") == added("no digits at all") == []


def test_marginals_against_all_labellings():
    r = np.random.default_rng(3)
    for edges, exact in ([[0, 1], [1, 2], [1, 3]], True), ([[0, 1], [1, 2], [2, 3], [0, 3]], False):
        node, tables = r.normal(size=(4, 3)), r.normal(size=(len(edges), 3, 3)) * (1 if exact else 0.3)
        total = np.zeros((4, 3))
        for y in itertools.product(range(3), repeat=4):
            p = np.exp(sum(node[i, y[i]] for i in range(4)) + sum(t[y[a], y[b]] for (a, b), t in zip(edges, tables, strict=True)))
            for i in range(4):
                total[i, y[i]] += p
        want = total / total.sum(1, keepdims=True)
        assert np.abs(P.marginals(node, np.array(edges), tables) - want).max() < (1e-6 if exact else 0.03)
    assert P.marginals(np.zeros((0, 3)), np.zeros((0, 2), int), np.zeros((0, 3, 3))).shape == (0, 3)


def test_gradient_leads_to_the_contexts_labels(model):
    """Twins of each kind prefer their own kind, and neighbours inside a phone number each other."""
    assert (np.diag(model.skip) == model.skip.max(1)).all() and np.allclose(model.skip, model.skip.T)
    assert model.chain[4, 4] == model.chain[4].max()


def test_whole_table(spark):
    docs = documents(300)
    again = "x +1 (988) 555-2485 y 988-555-2485"
    docs += [(900, None), (901, ""), (None, again), (None, again), (902, "pad " * 40_000 + again), docs[5], (5, again)]
    d = spark.createDataFrame([(i, t, "f", 1, True, 2, 3, "c", 4) for i, t in docs], DOC).repartition(5)
    got = P.personal_data(d).collect()
    assert sorted((repr(r.doc_id), [(P.KINDS.index(s.kind), s.start, s.end) for s in r.found if s.base]) for r in got) == sorted((repr(i), by_patterns(t or "")) for i, t in docs)
    for r in got:
        spans = [(P.KINDS.index(s.kind), s.start) for s in r.found]
        assert spans == sorted(spans)
        own = [(s.start, s.end) for s in r.found if s.base]
        assert all(s.base or all(b <= s.start or s.end <= a for a, b in own) for s in r.found)
    by = {r.doc_id: [tuple(s) for s in r.found] for r in got}
    assert by[900] == by[901] == [] and [x[3] for x in by[None]] == [True, False]
    assert [(k, a - 160_000, b - 160_000, own) for k, a, b, own in by[902]] == by[None]


def test_nothing_to_learn_from(spark):
    assert P.personal_data(spark.createDataFrame([], DOC)).collect() == []
    plain = spark.createDataFrame([(1, "no 12", *[None] * 7)], DOC)
    assert P.learn(plain) is None and P.personal_data(plain).first().found == []


def test_query(spark):
    from tidemark.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op11_pii"](spark, sf).collect():
        base = by_patterns(texts[r.doc_id])
        said = [f"{P.KINDS[k]}:{a}:{b}" for k, a, b in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for k, _, _ in base) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(",".join(said).encode()).hexdigest() and set(said) <= set(r.spans.split(",")) | ({""} if not said else set())
    assert cases.sha("") == hashlib.sha256(b"").hexdigest()
