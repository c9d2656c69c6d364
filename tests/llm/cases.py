"""Small tables with the awkward cases, and brute-force versions of the text operators."""

import hashlib
import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _id string, _text string, _row int, node string, key string, word int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
NULL_ID = 2**63 - 1


def frame(spark, rows):
    """Documents from (doc_id, text) with further columns whose names clash with inner ones."""
    full = [(i, t, "en" if n % 2 else None, "s", None if t is None else len(t), "x", "y", n, "z", "k", n) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCS)


def awkward(seed=1, n=60):
    """Random documents with shared lines and passages, nulls, blanks, equal rows, equal ids and a long text."""
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)] + ["Éa", "ß", "日本"]
    passages = [" ".join(r.choices(vocab, k=30)) for _ in range(4)]
    shared = ["  A Shared Line here ", "a shared LINE here", "tiny", "Another Shared one\t", " unstripped but shared"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(r.randint(1, 6)):
            kind = r.random()
            parts.append(r.choice(passages) if kind < 0.3 else r.choice(shared) if kind < 0.5 else " ".join(r.choices(vocab, k=r.randint(0, 30))))
        rows.append((i, "\n".join(parts)))
    rows += [(100, None), (101, ""), (102, " \t\n "), (None, rows[3][1]), (None, None), rows[5], rows[5], (7, "another text of an id that is there\na shared line here"), (200, rows[9][1]), (300, rows[9][1])]
    rows.append((400, "\n".join(r.choices(shared + passages, k=400))))
    r.shuffle(rows)
    return rows


def key_of(i):
    return NULL_ID if i is None else i


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lines_brute(rows, least=10):
    def key(line):
        k = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in k)

    first = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            if len(k) >= least:
                first[k] = min(first.get(k, NULL_ID), key_of(i))
    out = []
    for i, t in rows:
        ls = (t or "").split("\n")
        kept = [x for x in ls if key_of(i) <= first.get(key(x), NULL_ID)]
        out.append((i, "\n".join(kept), len(ls), len(ls) - len(kept)))
    return out


def substrings_brute(rows, n=20):
    first = {}
    split = [(i, WORDS.findall(t or "")) for i, t in rows]
    for i, ws in split:
        for s in range(len(ws) - n + 1):
            w = tuple(ws[s : s + n])
            first[w] = min(first.get(w, (NULL_ID, 1 << 60)), (key_of(i), s))
    out = []
    for i, ws in split:
        gone = set()
        for s in range(len(ws) - n + 1):
            if (key_of(i), s) > first[tuple(ws[s : s + n])]:
                gone.update(range(s, s + n))
        out.append((i, " ".join(w for j, w in enumerate(ws) if j not in gone), len(ws), len(gone)))
    return out


def near_brute(rows, k, percent=80):
    def shingles(t):
        ws = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        if not ws:
            return frozenset()
        return frozenset(tuple(ws[j : j + k]) for j in range(len(ws) - k + 1)) if len(ws) >= k else frozenset([tuple(ws)])

    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                up[top(a)] = top(b)
    low = {}
    for a, (i, _) in enumerate(rows):
        low[top(a)] = min(low.get(top(a), NULL_ID), key_of(i))
    out = []
    for a, (i, _) in enumerate(rows):
        c = low[top(a)]
        out.append((i, len(sets[a]), None if c == NULL_ID else c, key_of(i) == c))
    return out


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def same(got, want):
    assert got == sorted(want, key=repr)
