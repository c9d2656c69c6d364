import random

import numpy as np
import pyarrow as pa
import pytest
from cases import awkward, frame, near_brute, rows_of, same

from tidemark.llm import neardup as N
from tidemark.llm import words as W
from tidemark.llm.common import components


def near_copies(seed, groups=6, size=12):
    r = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"g{g}w{r.randrange(90)}" for _ in range(80)]
        for _ in range(size):
            ws = list(base)
            for _ in range(r.randint(0, 6)):
                ws[r.randrange(len(ws))] = f"n{r.randrange(10**6)}"
            rows.append((len(rows), " ".join(ws)))
    return rows


@pytest.mark.parametrize("k", [2, 5])
def test_against_brute_force(spark, k):
    rows = near_copies(k) + [(1000 + i if i is not None else None, t) for i, t in awkward(4, 30)]
    got = N.near_duplicates(frame(spark, rows), words=k)
    same(rows_of(got, "doc_id", "n_shingles", "component_id", "kept"), near_brute(rows, k))


def test_chain_through_one_middle_text(spark):
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(words[8 * i : 8 * i + 90 - 8])) for i in range(3)]
    got = N.near_duplicates(frame(spark, rows), words=2)
    same(rows_of(got, "doc_id", "n_shingles", "component_id", "kept"), near_brute(rows, 2))


def test_empty_table_and_survivors(spark):
    assert N.near_duplicates(frame(spark, [])).collect() == []
    docs = frame(spark, [(5, "one two three four five six"), (2, "one two three four five six"), (9, None), (8, "")])
    assert sorted(r.doc_id for r in N.deduped(docs).collect()) == [2, 8, 9]


def test_sketches_estimate_high_similarities():
    r = np.random.default_rng(1)
    close, far = [], []
    for share, out in ((0.8, close), (0.4, far)):
        for _ in range(40):
            x = np.unique(r.integers(0, 2**63, 900, dtype=np.uint64))
            both = int(2 * 450 * share / (1 + share))
            a, b = x[:450], np.concatenate([x[:both], x[450 : 900 - both]])
            s = N.odd_sketches(np.stack([N.samples(a), N.samples(b)]))
            out.append(int(np.bitwise_count((s[0] ^ s[1]).view(np.uint64)).sum()))
    assert max(close) <= N.most_different(80) < min(far)


def block_of(rows):
    """Rows (key, x, y, role, node, comp, set) as ``forests`` and ``across`` get them."""
    sets = [np.unique(np.array(r[6], np.uint64)) for r in rows]
    low = np.stack([N.samples(W.mix(s)) for s in sets])
    columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(6)]
    return pa.record_batch([*columns, N._lists(N.odd_sketches(low)), pa.array([s.view(np.int64) for s in sets])], names=["key", "x", "y", "role", "node", "comp", "sketch", "shingles"])


BASE = list(range(100))
SETS = [BASE, [*BASE[:95], 900], [*BASE[:60], *range(500, 540)], [*BASE[:96], 901]]


@pytest.mark.parametrize(("x", "y", "roles"), [(0, 0, (0, 1, 1, 1)), (0, -1, (0, 0, 0, 0))])
def test_across_confirms_what_stars_left(x, y, roles):
    rows = [(7, x, y, roles[i], i, [0, 1, 2, 1][i], s) for i, s in enumerate(SETS)]
    (out,) = N.across(N.most_different(80), 80)(iter([block_of(rows)]))
    found = {tuple(sorted(p)) for p in zip(*(c.to_pylist() for c in out.columns), strict=True)}
    assert found and found <= {(0, 1), (0, 3)}


def test_forests_span_what_passes():
    r = np.random.default_rng(5)
    sets = [[*range(g * 1000, g * 1000 + 90), *r.integers(10**6, 10**9, 4).tolist()] for g in range(5) for _ in range(8)]
    rows = [(key, 0, -1, 0, i, i, s) for key in (1, 2) for i, s in enumerate(sets) if i % 2 == key - 1 or i % 8 < 2]
    (out,) = N.forests(N.most_different(80))(iter([block_of(rows)]))
    passed = {n for n in out.column("node").to_pylist() if n is not None}
    tree = {(a, b) for a, b in zip(out.column("a").to_pylist(), out.column("b").to_pylist(), strict=True) if a is not None}
    assert passed == set(range(40)) and len(tree) < len(rows)
    zone = list(range(40))
    for _ in range(40):
        for a, b in tree:
            zone[a] = zone[b] = min(zone[a], zone[b])
    assert zone == [i // 8 * 8 for i in range(40)]


def test_one_large_group_at_the_threshold(spark, monkeypatch):
    """Copies that are about as similar as a link takes: some links, many refuted pairs, several blocks."""
    monkeypatch.setattr(N, "BLOCK", 64)
    r = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(300):
        ws = list(base)
        for _ in range(r.randint(3, 5)):
            ws[r.randrange(len(ws))] = f"n{r.randrange(10**6)}"
        rows.append((i, " ".join(ws)))
    got = N.near_duplicates(frame(spark, rows), words=1)
    same(rows_of(got, "doc_id", "n_shingles", "component_id", "kept"), near_brute(rows, 1))
    got = N.near_duplicates(frame(spark, rows), words=2)
    same(rows_of(got, "doc_id", "n_shingles", "component_id", "kept"), near_brute(rows, 2))


def test_sql_judges_rows_of_one_id_apart(spark, tmp_path):
    import duckdb

    from tidemark.llm.queries import ORACLE

    x, y = "one two three four five", "six seven eight nine ten"
    rows = [(1, x), (5, x), (5, y), (9, y), (None, y)]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    sql = con.execute(ORACLE["op9_minhash_near_dedup"]).fetchall()
    got = rows_of(N.near_duplicates(frame(spark, rows), words=2), "doc_id", "n_shingles", "component_id", "kept")
    same(got, near_brute(rows, 2))
    same(got, sql)


def test_blocks_bring_every_cross_pair_together_once(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 3)
    comps = [1] * 10 + [2] * 4 + [3] * 4 + [4]
    mixed = spark.createDataFrame([(7, i, c) for i, c in enumerate(comps)], "key long, node long, comp long")
    cells: dict = {}
    for r in N._blocks(mixed).collect():
        cells.setdefault((r.x, r.y), ([], []))[r.role].append(r.node)
    met: dict = {}
    for (x, y), (left, right) in cells.items():
        pairs = [(a, b) for a in left for b in right] if y >= 0 or -y - 1 != x else [(a, b) for a in left for b in left if a < b]
        for a, b in pairs:
            k = (min(a, b), max(a, b))
            met[k] = met.get(k, 0) + 1
    want = {(a, b) for a in range(len(comps)) for b in range(a + 1, len(comps)) if comps[a] != 1 or comps[b] != 1}
    assert set(met) == want and set(met.values()) == {1}


def test_components_of_a_long_chain(spark):
    links = spark.range(1, 40).selectExpr("id as a", "id + 1 as b").union(spark.sql("select 100L, 101L"))
    got = {r.node: r.component for r in components(links, "a", "b").collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100}
