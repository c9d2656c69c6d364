"""Substring dedup by prefix-partitioned suffix trees over words.

A window is ``WINDOW`` consecutive words.  A word goes if a window that covers it starts earlier as well: in a
document with a smaller id, or earlier in the same one.

1. Suffixes are indexed at anchors: of the first words of each window's ``ANCHOR``-word prefixes the one with the
   smallest hash.  Equal windows have their anchor at the same place, so consecutive windows of one anchor travel as
   one run of words instead of one suffix each.  Equal runs of one batch are combined before the shuffle, the
   earliest stands for them.
2. Runs are dealt by their anchor's prefix.  A prefix that occurs once cannot lead to a repeat and ends there.
3. The words of the others go to their prefix's group; groups of prefixes fill memory-sized parts.  A prefix with
   more than ``HOT`` runs is split by document first, and its windows, now the longest prefixes, meet in a second
   round, so no group grows with the data.
4. In a part the tree is refined from short prefixes to whole windows: a branch with one leaf is dropped, and a node
   as deep as a window with several leaves is a repeat.  Its earliest leaf stays.
5. Repeats come back as spans per document and are taken out of its words.

Later exact copies of a text are known from two hashes of it; they lose all their windows and are not indexed.

Defined cases: a null text has no words; a null id counts as one id above all others; of rows with the same id,
none is earlier than another at the same start, and every row is returned; texts below ``WINDOW`` words lose
nothing; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.common import id_of, keyed, parts

WINDOW, ANCHOR = 20, 4
HOT = 20_000
DEPTHS = (7, 13, WINDOW)  #: prefix lengths at which branches are split and single leaves dropped
CHUNK_WORDS = 500_000  #: words of one tree
HELD_RUNS = 200_000  #: runs that a task combines at a time
_STEP = 0x9FB21C651E98DF25
RUN = "_id long, _fp long, s0 int, s1 int, key long, n int"


def _schema(sql: str) -> list[str]:
    return [x.split()[0] for x in sql.split(", ")]


def _batch(sql: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], names=_schema(sql))


def _whole(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    rows = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(rows).combine_chunks() if rows else None


def anchored_runs(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows of words: first and last window of each run (indices of their first words), and its anchor's word."""
    g = W.runs(h, ANCHOR)
    wide = WINDOW - ANCHOR + 1
    at = np.arange(len(h))
    end = np.repeat(first[1:], np.diff(first))
    window = at[at + WINDOW <= end]
    if not len(window):
        return window, window, window
    low, span = g, 1
    while span < wide:
        step = min(span, wide - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    best = low[window]
    anchor = np.zeros(len(window), np.int64)
    for j in range(wide - 1, -1, -1):  # the leftmost of equal ones
        anchor[g[window + j] == best] = j
    anchor += window
    edge = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    return window[edge], window[np.r_[edge[1:], len(window)] - 1], anchor[edge]


def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of every document.  n is 0 for spans that repeat an earlier run seen by this task, merged."""
    held: list[tuple] = []
    for b in (c for big in batches for c in W.chunks(big)):
        w = W.split(b.column("_text"))
        h = W.word_hashes(w)
        s0, s1, anchor = anchored_runs(h, w.first)
        if not len(s0):
            continue
        doc = w.doc[s0]
        # the run's whole content as one hash, its anchor as another
        up, down = (W.powers(np.uint64(x), len(h) + 1) for x in (_STEP, pow(_STEP, -1, 2**64)))
        total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * up[: len(h)], out=total[1:])
        content = W.mix((total[s1 + WINDOW] - total[s0]) * down[s0] + (s1 - s0).astype(np.uint64))
        at = w.first[doc]
        held.append((b.column("_id").to_numpy()[doc], b.column("_fp").to_numpy()[doc], (s0 - at).astype(np.int32), (s1 - at).astype(np.int32), W.runs(h, ANCHOR)[anchor].view(np.int64), content))
        if sum(len(x[0]) for x in held) > HELD_RUNS:
            yield from _combined(held)
            held = []
    if held:
        yield from _combined(held)


def _combined(held: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Equal runs as their earliest one and the spans of the others."""
    ident, fp, s0, s1, key, content = (np.concatenate(x) for x in zip(*held, strict=True))
    by = np.lexsort((fp, s0, ident, key, content))
    same = np.r_[False, (content[by][1:] == content[by][:-1]) & (key[by][1:] == key[by][:-1])]
    lead = by[np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))]
    earlier = np.zeros(len(by), bool)
    earlier[by] = same & ((ident[by] != ident[lead]) | (s0[by] != s0[lead]))
    again = np.zeros(len(by), bool)  # the same row once more
    again[by[1:]] = same[1:] & (ident[by[1:]] == ident[by[:-1]]) & (s0[by[1:]] == s0[by[:-1]]) & (fp[by[1:]] == fp[by[:-1]])
    fresh = ~earlier & ~again
    yield _batch(RUN, *(x[fresh] for x in (ident, fp, s0, s1, key)), np.ones(fresh.sum(), np.int32))
    doc = np.unique(np.stack([ident, fp]), axis=1, return_inverse=True)[1].ravel() if earlier.any() else ident
    yield _spans(ident[earlier], fp[earlier], doc[earlier], s0[earlier], s1[earlier])


def _spans(ident, fp, doc, start, stop) -> pa.RecordBatch:
    """Adjoining or overlapping windows of one row as one span (n = 0)."""
    by = np.lexsort((start, doc))
    doc, start, stop = doc[by], start[by], stop[by]
    head = np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] > stop[:-1] + 1)][: len(doc)]
    at = np.flatnonzero(head)
    last = np.maximum.reduceat(stop, at) if len(at) else stop
    n = len(at)
    return _batch(RUN, ident[by][at], fp[by][at], start[at].astype(np.int32), last.astype(np.int32), ident[by][at], np.zeros(n, np.int32))


def shared_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs whose anchor's prefix occurs again, with its count; spans as they are."""
    t = _whole(batches)
    if t is None:
        return
    key, n = t.column("key").to_numpy(), t.column("n").to_numpy()
    _, at, count = np.unique(key[n > 0], return_inverse=True, return_counts=True)
    n = n.copy()
    n[n > 0] = count[at]
    t = t.set_column(5, "n", pa.array(n.astype(np.int32)))
    yield from t.filter(pa.array(n != 1)).to_batches()


CONTENT = "_id long, _fp long, s0 int, s1 int, part long, level int, words binary"


def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each run, dealt by prefix.  level 0: one round, 1: split prefix, 2: a span that goes."""
    for big in batches:
        for b in W.chunks(big):
            w = W.split(b.column("_text"))
            h = W.word_hashes(w)
            runs = b.column("runs")
            per_doc = np.diff(np.asarray(runs.offsets))
            flat = runs.flatten()
            s0, s1, key, n = (flat.field(x).to_numpy() for x in ("s0", "s1", "key", "n"))
            doc = np.repeat(np.arange(b.num_rows), per_doc)
            ident, fp = b.column("_id").to_numpy()[doc], b.column("_fp").to_numpy()[doc]
            copies = np.zeros(b.num_rows, bool)
            copies[doc[n < 0]] = True
            last = (np.diff(w.first) - WINDOW)[doc]
            keep = (~copies[doc] | (n < 0)) & (last >= 0)
            s1 = np.where(n < 0, last, s1)
            for i in np.array_split(np.flatnonzero(keep), max(1, int(keep.sum()) // 20_000)):
                size = np.where(n[i] > 0, s1[i] - s0[i] + WINDOW, 0)
                top = np.concatenate([[0], np.cumsum(size)])
                index = np.arange(top[-1]) + np.repeat(w.first[doc[i]] + s0[i] - top[:-1], size)
                content = pa.Array.from_buffers(pa.binary(), len(i), [None, pa.py_buffer((top * 8).astype(np.int32).tobytes()), pa.py_buffer(h[index].tobytes())])
                salt = W.mix(W.mix(ident[i].view(np.uint64)) % (n[i] // HOT + 1).clip(1).astype(np.uint64)).view(np.int64)
                level = np.where(n[i] <= 0, 2, n[i] > HOT).astype(np.int32)
                yield _batch(CONTENT, ident[i], fp[i], s0[i].astype(np.int32), s1[i].astype(np.int32), np.where(level == 0, key[i], np.where(level == 1, key[i] ^ salt, ident[i])), level, content)


REPEAT = "_id long, _fp long, s0 int, s1 int, part long, check long, level int"


def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans that go (level 2), and the first leaf of each window of a split prefix (level 1) for the second round."""
    t = _whole(batches)
    if t is None:
        return
    level = t.column("level").to_numpy()
    done = t.filter(pa.array(level == 2))
    yield from (_batch(REPEAT, *(b.column(c) for c in ("_id", "_fp", "s0", "s1", "part")), b.column("part"), b.column("level")) for b in done.to_batches())
    t = t.filter(pa.array(level < 2))
    if not t.num_rows:
        return
    part = t.column("part").to_numpy()
    order = np.argsort(part, kind="stable")
    size = (t.column("s1").to_numpy() - t.column("s0").to_numpy() + WINDOW)[order]
    edge = np.flatnonzero(np.r_[True, np.diff(part[order]) != 0, True])  # prefixes stay whole
    filled = np.r_[0, np.cumsum(size)][edge] // CHUNK_WORDS
    cuts = edge[np.flatnonzero(np.r_[True, np.diff(filled) != 0])]
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
        if b > a:
            yield from tree(t.take(pa.array(order[a:b])).combine_chunks())


def tree(t: pa.Table) -> Iterator[pa.RecordBatch]:
    ident, fp, s0, s1, level = (t.column(c).to_numpy() for c in ("_id", "_fp", "s0", "s1", "level"))
    column = t.column("words")
    h = np.frombuffer(b"".join(x.as_py() for x in column), np.uint64)
    count = (s1 - s0 + 1).astype(np.int64)
    top = np.concatenate([[0], np.cumsum(count + WINDOW - 1)])
    row = np.repeat(np.arange(len(count)), count)
    nth = np.arange(count.sum()) - np.repeat(np.concatenate([[0], np.cumsum(count)])[:-1], count)
    leaf, node = top[row] + nth, np.zeros(len(row), np.int64)
    start = s0[row] + nth
    alone: list[np.ndarray] = []  # leaves whose branch has no other
    whole = W.runs(h, WINDOW)
    left = np.arange(len(row))
    depth = 0
    for to in DEPTHS:
        step = W.runs(h, to - depth)[leaf[left] + depth]
        branch = W.mix(step + node[left].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, node_of, size = np.unique(branch, return_inverse=True, return_counts=True)
        node[left] = node_of
        alone.append(left[size[node_of] == 1])
        left = left[size[node_of] > 1]
        depth = to
    by = left[np.lexsort((start[left], ident[row[left]], node[left]))]
    head = np.flatnonzero(np.r_[True, node[by][1:] != node[by][:-1]][: len(by)])
    lead = by[np.repeat(head, np.diff(np.r_[head, len(by)]))]
    equal = np.ones(len(by), bool)
    for j in range(WINDOW):
        equal &= h[leaf[by] + j] == h[leaf[lead] + j]
    if not equal.all():
        raise ArithmeticError("two word sequences share a 64-bit hash")
    later = (ident[row[by]] != ident[row[lead]]) | (start[by] != start[lead])
    gone = by[later]
    r = row[gone]
    spans = _spans(ident[r], fp[r], r, start[gone], start[gone])
    yield _batch(REPEAT, *(spans.column(c) for c in ("_id", "_fp", "s0", "s1", "key")), spans.column("key"), np.full(spans.num_rows, 2, np.int32))
    first = np.concatenate([by[~later], *alone])
    first = first[level[row[first]] == 1]
    r = row[first]
    at = start[first].astype(np.int32)
    second = W.runs(h, WINDOW, np.uint64(0xA0761D6478BD642F))[leaf[first]].view(np.int64) if len(first) else np.zeros(0, np.int64)
    yield _batch(REPEAT, ident[r], fp[r], at, at, whole[leaf[first]].view(np.int64), second, np.ones(len(first), np.int32))


def second_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans that go, with the later of equal windows among the first leaves."""
    t = _whole(batches)
    if t is None:
        return
    level = t.column("level").to_numpy()
    yield from t.filter(pa.array(level == 2)).select(["_id", "_fp", "s0", "s1"]).to_batches()
    t = t.filter(pa.array(level == 1)).combine_chunks()
    if t.num_rows:
        ident, s0, part, check = (t.column(c).to_numpy() for c in ("_id", "s0", "part", "check"))
        by = np.lexsort((s0, ident, check, part))
        head = np.flatnonzero(np.r_[True, (part[by][1:] != part[by][:-1]) | (check[by][1:] != check[by][:-1])])
        lead = by[np.repeat(head, np.diff(np.r_[head, len(by)]))]
        later = by[(ident[by] != ident[lead]) | (s0[by] != s0[lead])]
        yield from t.take(pa.array(later)).select(["_id", "_fp", "s0", "s1"]).to_batches()


def without_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words of their spans; other columns as they are."""
    for big in batches:
        for b in W.chunks(big):
            texts, n_words, n_gone = [], [], []
            for text, spans in zip(b.column("_text").cast(pa.binary()).to_pylist(), b.column("spans").to_pylist(), strict=True):
                ws = text.split()  # bytes split at the six blanks and nothing else
                gone = np.zeros(len(ws), bool)
                for s in spans or ():
                    gone[s["s0"] : s["s1"] + WINDOW] = True
                n_words.append(len(ws))
                n_gone.append(int(gone.sum()))
                texts.append(b" ".join([ws[i] for i in np.flatnonzero(~gone)] if n_gone[-1] else ws).decode())
            more = [c for c in b.schema.names if c == "_row"]
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_text"), pa.array(texts, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()), *(b.column(c) for c in more)],
                names=["_id", "_text", "text", "n_words", "n_removed", *more],
            )


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """``doc_id, text, n_words, n_removed`` of every row, ``text`` being the kept words joined by one space.

    With ``carry``, ``_text`` is the text as it was and a struct ``_row`` has the row's other columns.
    """
    spark = docs.sparkSession
    texts = keyed(docs, id_col, text_col)
    rows = keyed(docs, id_col, text_col, carry)
    n_bytes = texts.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    width = parts(spark, n_bytes, 32_000_000)
    placed = rows.repartition(width, "_id", "_fp")

    twins = texts.select("_id", "_fp", F.xxhash64(F.lit(1), "_text").alias("_fp2"))
    firsts = twins.groupBy("_fp", "_fp2").agg(F.min("_id").alias("first"))
    copies = twins.join(firsts, ["_fp", "_fp2"]).where("_id > first").select("_id", "_fp").distinct()
    copies = copies.selectExpr("_id", "_fp", "0 as s0", "0 as s1", "_id as key", "-1 as n")

    runs = texts.mapInArrow(anchors, RUN).repartition(width, "key").mapInArrow(shared_prefixes, RUN)
    by_doc = runs.union(copies).groupBy("_id", "_fp").agg(F.collect_list(F.struct("s0", "s1", "key", "n")).alias("runs"))
    content = placed.join(by_doc.hint("shuffle_hash"), ["_id", "_fp"]).select("_id", "_fp", "_text", "runs").mapInArrow(contents, CONTENT)
    gone = content.repartition(width, "part").mapInArrow(trees, REPEAT).repartition(width, "part").mapInArrow(second_round, "_id long, _fp long, s0 int, s1 int")
    spans = gone.groupBy("_id", "_fp").agg(F.collect_list(F.struct("s0", "s1")).alias("spans"))
    more = [f"_row {rows.schema['_row'].dataType.simpleString()}"] if carry else []
    schema = ", ".join(["_id long, _text string, text string, n_words long, n_removed long", *more])
    out = placed.join(spans.hint("shuffle_hash"), ["_id", "_fp"], "left").select("_id", "_text", "spans", *["_row"] * carry).mapInArrow(without_spans, schema)
    return out.select(id_of("_id").alias("doc_id"), "text", "n_words", "n_removed", *["_text", "_row"] * carry)
