"""MinHash near-dedup with odd sketches.

Documents are linked if their sets of word shingles have a Jaccard similarity of at least ``percent`` / 100; a
component of links is one group.

1. Each document's set gives MinHash samples.  Groups of ``ROWS`` samples are band keys; all samples together are
   folded into an odd sketch, a bitmap that keeps the parity of the samples that fall on each bit.  Documents with
   the same set are one class from here on.
2. Classes that share a band key are candidates.  In a bucket each class meets the bucket's hub.  The population
   count of two sketches' XOR estimates the similarity; only pairs far below the threshold go.
3. The others are confirmed on the full sets, recomputed from the whole texts.
4. Confirmed links give components.  Where a bucket still holds several, its classes are compared across components
   in blocks that carry sketches alone.  A block gives the classes that pass with another component, and a spanning
   forest of the components that pass with each other, no more than it has rows; joined, the forests are zones.
5. Inside a zone the classes that passed are compared across components in blocks that carry the full sets, each class
   once for every block of its zone and not for every bucket, and what passes by sketch is confirmed there.  So no
   pair of one bucket is left out unless confirmed links join it already, and only links leave a task.

A pair at the very threshold shares no band with probability (1 - 0.8 ** ROWS) ** BANDS, 5e-9; the sketch loses one
with about 3e-7 (MARGIN is five standard deviations of the estimate).

Defined cases: a null or blank text has an empty set and no links; with fewer words than a shingle the whole
sequence is the only shingle; a null id counts as one id above all others (shown as null); every row is returned
and judged by its own text, so rows that share an id may be of several groups, and ``kept`` marks all rows of a
group that have its smallest id; extra columns are ignored.  ``deduped`` leaves one row of each group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.common import KEY, components, cut, id_of, keyed, parts, with_key

BANDS, ROWS, BITS = 48, 5, 1024
SAMPLES = BANDS * ROWS
MARGIN = 0.13
BLANKS = " \t\n\x0b\x0c\r"  #: a text of nothing else has no words
BLOCK = 512  #: classes of a block on either side
SKETCH_ROWS, BLOCK_ROWS = 50_000, 2000  #: about so many rows of blocks a task, with sketches alone and with full sets
_rng = np.random.default_rng(9)
_XOR = _rng.integers(0, 2**32, (SAMPLES, 1), dtype=np.uint32)
_MUL = _rng.integers(0, 2**32, (SAMPLES, 1), dtype=np.uint32) | np.uint32(1)


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every row."""
    w = W.split(column, lower=True)
    h = W.word_hashes(w)
    s = W.runs(h, k, np.uint64(0xA0761D6478BD642F))
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(s[a : b - k + 1]))
        else:
            out.append(W.runs(np.concatenate([h[a:b], [np.uint64(b - a)]]), b - a + 1) if b > a else h[:0])
    return out


def node_of(s: np.ndarray) -> int:
    """A 64-bit hash of a set, never null for a set that is not empty."""
    return int(W.mix(np.array([W.mix(s).sum() + np.uint64(len(s))]))[0].view(np.int64))


def samples(s: np.ndarray) -> np.ndarray:
    x = (s >> np.uint64(32)).astype(np.uint32)
    low = np.full(SAMPLES, 2**32 - 1, np.uint32)
    for i in range(0, len(x), 4096):
        np.minimum(low, ((x[i : i + 4096] ^ _XOR) * _MUL).min(1), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each row of samples."""
    x = low.reshape(len(low), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), x.shape[:2]).copy()
    for j in range(ROWS):
        key = W.mix(key * np.uint64(0x9E3779B97F4A7C15) + x[:, :, j])
    return key.view(np.int64)


def odd_sketches(low: np.ndarray) -> np.ndarray:
    """BITS bits for each row of samples: the parity of the samples that fall on each bit."""
    n = len(low)
    at = W.mix(low.astype(np.uint64) | np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)) % np.uint64(BITS)
    count = np.bincount((at.astype(np.int64) + np.arange(n)[:, None] * BITS).ravel(), minlength=n * BITS)
    return np.packbits((count & 1).astype(np.uint8).reshape(n, BITS), axis=1).view(np.int64)


def _lists(x: np.ndarray) -> pa.Array:
    flat = pa.array(x.ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), flat)


def describe(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in W.chunks(big):
                sets = shingle_sets(b.column("_text"), k)
                low = np.stack([samples(s) for s in sets])
                yield pa.RecordBatch.from_arrays(
                    [b.column("_id"), b.column("_fp"), pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), _lists(band_keys(low)), _lists(odd_sketches(low))],
                    names=["_id", "_fp", "node", "n", "bands", "sketch"],
                )

    return run


def most_different(percent: int) -> int:
    """The largest XOR count of two sketches whose similarity may reach the threshold."""
    odd = 2 * SAMPLES * (1 - percent / 100 + MARGIN)
    return math.ceil(BITS / 2 * (1 - math.exp(-2 * odd / BITS)))


def _different(a: str, b: str) -> Column:
    return F.expr(f"aggregate(zip_with({a}, {b}, (x, y) -> bit_count(x ^ y)), 0, (n, x) -> n + x)")


def confirm(k: int, percent: int):
    """Rows sorted by pair group, the group's own text first; gives the links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own = None, None
        for b in (c for big in batches for c in W.chunks(big)):
            a, salt, kind, node = (b.column(c).to_pylist() for c in ("a", "salt", "kind", "node"))
            got: tuple[list, list] = ([], [])
            for i, s in enumerate(shingle_sets(b.column("_text"), k)):
                if not len(s) or node_of(s) != node[i]:  # another row of that id
                    continue
                if kind[i] == 0:
                    group, own = (a[i], salt[i]), s
                elif (a[i], salt[i]) == group:
                    both = len(np.intersect1d(own, s, assume_unique=True))
                    if 100 * both >= percent * (len(own) + len(s) - both):
                        got[0].append(a[i])
                        got[1].append(node[i])
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in got], names=["a", "b"])

    return run


def _confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, k: int, percent: int, members: int = 256) -> DataFrame:
    """The pairs of nodes that are links.  A node's text is sent once for every ``members`` of its pairs."""
    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / members).cast("int").alias("n"))
    rest = pairs.join(groups, "a").select("a", F.pmod(F.xxhash64("b"), F.col("n")).cast("int").alias("salt"), F.lit(1).alias("kind"), F.col("b").alias("node"))
    own = groups.select("a", F.explode(F.expr("sequence(0, n - 1)")).alias("salt"), F.lit(0).alias("kind"), F.col("a").alias("node"))
    need = rest.union(own).join(classes, "node")
    full = need.join(texts, ["_id", "_fp"]).select("a", "salt", "kind", "node", "_text")
    return full.repartition("a", "salt").sortWithinPartitions("a", "salt", "kind").mapInArrow(confirm(k, percent), "a long, b long")


def sets_of(k: int):
    """The full sets of nodes, from the texts of their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (c for big in batches for c in W.chunks(big)):
            node = b.column("node").to_pylist()
            got = [(n, s) for n, s in zip(node, shingle_sets(b.column("_text"), k), strict=True) if len(s) and node_of(s) == n]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in got], pa.int64()), pa.array([s.view(np.int64) for _, s in got], pa.list_(pa.int64()))], names=["node", "shingles"])

    return run


def _dealt(batches: Iterator[pa.RecordBatch]) -> tuple[pa.Table | None, Iterator[tuple[np.ndarray, list[np.ndarray]]]]:
    """The rows of a task, and for each block ``(key, x, y)`` its left rows and those that each is compared with:
    role 0 against role 1, or within itself if that lacks."""
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return None, iter(())
    t = pa.Table.from_batches(rows).combine_chunks()
    key, x, y, role, node = (t.column(c).to_numpy() for c in ("key", "x", "y", "role", "node"))
    order = np.lexsort((node, role, y, x, key))
    edge = np.flatnonzero(np.r_[True, np.any([np.diff(c[order]) != 0 for c in (key, x, y)], axis=0), True])

    def blocks() -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            left, right = order[a:b][role[order[a:b]] == 0], order[a:b][role[order[a:b]] == 1]
            own = len(left) and y[left[0]] < 0 and -y[left[0]] - 1 == x[left[0]]
            yield left, [left[i + 1 :] if own else right for i in range(len(left))]

    return t, blocks()


def _sketches(t: pa.Table) -> np.ndarray:
    """As unsigned values: of a signed one, bitwise_count counts the bits of its magnitude."""
    return t.column("sketch").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1).view(np.uint64)


def forests(limit: int):
    """Of each block: its classes that pass by sketch with one of another component (``node``, no ``a``), and a
    spanning forest ``(a, b)`` of the components that pass with each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, blocks = _dealt(batches)
        if t is None:
            return
        node, comp, sketch = t.column("node").to_numpy(), t.column("comp").to_numpy(), _sketches(t)
        passed, tree = set(), set()
        for left, partners in blocks:
            label = {}

            def top(c: int) -> int:
                while label.get(c, c) != c:
                    c = label[c]
                return c

            for me, near in zip(left, partners, strict=True):
                near = near[comp[near] != comp[me]]
                near = near[np.bitwise_count(sketch[near] ^ sketch[me]).sum(1) <= limit]
                if len(near):
                    passed.add(int(node[me]))
                    passed.update(node[near].tolist())
                    mine = int(comp[me])
                    for c in np.unique(comp[near]).tolist():
                        if top(c) != top(mine):
                            label[top(c)] = top(mine)
                            tree.add((mine, c))
        none = [None] * len(passed)
        yield pa.RecordBatch.from_arrays([pa.array([*passed, *[None] * len(tree)], pa.int64()), *[pa.array([*none, *[e[i] for e in tree]], pa.int64()) for i in range(2)]], names=["node", "a", "b"])

    return run


def across(limit: int, percent: int):
    """Links between components in one block of one zone; one link to another component is enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, blocks = _dealt(batches)
        if t is None:
            return
        node, comp, sketch = t.column("node").to_numpy(), t.column("comp").to_numpy(), _sketches(t)
        sets = t.column("shingles").combine_chunks()
        first, shingles = np.asarray(sets.offsets), sets.flatten().to_numpy().view(np.uint64)
        out = set()
        for left, partners in blocks:
            for me, near in zip(left, partners, strict=True):
                near = near[comp[near] != comp[me]]
                near = near[np.bitwise_count(sketch[near] ^ sketch[me]).sum(1) <= limit]
                own, joined = shingles[first[me] : first[me + 1]], set()
                for j in near:
                    if comp[j] not in joined:
                        other = shingles[first[j] : first[j + 1]]
                        both = len(np.intersect1d(own, other, assume_unique=True))
                        if 100 * both >= percent * (len(own) + len(other) - both):
                            joined.add(comp[j])
                            out.add((int(node[me]), int(node[j])))
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in range(2)], names=["a", "b"])

    return run


def _blocks(mixed: DataFrame) -> DataFrame:
    """The classes of keys (buckets or zones) of several components, dealt to blocks ``(key, x, y)`` with their role.

    Nothing is compared inside a key's largest component.  The other classes (block x) meet the largest
    component's blocks (y from 0) and each other's (y below 0), so a row is sent once for each block of the others.
    """
    bucket = Window.partitionBy("key")
    m = mixed.withColumn("size", F.count("*").over(Window.partitionBy("key", "comp")))
    m = m.withColumn("top", F.max(F.struct("size", "comp")).over(bucket)).withColumn("all", F.count("*").over(bucket))
    m = m.withColumn("tops", F.ceil(F.col("top.size") / BLOCK).cast("int")).withColumn("rest", F.ceil((F.col("all") - F.col("top.size")) / BLOCK).cast("int"))
    m = m.where("rest > 0").withColumn("minor", F.expr("comp <> top.comp"))
    m = m.withColumn("i", F.expr("cast(pmod(xxhash64(node), if(minor, rest, tops)) as int)"))
    places = F.expr("""if(minor,
        concat(transform(sequence(0, tops - 1), j -> struct(i as x, j as y, 0 as role)),
               transform(sequence(i, rest - 1), j -> struct(i as x, -j - 1 as y, 0 as role)),
               if(i > 0, transform(sequence(0, greatest(i - 1, 0)), j -> struct(j as x, -i - 1 as y, 1 as role)), array())),
        transform(sequence(0, rest - 1), j -> struct(j as x, i as y, 1 as role)))""")
    return m.select("key", "node", "comp", F.explode(places).alias("p")).select("key", "node", "comp", "p.*")


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> tuple[DataFrame, bool]:
    """``_id, _fp, n, low`` of every row, and whether some id has a text that is not blank more than once.

    ``low`` is the smallest ``(_id, _fp)`` of the row's group, null for an empty set.
    """
    texts = keyed(docs, id_col, text_col).select("_id", "_fp", "_text")
    spark = docs.sparkSession
    seen = cut(texts.mapInArrow(describe(words), "_id long, _fp long, node long, n long, bands array<long>, sketch array<long>"))
    filled = seen.where("node is not null")
    again = (filled.groupBy("_id", "_fp").count().agg(F.max("count")).first()[0] or 0) > 1
    if again:
        filled, texts = filled.dropDuplicates(["_id", "_fp"]), texts.dropDuplicates(["_id", "_fp"])
    classes = filled.groupBy("node").agg(F.min(F.struct("_id", "_fp")).alias("first")).select("node", "first.*")
    one = filled.join(classes, ["node", "_id", "_fp"])
    sketches = one.select("node", "sketch")
    limit = most_different(percent)

    keys = one.select("node", F.explode("bands").alias("key"))
    bucket = Window.partitionBy("key")
    held = keys.withColumn("hub", F.min("node").over(bucket)).withColumn("top", F.max("node").over(bucket))
    held = cut(held.where("hub != top").select("key", "node", "hub"))

    def close(pairs: DataFrame) -> DataFrame:
        p = pairs.join(sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sa")), "a")
        p = p.join(sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sb")), "b")
        return p.where(_different("sa", "sb") <= limit).select("a", "b").distinct()

    stars = cut(close(held.where("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()))
    links = cut(_confirmed(stars, classes, texts, words, percent))
    label = components(links, "a", "b")

    mixed = held.where("node != hub").distinct().join(label, "node", "left").select("key", "node", F.coalesce("component", "node").alias("comp"))
    mixed = mixed.withColumn("lo", F.min("comp").over(bucket)).withColumn("hi", F.max("comp").over(bucket)).where("lo != hi")
    mixed = cut(_blocks(mixed))
    n = mixed.count()
    if n:
        near = mixed.join(sketches.dropDuplicates(["node"]), "node").repartition(parts(spark, n, SKETCH_ROWS), "key", "x", "y")
        near = cut(near.mapInArrow(forests(limit), "node long, a long, b long").distinct())
        passed = near.where("node is not null").select("node").join(label, "node", "left").select("node", F.coalesce("component", "node").alias("comp"))
        zones = components(near.where("node is null"), "a", "b").select(F.col("node").alias("comp"), F.col("component").alias("key"))
        inside = cut(_blocks(passed.join(zones, "comp").select("key", "node", "comp")))
        need = inside.select("node").distinct()
        sets = need.join(classes, "node").join(texts, ["_id", "_fp"]).select("node", "_text").mapInArrow(sets_of(words), "node long, shingles array<long>")
        described = sketches.join(sets, "node").dropDuplicates(["node"])
        dealt = inside.join(described, "node").repartition(parts(spark, inside.count(), BLOCK_ROWS), "key", "x", "y")
        more = cut(dealt.mapInArrow(across(limit, percent), "a long, b long").distinct())
        if not more.isEmpty():
            links = cut(links.union(more))
            label = components(links, "a", "b")

    group = classes.join(label, "node", "left").select("node", "_id", "_fp", F.coalesce("component", "node").alias("component"))
    least = group.groupBy("component").agg(F.min(F.struct("_id", "_fp")).alias("low"))
    by_node = group.join(least, "component").select("node", "low")
    return seen.select("_id", "_fp", "node", "n").join(by_node, "node", "left").select("_id", "_fp", "n", "low"), again


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row; see the module for the method and defined cases."""
    out = _grouped(docs, id_col, text_col, words, percent)[0].withColumn("low", F.coalesce("low._id", "_id"))
    return out.select(id_of("_id").alias("doc_id"), F.col("n").alias("n_shingles"), id_of("low").alias("component_id"), (F.col("_id") == F.col("low")).alias("kept"))


def deduped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group, with its own columns, and every row with an empty set.

    That row has the group's smallest id, and of several texts under that id the one with the smallest hash; of rows
    that are equal in both, the smallest in their columns stays.
    """
    judged, again = _grouped(docs, id_col, text_col, words, percent)
    gone = judged.where("low is not null and (_id <> low._id or _fp <> low._fp)").select(F.col("_id").alias(KEY[0]), F.col("_fp").alias(KEY[1])).distinct()
    rows = with_key(docs, id_col, text_col)
    if not again:
        return rows.join(gone, KEY, "left_anti").select("row.*")
    text = F.col("row")[text_col].cast("string")
    blank = F.coalesce(F.btrim(text, F.lit(BLANKS)) == "", F.lit(True))
    ordered = F.struct(*[F.col("row")[c] for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind])
    single = rows.where(~blank).groupBy(*KEY).agg(F.min_by("row", ordered).alias("row"))
    return rows.where(blank).select("row.*").union(single.join(gone, KEY, "left_anti").select("row.*"))
