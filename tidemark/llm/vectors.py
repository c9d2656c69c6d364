"""Vector search: exact top-k by ball trees (integer vectors) and nearest neighbours by a block matrix join.

Both take stated queries against all rows, candidates in shards of ``SHARD`` rows.  Exact top-k holds one shard's tree
in a task and streams queries past it; the block join sees a shard and a block of ``QUERY_BLOCK`` queries at a time.
So memory does not grow with the table.  A query's results from all shards are merged by rank.

Defined cases: a vector that is null, empty, or holds a null or non-finite component takes no part, nor does a row
with a null id (nearest neighbours: nor a zero vector); shorter vectors count as padded with zeros; rows that share
the query's id are its own; repeated rows are candidates of their own and rank by vector where id and score tie; an
id that is a query twice is asked once, with its smallest vector; fewer than k candidates give all of them; extra
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut

QUERY_BLOCK, SHARD, LEAF = 2048, 8192, 32
FOUND = "query_id long, vec_id long, score {}"


def clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, v)`` of the rows that take part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v"), F.coalesce(bad, F.lit(True)).alias("_bad"))
    return rows.where("not _bad and size(v) > 0 and vec_id is not null").drop("_bad")


def _dealt(rows: DataFrame, n: int) -> Column:
    return F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(n)).cast("int")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of doubles, padded with zeros to the longest."""
    lists = column.combine_chunks()
    size = np.diff(np.asarray(lists.offsets))
    out = np.zeros((len(lists), int(size.max()) if len(size) else 0))
    out[np.arange(out.shape[1]) < size[:, None]] = lists.flatten().to_numpy()
    return out


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, n - x.shape[1]))) for x in (a, b))


def _blocks(queries: DataFrame, rows: DataFrame, n_queries: int, n_rows: int) -> tuple[DataFrame, DataFrame, int]:
    """Queries and candidates with their block and shard, each candidate once for every block of queries."""
    blocks, shards = max(1, -(-n_queries // QUERY_BLOCK)), max(1, -(-n_rows // SHARD))
    q = queries.withColumn("block", _dealt(queries, blocks))
    c = rows.withColumn("shard", _dealt(rows, shards)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return cut(q), c, shards


def _to_shards(q: DataFrame, shards: int, which: Column) -> DataFrame:
    return q.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where(which)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


# ---- exact top-k by ball trees -------------------------------------------------------------------------------


class BallTree:
    """Nodes over rows of integers: centre, radius, and either two children or the rows of a leaf."""

    def __init__(self, v: np.ndarray):
        self.v, self.centre, self.radius, self.kids, self.rows = v, [], [], [], []
        if len(v):
            self._grow(np.arange(len(v)))
            self.centre, self.radius = np.array(self.centre), np.array(self.radius)

    def _grow(self, rows: np.ndarray) -> int:
        x = self.v[rows]
        me, centre = len(self.kids), x.mean(0)
        away = np.sqrt(((x - centre) ** 2).sum(1))
        self.centre.append(centre)
        self.radius.append(away.max())
        self.kids.append(None)
        self.rows.append(None)
        if len(rows) <= LEAF or away.max() == 0:
            self.rows[me] = rows
            return me
        # towards two rows far apart; halves keep the depth logarithmic whatever the rows are
        one = x[away.argmax()]
        other = x[((x - one) ** 2).sum(1).argmax()]
        order = np.argsort(x @ (other - one), kind="stable")
        half = len(rows) // 2
        self.kids[me] = (self._grow(rows[order[:half]]), self._grow(rows[order[half:]]))
        return me

    def search(self, q: np.ndarray, own: int, ids: np.ndarray, k: int, least: float) -> list[tuple[int, int, int]]:
        """The k best ``(score, -id, row)``; nodes whose bound is below ``least`` or the kth score are not opened."""
        if not len(self.kids):
            return []
        norm = np.sqrt(q @ q)
        bound = self.centre @ q + norm * self.radius
        bound += 1e-9 * (norm * (np.sqrt((self.centre**2).sum(1)) + self.radius) + 1)  # rounding
        best: list[tuple[int, int, int]] = []
        nodes = [(-bound[0], 0)]
        while nodes:
            top, node = heapq.heappop(nodes)
            if -top < (max(least, best[0][0]) if len(best) == k else least):
                break
            if self.kids[node]:
                for kid in self.kids[node]:
                    heapq.heappush(nodes, (-bound[kid], kid))
                continue
            rows = self.rows[node]
            for row, s in zip(rows.tolist(), (self.v[rows] @ q).tolist(), strict=True):
                if ids[row] != own and s >= least:
                    x = (int(s), -int(ids[row]), -row)
                    if len(best) < k:
                        heapq.heappush(best, x)
                    elif x > best[0]:
                        heapq.heapreplace(best, x)
        return best


def _search_shards(k: int) -> Callable:
    """Rows sorted by shard and role: a shard's candidates (role 0) become one tree, which its queries search in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, tree, ids = None, [], None, None
        for b in batches:
            if not b.num_rows:
                continue
            at, role = b.column("shard").to_numpy(), b.column("role").to_numpy()
            edge = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (role[1:] != role[:-1]), True])
            found: list[tuple[int, int, int]] = []
            for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                piece = pa.Table.from_batches([b.slice(i, j - i)])
                if at[i] != shard:
                    shard, parts, tree = at[i], [], None
                if role[i] == 0:
                    parts.append(piece)
                    continue
                if tree is None and parts:
                    c = pa.concat_tables(parts)
                    tree, ids, parts = BallTree(_matrix(c.column("v"))), c.column("vec_id").to_numpy(), []
                if tree is not None:
                    a, _ = _same_width(_matrix(piece.column("v")), tree.v[:0])
                    for own, x, least in zip(piece.column("vec_id").to_pylist(), a[:, : tree.v.shape[1]], piece.column("least").to_pylist(), strict=True):
                        found += [(own, -n, s) for s, n, _ in tree.search(x, own, ids, k, -np.inf if least is None else least)]
            yield pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], pa.int64()) for n in range(3)], names=["query_id", "vec_id", "score"])

    return run


def exact_top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest inner products of floor(scale * x), ties to smaller ids.

    Queries are the rows whose id is divisible by ``every``.  In rounds a query searches one shard, then one more, two
    more, four more and so on; all searches of a round begin with its kth score over the rounds before.  A round sends
    every candidate once, builds every shard's tree once, and queries follow it in a stream.

    Vectors of floor(scale * x) whose squared norm is 2**53 or more take no part: below it doubles hold every score
    exactly.
    """
    rows = clean(vectors, id_col, vector_col).withColumn("v", F.transform("v", lambda x: F.floor(F.greatest(F.least(x, F.lit(1e15)), F.lit(-1e15)) * scale).cast("double")))
    rows = rows.where(F.aggregate("v", F.lit(0.0), lambda n, x: n + x * x) < 2.0**53)
    shards = max(1, -(-rows.count() // SHARD))
    c = cut(rows.withColumn("shard", _dealt(rows, shards)))
    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    q = cut(queries.withColumn("home", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(shards)).cast("int")))
    none = F.lit(None).cast("long").alias("least")
    held = c.select("shard", F.lit(0).alias("role"), "vec_id", "v", none)
    best, done = None, 0
    while done < shards:
        to = min(shards, max(1, 2 * done))
        asked = q.withColumn("least", F.lit(None).cast("long"))
        if best is not None:
            asked = q.join(best.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("least")), "vec_id", "left")
        asked = asked.withColumn("shard", F.explode(F.transform(F.sequence(F.lit(done), F.lit(to - 1)), lambda i: F.pmod(F.col("home") + i, F.lit(shards)))))
        dealt = held.union(asked.select("shard", F.lit(1).alias("role"), "vec_id", "v", "least"))
        found = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "role").mapInArrow(_search_shards(k), FOUND.format("long"))
        best = cut(_ranked(found if best is None else best.drop("rank").union(found), k))
        done = to
    return best.select("query_id", "rank", "vec_id", "score")


# ---- nearest neighbours by a block matrix join ---------------------------------------------------------------


def quantised(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scale, and the norms of the rounded rows and of what rounding left."""
    scale = np.abs(v).max(1) / 127
    whole = np.rint(v / scale[:, None]).astype(np.int8)
    rounded = whole * scale[:, None]
    return whole, scale, np.sqrt((rounded**2).sum(1)), np.sqrt(((v - rounded) ** 2).sum(1))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, added up from the first component to the last."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


def _tile(k: int, rows_at_once: int = 256) -> Callable:
    """The k nearest candidates of a tile for each of its queries."""

    def run(q: pa.Table, c: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if q.num_rows and c.num_rows:
            a, b = _same_width(_matrix(q.column("v")), _matrix(c.column("v")))
            q_ids, c_ids = q.column("vec_id").to_numpy(), c.column("vec_id").to_numpy()
            qa, sa, na, ea = quantised(a)
            qb, sb, nb, eb = quantised(b)
            step = max(1, 2**24 // 127**2)  # so many int8 products add up exactly in a float32
            for i in range(0, len(a), rows_at_once):
                part = slice(i, i + rows_at_once)
                whole = sum(qa[part, j : j + step].astype(np.float32) @ qb[:, j : j + step].T.astype(np.float32) for j in range(0, a.shape[1], step))
                near = whole * sa[part, None] * sb
                error = na[part, None] * eb + ea[part, None] * (nb + eb) + 1e-9 * (na[part, None] + ea[part, None]) * (nb + eb)
                own = q_ids[part, None] == c_ids
                near[own] = -np.inf
                low = near - error
                kth = np.partition(low, -k, 1)[:, -k, None] if low.shape[1] > k else -np.inf
                x, y = np.nonzero((near + error >= kth) & ~own)  # the k nearest are among these
                exact = products(a[part][x], b[y])
                for n in range(len(near)):
                    mine = np.flatnonzero(x == n) if len(near) == 1 else slice(*np.searchsorted(x, [n, n + 1]))
                    best = heapq.nsmallest(k, zip((-exact[mine]).tolist(), c_ids[y[mine]].tolist(), strict=True))
                    out.append((np.full(len(best), q_ids[i + n]), np.array([z[1] for z in best], np.int64), -np.array([z[0] for z in best], np.float64)))
        joined = [np.concatenate(z) for z in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table([pa.array(z) for z in joined], names=["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest by inner product, ties to smaller ids.

    Queries are the rows whose id is divisible by ``every``.  int8 products of a tile bound each inner product from
    both sides; pairs whose upper bound reaches the tile's kth lower bound are computed again in double precision.
    The bounds hold always, so nothing near is missed.
    """
    rows = clean(vectors, id_col, vector_col).where(F.exists("v", lambda x: x != 0))
    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    q, c, shards = _blocks(queries, rows, queries.count(), rows.count())
    tiles = _to_shards(q, shards, F.lit(True)).groupBy("block", "shard").cogroup(c.groupBy("block", "shard"))
    return _ranked(tiles.applyInArrow(_tile(k), FOUND.format("double")), k).select("query_id", "rank", "vec_id", "score")
