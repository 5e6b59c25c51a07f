"""Exact top-k search by inner product with a forest of M-trees.

Vectors are dealt to the nearest of a bounded sample of pivots, and those of a pivot to trees of about TREE vectors. A
tree is loaded in bulk: a node's members go to the nearest of FANOUT routing objects, down to leaves of PAGE; each node
is a page (a row of a written table) with its entries' vectors, covering radii and distances to the node's own routing
object. Queries go through a tree in groups, best bound first, each page multiplied once with all the queries that must
open it: with q the query, p a node's routing object and c an
entry's, <q, c's members> <= <q, p> + |q| (d(p, c) + r(c)), which needs no product with c, and <= <q, c> + |q| r(c). A page
is opened by a query only while its bound reaches the query's k-th score so far. Without a score to start with, a query
goes down to one leaf first. Where vectors spread evenly no bound holds, and the products are queries times vectors.

The trees are gone through in two waves. In the first a query meets one tree, of the pivot whose product with it is
highest; the k-th score found there goes with it. In the second it meets only the trees of pivots whose bound, by the
pivot's covering radius, reaches that score, and starts in each of them with it. The best k of all are merged by score
and id. Where trees are few, several tasks take a copy of a tree and a share of the blocks each.

Every row of pages and blocks is small, and a task holds one tree at a time; vectors whose products might leave the exact
range of doubles are multiplied as integers of any size.

Results for odd input: vectors that are null, empty, or hold null or non-finite components take no part. Components, and
scores, beyond the range of a long are the end of that range. Vectors of another length than the query's are no
candidates. Rows of one id and equal vectors count once; a row with the query's own id is no candidate, and the rows of
one id with other vectors are queries whose results are ranked as one. A null id takes no part. Fewer than k candidates:
all of them; none: no row. An empty table gives an empty result. Other columns are not used or returned.
"""

from __future__ import annotations

import heapq
import itertools
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import stage, unstage
from tessera.llm.components import sorted_groups

TOP, TREE, PAGE, FANOUT, PIVOTS, BLOCK = 5, 16_384, 128, 12, 256, 64
#: Queries that go through a tree side by side.
GROUP = 8 * BLOCK
#: Sums of products stay exact below this, in single and double precision; above both as Python's integers.
_EXACT32, _EXACT, _TYPES = 1 << 24, 1 << 52, (np.float32, np.float64, object)
#: What bounds are raised by, for the rounding of doubles.
_SLACK = 1e-9
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def _narrow(m: np.ndarray) -> np.ndarray:
    """The same integers in as few bytes as hold them all."""
    for t in (np.int16, np.int32):
        if not m.size or (np.iinfo(t).min <= m.min() and m.max() <= np.iinfo(t).max):
            return m.astype(t)
    return m


def _under(score: int) -> float:
    """The score as a double, one step down if that may have rounded it up."""
    return float(score) if abs(score) < _EXACT else float(np.nextafter(float(score), -np.inf))


def _far(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    d = rows.astype(np.float64) - point.astype(np.float64)
    return np.sqrt(np.einsum("ij,ij->i", d, d)) * (1 + _SLACK)


def build(ids: np.ndarray, vectors: np.ndarray) -> list[bytes]:
    """The pages of a tree, root first: for an inner one (0, entries' pages, routing objects, radii, parent distances), for
    a leaf (1, ids, vectors, parent distances)."""
    pages: list = []

    def load(rows: np.ndarray, center: np.ndarray) -> int:
        at = len(pages)
        pages.append(None)
        if len(rows) <= PAGE:
            pages[at] = (1, ids[rows], _narrow(vectors[rows]), _far(vectors[rows], center))
            return at
        chosen, near = [rows[0]], _far(vectors[rows], vectors[rows[0]])
        owner = np.zeros(len(rows), np.int64)
        while len(chosen) < FANOUT and near.max() > 0:
            chosen.append(rows[int(near.argmax())])
            d = _far(vectors[rows], vectors[chosen[-1]])
            closer = d < near
            owner[closer], near[closer] = len(chosen) - 1, d[closer]
        if len(chosen) == 1:  # all equal: cut by number
            owner = np.arange(len(rows)) * FANOUT // len(rows)
            chosen = [rows[0]] * FANOUT
        entries = []
        for k, c in enumerate(chosen):
            part = rows[owner == k]
            if len(part):
                entries.append((load(part, vectors[c]), vectors[c], float(_far(vectors[part], vectors[c]).max())))
        centers = np.array([e[1] for e in entries])
        pages[at] = (0, np.array([e[0] for e in entries]), _narrow(centers), np.array([e[2] for e in entries]), _far(centers, center))
        return at

    load(np.arange(len(ids)), vectors[0])
    return [pickle.dumps((vectors[0], p) if k == 0 else (None, p)) for k, p in enumerate(pages)]


class Tree:
    def __init__(self, payloads: list[bytes]):
        got = [pickle.loads(x) for x in payloads]
        self.root = got[0][0].astype(np.float64)
        self.pages = [p for _, p in got]
        # no routing object is longer than the longest vector of a page
        self.reach = max(float(_norms(p[2]).max()) for p in self.pages)
        self.opened = 0
        self.typed: dict = {}

    def search(self, query_id: int, q: np.ndarray, k: int, floor: float = -np.inf) -> list[tuple[int, int]]:
        """(score, id) of the best k with scores of at least floor, best first."""
        return self.search_all(np.array([query_id]), q[None], k, np.array([floor], np.float64))[0]

    def search_all(self, ids: np.ndarray, m: np.ndarray, k: int, floors: np.ndarray) -> list[list[tuple[int, int]]]:
        """The same for each row of m, side by side: a page is multiplied once with all the queries that must open it.

        No partial sum of a product is above that of the lengths, which says in what type products are exact in any order.
        """
        most = np.maximum(_norms(m), 1) * max(self.reach, 1)
        kinds = np.where(most < _EXACT32, 0, np.where(most < _EXACT, 1, 2))
        out: list = [None] * len(ids)
        for kind in np.unique(kinds):
            who = np.flatnonzero(kinds == kind)
            for i, best in zip(who.tolist(), self._search(ids[who], m[who], k, floors[who], _TYPES[kind]), strict=True):
                out[i] = [(s, -v) for s, v in sorted(best, reverse=True)]
        return out

    def _rows(self, at: int, dtype) -> np.ndarray:
        if (at, dtype) not in self.typed:
            self.typed[at, dtype] = self.pages[at][2].astype(dtype)
        return self.typed[at, dtype]

    def _search(self, ids: np.ndarray, m: np.ndarray, k: int, floors: np.ndarray, dtype) -> list[list[tuple[int, int]]]:
        exact, q, norm, names = m.astype(dtype), m.astype(np.float64), _norms(m), ids.tolist()
        heaps: list[list[tuple[int, int]]] = [[] for _ in names]  # of (score, -id)
        # what an entry must reach: a score and, at that score, an id of at most last
        least, last = floors.astype(np.float64), np.full(len(names), _HIGH)

        def meet(at: int, rows, who: np.ndarray) -> None:
            self.opened += len(who)
            found = self._rows(at, dtype)[rows] @ exact[who].T
            if dtype is object:
                found = np.minimum(np.maximum(found, _LOW), _HIGH)
            r, c = np.nonzero(found >= least[who])
            scores, near, who = found[r, c], self.pages[at][1][rows][r], who[c]
            good = np.flatnonzero((scores > least[who]) | (near <= last[who]))
            for i, score, v in zip(who[good].tolist(), scores[good].tolist(), near[good].tolist(), strict=True):
                best, entry = heaps[i], (int(score), -v)
                if v == names[i] or (len(best) == k and entry <= best[0]) or entry in best:
                    continue
                heapq.heappush(best, entry) if len(best) < k else heapq.heapreplace(best, entry)
                if len(best) == k:
                    least[i], last[i] = _under(best[0][0]), -best[0][1]

        # a query without a floor first goes down to one leaf, by the products with routing objects
        down = [(0, np.flatnonzero(least == -np.inf))]
        while down:
            at, who = down.pop()
            if not len(who):
                continue
            if self.pages[at][0]:
                meet(at, slice(None), who)
                continue
            self.opened += len(who)
            nearest = (self._rows(at, np.float64) @ q[who].T).argmax(0)
            down += [(int(self.pages[at][1][e]), who[nearest == e]) for e in np.unique(nearest)]
        # then all go on together: (bound by length, number, page, queries, their bounds, their products with the page's routing object)
        who, number = np.arange(len(names)), itertools.count()
        todo = [(0.0, next(number), 0, who, np.full(len(names), np.inf), q @ self.root)]
        while todo:
            _, _, at, who, bound, ip = heapq.heappop(todo)
            live = bound >= least[who]
            if not live.any():
                continue
            who, ip = who[live], ip[live]
            page, lengths = self.pages[at], norm[who]
            far = page[-1] if page[0] else page[4] + page[3]
            # entries nearer to the routing object than any query needs are not multiplied
            rows = np.flatnonzero(far >= _needed(least[who], ip, lengths, self.reach))
            if not len(rows):
                continue
            if page[0]:
                meet(at, rows, who)
                continue
            self.opened += len(who)
            near, r, far = self._rows(at, np.float64)[rows] @ q[who].T, page[3][rows][:, None], far[rows][:, None]
            ub = np.minimum(_raised(near + lengths * r, lengths * (r + self.reach)), _raised(ip + lengths * far, lengths * (far + self.reach)))
            for e, child in enumerate(page[1][rows].tolist()):
                meets = np.flatnonzero(ub[e] >= least[who])
                if len(meets):
                    first = -float((ub[e, meets] / np.maximum(lengths[meets], 1)).max())
                    heapq.heappush(todo, (first, next(number), child, who[meets], ub[e, meets], near[e, meets]))
        return heaps


def _norms(m: np.ndarray) -> np.ndarray:
    return np.sqrt((m.astype(np.float64) ** 2).sum(1)) * (1 + _SLACK)


def _needed(least: np.ndarray, ip: np.ndarray, norm: np.ndarray, reach: float) -> float:
    """The least distance from a routing object at which the bound of some query reaches its score: _raised() solved for
    the distance, with room for rounding."""
    free = (least <= _LOW) | (norm == 0)
    room = 2 * _SLACK * (1 + np.abs(ip) + norm * reach)
    need = (least - ip - room) / np.where(free, 1, norm * (1 + 2 * _SLACK))
    return float(np.where(free, -np.inf, need).min())


def _raised(bound, size):
    """An upper bound with room for rounding, which grows with what was added up; at least the least score there is."""
    return np.maximum(bound + _SLACK * (1 + np.abs(size)), float(_LOW))


def _matrix(raw: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(raw).view(np.int64)


def _paged(batches):
    for tree, g in sorted_groups(batches, "tree", "vec_id", "v"):
        pages = build(g["vec_id"], _matrix(g["v"]))
        n = len(pages)
        cols = [pa.array([int(tree)] * n, pa.int64()), pa.array([0] * n, pa.int32()), pa.array(range(n), pa.int64()), pa.array(pages, pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=["tree", "kind", "seq", "payload"])


def _blocked(batches):
    for block, g in sorted_groups(batches, "block", "vec_id", "v", "floor"):
        ids, m, floors = g["vec_id"], _matrix(g["v"]), g["floor"]
        for i in range(0, len(ids), BLOCK):
            j = i + BLOCK
            cols = [pa.array([int(block)], pa.int64()), pa.array([i], pa.int64()), pa.array([m.shape[1]], pa.int32()), pa.array([pickle.dumps((ids[i:j], _narrow(m[i:j]), floors[i:j]))], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["block", "part", "dim", "payload"])


def _router(pivots: dict, radii: dict, first: bool):
    """Of blocks of queries, for every pivot that they must look at, the part that must: in the first wave the pivot of
    the highest product, in the second those whose bound reaches the query's floor."""

    def route(batches):
        for batch in batches:
            rows = []
            for block, part, dim, payload in zip(*(batch.column(c).to_pylist() for c in ("block", "part", "dim", "payload")), strict=True):
                ids, m, floors = pickle.loads(payload)
                p, r = pivots[dim].astype(np.float64), radii[dim]
                ips = m.astype(np.float64) @ p.T
                if first:
                    meets = np.zeros(ips.shape, bool)
                    meets[np.arange(len(ids)), np.where(r >= 0, ips, -np.inf).argmax(1)] = True
                else:
                    norms = _norms(m)[:, None]
                    reach = np.sqrt((p * p).sum(1))[None, :]
                    meets = (_raised(ips + norms * r[None, :], norms * (r[None, :] + reach)) >= floors[:, None]) & (r >= 0)[None, :]
                for k in np.flatnonzero(meets.any(0)):
                    who = np.flatnonzero(meets[:, k])
                    rows.append((dim, int(k), block, part, pickle.dumps((ids[who], m[who], floors[who]))))
            cols = list(zip(*rows, strict=True)) or [[] for _ in range(5)]
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["dim", "pivot", "block", "part", "payload"])

    return route


def _searcher(k: int):
    def search(batches):
        at, pages, tree, asked = None, [], None, []

        def answers():
            ids, m, floors = (np.concatenate(x) for x in zip(*asked, strict=True))
            asked.clear()
            out = [(i, v, s) for i, best in zip(ids.tolist(), tree.search_all(ids, m, k, floors), strict=True) for s, v in best]
            cols = list(zip(*out, strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for name, kind, payload in zip(batch.column("tree").to_pylist(), batch.column("kind").to_pylist(), batch.column("payload"), strict=True):
                if name != at:
                    if asked:
                        yield answers()
                    at, pages, tree = name, [], None
                if kind == 0:
                    pages.append(payload.as_py())
                    continue
                if tree is None:
                    tree, pages = Tree(pages), []
                asked.append(pickle.loads(payload.as_py()))
                if sum(len(x[0]) for x in asked) >= GROUP:
                    yield answers()
        if asked:
            yield answers()

    return search


def _packed(batches):
    """Arrays of longs as bytes."""
    for batch in batches:
        flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
        ends = np.append(0, np.cumsum(batch.column("v").value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64) * 8)
        v = pa.LargeBinaryArray.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(flat))])
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("dim"), v.cast(pa.binary())], names=["vec_id", "dim", "v"])


def _dealer(pivots: dict):
    def deal(batches):
        for batch in batches:
            dims, raw = batch.column("dim").to_pylist(), batch.column("v")
            found, far = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for d in set(dims):
                rows = [i for i, x in enumerate(dims) if x == d]
                m = np.frombuffer(b"".join(raw[i].as_py() for i in rows), np.int64).reshape(len(rows), d).astype(np.float64)
                p = pivots[d].astype(np.float64)
                found[rows] = near = ((p * p).sum(1)[None, :] - 2 * (m @ p.T)).argmin(1)
                far[rows] = np.sqrt(((m - p[near]) ** 2).sum(1)) * (1 + _SLACK)
            cols = [*batch.columns, pa.array(found, pa.int64()), pa.array(far, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, names=["vec_id", "dim", "v", "pivot", "far"])

    return deal


def top_k(vectors: DataFrame, is_query, k: int = TOP) -> DataFrame:
    """vectors: vec_id, v (array of longs). Rows query_id, rank, vec_id, score for the rows where is_query holds."""
    rows = vectors.filter(F.col("vec_id").isNotNull()).select("vec_id", F.size("v").alias("dim"), "v")
    rows = stage(rows.mapInArrow(_packed, "vec_id long, dim int, v binary").dropDuplicates(["vec_id", "v"]), "vectors")
    n = rows.count()
    # pivots: a bounded sample, of each length of vectors
    order = Window.partitionBy("dim").orderBy(F.xxhash64("vec_id"), "vec_id", "v")
    wanted = max(1, min(PIVOTS, n // TREE))
    sample = rows.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= wanted).select("dim", "v").collect()
    pivots: dict[int, list] = {}
    for r in sorted(sample, key=lambda r: (r["dim"], bytes(r["v"]))):
        pivots.setdefault(r["dim"], []).append(np.frombuffer(bytes(r["v"]), np.int64))
    points = {d: np.array(p) for d, p in pivots.items()}
    dealt = stage(rows.mapInArrow(_dealer(points), "vec_id long, dim int, v binary, pivot long, far double"), "dealt")
    # at most PIVOTS rows for each length of vectors
    cells = dealt.groupBy("dim", "pivot").agg(F.ceil(F.count("*") / TREE).cast("long").alias("parts"), F.max("far").alias("r"))
    cells = stage(cells.coalesce(1), "cells")
    radii, trees = {d: np.full(len(p), -1.0) for d, p in points.items()}, 0
    for c in cells.collect():
        radii[c["dim"]][c["pivot"]] = c["r"]
        trees += c["parts"]
    name = F.xxhash64("dim", "pivot", "j")
    pages = dealt.join(F.broadcast(cells), ["dim", "pivot"]).withColumn("j", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.col("parts"))).withColumn("tree", name)
    pages = pages.repartition("tree").sortWithinPartitions("tree", "vec_id").select("tree", "vec_id", "v")
    pages = stage(pages.mapInArrow(_paged, "tree long, kind int, seq long, payload binary"), "pages")
    asked = rows.filter(is_query)
    count = asked.count()
    slices = max(1, min(-(-2 * rows.sparkSession.sparkContext.defaultParallelism // max(trees, 1)), -(-count // BLOCK)))

    def blocked(queries: DataFrame) -> DataFrame:
        dealt = queries.withColumn("block", F.xxhash64("dim", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, count // (BLOCK * 8))))))
        return dealt.repartition("block").sortWithinPartitions("block", "vec_id").mapInArrow(_blocked, "block long, part long, dim int, payload binary")

    def searched(queries: DataFrame, first: bool) -> DataFrame:
        met = blocked(queries).mapInArrow(_router(points, radii, first), "dim int, pivot long, block long, part long, payload binary")
        met = met.join(F.broadcast(cells), ["dim", "pivot"]).withColumn("slice", F.pmod(F.xxhash64("block", "part"), F.lit(slices)).cast("int"))
        one = F.array(F.pmod(F.xxhash64("block", "part", F.lit(3)), F.col("parts")))
        met = met.withColumn("j", F.explode(one if first else F.expr("sequence(0L, parts - 1)")))
        met = met.select(name.alias("tree"), "slice", F.lit(1).alias("kind"), F.xxhash64("block", "part").alias("seq"), "payload")
        copies = pages.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).select("tree", "slice", "kind", "seq", "payload")
        both = copies.unionByName(met).repartition("tree", "slice").sortWithinPartitions("tree", "slice", "kind", "seq")
        return both.withColumn("tree", F.xxhash64("tree", "slice")).mapInArrow(_searcher(k), "query_id long, vec_id long, score long").distinct()

    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    floor = F.lit(float("-inf"))
    queries = asked.withColumn("floor", floor)
    if trees > 2:
        kth = searched(queries, True).withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") == k)
        # a double may round a large score up: one step down is a floor still
        known = stage(kth.select(F.col("query_id").alias("vec_id"), (F.col("score").cast("double") * (1 - F.signum("score") * 1e-15)).alias("floor")), "floors")
        # rows of one id that hold several vectors share their results, but not a floor
        single = asked.groupBy("vec_id").agg(F.count("*").alias("n")).filter("n = 1").select("vec_id")
        queries = asked.join(known.join(single, "vec_id"), "vec_id", "left").withColumn("floor", F.coalesce("floor", floor))
    found = searched(queries, False)
    out = found.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
    out = stage(out.select("query_id", "rank", "vec_id", "score"), "top-k")
    unstage(rows, dealt, pages, cells)
    return out


def quantized(embeddings: DataFrame) -> DataFrame:
    """vec_id, v: floor(256 x) of every component, of the vectors that take part."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.coalesce(fine, F.lit(False)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("v"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(quantized(spark.read.parquet(f"{sf_dir}/embeddings.parquet")), F.col("vec_id") % 50 == 0)


QUERIES = {"op9_topk": op9_topk}
SQL = {
    "op9_topk": """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT DISTINCT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""
}
