"""Connected components of a table of links, by alternating large and small stars on written tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import split_join, stage, unstage


def _contract(batches):
    """The links of a task as stars on the smallest id each reaches within the task: fewer rounds for what follows."""
    parent: dict[int, int] = {}

    def find(x):
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > 1_000_000:  # what is known so far is passed on, so that memory stays bounded
            ids = list(parent)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([find(x) for x in ids], pa.int64())], names=["a", "b"])
            parent = {}
    ids = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([find(x) for x in ids], pa.int64())], names=["a", "b"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: staged a > b. Large star: links of each node to larger ones go to its smallest neighbour; small star: those
    to smaller ones. A node may have any share of the links: its minimum is joined back by split_join."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))
    least = stage(least, "least")
    rows = split_join(both, least, ["a"], "n", both.count())
    if large:
        out = rows.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = rows.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    out = stage(out.filter("a > b").distinct(), "links")
    unstage(least)
    return out


def components(links: DataFrame, together: str | None = None) -> DataFrame:
    """Staged rows id, component (the smallest id reachable) for every id of links (a, b, long) but the smallest ones.

    together: a column of links; links that share its value meet in one task first. The rounds go on until all is stars,
    which takes about the logarithm of the longest path; a round that changes nothing before that would be an error.
    """
    dealt = links.repartition(together) if together else links
    edges = dealt.select("a", "b").mapInArrow(_contract, "a long, b long")
    edges = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "links")
    before = None
    while True:
        # all stars: no node is both an end and a centre, and none has two centres
        mixed = edges.select("a").join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").limit(1).count()
        if not mixed and edges.count() == edges.select("a").distinct().count():
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
        state = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if state == before:
            raise RuntimeError("links that no longer change are not stars")
        before = state
        wide = _star(edges, True)
        unstage(edges)
        edges = _star(wide, False)
        unstage(wide)


def sorted_groups(batches, key: str, *columns: str):
    """For rows sorted by key within a task: (key, {column: numpy array or list}) of each group, in bounded memory.

    Binary columns, of one width in a group, come as a matrix of bytes, lists as an array of arrays.
    """
    rest: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cols = {}
        for c in columns:
            arr = batch.column(c)
            if pa.types.is_binary(arr.type):
                cols[c] = arr.to_pylist()
            elif pa.types.is_list(arr.type):
                values, ends = arr.values.to_numpy(zero_copy_only=False), arr.offsets.to_numpy()
                cols[c] = np.empty(len(keys), object)
                for k in range(len(keys)):
                    cols[c][k] = values[ends[k] : ends[k + 1]]
            else:
                cols[c] = arr.to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            part = {c: np.frombuffer(b"".join(v[i:j]), np.uint8).reshape(j - i, -1) if isinstance(v, list) else v[i:j] for c, v in cols.items()}
            if rest and rest[0][0] != keys[i]:
                yield _joined(rest)
                rest = []
            rest.append((keys[i], part))
            if j < len(keys):
                yield _joined(rest)
                rest = []
    if rest:
        yield _joined(rest)


def _joined(parts):
    key, first = parts[0]
    if len(parts) == 1:
        return key, first
    return key, {c: np.concatenate([p[c] for _, p in parts]) for c in first}
