"""MinHash near-dedup by the chosen-path set similarity join.

A document's set is embedded in TOKENS minwise coordinates. The roots of ROOTS trees are the documents that share a
coordinate's token; a node too large to compare is branched by further coordinates, chosen at random for the node, into
those that share another token. Nodes that are small enough are compared exhaustively on their signatures: the task that
holds a node proposes a maximum spanning forest of its pairs of estimated similarity CANDIDATE and more, so a node makes
no more rows than it has documents. Proposed links are confirmed on the full sets, exactly. In a second round the
documents of a node that have candidates in another component meet there with their full sets, and links between the
components are looked for exactly, so no pair of candidates is left that is neither linked nor checked, and again no row
stands for a pair. Two documents of similarity s share no root with probability
(1 - s) ** ROOTS, 0.0000153 at 0.75, and are estimated under CANDIDATE with one of 0.0001 at 0.75, less above.

A node of which a child still holds most is a family of near copies: branching would multiply it. It is cut into blocks
that share some documents. In the second round the documents of its largest component and the others are cut into blocks
each, and every pair of blocks of which one is of the others meets: what a task holds is bounded, whatever the labels.

Documents with equal sets are one class, found by their sets' fingerprints (128 bits) and represented by the smallest
doc_id, so copies cost nothing. A class has a number of its own; rows of one doc_id that are in several classes link those.

Results for odd input: a null text, or one without words, has an empty set (n_shingles 0), is linked with nothing and has
its own doc_id as component, whatever other rows its doc_id has. All other rows of one doc_id are one vertex; all rows of
the smallest doc_id of a component are kept. A null doc_id takes part in its class only: it has the class's component,
null if the class has no other row. Very long texts are read whole: a set takes 8 bytes a word, of one row at a time, and
in the second round a task holds two blocks of HELD / 2 shingles, or one set if that is longer. An empty table gives an
empty result. Other columns pass through near_dedup(), whatever their names; columns made here start with two underscores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import salted_join, sized, split_join, stage, unstage
from tessera.llm.components import components, sorted_groups

SHINGLE, PERCENT = 5, 75
TOKENS, ROOTS, CANDIDATE = 128, 8, 0.6
#: Nodes of more documents are branched across tasks; within one, nodes of more than LEAF are, as long as that shrinks them.
NODE, LEAF, BRANCHES, DEPTH = 4096, 48, 6, 4
#: A node is a family if a child still has more than this share of it; documents that all blocks of a family share.
SHRINK, ANCHORS = 0.7, 64
#: Shingles that a node may hold in the second round.
HELD = 2_000_000
_MULT = (np.random.default_rng(20240611).integers(0, 1 << 63, TOKENS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes | None) -> np.ndarray:
    """The distinct shingles of a whole text, each as 64 bits, sorted. bytes.lower() and split() are those of ASCII."""
    found = text.lower().split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    span = min(SHINGLE, len(w))
    h = np.full(len(w) - span + 1, span, np.uint64)
    for k in range(span):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[k : len(w) - span + 1 + k]
    return np.unique(_mix(h))


def signature(sets: np.ndarray) -> np.ndarray:
    least = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(sets), 1024):
        np.minimum(least, np.multiply.outer(sets[i : i + 1024], _MULT).min(axis=0), out=least)
    return least


def _features(batches):
    for batch in batches:
        out = [[] for _ in range(5)]
        for text in batch.column("text").cast(pa.binary()):
            s = shingles(text.as_py())
            out[0].append(len(s))
            out[1].append(int(s.sum(dtype=np.uint64).astype(np.int64)) if len(s) else 0)
            out[2].append(int(np.bitwise_xor.reduce(_mix(s)).astype(np.int64)) if len(s) else 0)
            sig = signature(s) if len(s) else None
            out[3].append(None if sig is None else sig[:ROOTS].astype(np.int64))
            out[4].append(None if sig is None else (sig & np.uint64(0xFFFF)).astype(np.uint16).tobytes())
        types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
        cols = [batch.column("doc_id"), batch.column("__rid"), *(pa.array(x, t) for x, t in zip(out, types, strict=True))]
        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "__rid", "n", "f1", "f2", "roots", "sig"])


def _sets(batches):
    for batch in batches:
        found = [shingles(x.as_py()) for x in batch.column("text").cast(pa.binary())]
        f1 = [int(s.sum(dtype=np.uint64).astype(np.int64)) if len(s) else 0 for s in found]
        f2 = [int(np.bitwise_xor.reduce(_mix(s)).astype(np.int64)) if len(s) else 0 for s in found]
        cols = [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in ([len(s) for s in found], f1, f2))]
        sets = pa.array([s.astype(np.int64) for s in found], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*cols, sets], names=["doc_id", "n", "f1", "f2", "s"])


def _alike(sig: np.ndarray, i: int) -> np.ndarray:
    """Of every row the estimated similarity to row i."""
    return np.count_nonzero(sig == sig[i], axis=1) / TOKENS


def _forest(sig: np.ndarray) -> list[tuple[int, int]]:
    """A maximum spanning forest of the pairs of CANDIDATE and more, by Prim's method: no pair is kept."""
    m = len(sig)
    if m == 2:
        return [(0, 1)] if np.count_nonzero(sig[0] == sig[1]) >= CANDIDATE * TOKENS else []
    best, to = np.full(m, -1.0), np.zeros(m, np.int64)
    free, out, i = np.ones(m, bool), [], 0
    for _ in range(m - 1):
        free[i] = False
        near = _alike(sig, i)
        closer = free & (near > best)
        best[closer], to[closer] = near[closer], i
        i = int(np.argmax(np.where(free, best, -2.0)))
        if best[i] >= CANDIDATE:
            out.append((int(to[i]), i))
    return out


def _minority(label: np.ndarray) -> np.ndarray:
    """The rows that do not have the most frequent label."""
    values, inverse, counts = np.unique(label, return_inverse=True, return_counts=True)
    return np.flatnonzero(inverse != int(np.argmax(counts)))


def _leaves(sig: np.ndarray, rows: np.ndarray, seed: int, depth: int = 0):
    """The nodes below one: branched by the tokens of chosen coordinates until small, or as similar as a family of copies."""
    if len(rows) <= LEAF or depth > 30:
        yield rows
        return
    chosen = np.random.default_rng([seed & 0xFFFFFFFF, depth, len(rows)]).choice(TOKENS, BRANCHES, replace=False)
    split = []
    for c in chosen:
        token = sig[rows, c]
        order = np.argsort(token, kind="stable")
        cuts = np.flatnonzero(np.diff(token[order])) + 1
        split.append([p for p in np.split(rows[order], cuts) if len(p) > 1])
    if max((len(p) for s in split for p in s), default=0) > SHRINK * len(rows):
        yield rows
        return
    for k, s in enumerate(split):
        for p in s:
            yield from _leaves(sig, p, seed * 31 + k, depth + 1)


def _propose(batches):
    """The spanning forests of all nodes."""
    out: list[tuple] = []
    for node, g in sorted_groups(batches, "node", "id", "sig"):
        sig, ids = np.ascontiguousarray(g["sig"]).view(np.uint16), g["id"]
        if len(ids) < 2:
            continue
        for rows in _leaves(sig, np.arange(len(ids)), int(node)):
            part = sig if len(rows) == len(ids) else sig[rows]
            out += [(int(node), int(ids[rows[i]]), int(ids[rows[j]])) for i, j in _forest(part)]
        if len(out) > 20_000:
            yield _links(out)
            out = []
    yield _links(out)


def _open(batches):
    """node, id of documents with a candidate in another component than theirs."""
    for node, g in sorted_groups(batches, "node", "id", "sig", "label"):
        sig, label = np.ascontiguousarray(g["sig"]).view(np.uint16), g["label"]
        marked = np.zeros(len(label), bool)
        for i in _minority(label):
            near = (_alike(sig, i) >= CANDIDATE) & (label != label[i])
            if near.any():
                marked |= near
                marked[i] = True
        ids = g["id"][marked]
        yield pa.RecordBatch.from_arrays([pa.array([int(node)] * len(ids), pa.int64()), pa.array(ids, pa.int64())], names=["node", "id"])


def _verify(batches):
    """Exact links between the components of a node, each pair of components linked once: of every document that is not of
    the largest component the intersections with all sets of the node are counted in one pass over them."""
    for node, g in sorted_groups(batches, "node", "id", "label", "s"):
        ids, label, sets = g["id"], g["label"].copy(), g["s"]
        size = np.array([len(x) for x in sets])
        names, which = np.unique(np.concatenate(sets), return_inverse=True)
        starts, flag, out = np.concatenate([[0], np.cumsum(size)[:-1]]), np.zeros(len(names), np.uint8), []
        for i in _minority(label):
            mine = which[starts[i] : starts[i] + size[i]]
            flag[mine] = 1
            both = np.add.reduceat(flag[which], starts, dtype=np.int64)
            flag[mine] = 0
            for j in np.flatnonzero((100 * both >= PERCENT * (size + size[i] - both)) & (label != label[i])):
                if label[i] != label[j]:
                    out.append((int(node), int(ids[i]), int(ids[j])))
                    label[label == label[j]] = label[i]
        yield _links(out)


def _links(rows):
    cols = list(zip(*rows, strict=True)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["node", "a", "b"])


def _blocks(size: Column) -> Column:
    return F.ceil(size / (NODE // 2)).cast("int")


def _with_anchors(rows: DataFrame) -> DataFrame:
    """Rows (node, id, size) of families as nodes of a block each; some ANCHORS of their documents are in every block, so
    that the blocks' forests meet."""
    parts = _blocks(F.col("size"))
    anchor = F.pmod(F.xxhash64("id", "node"), F.col("size")) < ANCHORS
    mine = F.array(F.pmod(F.xxhash64(F.lit(1), "id"), parts).cast("int"))
    k = F.explode(F.when(anchor, F.sequence(F.lit(0), parts - 1)).otherwise(mine))
    return rows.withColumn("k", k).select(F.xxhash64("node", F.lit("block"), "k").alias("node"), "id")


def _block_pairs(rows: DataFrame, most: int) -> DataFrame:
    """Rows (node, id, label, w) of nodes too large for a task as nodes of at most about `most` weight. The documents of a
    node's largest label are cut into blocks, and so are all others; each block of the others meets every block of both, so
    every pair of documents of two labels still meets, and those of the largest label are repeated once a block of others."""
    half = max(1, most // 2)
    per = rows.groupBy("node", "label").agg(F.sum("w").alias("w"))
    top = per.groupBy("node").agg(F.max(F.struct("w", "label")).alias("top"), F.sum("w").alias("all"))
    blocks = lambda w: F.greatest(F.ceil(w / half), F.lit(1)).cast("int")
    top = stage(top.select("node", F.col("top.label").alias("top"), blocks(F.col("top.w")).alias("p"), blocks(F.col("all") - F.col("top.w")).alias("q")), "tops")
    mine = F.xxhash64(F.lit(2), "id")
    met = F.expr(
        "case when label = top then transform(sequence(0, q - 1), j -> struct(0 as kind, i, j))"
        " else concat(transform(sequence(0, p - 1), x -> struct(0 as kind, x as i, i as j)),"
        " transform(filter(sequence(0, q - 1), x -> x <> i), x -> struct(1 as kind, least(i, x) as i, greatest(i, x) as j))) end"
    )
    dealt = rows.join(sized(top, 32), "node").withColumn("i", F.pmod(mine, F.when(F.col("label") == F.col("top"), F.col("p")).otherwise(F.col("q"))).cast("int"))
    return dealt.withColumn("k", F.explode(met)).select(F.xxhash64("node", F.lit("pair"), "k.kind", "k.i", "k.j").alias("node"), "id", "label")


def tree_nodes(reps: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Staged rows node, id, sig: who is in which node of more than one document, large nodes branched; and the families
    (node, id, size), None without any: large nodes of which a child still holds over SHRINK. Branching those would only
    multiply them, so they are cut into blocks here, and what blocks tear apart is looked at in the second round."""
    roots = reps.select(F.posexplode("roots").alias("c", "v"), "id").select(F.xxhash64("c", "v").alias("node"), "id")
    sizes = stage(roots.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1").withColumn("size", F.col("n")), "node-sizes")
    level = stage(split_join(roots, sizes, ["node"], "n", reps.count() * ROOTS), "nodes")
    made, out, families, sigs, depth = [sizes, level], None, None, reps.select("id", "sig"), 0
    while True:
        done = level.filter(F.col("size") <= NODE).select("node", "id")
        out = done if out is None else out.unionByName(done)
        large = level.filter(F.col("size") > NODE).select("node", "id", "size")
        if not large.limit(1).count():
            break
        picks = F.array(*(F.pmod(F.xxhash64("node", F.lit(depth), F.lit(k)), F.lit(TOKENS)).cast("int") for k in range(BRANCHES)))
        grown = large.join(sigs, "id").withColumn("c", F.explode(F.array_distinct(picks)))
        child = F.xxhash64("node", "c", F.expr("substring(sig, c * 2 + 1, 2)"))
        grown = stage(grown.select(child.alias("node"), "id", F.col("node").alias("up"), F.col("size").alias("was")), "nodes")
        sizes = stage(grown.groupBy("node").agg(F.count("*").alias("n"), F.first("up").alias("up"), F.first("was").alias("was")), "node-sizes")
        dense = sizes.filter(F.col("n") > SHRINK * F.col("was") if depth < DEPTH else F.col("was") > 0)
        dense = stage(dense.select("up").distinct(), "dense")
        family = large.join(sized(dense, 8), F.col("node") == F.col("up"), "left_semi")
        families = family if families is None else families.unionByName(family)
        live = sizes.join(sized(dense, 8), "up", "left_anti").filter("n > 1").select("node", "n", F.col("n").alias("size"))
        level = stage(split_join(grown.select("node", "id"), live, ["node"], "n", grown.count()), "nodes")
        made += [grown, sizes, dense, level]
        depth += 1
    if families is not None:
        families = stage(families, "families")
        out = out.unionByName(_with_anchors(families))
    held = stage(out.join(sigs, "id"), "tree")
    unstage(*made)
    return held, families


def confirmed(links: DataFrame, sets: DataFrame) -> DataFrame:
    """The links (node, a, b) whose full sets are similar enough. Both frames are staged. A document may have any share of
    the links, as ties make stars of a family's forest: its set is repeated for shares of them."""
    total = links.count()
    for k in "ab":
        counted = links.groupBy(k).agg(F.count("*").alias("w"))
        wide = sets.select(F.col("id").alias(k), F.col("s").alias(f"s{k}")).join(counted, k)
        links = salted_join(links, wide, [k], "w", total, ["a", "b"])
    both = links.withColumn("i", F.size(F.array_intersect("sa", "sb")).cast("long"))
    return both.filter(100 * F.col("i") >= PERCENT * (F.size("sa") + F.size("sb") - F.col("i"))).select("node", "a", "b")


def _by_node(rows: DataFrame) -> DataFrame:
    return rows.repartition("node").sortWithinPartitions("node")


def _proposed(nodes: DataFrame) -> DataFrame:
    pairs = _by_node(nodes).mapInArrow(_propose, "node long, a long, b long")
    pairs = pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("node").alias("node"))
    return pairs.filter("a < b")


def _full_sets(docs: DataFrame, ids: DataFrame, reps: DataFrame) -> DataFrame:
    """Staged rows id, s: the whole sets of the classes of ids, from the texts of their smallest doc_ids."""
    ids = stage(ids.distinct().join(reps.select("id", F.col("top").alias("doc_id"), "n", "f1", "f2"), "id"), "linked")
    texts = docs.join(sized(ids.select("doc_id"), 16), "doc_id", "left_semi")
    schema = "doc_id long, n long, f1 long, f2 long, s array<long>"
    sets = texts.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_sets, schema).join(sized(ids, 48), ["doc_id", "n", "f1", "f2"])
    out = stage(sets.dropDuplicates(["id"]).select("id", "s"), "sets")
    unstage(ids)
    return out


def _second_round(docs: DataFrame, reps: DataFrame, nodes: DataFrame, families: DataFrame | None, labels: DataFrame) -> DataFrame | None:
    """Staged links between components that candidates of one node still make; None without any such candidates."""
    known = labels.select("id", F.col("component").alias("label"))
    named = lambda rows: rows.join(known, "id", "left").withColumn("label", F.coalesce("label", "id"))
    mixed = lambda rows: stage(rows.groupBy("node").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("node"), "mixed")
    # labels alone decide: a proposed link has the name of one of its nodes only, and any other may hold candidates it left out
    several = mixed(named(nodes.select("node", "id")))
    again = named(nodes.join(sized(several, 8), "node", "left_semi")).select("node", "id", "label", "sig")
    if families is not None:
        family = named(families)
        torn = mixed(family)
        family = stage(family.join(sized(torn, 8), "node", "left_semi").withColumn("w", F.lit(1).cast("long")), "torn")
        again = again.unionByName(_block_pairs(family, NODE).join(reps.select("id", "sig"), "id").select("node", "id", "label", "sig"))
    left = stage(_by_node(again).mapInArrow(_open, "node long, id long"), "open")
    extra = None
    if left.limit(1).count():
        wide = _full_sets(docs, left.select("id"), reps)
        weighed = left.join(reps.select("id", F.col("n").alias("w")), "id")
        large = stage(weighed.groupBy("node").agg(F.sum("w").alias("w")).filter(F.col("w") > HELD).select("node"), "large")
        dealt = stage(named(weighed), "open")
        some = sized(large, 8)
        both = dealt.join(some, "node", "left_anti").select("node", "id", "label").unionByName(_block_pairs(dealt.join(some, "node", "left_semi"), HELD))
        extra = stage(_by_node(both.join(wide, "id")).mapInArrow(_verify, "node long, a long, b long"), "confirmed")
        unstage(wide, dealt, large)
    unstage(several, left)
    return extra


def _same_id(found: DataFrame, reps: DataFrame, total: int) -> DataFrame | None:
    """Staged links (node, a, b) of the classes that rows of one doc_id are in, each with the least of them; None without any."""
    key = ["n", "f1", "f2"]
    rows = found.filter("n > 0 and doc_id is not null").select("doc_id", *key)
    torn = rows.groupBy("doc_id").agg(F.min(F.struct(*key)).alias("lo"), F.max(F.struct(*key)).alias("hi"), F.count("*").alias("w"))
    torn = stage(torn.filter("lo < hi").select("doc_id", "lo", "w"), "shared-ids")
    if not torn.limit(1).count():
        unstage(torn)
        return None
    pairs = split_join(rows, torn, ["doc_id"], "w", total).select(*key, *(F.col(f"lo.{c}").alias(f"{c}_0") for c in key))
    pairs = stage(pairs.filter("not (n = n_0 and f1 = f1_0 and f2 = f2_0)").distinct().join(reps.select(F.col("id").alias("a"), *key), key), "shared-pairs")
    least = [f"{c}_0" for c in key]
    centres = pairs.groupBy(*least).agg(F.count("*").alias("w")).join(reps.select(F.col("id").alias("b"), *(F.col(c).alias(f"{c}_0") for c in key)), least)
    out = stage(split_join(pairs.select("a", *least), stage(centres, "centres"), least, "w", total).select(F.col("a").alias("node"), "a", "b"), "shared-links")
    unstage(torn, pairs)
    return out


def _component_ids(reps: DataFrame, labels: DataFrame) -> DataFrame:
    """id, component_id (the smallest doc_id of the component) for the classes that have links. A component may hold any
    share of them."""
    members = labels.unionByName(labels.select(F.col("component").alias("id"), "component").distinct())
    members = stage(members.join(reps.select("id", "top"), "id"), "members")
    least = stage(members.groupBy("component").agg(F.min("top").alias("component_id"), F.count("*").alias("w")), "least-ids")
    return split_join(members.select("id", "component"), least, ["component"], "w", members.count()).select("id", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, __rid (hash of the text), n_shingles, component_id, kept for every row of docs."""
    docs = docs.select("doc_id", "text")
    schema = "doc_id long, __rid long, n long, f1 long, f2 long, roots array<long>, sig binary"
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("__rid"), "text").mapInArrow(_features, schema)
    found = stage(found, "features")
    total, key = found.count(), ["n", "f1", "f2"]
    classes = found.filter("n > 0").groupBy(*key).agg(
        F.min("doc_id").alias("top"), F.count("*").alias("copies"), F.first("roots").alias("roots"), F.first("sig").alias("sig")
    )
    # numbered as written, so a number stays with its class whatever is run again
    classes = stage(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    reps = classes.filter("top is not null")
    nodes, families = tree_nodes(reps)
    links = stage(_proposed(nodes), "proposed")
    sets = _full_sets(docs, links.select(F.explode(F.array("a", "b")).alias("id")), reps)
    good = stage(confirmed(links, sets), "confirmed")
    shared = _same_id(found, reps, total)
    if shared is not None:
        good = good.unionByName(shared)
    labels = components(good, "node")
    extra = _second_round(docs, reps, nodes, families, labels)
    if extra is not None and extra.limit(1).count():
        labels = components(good.unionByName(extra), "node")
    unstage(nodes, sets)
    named = classes.select(*key, "id", "top", "copies").join(_component_ids(reps, labels), "id", "left")
    named = stage(named.select(*key, F.coalesce("component_id", "top").alias("component_id"), "copies"), "named")
    rows = found.select("doc_id", "__rid", *key)
    out = split_join(rows.filter("n > 0"), named, key, "copies", total)
    out = out.unionByName(rows.filter("n = 0").withColumn("component_id", F.col("doc_id")))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return out.select("doc_id", "__rid", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def near_dedup(docs: DataFrame) -> DataFrame:
    """docs without the rows that are not kept."""
    gone = stage(near_duplicates(docs).filter(~F.col("kept")).select(F.col("doc_id").alias("__id"), F.col("__rid").alias("__r")).distinct(), "gone")
    cond = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__r"))
    return docs.join(sized(gone, 24), cond, "left_anti")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


QUERIES = {"op2_minhash": op2_minhash}
