"""Ranked lexical search with Fagin's threshold algorithm over shards of documents.

One pass over the texts keeps, of each document, its number of terms and the terms that any query has with their
occurrences: the forward index, a written table. From it come the counts that scores need (N, L, and df of each term), over
all documents. A shard is a part of the forward index of about SHARD entries, held by one task, which sorts the entries of
each term by impact, largest first. Every query then goes down its terms' lists round by round, a longer step each time;
documents met there for the first time are looked up in the forward index for their whole scores (random access). A query
stops in a shard when its threshold, the sum of the impacts that its lists have come to, falls strictly below its k-th
score so far: no document not yet met can reach it, and all that tie with it have been met. The best k of all shards are
merged in two steps.

The terms of the queries go to every task. They are counted first: queries are taken in blocks whose terms fit
BROADCAST_BYTES, one pass over the texts a block.

Results for odd input: a null or empty text, or one without a term, is no document: it counts in nothing. A null doc_id is
an id like others, before all of them in ties. Rows of one doc_id are documents each on its own, and may take several
ranks. A query whose text is null or has no term, or whose terms no document has, has no row, and a null item_id takes no
part; rows of one item_id are one query with the terms of all. Long texts are read whole. An empty table of either kind
gives an empty result. Other columns are not used or returned.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import BROADCAST_BYTES, ascii_lower, stage, unstage

TOP = 50
#: The score's fixed values: its scale, the weight of tf, the share of length in percent, and the weight of length.
SCALE, BY_TF, LENGTH, BY_LENGTH = 1_000_000_000, 1000, 50, 20
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: Entries of a shard (each about 40 bytes while it is searched) and positions of the first round.
SHARD, STEP = 4_000_000, 64
SALTS = 64
FORWARD = "doc_id long, n long, terms array<int>, counts array<int>"
#: Bytes of ASCII that stand in no term become blanks, and A to Z a to z.
_CLEAN = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def query_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Staged item_id, term: once each."""
    found = F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text), F.lit(""))), F.lit(TERM), F.lit(0))
    terms = items.filter(F.col(item_id).isNotNull()).select(F.col(item_id).cast("long").alias("item_id"), F.explode(found).alias("term"))
    return stage(terms.distinct(), "query-terms")


def blocks(terms: DataFrame, most: int = BROADCAST_BYTES) -> list[DataFrame]:
    """The queries in blocks of neighbouring ids whose terms take `most` bytes at most; a single larger query is one of its own."""
    sizes = terms.groupBy("item_id").agg(F.sum(F.octet_length("term") + 60).alias("b"))
    if (sizes.agg(F.sum("b")).first()[0] or 0) <= most:
        return [terms]
    # sums up to each query, in ranges of ids, so that no task sorts all of them
    ranged = stage(sizes.repartitionByRange("item_id").sortWithinPartitions("item_id").withColumn("p", F.spark_partition_id()), "query-sizes")
    parts = sorted(tuple(r) for r in ranged.groupBy("p").agg(F.sum("b")).collect())
    ahead, before = 0, {}
    for p, b in parts:
        before[p], ahead = ahead, ahead + b
    start = F.create_map(*(F.lit(x) for pair in before.items() for x in pair))
    so_far = F.sum("b").over(Window.partitionBy("p").orderBy("item_id")) + start[F.col("p")]
    block = F.floor((so_far - F.col("b")) / F.lit(max(1, most // 2))).cast("long")
    marked = stage(ranged.select("item_id", block.alias("block")), "query-blocks")
    found = sorted(r[0] for r in marked.select("block").distinct().collect())
    return [terms.join(marked.filter(F.col("block") == b).select("item_id"), "item_id", "left_semi") for b in found]


def _forward(vocabulary):
    def index(batches):
        number = {t.encode(): k for k, t in enumerate(vocabulary.value)}
        for batch in batches:
            doc, n, terms, counts, ends = [], [], [], [], [0]
            for k, text in enumerate(batch.column("text")):
                raw = text.as_py()
                words = raw.encode().translate(_CLEAN).split() if raw else ()
                if words:
                    held = Counter(map(number.get, words))
                    held.pop(None, None)
                    doc.append(batch.column("doc_id")[k].as_py())
                    n.append(len(words))
                    terms.extend(held)
                    counts.extend(held.values())
                    ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(c, pa.int32())) for c in (terms, counts)]
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"])

    return index


class Shard:
    """The forward index of some documents and, for each term, its entries by falling impact.

    docs: rows; starts: where a row's entries begin; terms, counts: entries. weight: of each term, by number. sizes: a row's
    n. sorted_reads and random_reads count what the searches took.
    """

    def __init__(self, starts: np.ndarray, terms: np.ndarray, counts: np.ndarray, sizes: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int):
        self.starts, self.terms, self.lengths = starts, terms, np.diff(starts)
        length = 100 - LENGTH + (LENGTH * sizes.astype(np.int64) * n_docs) // n_terms
        tf = counts.astype(np.int64)
        owner = np.repeat(np.arange(len(sizes), dtype=np.int32), self.lengths)
        self.impact = weight[terms] * ((SCALE * tf) // (BY_TF * tf + BY_LENGTH * length[owner]))
        order = np.lexsort((-self.impact, terms))
        self.by_impact, self.doc = self.impact[order], owner[order]
        self.lists = np.searchsorted(terms[order], np.arange(len(weight) + 1))
        self.sorted_reads = self.random_reads = 0

    def whole(self, docs: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Random access: the scores of documents for the terms that are wanted."""
        self.random_reads += len(docs)
        n = self.lengths[docs]
        at = np.repeat(self.starts[docs] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.add.reduceat(self.impact[at] * wanted[self.terms[at]], np.cumsum(n) - n)

    def search(self, query: np.ndarray, k: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the k best documents above 0, ties by ids (rows' places in ascending order of id)."""
        begin, end = self.lists[query], self.lists[query + 1]
        begin, end = begin[end > begin], end[end > begin]
        wanted = np.zeros(len(self.lists) - 1, np.int64)
        wanted[query] = 1
        seen = np.zeros(len(self.lengths), bool)
        best, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        depth, step = 0, max(STEP, k // max(1, len(begin)))
        while True:
            low, high = np.minimum(begin + depth, end), np.minimum(begin + depth + step, end)
            n = high - low
            if not n.sum():
                break
            self.sorted_reads += int(n.sum())
            at = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            met = np.unique(self.doc[at])
            met = met[~seen[met]]
            if len(met):
                seen[met] = True
                best, scores = np.concatenate([best, met]), np.concatenate([scores, self.whole(met, wanted)])
                chosen = np.lexsort((ids[best], -scores))[:k]
                best, scores = best[chosen], scores[chosen]
            # a list that has ended has nothing left to give
            threshold = int(self.by_impact[high[high < end] - 1].sum())
            if len(best) == k and threshold < scores[-1]:
                break
            depth, step = depth + step, step * 2
        able = scores > 0
        return best[able], scores[able]


def _searcher(queries, weights, n_docs: int, n_terms: int, k: int, entries: int):
    def search(batches):
        items, weight = queries.value, weights.value

        def answer(held):
            tables = pa.Table.from_batches(held).combine_chunks()
            terms, counts = (tables[c].combine_chunks() for c in ("terms", "counts"))
            terms, counts = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (terms, counts))
            starts = terms.offsets.to_numpy().astype(np.int64)
            shard = Shard(starts - starts[0], terms.flatten().to_numpy(), counts.flatten().to_numpy(), tables["n"].to_numpy(), weight, n_docs, n_terms)
            doc = tables["doc_id"].combine_chunks()
            ids, null = doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False)
            place = np.empty(len(ids), np.int64)
            place[np.lexsort((ids, ~null))] = np.arange(len(ids))
            for item, query in items:
                rows, scores = shard.search(query, k, place)
                if len(rows):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), item, np.int64)), doc.take(pa.array(rows)), pa.array(scores)], names=["item_id", "doc_id", "score"])

        held, n = [], 0
        for batch in batches:
            batch = batch.filter(pc.greater(pc.list_value_length(batch.column("terms")), 0))
            while batch.num_rows:
                sizes = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy())
                cut = min(int(np.searchsorted(sizes, entries - n)) + 1, len(sizes))
                held.append(batch.slice(0, cut))
                n += int(sizes[cut - 1])
                batch = batch.slice(cut)
                if n >= entries:
                    yield from answer(held)
                    held, n = [], 0
        if held:
            yield from answer(held)

    return search


def _block(docs: DataFrame, terms: DataFrame, k: int, entries: int) -> DataFrame:
    """Staged item_id, doc_id, score: the best k of each shard for the queries of one block."""
    spark = docs.sparkSession
    asked = terms.select("item_id", "term").collect()  # counted: see blocks()
    names = sorted({t for _, t in asked})
    number = {t: i for i, t in enumerate(names)}
    queries: dict[int, list[int]] = {}
    for item, t in asked:
        queries.setdefault(item, []).append(number[t])
    vocabulary = spark.sparkContext.broadcast(names)
    forward = stage(docs.mapInArrow(_forward(vocabulary), FORWARD), "forward")
    n_docs, n_terms = forward.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # a row for each term of the block, so as many as the vocabulary that was counted
    df = forward.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df"))
    w = F.floor(F.lit(1000) * F.log((F.lit(2.0) * n_docs + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("long")
    weight = np.zeros(len(names), np.int64)
    for t, x in df.select("t", w).collect():
        weight[t] = x
    shared = spark.sparkContext.broadcast([(item, np.array(sorted(q), np.int64)) for item, q in sorted(queries.items())])
    weights = spark.sparkContext.broadcast(weight)
    found = stage(forward.mapInArrow(_searcher(shared, weights, n_docs, n_terms, k, entries), "item_id long, doc_id long, score long"), "found")
    unstage(forward)
    return found


def search(docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", query: str = "text", entries: int = SHARD, block_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: each query's k best documents with a score above 0."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    terms = query_terms(items, item_id, query)
    found = None
    for block in blocks(terms, block_bytes):
        part = _block(rows, block, k, entries)
        found = found.unionByName(part) if found is not None else part
    # many shards give k rows each, so the best of each part come first
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    salt = F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS))
    part = found.withColumn("__part", salt).withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "__part").orderBy(*order))).filter(F.col("rank") <= k)
    best = part.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).filter(F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"op11_lexical": op11_lexical}
SQL = {
    "op11_lexical": """
WITH lowered AS (SELECT row_number() OVER () AS r, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
words AS (SELECT r, doc_id, unnest(regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM lowered),
tf AS MATERIALIZED (SELECT r, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS MATERIALIZED (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
totals AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM sizes),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL),
df AS MATERIALIZED (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM asked) GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * nd + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w FROM df, totals),
parts AS MATERIALIZED (SELECT tf.r, tf.doc_id, tf.term, w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (100 - 50 + (50 * s.n * t.nd) // t.nt))) AS part
  FROM tf JOIN w ON w.term = tf.term JOIN sizes s ON s.r = tf.r, totals t),
scores AS (SELECT a.item_id, p.r, p.doc_id, CAST(sum(p.part) AS BIGINT) AS score FROM asked a JOIN parts p ON p.term = a.term GROUP BY ALL HAVING sum(p.part) > 0),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score FROM scores)
SELECT * FROM ranked WHERE rank <= 50"""
}
