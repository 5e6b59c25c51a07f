"""Line dedup over levelled sorted runs of line hashes. DataFrame functions only.

A run is a bucketed table sorted by the 128-bit hash of a line's key, with the number of documents that hold the line
and the largest id among them. Each batch of documents becomes a run of level 0; keys that an anti-join with the older
runs finds settled there (enough documents, and no smaller id) are left out of it. Once a level has `fanout` runs they
are merged into one of the next level. Counts add up and ids take the maximum, so the order of batches does not matter.
At the end the lines are merge-joined with the runs, and those that stand repeated elsewhere go. A batch is a share of the
input's splits, of about BATCH_DOCS documents, and there are BATCHES at least, so the more input, the more batches and
levels. SortedRuns takes batches that arrive one by one just as well.

Results for odd input: a null or empty text is one empty line, which stays. Every row counts as a document, so repeated
rows of one doc_id count each; both keep their lines if theirs is the largest id. A null doc_id is never the largest;
a key that only rows with null ids hold stays in all of them. Very long texts are split whole: a row's lines are in
memory at once, and no line is cut. An empty table gives an empty result. Other columns pass through, whatever their
names; columns made here start with two underscores.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import WHITE, ascii_lower, delete, new_path, sized, split_join, stage, unstage

LEAST_CHARS, LEAST_DOCS = 20, 3
BATCHES, BATCH_DOCS, FANOUT = 4, 50_000_000, 4
KEY = ["h1", "h2"]
RUN = "h1 long, h2 long, n long, top long"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


class SortedRuns:
    """The levelled store. merged() has a row h1, h2, n, top for each key that was not settled when a batch brought it."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = FANOUT, least_docs: int = LEAST_DOCS):
        self.spark, self.fanout, self.least_docs = spark, fanout, least_docs
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self.paths: dict[str, str] = {}

    def _write(self, df: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = new_path(self.spark, "line-run")
        dealt = df.select(*KEY, "n", "top").repartition(self.buckets, *KEY)
        dealt.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", self.paths[name]).saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        delete(self.spark, self.paths.pop(name))

    def runs(self) -> list[str]:
        return [x for level in self.levels for x in level]

    def absorb(self, keyed: DataFrame) -> None:
        """Adds a batch of rows h1, h2, doc_id, one for each document and distinct key."""
        fresh = keyed.groupBy(*KEY).agg(F.count("*").alias("n"), F.max(F.col("doc_id").cast("long")).alias("top"))
        for name in self.runs():
            old = self.spark.table(name).filter(F.col("n") >= self.least_docs).select(*KEY, F.col("top").alias("__top"))
            fresh = fresh.join(old, [*(fresh[k] == old[k] for k in KEY), old["__top"] >= F.coalesce(fresh["top"], old["__top"])], "left_anti")
        self.levels[0].append(self._write(fresh))
        self._compact()

    def _compact(self) -> None:
        for k, level in enumerate(self.levels):
            if len(level) >= self.fanout:
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(self._write(self._sum(level)))
                self.levels[k] = []
                for name in level:
                    self._drop(name)

    def _sum(self, names: list[str]) -> DataFrame:
        # the runs' files, not the bucketed tables: a union of those counts as partitioned by the key even where Spark
        # then reads them unbucketed (SPARK 4.1), and the sums would be of single runs
        both = self.spark.read.schema(RUN).parquet(*(self.paths[name] for name in names))
        return both.groupBy(*KEY).agg(F.sum("n").alias("n"), F.max("top").alias("top"))

    def merged(self) -> DataFrame:
        names = self.runs()
        return self.spark.table(names[0]) if len(names) == 1 else self._sum(names)

    def repeated(self) -> DataFrame:
        """h1, h2, top of the keys that enough documents hold."""
        return self.merged().filter(F.col("n") >= self.least_docs).select(*KEY, "top")

    def close(self) -> None:
        for name in self.runs():
            self._drop(name)
        self.levels = [[]]


def keyed_lines(docs: DataFrame, batches: int, least_chars: int) -> DataFrame:
    """Rows doc_id, __rid, h1, h2, pos, batch for every line whose key is long enough; first: the document's first of
    that key (the lines are sorted within their row for it, so nothing is shuffled)."""
    key = F.transform(lines_of(F.col("text")), lambda x, i: F.struct(line_key(x).alias("key"), i.alias("pos")))
    rows = docs.select("doc_id", F.xxhash64("text").alias("__rid"), F.filter(key, lambda x: F.length(x.key) >= least_chars).alias("k"))
    rows = rows.filter(F.size("k") > 0).withColumn(
        "a",
        F.sort_array(F.transform("k", lambda x: F.struct(F.xxhash64(x.key).alias("h1"), F.xxhash64(F.lit("b"), x.key).alias("h2"), x.pos.alias("pos")))),
    )
    flagged = F.expr(
        "transform(a, (x, i) -> struct(x.h1 as h1, x.h2 as h2, x.pos as pos,"
        " i = 0 or a[greatest(i - 1, 0)].h1 <> x.h1 or a[greatest(i - 1, 0)].h2 <> x.h2 as first))"
    )
    # a split's documents go to BATCHES batches next to each other, so there are few files
    batch = F.pmod(F.spark_partition_id() + F.pmod(F.xxhash64(F.lit(5), "doc_id", "__rid"), F.lit(BATCHES)), F.lit(batches)).cast("int")
    return rows.select("doc_id", "__rid", F.explode(flagged).alias("x"), batch.alias("batch")).select("doc_id", "__rid", "x.*", "batch")


def dropped_lines(docs: DataFrame, batches: int | None = None, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, fanout: int = FANOUT) -> DataFrame:
    """Staged rows doc_id, __rid, __gone: positions, from 0, of the lines that a document loses; none for most documents."""
    batches = batches or max(BATCHES, -(-docs.count() // BATCH_DOCS))
    lines = stage(keyed_lines(docs, batches, least_chars), "lines", "batch")
    store = SortedRuns(docs.sparkSession, fanout=fanout, least_docs=least_docs)
    for b in range(batches):
        store.absorb(lines.filter((F.col("batch") == b) & F.col("first")))
    # a key's number of lines decides how it is joined, not whether
    weights = lines.groupBy(*KEY).agg(F.count("*").alias("n"))
    repeated = stage(store.repeated().join(weights, KEY), "repeated")
    store.close()
    hit = split_join(lines.select("doc_id", "__rid", "pos", *KEY), repeated, KEY, "n", lines.count())
    gone = hit.filter(~F.col("doc_id").eqNullSafe(F.col("top")))
    out = stage(gone.groupBy("doc_id", "__rid").agg(F.collect_set("pos").alias("__gone")), "gone-lines")
    unstage(lines, repeated)
    return out


def dedup_lines(docs: DataFrame, **limits: int) -> DataFrame:
    """docs with text without its dropped lines, and __n_lines, __n_dropped. A text that keeps all lines is untouched,
    a null one too."""
    gone = dropped_lines(docs, **limits)
    small = sized(gone.select(F.col("doc_id").alias("__id"), F.col("__rid").alias("__r"), "__gone"), 48 + 8 * F.size("__gone"))
    keyed = docs.withColumn("__rid", F.xxhash64("text"))
    both = keyed.join(small, F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("__rid").eqNullSafe(F.col("__r")), "left")
    both = both.withColumn("__l", lines_of(F.col("text")))
    stay = F.expr("transform(array_except(sequence(0, size(__l) - 1), __gone), i -> __l[i])")
    both = both.withColumns(
        {
            "text": F.when(F.col("__gone").isNotNull(), F.array_join(stay, "\n")).otherwise(F.col("text")),
            "__n_lines": F.size("__l").cast("long"),
            "__n_dropped": F.coalesce(F.size("__gone"), F.lit(0)).cast("long"),
        }
    )
    return both.select(*docs.columns, "__n_lines", "__n_dropped")


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = dedup_lines(docs)
    return out.select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


QUERIES = {"op5_lines": op5_lines}
SQL = {
    "op5_lines": r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
l AS (
  SELECT row, doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS pos FROM d),
k AS (
  SELECT row, doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (
  SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT row) >= 3),
m AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM f.top AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY row, doc_id"""
}
