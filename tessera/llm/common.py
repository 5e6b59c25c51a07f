"""What the training-data operators share: scratch tables, row keys, joins that survive hot keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of every contract: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A table goes to every executor only if its rows, counted first, take no more than this.
BROADCAST_BYTES = 32 << 20
#: At most so many keys can each hold more than 1/HOT_KEYS of all rows; those are the hot ones.
HOT_KEYS = 1024
WAVES = 8


def scratch(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Where that is unset a local master gets a temporary folder, as in tests;
    a cluster must name one, since no folder of one machine is seen by all of it."""
    return (spark.conf.get("spark.checkpoint.dir", None) or _own_dir(spark)).rstrip("/")


def _own_dir(spark: SparkSession) -> str:
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    found = getattr(spark, "_tessera_scratch", None)
    if not found:
        found = spark._tessera_scratch = "file://" + tempfile.mkdtemp(prefix="tessera-")
    return found


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stage(df: DataFrame, name: str, *folders: str) -> DataFrame:
    """The rows as a written table in the shared folder: lineage ends here and a lost executor loses nothing.

    More tasks than WAVES for each core would only make more files, so partitions are joined, without a shuffle, down to
    that number; not where executors come and go, since the cores of the moment say nothing there. The frame has the
    folder as `staged_at`, for unstage(). folders: columns by whose values the table is cut into folders.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") != "true":
        df = df.coalesce(WAVES * spark.sparkContext.defaultParallelism)
    (df.write.partitionBy(*folders) if folders else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def unstage(*frames: DataFrame) -> None:
    """Deletes staged tables that no returned frame reads."""
    for df in frames:
        delete(df.sparkSession, df.staged_at)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text as an array; of a null text none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), WHITE, " " * len(WHITE))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def n_words(text: Column) -> Column:
    """The number of words, without keeping them."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text modulo 5 is 0; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def text_hashes(text: Column, prefix: str = "__t") -> list[Column]:
    """128 bits of a text, as two longs; a null text hashes as null does, apart from the empty one."""
    return [F.xxhash64(F.lit(17), text.isNull(), text).alias(f"{prefix}1"), F.xxhash64(F.lit("b"), text).alias(f"{prefix}2")]


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def sized(df: DataFrame, row_bytes: int | Column) -> DataFrame:
    """The frame with a broadcast hint if its bytes, summed now, fit BROADCAST_BYTES; else as it is, for a shuffle join.

    row_bytes: of a row, as a number or as a column of df. df must be cheap to read twice (a staged table).
    """
    each = F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes
    total = df.agg(F.coalesce(F.sum(each.cast("long")), F.lit(0))).first()[0]
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def split_join(rows: DataFrame, table: DataFrame, keys: Sequence[str], weight: str, total: int, how: str = "inner") -> DataFrame:
    """rows joined with a narrow table that has each key once, whatever share of the rows one key holds.

    weight: the table's column with the number of rows that have the key. Fewer than HOT_KEYS keys can hold more than
    total / HOT_KEYS rows each, so those are broadcast; no other key can make a partition of a shuffle join lopsided.
    Both frames are read twice: staged tables, or cheap ones. The weight column is not returned.
    """
    most = max(total // HOT_KEYS, 1)
    keys = list(keys)
    hot = F.broadcast(table.filter(F.col(weight) > most).drop(weight))
    cold = table.filter(F.col(weight) <= most).drop(weight)
    return rows.join(hot, keys, "inner").unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(cold, keys, how))


def salted_join(rows: DataFrame, table: DataFrame, keys: Sequence[str], weight: str, total: int, by: Sequence[str]) -> DataFrame:
    """The same for a table of wide rows, which are never broadcast: a key of more than total / HOT_KEYS rows is dealt over
    as many salts as it has such shares, by the columns `by` of rows, and its wide row is repeated for each. That makes
    no more than HOT_KEYS + 1 further rows in all. Only keys and salts of the hot ones, fewer than HOT_KEYS, go everywhere.
    """
    most = max(total // HOT_KEYS, 1)
    keys = list(keys)
    salts = F.ceil(F.col(weight) / most).cast("int")
    hot = F.broadcast(table.filter(F.col(weight) > most).select(*keys, salts.alias("__salts")))
    mine = F.pmod(F.xxhash64(F.lit(29), *by), F.coalesce("__salts", F.lit(1))).cast("int")
    dealt = rows.join(hot, keys, "left").withColumn("__salt", mine).drop("__salts")
    wide = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.greatest(salts, F.lit(1)) - 1))).drop(weight)
    return dealt.join(wide, [*keys, "__salt"]).drop("__salt")
