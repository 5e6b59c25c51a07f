"""Sharding by vector bin packing over bytes, tokens and rows.

Documents of equal text are a group. Groups larger than a share of a cell are placed as they are (in parts, if one is
larger than PART of a shard); the others are dealt over CELLS cells by their text's hash, so that copies stay together,
and a cell is placed as one group. So no more than CELLS + HOT_KEYS * parts groups are placed, one after another from the
largest down, each where the dot product of its vector with the shard's residual capacity is highest among the shards
that have the most room for its bytes left. Slots are ranks within a cell, behind the slots of the shard's cells before
it: no window holds more than a cell.

Law `bytes`: the shards' sizes are near equal; tokens and rows are balanced as far as that allows.

Results for odd input: a null text has 1 byte (the one that every document adds) and its own group, apart from the empty
text; its crc32 is that of no bytes, 0. Rows of one doc_id and null doc_ids are documents like others. A very long text
is placed whole, and a shard holds at least that; its bytes are measured without keeping it. An empty table gives an empty
result. Other columns pass through, whatever their names; columns made here start with two underscores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import HOT_KEYS, n_words, stage, text_hashes

SHARDS, CELLS = 16, 4096
#: A group of copies that holds more than this part of a shard is split: else the sizes could not be near equal.
PART = 0.8


def place(items: list[tuple], shards: int) -> dict:
    """items: (name, bytes, tokens, rows). name: shard. The targets are equal shares of each; bytes decide which shards
    are open to an item (those within its own size of the most room), the dot product which of them takes it."""
    totals = [max(1.0, float(sum(x[k] for x in items))) for k in (1, 2, 3)]
    room = [[1.0 / shards] * 3 for _ in range(shards)]
    out = {}
    for name, *sizes in sorted(items, key=lambda x: (-x[1], str(x[0]))):
        v = [s / t for s, t in zip(sizes, totals, strict=True)]
        most = max(r[0] for r in room)
        open_ = [i for i in range(shards) if room[i][0] >= most - v[0]]
        best = max(open_, key=lambda i: (sum(a * b for a, b in zip(v, room[i], strict=True)), -i))
        room[best] = [a - b for a, b in zip(room[best], v, strict=True)]
        out[name] = best
    return out


def assign_shards(docs: DataFrame, shards: int = SHARDS, cells: int = CELLS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, __t1, __t2 (the text's hashes), size, text_crc32, shard, slot for every row of docs."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = stage(
        docs.select(
            F.col(doc_id).alias("doc_id"), *text_hashes(F.col(text)), (F.octet_length(body) + 1).cast("long").alias("size"),
            n_words(F.col(text)).alias("tokens"), F.crc32(body).alias("text_crc32"),
        ),
        "shard-rows",
    )
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    # groups over a HOT_KEYS-th of all bytes or rows: fewer than 2 * HOT_KEYS, whatever the data
    heavy = rows.groupBy("__t1", "__t2").agg(F.sum("size").alias("b"), F.count("*").alias("r"))
    heavy = heavy.filter((F.col("b") > total / HOT_KEYS) | (F.col("r") > max(n / HOT_KEYS, 1)))
    part = max(1, int(total * PART / shards))
    # parts by size; and cells of a part, for the slots, by rows
    parts = F.greatest(F.ceil(F.col("b") / part), F.lit(1)).cast("int")
    subs = F.ceil(F.col("r") / max(1, n // cells)).cast("int")
    heavy = stage(heavy.select("__t1", "__t2", parts.alias("__parts"), subs.alias("__subs")), "shard-heavy")
    mine = F.xxhash64(F.lit(3), "doc_id")
    cell = F.when(F.col("__parts").isNull(), F.pmod("__t1", F.lit(cells))).otherwise(F.xxhash64("__t1", "__t2"))
    rows = rows.join(F.broadcast(heavy), ["__t1", "__t2"], "left")
    rows = rows.withColumns(
        {
            "__cell": cell,
            "__part": F.when(F.col("__parts").isNull(), F.lit(-1)).otherwise(F.pmod(mine, F.col("__parts"))).cast("int"),
            "__sub": F.when(F.col("__parts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(mine), F.greatest(F.ceil(F.col("__subs") / F.col("__parts")), F.lit(1)))).cast("int"),
        }
    ).drop("__parts", "__subs")
    loads = rows.groupBy("__cell", "__part", "__sub").agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("r")).collect()
    items: dict[tuple, list[int]] = {}
    for x in loads:  # at most cells + the heavy groups' parts and cells, which their shares bound
        got = items.setdefault((x["__cell"], x["__part"]), [0, 0, 0])
        for k, c in enumerate("btr"):
            got[k] += x[c]
    shard_of = place([(name, *v) for name, v in items.items()], shards)
    ends, placed = [0] * shards, []
    for x in sorted(loads, key=lambda x: (x["__part"], x["__cell"], x["__sub"])):
        s = shard_of[x["__cell"], x["__part"]]
        placed.append((x["__cell"], x["__part"], x["__sub"], s, ends[s]))
        ends[s] += x["r"]
    table = spark.createDataFrame(placed, "__cell long, __part int, __sub int, shard int, __before long")
    rank = Window.partitionBy("__cell", "__part", "__sub").orderBy("doc_id", "__t1", "__t2")
    out = rows.withColumn("__rank", F.row_number().over(rank)).join(F.broadcast(table), ["__cell", "__part", "__sub"])
    return out.select("doc_id", "__t1", "__t2", "size", "text_crc32", "shard", (F.col("__before") + F.col("__rank") - 1).alias("slot"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op4_sharding": op4_sharding}
