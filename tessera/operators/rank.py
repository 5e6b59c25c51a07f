"""Order-dependent selections: round-robin packs, even samples, top-k, ids, shards."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import slugify
from tessera.sources.scratch import written


#: Groups that are known to have at most so many rows are sorted by one task each.
ONE_TASK = 1_000_000


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str | Column], name: str = "position", total: str | None = None, most: int | None = None) -> DataFrame:
    """rows with their number from 1 in their group, and with `total` the group's rows: row_number() for groups of any size.

    Rows are dealt by ranges of group and order and written, so a group is as many sorted parts as it needs and no task
    holds all of a large one; the parts are counted, and a row's number is its place in its part after the parts before. A
    caller who knows that no group has more than ONE_TASK rows says so (most) and gets a window. The order must be total
    for the numbers to be the same each time.
    """
    if most is not None and most <= ONE_TASK:
        g = Window.partitionBy(*group)
        return rows.withColumns({name: F.row_number().over(g.orderBy(*order)).cast("long")} | ({total: F.count("*").over(g)} if total else {}))
    dealt = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    table = written(dealt.withColumn("__num_id", F.monotonically_increasing_id()), "numbered").withColumn("__num_part", F.shiftright("__num_id", 33))
    counted = table.groupBy(*(F.col(c).alias(f"__num_g{k}") for k, c in enumerate(group)), F.col("__num_part").alias("__num_p")).agg(F.min("__num_id").alias("__num_first"), F.count("*").alias("__num_n"))
    w = Window.partitionBy(*(f"__num_g{k}" for k in range(len(group))))
    before = F.coalesce(F.sum("__num_n").over(w.orderBy("__num_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = counted.select("*", before.alias("__num_before"), F.sum("__num_n").over(w).alias("__num_all"))
    same = F.col("__num_part") == F.col("__num_p")
    for k, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"__num_g{k}"))
    new = [(F.col("__num_id") - F.col("__num_first") + F.col("__num_before") + 1).alias(name)] + ([F.col("__num_all").alias(total)] if total else [])
    return table.join(counted, same).select(*rows.columns, *new)


def round_robin(rows: DataFrame, group: Sequence[str], buckets: Sequence[str], order: Sequence[str], name: str = "position") -> DataFrame:
    """Numbers a group's rows from 1 so that each pass takes one row of each bucket, in the buckets' order."""
    turn = F.row_number().over(Window.partitionBy(*group, *buckets).orderBy(*order))
    out = rows.withColumn("__turn", turn)
    return out.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy("__turn", *buckets, *order))).drop("__turn")


def packs(rows: DataFrame, kinds: dict[str, Sequence[str]], item: str, buckets: Sequence[str], order: Sequence[str], size: int = 100, least: int = 5) -> DataFrame:
    """kind, key (array), count, first_year, last_year, items (ordered array) for every group of every kind that has least
    rows; rows with a null in a kind's columns have no group there. The first bucket but one is the year. One pass: a row
    is exploded into its kinds."""
    parts = F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(n).alias("kind_no"), F.array(*(F.col(c).cast("string") for c in cols)).alias("key")) for n, (k, cols) in enumerate(kinds.items())))
    grown = rows.withColumn("__k", F.explode(parts)).select("*", "__k.kind", "__k.kind_no", "__k.key").filter(~F.exists("key", lambda v: v.isNull()))
    held = grown.groupBy("kind", "key").agg(F.count("*").alias("__n")).filter(F.col("__n") >= least).select("kind", "key")
    if size:
        # a row's position is its turn at least, so later turns go before a group's rows meet
        turn = F.row_number().over(Window.partitionBy("kind", "key", *buckets).orderBy(*order))
        grown = grown.withColumn("__turn", turn).filter(F.col("__turn") <= size).drop("__turn")
    chosen = round_robin(grown.join(held, ["kind", "key"], "left_semi"), ["kind", "key"], buckets, order)
    chosen = chosen.filter(F.col("position") <= size) if size else chosen
    year = F.col(buckets[1] if len(buckets) > 1 else buckets[0])
    out = chosen.groupBy("kind", "kind_no", "key").agg(
        F.count("*").cast("int").alias("count"), F.min(year).alias("first_year"), F.max(year).alias("last_year"),
        F.transform(F.array_sort(F.collect_list(F.struct("position", F.col(item).alias("i")))), lambda x: x.i).alias("items"),
    )
    return out.withColumn("id", pack_id(F.col("kind"), F.col("key")))


def pack_id(kind: Column, key: Column) -> Column:
    joined = slugify(F.array_join(F.filter(key, lambda v: v != ""), "-"), None)
    return F.when(kind == "full", F.lit("all")).when(kind == "year", F.concat(F.lit("year-"), key[0])).otherwise(F.coalesce(F.nullif(joined, F.lit("")), F.concat(kind, F.lit("-pack"))))


def distinct_ids(found: DataFrame, kind: str = "kind", name: str = "id", key: str = "key") -> DataFrame:
    """Second and later packs of one id get six hex digits of their key's digest."""
    joined = F.array_join(key, "|")
    nth = F.row_number().over(Window.partitionBy(kind, name).orderBy(joined))
    suffixed = F.concat(F.col(name), F.lit("--"), F.substring(F.sha2(joined, 256), 1, 6))
    return found.withColumn("__nth", nth).withColumn(name, F.when(F.col("__nth") == 1, F.col(name)).otherwise(suffixed)).drop("__nth")


def evenly(rows: DataFrame, group: Sequence[str], order: Sequence[str], take: int | Column) -> DataFrame:
    """Of each group evenly spaced rows: those at floor(i * size / take) for i under take; all if there are fewer."""
    out = numbered(rows, group, order, "__nth", "__n").withColumn("__at", F.col("__nth") - 1)
    k = F.least(F.col("__n"), take if isinstance(take, Column) else F.lit(take)).cast("long")
    # a row at p is floor(i * n / k) for some i exactly if the multiple of n above p * k lies within k of it
    i = F.ceil(F.col("__at") * k / F.col("__n")).cast("long")
    return out.filter((i < k) & (F.floor(i * F.col("__n") / k) == F.col("__at"))).drop("__at", "__n", "__nth")


def stratified(rows: DataFrame, stratum: str, order: Sequence[str], strata: int, take: int) -> DataFrame:
    """Rows of the largest half of the wanted strata and an even choice of the others; of each evenly spaced rows."""
    sizes = rows.groupBy(stratum).agg(F.count("*").alias("__size")).withColumn("__one", F.lit(1))
    ranked = numbered(sizes, ["__one"], [F.desc("__size"), stratum], "__rank")
    half = strata // 2
    rest = evenly(ranked.filter(F.col("__rank") > half), ["__one"], [stratum], strata - half).select(stratum)
    chosen = ranked.filter(F.col("__rank") <= half).select(stratum).unionByName(rest)
    return evenly(rows.join(F.broadcast(chosen), stratum, "left_semi"), [stratum], order, take)


def top_k(rows: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col(name) <= k)


def with_margin(rows: DataFrame, group: Sequence[str], score: str, ties: Sequence[Column], least: float, margin: float) -> DataFrame:
    """One row for each group: its best, with runner_up and outcome: matched, ambiguous (the runner-up is too near) or none.
    Only scores of least and more compete; a group that has none of them keeps its key, and all else is null."""
    w = Window.partitionBy(*group).orderBy(F.desc_nulls_last(score), *ties)
    able = rows.withColumn(score, F.when(F.col(score) >= least, F.col(score)))
    best = able.withColumns({"__r": F.row_number().over(w), "runner_up": F.lead(score).over(w)}).filter("__r = 1")
    none = F.col(score).isNull()
    outcome = F.when(none, "none").when(F.col(score) < F.col("runner_up") * margin, "ambiguous").otherwise("matched")
    return best.select(*(F.col(c) if c in group else F.when(~none, F.col(c)).alias(c) for c in rows.columns), "runner_up", outcome.alias("outcome"))


def recent_values(rows: DataFrame, column: str, span: int) -> DataFrame:
    """The largest distinct values but 0."""
    return rows.filter(F.coalesce(F.col(column), F.lit(0)) != 0).select(column).distinct().orderBy(F.desc(column)).limit(span)


def batches(rows: DataFrame, group: Sequence[str], order: Sequence[str], size: int, name: str = "batch") -> DataFrame:
    """Numbers runs of size rows from 0; a size of 0 makes one."""
    if size <= 0:
        return rows.withColumn(name, F.lit(0))
    return numbered(rows, group, order, "__nth").withColumn(name, F.floor((F.col("__nth") - 1) / size).cast("int")).drop("__nth")


def mode(rows: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """The most frequent value of each group, the smallest of equals."""
    n = rows.groupBy(*group, value).agg(F.count("*").alias("n"))
    return n.groupBy(*group).agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(value).alias("v")))["v"].alias(value), F.max("n").alias("n"))


def first_wins(rows: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("__r = 1").drop("__r")


def subject_order(subject: Column, order: Sequence[str]) -> Column:
    """A sort key: the fixed order first, others after it by name."""
    at = F.array_position(F.array(*(F.lit(s) for s in order)), subject)
    return F.struct(F.when(at > 0, at).otherwise(len(order) + 1).alias("at"), subject.alias("name"))


def byte_shards(rows: DataFrame, group: str, order: Sequence[str], size: str, most: int, name: str = "shard") -> DataFrame:
    """Numbers a group's shards from 0: in order, a new one where the next row would take it over `most`; a larger row has
    one of its own. Null sizes are 0; a null group is a group. Columns: group, order, size and the number.

    The sum starts anew with each shard, which no window does. But all that a block of rows needs to know is how many bytes
    the shard that reaches into it holds, and the first row to open a shard stands within the block's first `most` bytes. So
    blocks of PART rows are summed up side by side, as maps from bytes held before to bytes held after and shards opened;
    maps of up to FAN blocks are joined to one, level by level while a group has more; then each block gets what reaches into
    it, from the top down, and numbers its rows. A task holds PART rows, or FAN maps (each of the rows of one shard).
    """
    narrow = rows.select(group, *order, size)
    at = numbered(narrow, [group], list(order), "__at")
    at = written(at.withColumns({"__block": F.floor((F.col("__at") - 1) / PART).cast("long"), "__size": F.coalesce(F.col(size), F.lit(0)).cast("long")}), "shard-rows")
    kind = rows.schema[group].dataType.simpleString()
    maps = f"`{group}` {kind}, __block long, total long, before array<long>, size array<long>, held array<long>, opened array<long>"

    def summed(key, part):
        return _framed(group, key, _summary(part.sort_values("__at")["__size"].to_numpy(), most))

    blocks = written(at.select(group, "__block", "__at", "__size").groupBy(group, "__block").applyInPandas(summed, maps), "shard-blocks")
    entered = _entered(blocks, group, kind, most, maps)
    same = F.col(group).eqNullSafe(F.col("__g")) & (F.col("__block") == F.col("__b"))
    rows_in = at.join(entered.select(F.col(group).alias("__g"), F.col("__block").alias("__b"), "held", "opened"), same).drop("__g", "__b")

    def number(key, part):
        part = part.sort_values("__at")
        shard = _numbers(part["__size"].to_numpy(), int(part["held"].iloc[0]), int(part["opened"].iloc[0]), most)
        return part.assign(**{name: shard})[[group, *order, size, name]]

    schema = ", ".join(f"`{c}` {narrow.schema[c].dataType.simpleString()}" for c in narrow.columns) + f", `{name}` int"
    return rows_in.groupBy(group, "__block").applyInPandas(number, schema)


#: Rows of a block and blocks of a level in byte_shards().
PART, FAN = 200_000, 64
#: A map of a block: bytes in all; of each row that may be the first to open a shard the bytes before it, its own, and the
#: bytes held and shards opened at the block's end if it does.
Block = tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _next_starts(sums: np.ndarray, most: int) -> np.ndarray:
    """For each row that opens a shard the next row that does, else the number of rows. sums: of sizes before each row."""
    base = sums[:-1]
    # a shard that holds nothing takes any row; else the row whose sum passes `most` opens the next
    return np.maximum(np.searchsorted(sums, base, "right"), np.searchsorted(sums, base + most, "right") - 1).clip(max=len(base))


def _summary(sizes: np.ndarray, most: int) -> Block:
    n, sums = len(sizes), np.concatenate([[0], np.cumsum(sizes)])
    follow, rows = _next_starts(sums, most), np.arange(n)
    last, opened = np.where(follow < n, follow, rows), (follow < n).astype(np.int64)
    while (last[last] != last).any():  # twice as many shards on each time
        opened, last = opened + opened[last], last[last]
    able = rows[: int(np.searchsorted(sums[:n], most, "right")) + 1]
    return int(sums[n]), sums[able], sizes[able], sums[n] - sums[last[able]], opened[able] + 1


def _passed(block: Block, held: np.ndarray, opened: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes held and shards opened after a block, for each of those before it."""
    total, before, size, after, more = block
    first = np.searchsorted(before + size, most - held, "right")
    first = np.where(held == 0, np.maximum(first, np.searchsorted(before, 0, "right")), first)
    none, at = first >= len(before), first.clip(max=len(before) - 1)
    return np.where(none, held + total, after[at]), opened + np.where(none, 0, more[at])


def _joined(a: Block, b: Block, most: int) -> Block:
    held, opened = _passed(b, a[3], a[4], most)
    rest = int(np.searchsorted(b[1] + a[0], most, "right")) + 1 if a[1][-1] <= most else 0
    both = lambda x, y: np.concatenate([x, y[:rest]])
    return a[0] + b[0], both(a[1], b[1] + a[0]), both(a[2], b[2]), both(held, b[3]), both(opened, b[4])


def _framed(group: str, key: tuple, block: Block) -> pd.DataFrame:
    return pd.DataFrame({group: [key[0]], "__block": [key[1]], "total": [block[0]], "before": [block[1]], "size": [block[2]], "held": [block[3]], "opened": [block[4]]})


def _blocks(part: pd.DataFrame) -> list[tuple[int, Block]]:
    part = part.sort_values("__block")
    return [(b, (int(t), *(np.asarray(x, np.int64) for x in rest))) for b, t, *rest in zip(*(part[c] for c in ("__block", "total", "before", "size", "held", "opened")), strict=True)]


def _entered(blocks: DataFrame, group: str, kind: str, most: int, maps: str) -> DataFrame:
    """group, __block, held, opened: the bytes of the shard that reaches into each block and the shards opened before."""
    above = F.floor(F.col("__block") / FAN).cast("long").alias("__above")
    found = f"`{group}` {kind}, __block long, held long, opened long"

    def down(part, held, opened):
        out = []
        for b, block in _blocks(part):
            out.append((part[group].iloc[0], b, held, opened))
            held, opened = (int(x[0]) for x in _passed(block, np.array([held]), np.array([opened]), most))
        return pd.DataFrame(out, columns=[group, "__block", "held", "opened"])

    if (blocks.agg(F.max("__block")).first()[0] or 0) < FAN:
        return blocks.groupBy(group).applyInPandas(lambda part: down(part, 0, 0), found)

    def up(key, part):
        held = [block for _, block in _blocks(part)]
        return _framed(group, key, reduce(lambda a, b: _joined(a, b, most), held))

    joined = written(blocks.groupBy(group, above).applyInPandas(up, maps), "shard-blocks")
    top = _entered(joined, group, kind, most, maps).select(F.col(group).alias("__g"), F.col("__block").alias("__a"), F.col("held").alias("__held"), F.col("opened").alias("__opened"))
    rows = blocks.withColumn("__above", above).join(top, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__above") == F.col("__a")))
    return rows.groupBy(group, "__above").applyInPandas(lambda part: down(part, int(part["__held"].iloc[0]), int(part["__opened"].iloc[0])), found)


def _numbers(sizes: np.ndarray, held: int, opened: int, most: int) -> np.ndarray:
    """The shard of each row of a block."""
    sums = np.concatenate([[0], np.cumsum(sizes)])
    first = int(np.searchsorted(sums[1:], most - held, "right"))
    first = max(first, int(np.searchsorted(sums[:-1], 0, "right"))) if not held else first
    follow, opens, at = _next_starts(sums, most), np.zeros(len(sizes), np.int32), first
    while at < len(sizes):
        opens[at] = 1
        at = int(follow[at])
    return (opened + np.cumsum(opens)).astype(np.int32)
