"""Distributions over hierarchies: grouping sets, importance, trends, matrices, subtrees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Weights of the years back from the latest, of all before them, and of the parts of the importance.
BY_GAP, OLDER = {0: 1.00, 1: 0.75, 2: 0.50}, 0.30
RECENCY, FREQUENCY, TREND = 0.50, 0.35, 0.15


def recency_weight(year: Column, latest: Column) -> Column:
    gap = latest - year
    out = F.when(gap < 0, F.lit(BY_GAP[0]))
    for k, w in BY_GAP.items():
        out = out.when(gap == k, F.lit(w))
    return out.otherwise(F.lit(OLDER))


def trend(last: Column, before: Column) -> Column:
    """Relative change between two periods, within -1 and 1."""
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (last - before) / F.greatest(before, F.lit(1))))


def trend_label(now: Column, before: Column) -> Column:
    return F.when((now == before), "flat").when(before == 0, "new").when(now > before, F.concat(F.lit("up +"), now - before)).otherwise(F.concat(F.lit("down "), now - before))


def nodes(rows: DataFrame, levels: Sequence[str], year: str, latest: int) -> DataFrame:
    """A row for every node of the hierarchy: level (1 for the first), the level columns, questions, recency, last_2y,
    prev_2y. One pass by grouping sets; a level is told by its grouping id, so null members stay apart from totals."""
    y = F.coalesce(F.col(year).cast("int"), F.lit(0))
    # weights in hundredths: sums of integers do not depend on their order
    weighted = rows.select(*levels, y.alias("__y"), (recency_weight(y, F.lit(latest)) * 100).cast("long").alias("__w"))
    out = weighted.rollup(*levels).agg(
        F.grouping_id().alias("__g"), F.count("*").alias("questions"), (F.sum("__w") / 100.0).alias("recency"),
        F.count_if(F.col("__y").between(latest - 1, latest)).alias("last_2y"), F.count_if(F.col("__y").between(latest - 3, latest - 2)).alias("prev_2y"),
    )
    level = F.lit(len(levels)) - F.length(F.regexp_replace(F.bin("__g"), "0", ""))
    return out.withColumn("level", level.cast("int")).filter("level > 0").drop("__g")


def with_importance(found: DataFrame) -> DataFrame:
    """nodes() with delta_2y, trend and importance: 100 times the weighted sum of recency and count, each in shares of
    the largest of all levels, and the trend moved to 0 to 1."""
    largest = found.agg(F.max("recency").alias("__mr"), F.max("questions").alias("__mq"))
    t = trend(F.col("last_2y"), F.col("prev_2y"))
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    score = 100.0 * (RECENCY * share("recency", "__mr") + FREQUENCY * share("questions", "__mq") + TREND * ((t + 1) / 2))
    out = found.join(F.broadcast(largest)).withColumns({"delta_2y": F.col("last_2y") - F.col("prev_2y"), "trend": F.round(t, 4), "importance": F.round(score, 4)})
    return out.drop("__mr", "__mq")


def priority(found: DataFrame, level: int, levels: Sequence[str], limit: int, within: Sequence[str] = ()) -> DataFrame:
    """The first nodes of a level by importance, count and path; within: of each of these."""
    rows = found.filter(F.col("level") == level)
    order = [F.desc("importance"), F.desc("questions"), *levels]
    if not within:
        return rows.orderBy(*order).limit(limit)
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*within).orderBy(*order))).filter(F.col("rank") <= limit)


def top_counts(rows: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """The most frequent keys, ties by the keys as text."""
    return rows.groupBy(*keys).agg(F.count("*").alias("count")).orderBy(F.desc("count"), *(F.col(k).cast("string") for k in keys)).limit(limit)


def matrix(rows: DataFrame, down: str, across: str, members: Sequence[str]) -> DataFrame:
    """Counts of down by across, zeros filled, with the row's total and its share of all in percent."""
    out = rows.groupBy(down).pivot(across, list(members)).count().na.fill(0)
    total = sum((F.col(f"`{m}`") for m in members), F.lit(0))
    grand = rows.filter(F.col(across).isin(*members)).agg(F.count("*").alias("__all"))
    return out.withColumn("total", total.cast("long")).join(F.broadcast(grand)).withColumn("share", F.round(100.0 * F.col("total") / F.col("__all"), 1)).drop("__all")


def counts_with_totals(rows: DataFrame, *keys: str) -> DataFrame:
    """Counts for every combination of keys and totals; level: the grouping id."""
    return rows.cube(*keys).agg(F.grouping_id().alias("level"), F.count("*").alias("count"))


def coverage(records: DataFrame, placed: Column, reports: DataFrame, **sums: str) -> DataFrame:
    """One row: placed and unclassified records, the sums of report columns, and whether they add up to what was read
    (the sum named total)."""
    a = records.agg(F.count_if(placed).alias("placed"), F.count_if(~placed).alias("unclassified"))
    b = reports.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(k) for k, c in sums.items()))
    rest = sum((F.col(k) for k in sums if k != "total"), F.lit(0))
    return a.join(F.broadcast(b)).withColumn("balanced", F.col("placed") + F.col("unclassified") + rest == F.col("total"))


def subtree_counts(rows: DataFrame, path: str) -> DataFrame:
    """node (array), depth, own, subtree: a path counts for all its prefixes; no recursion."""
    size = F.size(path)
    grown = rows.filter(size > 0).select(F.explode(F.transform(F.sequence(F.lit(1), size), lambda k: F.struct(F.slice(path, F.lit(1), k).alias("node"), (k == size).alias("own")))).alias("p"))
    return grown.groupBy("p.node").agg(F.size(F.first("p.node")).alias("depth"), F.count_if("p.own").alias("own"), F.count("*").alias("subtree"))


def children(counted: DataFrame) -> DataFrame:
    """parent, child, depth, subtree of subtree_counts()."""
    up = F.when(F.col("depth") > 1, F.expr("slice(node, 1, depth - 1)")).otherwise(F.array().cast("array<string>"))
    return counted.select(up.alias("parent"), F.element_at("node", -1).alias("child"), "depth", "subtree")


def span_of(rows: DataFrame, group: Sequence[str], year: str) -> DataFrame:
    return rows.groupBy(*group).agg(F.count("*").alias("rows"), F.min(year).alias("first_year"), F.max(year).alias("last_year"))


def two_periods(rows: DataFrame, group: Sequence[str], year: str, recent: Sequence[int]) -> DataFrame:
    """For each group the counts of two years, first and last, their difference and a label."""
    a, b = recent[0], recent[-1]
    out = rows.groupBy(*group).agg(F.count_if(F.col(year) == a).alias("before"), F.count_if(F.col(year) == b).alias("now"))
    return out.withColumn("delta", F.col("now") - F.col("before")).withColumn("label", trend_label(F.col("now"), F.col("before")))


def with_empty(counted: DataFrame, members: DataFrame, keys: Sequence[str], *counts: str) -> DataFrame:
    """All members, those without rows with counts of 0."""
    return members.join(counted, list(keys), "left").na.fill(0, list(counts))


def counts_by(rows: DataFrame, column: str, default) -> DataFrame:
    """Counts by a column, null and empty as the default, in the column's order."""
    value = F.coalesce(F.nullif(F.col(column), F.lit("")) if isinstance(default, str) else F.col(column), F.lit(default))
    return rows.groupBy(value.alias(column)).agg(F.count("*").alias("count")).orderBy(column)


def subject_metrics(rows: DataFrame, subject: str, chapter: str, image: str) -> DataFrame:
    return rows.groupBy(subject).agg(
        F.count("*").alias("rows"), F.count_if(F.col(chapter).isNull()).alias("unclassified"), F.count_if(F.col(image)).alias("with_image"), F.count_distinct(chapter).alias("chapters")
    )


def rolled(rows: DataFrame, group: str, members: DataFrame, *dims: str) -> DataFrame:
    """For each member of a dimension its rows and, of every other column, counts by value as a map; members without rows
    stay, with 0 and empty maps."""
    out = members.select(group).distinct().join(rows.groupBy(group).agg(F.count("*").alias("count")), group, "left").na.fill(0, ["count"])
    for d in dims:
        n = rows.groupBy(group, F.col(d).cast("string").alias("k")).agg(F.count("*").alias("n")).filter(F.col("k").isNotNull())
        m = n.groupBy(group).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias(f"by_{d}"))
        out = out.join(m, group, "left").withColumn(f"by_{d}", F.coalesce(f"by_{d}", F.create_map().cast("map<string,bigint>")))
    return out


def paper_summary(reports: DataFrame) -> DataFrame:
    """For each exam: papers, validated, flagged, questions, skipped (columns ok, questions, skipped)."""
    return reports.groupBy("exam").agg(
        F.count("*").alias("papers"), F.count_if("ok").alias("validated"), F.count_if(~F.col("ok")).alias("flagged"),
        F.coalesce(F.sum("questions"), F.lit(0)).cast("long").alias("questions"), F.coalesce(F.sum("skipped"), F.lit(0)).cast("long").alias("skipped"),
    ).orderBy("exam")
