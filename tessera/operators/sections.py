"""Sections and layouts: reset detection, votes, filling, spans, and how far two sources of subjects agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

FOREVER = (Window.unboundedPreceding, Window.unboundedFollowing)


def _opens(n: str, w: WindowSpec) -> Column:
    last = F.last(n, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return F.col(n).isNull() | last.isNull() | (F.col(n) <= last)


def with_sections(rows: DataFrame, group: Sequence[str], order: str, n: str, name: str = "section", by: Sequence[str] = ()) -> DataFrame:
    """Numbers a group's sections from 1: one begins where n is null, not above the last n that was not, or has none before.
    by: the columns that `order` numbers the rows by, so that rows sorted by them for it are not sorted anew."""
    w = Window.partitionBy(*group).orderBy(*(by or [order]))
    return rows.withColumn(name, F.sum(_opens(n, w).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))


def clean_sections(rows: DataFrame, group: Sequence[str], order: str, n: str, by: Sequence[str] = ()) -> DataFrame:
    """For each section its size, and whether its n run 1, 2, 3 and so on. by: as for with_sections.

    All of it is one sort and running values over it, of which a section's last row holds the result: no aggregate keeps a
    row for each section."""
    w = Window.partitionBy(*group).orderBy(*(by or [order]))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    cut = rows.withColumns({"__opens": _opens(n, w), "__nth": F.row_number().over(w)})
    first = lambda c: F.max(F.when(F.col("__opens"), F.col(c))).over(upto)
    section = F.sum(F.col("__opens").cast("int")).over(upto).cast("int")
    cut = cut.withColumns({"section": section, "start": first(order), "__from": first("__nth"), "__ends": F.coalesce(F.lead("__opens").over(w), F.lit(True))})
    cut = cut.withColumn("size", (F.col("__nth") - F.col("__from") + 1).cast("long"))
    wrong = F.max(F.when(F.coalesce(F.col(n) != F.col("size"), F.lit(True)), F.col("__nth"))).over(upto)
    cut = cut.withColumn("clean", F.coalesce(wrong < F.col("__from"), F.lit(True)))
    return cut.filter("__ends").select(*group, "section", "size", "clean", "start", F.col(order).alias("end"))


def majority(votes: DataFrame, group: Sequence[str], subject: str, order: Sequence[str] = (), least: int = 3, most_share: float = 0.60) -> DataFrame:
    """For each group the subject with most votes (ties by the given order, then by name), its votes, their total, and
    whether that decides: least votes in all and a share of most_share. Null subjects do not vote."""
    n = votes.filter(F.col(subject).isNotNull()).groupBy(*group, subject).agg(F.count("*").alias("votes"))
    rank = F.coalesce(F.nullif(F.array_position(F.array(*(F.lit(s) for s in order)), F.col(subject)), F.lit(0)), F.lit(99)) if order else F.lit(0)
    best = n.groupBy(*group).agg(
        F.min(F.struct((-F.col("votes")).alias("v"), rank.alias("r"), F.col(subject).alias("s"))).alias("b"), F.sum("votes").alias("total")
    )
    top = -F.col("b.v")
    return best.select(*group, F.col("b.s").alias("subject"), top.alias("votes"), "total", ((F.col("total") >= least) & (top / F.col("total") >= most_share)).alias("decisive"))


def detected_layout(rows: DataFrame, group: str, order: str, n: str, subject: str, ranks: Sequence[str] = ()) -> DataFrame:
    """Spans (group, subject, start, end) of the sections' majorities: sections without votes take the subject before
    them, else the one after, and neighbours of one subject merge."""
    cut = with_sections(rows, [group], order, n)
    at = cut.withColumn("ordinal", F.row_number().over(Window.partitionBy(group).orderBy(order)))
    named = majority(cut, [group, "section"], subject, ranks).select(group, "section", "subject")
    s = at.groupBy(group, "section").agg(F.min("ordinal").alias("start"), F.max("ordinal").alias("end"))
    s = s.join(named, [group, "section"], "left")
    w = Window.partitionBy(group).orderBy("section")
    before = F.last("subject", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first("subject", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    s = s.withColumn("filled", F.coalesce("subject", before, after)).filter(F.col("filled").isNotNull())
    turn = F.coalesce((F.col("filled") != F.lag("filled").over(w)).cast("int"), F.lit(1))
    s = s.withColumn("span", F.sum(turn).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return s.groupBy(group, "span", F.col("filled").alias("subject")).agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("span")


def layout_quality(rows: DataFrame, group: str, order: str, n: str, subject: str, least: float = 0.60, votes: int = 3) -> DataFrame:
    """For each group: sections, share of rows with a subject, whether every voting section decides, and whether the
    layout is accepted."""
    cut = with_sections(rows, [group], order, n)
    m = majority(cut, [group, "section"], subject, least=votes).groupBy(group).agg(F.min("decisive").alias("decisive"))
    c = cut.groupBy(group).agg(F.max("section").alias("sections"), F.count(subject).alias("voted"), F.count("*").alias("rows"))
    c = c.join(m, group, "left").withColumn("confidence", F.col("voted") / F.col("rows"))
    enough = (F.col("confidence") >= least) | ((F.col("sections") == 1) & (F.col("voted") >= votes))
    return c.withColumn("ok", F.coalesce(F.col("decisive") & enough, F.lit(False))).select(group, "sections", F.round("confidence", 6).alias("confidence"), "decisive", "ok")


def expand_spans(spans: DataFrame, start: str, end: str, point: str) -> DataFrame:
    """A row for each point of inclusive spans, so that an interval join becomes one on equality; span lengths bound it."""
    return spans.withColumn(point, F.explode(F.sequence(F.col(start).cast("int"), F.col(end).cast("int"))))


def at_point(points: DataFrame, spans: DataFrame, keys: Sequence[str], point: str, subject: str, number: str) -> DataFrame:
    """points with the subject of the first span (by number) that holds them, null if none: an equality join on points."""
    first = expand_spans(spans, "start", "end", point).groupBy(*keys, point).agg(F.min_by(subject, number).alias(subject))
    return points.join(first, [*keys, point], "left")


def agreement(rows: DataFrame, group: Sequence[str], declared: Column, seen: Column, least: float = 0.60) -> DataFrame:
    """For each group how often two subjects agree where both are known; 0 if they never are."""
    both = declared.isNotNull() & seen.isNotNull()
    out = rows.groupBy(*group).agg(
        F.count("*").alias("total"), F.count(declared).alias("positional_known"), F.count(seen).alias("keyword_known"),
        F.count_if(both).alias("comparable"), F.count_if(both & (declared == seen)).alias("hits"),
    )
    share = F.when(F.col("comparable") == 0, F.lit(0.0)).otherwise(F.col("hits") / F.col("comparable"))
    return out.withColumn("agreement", F.round(share, 6)).withColumn("ok", (F.col("comparable") > 0) & (share >= least))


def section_agreement(rows: DataFrame, group: Sequence[str], span: str, declared: str, seen: str) -> DataFrame:
    """For each group over its spans: does the span's majority agree with what is declared; null where no span votes."""
    modal = majority(rows, [*group, span, declared], seen)
    spans = rows.select(*group, span, declared).distinct()
    out = spans.join(modal.select(*group, span, "subject"), [*group, span], "left").groupBy(*group).agg(
        F.count("*").alias("spans"), F.count("subject").alias("comparable"), F.count_if(F.col("subject") == F.col(declared)).alias("hits")
    )
    return out.withColumn("agreement", F.when(F.col("comparable") > 0, F.round(F.col("hits") / F.col("comparable"), 6)))


def layout_verdict(question_ok: Column, section_rate: Column, comparable: Column, detected_ok: Column, least: float = 0.60) -> Column:
    """canonical, canonical-unverified, detected or none: sections decide, else questions; without any evidence the
    declared layout stays, unverified."""
    ok = F.coalesce(section_rate >= least, question_ok)
    return (
        F.when(section_rate.isNull() & (comparable == 0), F.lit("canonical-unverified")).when(ok, F.lit("canonical"))
        .when(F.coalesce(detected_ok, F.lit(False)), F.lit("detected")).otherwise(F.lit("none"))
    )
