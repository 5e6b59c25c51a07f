"""Integrity rules as queries: each returns rows rule, place, detail; no rows, no violation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import norm_key


def _found(rows: DataFrame, rule: str, place: Column, detail: Column) -> DataFrame:
    return rows.select(F.lit(rule).alias("rule"), place.cast("string").alias("place"), detail.cast("string").alias("detail"))


def nested_twice(paths: DataFrame, path: str = "path") -> DataFrame:
    """No element of a path (array) equals its parent."""
    p = F.col(path)
    twice = F.exists(F.when(F.size(p) > 1, F.sequence(F.lit(2), F.size(p))).otherwise(F.array().cast("array<int>")), lambda i: F.element_at(p, i) == F.element_at(p, i - 1))
    return _found(paths.filter(twice), "nested_twice", F.array_join(p, "/"), F.lit("an element equals its parent"))


def page_beside_child(pages: DataFrame, folders: DataFrame, path: str = "path") -> DataFrame:
    """No page stands beside a folder of its name."""
    hit = pages.join(folders.select(path).distinct(), path, "left_semi")
    return _found(hit, "page_beside_child", F.array_join(path, "/"), F.lit("a page beside a folder of the same name"))


def foreign_slugs(paths: DataFrame, foreign: DataFrame, path: str = "path", slug: str = "slug") -> DataFrame:
    """No path element is another subject's word."""
    parts = paths.select(path, F.explode(F.array_distinct(F.col(path))).alias(slug))
    return _found(parts.join(foreign.select(slug).distinct(), slug, "left_semi"), "foreign_slug", F.array_join(path, "/"), F.col(slug))


def bad_slugs(rows: DataFrame, slug: str, required: Sequence[str], placeholder: str = "_unclassified", label: str | None = None) -> DataFrame:
    """Names are slugs, required columns are filled, and the placeholder stands exactly where the label is null."""
    missing = reduce(lambda a, b: a | b, (F.coalesce(F.col(c).cast("string"), F.lit("")) == "" for c in required), F.lit(False))
    wrong = ~F.coalesce(F.col(slug).rlike("^(_[a-z]+|[a-z0-9]+(-[a-z0-9]+)*)$"), F.lit(False))
    odd = (F.col(slug) == placeholder) != F.col(label).isNull() if label else F.lit(False)
    detail = F.when(missing, "a required column is empty").when(wrong, "not a slug").otherwise("placeholder and label disagree")
    return _found(rows.filter(missing | wrong | odd), "bad_slug", F.col(slug), detail)


def in_several_places(rows: DataFrame, identity: Sequence[str], place: str) -> DataFrame:
    n = rows.groupBy(*identity).agg(F.count_distinct(place).alias("n")).filter("n > 1")
    return _found(n, "in_several_places", F.concat_ws("|", *identity), F.col("n"))


def repeated_in_place(rows: DataFrame, identity: Sequence[str], place: str) -> DataFrame:
    n = rows.groupBy(place, *identity).agg(F.count("*").alias("n")).filter("n > 1")
    return _found(n, "repeated_in_place", F.concat_ws("|", place, *identity), F.col("n"))


def reused_ids(rows: DataFrame, short: str, identity: Sequence[str]) -> DataFrame:
    """A warning: one id for several identities."""
    n = rows.groupBy(short).agg(F.count_distinct(*identity).alias("n")).filter("n > 1")
    return _found(n, "reused_id", F.col(short), F.col("n"))


def undeclared(rows: DataFrame, scope: DataFrame, keys: Sequence[str], place: Column, parked: Column | None = None) -> DataFrame:
    """Keys that the scope does not declare, unless they are parked."""
    able = rows.filter(~parked) if parked is not None else rows
    return _found(able.join(scope, list(keys), "left_anti"), "undeclared", place, F.concat_ws("|", *keys))


def differs_by_case(names: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Siblings whose names differ by case, accents of ASCII aside, only."""
    n = names.groupBy(*parent, norm_key(F.col(name)).alias("__k")).agg(F.count_distinct(name).alias("n"), F.min(name).alias("first")).filter("n > 1")
    return _found(n, "differs_by_case", F.concat_ws("|", *parent, "first"), F.col("n"))


def catalogue_counts(catalogue: DataFrame, files: DataFrame, path: str, count: str) -> DataFrame:
    """Listed packs have a file with as many items; paths are listed once."""
    twice = catalogue.groupBy(path).agg(F.count("*").alias("n")).filter("n > 1")
    held = catalogue.join(files.select(F.col(path), F.col(count).alias("__have")), path, "left")
    wrong = held.filter(F.col("__have").isNull() | (F.col("__have") != F.col(count)))
    return _found(twice, "listed_twice", F.col(path), F.col("n")).unionByName(_found(wrong, "catalogue_count", F.col(path), F.concat_ws("|", F.col(count), F.col("__have"))))


def empty_and_marked(places: DataFrame, rows: DataFrame, place: str, marked: str) -> DataFrame:
    """A place is marked as empty exactly if it has no rows."""
    n = rows.groupBy(place).agg(F.count("*").alias("__n"))
    held = places.join(n, place, "left").na.fill(0, ["__n"])
    return _found(held.filter((F.col("__n") == 0) != F.col(marked)), "empty_mark", F.col(place), F.col("__n"))


def wrong_owner(rows: DataFrame, declared: DataFrame, subject: str, chapter: str, place: str) -> DataFrame:
    """Chapters that the filing subject does not declare. declared: subject, key."""
    r = rows.filter(F.col(chapter).isNotNull()).withColumn("key", norm_key(F.col(chapter)))
    gone = r.join(declared.select(F.col("subject").alias(subject), "key").distinct(), [subject, "key"], "left_anti")
    return _found(gone, "wrong_owner", F.col(place), F.concat_ws("|", subject, chapter))


def report(*violations: DataFrame) -> DataFrame:
    """All violations; and counted by rule with summary()."""
    return reduce(DataFrame.unionByName, violations)


def summary(found: DataFrame, rules: Sequence[str]) -> DataFrame:
    spark = found.sparkSession
    every = spark.createDataFrame([(r,) for r in rules], "rule string")
    n = found.groupBy("rule").agg(F.count("*").alias("violations"), F.min("place").alias("first_place"))
    return every.join(n, "rule", "left").na.fill(0, ["violations"])


def setting(spark, rule: str, holds: bool, detail: str) -> DataFrame:
    """A check of configuration as a rule: a violation unless it holds."""
    return spark.createDataFrame([] if holds else [(rule, "settings", detail)], "rule string, place string, detail string")
