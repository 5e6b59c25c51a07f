"""Phrases by automaton, and ordered rules with wildcards by masks, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import lookup, scoring
from tessera.operators.phrases import Automaton, phrases_in
from tests.test_operators import rows_of


def by_hand(text, phrases):
    return {p for p in phrases if p and text is not None and f" {p} " in f" {text} "}


def test_automaton_like_containment():
    rng = random.Random(4)
    words = ["the", "a", "b", "c", "dd"]
    for _ in range(400):
        phrases = sorted({" ".join(rng.choices(words, k=rng.randrange(1, 5))) for _ in range(rng.randrange(1, 12))})
        text = " ".join(rng.choices([*words, "x", ""], k=rng.randrange(0, 30)))
        assert {phrases[k] for k in Automaton(phrases).found(text.split(" "))} == by_hand(text, phrases)


@pytest.mark.parametrize("most", [1 << 20, 200])
def test_phrases_in_blocks(spark, most):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(12)]
    phrases = [" ".join(rng.choices(words, k=rng.randrange(1, 4))) for _ in range(60)] + ["", None, "the end"]
    rows = [(i, " ".join(rng.choices([*words, "the"], k=20))) for i in range(80)] + [(90, None), (91, ""), (92, "x the end"), (92, "the end")]
    got = phrases_in(spark.createDataFrame(rows, "i int, t string"), "i", F.col("t"), spark.createDataFrame([(p,) for p in phrases], "key string"), most=most)
    assert rows_of(got, "i", "key") == sorted((i, p) for i, t in rows for p in by_hand(t, set(phrases) - {None}))
    assert phrases_in(spark.createDataFrame(rows, "i int, t string"), "i", F.col("t"), spark.createDataFrame([], "key string")).count() == 0


def test_a_hot_word_makes_no_candidates(spark):
    """Every text and every phrase begins with one word: rows out are matches alone."""
    phrases = spark.createDataFrame([(k, f"the w{k} x") for k in range(2000)], "rule int, phrase string")
    docs = spark.createDataFrame([(i, f"the w{i} x the w{i + 1} y the") for i in range(500)], "i int, t string")
    stats = scoring.phrase_frequency(docs, "i", "t", phrases)
    assert stats.filter("df > 0").count() == 500 and stats.count() == 2000
    hits = scoring.phrase_hits(docs, "i", "t", phrases, stats.withColumn("rarity", F.lit(1)))
    assert rows_of(hits.select("i", "rule"), "i") == [(i, i) for i in range(500)]
    assert "Join" not in phrases_in(docs, "i", F.col("t"), phrases.select(F.col("phrase").alias("key")))._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("many", [5, 600])
def test_first_rule_like_a_loop(spark, many):
    rng = random.Random(many)
    some = lambda xs: None if rng.random() < 0.4 else rng.sample(xs, rng.randrange(0, 4))
    kinds, years = ["a", "b", "c", "d"], list(range(2000, 2012))
    rules = [(k, some(kinds), some(years), f"v{k % 7}") for k in range(many)]
    rows = [(i, rng.choice([*kinds, None, "z"]), rng.choice([*years, None])) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, k string, y int")
    r = spark.createDataFrame(rules, "n int, ks array<string>, ys array<int>, v string")
    out = lookup.first_rule(df, "i", r, {"k": "ks", "y": "ys"}, "n", "v")
    fits = lambda held, x: held is None or x in held
    want = [next(((i, n, v) for n, ks, ys, v in rules if fits(ks, k) and fits(ys, y)), None) for i, k, y in rows]
    assert rows_of(out, "i") == [w for w in want if w]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert lookup.first_rule(df, "i", r.filter("n < 0"), {"k": "ks", "y": "ys"}, "n", "v").count() == 0


def test_report_keeps_the_first_samples(spark):
    df = spark.createDataFrame([("a", i % 9) for i in range(50)] + [(None, 3), (None, None), ("b", None)], "g string, s int")
    got = {r["g"]: (r["count"], r["samples"]) for r in lookup.verdict_report(df, ["g"], "s").collect()}
    assert got == {"a": (50, [0, 1, 2, 3, 4]), None: (2, [3]), "b": (1, [])}


def test_hints_and_frequent_terms(spark):
    """A term that gives no points makes no pair; a strong hint counts without a term, a weak one with evidence alone."""
    terms = spark.createDataFrame([(i, t) for i in range(50) for t in ("the", f"t{i % 3}")], "q int, term string")
    weighted = spark.createDataFrame([(r, "the", 3, False) for r in range(400)] + [(1, "t1", 3, False)], "rule int, term string, weight int, loose boolean")
    stats = spark.createDataFrame([("the", 0), ("t0", 1), ("t1", 2), ("t2", 1)], "term string, rarity int")
    hints = spark.createDataFrame([(0, 7, True), (1, 1, False), (2, 1, False)], "q int, rule int, strong boolean")
    got = {(r["q"], r["rule"]): (r["score"], r["hint"]) for r in scoring.score_rules(terms, "q", terms, weighted, stats, hints=hints).collect()}
    assert got == {(0, 7): (6, True), **{(i, 1): (8, True) if i == 1 else (6, False) for i in range(50) if i % 3 == 1}}
