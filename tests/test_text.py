import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tessera.functions import ladders, text
from tessera.plans import registry


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items()))
    return row.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("raw, want", [(None, ""), ("  a \t\n b  ", "a b"), ("a  b", "a b"), ("", "")])
def test_norm_space(spark, raw, want):
    assert one(spark, text.norm_space(F.col("x")), x=raw) == want


def test_keys(spark):
    assert one(spark, text.norm_key(F.col("x")), x="Profit & Loss/Gain-2.0") == "profit and loss gain 2 0"
    assert one(spark, text.fold_key(F.col("x")), x=" Éclair  STRAßE ﬁn") == "eclair strasse fin"
    assert one(spark, text.slugify(F.col("x")), x="  A & B: c!") == "a-and-b-c"
    assert one(spark, text.slugify(F.col("x")), x="देव") == "unclassified"


def test_labels_keep_nested_parentheses(spark):
    assert one(spark, text.split_labels(F.col("x")), x="a (b, c (d, e)), f,, (g) ") == ["a (b, c (d, e))", "f", "(g)"]
    assert one(spark, text.split_labels(F.col("x")), x=None) == []


def test_contains_phrase_needs_word_boundaries(spark):
    f = text.contains_phrase(F.col("x"), F.col("y"))
    assert not one(spark, f, x="mensuration", y="ratio") and one(spark, f, x="speed time and distance", y="time and distance")
    assert not one(spark, f, x="", y="a") and not one(spark, f, x="a", y="")


def test_prompt_parts(spark):
    got = one(spark, text.split_prompt(F.col("x")), x="Pick one [IMAGE: z]\r\n\r\nthe  word\n\n\nmore")
    assert (got.instruction, got.payload) == ("Pick one", "the word\n\nmore")
    deny, instruction = r"(?i)options?\b|choose the correct", r"(?i)select|choose|direction"
    asked = text.asked_term(F.col("x"), instruction, deny)
    assert one(spark, asked, x="**Select the synonym of the word.**\n\nScintillating") == "Scintillating"
    assert one(spark, asked, x="Direction: Select the synonym. ABANDON") == "ABANDON"
    assert one(spark, asked, x="It is __splendid__ here") == "splendid"
    assert one(spark, text.spelling_target(F.col("a"), F.col("b"), deny), a="x", b="the __wrod__ is") == "wrod"


def test_quotes_and_signals(spark):
    q = text.quoted(F.col("x"), ["verb"])
    assert one(spark, q, x='Use “due to”, "Due To" and “verb” or “not only...but also”') == ["due to", "not only...but also"]
    assert one(spark, text.signal_phrases(F.col("x")), x=["due to", "not only...but also", "word"]) == ["due to", "not only but also"]
    assert one(spark, text.signal_words(F.col("x")), x=["due to", "Since", "an"]) == ["since"]
    assert one(spark, text.sentences(F.col("x")), x="One. Two!  Three") == ["One.", "Two!", "Three"]


def test_paths(spark):
    assert one(spark, text.collapse_levels(F.array(F.lit("a"), F.lit("a"), F.lit(None), F.lit("b"), F.lit("a"))), x="") == ["a", "b", "a"]
    path = text.leaf_path(F.col("c"), F.col("t"), F.col("k"), F.lit(True))
    assert one(spark, path, c="Vocabulary", t="Vocabulary", k="Antonym") == ["vocabulary", "_other", "antonym"]
    assert one(spark, path, c=None, t=None, k=None) == ["_unclassified"]


def test_year_and_date(spark):
    got = one(spark, text.year_of_path(F.col("p"), F.col("t")), p="x/CGL 2021/y 2019 z/f.json", t="2020")
    assert (got.year, got.source) == (2019, "folder:y 2019 z")
    assert one(spark, text.year_of_path(F.col("p"), F.col("t")), p="a/b", t="held 2020").year == 2020
    assert one(spark, text.held_on(F.col("t")), t="Paper held on 3 January 2024").iso == "2024-01-03"
    assert one(spark, text.held_on(F.col("t")), t="Paper").iso == ""


def test_redact(spark):
    got = one(spark, text.redact(F.col("x")), x="token: abcdef123456 and Bearer abc.def-ghi at ?key=zz&q=1 " + "y" * 400)
    assert "abcdef" not in got and "abc.def" not in got and "key=<redacted>" in got and len(got) <= 300


def test_redact_query_hashes_whole_texts(spark, tmp_path):
    long = "ab cd " * 180_000 + "me@x.org end"
    spark.createDataFrame([(1, long), (2, "short a@b.c")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["h"] for r in registry.QUERIES["redact"](spark, str(tmp_path)).collect()}
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    assert len(long) > 1 << 20 and got == {1: md5(long.replace("me@x.org", "<mail>")), 2: md5("short <mail>")}


def test_ladders(spark):
    kind = ladders.failure_kind(F.col("s"), F.col("m"))
    for s, m, want in [(401, "", "auth"), (429, "", "rate_limit"), (200, "<html>", "http"), (None, "invalid JSON", "bad_json"), (None, "timed out", "transport"), (500, "x", "http"), (None, "x", "other")]:
        row = spark.createDataFrame([(s, m)], "s int, m string")
        assert row.select(kind.alias("k")).first()["k"] == want
    assert one(spark, ladders.json_text(F.col("x")), x='well: {"a": 1} ok') == '{"a": 1}'
    assert one(spark, ladders.json_text(F.col("x")), x="no") is None
    v = one(spark, ladders.verdict(F.col("x")), x='```json\n{"ok": false, "confidence": 7}\n```')
    assert v.ok is False and v.confidence == 1.0
    d = one(spark, ladders.decisions(F.col("x"), 129), x='{"items": [{"id": "q1", "rule": 5, "confidence": -1}, {"id": "q2", "rule": 500}, {"rule": 2}]}')
    assert [(r.qid, r.rule, r.confidence) for r in d] == [("q1", 5, 0.0)]
    assert [(o.label, o.text) for o in one(spark, ladders.options(F.col("x")), x='{"A": {"label": "1", "text": "x"}, "B": "y"}')] == [("1", "x"), ("B", "y")]
    assert [(o.label, o.text) for o in one(spark, ladders.options(F.col("x")), x='["x", {"label": "b", "text": "y"}]')] == [("", "x"), ("b", "y")]
    got = one(spark, ladders.by_label(F.col("x"), {"algebra": "MATH"}, ["misc"], [("GK", "history|polity")]), x="Misc, World History (a, b), Algebra")
    assert got == "GK"
    assert datetime.min
