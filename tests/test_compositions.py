import json

from pyspark.sql import functions as F

from tessera.functions import ladders, text
from tessera.operators import hierarchy, lookup, scoring, state, taxonomy
from tessera.plans import indexing
from tessera.sources import files, settings

ALIASES = [("algebra", "Algebra", "MATH", "Algebra", None), ("physics", "Physics", "GK", "Science", None)]
CHAPTERS = [("MATH", "Algebra", 0), ("MATH", "Time and Distance", 1), ("GK", "Science", 2), ("GK", "History", 3)]


def dims(spark):
    return {
        "aliases": spark.createDataFrame(ALIASES, "key string, canonical string, subject string, chapter string, topic string"),
        "chapters": spark.createDataFrame(CHAPTERS, "subject string, name string, number int"),
        "topics": spark.createDataFrame([("GK", "Mughal Empire", "History", 0)], "subject string, name string, chapter string, number int"),
        "patterns": spark.createDataFrame([("MATH", 0, "surd|root", "Algebra")], "subject string, number int, pattern string, target string"),
    }


def test_ladder(spark):
    rows = spark.createDataFrame(
        [(1, "Algebra", "MATH"), (2, "Physics", "MATH"), (3, "speed time and distance", "MATH"), (4, "Mughal Empire art", "GK"), (5, "Surds", "MATH"), (6, "Nothing", "GK"), (7, "distance time", "MATH")],
        "i int, c string, s string",
    )
    got = {r["i"]: (r["concept"], r["chapter"], r["source"], r["confidence"]) for r in lookup.placed(rows, "i", "c", "s", **dims(spark)).collect()}
    assert got[1] == ("Algebra", "Algebra", "alias", "high") and got[2] == ("Physics", None, "alias", "high")
    assert got[3] == ("Time and Distance", "Time and Distance", "chapter", "medium") and got[4][1] == "History"
    assert got[5] == ("Algebra", "Algebra", "keyword", "low") and got[6] == (None, None, "unmapped", "low") and got[7][1] == "Time and Distance"


def test_build_index(spark, tmp_path):
    (tmp_path / "CGL 2021").mkdir()
    qs = [{"qid": f"m{i}", "n": i, "concept": "Algebra", "question": "x"} for i in range(1, 5)] + [{"qid": f"g{i}", "n": i, "concept": "Physics", "question": "y http://i/p.png"} for i in range(1, 4)]
    qs.append({"qid": "h", "n": 4, "concept": "Physics", "question": "हिन्दी"})
    (tmp_path / "CGL 2021" / "a.json").write_text(json.dumps({"title": "t", "questions": qs}))
    papers = files.scan_papers(spark, f"file://{tmp_path}")
    doc = {"exams": [{"code": "CGL", "kinds": [{"id": "cgl1", "includes": ["cgl"], "rules": [{"years": [2019], "spans": [["GK", 1, 8]]}, {"spans": [["MATH", 1, 4], ["GK", 5, 8]]}]}]}]}
    kinds, rules, spans = settings.layout_tables(spark, doc)
    seen = ladders.by_label(F.col("concept"), {"algebra": "MATH", "physics": "GK"}, [], [])
    index, reports = indexing.build_index(papers, kinds, rules, spans, dims(spark), seen)
    got = {r["qid"]: (r["subject"], r["chapter"], r["exam"], r["has_image"], r["status"]) for r in index.collect()}
    assert len(got) == 7 and got["m1"] == ("MATH", "Algebra", "CGL", False, "placed") and got["g1"] == ("GK", "Science", "CGL", True, "placed")
    r = reports.first()
    assert (r["source"], r["questions"], r["hidden"], r["placeable"]) == ("canonical", 8, 1, True)
    nodes = indexing.distribution(index, 2021)
    assert nodes.filter("level = 1").count() == 2 and nodes.agg(F.max("importance")).first()[0] > 50
    assert lookup.raw_questions(papers, index.select("qid", F.col("paper_path"))).count() == 7
    assert hierarchy.paper_summary(reports.withColumn("exam", F.lit("CGL")).withColumn("skipped", F.col("hidden"))).first()["validated"] == 1
    flagged = files.write_reports(reports, spark.createDataFrame([(1, True)], "placed int, balanced boolean"), f"file://{tmp_path}/out")
    assert flagged.count() == 0 and files.read_document(spark, f"file://{tmp_path}/out/coverage.json") == {"placed": 1, "balanced": True}


def test_reordered_sections_take_the_detected_layout(spark):
    qs = [("p", "k", i, i if i <= 4 else i - 4, "GK" if i <= 4 else "MATH") for i in range(1, 9)]
    q = spark.createDataFrame(qs, "path string, kind string, ordinal int, n int, label string")
    spans = spark.createDataFrame([("k", 0, "MATH", 1, 4), ("k", 1, "GK", 5, 8)], "kind string, number int, subject string, start int, end int")
    named, reports = indexing.analyzed(q, spans, F.col("label"), F.lit(False))
    assert reports.first()["source"] == "detected" and {(r["ordinal"], r["subject"]) for r in named.collect()} == {(i, "GK" if i <= 4 else "MATH") for i in range(1, 9)}


def test_rule_view(spark):
    rules = spark.createDataFrame(
        [(1, ["since"], [], [], [], [], ["due to"]), (2, ["voice"], ["passive"], [], ["since"], [], [])],
        "rule int, title_terms array<string>, topic_terms array<string>, signal_words array<string>, body_terms array<string>, example_terms array<string>, signal_phrases array<string>",
    )
    items = spark.createDataFrame([("a", "since monday"), ("b", "the passive voice"), ("c", "it was due to rain"), ("d", "nothing here"), ("e", "other words"), *((f"z{i}", f"filler{i} thing{i}") for i in range(120))], "qid string, text string")
    stored = spark.createDataFrame([("d", 2, 0.9, False, False), ("e", 1, 0.5, False, False), ("b", 1, 0.95, True, False)], "qid string, rule int, confidence double, veto boolean, same_model_fallback boolean")
    out, short = indexing.rule_view(items, rules, stored)
    got = {r["qid"]: (r["rule"], r["source"], r["reason"]) for r in out.collect() if not r["qid"].startswith("z")}
    assert got["a"] == (1, "keyword", None) and got["b"] == (1, "review", None) and got["d"] == (2, "stored", None)
    assert got["c"] == (None, None, "weak") and got["e"] == (None, None, "low_confidence")
    assert [(r["qid"], r["rule"]) for r in short.collect()] == [("c", 1)]


def test_small_operators(spark):
    df = spark.createDataFrame([("q1", "Time & Work", ["a", "b"], "ENG", None), ("q2", "Verb", [], "ENG", "Grammar")], "qid string, concept string, tags array<string>, subject string, chapter string")
    owned = lookup.owners(spark.createDataFrame([("Time & Work", "MATH"), ("Verb", "ENG")], "name string, subject string"))
    assert [r["concept"] for r in taxonomy.hygiene(df, owned, "subject", "concept", "chapter").orderBy("qid").collect()] == [None, "Verb"]
    labels = taxonomy.canonical_labels(spark.createDataFrame([("VERB",)], "label string"))
    ch = spark.createDataFrame([("ENG", "Grammar", 0)], "subject string, chapter string, number int")
    declared = spark.createDataFrame([("ENG", "grammar", "noun", "Noun")], "subject string, chapter_key string, key string, topic string")
    fin = {r["qid"]: (r["concept"], r["leaf_bucket"]) for r in taxonomy.finalized(df, owned, labels, declared, ch, "subject", "concept", "chapter").collect()}
    assert fin == {"q1": (None, None), "q2": ("VERB", "_other")}
    assert [r["label"] for r in taxonomy.raw_labels(df).collect()] == ["Time & Work", "Verb", "a", "b"]
    row = df.filter("qid = 'q1'").select(
        text.question_text(F.col("concept"), F.col("tags"), F.lit("**p** [IMAGE: x]"), F.array(F.lit("o"))).alias("t"),
        ladders.pinned(F.array(F.lit("x"), F.lit("y"), F.lit("x"), F.lit("z")), F.lit("z"), F.lit("x")).alias("p"),
        ladders.agreement_candidate(F.lit("Bread and butter is here"), F.array(F.lit("a")), "bread and butter", "is|has", "are|have").alias("g"),
        ladders.is_task([F.lit("Vocabulary")], F.lit("fill the blank"), F.lit(""), veto_topic="vocabulary", veto="vocabulary", generic="grammar", table={"voice": "v"}, wording="tense", rules=[("f", "fill")]).alias("v"),
        ladders.is_task([F.lit("x")], F.lit("fill the blank"), F.lit(""), veto_topic="vocabulary", veto="vocabulary", generic="grammar", table={"voice": "v"}, wording="tense", rules=[("f", "fill")]).alias("w"),
        ladders.status_of(F.lit(None).cast("int"), F.lit("503")).alias("s"),
    ).first()
    assert (row["t"], row["p"], row["g"], row["v"], row["w"], row["s"]) == ("Time & Work a b p o", ["z", "y", "x"], True, False, True, 503)
    packs = spark.createDataFrame([("k", "i", ["q2", "gone"])], "kind string, id string, items array<string>")
    assert [(r["position"], r["known"]) for r in lookup.enriched(packs, df).orderBy("position").collect()] == [(0, True), (1, False)]
    wrong = lookup.split_repairs(df, "chapter")
    assert [w.count() for w in wrong] == [1, 1]
    verdicts = spark.createDataFrame([("q1", False, "Work", 0.9, "r"), ("q2", False, "x", 0.5, "r")], "qid string, ok boolean, concept string, confidence double, reason string")
    assert state.corrections_from(df, verdicts, ["qid"]).count() == 1 and state.assigned(packs).count() == 2
    m = hierarchy.rolled(df, "subject", spark.createDataFrame([("ENG",), ("GK",)], "subject string"), "chapter")
    assert {r["subject"]: (r["count"], r["by_chapter"]) for r in m.collect()} == {"ENG": (2, {"Grammar": 1}), "GK": (0, {})}
    assert scoring.rarity(F.lit(0.02)) is not None and files.pointer(df, ["qid", "absent"]).columns == ["qid", "absent"]
    assert ladders.rule_table(spark, {"a": "M"}, ["b"], [("G", "x")]).count() == 3
