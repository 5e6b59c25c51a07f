"""The compositions: papers to index and reports, index to distribution, questions to rule decisions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import ladders, text
from tessera.operators import hierarchy, lookup, scoring, sections
from tessera.sources.files import questions_of
from tessera.sources.scratch import written


def analyzed(questions: DataFrame, spans: DataFrame, seen: Column, skipped: Column, least: float = 0.60, order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(questions with subject, reports by paper).

    questions: path, kind, ordinal, n. spans: kind, number, subject, start, end of the layout that holds for the paper. The
    declared layout is compared with the subjects that the labels show, by section and by question; where it fails and the
    paper's own sections give a layout that decides, that one is taken. A paper is placeable if every question that is not
    skipped gets a subject.
    """
    q = questions.withColumns({"seen": seen, "skipped": skipped})
    q = sections.at_point(q, spans, ["kind"], "ordinal", "subject", "number").withColumnRenamed("subject", "declared")
    q = written(q, "questions")
    live = q.filter(~F.col("skipped"))
    by_question = sections.agreement(live, ["path"], F.col("declared"), F.col("seen"), least)
    ends = spans.select("kind", F.col("number").alias("span"), "start", "end")
    in_span = sections.expand_spans(ends, "start", "end", "ordinal").groupBy("kind", "ordinal").agg(F.min("span").alias("span"))
    # written, as the quality below, since one task would else hold the sorts and aggregates of all three at once
    by_section = written(sections.section_agreement(live.join(in_span, ["kind", "ordinal"]), ["path"], "span", "declared", "seen"), "by-section")
    layout = sections.detected_layout(live, "path", "ordinal", "n", "seen", order)
    quality = written(sections.layout_quality(live, "path", "ordinal", "n", "seen", least), "quality")
    report = by_question.withColumnRenamed("ok", "question_ok").join(by_section.select("path", F.col("agreement").alias("section_agreement"), F.col("comparable").alias("section_comparable")), "path", "left")
    report = report.join(quality.select("path", F.col("ok").alias("detected_ok"), "confidence"), "path", "left")
    report = written(report, "reports")
    evidence = F.col("comparable") + F.coalesce("section_comparable", F.lit(0))
    report = report.withColumn("source", sections.layout_verdict(F.col("question_ok"), F.col("section_agreement"), evidence, F.col("detected_ok"), least))
    points = sections.expand_spans(layout, "start", "end", "__at").select("path", "__at", F.col("subject").alias("detected"))
    q = q.join(report.select("path", "source"), "path", "left")
    at = F.row_number().over(sections.Window.partitionBy("path", "skipped").orderBy("ordinal"))
    q = q.withColumn("__at", at).join(points, ["path", "__at"], "left").drop("__at")
    subject = F.when(F.col("source") == "detected", F.col("detected")).when(F.col("source") != "none", F.col("declared"))
    q = q.withColumn("subject", F.when(~F.col("skipped"), subject)).drop("detected")
    placeable = q.filter(~F.col("skipped")).groupBy("path").agg((F.count("*") == F.count("subject")).alias("placeable"))
    counts = q.groupBy("path").agg(F.count("*").alias("questions"), F.count_if("skipped").alias("hidden"))
    q = written(q, "named")
    return q, report.join(placeable, "path", "left").join(counts, "path").withColumn("ok", F.col("source") != "none")


def build_index(papers: DataFrame, kinds: DataFrame, rules: DataFrame, spans: DataFrame, dims: Mapping[str, DataFrame], seen: Column, script: str = r"[ऀ-ॿ]") -> tuple[DataFrame, DataFrame]:
    """(index records, paper reports) of scanned papers: route each path to a kind, take the first layout rule that fits,
    flatten, leave out questions in the other script, place the rest by the resolution ladder. dims: aliases, chapters,
    topics, patterns of lookup.placed()."""
    q = questions_of(papers.withColumn("length", F.size("questions"))).select("path", "title", "year", "shift", "length", "ordinal", "q.*")
    routed = lookup.best_path(papers, "path", kinds)
    q = q.join(routed, "path").join(kinds.select("kind", "exam"), "kind")
    shape = q.select("path", "kind", "year", "length").distinct()
    fields = {"kind": "__kinds", "year": "years", "length": "lengths"}
    chosen = lookup.first_rule(shape, "path", rules.withColumn("__kinds", F.array("kind")), fields, "rule_no", "rule_no")
    q = q.join(chosen.select("path", "rule_no"), "path", "left").withColumn("layout", F.concat_ws("#", "kind", "rule_no"))
    laid = spans.select(F.concat_ws("#", "kind", "rule_no").alias("kind"), "number", "subject", "start", "end")
    opts = F.array_join(F.transform(ladders.options(F.col("options")), lambda o: o.text), " ")
    hidden = text.script_hit([text.text_of(F.col("question")), opts], script)
    named, reports = analyzed(q.withColumnRenamed("kind", "kind_id").withColumnRenamed("layout", "kind"), laid, seen, hidden)
    reports = written(reports, "paper-reports")
    able = reports.filter("placeable").select("path")
    kept = named.filter(~F.col("skipped")).join(able, "path", "left_semi").withColumn("row_id", F.concat_ws("|", "path", "ordinal"))
    placed = lookup.placed(kept, "row_id", "concept", "subject", dims["aliases"], dims["chapters"], dims["topics"], dims["patterns"])
    out = kept.withColumnRenamed("concept", "concept_raw").withColumnRenamed("source", "subject_source").drop("skipped", "declared", "seen").join(placed.withColumnRenamed("source", "class_source").withColumnRenamed("confidence", "class_confidence"), "row_id")
    images = F.size(text.extract_urls(F.concat_ws(" ", "question", "solution"))) > 0
    return written(out.withColumns({"paper_path": F.col("path"), "has_image": images, "status": F.when(F.col("chapter").isNull(), "unclassified").otherwise("placed")}).drop("path", "row_id"), "index"), reports


def distribution(index: DataFrame, latest: int) -> DataFrame:
    """Every node of subject, chapter, topic, concept with its importance."""
    rows = index.select(
        F.coalesce("subject", F.lit("UNKNOWN")).alias("subject"), F.coalesce("chapter", F.lit("_unclassified")).alias("chapter"), F.coalesce("topic", F.lit("")).alias("topic"),
        F.coalesce("concept", F.lit("_unclassified")).alias("concept"), "year",
    )
    return hierarchy.with_importance(hierarchy.nodes(rows, ["subject", "chapter", "topic", "concept"], "year", latest))


def rule_view(items: DataFrame, rules: DataFrame, stored: DataFrame, *, doc_id: str = "qid", body: str = "text", stop: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(items with their effective rule, shortlists of those without): corpus statistics first, then scores, the margin,
    and the merge with stored decisions. rules: rule, term arrays, signal_phrases."""
    terms = items.select(doc_id, F.explode(text.content_terms(F.col(body), stop)).alias("term"))
    stats = scoring.document_frequency(items, doc_id, text.content_terms(F.col(body), stop))
    phrases = rules.select("rule", F.explode("signal_phrases").alias("phrase"))
    n = items.agg(F.count("*").alias("__n"))
    df = scoring.phrase_frequency(items, doc_id, body, phrases).join(F.broadcast(n)).withColumn("rarity", scoring.rarity(F.col("df") / F.col("__n")))
    hits = scoring.phrase_hits(items, doc_id, body, phrases, df)
    scored = scoring.score_rules(items, doc_id, terms, scoring.rule_terms(rules), stats, hits)
    specific = rules.select("rule", scoring.specificity("title_terms", "topic_terms", "signal_words", "signal_phrases").alias("terms"))
    decided = scoring.decide(scored, doc_id, specific)
    out = scoring.effective(items, decided, stored, ladders.accepted(F.col("confidence"), F.coalesce("same_model_fallback", F.lit(False))), doc_id)
    return out, scoring.shortlist(scored, doc_id, specific).join(out.filter("rule is null").select(doc_id), doc_id, "left_semi")
