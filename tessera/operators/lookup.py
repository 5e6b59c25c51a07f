"""Dimension lookups: defaults, several probes, ordered rules, containment and token overlap.

Dimensions are small tables that carry a declaration number; the joins are on equality wherever the rule allows it. What
can't be is one expression over the rows, with the rules as literals, where there are at most LITERALS rules; more of them
are joined on the condition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.ladders import first_of
from tessera.functions.text import key_tokens, norm_key, norm_space
from tessera.operators.phrases import phrases_in


LITERALS = 256


def _literals(rules: DataFrame) -> list | None:
    """The rows of a rule table; None if there are more than LITERALS."""
    found = rules.limit(LITERALS + 1).collect()
    return found if len(found) <= LITERALS else None


def resolve(rows: DataFrame, value: str, aliases: DataFrame, *, key: str = "key", canonical: str = "canonical") -> DataFrame:
    """rows with canonical and source: the alias of the value's key, else the value itself as observed."""
    a = aliases.select(F.col(key).alias("__key"), F.col(canonical).alias("__canonical"))
    out = rows.withColumn("__probe", norm_key(F.col(value))).join(a, F.col("__probe") == F.col("__key"), "left")
    known = F.col("__key").isNotNull()
    return out.withColumn("canonical", F.when(known, F.col("__canonical")).otherwise(norm_space(F.col(value)))).withColumn(
        "source", F.when(known, F.lit("alias")).otherwise(F.lit("observed"))
    ).drop("__probe", "__key", "__canonical")


def resolve_any(rows: DataFrame, row_id: str, probes: Column, aliases: DataFrame, *, key: str = "key", canonical: str = "canonical") -> DataFrame:
    """row_id, canonical, probe_no: of an array of probes the first that an alias names."""
    p = rows.select(row_id, F.posexplode(probes).alias("probe_no", "probe")).withColumn("__key", norm_key(F.col("probe")))
    hit = p.join(aliases.select(F.col(key).alias("__key"), canonical).filter(F.col(canonical).isNotNull()), "__key")
    return hit.groupBy(row_id).agg(F.min_by(canonical, "probe_no").alias("canonical"), F.min("probe_no").alias("probe_no"))


def first_rule(rows: DataFrame, row_id: str, rules: DataFrame, fields: Mapping[str, str], number: str, value: str) -> DataFrame:
    """row_id and value: of the rules that fit, the first by number. fields: a column of rows and the rules' set (array) of
    values for it, null where any value does; a null in rows is in no set.

    Rules are told apart by which of their sets are null, at most 2 ** fields ways. Those of one way are a table by their
    values, each with its first rule, and meet the rows on equality; the least of all ways wins. So there is no nested loop
    for any number of rules, and rows are not multiplied.
    """
    best = F.min(F.struct(F.col(number).alias("number"), F.col(value).alias("value"))).alias("__best")
    open_ = F.array(*(F.col(c).isNull() for c in fields.values()))
    masks = sorted(tuple(r[0]) for r in rules.select(open_).distinct().collect())
    out, hits = rows.select(row_id, *(F.col(c).alias(f"__f{k}") for k, c in enumerate(fields))), []
    for m, mask in enumerate(masks):
        able = rules.filter(reduce(lambda a, b: a & b, (F.col(c).isNull() == o for c, o in zip(fields.values(), mask, strict=True))))
        keys = []
        for k, (c, free) in enumerate(zip(fields.values(), mask, strict=True)):
            if not free:
                able = able.withColumn(f"__f{k}", F.explode(F.col(c)))
                keys.append(f"__f{k}")
        hits.append(f"__hit{m}")
        if keys:
            out = out.join(able.groupBy(*keys).agg(best).withColumnRenamed("__best", hits[-1]), keys, "left")
        else:
            kinds = [rules.schema[c].dataType for c in (number, value)]
            first = able.agg(best).first()[0]  # one rule
            out = out.withColumn(hits[-1], F.struct(*(F.lit(x).cast(t).alias(n) for x, t, n in zip(first, kinds, ("number", "value"), strict=True))))
    if not hits:
        return out.select(row_id, F.lit(None).cast(rules.schema[number].dataType).alias(number), F.lit(None).cast(rules.schema[value].dataType).alias(value)).limit(0)
    won = out.withColumn("__won", F.least(*hits) if len(hits) > 1 else F.col(hits[0])).filter("__won is not null")
    return won.select(row_id, F.col("__won.number").alias(number), *([F.col("__won.value").alias(value)] if value != number else [])).distinct()


def best_path(rows: DataFrame, path: str, kinds: DataFrame) -> DataFrame:
    """path and kind: the kind whose includes are all in the path and whose excludes are not; the one with the longest
    include wins, the first declared of equals. kinds: kind, number, includes, excludes."""
    p = F.lower(F.col(path))
    literal = _literals(kinds)
    if literal is not None:
        able = [k for k in literal if k["includes"] is not None and k["excludes"] is not None]
        able.sort(key=lambda k: (-max((len(i) for i in k["includes"] if i is not None), default=0), k["number"], k["kind"]))
        held = lambda words: [p.contains(F.lower(F.lit(w))) for w in words]
        every = lambda k: reduce(lambda a, b: a & b, [*held(k["includes"]), *(~e for e in held(k["excludes"]))], F.lit(True))
        kind = first_of([(every(k), F.struct(F.lit(k["kind"]).alias("kind"))) for k in able], F.lit(None).cast("struct<kind:string>"))
        return rows.select(path).distinct().withColumn("__hit", kind).filter("__hit is not null").select(path, "__hit.kind")
    fits = F.forall("includes", lambda i: p.contains(F.lower(i))) & ~F.exists("excludes", lambda e: p.contains(F.lower(e)))
    hit = rows.select(path).distinct().join(F.broadcast(kinds), fits)
    longest = F.aggregate("includes", F.lit(0), lambda a, i: F.greatest(a, F.length(i)))
    return hit.groupBy(path).agg(F.min(F.struct((-longest).alias("l"), F.col("number").alias("n"), F.col("kind").alias("k")))["k"].alias("kind"))


def contained(rows: DataFrame, row_id: str, text: str, names: DataFrame, least: int = 4) -> DataFrame:
    """row_id, name, number: the longest name found in the text on word boundaries, the first declared of equals; one pass
    of an automaton. names: name, number."""
    n = names.withColumn("key", norm_key(F.col("name"))).filter(F.length("key") >= least)
    hit = phrases_in(rows, row_id, norm_key(F.col(text)), n).join(n, "key")
    best = F.min(F.struct((-F.length("key")).alias("l"), F.col("number").alias("number"), F.col("name").alias("name"))).alias("b")
    return hit.groupBy(row_id).agg(best).select(row_id, "b.name", "b.number")


def overlapping(rows: DataFrame, row_id: str, text: str, names: DataFrame, least: float = 0.6) -> DataFrame:
    """row_id, name, overlap: the name with the largest share of its tokens (of 3 characters and more) in the text, from
    least up, the first declared of equals. They meet on tokens."""
    t = rows.select(row_id, F.explode(F.array_distinct(key_tokens(F.col(text), 3))).alias("__token"))
    n = names.withColumn("__tokens", F.array_distinct(key_tokens(F.col("name"), 3)))
    n = n.select("name", "number", F.size("__tokens").alias("__of"), F.explode("__tokens").alias("__token"))
    hits = t.join(n, "__token").groupBy(row_id, "name", "number", "__of").agg(F.count("*").alias("__hits"))
    hits = hits.withColumn("overlap", F.col("__hits") / F.col("__of")).filter(F.col("overlap") >= least)
    best = F.min(F.struct((-F.col("overlap")).alias("o"), F.col("number").alias("n"), F.col("name").alias("name"))).alias("b")
    return hits.groupBy(row_id).agg(best).select(row_id, "b.name", (-F.col("b.o")).alias("overlap"))


def by_pattern_rule(rows: DataFrame, row_id: str, text: str, rules: DataFrame) -> DataFrame:
    """row_id, target: the first rule (number, pattern, target) whose pattern begins at a word's start in the text."""
    lowered = rows.select(row_id, F.lower(norm_space(F.col(text))).alias("__text"))
    literal = _literals(rules.select("number", "pattern", "target"))
    if literal is not None:
        typed = f"struct<target:string,rule:{rules.schema['number'].dataType.simpleString()}>"
        ordered = sorted((x for x in literal if x["pattern"] is not None), key=lambda x: x["number"])
        value = lambda x: F.struct(F.lit(x["target"]).alias("target"), F.lit(x["number"]).alias("rule")).cast(typed)
        hit = first_of([(F.col("__text").rlike(f"\\b(?:{x['pattern']})"), value(x)) for x in ordered], F.lit(None).cast(typed))
        return lowered.select(row_id, hit.alias("__hit")).filter("__hit is not null").select(row_id, "__hit.target", "__hit.rule")
    hit = lowered.join(F.broadcast(rules), F.expr("__text rlike concat('\\\\b(?:', pattern, ')')"))
    return hit.groupBy(row_id).agg(F.min_by("target", "number").alias("target"), F.min("number").alias("rule"))


def longest_key(rows: DataFrame, path: str, blocks: DataFrame) -> DataFrame:
    """path, block: the block of the longest key (key, block) that the path contains; empty if none."""
    literal = _literals(blocks.select("key", "block"))
    if literal is not None:
        ordered = sorted((b for b in literal if b["key"] is not None), key=lambda b: (len(b["key"]), b["key"]), reverse=True)
        block = first_of([(F.col(path).contains(b["key"]), b["block"] or "") for b in ordered], "")
        return rows.select(path).distinct().withColumn("block", block)
    hit = rows.select(path).distinct().join(F.broadcast(blocks), F.col(path).contains(F.col("key")), "left")
    return hit.groupBy(path).agg(F.coalesce(F.max_by("block", F.struct(F.length("key"), "key")), F.lit("")).alias("block"))


def owners(names: DataFrame, name: str = "name", subject: str = "subject") -> DataFrame:
    """key, owners (sorted): which subjects declare a name."""
    keyed = names.select(norm_key(F.col(name)).alias("key"), subject).filter("key <> ''").distinct()
    return keyed.groupBy("key").agg(F.array_sort(F.collect_set(subject)).alias("owners"))


def foreign(owned: Column, subject: Column) -> Column:
    """The owners other than the subject; of an unknown name none."""
    return F.array_remove(F.coalesce(owned, F.array().cast("array<string>")), subject)


def only_foreign(owned: Column, subject: Column) -> Column:
    known = F.coalesce(owned, F.array().cast("array<string>"))
    return (F.size(known) > 0) & ~F.array_contains(known, subject)


def ownership_verdict(chapter: Column, chapter_owners: Column, concept: Column, concept_owners: Column, labels_owned: Column, subject: Column) -> Column:
    """wrong, ambiguous or ok: the chapter decides; without one the concept names the place."""
    shared = F.exists(F.coalesce(labels_owned, F.array().cast("array<array<string>>")), lambda o: F.size(foreign(o, subject)) > 0)
    has_chapter = F.coalesce(chapter, F.lit("")) != ""
    has_concept = F.coalesce(concept, F.lit("")) != ""
    return (
        F.when(has_chapter & only_foreign(chapter_owners, subject), "wrong").when(has_chapter & shared, "ambiguous").when(has_chapter, "ok")
        .when(~has_concept, "ok").when(only_foreign(concept_owners, subject), "wrong").when(shared, "ambiguous").otherwise("ok")
    )


def foreign_level(chapter_owners: Column, topic_owners: Column, subject: Column) -> Column:
    return F.when(F.size(foreign(chapter_owners, subject)) > 0, "chapter").when(F.size(foreign(topic_owners, subject)) > 0, "topic").otherwise("concept")


def single_foreign(label_owners: Column, subject: Column) -> Column:
    """Whether a label is owned by exactly one subject, and that another one."""
    return F.exists(label_owners, lambda o: (F.size(o) == 1) & ~F.array_contains(o, subject))


def placed(rows: DataFrame, row_id: str, concept: str, subject: str, aliases: DataFrame, chapters: DataFrame, topics: DataFrame, patterns: DataFrame) -> DataFrame:
    """The resolution ladder: row_id, concept, chapter, topic, source, confidence.

    Alias first (of another subject: without its chapter); then a chapter by exact name, by containment, by the chapter
    of a topic, by token overlap (not for an alias of another subject); then pattern rules; else unmapped.
    aliases: key, canonical, subject, chapter, topic. chapters: subject, name, number. topics: subject, name, chapter,
    number. patterns: subject, number, pattern, target.
    """
    key = norm_key(F.col(concept))
    a = aliases.select(F.col("key").alias("__k"), "canonical", F.col("subject").alias("__as"), F.col("chapter").alias("__ac"), F.col("topic").alias("__at"))
    base = rows.select(row_id, F.col(concept).alias("__raw"), F.col(subject).alias("__s"), key.alias("__key")).join(a, F.col("__key") == F.col("__k"), "left")
    cross = F.col("__as").isNotNull() & (F.col("__as") != F.col("__s"))
    base = base.withColumns({
        "__cross": F.coalesce(cross, F.lit(False)), "__chapter": F.when(~F.coalesce(cross, F.lit(False)), F.col("__ac")),
        "__topic": F.when(~F.coalesce(cross, F.lit(False)), F.col("__at")), "__text": F.coalesce("canonical", "__raw"),
    })
    chapter_key = chapters.select(F.col("subject").alias("__s"), norm_key(F.col("name")).alias("__key2"), F.col("name").alias("__exact"))
    base = base.withColumn("__key2", norm_key(F.col("__text"))).join(chapter_key.dropDuplicates(["__s", "__key2"]), ["__s", "__key2"], "left")
    held = _within(base, row_id, chapters, 4).select(row_id, F.col("name").alias("__held"))
    topical = _within(base, row_id, topics, 5).select(row_id, F.col("name").alias("__tname"), F.col("chapter").alias("__tchapter"))
    t = base.select(row_id, "__s", F.explode(F.array_distinct(key_tokens(F.col("__text"), 3))).alias("__token"))
    n = chapters.withColumn("__tokens", F.array_distinct(key_tokens(F.col("name"), 3))).select(
        F.col("subject").alias("__s"), "name", "number", F.size("__tokens").alias("__of"), F.explode("__tokens").alias("__token")
    )
    near = t.join(n, ["__s", "__token"]).groupBy(row_id, "name", "number", "__of").agg(F.count("*").alias("__h")).filter(F.col("__h") / F.col("__of") >= 0.6)
    near = near.groupBy(row_id).agg(F.min(F.struct((-F.col("__h") / F.col("__of")).alias("o"), "number", "name"))["name"].alias("__near"))
    p = _by_subject_pattern(base, row_id, patterns)
    for d in (held, topical, near, p):
        base = base.join(d, row_id, "left")
    local = F.coalesce("__exact", "__held", "__tchapter", F.when(~F.col("__cross"), F.col("__near")))
    chapter = F.coalesce("__chapter", local, "__target")
    source = (
        F.when(F.col("canonical").isNotNull() & F.col("__chapter").isNotNull(), "alias").when(local.isNotNull(), "chapter")
        .when(F.col("__target").isNotNull(), "keyword").when(F.col("canonical").isNotNull(), "alias").otherwise("unmapped")
    )
    confidence = (
        F.when(source == "alias", "high").when(source == "chapter", "medium")
        .when((source == "keyword") & F.col("canonical").isNotNull(), "medium").otherwise("low")
    )
    return base.select(
        row_id, F.coalesce("canonical", chapter).alias("concept"), chapter.alias("chapter"),
        F.when(chapter.isNotNull(), F.coalesce("__topic", F.when(source != "keyword", F.col("__tname")))).alias("topic"), source.alias("source"), confidence.alias("confidence"),
    )


def _by_subject_pattern(base: DataFrame, row_id: str, patterns: DataFrame) -> DataFrame:
    """row_id, __target: the first pattern of the row's subject that begins at a word's start in __raw."""
    rules = patterns.select(F.col("subject").alias("__ps"), "number", "pattern", "target")
    literal = _literals(rules)
    if literal is None:
        p = base.join(rules, (F.col("__s") == F.col("__ps")) & F.expr("lower(__raw) rlike concat('\\\\b(?:', pattern, ')')"))
        return p.groupBy(row_id).agg(F.min_by("target", "number").alias("__target"))
    able = sorted((x for x in literal if x["pattern"] is not None and x["__ps"] is not None), key=lambda x: x["number"])
    hit = first_of([((F.col("__s") == x["__ps"]) & F.lower("__raw").rlike(f"\\b(?:{x['pattern']})"), F.struct(F.lit(x["target"]).alias("t"))) for x in able], F.lit(None).cast("struct<t:string>"))
    return base.select(row_id, hit.alias("__hit")).filter("__hit is not null").select(row_id, F.col("__hit.t").alias("__target"))


def _within(base: DataFrame, row_id: str, names: DataFrame, least: int) -> DataFrame:
    n = names.withColumn("key", norm_key(F.col("name"))).filter(F.length("key") >= least).withColumnRenamed("subject", "__s")
    hit = phrases_in(base, row_id, norm_key(F.col("__text")), n).join(base.select(row_id, "__s"), row_id).join(n, ["__s", "key"])
    rank = Window.partitionBy(row_id).orderBy(F.length("key").desc(), "number")
    return hit.withColumn("__r", F.row_number().over(rank)).filter("__r = 1")


def raw_questions(papers: DataFrame, records: DataFrame, path: str = "path", qid: str = "qid") -> DataFrame:
    """The questions of records: only papers that they name are exploded; of a reused id the last paper's last one."""
    needed = records.select(F.col("paper_path").alias(path)).distinct()
    q = papers.join(needed, path, "left_semi").select(path, F.posexplode("questions").alias("__at", "q"))
    q = q.select(path, "__at", "q.*").join(records.select(qid).distinct(), qid, "left_semi")
    w = Window.partitionBy(qid).orderBy(F.desc(path), F.desc("__at"))
    return q.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r", "__at")


def found(rows: DataFrame, column: str, value: str, order: Sequence[str]) -> DataFrame:
    """The first row with the value."""
    return rows.filter(F.col(column) == value).orderBy(*order).limit(1)


def enriched(packs: DataFrame, pointers: DataFrame, on: str = "qid", items: str = "items") -> DataFrame:
    """kind, id, position, the item and its pointer's columns, in order; known: whether there is a pointer."""
    rows = packs.select("kind", "id", F.posexplode(items).alias("position", on))
    p = pointers.dropDuplicates([on]).withColumn("known", F.lit(True))
    return rows.join(p, on, "left").withColumn("known", F.coalesce("known", F.lit(False)))


def verdict_report(rows: DataFrame, group: Sequence[str], sample: str, most: int = 5) -> DataFrame:
    """For each group its count and its first different samples, the largest groups first. Samples are counted by value and
    ranked, so a group's are never gathered."""
    each = rows.groupBy(*group, sample).agg(F.count("*").alias("__n"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.asc_nulls_last(sample)))
    kept = each.filter(F.col(sample).isNotNull()).withColumn("__r", rank).filter(F.col("__r") <= most)
    cols = [F.col(c).alias(f"__g{k}") for k, c in enumerate(group)]
    named = kept.groupBy(*cols).agg(F.array_sort(F.collect_list(sample)).alias("samples"))
    counts = each.groupBy(*group).agg(F.sum("__n").alias("count"))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__g{k}")) for k, c in enumerate(group)))
    none = F.array().cast(named.schema["samples"].dataType)
    out = counts.join(named, same, "left").select(*group, "count", F.coalesce("samples", none).alias("samples"))
    return out.orderBy(F.desc("count"), *group)


def split_repairs(wrong: DataFrame, chapter: str) -> tuple[DataFrame, DataFrame]:
    """Wrong rows that a chapter blocks, and those whose concept can be cleared."""
    blocked = F.coalesce(F.col(chapter), F.lit("")) != ""
    return wrong.filter(blocked), wrong.filter(~blocked)
