"""Dimensions of a taxonomy: names, scopes, aliases, relocation and merging, on flat tables.

chapter(subject, chapter, number) · topic(subject, chapter, topic, number) · concept(subject, chapter, topic or null,
concept, number). Numbers give the order of declaration.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import after_dash, key_tokens, name_like, norm_key, norm_space
from tessera.operators.rank import first_wins


def all_names(chapters: DataFrame, topics: DataFrame, concepts: DataFrame, topic_concepts: bool = False) -> DataFrame:
    """subject, chapter, topic, name, kind, number: chapters, topics, and the concepts of chapters (of topics on demand)."""
    c = chapters.select("subject", "chapter", F.lit(None).cast("string").alias("topic"), F.col("chapter").alias("name"), F.lit("chapter").alias("kind"), "number")
    t = topics.select("subject", "chapter", "topic", F.col("topic").alias("name"), F.lit("topic").alias("kind"), "number")
    k = concepts if topic_concepts else concepts.filter(F.col("topic").isNull())
    k = k.select("subject", "chapter", "topic", F.col("concept").alias("name"), F.lit("concept").alias("kind"), "number")
    return c.unionByName(t).unionByName(k)


def name_index(names: DataFrame) -> DataFrame:
    """key and its first node, chapters before topics before concepts; also under `subject name`."""
    level = F.when(F.col("kind") == "chapter", 0).when(F.col("kind") == "topic", 1).otherwise(2)
    keyed = names.withColumn("level", level).withColumn("key", F.explode(F.array(norm_key(F.col("name")), norm_key(F.concat_ws(" ", "subject", "name")))))
    return first_wins(keyed.filter("key <> ''"), ["key"], ["level", "number", "subject"]).select("key", "name", "kind", "subject", "chapter", "topic")


def vocabulary(names: DataFrame, slug: Column) -> DataFrame:
    """For each subject its keys and slugs."""
    return names.groupBy("subject").agg(F.array_sort(F.collect_set(norm_key(F.col("name")))).alias("keys"), F.array_sort(F.collect_set(slug)).alias("slugs"))


def foreign_names(names: DataFrame, subject: str) -> DataFrame:
    """Keys of other subjects that this one does not have."""
    key = names.select("subject", norm_key(F.col("name")).alias("key"))
    return key.filter(F.col("subject") != subject).select("key").subtract(key.filter(F.col("subject") == subject).select("key"))


def vocabulary_lines(topics: DataFrame, limit: int = 200) -> DataFrame:
    line = F.concat(F.col("subject"), F.lit(": "), F.col("chapter"), F.lit(" > "), F.col("topic"))
    return topics.orderBy("subject", "number", "topic").select(line.alias("line")).limit(limit)


def scope(chapters: DataFrame, topics: DataFrame, concepts: DataFrame) -> DataFrame:
    """subject, chapter_key, key, topic: what a chapter declares: its own and short name, topics, concepts; with the first
    topic that spells it."""
    c = chapters.select("subject", "chapter", F.explode(F.array("chapter", after_dash(F.col("chapter")))).alias("name"), F.lit(None).cast("string").alias("topic"), F.lit(0).alias("level"), "number")
    t = topics.select("subject", "chapter", F.col("topic").alias("name"), "topic", F.lit(2).alias("level"), "number")
    k = concepts.select("subject", "chapter", F.col("concept").alias("name"), F.coalesce("topic", "concept").alias("topic"), F.when(F.col("topic").isNull(), 1).otherwise(3).alias("level"), "number")
    rows = c.unionByName(t).unionByName(k).filter(name_like(F.col("name")))
    rows = rows.select("subject", norm_key(F.col("chapter")).alias("chapter_key"), norm_key(F.col("name")).alias("key"), "topic", "level", "number").filter("key <> ''")
    return rows.groupBy("subject", "chapter_key", "key").agg(F.min_by("topic", F.struct("level", "number")).alias("topic"))


def declares(rows: DataFrame, declared: DataFrame, subject: str, chapter: str, concept: str, name: str = "declared") -> DataFrame:
    """rows with a flag: the chapter declares the concept, or all the concept's tokens are in the chapter's name."""
    d = declared.select(F.col("subject").alias("__s"), F.col("chapter_key").alias("__c"), F.col("key").alias("__k")).distinct().withColumn("__d", F.lit(True))
    out = rows.join(d, (F.col(subject) == F.col("__s")) & (norm_key(F.col(chapter)) == F.col("__c")) & (norm_key(F.col(concept)) == F.col("__k")), "left")
    tokens = key_tokens(F.col(concept), 3)
    within = (F.size(tokens) > 0) & (F.size(F.array_except(tokens, key_tokens(F.col(chapter), 3))) == 0)
    return out.withColumn(name, F.coalesce(F.col("__d"), within, F.lit(False))).drop("__s", "__c", "__k", "__d")


def realigned(rows: DataFrame, declared: DataFrame, chapters: DataFrame, subject: str, chapter: str, concept: str) -> DataFrame:
    """rows whose concept exactly one chapter of the subject owns, and not the one they have, moved to that one."""
    own = declared.groupBy("subject", "key").agg(F.count_distinct("chapter_key").alias("__n"), F.min("chapter_key").alias("__owner")).filter("__n = 1")
    own = own.join(chapters.select("subject", norm_key(F.col("chapter")).alias("__owner"), F.col("chapter").alias("__name")).dropDuplicates(["subject", "__owner"]), ["subject", "__owner"])
    own = own.select(F.col("subject").alias("__s"), F.col("key").alias("__k"), "__owner", "__name")
    flagged = declares(rows, declared, subject, chapter, concept, "__ok")
    out = flagged.join(own, (F.col(subject) == F.col("__s")) & (norm_key(F.col(concept)) == F.col("__k")), "left")
    moves = ~F.col("__ok") & F.col("__owner").isNotNull() & F.col(chapter).isNotNull()
    return out.withColumn(chapter, F.when(moves, F.col("__name")).otherwise(F.col(chapter))).drop("__ok", "__s", "__k", "__owner", "__name")


def relocated(concepts: DataFrame, chapters: DataFrame, topics: DataFrame) -> DataFrame:
    """concepts whose name is that of exactly one other chapter (full or short), or else of exactly one topic, under that
    one; doubles that this makes are dropped. via: chapter, topic or null (stayed)."""
    c = chapters.select("subject", "chapter", F.explode(F.array_distinct(F.array(norm_key(F.col("chapter")), norm_key(after_dash(F.col("chapter")))))).alias("key")).filter("key <> ''")
    c = c.groupBy("subject", "key").agg(F.count("*").alias("nc"), F.min("chapter").alias("to_chapter"))
    t = topics.select("subject", "chapter", "topic", norm_key(F.col("topic")).alias("key"))
    t = t.groupBy("subject", "key").agg(F.count("*").alias("nt"), F.min("chapter").alias("to_chapter_t"), F.min("topic").alias("to_topic"))
    k = concepts.withColumn("key", norm_key(F.col("concept"))).join(c, ["subject", "key"], "left").join(t, ["subject", "key"], "left")
    by_chapter = F.coalesce(F.col("nc") == 1, F.lit(False))
    by_topic = F.col("nc").isNull() & F.coalesce(F.col("nt") == 1, F.lit(False))
    goal = F.when(by_chapter, F.col("to_chapter")).when(by_topic, F.col("to_chapter_t"))
    moves = goal.isNotNull() & (goal != F.col("chapter"))
    k = k.withColumns({
        "via": F.when(moves & by_chapter, "chapter").when(moves, "topic"), "topic": F.when(moves & by_topic, F.col("to_topic")).when(~F.coalesce(moves, F.lit(False)), F.col("topic")),
        "chapter": F.when(moves, goal).otherwise(F.col("chapter")),
    })
    stay = F.col("via").isNotNull().cast("int")
    return first_wins(k, ["subject", "chapter", "topic", "key"], [stay, "number"]).select("subject", "chapter", "topic", "concept", "number", "via")


def supplemented(chapters: DataFrame, topics: DataFrame, more_chapters: DataFrame, more_topics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both dimensions with a supplement: chapters of unknown keys are added, topics whose key their chapter lacks too."""
    key = lambda d, c: d.withColumn("__k", norm_key(F.col(c)))
    known = key(chapters, "chapter").select("subject", "__k", F.col("chapter").alias("__name"))
    new = key(more_chapters, "chapter").join(known, ["subject", "__k"], "left_anti").drop("__k")
    renamed = key(more_topics, "chapter").join(known.dropDuplicates(["subject", "__k"]), ["subject", "__k"], "left")
    renamed = renamed.withColumn("chapter", F.coalesce("__name", "chapter")).drop("__k", "__name")
    have = key(topics, "topic").select("subject", "chapter", "__k")
    add = key(renamed, "topic").join(have, ["subject", "chapter", "__k"], "left_anti")
    add = first_wins(add, ["subject", "chapter", "__k"], ["number"]).drop("__k")
    return chapters.unionByName(new), topics.unionByName(add)


def alias_map(labels: DataFrame, curated: DataFrame, index: DataFrame) -> DataFrame:
    """key, raw, canonical, subject, chapter, topic, source for raw labels (label, seq; first wins by key) and curated keys
    the corpus lacks. Sources: curated, taxonomy, component (the first comma part that is known), observed.

    curated: key, canonical, subject, chapter, topic. index: name_index().
    """
    raw = first_wins(labels.withColumn("key", norm_key(F.col("label"))).filter("key <> ''"), ["key"], ["seq"]).select("key", F.col("label").alias("raw"))
    fields = ["canonical", "subject", "chapter", "topic"]
    tax = index.select("key", F.col("name").alias("canonical"), "subject", "chapter", "topic")
    known = curated.select("key", *fields, F.lit(0).alias("prec")).unionByName(tax.withColumn("prec", F.lit(1)))
    known = first_wins(known, ["key"], ["prec"])
    parts = raw.select("key", F.posexplode(F.transform(F.split("raw", ","), norm_key)).alias("pos", "part")).filter("part <> '' and part <> key")
    first = parts.join(known.withColumnRenamed("key", "part"), "part").groupBy("key").agg(F.min_by(F.struct(*fields), "pos").alias("c"))
    out = raw.join(known, "key", "left").join(first, "key", "left")
    source = F.when(F.col("prec") == 0, "curated").when(F.col("prec") == 1, "taxonomy").when(F.col("c").isNotNull(), "component").otherwise("observed")
    picked = [F.coalesce(F.col(f), F.col(f"c.{f}")).alias(f) for f in fields[1:]]
    out = out.select("key", "raw", F.coalesce("canonical", "c.canonical", norm_space(F.col("raw"))).alias("canonical"), *picked, source.alias("source"))
    extra = curated.join(raw, "key", "left_anti").select("key", F.col("canonical").alias("raw"), *fields, F.lit("curated").alias("source"))
    return out.unionByName(extra)


def counts(chapters: DataFrame, topics: DataFrame, concepts: DataFrame) -> DataFrame:
    one = lambda d, k: d.select("subject", F.lit(k).alias("kind"))
    return one(chapters, "chapters").unionByName(one(topics, "topics")).unionByName(one(concepts, "concepts")).groupBy("subject").pivot("kind", ["chapters", "topics", "concepts"]).count().na.fill(0)


def canonical_labels(*sources: DataFrame, seq: str | None = None) -> DataFrame:
    """key, label: the first spelling of each key over sources (label) in their order; within a source the first by the
    column seq, without one the smallest spelling."""
    rows = None
    for k, s in enumerate(sources):
        part = s.select(F.col("label"), F.struct(F.lit(k).alias("prec"), (F.col(seq) if seq else F.lit(0)).alias("seq"), "label").alias("at"))
        rows = part if rows is None else rows.unionByName(part)
    keyed = rows.withColumn("key", F.lower(norm_space(F.col("label")))).filter("key <> ''")
    return keyed.groupBy("key").agg(F.min("at").alias("at")).select("key", F.col("at.label").alias("label"))


def raw_labels(questions: DataFrame, concept: str = "concept", tags: str = "tags") -> DataFrame:
    """Distinct concepts and tags, white space normalised."""
    one = questions.select(norm_space(F.col(concept)).alias("label")).unionByName(questions.select(F.explode(tags).alias("t")).select(norm_space(F.col("t")).alias("label")))
    return one.filter("label <> ''").distinct().orderBy("label")


def hygiene(rows: DataFrame, owned: DataFrame, subject: str, concept: str, chapter: str, strict: tuple[str, ...] = ()) -> DataFrame:
    """rows whose concept is cleared where it makes no slug, or is another subject's: always in strict subjects, elsewhere
    without a chapter. owned: owners()."""
    from tessera.functions.text import slugify
    from tessera.operators.lookup import only_foreign

    o = owned.select(F.col("key").alias("__k"), F.col("owners").alias("__o"))
    out = rows.join(o, norm_key(F.col(concept)) == F.col("__k"), "left")
    foreign = only_foreign(F.col("__o"), F.col(subject))
    clear = (slugify(F.col(concept), None) == "") | (foreign & (F.col(subject).isin(*strict) if strict else F.lit(False))) | (foreign & F.col(chapter).isNull())
    return out.withColumn(concept, F.when(~clear, F.col(concept))).drop("__k", "__o")


def finalized(rows: DataFrame, owned: DataFrame, labels: DataFrame, declared: DataFrame, chapters: DataFrame, subject: str, concept: str, chapter: str, strict: tuple[str, ...] = ()) -> DataFrame:
    """hygiene, canonical spelling (labels: key, label), the owning chapter, and leaf_bucket `_other` where the chapter does
    not declare the concept."""
    out = hygiene(rows, owned, subject, concept, chapter, strict)
    for c in (concept, chapter):
        l = labels.select(F.col("key").alias("__k"), F.col("label").alias("__l"))
        out = out.join(l, F.lower(norm_space(F.col(c))) == F.col("__k"), "left").withColumn(c, F.coalesce("__l", F.when(F.col(c).isNotNull(), norm_space(F.col(c))))).drop("__k", "__l")
    out = realigned(out, declared, chapters, subject, chapter, concept)
    out = declares(out, declared, subject, chapter, concept, "__declared")
    parked = F.col(concept).isNotNull() & F.col(chapter).isNotNull() & ~F.col("__declared")
    return out.withColumn("leaf_bucket", F.when(parked, "_other")).drop("__declared")
