"""Markdown outlines as tables: numbered headings, bullets of the innermost open heading, rule blocks.

Lines are numbered, classified by patterns, and headings carried down by last-value windows; a file is one group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.text import clean_heading, marked_lines, norm_key, prose_bullet, quoted


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no, line of every text file."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "line"))
    return raw


def outline(lines: DataFrame, first: int, last: int, depth: int = 2, labels: Sequence[str] = ()) -> DataFrame:
    """file, line_no, kind (chapter, topic, subtopic, concept), chapter_no, chapter, topic, subtopic, name, tag.

    `# 12. Name` opens chapter 12 if it is within first and last, any other `#` closes it; `##` opens a topic, `###` a
    subtopic if depth is 3; bullets are concepts of what is innermost; prose bullets are dropped; `[TAG]` leads a bullet.
    """
    w = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    head = F.length(F.regexp_extract("line", r"^(#{1,3})\s", 1))
    number = F.nullif(F.regexp_extract("line", r"^#\s+(?:§\s*)?(\d+)[.)]?\s", 1), F.lit("")).cast("int")
    title = clean_heading(F.regexp_replace("line", r"^#{1,3}\s+(?:§\s*)?(?:\d+(?:\.\d+)*[.)]?\s+)?", ""))
    rows = lines.withColumns({"head": head, "no": number, "title": title})
    opens = (F.col("head") == 1) & F.coalesce(F.col("no").between(first, last), F.lit(False))
    rows = rows.withColumn("c", F.last(F.when(F.col("head") == 1, F.struct(F.when(opens, F.col("no")).alias("no"), F.when(opens, F.col("title")).alias("name"), F.col("line_no").alias("at"))), True).over(w))
    held = lambda k: F.last(F.when(F.col("head") == k, F.struct(F.col("title").alias("name"), F.col("line_no").alias("at"))), True).over(w)
    rows = rows.withColumns({"t": held(2), "s": held(3) if depth >= 3 else F.lit(None).cast("struct<name:string,at:int>")})
    topic = F.when(F.col("t.at") > F.col("c.at"), F.col("t.name"))
    sub = F.when((F.col("s.at") > F.col("t.at")) & topic.isNotNull(), F.col("s.name"))
    bullet = F.regexp_extract("line", r"^\s*[-*+]\s+(.+)$", 1)
    tag = F.nullif(F.regexp_extract(bullet, r"^\[([^\]]+)\]\s*", 1), F.lit(""))
    name = clean_heading(F.regexp_replace(bullet, r"^\[[^\]]+\]\s*", ""))
    kind = (
        F.when(opens, "chapter").when(F.col("head") == 2, "topic").when((F.col("head") == 3) & F.lit(depth >= 3), "subtopic")
        .when((bullet != "") & ~prose_bullet(name, labels), "concept")
    )
    out = rows.select("file", "line_no", kind.alias("kind"), F.col("c.no").alias("chapter_no"), F.col("c.name").alias("chapter"), topic.alias("topic"), sub.alias("subtopic"), F.when(F.col("head") > 0, F.col("title")).otherwise(name).alias("name"), tag.alias("tag"))
    return out.filter(F.col("kind").isNotNull() & F.col("chapter").isNotNull())


def families(members: DataFrame, chapters: DataFrame) -> DataFrame:
    """member, chapter: family members joined to chapters by equal key, else to the first chapter that contains theirs."""
    m = members.select("member", norm_key(F.col("member")).alias("mk")).distinct()
    c = chapters.select(F.col("name").alias("chapter"), "number", norm_key(F.col("name")).alias("ck"))
    exact = m.join(c, F.col("mk") == F.col("ck")).groupBy("member").agg(F.min_by("chapter", "number").alias("exact"))
    # containment on equality: a chapter's parts of the lengths that members have
    lengths = sorted(r[0] for r in m.select(F.length("mk")).distinct().collect() if r[0])
    parts = F.array_distinct(F.flatten(F.array(*(_parts(F.col("ck"), n) for n in lengths)))) if lengths else F.array().cast("array<string>")
    held = c.select("chapter", "number", F.explode(parts).alias("mk"))
    part = m.join(held, "mk").groupBy("member").agg(F.min_by("chapter", "number").alias("part"))
    return m.select("member").distinct().join(exact, "member", "left").join(part, "member", "left").select("member", F.coalesce("exact", "part").alias("chapter"))


def _parts(x: Column, n: int) -> Column:
    none = F.array().cast("array<string>")
    return F.when(F.length(x) >= n, F.transform(F.sequence(F.lit(1), F.length(x) - n + 1), lambda i: F.substr(x, i, F.lit(n)))).otherwise(none)


def rule_blocks(lines: DataFrame) -> DataFrame:
    """file, number, title, topic, sources, body, examples, wrong, right, quotes of the blocks `## Rule N: title`."""
    w = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    number = F.nullif(F.regexp_extract("line", r"^##\s+Rule\s+(\d+)\s*[:.—-]", 1), F.lit("")).cast("int")
    rows = lines.withColumn("no", F.last(number, True).over(w)).filter(F.col("no").isNotNull())
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x.line), "\n")
    return parsed_rules(rows.groupBy("file", F.col("no").alias("number")).agg(text.alias("block")))


def parsed_rules(blocks: DataFrame) -> DataFrame:
    b = F.col("block")
    field = lambda name: F.trim(F.regexp_extract(b, rf"(?im)^\*\*{name}:?\*\*:?\s*(.+)$", 1))
    parts = F.split(F.regexp_replace(b, r"^##[^\n]*\n?", ""), r"(?im)^\*\*Examples:?\*\*.*$", 2)
    prose = F.trim(F.regexp_replace(parts[0], r"(?im)^\*\*(Topic|Sources):?\*\*:?.*$", ""))
    shown = F.coalesce(F.get(parts, F.lit(1)), F.lit(""))
    bullets = F.transform(F.regexp_extract_all(shown, F.lit(r"(?m)^\s*[-*]\s+(.+)$"), F.lit(1)), lambda v: F.trim(v))
    return blocks.select(
        "file", "number", F.trim(F.regexp_extract(b, r"^##\s+Rule\s+\d+\s*[:.—-]\s*([^\n]*)", 1)).alias("title"), field("Topic").alias("topic"), field("Sources").alias("sources"),
        prose.alias("body"), bullets.alias("examples"), marked_lines(shown, "✗❌").alias("wrong"), marked_lines(shown, "✓✔✅").alias("right"),
        F.array_distinct(F.concat(quoted(prose), quoted(F.array_join(bullets, " \n")))).alias("quotes"),
    )


def rule_label(number: Column, title: Column, topic: Column) -> Column:
    return F.concat(number.cast("string"), F.lit(". "), title, F.lit(" — "), F.coalesce(F.nullif(topic, F.lit("")), F.lit("-")))
