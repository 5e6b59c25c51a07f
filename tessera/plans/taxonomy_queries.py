"""Taxonomy merging and placement, the index composition, vocabulary items, ledger entries and exported rule tables."""

import pandas as pd
from pyspark.sql import functions as F

from tessera.functions import ladders, text
from tessera.operators import audit, ledger, lookup, scoring, state, taxonomy, vocab
from tessera.plans import indexing
from tessera.plans.item_queries import _DIMS, _chapters, _concepts, _topics
from tessera.plans.registry import query
from tessera.sources import files, outline, settings


@query("""WITH x AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS label, p_partkey AS seq, 0 AS prec FROM part UNION ALL SELECT p_type, p_partkey, 1 FROM part),
r AS (SELECT lower(label) AS key, label, row_number() OVER (PARTITION BY lower(label) ORDER BY prec, seq) AS k FROM x WHERE label <> '') SELECT key, label FROM r WHERE k = 1""")
def canonical_labels(t):
    seq = F.col("p_partkey").alias("seq")
    names = t("part").select(F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("label"), seq)
    return taxonomy.canonical_labels(names, t("part").select(F.col("p_type").alias("label"), seq), seq="seq")


@query(f"""WITH {_DIMS}, s AS (SELECT subject, chapter, number, s_name, s_suppkey FROM supplier JOIN chapter ON s_nationkey = number)
SELECT 'chapter' AS kind, subject, CASE WHEN number % 2 = 0 THEN chapter ELSE lower(chapter) END AS chapter, CAST(NULL AS VARCHAR) AS topic FROM chapter
UNION ALL SELECT 'topic', subject, chapter, s_name FROM s WHERE s_suppkey % 3 <> 0
UNION ALL SELECT 'topic', subject, CASE WHEN number % 2 = 0 THEN chapter ELSE lower(chapter) END, lower(s_name) FROM s WHERE s_suppkey % 3 = 0 OR number % 2 = 1""")
def taxonomy_supplemented(t):
    # half the chapters and two thirds of the topics, with all of both in another spelling as the supplement
    c, s = _chapters(t), _topics(t)
    low = lambda d, *names: d.withColumns({n: F.lower(n) for n in names})
    chapters, topics = taxonomy.supplemented(c.filter("number % 2 = 0"), s.filter("number % 3 <> 0"), low(c, "chapter"), low(s, "chapter", "topic"))
    none = F.lit(None).cast("string").alias("topic")
    return chapters.select(F.lit("chapter").alias("kind"), "subject", "chapter", none).unionByName(topics.select(F.lit("topic").alias("kind"), "subject", "chapter", "topic"))


@query(f"""WITH {_DIMS}, s AS (SELECT s_suppkey, s_name, subject, chapter FROM supplier JOIN chapter ON s_nationkey = number),
k AS (SELECT c_custkey AS number, c.subject, c.chapter, CASE WHEN c_acctbal < 0 THEN c_mktsegment END AS topic, CASE c_custkey % 4 WHEN 0 THEN o.chapter WHEN 1 THEN s.s_name ELSE c_name END AS concept,
  CASE WHEN c_custkey % 4 = 0 AND o.subject = c.subject AND o.chapter <> c.chapter THEN 'chapter' WHEN c_custkey % 4 = 1 AND s.subject = c.subject AND s.chapter <> c.chapter THEN 'topic' END AS via,
  o.chapter AS oc, s.chapter AS sc, s.s_name FROM customer JOIN chapter c ON c_nationkey = c.number LEFT JOIN chapter o ON o.number = (c_nationkey + 5) % 25 LEFT JOIN s ON s.s_suppkey = c_custkey % 10),
m AS (SELECT number, subject, CASE via WHEN 'chapter' THEN oc WHEN 'topic' THEN sc ELSE chapter END AS chapter, CASE via WHEN 'chapter' THEN NULL WHEN 'topic' THEN s_name ELSE topic END AS topic, concept, via FROM k),
r AS (SELECT *, row_number() OVER (PARTITION BY subject, chapter, topic, concept ORDER BY via IS NOT NULL, number) AS n FROM m) SELECT number, subject, chapter, topic, concept, via FROM r WHERE n = 1""")
def concepts_relocated(t):
    other = t("nation").select(((F.col("n_nationkey") + 20) % 25).alias("__n"), F.col("n_name").alias("__other"))
    home = t("customer").select(F.col("c_custkey").alias("number"), F.col("c_nationkey").alias("__n"))
    topics = _topics(t).select(F.col("number").alias("__s"), F.col("topic").alias("__topic"))
    k = _concepts(t).join(home, "number").join(other, "__n", "left").join(topics, F.col("number") % 10 == F.col("__s"), "left")
    z = F.col("number") % 4
    k = k.withColumn("concept", F.when(z == 0, F.col("__other")).when(z == 1, F.col("__topic")).otherwise(F.col("concept")))
    return taxonomy.relocated(k.select("subject", "chapter", "topic", "concept", "number"), _chapters(t), _topics(t)).select("number", "subject", "chapter", "topic", "concept", "via")


@query(f"""WITH {_DIMS}, k AS (SELECT c_custkey, c_name, c.chapter AS own, c_custkey % 5 = 0 AS strange, CASE c_custkey % 3 WHEN 0 THEN c.chapter WHEN 1 THEN o.n_name END AS asked
  FROM customer JOIN chapter c ON c_nationkey = c.number JOIN nation o ON o.n_nationkey = (c_nationkey + 5) % 25)
SELECT c_custkey, CASE WHEN NOT (strange AND asked IS NULL) THEN c_name END AS concept, CASE WHEN asked IS NULL THEN NULL WHEN strange THEN asked ELSE own END AS chapter,
  CASE WHEN strange AND asked IS NOT NULL THEN '_other' END AS leaf_bucket FROM k""")
def placements_finalized(t):
    # a third in their chapter, a third in another one, a third in none; every fifth under a subject without the concept
    chapters, concepts = _chapters(t), _concepts(t)
    other = t("nation").select(((F.col("n_nationkey") + 20) % 25).alias("__n"), F.col("n_name").alias("__other"))
    home = t("customer").select(F.col("c_custkey").alias("number"), F.col("c_nationkey").alias("__n"))
    rows = concepts.join(home, "number").join(other, "__n").select(
        F.col("number").alias("c_custkey"), F.when(F.col("number") % 5 == 0, "OTHER").otherwise(F.col("subject")).alias("subject"), F.upper("concept").alias("concept"),
        F.when(F.col("number") % 3 == 0, F.col("chapter")).when(F.col("number") % 3 == 1, F.col("__other")).alias("chapter"),
    )
    owned = lookup.owners(concepts, "concept", "subject")
    labels = taxonomy.canonical_labels(concepts.select(F.col("concept").alias("label"), F.col("number").alias("seq")), seq="seq")
    out = taxonomy.finalized(rows, owned, labels, taxonomy.scope(chapters, _topics(t), concepts), chapters, "subject", "concept", "chapter")
    return out.select("c_custkey", "concept", "chapter", "leaf_bucket")


_PLACED = """q AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS ordinal, o_orderkey % 7 = 0 AS hidden FROM orders),
p AS (SELECT *, CASE WHEN ordinal <= 2 THEN 'MATH' ELSE 'GK' END AS subject, CASE WHEN ordinal <= 2 THEN 'Algebra' ELSE 'Science' END AS chapter,
  CASE WHEN ordinal > 2 THEN 'Physics' ELSE 'Algebra' END AS concept, CASE WHEN ordinal <= 2 AND o_orderkey % 3 = 0 THEN 'keyword' ELSE 'alias' END AS class_source FROM q WHERE NOT hidden)"""


def _index(t):
    """Customers as papers, their orders as questions: the first two of one subject, all others of a second one."""
    s = t.spark
    named = F.struct(F.col("o_orderkey"))
    sorted_ = t("orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(named)).alias("o"))
    concept = lambda x, i: F.when(i >= 2, "Physics").when(x.o_orderkey % 3 == 0, "Surds").otherwise("Algebra")
    question = lambda x, i: F.struct(
        x.o_orderkey.cast("string").alias("qid"), F.when(i < 2, i + 1).otherwise(i - 1).cast("int").alias("n"), concept(x, i).alias("concept"),
        F.when(x.o_orderkey % 7 == 0, "हिन्दी").otherwise("What http://i/p.png").alias("question"), F.lit("").alias("solution"), F.lit("[]").alias("options"),
    )
    papers = sorted_.select(
        F.concat(F.lit("CGL 2021/"), F.col("o_custkey").cast("string")).alias("path"), F.lit("t").alias("title"), F.lit(2021).alias("year"), F.lit(1).alias("shift"), F.transform("o", question).alias("questions"),
    )
    doc = {"exams": [{"code": "CGL", "kinds": [{"id": "cgl1", "includes": ["cgl"], "rules": [{"years": [2019], "spans": [["GK", 1, 1000]]}, {"spans": [["MATH", 1, 2], ["GK", 3, 1000]]}]}]}]}
    kinds, rules, spans = settings.layout_tables(s, doc)
    dims = {
        "aliases": s.createDataFrame([("algebra", "Algebra", "MATH", "Algebra", None), ("physics", "Physics", "GK", "Science", None)], "key string, canonical string, subject string, chapter string, topic string"),
        "chapters": s.createDataFrame([("MATH", "Algebra", 0), ("GK", "Science", 1)], "subject string, name string, number int"),
        "topics": s.createDataFrame([("GK", "Mughal Empire", "Science", 0)], "subject string, name string, chapter string, number int"),
        "patterns": s.createDataFrame([("MATH", 0, "surd|root", "Algebra")], "subject string, number int, pattern string, target string"),
    }
    seen = ladders.by_label(F.col("concept"), {"algebra": "MATH", "surds": "MATH", "physics": "GK"}, [], [])
    return indexing.build_index(papers, kinds, rules, spans, dims, seen)


@query(f"""WITH {_PLACED} SELECT CAST(o_orderkey AS VARCHAR) AS qid, 'CGL 2021/' || o_custkey AS paper_path, CAST(ordinal AS INTEGER) AS ordinal, 'CGL' AS exam, subject, chapter, concept, class_source,
CASE class_source WHEN 'alias' THEN 'high' ELSE 'low' END AS class_confidence, true AS has_image, 'placed' AS status FROM p""")
def index_build(t):
    index, _ = _index(t)
    return index.select("qid", "paper_path", F.col("ordinal").cast("int").alias("ordinal"), "exam", "subject", "chapter", "concept", "class_source", "class_confidence", "has_image", "status")


@query(f"""WITH {_PLACED} SELECT CASE WHEN grouping(chapter) = 1 THEN 1 WHEN grouping(concept) = 1 THEN 2 ELSE 4 END AS level, subject, chapter, concept, count(*) AS questions FROM p GROUP BY GROUPING SETS ((subject), (subject, chapter), (subject, chapter, concept))""")
def index_distribution(t):
    index, _ = _index(t)
    return indexing.distribution(index, 2021).filter("level <> 3").select("level", "subject", "chapter", "concept", "questions")


@query("""WITH v(n, kind, rule_no, number, subject, s, e) AS (VALUES (0, 'cgl1', 0, 0, 'GK', 1, 50), (1, 'cgl1', 1, 0, 'MATH', 1, 25), (2, 'cgl1', 1, 1, 'GK', 26, 50), (3, 'chsl', 0, 0, 'ENG', 1, 100))
SELECT kind, CASE kind WHEN 'cgl1' THEN 'CGL' ELSE 'CHSL' END AS exam, rule_no, number, subject, s AS start, e AS "end" FROM v""")
def layout_spans(t):
    doc = {"exams": [
        {"code": "CGL", "kinds": [{"id": "cgl1", "includes": ["cgl"], "rules": [{"years": [2019], "spans": [["GK", 1, 50]]}, {"spans": [["MATH", 1, 25], ["GK", 26, 50]]}]}]},
        {"code": "CHSL", "kinds": [{"id": "chsl", "rules": [{"spans": [["ENG", 1, 100]]}]}]},
    ]}
    kinds, _, spans = settings.layout_tables(t.spark, doc)
    return spans.join(F.broadcast(kinds.select("kind", "exam")), "kind").select("kind", "exam", "rule_no", "number", "subject", "start", "end")


@query("SELECT 2020 AS first_year, 2024 AS last_year, 30 AS pack_size, 20 AS batch_size, (SELECT count(*) FROM orders WHERE 1990 + o_orderkey % 40 BETWEEN 2020 AND 2024) AS held")
def settings_scope(t):
    got = settings.load_settings('{"first_year": 2020, "last_year": 2030, "unknown": 1}', {"TESSERA_LAST_YEAR": "2024", "TESSERA_PACK_SIZE": " 30 ", "TESSERA_BATCH_SIZE": "many"})
    held = t("orders").filter((F.lit(1990) + F.col("o_orderkey") % 40).between(got.first_year, got.last_year))
    return held.agg(F.count("*").alias("held")).select(*(F.lit(getattr(got, c)).alias(c) for c in ("first_year", "last_year", "pack_size", "batch_size")), "held")


@query("""SELECT n_name AS member, n_name AS chapter FROM nation UNION ALL SELECT 'tion_1', (SELECT n_name FROM nation WHERE contains(lower(n_name), 'tion_1') ORDER BY n_nationkey LIMIT 1) UNION ALL SELECT 'absent', NULL""")
def family_members(t):
    members = t("nation").select(F.col("n_name").alias("member")).unionByName(t.spark.createDataFrame([("tion_1",), ("absent",)], "member string"))
    return outline.families(members, t("nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("number")))


@query("""SELECT CAST(p_partkey AS VARCHAR) AS qid, 'synonym' AS kind, p_name AS term, p_type AS first_option, p_name AS correct_option, p_brand AS exam, p_size AS year FROM part WHERE p_size % 2 = 0 AND p_partkey % 5 <> 0""")
def vocabulary_items(t):
    option = lambda label, c: F.struct(F.lit(label).alias("label"), F.col(c).alias("text"))
    q = t("part").select(
        F.col("p_partkey").cast("string").alias("qid"), F.when(F.col("p_size") % 2 == 0, "Synonyms").otherwise("Sums").alias("labels"), F.concat(F.lit("Select the word.\n\n"), F.col("p_name")).alias("prompt"),
        F.array(option("A", "p_type"), option("B", "p_name")).alias("options"), F.lit("B").alias("correct"), F.col("p_brand").alias("exam"), F.col("p_size").alias("year"),
    )
    found = vocab.items(q, "(?i)select|choose", "(?i)options?\\b", "(?i)^none of these$")
    out = vocab.missing(found, t("part").filter("p_partkey % 5 = 0").select(F.col("p_partkey").cast("string").alias("qid")), ["qid"])
    return out.select("qid", "kind", "term", F.col("options")[0].alias("first_option"), "correct_option", "exam", "year")


@query("""SELECT event_id, 'p' AS phase, CASE event_id % 3 WHEN 0 THEN 'rate_limit' WHEN 1 THEN 'transport' ELSE 'auth' END AS kind, event_id % 3 <> 2 AS retryable, least(50, user_id % 70) AS ids
FROM events""")
def ledger_entries(t):
    z = F.col("event_id") % 3
    ids = F.when(F.col("user_id") % 70 > 0, F.transform(F.sequence(F.lit(1), (F.col("user_id") % 70).cast("int")), lambda i: i.cast("string")))
    raw = t("events").select(
        F.col("event_id").alias("ts"), F.lit("p").alias("phase"), F.lit("b").alias("batch_id"), F.lit("r").alias("provider"), F.lit("m").alias("model"), F.lit(None).cast("string").alias("kind"),
        F.when(z == 0, 429).when(z == 2, 401).alias("http_status"), F.lit(1).alias("attempt"), F.when(z == 1, "connection timed out").otherwise("no").alias("message"), ids.alias("item_ids"), F.lit("route").alias("scope"), F.lit("t").alias("task"),
    )
    return ledger.entries(raw).select(F.col("ts").alias("event_id"), "phase", "kind", "retryable", F.size("item_ids").cast("long").alias("ids"))


@query("""SELECT 'anchor' AS part, 0 AS number, 'algebra' AS label, 'MATH' AS value UNION ALL SELECT 'anchor', 1, 'physics', 'GK' UNION ALL SELECT 'ambiguous', 0, 'general', NULL UNION ALL SELECT 'rule', 0, 'MATH', 'surd|root' UNION ALL SELECT 'rule', 1, 'GK', 'empire'""")
def rule_table_export(t):
    return ladders.rule_table(t.spark, {"physics": "GK", "algebra": "MATH"}, ["general"], [("MATH", "surd|root"), ("GK", "empire")])


@query("SELECT p_partkey, len(string_split(p_name, ' ')) + 1 AS terms FROM part")
def rule_specificity(t):
    return t("part").select("p_partkey", F.split("p_name", " ").alias("a"), F.array("p_type").alias("b")).select("p_partkey", scoring.specificity("a", "b").cast("long").alias("terms"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN lower(p_name) ELSE 'to ' || lower(p_name) END AS key, p_partkey || '. ' || p_name || ' — ' || CASE WHEN p_size % 3 = 0 THEN '-' ELSE p_type END AS label FROM part")
def entry_keys_and_labels(t):
    name = F.concat(F.lit("Tó  "), F.upper("p_name"))
    topic = F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_type"))
    return t("part").select("p_partkey", text.entry_key(name, F.col("p_size") % 2 == 0).alias("key"), outline.rule_label(F.col("p_partkey"), F.col("p_name"), topic).alias("label"))


@query("""SELECT p_partkey, p_size % 4 <> 0 AND (p_size % 3 = 0 OR p_size % 2 = 1) AS found FROM part""")
def agreement_candidates(t):
    z = F.col("p_size")
    prompt = F.concat(F.when(z % 4 == 0, "Bread or butter ").otherwise("Bread and butter "), F.when(z % 2 == 1, F.lit("are ")).otherwise(F.lit("with ")), F.col("p_name"))
    options = F.when(z % 3 == 0, F.array(F.lit("it is"), F.lit("they are"))).otherwise(F.array(F.lit("it is"), F.lit("none")))
    return t("part").select("p_partkey", ladders.agreement_candidate(prompt, options, "bread and butter", "is|has", "are|have").alias("found"))


@query("""SELECT slug AS place, detail, count(*) AS n FROM (SELECT CASE p_partkey % 4 WHEN 0 THEN 'a-b' WHEN 1 THEN 'Not A Slug' WHEN 2 THEN '_unclassified' ELSE 'ok7' END AS slug,
  CASE WHEN p_partkey % 7 = 0 THEN 'a required column is empty' WHEN p_partkey % 4 = 1 THEN 'not a slug' ELSE 'placeholder and label disagree' END AS detail FROM part
  WHERE p_partkey % 7 = 0 OR p_partkey % 4 = 1 OR ((p_partkey % 4 = 2) <> (p_partkey % 8 IN (2, 3)))) GROUP BY ALL""")
def audit_slugs(t):
    k = F.col("p_partkey")
    slug = F.when(k % 4 == 0, "a-b").when(k % 4 == 1, "Not A Slug").when(k % 4 == 2, "_unclassified").otherwise("ok7")
    rows = t("part").select(slug.alias("slug"), F.when(k % 7 != 0, F.col("p_name")).alias("name"), F.when(~(k % 8).isin(2, 3), F.lit("x")).alias("label"))
    return audit.bad_slugs(rows, "slug", ["name"], label="label").groupBy("place", "detail").agg(F.count("*").alias("n"))


@query("""WITH old AS (SELECT o_orderstatus AS phase, o_orderpriority AS k, count(*) AS v FROM orders GROUP BY ALL), new(phase, k, v) AS (VALUES ('F', '1-URGENT', 5), ('F', 'extra', 2)),
f AS (SELECT phase, k, sum(v) AS v FROM (SELECT * FROM old WHERE phase = 'F' UNION ALL SELECT * FROM new) GROUP BY ALL)
SELECT phase, 'done' AS status, 't1' AS updated, k, CAST(v AS BIGINT) AS v FROM f UNION ALL SELECT phase, 'running', 't0', k, v FROM old WHERE phase <> 'F'""")
def progress_upsert(t):
    n = t("orders").groupBy(F.col("o_orderstatus").alias("phase"), F.col("o_orderpriority").alias("k")).agg(F.count("*").alias("v"))
    old = n.groupBy("phase").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("counters"))
    old = old.select("phase", F.lit("running").alias("status"), "counters", F.lit("t0").alias("updated"))
    out = state.record_progress(old, "F", "done", {"1-URGENT": 5, "extra": 2}, "t1")
    return out.select("phase", "status", "updated", F.explode("counters").alias("k", "v"))


def _judge(parts):
    for p in parts:
        yield pd.DataFrame({"doc_id": p["doc_id"], "score": p["n_chars"].astype("float64") * 2})


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN -1.0::DOUBLE ELSE n_chars * 2.0::DOUBLE END AS score FROM documents")
def scored_with_cache(t):
    # every second answer is cached; the scorer is called for the rest
    cache = t("documents").filter("doc_id % 2 = 0").select("doc_id", F.lit(-1.0).alias("score"))
    return files.scored(t("documents").select("doc_id", "n_chars"), _judge, "doc_id long, score double", "doc_id", cache)
