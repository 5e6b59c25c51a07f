"""Lookups, containment, overlap, ownership, vocabularies and rule scoring."""

from pyspark.sql import functions as F

from tessera.functions.text import content_terms
from tessera.operators import lookup, scoring, taxonomy, vocab
from tessera.plans.registry import query

WORDS = ["almond", "antique", "azure", "blue", "cream", "dark", "green", "ivory", "linen", "metallic", "navy", "olive", "plum", "red", "rose", "steel", "tan", "white", "yellow"]
_NAMES = "n(number, name) AS (VALUES " + ", ".join(f"({k}, '{w}')" for k, w in enumerate(WORDS)) + ")"


def _names(t):
    return t.spark.createDataFrame(list(enumerate(WORDS)), "number int, name string")


_KEYED = "lower(trim(p_type))"


@query(f"""WITH a AS (SELECT DISTINCT lower(p_type) AS key, upper(p_type) AS canonical FROM part WHERE starts_with(p_type, 'PROMO') OR starts_with(p_type, 'ECONOMY'))
SELECT p_partkey, coalesce(canonical, trim(p_type)) AS canonical, CASE WHEN canonical IS NULL THEN 'observed' ELSE 'alias' END AS source FROM part LEFT JOIN a ON key = {_KEYED}""")
def alias_lookup_default(t):
    p = t("part")
    aliases = p.filter(F.col("p_type").startswith("PROMO") | F.col("p_type").startswith("ECONOMY")).select(F.lower("p_type").alias("key"), F.upper("p_type").alias("canonical")).distinct()
    return lookup.resolve(p, "p_type", aliases).select("p_partkey", "canonical", "source")


@query(f"""WITH {_NAMES}, w AS (SELECT p_partkey, unnest(string_split(lower(p_name), ' ')) AS w, unnest(range(len(string_split(p_name, ' ')))) AS i FROM part)
SELECT p_partkey, arg_min(upper(name), i) AS canonical, CAST(min(i) AS INTEGER) AS probe_no FROM w JOIN n ON w = name GROUP BY ALL""")
def alias_lookup_coalesce(t):
    aliases = _names(t).select(F.col("name").alias("key"), F.upper("name").alias("canonical"))
    return lookup.resolve_any(t("part"), "p_partkey", F.split("p_name", " "), aliases)


@query(f"""WITH {_NAMES}, h AS (SELECT p_partkey, name, number, row_number() OVER (PARTITION BY p_partkey ORDER BY length(name) DESC, number) AS k FROM part JOIN n
  ON length(name) >= 4 AND contains(' ' || trim(regexp_replace(translate(lower(p_name), '/-.', '   '), ' +', ' ', 'g')) || ' ', ' ' || name || ' '))
SELECT p_partkey, name, number FROM h WHERE k = 1""")
def longest_containment_match(t):
    return lookup.contained(t("part"), "p_partkey", "p_name", _names(t))


_PAIRS = [(k, f"{a} {b}") for k, (a, b) in enumerate(zip(WORDS, WORDS[3:] + WORDS[:3], strict=True))]
_PAIRSQL = "n(number, name) AS (VALUES " + ", ".join(f"({k}, '{w}')" for k, w in _PAIRS) + ")"


@query(f"""WITH {_PAIRSQL}, t AS (SELECT DISTINCT p_partkey, unnest(string_split_regex(lower(p_name), '[^a-z0-9]+')) AS tok FROM part),
m AS (SELECT number, name, unnest(string_split(name, ' ')) AS tok FROM n), h AS (SELECT p_partkey, number, name, count(*) / 2.0::DOUBLE AS overlap FROM t JOIN m USING (tok) WHERE length(tok) >= 3 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY overlap DESC, number) AS k FROM h WHERE overlap >= 0.5) SELECT p_partkey, name, overlap FROM r WHERE k = 1""")
def fuzzy_overlap_match(t):
    return lookup.overlapping(t("part"), "p_partkey", "p_name", t.spark.createDataFrame(_PAIRS, "number int, name string"), 0.5)


_RULES = [(0, ["1-URGENT"], None, "express"), (1, None, [1995, 1996], "old"), (2, ["2-HIGH", "5-LOW"], [1999], "odd"), (3, None, None, "any")]


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'express' WHEN year(o_orderdate) IN (1995, 1996) THEN 'old' WHEN o_orderpriority IN ('2-HIGH', '5-LOW') AND year(o_orderdate) = 1999 THEN 'odd' ELSE 'any' END AS lane FROM orders""")
def first_matching_rule(t):
    rules = t.spark.createDataFrame(_RULES, "number int, priorities array<string>, years array<int>, lane string")
    o = t("orders").select("o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("y"))
    return lookup.first_rule(o, "o_orderkey", rules, {"o_orderpriority": "priorities", "y": "years"}, "number", "lane").select("o_orderkey", "lane")


@query("""WITH k(kind, number, inc) AS (VALUES ('en', 0, '/en/'), ('fr', 1, '/fr/'), ('query', 2, 'page='), ('net', 3, 'example.net'))
SELECT url AS path, arg_min(kind, (-length(inc)) * 100 + number) AS kind FROM (SELECT DISTINCT url FROM pages) JOIN k ON contains(lower(url), inc) WHERE NOT (kind = 'net' AND contains(url, '//m.')) GROUP BY url""")
def path_router(t):
    kinds = [("en", 0, ["/en/"], []), ("fr", 1, ["/fr/"], []), ("query", 2, ["page="], []), ("net", 3, ["example.net"], ["//m."])]
    k = t.spark.createDataFrame(kinds, "kind string, number int, includes array<string>, excludes array<string>")
    return lookup.best_path(t("pages").select(F.col("url").alias("path")), "path", k)


@query("""WITH b(key, block) AS (VALUES ('/en/', 'english'), ('example.com', 'com'), ('/fr/8', 'french 8'))
SELECT url AS path, coalesce((SELECT block FROM b WHERE contains(url, key) ORDER BY length(key) DESC, key DESC LIMIT 1), '') AS block FROM (SELECT DISTINCT url FROM pages)""")
def longest_key_lookup(t):
    blocks = t.spark.createDataFrame([("/en/", "english"), ("example.com", "com"), ("/fr/8", "french 8")], "key string, block string")
    return lookup.longest_key(t("pages").select(F.col("url").alias("path")), "path", blocks)


@query("""WITH r(number, pattern, target) AS (VALUES (0, 'PROMO', 'sale'), (1, 'BRUSH|POLISH', 'finished'), (2, 'TIN|STEEL', 'metal'))
SELECT p_partkey, arg_min(target, number) AS target, min(number) AS rule FROM part JOIN r ON regexp_matches(lower(p_type), '\\b(?:' || lower(pattern) || ')') GROUP BY ALL""")
def pattern_rule_fallback(t):
    rules = t.spark.createDataFrame([(0, "promo", "sale"), (1, "brush|polish", "finished"), (2, "tin|steel", "metal")], "number int, pattern string, target string")
    return lookup.by_pattern_rule(t("part"), "p_partkey", "p_type", rules)


_OWN = """o AS (SELECT lower(p_type) AS key, list_sort(list(DISTINCT p_brand)) AS owners FROM part GROUP BY ALL)"""


@query(f"WITH {_OWN} SELECT key, array_to_string(owners, ',') AS owners FROM o")
def name_owners(t):
    o = lookup.owners(t("part").select(F.col("p_type").alias("name"), F.col("p_brand").alias("subject")))
    return o.select("key", F.array_join("owners", ",").alias("owners"))


@query(f"""WITH {_OWN}, x AS (SELECT p_partkey, p_brand, lower(p_type) AS key, p_size FROM part), c AS (SELECT lower(p_type) AS key, list_sort(list(DISTINCT p_brand)) AS co FROM part WHERE p_size <= 25 GROUP BY ALL)
SELECT p_partkey, CASE WHEN p_size % 4 <> 0 AND len(coalesce(co, [])) > 0 AND NOT list_contains(co, p_brand) THEN 'wrong'
  WHEN p_size % 4 <> 0 AND len(list_filter(owners, lambda z: z <> p_brand)) > 0 THEN 'ambiguous' WHEN p_size % 4 <> 0 THEN 'ok'
  WHEN len(coalesce(co, [])) > 0 AND NOT list_contains(co, p_brand) THEN 'wrong' WHEN len(list_filter(owners, lambda z: z <> p_brand)) > 0 THEN 'ambiguous' ELSE 'ok' END AS verdict,
  CASE WHEN len(list_filter(coalesce(co, []), lambda z: z <> p_brand)) > 0 THEN 'chapter' WHEN len(list_filter(owners, lambda z: z <> p_brand)) > 0 THEN 'topic' ELSE 'concept' END AS level
FROM x LEFT JOIN o USING (key) LEFT JOIN c USING (key)""")
def ownership_verdict(t):
    p = t("part").select("p_partkey", "p_brand", F.lower("p_type").alias("key"), "p_size")
    named = lambda d: lookup.owners(d.select(F.col("p_type").alias("name"), F.col("p_brand").alias("subject")))
    p = p.join(named(t("part")), "key", "left").join(named(t("part").filter("p_size <= 25")).withColumnRenamed("owners", "co"), "key", "left")
    chapter = F.when(F.col("p_size") % 4 != 0, F.col("key"))
    v = lookup.ownership_verdict(chapter, F.col("co"), F.col("key"), F.col("co"), F.array("owners"), F.col("p_brand"))
    return p.select("p_partkey", v.alias("verdict"), lookup.foreign_level(F.col("co"), F.col("owners"), F.col("p_brand")).alias("level"))


@query("""SELECT DISTINCT lower(p_name) AS key FROM part WHERE p_brand <> 'Brand#11' EXCEPT SELECT lower(p_name) FROM part WHERE p_brand = 'Brand#11'""")
def foreign_vocabulary(t):
    return taxonomy.foreign_names(t("part").select(F.col("p_name").alias("name"), F.col("p_brand").alias("subject")), "Brand#11")


@query(f"""WITH a AS (SELECT subject, key, canonical, chapter FROM (VALUES ('R0', 'promo anodized tin', 'Promo Tin', 'PROMO')) v(subject, key, canonical, chapter)),
p AS (SELECT p_partkey, p_type, lower(p_type) AS k, 'R' || CAST(p_size % 2 AS VARCHAR) AS s FROM part),
j AS (SELECT p.*, a.canonical, a.subject AS asub, a.chapter AS ach FROM p LEFT JOIN a ON a.key = p.k)
SELECT p_partkey, CASE WHEN canonical IS NOT NULL AND asub = s THEN ach WHEN s = 'R0' AND contains(' ' || lower(coalesce(canonical, p_type)) || ' ', ' standard ') THEN 'STANDARD'
   WHEN s = 'R0' AND contains(' ' || lower(coalesce(canonical, p_type)) || ' ', ' promo ') THEN 'PROMO' WHEN s = 'R1' AND contains(' ' || lower(coalesce(canonical, p_type)) || ' ', ' economy ') THEN 'ECONOMY'
   WHEN s = 'R1' AND regexp_matches(k, '\\b(?:small|large)') THEN 'SIZES' END AS chapter FROM j""")
def resolution_ladder(t):
    s = t.spark
    aliases = s.createDataFrame([("promo anodized tin", "Promo Tin", "R0", "PROMO", None)], "key string, canonical string, subject string, chapter string, topic string")
    chapters = s.createDataFrame([("R0", "STANDARD", 0), ("R0", "PROMO", 1), ("R1", "ECONOMY", 2)], "subject string, name string, number int")
    topics = s.createDataFrame([], "subject string, name string, chapter string, number int")
    patterns = s.createDataFrame([("R1", 0, "small|large", "SIZES")], "subject string, number int, pattern string, target string")
    p = t("part").withColumn("s", F.concat(F.lit("R"), F.col("p_size") % 2))
    return lookup.placed(p, "p_partkey", "p_type", "s", aliases, chapters, topics, patterns).select("p_partkey", "chapter")


_ITEMS = """i AS (SELECT p_partkey AS item, string_split(lower(p_name), ' ') AS w, p_brand AS exam FROM part WHERE p_name IS NOT NULL),
o AS (SELECT item, 0 AS no, w[1] AS key, w[1] AS mk FROM i UNION ALL SELECT item, min(k) AS no, key, any_value(mk) FROM (SELECT item, unnest(range(1, len(w))) AS k, unnest(w[2:]) AS key, w[1] AS mk FROM i) WHERE key <> mk GROUP BY item, key)"""


@query(f"""WITH {_ITEMS}, g AS (SELECT key, count(*) FILTER (WHERE no = 0) AS as_main, count(*) FILTER (WHERE no > 0) AS as_option FROM o WHERE key <> '' GROUP BY ALL)
SELECT key, as_main, as_option, as_main + as_option AS total, 3 * as_main + as_option AS importance, CAST(row_number() OVER (ORDER BY 3 * as_main + as_option DESC, as_main + as_option DESC, key) AS INTEGER) AS rank FROM g""")
def option_unpivot_buckets(t):
    w = F.split("p_name", " ")
    p = t("part").filter(F.col("p_name").isNotNull()).select(
        F.col("p_partkey").alias("item"), F.lit("words").alias("table"), w[0].alias("main"), F.when(F.size(w) > 1, F.slice(w, F.lit(2), F.size(w) - 1)).otherwise(F.array().cast("array<string>")).alias("options"),
        F.lit("").alias("correct"), F.col("p_brand").alias("exam"), F.lit(0).alias("year"),
    )
    return vocab.entries(p).select("key", "as_main", "as_option", "total", "importance", "rank")


STOP = ["the", "and", "that", "with", "from", "for"]
_TERMS = "list_distinct(list_filter(list_transform(regexp_extract_all(text, '[a-zA-Z][a-zA-Z''\\-]+'), lambda x: lower(x)), lambda x: length(x) >= 3 AND x NOT IN ('the', 'and', 'that', 'with', 'from', 'for')))"
_DF = f"""d AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents), df AS (SELECT term, count(*) AS df FROM d GROUP BY ALL),
r AS (SELECT term, df, df / (SELECT count(*) FROM documents)::DOUBLE AS share FROM df), q AS (SELECT *, CASE WHEN share <= 0.01 THEN 3 WHEN share <= 0.04 THEN 2 WHEN share <= 0.12 THEN 1 ELSE 0 END AS rarity FROM r)"""


def _stats(t):
    return scoring.document_frequency(t("documents"), "doc_id", content_terms(F.col("text"), STOP))


@query(f"WITH {_DF} SELECT term, df, round(share, 9) AS share, rarity FROM q WHERE df >= 3")
def document_frequency(t):
    return _stats(t).filter("df >= 3").select("term", "df", F.round("share", 9).alias("share"), "rarity")


@query(f"WITH {_DF} SELECT rarity, count(*) AS terms, CAST(sum(df) AS BIGINT) AS df FROM q GROUP BY rarity")
def rarity_buckets(t):
    return _stats(t).groupBy("rarity").agg(F.count("*").alias("terms"), F.sum("df").alias("df"))


_NK = "trim(regexp_replace(translate(replace(lower({0}), '&', ' and '), '/-.' || chr(10) || chr(9) || chr(13), '      '), ' +', ' ', 'g'))"


_TWO_WORDS = "SELECT DISTINCT {0} w[i] || ' ' || w[i + 1] AS key FROM (SELECT *, unnest(range(1, len(w))) AS i FROM (SELECT *, string_split({1}, ' ') AS w FROM {2}))"


@query(f"""WITH p AS ({_TWO_WORDS.format('', _NK.format('text'), 'benchmark')}), d AS ({_TWO_WORDS.format('doc_id,', _NK.format('text'), 'documents')})
SELECT key, count(doc_id) AS df FROM p LEFT JOIN d USING (key) GROUP BY ALL""")
def phrase_document_frequency(t):
    from tessera.functions.text import norm_key

    w = F.split(norm_key(F.col("text")), " ")
    two = F.when(F.size(w) > 1, F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.array_join(F.slice(w, i, F.lit(2)), " ")))
    return scoring.phrase_frequency(t("documents"), "doc_id", "text", t("benchmark").select(F.explode(two).alias("phrase")))


_SCORE = f"""{_DF}, b AS (SELECT item_id AS rule, list_sort({_TERMS}) AS l FROM benchmark), w AS (SELECT rule, unnest(l[1:6]) AS term, 3 AS weight, false AS loose FROM b UNION ALL SELECT rule, unnest(l[7:]), 1, true FROM b),
x AS (SELECT rule, term, max(weight) AS weight, min(loose) AS loose FROM w GROUP BY ALL), h AS (SELECT d.doc_id, x.rule, x.loose, x.weight * coalesce(q.rarity, 3) AS points FROM d JOIN x USING (term) LEFT JOIN q USING (term)),
s AS (SELECT doc_id, rule, coalesce(sum(points) FILTER (WHERE NOT loose), 0) AS strong, least(4, coalesce(sum(points) FILTER (WHERE loose), 0)) AS loosely FROM h GROUP BY ALL),
z AS (SELECT doc_id, rule, strong, strong + loosely AS score, l.n FROM s JOIN (SELECT rule, least(len(l), 6) AS n FROM b) l USING (rule)),
k AS (SELECT *, row_number() OVER o AS rk, lead(score) OVER o AS runner_up FROM z WHERE score >= 4 WINDOW o AS (PARTITION BY doc_id ORDER BY score DESC, n, rule))"""


def _scored(t):
    terms = content_terms(F.col("text"), STOP)
    b = t("benchmark").select(F.col("item_id").alias("rule"), F.array_sort(terms).alias("l"))
    empty = F.array().cast("array<string>")
    cut = lambda i, n: F.when(F.size("l") >= i, F.slice("l", F.lit(i), n)).otherwise(empty)
    rules = b.select("rule", cut(1, F.lit(6)).alias("title_terms"), empty.alias("topic_terms"), empty.alias("signal_words"), cut(7, F.size("l")).alias("body_terms"), empty.alias("example_terms"))
    doc_terms = t("documents").select("doc_id", F.explode(terms).alias("term"))
    s = scoring.score_rules(doc_terms, "doc_id", doc_terms, scoring.rule_terms(rules), _stats(t))
    return s, rules.select("rule", scoring.specificity("title_terms", "topic_terms", "signal_words").alias("terms"))


@query(f"""WITH {_SCORE} SELECT doc_id, rule, CAST(score AS BIGINT) AS score, CAST(runner_up AS BIGINT) AS runner_up,
CASE WHEN score < runner_up * 1.5 THEN 'ambiguous' WHEN strong <> 0 THEN 'matched' ELSE 'weak' END AS outcome FROM k WHERE rk = 1""")
def rule_score_top1_margin(t):
    s, specific = _scored(t)
    return scoring.decide(s, "doc_id", specific)


@query(f"""WITH {_SCORE}, a AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, n, rule) AS rank FROM z WHERE score > 0) SELECT doc_id, CAST(rank AS INTEGER) AS rank, rule, CAST(score AS BIGINT) AS score FROM a WHERE rank <= 3""")
def rule_shortlist(t):
    s, specific = _scored(t)
    return scoring.shortlist(s, "doc_id", specific)


_SIG = """t AS (SELECT d.doc_id, l.quality AS label, unnest(list_transform(regexp_extract_all(text, '[a-zA-Z][a-zA-Z''\\-]+'), lambda x: lower(x))) AS term FROM documents d JOIN labels l USING (doc_id) WHERE l.quality IS NOT NULL),
tf AS (SELECT label, term, count(*) AS tf FROM t GROUP BY ALL), df AS (SELECT term, count(DISTINCT doc_id) AS df FROM t GROUP BY ALL), dc AS (SELECT label, count(DISTINCT doc_id) AS docs FROM t GROUP BY ALL),
s AS (SELECT label, term, tf * ln((2 + 1) / (df + 0.5::DOUBLE)) * (0.4::DOUBLE + tf / docs::DOUBLE) AS weight FROM tf JOIN df USING (term) JOIN dc USING (label) WHERE tf >= 2),
g AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY round(weight, 9) DESC, term) AS k FROM s)"""


def _tokens(t):
    from tessera.functions.text import letter_tokens

    d = t("documents").join(t("labels").filter("quality is not null").select("doc_id", F.col("quality").alias("label")), "doc_id")
    return d.select("doc_id", "label", F.explode(letter_tokens(F.col("text"))).alias("term"))


@query(f"WITH {_SIG} SELECT label, term, round(weight, 6) AS weight FROM g WHERE k <= 50")
def class_signatures(t):
    return scoring.signatures(_tokens(t), "label", "doc_id").select("label", "term", F.round("weight", 6).alias("weight"))


@query("""WITH l AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY doc_id) AS k, count(*) OVER (PARTITION BY quality) AS n FROM labels) SELECT doc_id, quality, k <= greatest(1, floor(n * 0.8::DOUBLE)) AS train FROM l""")
def holdout_split(t):
    return scoring.holdout(t("labels").select("doc_id", "quality"), "quality", ["doc_id"])


@query("""WITH x AS (SELECT n_chars AS score, quality = 1 AS good FROM documents JOIN labels USING (doc_id)), b AS (SELECT score, count(*) AS n, count(*) FILTER (WHERE good) AS r FROM x GROUP BY ALL),
c AS (SELECT score, sum(n) OVER (ORDER BY score DESC) AS cn, sum(r) OVER (ORDER BY score DESC) AS cr FROM b), f AS (SELECT * FROM c WHERE cn > 20 AND cr / cn::DOUBLE >= 0.85 ORDER BY score DESC LIMIT 1)
SELECT max(score) AS threshold, round(max(cn) / (SELECT count(*) FROM x)::DOUBLE, 6) AS coverage FROM f""")
def precision_threshold(t):
    x = t("documents").join(t("labels"), "doc_id").select(F.col("n_chars").alias("score"), (F.col("quality") == 1).alias("good"))
    return scoring.threshold(x, "score", F.col("good"), 0.85).select("threshold", F.round("coverage", 6).alias("coverage"))


@query("""WITH k AS (SELECT p_type AS label, min(p_partkey) AS seq FROM part GROUP BY ALL), c(key, canonical) AS (VALUES ('promo plated tin', 'Plated'), ('not there', 'Ghost'))
SELECT lower(label) AS key, coalesce(canonical, label) AS canonical, CASE WHEN canonical IS NULL THEN 'observed' ELSE 'curated' END AS source FROM k LEFT JOIN c ON key = lower(label)
UNION ALL SELECT key, canonical, 'curated' FROM c WHERE key NOT IN (SELECT lower(label) FROM k)""")
def alias_map(t):
    s = t.spark
    curated = s.createDataFrame([("promo plated tin", "Plated", None, None, None), ("not there", "Ghost", None, None, None)], "key string, canonical string, subject string, chapter string, topic string")
    index = s.createDataFrame([], "key string, name string, kind string, subject string, chapter string, topic string")
    labels = t("part").groupBy(F.col("p_type").alias("label")).agg(F.min("p_partkey").alias("seq"))
    return taxonomy.alias_map(labels, curated, index).select("key", "canonical", "source")
