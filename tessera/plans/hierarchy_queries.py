"""Distributions over lineitem, orders, customer, nation and region."""

from pyspark.sql import functions as F

from tessera.functions.text import collapse_levels, leaf_path
from tessera.operators import hierarchy as h
from tessera.operators.rank import recent_values
from tessera.plans.registry import query

LEVELS = ["region", "nation", "segment"]
LATEST = 2001
_FACTS = """
f AS (SELECT r_name AS region, n_name AS nation, c_mktsegment AS segment, year(o_orderdate) AS y
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
_NODES = f"""
{_FACTS},
g AS (SELECT *, CASE WHEN {LATEST} - y <= 0 THEN 100 WHEN {LATEST} - y = 1 THEN 75 WHEN {LATEST} - y = 2 THEN 50 ELSE 30 END AS w FROM f),
n AS (SELECT region, nation, segment, 3 - bit_count(grouping(region, nation, segment)) AS level, count(*) AS questions,
    sum(w) / 100.0 AS recency, count(*) FILTER (WHERE y BETWEEN {LATEST - 1} AND {LATEST}) AS last_2y,
    count(*) FILTER (WHERE y BETWEEN {LATEST - 3} AND {LATEST - 2}) AS prev_2y
  FROM g GROUP BY ROLLUP (region, nation, segment) HAVING grouping(region, nation, segment) < 7)"""
_SCORED = f"""
{_NODES},
m AS (SELECT max(recency) AS mr, max(questions) AS mq FROM n),
t AS (SELECT *, greatest(-1.0, least(1.0, (last_2y - prev_2y) / greatest(prev_2y, 1)::DOUBLE)) AS tr FROM n, m),
s AS (SELECT region, nation, segment, CAST(level AS INTEGER) AS level, questions, CAST(recency AS DOUBLE) AS recency, last_2y, prev_2y,
  last_2y - prev_2y AS delta_2y, CAST(round(tr, 4) AS DOUBLE) AS trend,
  CAST(round(100.0 * (0.50 * recency / mr + 0.35 * questions / mq + 0.15 * ((tr + 1) / 2)), 4) AS DOUBLE) AS importance FROM t)"""


def facts(t):
    o = t("orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"))
    c = t("customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("segment"))
    n = t("nation").select("n_nationkey", "n_regionkey", F.col("n_name").alias("nation"))
    r = t("region").select("r_regionkey", F.col("r_name").alias("region"))
    li = t("lineitem").select("l_orderkey")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(
        n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(*LEVELS, "y")


def scored(t):
    return h.with_importance(h.nodes(facts(t), LEVELS, "y", LATEST))


@query(f"WITH {_SCORED} SELECT * FROM s")
def importance_by_hierarchy(t):
    return scored(t).select(*LEVELS, "level", "questions", "recency", "last_2y", "prev_2y", "delta_2y", "trend", "importance")


@query(f"WITH {_SCORED} SELECT *, CAST(row_number() OVER (ORDER BY importance DESC, questions DESC, region, nation, segment) AS INTEGER) AS rank FROM s WHERE level = 2 ORDER BY rank LIMIT 10")
def priority_overall(t):
    from pyspark.sql import Window

    top = h.priority(scored(t), 2, LEVELS, 10)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("importance"), F.desc("questions"), *LEVELS)))


@query(f"""WITH {_SCORED}, p AS (SELECT *, CAST(row_number() OVER (PARTITION BY region ORDER BY importance DESC, questions DESC, region, nation, segment) AS INTEGER) AS rank FROM s WHERE level = 3)
SELECT * FROM p WHERE rank <= 5""")
def priority_by_subject(t):
    return h.priority(scored(t), 3, LEVELS, 5, ["region"])


@query(f"WITH {_FACTS} SELECT CAST(y AS INTEGER) AS y, CASE WHEN {LATEST} - y <= 0 THEN 1.0::DOUBLE WHEN {LATEST} - y = 1 THEN 0.75::DOUBLE WHEN {LATEST} - y = 2 THEN 0.5::DOUBLE ELSE 0.3::DOUBLE END AS weight, count(*) AS n FROM f GROUP BY ALL")
def recency_weighted_counts(t):
    return facts(t).groupBy("y").agg(F.count("*").alias("n")).select("y", h.recency_weight(F.col("y"), F.lit(LATEST)).alias("weight"), "n")


@query(f"WITH {_FACTS} SELECT region, nation, count(*) AS count FROM f GROUP BY ALL ORDER BY count DESC, region, nation LIMIT 12")
def top_chapters(t):
    return h.top_counts(facts(t), ["region", "nation"], 12)


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("""WITH x AS (SELECT o_orderpriority AS priority, c_mktsegment AS s FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'))
SELECT priority, count(*) FILTER (WHERE s = 'AUTOMOBILE') AS "AUTOMOBILE", count(*) FILTER (WHERE s = 'BUILDING') AS "BUILDING",
  count(*) FILTER (WHERE s = 'FURNITURE') AS "FURNITURE", count(*) FILTER (WHERE s = 'HOUSEHOLD') AS "HOUSEHOLD",
  count(*) FILTER (WHERE s = 'MACHINERY') AS "MACHINERY", count(*) AS total,
  round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM x), 1) AS share FROM x GROUP BY priority""")
def exam_subject_matrix(t):
    rows = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderpriority").alias("priority"), F.col("c_mktsegment").alias("s"))
    return h.matrix(rows, "priority", "s", SEGMENTS)


@query("""SELECT o_orderstatus AS exam, o_orderpriority AS subject, CAST(grouping(o_orderstatus, o_orderpriority) AS BIGINT) AS level, count(*) AS count
FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def exam_subject_totals(t):
    rows = t("orders").select(F.col("o_orderstatus").alias("exam"), F.col("o_orderpriority").alias("subject"))
    return h.counts_with_totals(rows, "exam", "subject")


@query("""WITH r AS (SELECT d.doc_id, l.quality, coalesce(d.source, '') AS source FROM documents d LEFT JOIN labels l USING (doc_id)),
a AS (SELECT count(*) FILTER (WHERE coalesce(quality = 1, false)) AS placed, count(*) FILTER (WHERE NOT coalesce(quality = 1, false)) AS unclassified FROM r WHERE source <> 'src0'),
b AS (SELECT count(*) FILTER (WHERE source = 'src0') AS skipped, count(*) AS total FROM r)
SELECT placed, unclassified, skipped, total, placed + unclassified + skipped = total AS balanced FROM a, b""")
def coverage_identity(t):
    r = t("documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source")).join(t("labels").select("doc_id", "quality"), "doc_id", "left")
    reports = r.select((F.col("source") == "src0").cast("int").alias("s"), F.lit(1).alias("one"))
    return h.coverage(r.filter("source <> 'src0'"), F.coalesce(F.col("quality") == 1, F.lit(False)), reports, skipped="s", total="one")


_PATHS = "SELECT list_filter([r_name, n_name, c_mktsegment], lambda x: x IS NOT NULL) AS p FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
_TREE = f"""WITH a AS ({_PATHS}), b AS (SELECT p, unnest(range(1, len(p) + 1)) AS k FROM a),
s AS (SELECT array_to_string(p[1:k], '/') AS node, any_value(k) AS depth, count(*) FILTER (WHERE k = len(p)) AS own, count(*) AS subtree FROM b GROUP BY 1)"""


def _paths(t):
    c = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return c.select(F.array("r_name", "n_name", "c_mktsegment").alias("path"))


@query(f"{_TREE} SELECT node, CAST(depth AS INTEGER) AS depth, own, subtree FROM s")
def subtree_counts(t):
    return h.subtree_counts(_paths(t), "path").select(F.array_join("node", "/").alias("node"), "depth", "own", "subtree")


@query(f"""{_TREE} SELECT CASE WHEN depth > 1 THEN node[1:length(node) - strpos(reverse(node), '/')] ELSE '' END AS parent,
  list_last(string_split(node, '/')) AS child, CAST(depth AS INTEGER) AS depth, subtree FROM s""")
def child_summaries(t):
    return h.children(h.subtree_counts(_paths(t), "path")).select(F.array_join("parent", "/").alias("parent"), "child", "depth", "subtree")


@query("""WITH a AS (SELECT p_partkey, [split_part(p_name, ' ', 1), CASE WHEN p_size % 3 = 0 THEN split_part(p_name, ' ', 1) ELSE split_part(p_name, ' ', 2) END, p_brand] AS l FROM part),
b AS (SELECT p_partkey, list_filter(l, lambda x, i: i = 1 OR x <> l[i - 1]) AS l FROM a)
SELECT p_partkey, array_to_string(l, '/') AS path, CAST(len(l) AS INTEGER) AS depth FROM b""")
def collapse_repeated_levels(t):
    w = F.split("p_name", " ")
    levels = F.array(w[0], F.when(F.col("p_size") % 3 == 0, w[0]).otherwise(w[1]), F.col("p_brand"))
    out = t("part").select("p_partkey", collapse_levels(levels).alias("l"))
    return out.select("p_partkey", F.array_join("l", "/").alias("path"), F.size("l").alias("depth"))


_SLUG = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'), '-')"


@query(f"""WITH a AS (SELECT p_partkey, {_SLUG.format('p_type')} AS c, {_SLUG.format('p_brand')} AS k, p_size % 5 = 0 AS other FROM part)
SELECT p_partkey, CASE WHEN other AND c <> k THEN c || '/_other/' || k WHEN c = k THEN c ELSE c || '/' || k END AS path FROM a""")
def leaf_paths(t):
    path = leaf_path(F.col("p_type"), F.lit(None).cast("string"), F.col("p_brand"), F.col("p_size") % 5 == 0)
    return t("part").select("p_partkey", F.array_join(path, "/").alias("path"))


@query("SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders ORDER BY y DESC LIMIT 3")
def recent_years(t):
    return recent_values(t("orders").select(F.year("o_orderdate").alias("y")), "y", 3)


@query("""WITH x AS (SELECT c_mktsegment AS segment, count(*) FILTER (WHERE year(o_orderdate) = 1999) AS before, count(*) FILTER (WHERE year(o_orderdate) = 2000) AS now
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
SELECT *, now - before AS delta, CASE WHEN now = before THEN 'flat' WHEN before = 0 THEN 'new' WHEN now > before THEN 'up +' || (now - before) ELSE 'down ' || (now - before) END AS label FROM x""")
def year_over_year(t):
    rows = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_mktsegment").alias("segment"), F.year("o_orderdate").alias("y"))
    return h.two_periods(rows, ["segment"], "y", [1999, 2000])


@query("SELECT o_orderpriority AS priority, count(*) AS rows, CAST(min(year(o_orderdate)) AS INTEGER) AS first_year, CAST(max(year(o_orderdate)) AS INTEGER) AS last_year FROM orders GROUP BY ALL")
def topic_summary(t):
    return h.span_of(t("orders").select(F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").alias("y")), ["priority"], "y")


@query("SELECT n_name AS nation, count(s_suppkey) AS suppliers FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal > 5000 GROUP BY ALL")
def rules_with_zero_rows(t):
    n = t("supplier").filter("s_acctbal > 5000").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("nation")).agg(F.count("*").alias("suppliers"))
    return h.with_empty(n, t("nation").select(F.col("n_name").alias("nation")), ["nation"], "suppliers")
