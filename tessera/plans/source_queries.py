"""Sources and sinks: what they write is read back and compared."""

from pyspark.sql import functions as F

from tessera.plans.registry import query
from tessera.sources import files, outline, shards
from tessera.sources.scratch import new_path


def _papers(t):
    """A JSON document for each region, with its nations as questions, in a folder that names a year."""
    q = F.struct(F.concat(F.lit("n"), F.col("n_nationkey")).alias("qid"), F.col("n_nationkey").alias("n"), F.col("n_name").alias("concept"))
    both = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = both.groupBy("r_regionkey", "r_name").agg(F.array_sort(F.collect_list(q)).alias("questions"))
    rows = rows.select(F.concat(F.lit("set "), F.col("r_regionkey") + 2018).alias("folder"), F.col("r_name").alias("title"), "questions")
    root = new_path(t.spark, "papers")
    rows.repartition("folder").write.partitionBy("folder").json(root)
    return files.scan_papers(t.spark, root)


@query("""SELECT r_name AS title, CAST(r_regionkey + 2018 AS INTEGER) AS year, (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey) AS questions FROM region""")
def paper_scan(t):
    return _papers(t).select("title", "year", F.size("questions").cast("long").alias("questions"))


@query("""SELECT r_name AS title, CASE WHEN r_regionkey + 2018 BETWEEN 2019 AND 2021 THEN 'kept' ELSE 'year out of range' END AS verdict FROM region""")
def papers_in_scope(t):
    kept, dropped = files.in_scope(_papers(t), 2019, 2021)
    return kept.select("title", F.lit("kept").alias("verdict")).unionByName(dropped.select("title", F.col("reason").alias("verdict")))


@query("""SELECT 'n' || n_nationkey AS qid, n_name AS concept, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY 'n' || n_nationkey) AS INTEGER) AS ordinal,
  CAST(n_regionkey + 2018 AS INTEGER) AS year FROM nation""")
def paper_questions(t):
    return files.questions_of(_papers(t)).select("q.qid", "q.concept", "ordinal", "year")


@query("SELECT o_orderstatus, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY ALL")
def lines_strict(t):
    path = new_path(t.spark, "lines")
    files.write_lines(t("orders").select("o_orderkey", "o_orderstatus"), path, gzip=True)
    got = files.read_lines(t.spark, path, "o_orderkey long, o_orderstatus string")
    return got.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query("SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders WHERE o_orderstatus <> 'P'")
def lines_tolerant(t):
    # the lines of one status are torn off after the key
    whole = F.to_json(F.struct("o_orderkey", "o_orderstatus"))
    path = new_path(t.spark, "lines")
    torn = F.when(F.col("o_orderstatus") == "P", F.expr("substring(to_json(struct(o_orderkey, o_orderstatus)), 1, 16)")).otherwise(whole)
    t("orders").select(torn.alias("value")).write.text(path)
    got = files.read_lines(t.spark, path, "o_orderkey long, o_orderstatus string", strict=False)
    # a column beside those of the file is read, so that every line is parsed
    return got.filter(F.col("o_orderkey").isNotNull() & F.col("o_orderstatus").isNotNull()).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query("SELECT 0 AS missing, count(*) AS found FROM nation")
def lines_fallback(t):
    path = new_path(t.spark, "lines")
    missing = files.read_lines(t.spark, f"{path}-none", "n_name string").count()
    t("nation").write.parquet(path)
    got = files.read_index(t.spark, "n_name string", f"{path}-none", f"{path}-none.jsonl", path)
    return got.agg(F.lit(missing).cast("int").alias("missing"), F.count("*").alias("found"))


@query("SELECT c_mktsegment, 2 * count(*) AS n, CAST(2 * sum(c_custkey) AS BIGINT) AS keys FROM customer GROUP BY ALL")
def lines_append(t):
    path, rows = new_path(t.spark, "lines"), t("customer").select("c_custkey", "c_mktsegment")
    files.write_lines(rows, path)
    files.write_lines(rows, path, append=True)
    got = files.read_lines(t.spark, path, "c_custkey long, c_mktsegment string")
    return got.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys"))


@query("SELECT c_mktsegment, count(*) AS records, CAST(ceil(count(*) / 100) AS BIGINT) AS files FROM customer GROUP BY ALL")
def index_manifest(t):
    rows = t("customer").repartition("c_mktsegment")
    return files.write_index(rows, new_path(t.spark, "index"), "c_mktsegment", "c_custkey", 100).select("c_mktsegment", "records", "files")


_LINE = "length('{\"c_custkey\":,\"c_mktsegment\":\"\",\"c_name\":\"\"}') + length(CAST(c_custkey AS VARCHAR)) + length(c_mktsegment) + length(c_name) + 1"


@query(f"""WITH RECURSIVE o AS (SELECT c_mktsegment AS g, c_custkey, {_LINE} AS n, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS k FROM customer),
f AS (SELECT g, k, c_custkey, n, 0 AS shard, n AS held FROM o WHERE k = 1
  UNION ALL SELECT o.g, o.k, o.c_custkey, o.n, CASE WHEN f.held + o.n > 6000 THEN f.shard + 1 ELSE f.shard END, CASE WHEN f.held + o.n > 6000 THEN o.n ELSE f.held + o.n END FROM f JOIN o ON o.g = f.g AND o.k = f.k + 1),
s AS (SELECT *, row_number() OVER (ORDER BY g, k) - 1 AS seq FROM f)
SELECT g AS c_mktsegment, CAST(shard AS INTEGER) AS shard, count(*) AS records, min(c_custkey) AS first_key, min(seq) AS first_seq FROM s GROUP BY ALL""")
def index_shards(t):
    rows = t("customer").select("c_custkey", "c_mktsegment", "c_name")
    got = shards.round_trip(rows, "c_mktsegment", ["c_custkey"], 6000, packed=True)
    return got.groupBy("c_mktsegment", F.col("__shard").alias("shard")).agg(F.count("*").alias("records"), F.min("c_custkey").alias("first_key"), F.min("seq").alias("first_seq"))


@query("SELECT 'second' AS name, 2 AS version, 7 AS fallback, sha256('{' || chr(10) || '  \"version\": 2' || chr(10) || '}' || chr(10)) AS sha256")
def document_replace(t):
    path = new_path(t.spark, "document")
    files.write_json(t.spark, f"{path}/second", {"version": 1})
    files.write_json(t.spark, f"{path}/second", {"version": 2})
    version, fallback = files.read_document(t.spark, f"{path}/second")["version"], files.read_document(t.spark, f"{path}/none", 7)
    got = files.file_digests(t.spark, path)
    return got.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.lit(version).alias("version"), F.lit(fallback).alias("fallback"), "sha256")


_PLACED = "SELECT n_name, r_name, c_mktsegment, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


def _placed(t):
    both = t("customer").join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return both.select("n_name", "r_name", "c_mktsegment", "c_custkey")


@query(f"WITH p AS ({_PLACED}) SELECT 'r_name=' || replace(r_name, ' ', ' ') || '/n_name=' || n_name AS place, count(*) AS rows FROM p WHERE c_mktsegment <> 'BUILDING' GROUP BY ALL")
def tree_places(t):
    root, rows = new_path(t.spark, "tree"), _placed(t)
    files.write_tree(rows, root, ["r_name", "n_name"])  # replaced by the second write
    files.write_tree(rows, root, ["r_name", "n_name"], rows.filter("c_mktsegment = 'BUILDING'"), ["c_custkey"], whole=True)
    return files.places(files.leaf_rows(t.spark, root, "c_custkey long"))


@query(f"WITH p AS ({_PLACED}) SELECT r_name, count(*) AS rows, CAST(sum(c_custkey) AS BIGINT) AS keys FROM p WHERE r_name <> 'ASIA' GROUP BY ALL")
def tree_stale_parts(t):
    root, rows = new_path(t.spark, "tree"), _placed(t)
    files.write_tree(rows, root, ["r_name", "n_name"])
    files.write_tree(rows.filter("r_name <> 'ASIA'"), root, ["r_name", "n_name"], whole=True)
    got = files.leaf_rows(t.spark, root, "c_custkey long").withColumn("r_name", F.regexp_extract("place", "r_name=([^/]+)", 1))
    return got.groupBy("r_name").agg(F.count("*").alias("rows"), F.sum("c_custkey").alias("keys"))


@query("SELECT c_mktsegment AS kind, count(DISTINCT c_nationkey) AS packs, count(*) AS questions FROM customer GROUP BY ALL")
def packs_catalogue(t):
    packs = t("customer").groupBy(F.col("c_mktsegment").alias("kind"), "c_nationkey").agg(F.count("*").alias("count"))
    root = new_path(t.spark, "packs")
    files.write_packs(packs, root)
    return files.write_packs(packs, root)


@query("SELECT c_mktsegment AS title, c_acctbal >= 0 AS ok, count(*) AS n FROM customer WHERE c_acctbal < 0 GROUP BY ALL")
def report_flags(t):
    rows = t("customer").select(F.col("c_mktsegment").alias("title"), (F.col("c_acctbal") >= 0).alias("ok"), "c_custkey")
    flagged = files.write_reports(rows, rows.agg(F.count("*").alias("papers")), new_path(t.spark, "reports"))
    return flagged.groupBy("title", "ok").agg(F.count("*").alias("n"))


@query("SELECT CAST(n_nationkey AS INTEGER) AS rule, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal > 9000) AS count FROM nation")
def rule_leaves(t):
    rows = t("supplier").filter("s_acctbal > 9000").select(F.col("s_nationkey").cast("int").alias("rule"), "s_suppkey")
    return files.write_rule_leaves(rows, t("nation").select(F.col("n_nationkey").cast("int").alias("rule")), new_path(t.spark, "leaves"))


def _markdown(t, lines):
    path = new_path(t.spark, "outline")
    files.write_document(t.spark, path, lines)
    return outline.read_lines(t.spark, path)


def _outlined(t, depth):
    # nations under regions, a chapter each; small tables, so the text is made on the driver
    rows = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("r_regionkey", "r_name", "n_nationkey", "n_name").collect()
    text = ["# Notes", "- dropped"]
    for k, region in sorted({(r["r_regionkey"], r["r_name"]) for r in rows}):
        text += [f"# {k + 1}. {region}", "## Members"] + (["### Nations"] if depth == 3 else [])
        text += [f"- [{r['n_nationkey']}] {r['n_name']}" for r in sorted(rows, key=lambda r: r["n_nationkey"]) if r["r_regionkey"] == k]
    return outline.outline(_markdown(t, "\n".join(text) + "\n"), 1, 5, depth)


_CONCEPTS = """SELECT CAST(r_regionkey + 1 AS INTEGER) AS chapter_no, r_name AS chapter, 'Members' AS topic, {sub} AS subtopic, n_name AS name, CAST(n_nationkey AS VARCHAR) AS tag
  FROM nation JOIN region ON n_regionkey = r_regionkey"""


@query(_CONCEPTS.format(sub="CAST(NULL AS VARCHAR)"))
def outline_concepts(t):
    return _outlined(t, 2).filter("kind = 'concept'").select("chapter_no", "chapter", "topic", "subtopic", "name", "tag")


@query(_CONCEPTS.format(sub="'Nations'"))
def outline_concepts_deep(t):
    return _outlined(t, 3).filter("kind = 'concept'").select("chapter_no", "chapter", "topic", "subtopic", "name", "tag")


@query("""SELECT CAST(r_regionkey + 1 AS INTEGER) AS number, r_name AS title, 'Regions' AS topic, 'not ' || r_name AS wrong, r_name AS right FROM region""")
def rule_text_scan(t):
    rows = sorted((r["r_regionkey"], r["r_name"]) for r in t("region").collect())
    text = "".join(f"## Rule {k + 1}: {n}\n**Topic:** Regions\nUse “{n}”.\n**Examples:**\n- ✗ not {n}\n- ✓ {n}\n" for k, n in rows)
    got = outline.rule_blocks(_markdown(t, text))
    return got.select("number", "title", "topic", F.col("wrong")[0].alias("wrong"), F.col("right")[0].alias("right"))


@query("""WITH n AS (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS k, count(*) OVER (PARTITION BY c_nationkey) AS size FROM customer)
SELECT c_nationkey, string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY k) AS items, greatest(max(size) - 5, 0) AS more FROM n WHERE k <= 5 GROUP BY ALL""")
def page_of_ids(t):
    got = files.page(t("customer"), "c_nationkey", "c_custkey", ["c_custkey"], 5)
    return got.select("c_nationkey", F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("items"), F.col("more").cast("long").alias("more"))
