"""Sections, layouts, packs, samples, shards over orders, lineitem, conversations, events and documents."""

from pyspark.sql import functions as F

from tessera.operators import rank, sections, state
from tessera.plans.registry import query

_SECTIONS = """WITH a AS (SELECT *, last_value(turn IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
  FROM (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY role, turn, text) AS rn FROM conversations)),
s AS (SELECT *, sum(CASE WHEN turn IS NULL OR prev IS NULL OR turn <= prev THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY rn ROWS UNBOUNDED PRECEDING) AS section FROM a)"""


def _turns(t):
    from pyspark.sql import Window

    rows = t("conversations")
    return rows.withColumn("rn", F.row_number().over(Window.partitionBy("conv_id").orderBy("role", "turn", "text")))


@query(f"{_SECTIONS} SELECT conv_id, CAST(section AS INTEGER) AS section, count(*) AS size FROM s GROUP BY ALL")
def sections_by_reset(t):
    return sections.with_sections(_turns(t), ["conv_id"], "rn", "turn", by=["role", "turn", "text"]).groupBy("conv_id", "section").agg(F.count("*").alias("size"))


@query("""WITH a AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS ordinal FROM lineitem),
b AS (SELECT *, last_value(l_linenumber IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM a),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR l_linenumber <= prev THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey ORDER BY ordinal ROWS UNBOUNDED PRECEDING) AS section FROM b),
n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, section ORDER BY ordinal) AS k FROM s)
SELECT l_orderkey, CAST(section AS INTEGER) AS section, count(*) AS size, bool_and(l_linenumber = k) AS clean, CAST(min(ordinal) AS INTEGER) AS start, CAST(max(ordinal) AS INTEGER) AS "end" FROM n GROUP BY l_orderkey, section""")
def section_is_clean(t):
    from pyspark.sql import Window

    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")).alias("ordinal"))
    return sections.clean_sections(rows, ["l_orderkey"], "ordinal", "l_linenumber", ["l_linenumber", "l_partkey"])


_VOTES = """WITH v AS (SELECT user_id, event_type AS subject, count(*) AS votes FROM events GROUP BY ALL),
r AS (SELECT *, sum(votes) OVER (PARTITION BY user_id) AS total, row_number() OVER (PARTITION BY user_id ORDER BY votes DESC,
  CASE subject WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 ELSE 99 END, subject) AS k FROM v)"""


@query(f"{_VOTES} SELECT user_id, subject, votes, CAST(total AS BIGINT) AS total, total >= 3 AND votes / total::DOUBLE >= 0.6 AS decisive FROM r WHERE k = 1")
def section_majority(t):
    return sections.majority(t("events"), ["user_id"], "event_type", ["purchase", "click"])


def _labelled(t):
    """Events as questions: n restarts when the day changes, and only errors and purchases have a subject."""
    from pyspark.sql import Window

    e = t("events").select("user_id", "event_id", "ts", F.when(F.col("event_type").isin("error", "purchase"), F.col("event_type")).alias("subject"))
    w = Window.partitionBy("user_id", F.month("ts")).orderBy("ts", "event_id")
    at = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return e.withColumns({"n": F.row_number().over(w), "ordinal": F.row_number().over(at)})


_LAYOUT = """WITH e AS (SELECT user_id, CASE WHEN event_type IN ('error', 'purchase') THEN event_type END AS subject,
    row_number() OVER (PARTITION BY user_id, month(ts) ORDER BY ts, event_id) AS n, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ordinal FROM events),
a AS (SELECT *, lag(n) OVER (PARTITION BY user_id ORDER BY ordinal) AS prev FROM e),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR n <= prev THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ordinal ROWS UNBOUNDED PRECEDING) AS section FROM a),
v AS (SELECT user_id, section, subject, count(*) AS votes FROM s WHERE subject IS NOT NULL GROUP BY ALL),
m AS (SELECT *, sum(votes) OVER (PARTITION BY user_id, section) AS total, row_number() OVER (PARTITION BY user_id, section ORDER BY votes DESC, subject) AS k FROM v),
p AS (SELECT user_id, section, min(ordinal) AS st, max(ordinal) AS en FROM s GROUP BY ALL),"""


@query(f"""{_LAYOUT}
j AS (SELECT p.*, m.subject FROM p LEFT JOIN m ON p.user_id = m.user_id AND p.section = m.section AND m.k = 1),
f AS (SELECT *, coalesce(subject, last_value(subject IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY section ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  first_value(subject IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY section ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) AS filled FROM j),
q AS (SELECT *, lag(filled) OVER (PARTITION BY user_id ORDER BY section) AS pf FROM f WHERE filled IS NOT NULL),
z AS (SELECT *, sum(CASE WHEN pf IS NULL OR filled <> pf THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY section ROWS UNBOUNDED PRECEDING) AS span FROM q)
SELECT user_id, filled AS subject, CAST(min(st) AS INTEGER) AS start, CAST(max(en) AS INTEGER) AS "end" FROM z GROUP BY user_id, span, filled""")
def layout_detect(t):
    return sections.detected_layout(_labelled(t), "user_id", "ordinal", "n", "subject")


@query(f"""{_LAYOUT}
d AS (SELECT user_id, bool_and(total >= 3 AND votes / total::DOUBLE >= 0.6) AS decisive FROM m WHERE k = 1 GROUP BY ALL),
c AS (SELECT user_id, CAST(max(section) AS INTEGER) AS sections, count(subject) AS voted, count(*) AS rows FROM s GROUP BY ALL)
SELECT c.user_id, sections, round(voted / rows::DOUBLE, 6) AS confidence, decisive,
  coalesce(decisive AND (voted / rows::DOUBLE >= 0.6 OR (sections = 1 AND voted >= 3)), false) AS ok FROM c LEFT JOIN d USING (user_id)""")
def layout_quality(t):
    return sections.layout_quality(_labelled(t), "user_id", "ordinal", "n", "subject")


SPANS = [("low", 1, 10, 0), ("middle", 8, 30, 1), ("high", 31, 45, 2)]


@query("""WITH s(subject, a, b, k) AS (VALUES ('low', 1, 10, 0), ('middle', 8, 30, 1), ('high', 31, 45, 2)),
j AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INTEGER) AS q FROM lineitem)
SELECT q, (SELECT subject FROM s WHERE q BETWEEN a AND b ORDER BY k LIMIT 1) AS subject, count(*) AS n FROM j GROUP BY ALL""")
def span_join(t):
    spans = t.spark.createDataFrame(SPANS, "subject string, start int, end int, number int")
    points = t("lineitem").select(F.col("l_quantity").cast("int").alias("q"))
    return sections.at_point(points, spans, [], "q", "subject", "number").groupBy("q", "subject").agg(F.count("*").alias("n"))


@query("""WITH x AS (SELECT lang AS declared, CASE CAST(substr(source, 4) AS INTEGER) % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' WHEN 2 THEN NULL ELSE 'de' END AS seen, source FROM documents)
SELECT source, count(*) AS total, count(declared) AS positional_known, count(seen) AS keyword_known, count(*) FILTER (WHERE declared IS NOT NULL AND seen IS NOT NULL) AS comparable,
  count(*) FILTER (WHERE declared = seen) AS hits,
  CASE WHEN count(seen) = 0 THEN 0.0::DOUBLE ELSE round(count(*) FILTER (WHERE declared = seen) / count(seen)::DOUBLE, 6) END AS agreement,
  count(seen) > 0 AND count(*) FILTER (WHERE declared = seen) / count(seen)::DOUBLE >= 0.6 AS ok FROM x GROUP BY source""")
def signature_agreement(t):
    k = F.substring("source", 4, 9).cast("int") % 4
    d = t("documents").select("source", "lang", F.when(k == 0, "en").when(k == 1, "fr").when(k == 3, "de").alias("seen"))
    return sections.agreement(d, ["source"], F.col("lang"), F.col("seen"))


@query("""WITH x AS (SELECT source, doc_id % 4 AS span, CASE doc_id % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' ELSE 'de' END AS declared, lang FROM documents),
v AS (SELECT source, span, declared, lang, count(*) AS n FROM x GROUP BY ALL), m AS (SELECT *, row_number() OVER (PARTITION BY source, span ORDER BY n DESC, lang) AS k FROM v)
SELECT source, count(*) AS spans, count(lang) AS comparable, count(*) FILTER (WHERE lang = declared) AS hits, round(count(*) FILTER (WHERE lang = declared) / count(lang)::DOUBLE, 6) AS agreement
FROM m WHERE k = 1 GROUP BY source""")
def section_agreement(t):
    k = F.col("doc_id") % 4
    d = t("documents").select("source", k.alias("span"), F.when(k == 0, "en").when(k == 1, "fr").otherwise("de").alias("declared"), "lang")
    return sections.section_agreement(d, ["source"], "span", "declared", "lang")


@query("""WITH a AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders), b AS (SELECT *, count(*) OVER (PARTITION BY o_orderpriority) AS n,
  row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus, y ORDER BY o_orderdate, o_orderkey) AS turn FROM a),
c AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY turn, o_orderstatus, y, o_orderdate, o_orderkey) AS p FROM b WHERE n >= 5)
SELECT 'priority' AS kind, trim(regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '-', 'g'), '-') AS id, CAST(count(*) AS INTEGER) AS count, min(y) AS first_year, max(y) AS last_year,
  string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY p) AS items FROM c WHERE p <= 60 GROUP BY o_orderpriority
UNION ALL
SELECT 'full', 'all', CAST(count(*) AS INTEGER), min(y), max(y), string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY p)
FROM (SELECT *, row_number() OVER (ORDER BY turn2, o_orderstatus, y, o_orderdate, o_orderkey) AS p FROM
  (SELECT *, row_number() OVER (PARTITION BY o_orderstatus, y ORDER BY o_orderdate, o_orderkey) AS turn2 FROM a)) WHERE p <= 60""")
def round_robin_packs(t):
    o = t("orders").withColumns({"y": F.year("o_orderdate"), "everything": F.lit("all")})
    out = rank.packs(o, {"priority": ["o_orderpriority"], "full": ["everything"]}, "o_orderkey", ["o_orderstatus", "y"], ["o_orderdate", "o_orderkey"], 60, 5)
    return out.select("kind", "id", "count", "first_year", "last_year", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))


@query("""WITH a AS (SELECT p_brand, p_type, 'type' AS kind, trim(regexp_replace(lower(split_part(p_type, ' ', 1)), '[^a-z0-9]+', '-', 'g'), '-') AS id, p_brand || '|' || p_type AS k
  FROM (SELECT DISTINCT p_brand, p_type FROM part)), b AS (SELECT *, row_number() OVER (PARTITION BY kind, id ORDER BY k) AS n FROM a)
SELECT k, CASE WHEN n = 1 THEN id ELSE id || '--' || substr(sha256(k), 1, 6) END AS id FROM b""")
def pack_id_disambiguation(t):
    p = t("part").select("p_brand", "p_type").distinct()
    p = p.select(F.lit("type").alias("kind"), F.btrim(F.regexp_replace(F.lower(F.split("p_type", " ")[0]), "[^a-z0-9]+", "-"), F.lit("-")).alias("id"), F.array("p_brand", "p_type").alias("key"))
    return rank.distinct_ids(p).select(F.array_join("key", "|").alias("k"), "id")


@query("""WITH a AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) - 1 AS p, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders),
i AS (SELECT unnest(range(0, 7)) AS i)
SELECT DISTINCT o_orderpriority, o_orderkey FROM a JOIN i ON i < least(n, 7) AND (i * n) // least(n, 7) = p""")
def even_spaced_sample(t):
    return rank.evenly(t("orders"), ["o_orderpriority"], ["o_orderdate", "o_orderkey"], 7).select("o_orderpriority", "o_orderkey")


@query("""WITH z AS (SELECT p_brand, count(*) AS size FROM part GROUP BY ALL), r AS (SELECT *, row_number() OVER (ORDER BY size DESC, p_brand) AS k FROM z),
b AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS p, count(*) OVER () AS n FROM r WHERE k > 3),
c AS (SELECT p_brand FROM r WHERE k <= 3 UNION SELECT p_brand FROM b JOIN (SELECT unnest(range(0, 3)) AS i) ON i < least(n, 3) AND (i * n) // least(n, 3) = p),
a AS (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS p, count(*) OVER (PARTITION BY p_brand) AS n FROM part WHERE p_brand IN (SELECT p_brand FROM c))
SELECT DISTINCT p_brand, p_partkey FROM a JOIN (SELECT unnest(range(0, 4)) AS i) ON i < least(n, 4) AND (i * n) // least(n, 4) = p""")
def stratified_sample(t):
    return rank.stratified(t("part").select("p_brand", "p_partkey"), "p_brand", ["p_partkey"], 6, 4)


@query("""WITH r AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
SELECT o_custkey, o_orderkey, o_totalprice, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3""")
def top_k_per_group(t):
    rows = t("orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return rank.top_k(rows, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


@query("""WITH x AS (SELECT o_custkey, CAST(o_totalprice / 1000 AS BIGINT) AS s, o_orderkey FROM orders), a AS (SELECT * FROM x WHERE s >= 4),
r AS (SELECT *, row_number() OVER w AS k, lead(s) OVER w AS runner_up FROM a WINDOW w AS (PARTITION BY o_custkey ORDER BY s DESC, o_orderkey))
SELECT c.o_custkey, s, o_orderkey, runner_up, CASE WHEN k IS NULL THEN 'none' WHEN runner_up IS NOT NULL AND s < runner_up * 1.5 THEN 'ambiguous' ELSE 'matched' END AS outcome
FROM (SELECT DISTINCT o_custkey FROM orders) c LEFT JOIN (SELECT * FROM r WHERE k = 1) b ON c.o_custkey IS NOT DISTINCT FROM b.o_custkey""")
def top1_with_margin(t):
    rows = t("orders").select("o_custkey", F.rint(F.col("o_totalprice") / 1000).cast("long").alias("s"), "o_orderkey")
    return rank.with_margin(rows, ["o_custkey"], "s", [F.asc_nulls_last("o_orderkey")], 4, 1.5)


@query("""WITH n AS (SELECT c_mktsegment, o_orderpriority, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY n DESC, o_orderpriority) AS k FROM n)
SELECT c_mktsegment, o_orderpriority, n FROM r WHERE k = 1""")
def mode_per_group(t):
    rows = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rank.mode(rows, ["c_mktsegment"], "o_orderpriority")


@query("""WITH RECURSIVE o AS (SELECT lang, doc_id, n_chars, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS k FROM documents),
f AS (SELECT lang, k, doc_id, n_chars, 0 AS shard, n_chars AS held FROM o WHERE k = 1
  UNION ALL SELECT o.lang, o.k, o.doc_id, o.n_chars, CASE WHEN f.held > 0 AND f.held + o.n_chars > 50000 THEN f.shard + 1 ELSE f.shard END,
    CASE WHEN f.held > 0 AND f.held + o.n_chars > 50000 THEN o.n_chars ELSE f.held + o.n_chars END FROM f JOIN o ON o.lang = f.lang AND o.k = f.k + 1)
SELECT lang, shard, count(*) AS records, CAST(sum(n_chars) AS BIGINT) AS bytes, min(doc_id) AS first_id FROM f GROUP BY ALL""")
def shard_assignment(t):
    cut = rank.byte_shards(t("documents").select("lang", "doc_id", "n_chars"), "lang", ["doc_id"], "n_chars", 50_000)
    return cut.groupBy("lang", "shard").agg(F.count("*").alias("records"), F.sum("n_chars").alias("bytes"), F.min("doc_id").alias("first_id"))


@query("""WITH a AS (SELECT o_orderpriority, o_orderkey, CAST(floor((row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1) / 250) AS INTEGER) AS batch FROM orders)
SELECT o_orderpriority, batch, substr(sha256('v1' || string_agg(CAST(o_orderkey AS VARCHAR), chr(10) ORDER BY o_orderkey)), 1, 32) AS fingerprint, count(*) AS items FROM a GROUP BY ALL""")
def batch_fingerprint(t):
    cut = rank.batches(t("orders"), ["o_orderpriority"], ["o_orderkey"], 250)
    return state.ordered_digest(cut, ["o_orderpriority", "batch"], ["o_orderkey"], F.col("o_orderkey").cast("string"), salt="v1")


@query("""WITH a AS (SELECT o_orderpriority, o_orderkey, CAST(floor((row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1) / 250) AS INTEGER) AS batch FROM orders),
b AS (SELECT o_orderpriority, batch, substr(sha256(string_agg(CAST(o_orderkey AS VARCHAR), chr(10) ORDER BY o_orderkey)), 1, 32) AS fingerprint, count(*) AS items FROM a GROUP BY ALL)
SELECT * FROM b WHERE batch % 3 <> 0""")
def pending_batches(t):
    cut = rank.batches(t("orders"), ["o_orderpriority"], ["o_orderkey"], 250)
    work = state.ordered_digest(cut, ["o_orderpriority", "batch"], ["o_orderkey"], F.col("o_orderkey").cast("string"))
    return state.pending(work, work.filter("batch % 3 = 0")).select("o_orderpriority", "batch", "fingerprint", "items")


@query("SELECT c_mktsegment AS subject, sha256(string_agg(CAST(c_custkey AS VARCHAR), chr(10) ORDER BY CAST(c_custkey AS VARCHAR))) AS digest, count(*) AS records FROM customer GROUP BY ALL")
def qid_digest(t):
    return state.set_digest(t("customer").withColumnRenamed("c_mktsegment", "subject"), ["subject"], "c_custkey")


_CORRECTIONS = """WITH c AS (SELECT o_custkey AS c_custkey, o_orderkey AS seq, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderpriority END AS c_mktsegment, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS c_name FROM orders),
x AS (SELECT c_custkey, arg_max(c_mktsegment, seq) FILTER (WHERE trim(c_mktsegment) <> '') AS s, arg_max(c_name, seq) FILTER (WHERE trim(c_name) <> '') AS n FROM c GROUP BY ALL)"""


@query(f"{_CORRECTIONS} SELECT c.c_custkey, coalesce(x.s, c.c_mktsegment) AS c_mktsegment, coalesce(x.n, c.c_name) AS c_name, CASE WHEN x.s IS NOT NULL OR x.n IS NOT NULL THEN 'corrected' ELSE 'index' END AS source FROM customer c LEFT JOIN x USING (c_custkey)")
def apply_corrections(t):
    rows = t("customer").select("c_custkey", "c_mktsegment", "c_name", F.lit("index").alias("source"))
    o = t("orders")
    fixes = o.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("seq"), F.when(F.col("o_orderkey") % 4 == 0, "").otherwise(F.col("o_orderpriority")).alias("c_mktsegment"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("c_name"))
    return state.corrected(rows, fixes, ["c_custkey"], ["c_mktsegment", "c_name"], "seq")


@query("SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment FROM customer")
def null_out_repairs(t):
    rows = t("customer").select("c_custkey", "c_mktsegment")
    return state.nulled(rows, t("customer").filter("c_acctbal < 0"), ["c_custkey"], ["c_mktsegment"])


@query("""WITH b AS (SELECT event_type, user_id % 10 AS u, ts, 0 AS new FROM events WHERE event_id % 2 = 0 UNION ALL SELECT event_type, user_id % 10, ts, 1 FROM events WHERE event_id % 2 = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type, u ORDER BY ts DESC, new DESC) AS k FROM b)
SELECT event_type, u, ts FROM r WHERE k = 1 ORDER BY ts DESC, event_type, u LIMIT 20""")
def keyed_upsert(t):
    e = t("events").select("event_type", (F.col("user_id") % 10).alias("u"), "ts", "event_id")
    return state.upsert(e.filter("event_id % 2 = 0").drop("event_id"), e.filter("event_id % 2 = 1").drop("event_id"), ["event_type", "u"], "ts", 20)
