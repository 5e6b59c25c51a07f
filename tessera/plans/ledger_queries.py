"""Ledgers, outages, failure runs, audits and event windows over events, orders, documents and part."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import ladders
from tessera.operators import audit, ledger
from tessera.plans.registry import query
from tessera.sources.scratch import new_path
from tessera.streaming import events as stream

_RAW = """raw AS (SELECT event_id AS seq, ts, event_type AS phase, 'user' || (user_id % 7) AS provider, event_type = 'error' AS retry,
  CASE WHEN event_id % 3 = 0 THEN '' ELSE 'm' || (event_id % 11) END AS message, CAST(event_id % 5 AS INTEGER) AS status FROM events)"""


def _raw(t):
    return t("events").select(
        F.col("event_id").alias("seq"), "ts", F.col("event_type").alias("phase"), F.concat(F.lit("user"), F.col("user_id") % 7).alias("provider"), (F.col("event_type") == "error").alias("retry"),
        F.when(F.col("event_id") % 3 == 0, "").otherwise(F.concat(F.lit("m"), F.col("event_id") % 11)).alias("message"), (F.col("event_id") % 5).cast("int").alias("status"),
    )


@query(f"""WITH {_RAW} SELECT phase, provider, count(*) AS count, arg_min(ts, seq) AS first_ts, arg_max(ts, seq) AS last_ts, count(*) FILTER (WHERE retry) AS retryable,
coalesce(arg_max(message, seq) FILTER (WHERE message <> ''), '') AS message, arg_max(status, seq) FILTER (WHERE message <> '') AS http_status FROM raw GROUP BY ALL""")
def ledger_summary(t):
    return ledger.summary(_raw(t), ["phase", "provider"], "ts", "seq", F.col("retry"), "message", "status")


@query("""SELECT event_type, count(*) AS n, min(ts) AS first_ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 3 DAY GROUP BY ALL""")
def ledger_tail_window(t):
    return ledger.tail(t("events"), "ts", 3 * 86_400).groupBy("event_type").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"))


#: name, kind, scope and message of a tail's rows, and the verdict on it.
_TAILS = [
    ("waf", "auth", "route", "<html> Cloudflare", "all_providers_403_waf"), ("auth", "auth", "route", "denied", "all_providers_auth_rejected"),
    ("spent", "rate_limit", "route", "all keys in use", "all_keys_exhausted"), ("busy", "rate_limit", "route", "busy", "all_providers_rate_limited"),
    ("wire", "transport", "route", "timed out", "all_providers_transport_error"), ("skip", "other", "batch", "no healthy route for m", "no_route_for_model"),
    ("odd", "bad_json", "batch", "so", "unclassified_ai_outage"), ("none", None, None, None, "unclassified_ai_outage"),
]
_NAMED = ", ".join(f"('{name}', {kind is not None}, '{verdict}')" for name, kind, _, _, verdict in _TAILS)


@query(f"""WITH r AS (SELECT count(*) AS n FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY AND event_type = 'error'), v(tail, filled, reason) AS (VALUES {_NAMED})
SELECT tail, CASE WHEN filled AND n > 0 THEN reason ELSE 'unclassified_ai_outage' END AS reason, CASE WHEN filled THEN n ELSE 0 END AS rows FROM v, r
UNION ALL SELECT 'no_keys', 'no_keys_configured', n FROM r""")
def outage_reason(t):
    recent = ledger.tail(t("events"), "ts", 86_400).filter("event_type = 'error'")
    out = []
    for name, kind, scope, message, _ in _TAILS:
        rows = recent.select(F.lit(kind).cast("string").alias("kind"), F.lit(scope).cast("string").alias("scope"), F.lit(message).cast("string").alias("message"))
        out.append(ledger.outage(rows if kind else rows.limit(0)).select(F.lit(name).alias("tail"), "reason", "rows"))
    keyless = recent.select(F.lit("auth").alias("kind"), F.lit("route").alias("scope"), F.lit("").alias("message"))
    out.append(ledger.outage(keyless, keys_configured=False).select(F.lit("no_keys").alias("tail"), "reason", "rows"))
    return reduce(DataFrame.unionByName, out)


@query("""SELECT event_id, CASE WHEN event_id % 6 = 0 THEN 'auth' WHEN event_id % 6 = 1 THEN 'rate_limit' WHEN event_id % 6 = 2 THEN 'rate_limit' WHEN event_id % 6 = 3 THEN 'bad_json' WHEN event_id % 6 = 4 THEN 'transport' ELSE 'http' END AS kind,
  event_id % 6 NOT IN (0) AS retryable FROM events""")
def failure_classify(t):
    k = F.col("event_id") % 6
    status = F.when(k == 0, 401).when(k == 1, 429).when(k == 5, 500)
    message = F.when(k == 2, "Too many requests").when(k == 3, "invalid JSON in reply").when(k == 4, "read timed out").otherwise("x")
    kind = ladders.failure_kind(status, message)
    return t("events").select("event_id", kind.alias("kind"), ladders.retryable(kind, status, message).alias("retryable"))


@query("""WITH a AS (SELECT user_id, event_id, event_type = 'error' AS failed, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS i, ts FROM events),
b AS (SELECT *, CASE WHEN failed THEN sum(failed::INTEGER) OVER (PARTITION BY user_id, i ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) ELSE 0 END AS run FROM a)
SELECT user_id, CAST(max(run) AS BIGINT) AS longest, bool_or(run >= 2) AS halted FROM b GROUP BY ALL""")
def consecutive_failures(t):
    runs = ledger.failure_runs(t("events").select("user_id", "event_id", "ts", "event_type"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", 2)
    return runs.groupBy("user_id").agg(F.max("run").alias("longest"), F.max("halted").alias("halted"))


@query("WITH e AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS trips FROM events GROUP BY ALL) SELECT user_id, CASE WHEN trips < 1 THEN 0.0::DOUBLE ELSE least(3600.0::DOUBLE, 60.0::DOUBLE * pow(2, trips - 1)) END AS cooldown FROM e")
def breaker_cooldown(t):
    e = t("events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("trips"))
    return e.select("user_id", ledger.cooldown(F.col("trips"), 60.0, 3600.0).alias("cooldown"))


@query("""WITH p AS (SELECT 'index' AS manifest, o_orderkey AS path FROM orders WHERE o_orderstatus <> 'O'), f AS (SELECT o_orderkey AS path FROM orders WHERE o_orderstatus <> 'F')
SELECT count(*) AS files, CAST(sum(path) AS BIGINT) AS total FROM (SELECT path FROM p UNION SELECT path FROM f)""")
def manifest_upsert(t):
    from tessera.operators.state import merged_paths

    o = t("orders").withColumn("path", F.col("o_orderkey"))
    m = merged_paths(o.filter("o_orderstatus <> 'O'").select("path"), o.filter("o_orderstatus <> 'F'").select("path"))
    return m.agg(F.count("*").alias("files"), F.sum("path").alias("total"))


@query("""SELECT 'in_several_places' AS rule, CAST(l_partkey AS VARCHAR) || '|' || CAST(l_suppkey AS VARCHAR) AS place, CAST(count(DISTINCT l_orderkey) AS VARCHAR) AS detail FROM lineitem GROUP BY l_partkey, l_suppkey HAVING count(DISTINCT l_orderkey) > 1""")
def audit_duplicate_identity(t):
    return audit.in_several_places(t("lineitem"), ["l_partkey", "l_suppkey"], "l_orderkey")


@query("""SELECT 'repeated_in_place' AS rule, CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_partkey AS VARCHAR) AS place, CAST(count(*) AS VARCHAR) AS detail FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1""")
def audit_uniqueness(t):
    return audit.repeated_in_place(t("lineitem"), ["l_partkey"], "l_orderkey")


@query("""SELECT 'reused_id' AS rule, CAST(md5(text) AS VARCHAR) AS place, CAST(count(DISTINCT doc_id) AS VARCHAR) AS detail FROM documents GROUP BY md5(text) HAVING count(DISTINCT doc_id) > 1""")
def audit_reused_text(t):
    return audit.reused_ids(t("documents").select(F.md5("text").alias("h"), "doc_id"), "h", ["doc_id"])


@query("SELECT 'undeclared' AS rule, CAST(o_orderkey AS VARCHAR) AS place, CAST(c_custkey AS VARCHAR) AS detail FROM (SELECT o_orderkey, o_custkey + CASE WHEN o_orderkey % 97 = 0 THEN 1000000 ELSE 0 END AS c_custkey FROM orders) o WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)")
def audit_orphans(t):
    o = t("orders").select("o_orderkey", (F.col("o_custkey") + F.when(F.col("o_orderkey") % 97 == 0, 1_000_000).otherwise(0)).alias("c_custkey"))
    return audit.undeclared(o, t("customer").select("c_custkey"), ["c_custkey"], F.col("o_orderkey"))


@query("""WITH n AS (SELECT c_nationkey AS p, CASE WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS name FROM customer)
SELECT 'differs_by_case' AS rule, CAST(p AS VARCHAR) || '|' || min(name) AS place, CAST(count(DISTINCT name) AS VARCHAR) AS detail FROM n GROUP BY p, lower(name) HAVING count(DISTINCT name) > 1""")
def audit_case_only(t):
    n = t("customer").select(F.col("c_nationkey").alias("p"), F.when(F.col("c_custkey") % 2 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")).alias("name"))
    return audit.differs_by_case(n, ["p"], "name")


@query("""SELECT 'nested_twice' AS rule, p_brand || '/' || a || '/' || b AS place, 'an element equals its parent' AS detail FROM (SELECT p_brand, split_part(p_type, ' ', 1) AS a, CASE WHEN p_size % 10 = 0 THEN split_part(p_type, ' ', 1) ELSE split_part(p_type, ' ', 2) END AS b FROM part) WHERE a = b OR p_brand = a""")
def audit_adjacency(t):
    w = F.split("p_type", " ")
    path = F.array(F.col("p_brand"), w[0], F.when(F.col("p_size") % 10 == 0, w[0]).otherwise(F.coalesce(F.get(w, F.lit(1)), F.lit(""))))
    return audit.nested_twice(t("part").select(path.alias("path")))


@query("""WITH c AS (SELECT s_nationkey, count(*) AS n FROM supplier WHERE s_acctbal > 8000 GROUP BY ALL)
SELECT 'empty_mark' AS rule, CAST(n_nationkey AS VARCHAR) AS place, CAST(coalesce(n, 0) AS VARCHAR) AS detail FROM nation LEFT JOIN c ON s_nationkey = n_nationkey WHERE (coalesce(n, 0) = 0) <> (n_nationkey % 2 = 0)""")
def audit_empty_leaves(t):
    places = t("nation").select("n_nationkey", (F.col("n_nationkey") % 2 == 0).alias("marked"))
    rows = t("supplier").filter("s_acctbal > 8000").select(F.col("s_nationkey").alias("n_nationkey"))
    return audit.empty_and_marked(places, rows, "n_nationkey", "marked")


@query("""SELECT 'wrong_owner' AS rule, CAST(p_partkey AS VARCHAR) AS place, p_brand || '|' || p_name AS detail FROM part WHERE p_name IS NOT NULL AND (p_brand, lower(p_name)) NOT IN (SELECT p_brand, lower(p_name) FROM part WHERE p_size <= 10)""")
def audit_ownership(t):
    declared = t("part").filter("p_size <= 10").select(F.col("p_brand").alias("subject"), F.lower("p_name").alias("key"))
    return audit.wrong_owner(t("part"), declared, "p_brand", "p_name", "p_partkey")


@query("""WITH u AS (SELECT 'repeated_in_place' AS rule, count(*) AS violations FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1)
UNION ALL SELECT 'undeclared', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) SELECT * FROM u""")
def audit_report(t):
    found = audit.report(audit.repeated_in_place(t("lineitem"), ["l_partkey"], "l_orderkey"), audit.undeclared(t("orders"), t("customer").select(F.col("c_custkey").alias("o_custkey")), ["o_custkey"], F.col("o_orderkey")))
    return audit.summary(found, ["repeated_in_place", "undeclared"]).select("rule", "violations")


@query("SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS start, event_type, count(*) AS events, round(sum(value), 4) AS value FROM events GROUP BY ALL")
def tumbling_windows(t):
    e = t("events").groupBy(F.window(F.col("ts").cast("timestamp"), "1 day").alias("w"), "event_type").agg(F.count("*").alias("events"), F.round(F.sum("value"), 4).alias("value"))
    return e.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "events", "value")


@query("""WITH a AS (SELECT user_id, ts, value, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events), b AS (SELECT *, sum(CASE WHEN p IS NULL OR ts >= p + INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM a)
SELECT user_id, min(ts) AS start, count(*) AS events FROM b GROUP BY user_id, s""")
def session_windows(t):
    e = t("events").withColumn("at", F.col("ts").cast("timestamp")).groupBy("user_id", F.session_window("at", "6 hours").alias("w")).agg(F.count("*").alias("events"))
    return e.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), "events")


@query("""WITH RECURSIVE o AS (SELECT user_id, event_id, epoch_us(ts) / 1000000.0::DOUBLE AS sec, event_type = 'error' AS bad, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k
  FROM events WHERE ts < (SELECT max(ts) FROM events)),
f AS (SELECT user_id, 0 AS k, 0 AS run, 0 AS trips, 0.0::DOUBLE AS until FROM o WHERE k = 1
  UNION ALL SELECT o.user_id, CAST(o.k AS INTEGER), CASE WHEN NOT bad OR (run + 1 >= 2 AND sec >= until) THEN 0 ELSE run + 1 END,
    CASE WHEN NOT bad THEN 0 WHEN run + 1 >= 2 AND sec >= until THEN trips + 1 ELSE trips END,
    CASE WHEN bad AND run + 1 >= 2 AND sec >= until THEN sec + least(7200.0, 600.0 * pow(2, trips)) ELSE until END FROM f JOIN o ON o.user_id = f.user_id AND o.k = f.k + 1)
SELECT user_id, CAST(k AS BIGINT) AS events, trips, run, round(until, 3) AS open_until FROM f WHERE k > 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY k DESC) = 1""")
def keyed_breaker_stream(t):
    got = stream.replayed_breaker(t("events").select("event_id", "ts", "user_id", "event_type"), new_path(t.spark, "breaker"), base=600.0, most=7200.0, limit=2)
    return got.select("user_id", "events", "trips", "run", F.round("open_until", 3).alias("open_until"))
