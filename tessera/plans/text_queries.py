"""Scalar functions and extraction over part, documents, pages, events, benchmark."""

from pyspark.sql import functions as F

from tessera.functions import ladders, text
from tessera.plans.registry import query

_WS = "[\\s]+"


@query("SELECT doc_id, md5(trim(regexp_replace(text, '[ \\t\\n\\x0b\\x0c\\r]+', ' ', 'g'))) AS h FROM documents")
def norm_space(t):
    return t("documents").select("doc_id", F.md5(text.norm_space(F.col("text"))).alias("h"))


_KEY = "trim(regexp_replace(translate(replace(lower(trim({0})), '&', ' and '), '/-.', '   '), ' +', ' ', 'g'))"


@query(f"SELECT p_partkey, {_KEY.format('p_type')} AS key FROM part")
def norm_key(t):
    return t("part").select("p_partkey", text.norm_key(F.col("p_type")).alias("key"))


@query("SELECT p_partkey, trim(regexp_replace(lower(p_brand || ' & ' || p_type), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM (SELECT p_partkey, replace(p_brand, '&', ' and ') AS p_brand, replace(p_type, '&', ' and ') AS p_type FROM part)".replace("' & '", "' and '"))
def slugify(t):
    return t("part").select("p_partkey", text.slugify(F.concat_ws(" & ", "p_brand", "p_type")).alias("slug"))


@query("""SELECT doc_id, md5(replace(strip_accents(lower(trim(regexp_replace(text, '[ \\t\\n\\x0b\\x0c\\r]+', ' ', 'g')))), 'ß', 'ss')) AS key FROM documents""")
def fold_key(t):
    return t("documents").select("doc_id", F.md5(text.fold_key(F.col("text"))).alias("key"))


_TOK = "list_filter(string_split_regex(replace(lower(text), '&', ' and '), '[^a-z0-9]+'), lambda x: length(x) >= 3)"


@query(f"SELECT doc_id, CAST(len(t) AS INTEGER) AS n, CAST(len(list_distinct(t)) AS INTEGER) AS terms FROM (SELECT doc_id, {_TOK} AS t FROM documents)")
def token_counts(t):
    toks = text.key_tokens(F.col("text"), 3)
    return t("documents").select("doc_id", toks.alias("t")).select("doc_id", F.size("t").alias("n"), F.size(F.array_distinct("t")).alias("terms"))


@query(f"SELECT p_partkey, contains(' ' || {_KEY.format('p_name')} || ' ', ' ' || {_KEY.format('p_type')} || ' ') AS whole, contains(' ' || {_KEY.format('p_name')} || ' ', ' ' || split_part({_KEY.format('p_name')}, ' ', 1) || ' ') AS first FROM part")
def contains_phrase(t):
    name, kind = text.norm_key(F.col("p_name")), text.norm_key(F.col("p_type"))
    return t("part").select("p_partkey", text.contains_phrase(name, kind).alias("whole"), text.contains_phrase(name, F.split(name, " ")[0]).alias("first"))


@query("""SELECT doc_id, coalesce(TRY_CAST(source AS INTEGER), -1) AS a, coalesce(TRY_CAST(substr(source, 4) AS INTEGER), -1) AS b,
CASE WHEN n_chars = 0 THEN 0.0::DOUBLE ELSE round(100.0::DOUBLE * len(lang) / n_chars, 4) END AS pct FROM documents""")
def safe_casts(t):
    return t("documents").select(
        "doc_id", text.safe_int(F.col("source"), -1).alias("a"), text.safe_int(F.substring("source", 4, 9), -1).alias("b"),
        F.round(text.percent(F.length("lang"), F.col("n_chars")), 4).alias("pct"),
    )


@query("SELECT page_id, CAST(len(list_distinct(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1))) AS INTEGER) AS links, array_to_string(list_sort(list_distinct(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1))), ' ') AS found FROM pages")
def extract_links(t):
    links = F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)))
    return t("pages").select("page_id", links.alias("l")).select("page_id", F.size("l").alias("links"), F.array_join(F.array_sort("l"), " ").alias("found"))


@query("SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_matches(url, '[?&]') AS has_query FROM pages")
def page_hosts(t):
    return t("pages").select("page_id", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), F.col("url").rlike("[?&]").alias("has_query"))


@query("""SELECT o_orderkey, CAST(year(o_orderdate) + 10 AS INTEGER) AS year, 'folder:' || 'exam ' || (year(o_orderdate) + 10) AS source, (year(o_orderdate) + 10) || strftime(o_orderdate, '-%m-%d') AS iso FROM orders""")
def year_and_date_from_text(t):
    d = F.col("o_orderdate").cast("date")
    path = F.concat(F.lit("root/exam "), F.year(d) + 10, F.lit("/paper.json"))
    title = F.concat(F.lit("Paper held on "), F.date_format(d, "d MMM "), F.year(d) + 10)
    y, h = text.year_of_path(path, title), text.held_on(title)
    return t("orders").select("o_orderkey", y.year.alias("year"), y.source.alias("source"), h.iso.alias("iso"))


@query("""SELECT doc_id, md5(regexp_replace(trim(regexp_replace(text, '[ \\t\\n\\x0b\\x0c\\r]+', ' ', 'g')), '[A-Za-z0-9_.]+@[A-Za-z0-9.]+', '<mail>', 'g')) AS h,
  regexp_matches(text, '[A-Za-z0-9_.]+@[A-Za-z0-9.]+') AS hit FROM documents""")
def redact(t):
    # the SQL's pattern, from where a name begins or the last match ended and without going back: each character is met once
    name, host = "[A-Za-z0-9_.]", "[A-Za-z0-9.]"
    mail = (rf"(?:(?<!{name})|\G){name}++@{host}++", "<mail>", "@")
    hit = F.col("text").contains("@") & F.col("text").rlike(f"{name}@{host}")
    return t("documents").select("doc_id", F.md5(text.mask(F.col("text"), [mail], None)).alias("h"), hit.alias("hit"))


@query("SELECT count(*) FILTER (WHERE regexp_matches(text, '[àâçéèêëîïôûùüÿñæœ]')) AS wide, count(*) FILTER (WHERE regexp_matches(text, '[äöüß]')) AS german, count(*) FILTER (WHERE regexp_matches(lang || ' ' || source, '[é]')) AS labels FROM documents")
def script_variants(t):
    wide = "[àâçéèêëîïôûùüÿñæœ]"
    return t("documents").agg(
        F.count_if(text.script_hit([F.col("text")], wide)).alias("wide"), F.count_if(text.script_hit([F.col("text")], "[äöüß]")).alias("german"),
        F.count_if(text.script_hit([F.col("lang"), F.col("source")], "[é]")).alias("labels"),
    )


@query("""SELECT event_id, json_extract_string(props, '$.' || json_keys(props)[1]) AS first_value, CAST(len(json_keys(props)) AS INTEGER) AS keys FROM events WHERE props IS NOT NULL AND json_valid(props)""")
def tolerant_json_extract(t):
    wrapped = F.concat(F.lit("Here it is:\n```json\n"), F.col("props"), F.lit("\n```\nthanks"))
    e = t("events").filter(F.col("props").isNotNull()).select("event_id", ladders.json_text(wrapped).alias("j")).filter(F.col("j").isNotNull())
    m = F.from_json("j", "map<string,string>")
    return e.select("event_id", F.element_at(F.map_values(m), 1).alias("first_value"), F.size(F.map_keys(m)).alias("keys"))


@query("""SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)license') THEN 'license' WHEN regexp_matches(text, '[0-9]{3}-[0-9]{4}') THEN 'phone' WHEN regexp_matches(text, '@') THEN 'mail'
  WHEN regexp_matches(text, '[#*$%&|<>]') THEN 'symbols' END AS kind FROM documents""")
def ordered_regex_classify(t):
    rules = [("license", "license"), ("[0-9]{3}-[0-9]{4}", "phone"), ("@", "mail"), ("[#*$%&|<>]", "symbols")]
    return t("documents").select("doc_id", ladders.by_pattern(F.col("text"), [(n, p) for p, n in rules]).alias("kind"))


@query("""SELECT p_partkey, CASE split_part(lower(p_type), ' ', 1) WHEN 'standard' THEN 'plain' WHEN 'promo' THEN 'sale' WHEN 'economy' THEN 'plain' END AS kind FROM part""")
def label_table_classify(t):
    pieces = F.replace(F.col("p_type"), F.lit(" "), F.lit(", "))
    return t("part").select("p_partkey", ladders.by_piece([pieces], {"standard": "plain", "promo": "sale", "economy": "plain"}).alias("kind"))


@query("""SELECT p_partkey, 3 AS n, p_brand AS first, 'a (' || p_name || ', x (y, z)), b' AS second_raw FROM part""".replace("'a (' || p_name || ', x (y, z)), b' AS second_raw", "'a (' || trim(p_name) || ', x (y, z))' AS second"))
def multi_label_split(t):
    labels = text.split_labels(F.concat(F.col("p_brand"), F.lit(", a ("), F.trim("p_name"), F.lit(", x (y, z)),, b")))
    return t("part").select("p_partkey", labels.alias("l")).select("p_partkey", F.size("l").alias("n"), F.col("l")[0].alias("first"), F.col("l")[1].alias("second"))


@query("""SELECT doc_id, CAST(len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) AS INTEGER) AS lines,
  split_part(text, chr(10), 1) = text AS single FROM documents""")
def split_prompt_lines(t):
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    return t("documents").select("doc_id", F.size(lines).alias("lines"), (F.split("text", "\n")[0] == F.col("text")).alias("single"))


@query("""SELECT item_id, CAST(len(list_filter(string_split_regex(trim(regexp_replace(text, '\\s+', ' ', 'g')), '[.!?] '), lambda x: x <> '')) AS INTEGER) AS sentences,
  CAST(len(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')) AS INTEGER) AS words FROM benchmark""")
def sentence_split(t):
    return t("benchmark").select("item_id", F.size(text.sentences(F.col("text"))).alias("sentences"), text.word_count(F.col("text")).alias("words"))


@query("""SELECT p_partkey, length(v) <= 60 AND len(string_split(v, ' ')) <= 9 AND NOT (ends_with(v, '.') AND len(string_split(v, ' ')) > 5) AS name_like, v <> '' AND ends_with(v, '.') AS sentence
FROM (SELECT p_partkey, trim(p_name) || CASE WHEN p_size % 2 = 0 THEN ' of this and that, in a sentence.' ELSE '' END AS v FROM part)""")
def name_predicate(t):
    v = F.concat(F.trim("p_name"), F.when(F.col("p_size") % 2 == 0, " of this and that, in a sentence.").otherwise(""))
    return t("part").select("p_partkey", text.name_like(v).alias("name_like"), v.endswith(".").alias("sentence"))


@query("""SELECT event_id, coalesce(value >= 80, false) OR coalesce(user_id % 2 = 0 AND value >= 75, false) AS accepted FROM (SELECT event_id, user_id, TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'none' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS value FROM events)""")
def confidence_gate(t):
    c = F.when(F.col("event_id") % 7 == 0, "none").otherwise(F.col("value").cast("string"))
    return t("events").select("event_id", ladders.accepted(c, F.col("user_id") % 2 != 0, 80.0, 75.0).alias("accepted"))


@query("SELECT doc_id, text, lang FROM documents WHERE lower(text || ' ' || lang) LIKE '%license%' ORDER BY doc_id LIMIT 15")
def search_substring(t):
    from tessera.sources.files import searched

    return searched(t("documents").select("doc_id", "text", "lang"), "LICENSE", ["text", "lang"], ["doc_id"], 15)


@query("""SELECT 'Item ' || item_id AS title, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS part, item_id FROM benchmark""")
def pointer_projection(t):
    return t("benchmark").select(F.concat(F.lit("Item "), "item_id").alias("title"), text.norm_space(F.col("text")).alias("part"), "item_id")
