"""Quality rules: thresholds from mergeable quantile sketches of each language and source. DataFrame functions only.

The sketch is a log-linear histogram of an integer: values under 64 have a bucket each, every octave above has 32, so a
quantile is off by 1/32 of itself at most. Sketches merge by adding counts, in any order and with the same result, so
partial ones are built before the shuffle, and one of a language is the sum of those of its sources.

A limit stands above an upper quantile of the group by a multiple of that quantile's distance from the median. A group's
quantiles are shrunk to its language's, and a language's to those of all, as if SHRINK more documents were there: a group
of few documents is judged nearly by its language, one of many by itself, with no step between.

Results for odd input: a null or empty text has no word and fails the base rules. Null and empty lang or source are one
group. A null doc_id is a document like others; repeated rows each get their (equal) verdict. Very long texts are measured
whole, in arrays of the words and their hashes, of one row at a time. An empty table gives an empty result. Other columns
are not touched, whatever their names; columns made here start with two underscores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import BROADCAST_BYTES, WHITE, sized, split_join, stage, unstage, words

SYMBOLS = "#*$%&|<>"
#: metric: (upper quantile in thousandths, distances from the median that a value may lie above it, least distance, whether
#: low values are judged too, by the mirrored quantile). The least distance stands in where a group's values hardly differ.
RULES = {
    "sym": (900, 2, 50, False),  # symbols per 1000 words
    "dup": (990, 1, 50, False),  # lines equal to an earlier one, per 1000
    "rep": (990, 1, 50, False),  # words in repeated windows, per 1000
    "mean": (900, 3, 10, True),  # 100 times the characters per word
}
#: Documents that a group's quantiles are shrunk by.
SHRINK = 200
QUANTILES = sorted({500, *(r[0] for r in RULES.values()), *(1000 - r[0] for r in RULES.values() if r[3])})
WINDOW = 8


def with_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns given and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and __lines, all long."""
    t = F.coalesce(F.col(text), F.lit(""))
    blank = WHITE.replace("\n", "")
    out = docs.withColumn("__w", words(F.col(text))).withColumn(
        "__l", F.filter(F.split(t, "\n"), lambda x: F.translate(x, blank, "") != "")
    )
    # each word is hashed once, a window is the hash of its words' hashes
    out = out.withColumn("__v", F.transform("__w", lambda w: F.xxhash64(w)))
    window = ", ".join(f"__v[i + {k}]" for k in range(WINDOW))
    out = out.withColumn(
        "__h",
        F.when(F.size("__v") > WINDOW, F.expr(f"transform(sequence(0, size(__v) - {WINDOW}), i -> xxhash64({window}))")).otherwise(F.expr("cast(array() as array<bigint>)")),
    )
    out = out.withColumns(
        {
            "n_words": F.size("__w").cast("long"),
            "word_chars": F.length(F.translate(t, WHITE, "")).cast("long"),
            "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
            "__lines": F.size("__l").cast("long"),
            "__s": F.when(
                F.size(F.array_distinct("__h")) < F.size("__h"),
                F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            ),
        }
    ).drop("__w", "__l", "__v", "__h")
    # a window is repeated if it equals a neighbour among the sorted; its words count from where the last one ended
    out = out.withColumn(
        "__p",
        F.expr(
            "sort_array(transform(filter(__s, (e, k) -> (k > 0 and __s[greatest(k - 1, 0)].h = e.h)"
            " or (k < size(__s) - 1 and __s[least(k + 1, size(__s) - 1)].h = e.h)), e -> e.i))"
        ),
    )
    covered = (
        f"aggregate(__p, struct(0L as n, 0 as upto), (a, p) -> struct(a.n + (p + {WINDOW} - greatest(a.upto, p)) as n,"
        f" p + {WINDOW} as upto), a -> a.n)"
    )
    return out.withColumn("n_repeat_words", F.coalesce(F.expr(covered), F.lit(0).cast("long"))).drop("__s", "__p")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def bucket(value: Column) -> Column:
    shift = F.length(F.bin(value)) - 6
    return F.when(value < 64, value).otherwise(shift * 32 + F.call_function("shiftright", value, shift.cast("int"))).cast("int")


def bucket_floor(b: Column) -> Column:
    shift = F.floor(b / 32).cast("int") - 1
    return F.when(b < 64, b.cast("long")).otherwise(F.call_function("shiftleft", (b - shift * 32).cast("long"), shift))


def _ratio(a: str, b: str, scale: int) -> Column:
    return F.expr(f"({scale} * {a}) div greatest({b}, 1)")


METRIC = {
    "sym": lambda: _ratio("n_symbols", "n_words", 1000),
    "dup": lambda: _ratio("n_dup_lines", "__lines", 1000),
    "rep": lambda: _ratio("n_repeat_words", "n_words", 1000),
    "mean": lambda: _ratio("word_chars", "n_words", 100),
}


def sketches(measured: DataFrame) -> DataFrame:
    """Rows (__lang, __source, m, b, n): the histograms of each group, of documents that pass the base rules."""
    pairs = F.array(*(F.struct(F.lit(k).alias("m"), bucket(make()).alias("b")) for k, make in METRIC.items()))
    long = measured.filter(~base_failed()).select("__lang", "__source", F.explode(pairs).alias("p"))
    return long.groupBy("__lang", "__source", F.col("p.m").alias("m"), F.col("p.b").alias("b")).agg(F.count("*").alias("n"))


def quantiles(sk: DataFrame, *keys: str) -> DataFrame:
    """Of the merged sketches of keys and m: docs, and q500 and so on for QUANTILES."""
    h = sk.groupBy(*keys, "m", "b").agg(F.sum("n").alias("n"))
    h = h.groupBy(*keys, "m").agg(F.sort_array(F.collect_list(F.struct("b", "n"))).alias("h"), F.sum("n").alias("docs"))
    at = {
        q: f"aggregate(h, struct(0L as c, cast(null as int) as b), (a, x) -> struct(a.c + x.n as c,"
        f" case when a.b is null and (a.c + x.n) * 1000 >= docs * {q} then x.b else a.b end as b), a -> a.b)"
        for q in QUANTILES
    }
    return h.select(*keys, "m", "docs", *(bucket_floor(F.expr(e)).alias(f"q{q}") for q, e in at.items()))


def _shrunk(near: DataFrame, wide: DataFrame, keys: list[str], shrink: int) -> DataFrame:
    """near with its quantiles moved to those of wide, as by `shrink` documents."""
    wide = wide.select(*keys, *(F.col(f"q{q}").alias(f"w{q}") for q in QUANTILES))
    both = near.join(sized(wide, 100), keys)
    return both.withColumns({f"q{q}": F.expr(f"(docs * q{q} + {shrink} * w{q}) div (docs + {shrink})") for q in QUANTILES}).drop(*(f"w{q}" for q in QUANTILES))


def thresholds(sk: DataFrame, shrink: int = SHRINK) -> DataFrame:
    """For each group __lang, __source: docs, and lo_<m> and hi_<m> (null lo: not judged). sk is staged."""
    whole = stage(quantiles(sk), "quantiles")
    langs = stage(_shrunk(quantiles(sk, "__lang"), whole, ["m"], shrink), "quantiles")
    near = _shrunk(quantiles(sk, "__lang", "__source"), langs, ["__lang", "m"], shrink)
    aggs = [F.max("docs").alias("docs")]
    for m, (q, k, least, low) in RULES.items():
        this = F.col("m") == m
        up = k * F.greatest(F.col(f"q{q}") - F.col("q500"), F.lit(least))
        aggs.append(F.max(F.when(this, F.col(f"q{q}") + up)).alias(f"__hi_{m}"))
        if low:
            down = k * F.greatest(F.col("q500") - F.col(f"q{1000 - q}"), F.lit(least))
            aggs.append(F.max(F.when(this, F.col(f"q{1000 - q}") - down)).alias(f"__lo_{m}"))
        else:
            aggs.append(F.lit(None).cast("long").alias(f"__lo_{m}"))
    return near.groupBy("__lang", "__source").agg(*aggs)


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """measured (staged) with base_failed and kept. limits: a staged table; joined by broadcast if its counted size allows,
    else by split_join, as one group can hold any share of the documents."""
    keys = ["__lang", "__source"]
    if limits.count() * 160 <= BROADCAST_BYTES:
        joined = measured.join(F.broadcast(limits.drop("docs")), keys, "left")
    else:
        joined = split_join(measured, limits, keys, "docs", measured.count(), "left")
    odd = F.lit(False)
    for m, make in METRIC.items():
        # the value's bucket is compared, as the limit comes from buckets
        v = bucket_floor(bucket(make()))
        odd = odd | F.coalesce(v > F.col(f"__hi_{m}"), F.lit(False)) | F.coalesce(v < F.col(f"__lo_{m}"), F.lit(False))
    joined = joined.withColumn("base_failed", base_failed())
    return joined.withColumn("kept", ~(F.col("base_failed") | odd)).drop(*(f"__{x}_{m}" for m in RULES for x in ("lo", "hi")))


def measure(docs: DataFrame, *carry: str, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The narrow staged table of metrics: one pass over the texts, which are not kept."""
    df = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("__text"),
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("__lang"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("__source"),
        F.xxhash64(text, lang, source).alias("__rid"),
        *carry,
    )
    return stage(with_metrics(df, "__text").drop("__text"), "metrics")


def verdicts(docs: DataFrame, **names: str) -> DataFrame:
    """doc_id, __rid (hash of text, lang and source), the metrics, base_failed and kept, for every row of docs."""
    measured = measure(docs, **names)
    # as many tasks as there are groups for: adaptive execution joins small parts
    counted = stage(sketches(measured), "sketches")
    limits = stage(thresholds(counted), "limits")
    unstage(counted)
    return judge(measured, limits)


def quality_filter(docs: DataFrame) -> DataFrame:
    """The rows of docs that are kept, with the columns they had."""
    judged = verdicts(docs)
    gone = stage(judged.filter(~F.col("kept")).select(F.col("doc_id").alias("__id"), "__rid").distinct(), "rejected")
    keyed = docs.withColumn("__rid", F.xxhash64("text", "lang", "source"))
    small = sized(gone, 32).withColumnRenamed("__rid", "__gone")
    cond = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__rid") == F.col("__gone"))
    return keyed.join(small, cond, "left_anti").drop("__rid")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return verdicts(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


QUERIES = {"op10_quality": op10_quality}


def _sql() -> str:
    """The same thresholds and verdicts in DuckDB's SQL, from the constants above."""
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    value = {"sym": "(1000 * n_symbols) // greatest(n_words, 1)", "dup": "(1000 * n_dup_lines) // greatest(lines, 1)",
             "rep": "(1000 * n_repeat_words) // greatest(n_words, 1)", "mean": "(100 * word_chars) // greatest(n_words, 1)"}
    bucketed = lambda v: f"CASE WHEN {v} < 64 THEN {v} ELSE (length(bin({v})) - 6) * 32 + ({v} >> (length(bin({v})) - 6)) END"
    floor_ = lambda b: f"CASE WHEN {b} < 64 THEN {b} ELSE ({b} - ({b} // 32 - 1) * 32) << ({b} // 32 - 1) END"
    per = lambda f: "CASE m " + " ".join(f"WHEN '{m}' THEN {f(m, *r)}" for m, r in RULES.items()) + " END"
    hi = per(lambda m, q, k, least, low: f"q{q} + {k} * greatest(q{q} - q500, {least})")
    lo = per(lambda m, q, k, least, low: f"q{1000 - q} - {k} * greatest(q500 - q{1000 - q}, {least})" if low else "CAST(NULL AS BIGINT)")
    level = lambda name, keys: f"""
{name}_h AS (SELECT {keys}m, b, sum(n) AS n FROM sk GROUP BY ALL),
{name}_c AS (SELECT *, sum(n) OVER (PARTITION BY {keys}m ORDER BY b) AS c, sum(n) OVER (PARTITION BY {keys}m) AS docs FROM {name}_h),
{name}_b AS (SELECT {keys}m, max(docs) AS docs, {", ".join(f"min(b) FILTER (WHERE c * 1000 >= docs * {q}) AS b{q}" for q in QUANTILES)} FROM {name}_c GROUP BY ALL),
{name}_q AS (SELECT {keys}m, docs, {", ".join(f"{floor_(f'b{q}')} AS q{q}" for q in QUANTILES)} FROM {name}_b),"""  # noqa: E731
    shrunk = lambda name, wide, keys, using: f"""
{name} AS (SELECT {keys}m, {", ".join(f"(n.docs * n.q{q} + {SHRINK} * w.q{q}) // (n.docs + {SHRINK}) AS q{q}" for q in QUANTILES)}
  FROM {name}_q n JOIN {wide} w USING ({using})),"""  # noqa: E731
    return f"""
WITH w AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t,
         list_filter(string_split(translate(coalesce(text, ''), {white}, '      '), ' '), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, {white}) <> '') AS l FROM documents),
win AS (SELECT id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM w WHERE len(w) >= {WINDOW}),
x AS (SELECT id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s FROM win),
y AS (SELECT id, i, count(*) OVER (PARTITION BY id, s) AS n FROM x),
z AS (SELECT id, count(DISTINCT p) AS r FROM (SELECT id, unnest(range(i, i + {WINDOW})) AS p FROM y WHERE n > 1) GROUP BY id),
b AS (
  SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, len(l) AS lines, CAST(coalesce(r, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN z USING (id)),
v AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  {", ".join(f"{e} AS v_{m}" for m, e in value.items())} FROM b),
u AS (SELECT *, {", ".join(f"{bucketed(f'v_{m}')} AS b_{m}" for m in value)} FROM v),
sk AS ({" UNION ALL ".join(f"SELECT lang, source, '{m}' AS m, b_{m} AS b, count(*) AS n FROM u WHERE NOT base_failed GROUP BY ALL" for m in value)}),
{level('g', '')}{level('l', 'lang, ')}{level('s', 'lang, source, ')}{shrunk('l', 'g_q', 'lang, ', 'm')}{shrunk('s', 'l', 'lang, source, ', 'lang, m')}
t AS (SELECT lang, source, m, {hi} AS hi, {lo} AS lo FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR {" OR ".join(f"coalesce({floor_(f'b_{m}')} > t_{m}.hi, false) OR coalesce({floor_(f'b_{m}')} < t_{m}.lo, false)" for m in value)}) AS kept
FROM u {" ".join(f"LEFT JOIN t t_{m} ON t_{m}.m = '{m}' AND t_{m}.lang = u.lang AND t_{m}.source = u.source" for m in value)}"""


SQL = {"op10_quality": _sql()}
