"""Rule scoring: document frequencies, rarity, weighted evidence, class signatures, thresholds.

Documents and rules meet on terms (an inverted join), never in a product.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import norm_key
from tessera.operators.phrases import phrases_in
from tessera.operators.rank import numbered
from tessera.sources.scratch import written

#: Weights of a rule's tables, the most that loose terms add, and where evidence is enough.
SIGNAL, TITLE, TOPIC, BODY, PHRASE, HINT_STRONG, HINT_WEAK = 3, 3, 2, 1, 6, 6, 2
LOOSE_MOST, LEAST_SCORE, MARGIN = 4, 4, 1.5
RARITY = ((0.01, 3), (0.04, 2), (0.12, 1))
UNSEEN = 3


def rarity(share: Column) -> Column:
    out = None
    for most, value in RARITY:
        out = F.when(share <= most, value) if out is None else out.when(share <= most, value)
    return out.otherwise(0)


def document_frequency(docs: DataFrame, doc_id: str, terms: Column) -> DataFrame:
    """term, df, share, rarity: in how many documents a term is."""
    n = docs.agg(F.count("*").alias("__n"))
    df = docs.select(F.explode(F.array_distinct(terms)).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    out = df.join(F.broadcast(n)).withColumn("share", F.col("df") / F.col("__n")).drop("__n")
    return out.withColumn("rarity", rarity(F.col("share")))


def phrase_frequency(docs: DataFrame, doc_id: str, text: str, phrases: DataFrame, phrase: str = "phrase") -> DataFrame:
    """key, df: in how many documents a phrase of several words is; one pass of an automaton, with a row for each phrase that
    a document holds."""
    p = phrases.select(norm_key(F.col(phrase)).alias("key")).distinct().filter(F.col("key").contains(" "))
    hit = phrases_in(docs, doc_id, norm_key(F.col(text)), p).groupBy(doc_id, "key").agg(F.lit(1).alias("one"))
    return p.join(hit.groupBy("key").agg(F.count("*").alias("df")), "key", "left").na.fill(0, ["df"])


def rule_terms(rules: DataFrame, number: str = "rule") -> DataFrame:
    """rule, term, weight, loose from array columns title_terms, topic_terms, signal_words, body_terms, example_terms: a
    term has the weight of its strongest table; body and examples are loose where no table names the term."""
    tables = [("signal_words", SIGNAL, False), ("title_terms", TITLE, False), ("topic_terms", TOPIC, False), ("body_terms", BODY, True), ("example_terms", BODY, True)]
    long = None
    for column, weight, loose in tables:
        part = rules.select(F.col(number).alias("rule"), F.explode(column).alias("term")).withColumns({"weight": F.lit(weight), "loose": F.lit(loose)})
        long = part if long is None else long.unionByName(part)
    return long.groupBy("rule", "term").agg(F.max("weight").alias("weight"), F.min("loose").alias("loose"))


def specificity(*arrays: str) -> Column:
    return sum((F.size(a) for a in arrays), F.lit(0))


def score_rules(docs: DataFrame, doc_id: str, terms: DataFrame, weighted: DataFrame, stats: DataFrame, phrases: DataFrame | None = None, hints: DataFrame | None = None) -> DataFrame:
    """doc_id, rule, strong_score, loose_score, phrase_score, hint, score for every pair with a score above 0.

    terms: doc_id, term (distinct). weighted: rule_terms(). stats: term, rarity. phrases: doc_id, rule, rarity of each
    phrase found. hints: doc_id, rule, strong (boolean); a strong one counts without other evidence too.

    Documents and rules meet on terms that give points alone. The terms of over 12 % of the documents give none (RARITY), so
    the hottest keys take no part; what is left in a term is split by adaptive execution where it is skewed.
    """
    rare = weighted.join(stats.select("term", "rarity"), "term", "left").withColumn("points", F.col("weight") * F.coalesce("rarity", F.lit(UNSEEN))).filter("points > 0")
    hit = terms.join(rare, "term").groupBy(doc_id, "rule").agg(
        F.coalesce(F.sum(F.when(~F.col("loose"), F.col("points"))), F.lit(0)).alias("strong_score"),
        F.least(F.lit(LOOSE_MOST), F.coalesce(F.sum(F.when(F.col("loose"), F.col("points"))), F.lit(0))).alias("loose_score"),
    )
    if phrases is not None:
        p = phrases.groupBy(doc_id, "rule").agg((PHRASE * F.sum("rarity")).alias("phrase_score"))
        hit = hit.join(p, [doc_id, "rule"], "full_outer").na.fill(0, ["strong_score", "loose_score", "phrase_score"])
    else:
        hit = hit.withColumn("phrase_score", F.lit(0))
    score = F.col("strong_score") + F.col("loose_score") + F.col("phrase_score")
    if hints is None:
        return hit.withColumn("hint", F.lit(False)).withColumn("score", score).filter("score > 0")
    hit = hit.join(hints.select(doc_id, "rule", F.col("strong").alias("__s")), [doc_id, "rule"], "full_outer").na.fill(0, ["strong_score", "loose_score", "phrase_score"])
    bonus = F.when(F.col("__s"), HINT_STRONG).when(~F.col("__s") & (score > 0), HINT_WEAK).otherwise(0)
    out = hit.withColumn("hint", F.coalesce(F.col("__s").isNotNull() & (bonus > 0), F.lit(False))).withColumn("score", score + bonus)
    return out.drop("__s").filter("score > 0")


def decide(scored: DataFrame, doc_id: str, specific: DataFrame, least: float = LEAST_SCORE, margin: float = MARGIN) -> DataFrame:
    """doc_id, rule, score, runner_up, outcome: matched, ambiguous (the runner-up is within the margin) or weak (no strong
    evidence: phrases do not count for it). Ties: fewer terms, then the smaller number. specific: rule, terms."""
    w = Window.partitionBy(doc_id).orderBy(F.desc("score"), "terms", "rule")
    able = scored.filter(F.col("score") >= least).join(F.broadcast(specific), "rule")
    best = able.withColumns({"__r": F.row_number().over(w), "runner_up": F.lead("score").over(w)}).filter("__r = 1")
    outcome = F.when(F.col("score") < F.col("runner_up") * margin, "ambiguous").when((F.col("strong_score") != 0) | F.col("hint"), "matched").otherwise("weak")
    return best.select(doc_id, "rule", "score", "runner_up", outcome.alias("outcome"))


def shortlist(scored: DataFrame, doc_id: str, specific: DataFrame, top: int = 3) -> DataFrame:
    w = Window.partitionBy(doc_id).orderBy(F.desc("score"), "terms", "rule")
    able = scored.filter("score > 0").join(F.broadcast(specific), "rule")
    return able.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top).select(doc_id, "rank", "rule", "score")


def signatures(tokens: DataFrame, label: str, doc_id: str, top: int = 50, least: int = 2, seeds: DataFrame | None = None) -> DataFrame:
    """label, term, weight: tf * ln((classes + 1) / (df + 0.5)) * (0.4 + tf / documents) for terms of tf least and more, the
    top ones of each class; seeds (label, term) add 1. tokens: label, doc_id, term, repeats included."""
    tf = tokens.groupBy(label, "term").agg(F.count("*").alias("tf"))
    df = tokens.groupBy("term").agg(F.count_distinct(doc_id).alias("df"))
    docs = tokens.groupBy(label).agg(F.count_distinct(doc_id).alias("docs"))
    classes = docs.agg(F.count("*").alias("classes"))
    s = tf.filter(F.col("tf") >= least).join(df, "term").join(F.broadcast(docs), label).join(F.broadcast(classes))
    s = s.withColumn("weight", F.col("tf") * F.log((F.col("classes") + 1) / (F.col("df") + 0.5)) * (0.4 + F.col("tf") / F.col("docs")))
    w = Window.partitionBy(label).orderBy(F.desc(F.round("weight", 9)), "term")
    s = s.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= top).select(label, "term", "weight")
    if seeds is None:
        return s
    return s.unionByName(seeds.select(label, "term").distinct().withColumn("weight", F.lit(1.0))).groupBy(label, "term").agg(F.sum("weight").alias("weight"))


def by_signature(tokens: DataFrame, doc_id: str, sigs: DataFrame, label: str) -> DataFrame:
    """doc_id, label, score, second: the class with the largest weight of the document's distinct terms."""
    hit = tokens.select(doc_id, "term").distinct().join(sigs, "term").groupBy(doc_id, label).agg(F.sum("weight").alias("score")).filter("score > 0")
    w = Window.partitionBy(doc_id).orderBy(F.desc(F.round("score", 9)), label)
    out = hit.withColumns({"__r": F.row_number().over(w), "second": F.coalesce(F.lead("score").over(w), F.lit(0.0))})
    return out.filter("__r = 1").drop("__r")


def holdout(rows: DataFrame, label: str, order: Sequence[str], part: float = 0.8) -> DataFrame:
    """rows with train: the first part of each class, one row at least."""
    out = numbered(rows, [label], order, "__nth", "__n")
    return out.withColumn("train", F.col("__nth") <= F.greatest(F.lit(1), F.floor(F.col("__n") * part))).drop("__nth", "__n")


def threshold(scored: DataFrame, score: str, right: Column, precision: float, start: int = 20) -> DataFrame:
    """One row threshold, coverage: the first score, from the highest down and from the position `start` on, at which all
    rows of that score and more reach the precision. Rows are counted by score and the scores dealt by range, so a window
    holds the scores of a part, and one over the parts' sums a row for each part."""
    by = scored.groupBy(score).agg(F.count("*").alias("__n"), F.count_if(right).alias("__r"))
    by = written(by.repartitionByRange(F.desc(score)).withColumn("__part", F.spark_partition_id()), "scores")
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = by.groupBy("__part").agg(F.sum("__n").alias("__pn"), F.sum("__r").alias("__pr"))
    parts = parts.select("__part", *(F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(c) for c in ("__pn", "__pr")))
    w = Window.partitionBy("__part").orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    run = by.withColumns({"__cn": F.sum("__n").over(w), "__cr": F.sum("__r").over(w)}).join(parts, "__part")
    run = run.withColumns({"__cn": F.col("__cn") + F.col("__pn"), "__cr": F.col("__cr") + F.col("__pr")})
    all_ = scored.agg(F.count("*").alias("__all"))
    # a score counts from `start` on if its last row lies behind that position
    good = run.filter((F.col("__cn") > start) & (F.col("__cr") / F.col("__cn") >= precision))
    return good.agg(F.max(F.struct(F.col(score).alias("t"), F.col("__cn").alias("n"))).alias("b")).join(F.broadcast(all_)).select(
        F.col("b.t").alias("threshold"), (F.col("b.n") / F.col("__all")).alias("coverage")
    )


def phrase_hits(docs: DataFrame, doc_id: str, text: str, phrases: DataFrame, stats: DataFrame, as_is: bool = True, once: bool = False) -> DataFrame:
    """doc_id, rule, rarity of the phrases of several words (rule, phrase) in a text. as_is: the text is searched as it is,
    so a capital or a comma beside a phrase hides it; else its key is. once: a row for each rule and rarity of a document,
    however many phrases show it.

    A phrase's rules are an array until the last step, so that no aggregate holds a document's row for each rule.
    """
    p = phrases.select("rule", norm_key(F.col("phrase")).alias("key")).filter(F.col("key").contains(" ")).distinct()
    ruled = p.join(stats.select("key", "rarity"), "key", "left").select("key", F.struct("rule", F.coalesce("rarity", F.lit(UNSEEN)).alias("rarity")).alias("r"))
    ruled = ruled.groupBy("key").agg(F.collect_list("r").alias("rules"))
    body = F.col(text) if as_is else norm_key(F.col(text))
    hit = phrases_in(docs, doc_id, body, p)
    if not once:
        return hit.distinct().join(ruled, "key").select(doc_id, F.inline("rules"))
    # documents of the same phrases have the same rules, found once for each set of phrases
    sets = written(hit.groupBy(doc_id).agg(F.array_sort(F.collect_set("key")).alias("keys")), "phrase-sets")
    by_set = sets.select("keys").distinct().select("keys", F.explode("keys").alias("key")).join(ruled, "key")
    by_set = by_set.groupBy("keys").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("rules"))
    # from the left, so that the documents, few bytes but many rows out, are dealt and never broadcast
    return sets.repartition(F.col(doc_id)).join(by_set, "keys", "left").select(doc_id, F.inline("rules"))


def effective(items: DataFrame, keyword: DataFrame, stored: DataFrame, accepted: Column, on: str = "qid") -> DataFrame:
    """items with rule, source (review, keyword, stored or null) and reason: a review that vetoes moves or unfiles first;
    then the keyword's match; then a stored decision above the floor; else unassigned with a reason.

    keyword: qid, rule, outcome. stored: qid, rule, veto, and what accepted needs.
    """
    k = keyword.select(on, F.col("rule").alias("__k"), F.col("outcome").alias("__o"))
    s = stored.select(on, F.col("rule").alias("__s"), F.coalesce("veto", F.lit(False)).alias("__v"), accepted.alias("__a"), F.lit(True).alias("__has"))
    rows = items.join(k, on, "left").join(s, on, "left")
    veto, matched = F.coalesce(F.col("__v"), F.lit(False)), F.col("__o") == "matched"
    good = F.coalesce(F.col("__a"), F.lit(False))
    rule = F.when(veto & good, F.col("__s")).when(veto, F.lit(None)).when(matched, F.col("__k")).when(good, F.col("__s"))
    source = F.when(veto & good & F.col("__s").isNotNull(), "review").when(veto, F.lit(None)).when(matched, "keyword").when(good & F.col("__s").isNotNull(), "stored")
    reason = F.when(rule.isNotNull(), F.lit(None)).when(veto, "vetoed").when(F.col("__has") & ~good, "low_confidence").when(F.col("__o").isNotNull() & (F.col("__o") != "matched"), F.col("__o")).otherwise("no_match")
    return rows.withColumns({"rule": rule, "source": source, "reason": reason}).drop("__k", "__o", "__s", "__v", "__a", "__has")
