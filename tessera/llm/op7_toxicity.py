"""Toxicity by a weighted finite-state pattern grammar over clauses.

The words and marks of a text are symbols: insult (with a weight), threat, intent, target, negation, contrast, report,
quotation mark, comma, colon, ends of clauses and paragraphs, other words. Five transducers (transducers.py) are composed
into one, and what it puts out over a clause is the clause's weight:
  insult     hits by its weight
  threat     hits in full after an intent, by a part alone
  negation   a hit within its scope weighs less; the scope passes commas, and ends at a contrast
  report     a hit in reported or quoted speech weighs less; it passes commas and colons, a quotation also ends of clauses
  target     hits weigh more in a clause that addresses somebody, before or after
A document's features are its heaviest clause, the sum over clauses and the share of clauses that hit; a logistic function
of them, which never falls in any of them, is the score.

Learned are: the insults and their weights (words, and stems of STEMS letters, whose log odds between toxic and other rows
are LEAST_ODDS and more: all of them), the factors of the context (of CONTEXTS those under which the labels are likeliest)
and the logistic function. The fit is bounded: the FIT_ROWS labelled ids with the smallest hashes, a row of each. The words
of the other classes, which labels can't tell, are given in four languages. Every text is scored whole. Held out are rows
whose crc32(doc_id as text) is 0 modulo 5; their labels are never learned from.

Results for odd input: null and empty texts get the score of a text without any match. A null doc_id is not held out and
not learned from. Labels that are null, or neither 0 nor 1, are not learned from; without both kinds the score is near 0.
An id that has several labels is toxic if one says so; of its rows in the fit the least text counts. Repeated rows each
get their (equal) score. Very long texts are read whole, one clause after another. An empty table gives an empty result.
Other columns are not used or returned.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import held_out, stage, unstage
from tessera.llm.transducers import clause_machine

FIT_ROWS, STEMS, LEAST_ROWS, LEAST_ODDS = 12_000, (6, 7, 8), 4, 2.2
SCOPE, INTENT_SCOPE, ALONE, THREAT_WEIGHT = 3, 4, 0.5, 3.0
FADED = max(SCOPE, INTENT_SCOPE)
#: Factors of negated, reported and aimed hits, from the strongest on; equal likelihood leaves the first.
CONTEXTS = tuple(itertools.product((0.3, 0.6, 1.0), (0.5, 1.0), (1.5, 1.0)))
#: Given words, by class.
CLASSES = {
    "THREAT": "kill hurt beat destroy burn shoot stab punch strangle murder crush tuer frapper brûler étrangler écraser töten schlagen brennen erschießen erwürgen matar golpear quemar disparar apuñalar",
    "INTENT": "will shall gonna going i'll we'll should must want vais allons veux devrait werde werden will wollen sollte voy vamos quiero debería",
    "TARGET": "you your yours yourself yourselves they them their tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer tú ti tuyo vosotros usted ustedes vuestro",
    "NEGATION": "not no never neither nor without hardly cannot ne pas jamais aucun sans nicht kein keine keinen nie niemals ohne nunca jamás ningún sin tampoco",
    "CONTRAST": "but however yet mais pourtant aber jedoch sondern pero sino",
    "REPORT": "said says say saying wrote writes claimed claims reported reports quoted called calls told tells dit disait écrit appelle sagte sagt schrieb nannte dijo dice escribió llamó",
}
_CLASS = {w: c for c, ws in CLASSES.items() for w in ws.split()}
_MARK = {",": "COMMA", ":": "COLON", "\n": "PARAGRAPH"} | dict.fromkeys('"“”«»', "QUOTE") | dict.fromkeys(".!?;", "END")
_LETTERS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_TOKEN = re.compile(_LETTERS.pattern + r"|[,:\n\"“”«».!?;]")


def patterns_of(text: str | None) -> set[str]:
    """The words of a text, and their stems as `=stem`."""
    found = set(_LETTERS.findall((text or "").lower()))
    return found | {f"={w[:n]}" for w in found for n in STEMS if len(w) > n}


def faded(stream: Iterable[tuple[str, float]]) -> Iterator[tuple[str, float]]:
    """The stream without the words that follow more words than any scope spans: they leave every machine where it is."""
    run = 0
    for x in stream:
        run = run + 1 if x[0] == "WORD" else 0
        if run <= FADED:
            yield x


class Grammar:
    def __init__(self, insults: dict[str, float], curve: tuple[float, ...] = (-1.0, 1.0, 0.0, 0.0), context: tuple[float, float, float] = CONTEXTS[0]):
        self.insults, self.curve, self.context = insults, curve, context
        self.machine = clause_machine(SCOPE, INTENT_SCOPE, ALONE, *context)
        self.known: dict[str, tuple[str, float]] = {}

    def symbol(self, token: str) -> tuple[str, float]:
        """The class of a word or mark in lower case, and what it weighs. Looked up once for each word of a task."""
        found = self.known.get(token)
        if found is None:
            if len(self.known) > 500_000:
                self.known.clear()
            keys = (token, *(f"={token[:n]}" for n in STEMS if len(token) > n))
            weight = max((self.insults[k] for k in keys if k in self.insults), default=0.0)
            name = _MARK.get(token) or _CLASS.get(token) or ("NEGATION" if token.endswith(("n't", "n’t")) else "WORD")
            if name == "THREAT":
                found = name, max(weight, THREAT_WEIGHT)
            else:
                found = ("INSULT", weight) if weight else (name, 0.0)
            self.known[token] = found
        return found

    def stream(self, text: str) -> list[tuple[str, float]]:
        """The symbols of a text and their weights, up to a last end; none if it holds no insult or threat."""
        found = list(map(self.symbol, _TOKEN.findall(text.lower())))
        return [*faded(found), ("PARAGRAPH", 0.0)] if any(w for _, w in found) else []

    def clauses(self, text: str) -> list[float]:
        """The weights of a text's clauses; none if it holds no insult or threat."""
        return list(self.machine.clauses(self.stream(text)))

    def features(self, text: str | None) -> tuple[float, float, float]:
        return self.features_of(self.stream(text or ""))

    def features_of(self, stream: list[tuple[str, float]]) -> tuple[float, float, float]:
        found = list(self.machine.clauses(stream))
        if not found:
            return 0.0, 0.0, 0.0
        return math.log1p(max(found)), math.log1p(sum(found)), sum(c > 0 for c in found) / len(found)

    def score(self, text: str | None) -> float:
        z = self.curve[0] + sum(a * x for a, x in zip(self.curve[1:], self.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _newton(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1.0) -> np.ndarray:
    """Logistic weights by Newton steps, with a small ridge on all but the constant, the first column."""
    w = np.zeros(x.shape[1])
    r = np.full(len(w), ridge)
    r[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(r), x.T @ (y - p) - r * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """The constant and the features' weights, none of which is under 0 (a feature that would be is left out, and the others
    fitted again), and the labels' log likelihood."""
    x = np.column_stack([np.ones(len(x)), x])
    kept = list(range(x.shape[1]))
    while True:
        w = _newton(x[:, kept], y)
        worst = 1 + int(np.argmin(w[1:])) if len(w) > 1 else 0
        if not worst or w[worst] >= 0:
            break
        del kept[worst]
    full = np.zeros(x.shape[1])
    full[kept] = w
    p = np.clip(1 / (1 + np.exp(-np.clip(x @ full, -30, 30))), 1e-12, 1 - 1e-12)
    return full, float((y * np.log(p) + (1 - y) * np.log(1 - p)).sum())


def _counted(batches):
    """Of a task: in how many toxic and other rows each pattern is."""
    seen = {0: Counter(), 1: Counter()}
    rows = Counter()
    for batch in batches:
        for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
            seen[toxic].update(patterns_of(text.as_py()))
            rows[toxic] += 1
    out = [("", rows[1], rows[0]), *((k, n, seen[0][k]) for k, n in seen[1].items())]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["k", "bad", "good"])
    rest = [k for k in seen[0] if k not in seen[1]]
    yield pa.RecordBatch.from_arrays([pa.array(rest, pa.string()), pa.array([0] * len(rest), pa.int64()), pa.array([seen[0][k] for k in rest], pa.int64())], names=["k", "bad", "good"])


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Grammar:
    able = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    ids = able.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    rows = stage(rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")), "labelled")
    counts = rows.mapInArrow(_counted, "k string, bad long, good long").groupBy("k").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    found = stage(counts.filter((F.col("k") == "") | (F.col("bad") >= LEAST_ROWS)), "patterns")
    total = {r["k"]: r for r in found.filter("k = ''").collect()}.get("")
    if total is None or not total["bad"] or not total["good"]:
        unstage(rows, found)
        return Grammar({}, (-30.0, 0.0, 0.0, 0.0))
    base = math.log((total["bad"] + 1) / (total["good"] + 1))
    odds = F.log((F.col("bad") + 0.5) / (F.col("good") + 0.5)) - F.lit(base)
    # the rows of the fit bound how many patterns there are
    insults = {r["k"]: r["w"] for r in found.filter("k <> ''").select("k", odds.alias("w")).filter(F.col("w") >= LEAST_ODDS).collect()}

    def featured(batches):
        grammars = [Grammar(insults, context=c) for c in CONTEXTS]
        for batch in batches:
            # the contexts differ in factors alone, so they read the same symbols
            streams = [grammars[0].stream(t.as_py() or "") for t in batch.column("text")]
            got = [[v for g in grammars for v in g.features_of(s)] for s in streams]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.list_(pa.float64())), batch.column("toxic")], names=["x", "y"])

    points = rows.select("text", "toxic").mapInArrow(featured, "x array<double>, y int").collect()
    points = sorted((tuple(r["x"]), r["y"]) for r in points)
    x, y = np.array([p[0] for p in points]).reshape(len(points), len(CONTEXTS), 3), np.array([p[1] for p in points], float)
    curves = [logistic(x[:, k], y) for k in range(len(CONTEXTS))]
    best = max(range(len(CONTEXTS)), key=lambda k: (round(curves[k][1], 6), -k))
    unstage(rows, found)
    return Grammar(insults, tuple(float(v) for v in curves[best][0]), CONTEXTS[best])


def toxicity(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """doc_id, score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def scored(batches):
        for batch in batches:
            scores = [shared.value.score(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scored, "doc_id long, score double")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = toxicity(docs, fit(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op7_toxicity": op7_toxicity}
