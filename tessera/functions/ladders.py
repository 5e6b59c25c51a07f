"""First match wins: ordered classifiers, verdict ladders and tolerant parsing as single column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import norm_key, norm_space, split_labels, text_of


def first_of(rules: Sequence[tuple[Column, object]], otherwise=None) -> Column:
    """The value of the first condition that holds."""
    out = None
    for cond, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    last = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return last if out is None else out.otherwise(last)


def by_pattern(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Of (name, pattern) the name of the first pattern, case ignored, that is found."""
    return first_of([(text.rlike(f"(?i){p}"), name) for name, p in rules])


def by_label(labels: Column, anchors: Mapping[str, str], ambiguous: Sequence[str], rules: Sequence[tuple[str, str]]) -> Column:
    """The first label that names a class: by its exact key, unless that is ambiguous, else by the first pattern."""
    exact = F.create_map(*(F.lit(v) for kv in anchors.items() for v in kv)) if anchors else None

    def one(label: Column) -> Column:
        key = norm_key(label)
        named = exact[key] if exact is not None else F.lit(None).cast("string")
        vague = key.isin(*ambiguous) if ambiguous else F.lit(False)
        return F.coalesce(named, F.when(~vague, by_pattern(label, rules)))

    return F.get(F.filter(F.transform(split_labels(labels) if not isinstance(labels, list) else F.array(*labels), one), lambda v: v.isNotNull()), F.lit(0))


def by_piece(labels: Sequence[Column], table: Mapping[str, str]) -> Column:
    """The first comma-separated piece of the labels, in lower case, that the table has."""
    pieces = F.flatten(F.array(*(F.transform(F.split(norm_space(c), ","), lambda v: F.lower(F.trim(v))) for c in labels)))
    m = F.create_map(*(F.lit(v) for kv in table.items() for v in kv))
    return F.get(F.filter(F.transform(pieces, lambda v: m[v]), lambda v: v.isNotNull()), F.lit(0))


#: Kinds of failures and the signals that tell them.
KINDS = ("auth", "rate_limit", "transport", "bad_json", "http", "other")
AUTH, QUOTA = (401, 403), (402, 408, 429)
PERMANENT = r"balance|insufficient|quota|invalid api key|invalid_api_key|no credit|account suspended"


def failure_kind(status: Column, message: Column, kind: Column | None = None, busy: str = r"rate limit|too many requests|quota", wall: str = r"<html|cloudflare|captcha") -> Column:
    """A given kind wins; then the status of a refused credential, a quota, a challenge page, bad JSON, transport, any status."""
    text = F.lower(text_of(message))
    given = kind if kind is not None else F.lit(None).cast("string")
    return first_of(
        [
            (given.isin(*KINDS), given), (status.isin(*AUTH), "auth"), (status.isin(*QUOTA), "rate_limit"), (text.rlike(busy), "rate_limit"),
            (text.rlike(wall), "http"), (text.rlike("invalid json|bad json|json decode"), "bad_json"),
            (text.rlike("transport error|timed out|timeout"), "transport"), (F.coalesce(status, F.lit(0)) != 0, "http"),
            (text.contains("empty completion"), "bad_json"),
        ],
        "other",
    )


def retryable(kind: Column, status: Column, message: Column) -> Column:
    return ~(F.coalesce(kind == "auth", F.lit(False)) | F.lower(text_of(message)).rlike(PERMANENT) | F.coalesce(status == 402, F.lit(False)))


def rate_limited(status: Column, body: Column, busy: str = r"rate limit|too many requests|quota exceeded") -> Column:
    """By status, else by the body's words; a well-formed answer of status 200 never is."""
    fine = (status == 200) & F.get_json_object(text_of(body), "$.choices").isNotNull()
    return ~F.coalesce(fine, F.lit(False)) & (F.coalesce(status.isin(*QUOTA), F.lit(False)) | F.lower(text_of(body)).rlike(busy))


def failure_label(status: Column, message: Column) -> Column:
    text = F.lower(text_of(message))
    return first_of(
        [
            (text.rlike("<html|cloudflare|captcha"), "waf"), (status.isin(*QUOTA) | text.rlike("rate limit|too many requests"), "rate_limit"),
            (F.coalesce(status, F.lit(0)) != 0, "http"), (text.rlike("invalid json|json decode"), "bad_json"),
            (text.rlike("timed out|timeout|connection"), "transport"), (text.rlike("empty"), "empty"),
        ],
        "error",
    )


def accepted(confidence: Column, alone: Column, floor: float = 0.80, pair: float = 0.75) -> Column:
    """At the floor; or at the lower one if two different judges agreed. Not a number: false."""
    c = confidence.try_cast("double")
    return F.coalesce(F.when(c >= floor, F.lit(True)).when(~alone & (c >= pair), F.lit(True)), F.lit(False))


def exit_code(status: Column) -> Column:
    return first_of([(status == "done", 0), (status == "partial", 2), (status == "unavailable", 3)], 1)


def json_text(x: Column) -> Column:
    """The JSON in a reply: a fenced block, the whole, from the first { to the last }, or from [ to ]; null if none parses."""
    text = text_of(x)
    tries = [
        F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1), F.trim(text),
        F.regexp_extract(text, r"(?s)\{.*\}", 0), F.regexp_extract(text, r"(?s)\[.*\]", 0),
    ]
    valid = lambda t: F.when(t.rlike(r"^\s*[\[{]") & F.try_parse_json(t).isNotNull(), F.trim(t))
    return F.coalesce(*(valid(t) for t in tries))


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.least(x, F.lit(high)), F.lit(low))


def verdict(reply: Column, most: int = 400) -> Column:
    """struct(ok, concept, confidence, reason) of a judge's reply; null unless it has ok or concept."""
    v = F.from_json(json_text(reply), "ok boolean, concept string, chapter string, topic string, confidence double, reason string")
    out = F.struct(v.ok.alias("ok"), v.concept.alias("concept"), clamp(F.coalesce(v.confidence, F.lit(0.0))).alias("confidence"), F.substring(F.coalesce(v.reason, F.lit("")), 1, most).alias("reason"))
    return F.when(v.ok.isNotNull() | v.concept.isNotNull(), out)


def decisions(reply: Column, rules: int) -> Column:
    """array<struct<qid, rule, confidence, reason>> of a batch reply: a list, or an object with `items`; rules out of range
    and items without an id are dropped."""
    schema = "array<struct<qid:string,id:string,rule:int,confidence:double,reason:string>>"
    text = json_text(reply)
    # an object parses as a list of itself, so the first character decides
    rows = F.when(text.startswith("["), F.from_json(text, schema)).otherwise(F.from_json(F.get_json_object(text, "$.items"), schema))
    named = F.transform(rows, lambda r: F.struct(F.coalesce(r.qid, r.id).alias("qid"), r.rule.alias("rule"), clamp(F.coalesce(r.confidence, F.lit(0.0))).alias("confidence"), F.coalesce(r.reason, F.lit("")).alias("reason")))
    return F.filter(named, lambda r: r.qid.isNotNull() & (r.rule.isNull() | r.rule.between(1, rules)))


def payload(most: int = 1200, text: str | None = None, **columns: Column) -> Column:
    """A row as JSON, its text cut to a length."""
    parts = [c.alias(k) for k, c in columns.items()]
    return F.to_json(F.struct(*parts, *([F.substring(text_of(F.col(text)), 1, most).alias("text")] if text else [])))


def options(raw: Column) -> Column:
    """array<struct<label, text>> of options given as JSON: a map of texts or objects, or a list of them."""
    entry = "struct<label:string,text:string>"
    as_map = F.from_json(raw, "map<string,string>")
    of_map = F.transform(
        F.map_entries(as_map),
        lambda e: F.struct(
            F.coalesce(F.get_json_object(e.value, "$.label"), e.key).alias("label"),
            F.when(e.value.startswith("{"), F.coalesce(F.get_json_object(e.value, "$.text"), F.lit(""))).otherwise(e.value).alias("text"),
        ),
    )
    of_list = F.transform(
        F.from_json(raw, "array<string>"),
        lambda v: F.when(
            v.startswith("{"),
            F.struct(F.coalesce(F.get_json_object(v, "$.label"), F.lit("")).alias("label"), F.coalesce(F.get_json_object(v, "$.text"), F.lit("")).alias("text")),
        ).otherwise(F.struct(F.lit("").alias("label"), v.alias("text"))),
    )
    return F.when(F.trim(raw).startswith("{"), of_map).when(F.trim(raw).startswith("["), of_list).otherwise(F.array().cast(f"array<{entry}>"))


def task_type(labels: Sequence[Column], prompt: Column, table: Mapping[str, str], rules: Sequence[tuple[str, str]]) -> Column:
    """The type that a label names, else that the prompt's wording shows."""
    return F.coalesce(by_piece(labels, table), by_pattern(prompt, rules))


def is_task(labels: Sequence[Column], prompt: Column, topic: Column, *, veto_topic: str, veto: str, generic: str, table: Mapping[str, str], wording: str, rules: Sequence[tuple[str, str]]) -> Column:
    """Whether a question belongs to a family: vetoed by its topic, or by labels of another family unless they name this
    one too; then by a label of the table, a generic label, a label's wording, or the prompt."""
    blob = F.lower(F.concat_ws(" ; ", *labels))
    named = blob.rlike(generic)
    return first_of(
        [
            (F.lower(norm_space(topic)) == veto_topic, False), (blob.rlike(veto) & ~named, False), (by_piece(labels, table).isNotNull(), True),
            (named, True), (blob.rlike(wording), True), (task_type(labels, prompt, table, rules).isNotNull(), True),
        ],
        False,
    )


def status_of(given: Column, raised: Column) -> Column:
    """The given status, else that of the error as a number, else null."""
    return F.coalesce(given, raised.try_cast("int"))


def pinned(values: Column, first: Column, last: Column) -> Column:
    """The values, each once, with one of them first and one last where they are among them."""
    rest = F.filter(F.array_distinct(values), lambda v: ~v.eqNullSafe(first) & ~v.eqNullSafe(last))
    one = lambda c: F.when(c.isNotNull() & F.array_contains(values, c), F.array(c)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(one(first), rest, one(last)))


def near_after(text: Column, pattern: str, then: str, within: int = 40) -> Column:
    """Whether `then` stands within so many characters after the first match of pattern."""
    return text.rlike(f"(?is){pattern}.{{0,{within}}}?\\b(?:{then})\\b")


def agreement_candidate(prompt: Column, options: Column, joined: str, singular: str, plural: str, within: int = 40) -> Column:
    """A joined-noun pattern in the prompt, and both verb forms among the options or one of them soon after the pattern."""
    has = lambda p: F.exists(options, lambda o: o.rlike(f"(?i)\\b(?:{p})\\b"))
    return prompt.rlike(f"(?i){joined}") & ((has(singular) & has(plural)) | near_after(prompt, joined, f"{singular}|{plural}", within))


def rule_table(spark, anchors: Mapping[str, str], ambiguous: Sequence[str], rules: Sequence[tuple[str, str]]):
    """The classifier's tables as rows part, number, label, value, so that it can be audited."""
    rows = [("anchor", k, a, v) for k, (a, v) in enumerate(sorted(anchors.items()))] + [("ambiguous", k, a, None) for k, a in enumerate(sorted(ambiguous))]
    rows += [("rule", k, n, p) for k, (n, p) in enumerate(rules)]
    return spark.createDataFrame(rows, "part string, number int, label string, value string")
