"""Text expressions: normal forms, keys, tokens, extraction. Columns in, columns out; nothing leaves the JVM but fold_key."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: The mark of an image, underlined text, and what is trimmed off a term.
IMAGE = r"\[IMAGE:[^\]]*\]"
UNDERLINED = r"_{2,}(.+?)_{2,}"
TERM_EDGE = " \t\n\r\x0b\x0c\"'“”‘’.,;:!?()[]"
#: The white space of Unicode, and the four information separators that Python counts with it.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
QUOTES = "\"'“”‘’`"


def text_of(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit(""))


def held(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x worked out once: a lambda's variable is a value, where a column is put in again at each use."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def norm_space(x: Column) -> Column:
    """Runs of white space (Unicode's) as one space, none at the ends; null as empty."""
    return F.trim(F.regexp_replace(F.translate(text_of(x), SPACES, " " * len(SPACES)), " {2,}", " "))


def norm_key(x: Column) -> Column:
    """The lookup key: lower case, & as and, / - . as spaces."""
    plain = F.translate(F.replace(F.lower(text_of(x)), F.lit("&"), F.lit(" and ")), SPACES + "/-.", " " * (len(SPACES) + 3))
    return F.trim(F.regexp_replace(plain, " {2,}", " "))


@F.pandas_udf(StringType())
def fold_key(x: pd.Series) -> pd.Series:
    """Case- and accent-insensitive key that keeps punctuation: NFKD without combining marks, casefolded."""

    def fold(v):
        plain = "".join(c for c in unicodedata.normalize("NFKD", " ".join((v or "").split())) if not unicodedata.combining(c))
        return " ".join(plain.split()).casefold()

    return x.map(fold, na_action=None)


def slugify(x: Column, fallback: str | None = "unclassified") -> Column:
    slug = F.btrim(F.regexp_replace(F.replace(F.lower(norm_space(x)), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", "-"), F.lit("-"))
    return slug if fallback is None else F.coalesce(F.nullif(slug, F.lit("")), F.lit(fallback))


def key_tokens(x: Column, least: int = 1) -> Column:
    """Letter-and-digit tokens of the lookup key."""
    return F.filter(F.split(norm_key(x), "[^a-z0-9]+"), lambda t: F.length(t) >= least)


def letter_tokens(x: Column) -> Column:
    """Lower-case runs of ASCII letters, inner apostrophes and hyphens kept; two characters at least."""
    return F.transform(F.regexp_extract_all(strip_images(x), F.lit(r"[a-zA-Z][a-zA-Z'\-]+"), F.lit(0)), F.lower)


def tokens_without(x: Column, stop: Sequence[str]) -> Column:
    """letter_tokens without stop words, repeats kept."""
    return F.filter(letter_tokens(x), lambda t: ~t.isin(*stop)) if stop else letter_tokens(x)


def content_terms(x: Column, stop: Sequence[str] = (), keep: Sequence[str] = (), least: int = 3) -> Column:
    """The distinct tokens of a length, without stop words that are not to be kept."""
    out = [w for w in stop if w not in set(keep)]
    return F.array_distinct(F.filter(tokens_without(x, out), lambda t: F.length(t) >= least))


def contains_phrase(text: Column, phrase: Column) -> Column:
    """Containment on word boundaries of two keys; false for an empty one."""
    pad = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    return (F.length(phrase) > 0) & (F.length(text) > 0) & F.contains(pad(text), pad(phrase))


def safe_int(x: Column, default: int = 0) -> Column:
    return F.coalesce(x.try_cast("int"), F.lit(default))


def percent(n: Column, of: Column) -> Column:
    return F.when(of == 0, F.lit(0.0)).otherwise(100.0 * n / of)


def share(n: Column, of: Column) -> Column:
    """Percentage with one decimal."""
    return F.round(percent(n, of), 1)


def human_int(n: Column) -> Column:
    return F.format_number(n, 0)


def extract_urls(x: Column, pattern: str = r"https?://[^\s\"'<>)]+") -> Column:
    return F.array_distinct(F.regexp_extract_all(text_of(x), F.lit(pattern), F.lit(0)))


def strip_images(x: Column) -> Column:
    return F.regexp_replace(text_of(x), IMAGE, " ")


def split_labels(x: Column) -> Column:
    """Comma-separated labels; commas in parentheses, nested ones too, do not separate. A fold over the characters."""
    step = F.aggregate(
        F.split(text_of(x), ""),
        F.struct(F.lit(0).alias("depth"), F.lit("").alias("now"), F.array().cast("array<string>").alias("done")),
        lambda a, c: F.transform(
            F.array(F.when(c == "(", a.depth + 1).when(c == ")", F.greatest(a.depth - 1, F.lit(0))).otherwise(a.depth)),
            lambda d: F.struct(
                d.alias("depth"),
                F.when((c == ",") & (d == 0), F.lit("")).otherwise(F.concat(a.now, c)).alias("now"),
                F.when((c == ",") & (d == 0), F.concat(a.done, F.array(a.now))).otherwise(a.done).alias("done"),
            ),
        )[0],
        lambda a: F.concat(a.done, F.array(a.now)),
    )
    return F.filter(F.transform(step, lambda v: F.trim(v)), lambda v: v != "")


def norm_lines(x: Column) -> Column:
    """Line ends as \\n, runs of blanks as one, runs of empty lines as one."""
    out = F.regexp_replace(text_of(x), r"\r\n?", "\n")
    out = F.regexp_replace(F.regexp_replace(out, "[ \\t]+", " "), "\n{2,}", "\n\n")
    return F.btrim(out, F.lit(" \n\t"))


def split_prompt(x: Column) -> Column:
    """struct(instruction, payload): what stands before and after the first blank line."""
    parts = F.split(norm_lines(strip_images(x)), r"\n\s*\n", 2)
    return F.struct(F.trim(parts[0]).alias("instruction"), F.trim(F.coalesce(F.get(parts, F.lit(1)), F.lit(""))).alias("payload"))


def strip_markup(x: Column) -> Column:
    out = F.regexp_replace(strip_images(x), UNDERLINED, "$1")
    out = F.regexp_replace(out, r"\*{1,2}(.+?)\*{1,2}", "$1")
    return norm_space(F.replace(F.replace(out, F.lit("**"), F.lit("")), F.lit("__"), F.lit("")))


def clean_term(x: Column) -> Column:
    return norm_space(F.btrim(strip_markup(x), F.lit(TERM_EDGE)))


def clean_heading(x: Column) -> Column:
    """Back-quotes, emphasis and leading dashes off."""
    out = F.replace(F.trim(text_of(x)), F.lit("`"), F.lit(""))
    out = F.regexp_replace(F.regexp_replace(out, r"\*\*(.+?)\*\*", "$1"), r"\*(.+?)\*", "$1")
    return norm_space(F.regexp_replace(out, r"^[—\-–]+\s*", ""))


def clean_prompt(x: Column) -> Column:
    return norm_space(F.regexp_replace(strip_images(x), "[*_#>`]+", " "))


def word_count(x: Column) -> Column:
    return F.size(F.filter(F.split(norm_space(x), " "), lambda w: w != ""))


def name_like(x: Column) -> Column:
    """Short enough for a name: 60 characters, 9 words, and no sentence of more than 5."""
    v, n = norm_space(x), word_count(x)
    return (v != "") & (F.length(v) <= 60) & (n <= 9) & ~(v.endswith(".") & (n > 5))


def prose_bullet(x: Column, labels: Sequence[str] = ()) -> Column:
    """A bullet that is a sentence, a table, an example or a heading word rather than a name."""
    v = F.trim(text_of(x))
    marked = v.rlike(r"^(```|\||✓|✗|→|->|Example|Note:)")
    return (v == "") | marked | (v.endswith(".") & (word_count(v) > 6)) | (norm_key(v).isin(*labels) if labels else F.lit(False))


def term_like(x: Column, deny: str, least: int = 2, most_words: int = 12) -> Column:
    n = word_count(x)
    sentence = x.rlike(r"[.?!]$") & (n > 8)
    return (F.length(x) >= least) & (n <= most_words) & ~sentence & ~x.rlike(deny)


def short_term(x: Column, deny: str, least: int = 2, most_words: int = 3) -> Column:
    return (F.length(x) >= least) & (word_count(x) <= most_words) & ~x.rlike(deny)


def last_term(x: Column, deny: str) -> Column:
    """The last line that, cleaned, is like a term; empty if none is."""
    found = F.filter(F.transform(F.split(text_of(x), "\n"), clean_term), lambda v: term_like(v, deny))
    return F.coalesce(F.element_at(F.concat(F.array(F.lit("")), found), -1), F.lit(""))


def underlined(x: Column) -> Column:
    return F.regexp_extract_all(text_of(x), F.lit(UNDERLINED), F.lit(1))


def asked_term(x: Column, instruction: str, deny: str) -> Column:
    """The term a prompt asks about: after the first line that is an instruction, its own later sentences from the last
    back, then the following lines; without such a line the last underlined term, else the last line like one."""
    none = F.array().cast("array<string>")
    usable = lambda v: term_like(v, deny) & ~(v.rlike(instruction) & (word_count(v) > 4))
    first = lambda rows: F.array_position(F.transform(rows, lambda v: strip_markup(v).rlike(instruction)), F.lit(True)).cast("int")

    def later(rows: Column, at: Column) -> Column:
        line = F.regexp_replace(strip_markup(F.get(rows, at - 1)), r"(?i)^\s*directions?\s*[:\-–]\s*", "")
        own = held(F.split(line, r"(?<=[.:?])\s+"), lambda s: F.when(F.size(s) > 1, F.reverse(F.slice(s, 2, F.size(s) - 1))).otherwise(none))
        after = F.when(at < F.size(rows), F.slice(rows, at + 1, F.size(rows) - at)).otherwise(none)
        return F.get(F.filter(F.transform(F.concat(own, after), clean_term), usable), F.lit(0))

    lines = F.filter(F.split(norm_lines(x), "\n"), lambda v: F.trim(v) != "")
    found = held(lines, lambda rows: held(first(rows), lambda at: F.when(at > 0, later(rows, at))))
    marked = held(clean_term(F.get(F.reverse(underlined(x)), F.lit(0))), lambda v: F.when(term_like(v, deny), v))
    return F.coalesce(found, marked, last_term(norm_lines(x), deny))


def spelling_target(instruction: Column, payload: Column, deny: str) -> Column:
    """The first underlined term, else the last of the payload, else the instruction if it is one."""
    marked = clean_term(F.coalesce(F.get(underlined(payload), F.lit(0)), F.get(underlined(instruction), F.lit(0))))
    term = lambda x: held(x, lambda v: F.when(term_like(v, deny), v))
    return F.coalesce(F.nullif(term(marked), F.lit("")), F.nullif(last_term(payload, deny), F.lit("")), term(clean_term(instruction)), F.lit(""))


def entry_key(x: Column, drop_to: Column) -> Column:
    """fold_key; where drop_to holds without a leading `to `."""
    k = fold_key(x)
    return F.when(drop_to, F.regexp_replace(k, r"^to\s+", "")).otherwise(k)


def after_dash(x: Column) -> Column:
    """The last part of a name with a long dash; empty without one."""
    parts = F.split(norm_space(x), r"\s+[—–-]\s+|\s*[—–]\s*")
    return F.when(F.size(parts) < 2, F.lit("")).otherwise(clean_heading(F.element_at(parts, -1)))


def quoted(x: Column, drop: Sequence[str] = ()) -> Column:
    """Quoted expressions in order, each once whatever its case, without the words to drop."""
    # fixed value: the pattern
    raw = F.regexp_extract_all(text_of(x), F.lit("[\"“]([^\"“”]+)[\"”]|[‘']([^‘’']+)[’']|`([^`]+)`"), F.lit(0))
    found = F.filter(F.transform(raw, lambda v: F.trim(F.btrim(F.trim(v), F.lit(QUOTES)))), lambda v: v != "")
    keys = F.transform(found, F.lower)
    first = F.filter(found, lambda v, i: F.array_position(keys, F.lower(v)) == i + 1)
    return F.filter(first, lambda v: ~F.lower(v).isin(*drop)) if drop else first


def clean_signal(x: Column) -> Column:
    return F.lower(norm_space(F.btrim(F.trim(x), F.lit(QUOTES + ".,;:"))))


def signal_phrases(signals: Column) -> Column:
    """Of an array of quotes those of several words; an ellipsis joins what stands around it."""
    joined = F.transform(signals, lambda v: norm_space(F.replace(clean_signal(v), F.lit("..."), F.lit(" "))))
    return F.array_distinct(F.filter(joined, lambda v: v.rlike("[ -]") & (v != "")))


def signal_words(signals: Column, least: int = 3) -> Column:
    cleaned = F.transform(signals, clean_signal)
    return F.array_distinct(F.filter(cleaned, lambda v: ~v.contains(" ") & (F.length(v) >= least)))


def sentences(x: Column) -> Column:
    return F.filter(F.transform(F.split(norm_space(x), r"(?<=[.!?])\s+"), lambda v: F.trim(v)), lambda v: v != "")


def marked_lines(x: Column, marks: str) -> Column:
    """The bullet lines that begin with one of the marks, without it."""
    lines = F.transform(F.regexp_extract_all(text_of(x), F.lit(r"(?m)^\s*[-*]\s+(.+)$"), F.lit(1)), lambda v: F.btrim(v, F.lit("*_ ")))
    return F.transform(F.filter(lines, lambda v: v.rlike(f"^[{marks}]")), lambda v: F.trim(F.substring(v, 2, 1 << 20)))


def title_from_slug(x: Column) -> Column:
    return F.initcap(F.regexp_replace(F.element_at(F.split(text_of(x), "/"), -1), "[-_]+", " "))


def collapse_levels(levels: Column) -> Column:
    """An array without elements that equal the one before; null and empty ones dropped first."""
    kept = F.filter(levels, lambda v: F.coalesce(v, F.lit("")) != "")
    return F.aggregate(
        kept, F.array().cast("array<string>"),
        lambda a, v: F.when((F.size(a) > 0) & (F.coalesce(F.get(a, F.size(a) - 1), F.lit("")) == v), a).otherwise(F.concat(a, F.array(v))),
    )


def leaf_path(chapter: Column, topic: Column, concept: Column, other: Column) -> Column:
    """Slugs of the levels, equal neighbours merged; where other holds, `_other` after the first."""
    name = lambda c: F.coalesce(F.nullif(slugify(c, None), F.lit("")), F.lit("_unclassified"))
    topic_slug = F.when(F.coalesce(topic, F.lit("")) != "", name(topic))
    levels = collapse_levels(F.array(name(chapter), topic_slug, name(concept)))
    parked = F.concat(F.slice(levels, 1, 1), F.array(F.lit("_other")), F.slice(levels, 2, 10))
    return F.when(F.coalesce(other, F.lit(False)) & (F.size(levels) >= 2), parked).otherwise(levels)


def mask(x: Column, rules: Sequence[tuple[str, ...]], most: int | None = 300) -> Column:
    """White space collapsed, the patterns replaced in order, cut to a length with an ellipsis; None: not cut. A rule is a
    pattern, what replaces it and, where there is one, a string without which it is nowhere: that is looked for first."""
    out = norm_space(x)
    for pattern, to, *needs in rules:
        changed = F.regexp_replace(out, pattern, to)
        out = F.when(out.contains(needs[0]), changed).otherwise(out) if needs else changed
    if most is None:
        return out
    return F.when(F.length(out) > most, F.concat(F.rtrim(F.substring(out, 1, most - 3)), F.lit("..."))).otherwise(out)


#: Shapes of credentials.
CREDENTIALS = (
    (r"\bsk-[A-Za-z0-9_\-]{4,}", "sk-<redacted>"),
    (r"(?i)\bBearer\s+[A-Za-z0-9._\-]{4,}", "Bearer <redacted>"),
    (r"(?i)\b(api[_-]?key|apikey|token|access[_-]?token|secret)\b\s*[:=]\s*[\"']?[^\"'\s,}]{6,}", "$1=<redacted>"),
    (r"(?i)([?&](?:key|api_key|access_token)=)[^&\s]+", "$1<redacted>"),
    (r"\b[A-Za-z0-9_\-]{40,}\b", "<redacted-token>"),
)


def redact(x: Column) -> Column:
    return mask(x, CREDENTIALS)


def digest_of(lines: Column, length: int = 64) -> Column:
    """sha256 of an array's elements, one on each line."""
    return F.substring(F.sha2(F.array_join(lines, "\n"), 256), 1, length)


def script_hit(parts: Sequence[Column], pattern: str) -> Column:
    """Whether any of the texts has a character of the pattern."""
    return F.concat_ws(" ", *parts).rlike(pattern)


def year_in(x: Column) -> Column:
    return F.nullif(F.regexp_extract(text_of(x), r"(?<!\d)(20\d\d)(?!\d)", 1), F.lit("")).cast("int")


def year_of_path(path: Column, title: Column) -> Column:
    """struct(year, source): from the deepest folder that has one, else from the title."""
    folders = F.filter(F.reverse(F.split(text_of(path), "/")), lambda p: p.rlike(r"20\d\d"))
    folder, titled = F.get(folders, F.lit(0)), F.nullif(F.regexp_extract(text_of(title), r"20\d\d", 0), F.lit(""))
    year = F.coalesce(F.nullif(F.regexp_extract(folder, r"20\d\d", 0), F.lit("")), titled).cast("int")
    source = F.when(folder.isNotNull(), F.concat(F.lit("folder:"), folder)).when(titled.isNotNull(), F.lit("title")).otherwise(F.lit("none"))
    return F.struct(year.alias("year"), source.alias("source"))


def held_on(title: Column) -> Column:
    """struct(raw, iso) of `held on 3 Jan 2024`; empty strings without one."""
    # fixed values: the pattern and the months
    pattern = r"(?i)held\s+on\s+(\d{1,2})\s+([A-Za-z]{3})[A-Za-z]*\.?,?\s+(20\d\d)"
    part = lambda k: F.regexp_extract(text_of(title), pattern, k)
    months = F.create_map(*(F.lit(v) for k, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), 1) for v in (m, f"{k:02d}")))
    iso = F.concat_ws("-", part(3), months[F.lower(part(2))], F.lpad(part(1), 2, "0"))
    raw = F.regexp_extract(text_of(title), pattern, 0)
    known = (raw != "") & months[F.lower(part(2))].isNotNull()
    return F.struct(F.when(known, raw).otherwise("").alias("raw"), F.when(known, iso).otherwise("").alias("iso"))


def question_text(concept: Column, tags: Column, prompt: Column, options: Column) -> Column:
    """Label, tags, cleaned prompt and options as one text."""
    return norm_space(F.concat_ws(" ", concept, F.array_join(tags, " "), clean_prompt(prompt), F.array_join(options, " ")))


def all_signals(curated: Column, quotes: Column) -> Column:
    """Curated phrases of several words, then the quoted ones, each once."""
    return F.array_distinct(F.concat(signal_phrases(curated), signal_phrases(quotes)))
