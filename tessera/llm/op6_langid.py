"""Language ID by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is parsed against each: the longest match from
where the last phrase ended is a phrase. Few long phrases mean a close language: the one with the least phrases times
log2 of its reference's length wins, ties to the smaller name. Whole texts are parsed, as many pieces side by side as
numpy steps through at once, each from the state in which the piece before it ends.

The fit is bounded: of each language FIT_DOCS ids whose rows have letters, of any length, those with the smallest hashes
(of rows of one id the first by its letters), and REFERENCE characters of their letters, as equal a share from each as
their lengths allow. A share is taken in pieces from all over the text. Everything else holds for all rows. Held out are
rows whose crc32(doc_id as text) is 0 modulo 5; they are never learned from.

An automaton's transitions are kept in a double array (a state's base plus a symbol is a slot, which names the state it
belongs to): as many slots as transitions, whatever the alphabets. What the driver builds and sends grows with the number
of languages alone, by a few hundred KB for each; nothing bounds that number.

Results for odd input: a null text, and one without a letter, is `und` with score 0, as is every text if no language was
learned. Rows with a null doc_id are not held out, and not learned from either. Repeated rows each get their (equal)
prediction. Very long texts are parsed whole. An empty table gives an empty result. Other columns
are not used or returned.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import held_out

FIT_DOCS, FIT_CHARS, REFERENCE = 64, 20_000, 16_000
PIECE, SIDE = 256, 1 << 14
#: Parts of a language's ids that are ranked apart, whatever the input.
PARTS = 64
_LETTER = regex.compile(r"\p{L}")
#: The same for Spark.
_LETTERS = "\\p{L}"
#: A text longer than its share gives up to SLICES pieces, of at least SLICE letters.
SLICES, SLICE = 16, 120


def letters(text: str) -> str:
    """Lower case, every run of other characters a space."""
    return " ".join(regex.findall(r"\p{L}+", text.lower()))


def automaton(text: str) -> list[dict[str, int]]:
    """The transitions of the suffix automaton; state 0 is the start."""
    nxt, link, length, last = [{}], [-1], [0], 0
    for c in text:
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


class Packed:
    """The transitions of an automaton in a double array, symbols as numbers: from a state by a symbol lead the slot
    base[state] + symbol to nxt, if the slot's check is the state. start: where each symbol leads from state 0."""

    def __init__(self, states: list[dict[int, int]], width: int):
        dead = len(states)  # after a symbol that the reference lacks: a phrase of its own
        first = dict.fromkeys(range(1, width), dead) | states[0] | {0: 0}  # the end of a text begins no phrase
        size = sum(map(len, states)) + 2 * width + 2
        base, check, nxt = np.zeros(dead + 1, np.int32), np.full(size + width, -1, np.int32), np.zeros(size + width, np.int32)
        used = bytearray(size + width)
        low = 0

        def fill(state, at, moves):
            base[state] = at
            for sym, to in moves.items():
                used[at + sym] = 1
                check[at + sym], nxt[at + sym] = state, to

        fill(0, 0, first)
        end = width  # no slot from here on is used
        for state in sorted(range(1, dead), key=lambda k: -len(states[k])):
            moves = states[state]
            if not moves:
                continue
            least = min(moves)
            low = used.find(0, low)
            slot, tries = max(low, least), 0
            while True:
                slot = used.find(0, slot)
                at = slot - least
                if all(not used[at + sym] for sym in moves):
                    break
                slot, tries = slot + 1, tries + 1
                if tries == 64:  # sparse enough behind what is filled
                    slot = max(slot, end)
            end = max(end, at + max(moves) + 1)
            fill(state, at, moves)
            if end + width >= len(used):
                used.extend(bytes(len(used)))
                check, nxt = np.append(check, np.full(len(check), -1, np.int32)), np.append(nxt, np.zeros(len(nxt), np.int32))
        self.base, self.check, self.nxt = base, check[: end + width], nxt[: end + width]
        self.start = np.array([first[k] for k in range(width)], np.int32)

    def step(self, state: np.ndarray, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and where a phrase ended before the symbol."""
        slot = self.base[state] + sym
        miss = self.check[slot] != state
        return np.where(miss, self.start[sym], self.nxt[slot]), miss


class Model:
    """The automata of all languages."""

    def __init__(self, references: dict[str, str]):
        self.langs = sorted(references)
        self.bits = np.array([math.log2(len(references[x]) + 2) for x in self.langs])
        alphabet = sorted({c for x in references.values() for c in x} | {" "})
        # symbol 0: after the end of a text; 1: a character that no reference has
        self.symbol = np.ones(0x110000, np.uint8 if len(alphabet) < 250 else np.int32)
        for k, c in enumerate(alphabet):
            self.symbol[ord(c)] = k + 2
        numbered = lambda moves: {int(self.symbol[ord(c)]): t for c, t in moves.items()}
        self.packed = [Packed([numbered(m) for m in automaton(references[x])], len(alphabet) + 2) for x in self.langs]

    def nbytes(self) -> int:
        return self.symbol.nbytes + sum(a.nbytes for p in self.packed for a in (p.base, p.check, p.nxt, p.start))

    def phrases(self, texts: list[str]) -> np.ndarray:
        """For each text and language the number of phrases.

        Texts are cut into pieces that go side by side. A piece is parsed from the root first, and again from the state that
        the piece before it ends in, until no piece's first state changes: then all is as in one parse of the whole text.
        Parses from different states soon agree, so few pieces are parsed a third time.
        """
        pieces, owner = [], []
        for k, t in enumerate(texts):
            code = self.symbol[np.frombuffer(letters(t).encode("utf-32-le"), "<u4")]
            n = -(-len(code) // PIECE)
            pieces.append(np.pad(code, (0, n * PIECE - len(code))).reshape(n, PIECE))
            owner.append(np.full(n, k))
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        if not pieces:
            return out
        grid, owner = np.concatenate(pieces), np.concatenate(owner)
        follows = np.concatenate([[False], owner[1:] == owner[:-1]])
        last = np.concatenate([owner[1:] != owner[:-1], np.ones(min(1, len(owner)), bool)])
        for lang, packed in enumerate(self.packed):
            first, end, count = (np.zeros(len(grid), np.int32) for _ in range(3))
            todo = np.arange(len(grid))
            while len(todo):
                for i in range(0, len(todo), SIDE):
                    some = todo[i : i + SIDE]
                    state, n = first[some], np.zeros(len(some), np.int32)
                    for sym in np.ascontiguousarray(grid[some].T):
                        state, miss = packed.step(state, sym)
                        n += miss
                    end[some], count[some] = state, n
                wanted = np.where(follows, np.concatenate([[0], end[:-1]]), 0)
                todo = np.flatnonzero(wanted != first)
                first = wanted.astype(np.int32)
            # and the phrase that a text's end broke off
            np.add.at(out[:, lang], owner, count + (last & (end != 0)))
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        live = [k for k, t in enumerate(texts) if t and _LETTER.search(t)] if self.langs else []
        cost = self.phrases([texts[k] for k in live]) * self.bits
        for k, c in zip(live, cost, strict=True):
            order = np.argsort(c, kind="stable")
            names[k] = self.langs[order[0]]
            best, second = c[order[0]], c[order[1]] if len(order) > 1 else math.inf
            scores[k] = 1.0 if math.isinf(second) else float(second / (best + second)) if second else 0.5
        return names, scores


def shares(sizes: list[int], total: int) -> list[int]:
    """How many letters of each text make up total, as equal as the texts' sizes allow."""
    out = [0] * len(sizes)
    for done, k in enumerate(sorted(range(len(sizes)), key=lambda k: sizes[k])):
        out[k] = min(sizes[k], total // (len(sizes) - done))
        total -= out[k]
    return out


def spread(text: str, share: int) -> str:
    """At most share characters: the whole text, or pieces from all over it."""
    if len(text) <= share:
        return text
    n = min(max(share // SLICE, 1), SLICES)
    size = (share + 1) // n - 1  # and a space between two
    starts = [(len(text) - size) * (2 * i + 1) // (2 * n) for i in range(n)]
    return " ".join(text[i : i + size] for i in starts)


def _slices(found: Column) -> Column:
    """A text of at most FIT_CHARS characters as it is, of others SLICES pieces."""
    size = FIT_CHARS // SLICES - 1
    step = (F.length(found) - size) / (2 * SLICES)
    pieces = [F.substring(found, (F.floor(step * (2 * i + 1)) + 1).cast("int"), F.lit(size)) for i in range(SLICES)]
    return F.when(F.length(found) <= FIT_CHARS, found).otherwise(F.concat_ws(" ", *pieces))


def _referenced(reference: int):
    """Rows lang and the sorted letters of its rows as lang and its reference."""

    def made(batches):
        for batch in batches:
            out = []
            for rows in batch.column("rows").to_pylist():
                parts = [letters(r["t"]) for r in rows]
                sizes = shares([len(x) for x in parts], max(reference - len(parts) + 1, 0))
                out.append(" ".join(spread(x, n) for x, n in zip(parts, sizes, strict=True) if n))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(out, pa.string())], names=["lang", "reference"])

    return made


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS, reference: int = REFERENCE) -> Model:
    able = F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike(f"[{_LETTERS}]")
    # only ids are ranked, each once, and within PARTS of a language first: the last ranking sees PARTS * fit_docs of each
    ids = docs.filter(able).select("lang", "doc_id").distinct().withColumn("h", F.xxhash64("doc_id")).withColumn("p", F.pmod("h", F.lit(PARTS)))
    for keys in (["lang", "p"], ["lang"]):
        ids = ids.withColumn("k", F.row_number().over(Window.partitionBy(*keys).orderBy("h", "doc_id"))).filter(F.col("k") <= fit_docs)
    ids = ids.select("lang", "doc_id", "k")
    rows = docs.filter(able).join(F.broadcast(ids), ["lang", "doc_id"])
    rows = rows.select("lang", "k", F.trim(F.regexp_replace("text", f"[^{_LETTERS}]+", " ")).alias("t")).select("lang", "k", _slices(F.col("t")).alias("t"))
    rows = rows.groupBy("lang", "k").agg(F.min("t").alias("t"))
    made = rows.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("k", "t"))).alias("rows"))  # fit_docs rows of FIT_CHARS at most
    found = {r["lang"]: r["reference"] for r in made.mapInArrow(_referenced(reference), "lang string, reference string").collect()}
    return Model({lang: t for lang, t in found.items() if t.strip()})


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        for batch in batches:
            for part in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
                names, scores = shared.value.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(predict, "doc_id long, lang_pred string, score double")


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = identify(docs, fit(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES = {"op6_langid": op6_langid}
