"""Phrases in texts, all in one pass: a word-level Aho-Corasick automaton.

A text's words go through an automaton of all phrases; each word moves it once, so what a text costs doesn't grow with the
number of phrases, and a word that many phrases begin with (`the`) makes no candidates. The automaton goes to every task, so
the phrases are counted first: those that take more than MOST bytes are dealt to blocks, with a pass over the texts for each.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of phrases in one automaton; it takes about 20 times as many.
MOST = 4 << 20


class Automaton:
    """Finds phrases, given as words joined by single spaces, in sequences of words."""

    def __init__(self, phrases: Sequence[str]):
        self.number: dict[str, int] = {}
        split = [p.split(" ") for p in phrases]
        for words in split:
            for w in words:
                self.number.setdefault(w, len(self.number))
        self.width = max(1, len(self.number))
        self.step: dict[int, int] = {}
        self.phrase, parent = [-1], [(0, 0)]
        for k, words in enumerate(split):
            state = 0
            for w in words:
                key = state * self.width + self.number[w]
                if key not in self.step:
                    self.step[key] = len(self.phrase)
                    self.phrase.append(-1)
                    parent.append((state, self.number[w]))
                state = self.step[key]
            self.phrase[state] = k
        # children have higher numbers than parents, but fall back to shorter states: by depth
        depth = [0] * len(parent)
        for s in range(1, len(parent)):
            depth[s] = depth[parent[s][0]] + 1
        self.back, self.shorter = [0] * len(parent), [0] * len(parent)
        for s in sorted(range(1, len(parent)), key=depth.__getitem__):
            up, w = parent[s]
            if up:
                self.back[s] = self._after(self.back[up], w)
            b = self.back[s]
            self.shorter[s] = b if self.phrase[b] >= 0 else self.shorter[b]

    def _after(self, state: int, word: int) -> int:
        while state and state * self.width + word not in self.step:
            state = self.back[state]
        return self.step.get(state * self.width + word, 0)

    def found(self, words: Sequence[str]) -> set[int]:
        """The numbers of the phrases that stand in the words."""
        out: set[int] = set()
        state, step, width = 0, self.step, self.width
        for w in map(self.number.get, words):
            if w is None:
                state = 0
                continue
            after = step.get(state * width + w)
            state = self._after(state, w) if after is None else after
            s = state if self.phrase[state] >= 0 else self.shorter[state]
            while s:
                out.add(self.phrase[s])
                s = self.shorter[s]
        return out


_BUILT: dict[int, tuple] = {}


def _finder(shared, row_id: str):
    def find(batches):
        if shared.value[0] not in _BUILT:  # once for each worker and dictionary
            _BUILT.clear()
            _BUILT[shared.value[0]] = Automaton(shared.value[1])
        automaton, names = _BUILT[shared.value[0]], shared.value[1]
        for batch in batches:
            rows, keys = [], []
            for k, text in enumerate(batch.column("__text")):
                for p in automaton.found((text.as_py() or "").split(" ")):
                    rows.append(k)
                    keys.append(names[p])
            yield pa.RecordBatch.from_arrays([batch.column(row_id).take(pa.array(rows, pa.int64())), pa.array(keys, pa.string())], names=[row_id, "key"])

    return find


def phrases_in(rows: DataFrame, row_id: str, text: Column, phrases: DataFrame, key: str = "key", most: int | None = None) -> DataFrame:
    """row_id, key: which phrases stand whole, on word boundaries, in a text; once for each row of rows. Words are what single
    spaces separate; phrases are keys (norm_key), of which empty and null ones are nowhere. A null text has none."""
    spark, most = rows.sparkSession, MOST if most is None else most
    names = phrases.select(F.col(key).alias("key")).filter("key <> ''").distinct()
    size = names.agg(F.sum(F.octet_length("key") + 16)).first()[0] or 0
    blocks = -(-size // most)
    texts = rows.select(row_id, text.alias("__text"))
    schema = texts.schema[row_id]
    found = []
    for b in range(blocks):
        part = names if blocks == 1 else names.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b)
        held = sorted(r[0] for r in part.collect())  # counted: a block's bytes
        shared = spark.sparkContext.broadcast((hash(tuple(held)), held))
        found.append(texts.mapInArrow(_finder(shared, row_id), f"`{row_id}` {schema.dataType.simpleString()}, key string"))
    return reduce(DataFrame.unionByName, found) if found else texts.select(row_id, F.lit("").alias("key")).limit(0)
