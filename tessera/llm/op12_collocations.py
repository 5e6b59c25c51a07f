"""Phrases whose words stand together, from compressed position bitmaps of every word.

Texts are cut into pieces and words and dealt, as they are read, to shards of one language and about SHARD positions; a
piece's end takes a position of its own that no word holds. A shard has a bitmap of positions for each word: written (the
table of `bitmaps`, a row a shard) as the gaps between its positions, packed; in a task as sorted 32-bit positions, or as
the bits themselves where those are shorter. A phrase's bitmap holds the positions of its last word: shifted by one and
ANDed with a word's bitmap it is that of the phrase with the word after it, and popcounts are occurrences. As no bitmap has
a piece's end, no phrase passes it.

A shard extends its phrases depth first, a block of first words at a time, and the popcounts of all shards are summed. Most
pairs of a shard are rare over all, so their popcounts are first summed by a hash of about 32 times as many values as there
are words, packed by ranges of it; a sum is never less than a pair's own, so pairs whose sums are too small are out. The
rest are counted by the pairs themselves, and extended to a third word by pairs that are left too; their words travel
packed. So a bitmap is hardly made that can't count, and every phrase that is frequent is counted in each shard that holds
it.

The AND of a sparse bitmap with the sparse bitmaps of all words is done at once: a position holds one word at most, so the
shifted positions, grouped by the word there, are all the ANDs that aren't empty. Dense ones are ANDed as bits.

Results for odd input: null or empty text has no word. A null lang is `und`, and one with documents that say `und`. Repeated
rows count each. doc_id is not used. A text of any length is read a few megabytes at a time, cut at a piece's end; a piece
is never cut. An empty table gives an empty result. Other columns are not used or returned.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import sized, split_join, stage, unstage

LEAST, TOP, WORDS, SUBSUMED = 10, 2000, 3, 50
#: Positions of a shard; its word lists, bitmaps and positions take about 100 bytes each while it is built.
SHARD = 1 << 21
#: Positions of first words that are extended at once, and bytes of a text that are read at once.
BLOCK, SLICE = 1 << 19, 4 << 20
SALTS = 64
#: Positions whose pairs make one range of hashes.
RANGE = 1 << 22
BITMAPS = "shard long, lang string, words string, counts array<int>, positions long, gaps binary"
_ENDS = ".,;:!?\n\x0b\x0c\r"
#: Ends of pieces become the byte of a full stop, which no word can have, and tabs blanks.
_CLEAN = bytes.maketrans(_ENDS.encode() + b"\t", b"." * len(_ENDS) + b" ")
_END = b"."


def tokens_of(text: str) -> Iterator[list[bytes]]:
    """The words of a text, and an END after each piece, in lists of some megabytes that end with a piece."""
    clean = text.encode().translate(_CLEAN).lower()
    at = 0
    while at < len(clean):
        cut = clean.find(_END, at + SLICE)
        part = clean[at:] if cut < 0 else clean[at:cut]
        at = len(clean) if cut < 0 else cut + 1
        yield [w for w in (part + _END).replace(_END, b" . ").split(b" ") if w]


class Bitmaps:
    """The position bitmaps of a shard's words.

    words: a pyarrow array. place: all words' positions, word after word, each in order; ends: where a word's begin and end
    there. at: the word of each position, -1 where there is none. dense: numbers of the words whose bits are shorter than
    their positions; bits: those bits by number.
    """

    def __init__(self, words: pa.Array, place: np.ndarray, counts: np.ndarray, positions: int):
        self.words, self.place, self.counts, self.positions = words, place, counts, positions
        self.ends = np.concatenate([[0], np.cumsum(counts)])
        # one past the end for the shift of the last position
        self.at = np.full(positions + 1, -1, np.int32)
        self.owner = np.repeat(np.arange(len(words), dtype=np.int32), counts)
        self.at[place] = self.owner
        self.is_dense = counts * 32 >= positions
        self.dense = np.flatnonzero(self.is_dense)
        self.bits = {int(w): to_bits(place[self.ends[w] : self.ends[w + 1]], positions) for w in self.dense}

    @classmethod
    def of(cls, tokens: list[bytes]) -> Bitmaps:
        coded = pa.array(tokens, pa.binary()).dictionary_encode()
        codes, names = coded.indices.to_numpy(), coded.dictionary
        end = pc.index(names, pa.scalar(_END, pa.binary())).as_py()
        order = np.argsort(codes, kind="stable").astype(np.uint32)
        counts = np.bincount(codes, minlength=len(names))
        if end >= 0:
            first = counts[:end].sum()
            order = np.delete(order, slice(first, first + counts[end]))
            counts = np.delete(counts, end)
            names = pa.concat_arrays([names[:end], names[end + 1 :]])
        return cls(names.cast(pa.string()), order, counts, len(tokens))

    def gaps(self) -> np.ndarray:
        """The first position of each word and the gaps to its others."""
        out = np.diff(self.place.astype(np.int64), prepend=0)
        out[self.ends[:-1]] = self.place[self.ends[:-1]]
        return out

    @classmethod
    def loaded(cls, words: str, counts: np.ndarray, positions: int, gaps: bytes) -> Bitmaps:
        gap = unpacked(gaps).astype(np.int64)
        after = np.cumsum(gap)
        first = np.cumsum(counts) - counts
        # what had summed up before a word's first position goes off again
        place = after - np.repeat(after[first] - gap[first], counts)
        return cls(pa.array(words.split(" "), pa.string()), place.astype(np.uint32), counts, positions)

    def blocks(self) -> Iterator[tuple[int, int]]:
        """Ranges of words with about BLOCK positions."""
        cuts = np.unique(np.searchsorted(self.ends, np.arange(0, self.ends[-1] + BLOCK, BLOCK)).clip(0, len(self.words)))
        return zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)

    def extend(self, phrase: np.ndarray, last: np.ndarray, able) -> tuple[np.ndarray, ...]:
        """Shift and AND of sparse bitmaps: phrase numbers with positions of their last words, extended by every word.

        able(phrase, word) says which extensions are wanted. (phrase, word, popcount) of each extension, the number of the
        extension at each of its positions, and the positions.
        """
        after = last + np.uint32(1)
        word = self.at[after]
        keep = word >= 0
        keep[keep] = able(phrase[keep], word[keep])
        phrase, word, after = phrase[keep], word[keep], after[keep]
        key = phrase.astype(np.int64) * len(self.words) + word
        order = np.argsort(key, kind="stable")
        key = key[order]
        starts = _starts(key)
        counts = np.diff(np.concatenate([starts, [len(key)]]))
        found = key[starts]
        return found // len(self.words), found % len(self.words), counts, np.repeat(np.arange(len(starts)), counts), after[order]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(first, second, popcount) of all pairs, by blocks of first words."""
        for i, j in self.blocks():
            part = slice(self.ends[i], self.ends[j])
            sparse = lambda w, v: ~(self.is_dense[w] & self.is_dense[v])
            yield self.extend(self.owner[part], self.place[part], sparse)[:3]
        yield _columns((w, v, popcount(shifted(self.bits[w]) & self.bits[v])) for w in self.bits for v in self.bits)

    def triples(self, first: np.ndarray, second: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(first, second, third, popcount) of all triples whose two pairs are among (first, second); depth first: a block of
        first words is extended to its pairs and those to triples before the next block."""
        if not len(first):
            return
        n = len(self.words)
        wanted = np.unique(first.astype(np.int64) * n + second)

        def among(w, v):
            key = w.astype(np.int64) * n + v
            return wanted[np.searchsorted(wanted, key).clip(max=len(wanted) - 1)] == key

        for i, j in self.blocks():
            part = slice(self.ends[i], self.ends[j])
            w, v, _, pair, last = self.extend(self.owner[part], self.place[part], among)
            all_dense = self.is_dense[w] & self.is_dense[v]
            able = lambda p, x: among(v[p], x) & ~(all_dense[p] & self.is_dense[x])  # noqa: B023, E731
            p, x, count, _, _ = self.extend(pair, last, able)
            yield w[p], v[p], x, count
        dense, chosen = [], set(wanted.tolist())
        for w in self.bits:
            for v in self.bits:
                if w * n + v in chosen:
                    both = shifted(shifted(self.bits[w]) & self.bits[v])
                    dense += [(w, v, x, popcount(both & self.bits[x])) for x in self.bits if v * n + x in chosen]
        yield _columns(dense, 4)

    def phrase(self, *parts: np.ndarray) -> pa.Array:
        taken = [self.words.take(pa.array(p)) for p in parts]
        return pc.binary_join_element_wise(*taken, " ")


def _columns(rows, width: int = 3) -> tuple[np.ndarray, ...]:
    out = np.array([r for r in rows if r[-1]], np.int64).reshape(-1, width)
    return tuple(out.T)


def _starts(key: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))


def to_bits(place: np.ndarray, positions: int) -> np.ndarray:
    held = np.zeros(-(-positions // 64) * 64, np.uint8)
    held[place] = 1
    return np.packbits(held, bitorder="little").view("<u8")


def from_bits(bits: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little")).astype(np.uint32)


def shifted(bits: np.ndarray) -> np.ndarray:
    """Every position one on; what passes the last bit is dropped, since nothing stands there."""
    out = bits << np.uint64(1)
    out[1:] |= bits[:-1] >> np.uint64(63)
    return out


def popcount(bits: np.ndarray) -> int:
    return int(np.bitwise_count(bits).sum())


def _build(shard_positions: int):
    def build(batches):
        held: dict[str, list[bytes]] = {}
        total, made, part = 0, 0, 0

        def flush(lang):
            nonlocal total, made
            tokens = held.pop(lang)
            total -= len(tokens)
            found, made = Bitmaps.of(tokens), made + 1
            if len(found.words):
                row = [(part << 32) + made], [lang], [" ".join(found.words.to_pylist())], [found.counts], [found.positions], [packed(found.gaps())]
                kinds = pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.int64(), pa.binary()
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, kinds, strict=True)], names=["shard", "lang", "words", "counts", "positions", "gaps"])

        for batch in batches:
            texts, part = batch.column("text"), batch.column("part")[0].as_py() if batch.num_rows else part
            for k, lang in enumerate(batch.column("lang").to_pylist()):
                for tokens in tokens_of(texts[k].as_py() or ""):
                    held.setdefault(lang, []).extend(tokens)
                    total += len(tokens)
                    if len(held[lang]) >= shard_positions:
                        yield from flush(lang)
                    elif total >= 2 * shard_positions:  # many languages: the largest goes
                        yield from flush(max(held, key=lambda x: len(held[x])))
        for lang in list(held):
            yield from flush(lang)

    return build


def bitmaps(docs: DataFrame, shard_positions: int = SHARD) -> DataFrame:
    """Staged rows of BITMAPS: a shard each, its words joined by blanks, their popcounts, and their bitmaps one after another."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"), F.spark_partition_id().alias("part"))
    return stage(rows.mapInArrow(_build(shard_positions), BITMAPS), "bitmaps")


def _shards(batches) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each shard, of batches sorted by it."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            if rest and j > i and rest[0].column("shard")[0].as_py() != keys[i]:
                yield rest[0].column("shard")[0].as_py(), pa.Table.from_batches(rest)
                rest = []
            if j > i:
                rest.append(batch.slice(i, j - i))
    if rest:
        yield rest[0].column("shard")[0].as_py(), pa.Table.from_batches(rest)


def _loaded(rows: pa.Table) -> tuple[Bitmaps, str, np.ndarray]:
    """The bitmaps of a shard's row, the language, and a hash of each word."""
    row = rows.slice(0, 1).to_pydict()
    found = Bitmaps.loaded(row["words"][0], np.array(row["counts"][0], np.int64), row["positions"][0], row["gaps"][0])
    seed = zlib.crc32(row["lang"][0].encode())
    return found, row["lang"][0], np.array([xxhash.xxh64_intdigest(w, seed) for w in found.words.to_pylist()], np.uint64)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers, their bytes plane by plane: the high ones are alike."""
    return zstandard.compress(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def pair_hash(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """Of the words' hashes, the pair's among 2 ** bits values."""
    with np.errstate(over="ignore"):
        x = first * np.uint64(0x9E3779B97F4A7C15) + second
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
    return x >> np.uint64(64 - bits) if bits < 64 else x


def _sketch(bits: int, parts: int):
    """For each shard and range of hashes: the hashes there, as steps, and the sums of popcounts."""

    def sketch(batches):
        for shard, rows in _shards(batches):
            found, _, hashes = _loaded(rows)
            chunks = [(pair_hash(hashes[w], hashes[v], bits), n) for w, v, n in found.pairs()]
            key, n = (np.concatenate(x) for x in zip(*chunks, strict=True))
            if not len(key):
                continue
            order = np.argsort(key)
            key, n = key[order], n[order]
            starts = _starts(key)
            key, n = key[starts], np.add.reduceat(n, starts)
            part = key >> np.uint64(bits - parts)
            cuts = _starts(part).tolist()
            out = [(int(part[i]), shard, packed(np.diff(key[i:j], prepend=np.uint64(0))), packed(n[i:j])) for i, j in zip(cuts, [*cuts[1:], len(key)], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["part", "shard", "hashes", "counts"])

    return sketch


def _survivors(least: int):
    """Of each shard's hashes in a range those whose sums over all shards come to least."""

    def choose(batches):
        for _, rows in _shards(b.rename_columns(["shard", "of", "hashes", "counts"]) for b in batches):
            held = [np.cumsum(unpacked(x), dtype=np.uint64) for x in rows["hashes"].to_pylist()]
            counts = np.concatenate([unpacked(x) for x in rows["counts"].to_pylist()])
            known, where = np.unique(np.concatenate(held), return_inverse=True)
            enough = (np.bincount(where, counts, len(known)) >= least)[where]
            ends = np.cumsum([0, *map(len, held)])
            left = [x[enough[i:j]] for x, i, j in zip(held, ends, ends[1:], strict=False)]
            keep = [k for k, x in enumerate(left) if len(x)]
            yield pa.RecordBatch.from_arrays([rows["of"].combine_chunks().take(pa.array(keep, pa.int64())), pa.array([packed(np.diff(left[k], prepend=np.uint64(0))) for k in keep], pa.binary())], names=["shard", "hashes"])

    return choose


def _phrases(bits: int, parts: int, words: int):
    """Popcounts of a shard's phrases, packed by ranges of their hashes."""

    def count(batches):
        for _, rows in _shards(batches):
            chosen, rows = rows["hashes"].drop_null().to_pylist(), rows.filter(pc.is_valid(rows["gaps"]))
            if not chosen or not rows.num_rows:
                continue
            found, lang, hashes = _loaded(rows)
            wanted = np.sort(np.concatenate([np.cumsum(unpacked(x), dtype=np.uint64) for x in chosen]))
            able = []
            for w, v, n in found.pairs():
                key = pair_hash(hashes[w], hashes[v], bits)
                keep = wanted[np.searchsorted(wanted, key).clip(max=len(wanted) - 1)] == key
                able.append((w[keep], v[keep], n[keep], key[keep]))
            first, second, n, key = (np.concatenate(x) for x in zip(*able, strict=True))
            yield _ranged(found, lang, key >> np.uint64(bits - parts), n, first, second)
            if words > 2:
                a, b, c, n = (np.concatenate(x) for x in zip(*found.triples(first, second), strict=True)) if len(first) else [np.empty(0, np.int64)] * 4
                key = pair_hash(pair_hash(hashes[a], hashes[b], 64), hashes[c], bits)
                yield _ranged(found, lang, key >> np.uint64(bits - parts), n, a, b, c)

    return count


def _ranged(found: Bitmaps, lang: str, part: np.ndarray, n: np.ndarray, *words: np.ndarray) -> pa.RecordBatch:
    """A row for each range: its phrases, joined by END, and their popcounts."""
    order = np.argsort(part, kind="stable")
    part, n, starts = part[order], n[order], _starts(part[order])
    offsets = pa.array(np.concatenate([starts, [len(part)]]).astype(np.int32))
    joined = pc.binary_join(pa.ListArray.from_arrays(offsets, found.phrase(*(w[order] for w in words))), _END.decode())
    cuts = [*starts.tolist(), len(part)]
    columns = [
        pa.array(part[starts].astype(np.int64)), pa.array([lang] * len(starts), pa.string()), pa.array([len(words)] * len(starts), pa.int32()),
        pa.array([zstandard.compress(x.encode(), 1) for x in joined.to_pylist()], pa.binary()), pa.array([packed(n[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["part", "lang", "words", "phrases", "counts"])


def _sums(least: int):
    """Of each range the phrases whose popcounts come to least over all shards."""

    def total(batches):
        for _, rows in _shards(b.rename_columns(["shard", *b.schema.names[1:]]) for b in batches):
            tables = []
            for lang, words, phrases, counts in zip(*(rows[c].to_pylist() for c in ("lang", "words", "phrases", "counts")), strict=True):
                held = zstandard.decompress(phrases).decode().split(_END.decode())
                tables.append(pa.table({"lang": pa.array([lang] * len(held), pa.string()), "phrase": pa.array(held, pa.string()), "words": pa.array(np.full(len(held), words, np.int32)), "n": pa.array(unpacked(counts).astype(np.int64))}))
            summed = pa.concat_tables(tables).group_by(["lang", "phrase", "words"]).aggregate([("n", "sum")]).rename_columns(["lang", "phrase", "words", "a"])
            yield from summed.filter(pc.greater_equal(summed["a"], least)).combine_chunks().to_batches()

    return total


def _frequent(counted: DataFrame, least: int) -> DataFrame:
    """Staged lang, phrase, words, a: popcounts summed over shards, from least up."""
    return stage(counted.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("a")).filter(F.col("a") >= least), "phrases")


def phrase_counts(docs: DataFrame, least: int = LEAST, words: int = WORDS, shard_positions: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): staged lang, phrase, words, a for all phrases of 1 to `words` (at most 3) words with least
    occurrences, and lang, n with all word occurrences."""
    if not 1 <= words <= 3:
        raise ValueError("phrases have 1 to 3 words")
    table = bitmaps(docs, shard_positions)
    # a word stands once in a shard, so no word is hotter than the number of shards
    each = table.select("lang", F.explode(F.arrays_zip(F.split("words", " ").alias("phrase"), F.col("counts").alias("n"))).alias("x"))
    each = each.select("lang", "x.phrase", F.lit(1).alias("words"), F.col("x.n").cast("long").alias("n"))
    totals = stage(table.groupBy("lang").agg(F.sum(F.expr("aggregate(counts, 0L, (a, x) -> a + x)")).alias("n")), "totals")
    out = _frequent(each, least)
    if words > 1:
        shards, positions = table.count(), totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        parts, bits = (positions // RANGE).bit_length(), min(62, positions.bit_length() + 5)
        by = lambda df, key, n: df.repartition(max(1, min(n, 1 << 16)), key).sortWithinPartitions(key)
        sketch = table.mapInArrow(_sketch(bits, parts), "part long, shard long, hashes binary, counts binary")
        chosen = by(sketch, "part", 1 << parts).mapInArrow(_survivors(least), "shard long, hashes binary")
        both = by(table.unionByName(chosen, allowMissingColumns=True), "shard", shards)
        ranged = both.mapInArrow(_phrases(bits, parts, words), "part long, lang string, words int, phrases binary, counts binary")
        out = out.unionByName(stage(by(ranged, "part", 1 << parts).mapInArrow(_sums(least), "lang string, phrase string, words int, a long"), "phrases"))
    unstage(table)
    return out, totals


def _part(first: int | Column, last: int | Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, last), " ")


def scored(phrases: DataFrame) -> DataFrame:
    """lang, phrase, a, words, l, r, score of every phrase of two and more words: its lowest-scoring cut, the first of equals.

    Parts are looked up by split_join, since a frequent word is a part of many phrases.
    """
    longer = phrases.filter("words > 1")
    cuts = longer.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    sides = F.array(F.struct(F.lit("l").alias("side"), _part(F.lit(1), F.col("k")).alias("part")), F.struct(F.lit("r").alias("side"), _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("part")))
    asked = stage(cuts.withColumn("s", F.explode(sides)).select("lang", "phrase", "a", "words", "k", "s.side", "s.part"), "parts")
    weight = asked.groupBy("lang", "part").agg(F.count("*").alias("w"))
    table = stage(weight.join(phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f")), ["lang", "part"]), "part-counts")
    got = split_join(asked, table, ["lang", "part"], "w", asked.count())
    side = lambda s: F.max(F.when(F.col("side") == s, F.col("f"))).alias(s)
    whole = got.groupBy("lang", "phrase", "a", "words", "k").agg(side("l"), side("r"))
    # a phrase's count is of 14 digits at most (a hundred terabytes have fewer words), so the products have 38 at most
    exact = lambda c: F.col(c).cast("decimal(14,0)")
    whole = whole.withColumns({"x": F.lit(1_000_000).cast("decimal(7,0)") * exact("a") * exact("a"), "y": exact("l") * exact("r")}).withColumn("score", F.expr("x div y").cast("long"))
    return whole.groupBy("lang", "phrase", "a", "words").agg(F.min(F.struct("score", "k", "l", "r")).alias("b")).select("lang", "phrase", "a", "words", "b.l", "b.r", "b.score")


def subsumed(phrases: DataFrame, share: int = SUBSUMED) -> DataFrame:
    """lang, phrase of those whose words lie together inside a longer phrase that has `share` percent of their count."""
    inner = lambda n: F.transform(F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: _part(i, F.lit(n)))
    held = phrases.filter("words > 2").withColumn("inner", F.explode(F.array_distinct(inner(2))))
    held = held.groupBy("lang", F.col("inner").alias("phrase")).agg(F.max("a").alias("longer"))
    return phrases.filter("words > 1").join(held, ["lang", "phrase"]).filter(F.col("longer") * 100 >= F.col("a") * share).select("lang", "phrase")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, words: int = WORDS, shard_positions: int = SHARD) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best `top` phrases of each language."""
    phrases, totals = phrase_counts(docs, least, words, shard_positions)
    kept = scored(phrases).join(subsumed(phrases), ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # the best of each part first: a language's phrases are never all in one task
    part = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    best = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return best.join(sized(totals, F.octet_length("lang") + 40), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op12_collocations": op12_collocations}
SQL = {
    "op12_collocations": """
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, 'und') AS lang,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT row_number() OVER () AS j, lang, list_filter(string_split(replace(piece, chr(9), ' '), ' '), lambda w: w <> '') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d)),
x AS (SELECT j, lang, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM p),
y AS MATERIALIZED (SELECT lang, x, lead(x) OVER o AS y, lead(x, 2) OVER o AS z FROM x WINDOW o AS (PARTITION BY j ORDER BY i)),
c1 AS MATERIALIZED (SELECT lang, x AS phrase, count(*) AS a, 1 AS k FROM y GROUP BY ALL),
c2 AS MATERIALIZED (SELECT lang, x || ' ' || y AS phrase, count(*) AS a, 2 AS k FROM y WHERE y IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
c3 AS MATERIALIZED (SELECT lang, x || ' ' || y || ' ' || z AS phrase, count(*) AS a, 3 AS k FROM y WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f AS MATERIALIZED (SELECT * FROM c1 UNION ALL SELECT * FROM c2 UNION ALL SELECT * FROM c3),
cuts AS (SELECT lang, phrase, a, k, s[1] AS first_part, array_to_string(s[2:], ' ') AS rest, 1 AS cut FROM (SELECT *, string_split(phrase, ' ') AS s FROM f WHERE k > 1)
  UNION ALL SELECT lang, phrase, a, k, s[1] || ' ' || s[2], s[3], 2 FROM (SELECT *, string_split(phrase, ' ') AS s FROM f WHERE k = 3)),
h AS MATERIALIZED (SELECT q.*, x.a AS l FROM cuts q JOIN f x ON x.lang = q.lang AND x.phrase = q.first_part),
g AS MATERIALIZED (SELECT q.lang, q.phrase, q.a, q.k, q.cut, q.l, y.a AS r, CAST(CAST(1000000 AS HUGEINT) * q.a * q.a // (CAST(q.l AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM h q JOIN f y ON y.lang = q.lang AND y.phrase = q.rest),
b AS (SELECT lang, phrase, a, k, m.l AS l, m.r AS r, m.score AS score FROM (SELECT lang, phrase, a, k, min({'score': score, 'cut': cut, 'l': l, 'r': r}) AS m FROM g GROUP BY ALL)),
inner2 AS (SELECT lang, i AS phrase, max(a) AS longer FROM (SELECT lang, a, unnest([s[1] || ' ' || s[2], s[2] || ' ' || s[3]]) AS i FROM (SELECT *, string_split(phrase, ' ') AS s FROM c3)) GROUP BY ALL),
kept AS (SELECT b.* FROM b LEFT JOIN inner2 s ON b.k = 2 AND s.lang = b.lang AND s.phrase = b.phrase WHERE s.longer IS NULL OR 100 * s.longer < 50 * b.a),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM c1 GROUP BY lang),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT o.lang, o.rank, o.phrase, o.a, o.l, o.r, n.n, o.score FROM o JOIN n ON n.lang = o.lang WHERE o.rank <= 2000"""
}
