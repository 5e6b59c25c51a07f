"""Vector best-fit packing of tokenized documents into sequences.

A sequence has three capacities: tokens, documents, and attention cost (the sum of squared piece lengths). Pieces are
placed from the longest down; each goes to the open sequence that keeps every constraint and whose residual capacity
after it has the least weighted norm, or, with score="dot", whose residual has the largest weighted dot product with the
piece. Pieces that fill a sequence alone are not searched for. The rest are dealt over cells of about CELL pieces, each
packed in a task of its own; the sequences of a cell that stay emptier than REPACK of it are dissolved, and their pieces
packed again in the next round, over fewer cells, until one cell holds what is left. So cells cost no sequences.

Results for odd input: a null or empty text is the end token alone. Rows of one doc_id are documents each on its own. A
null doc_id is an id like others. Very long texts are encoded whole, one row at a time. An empty table gives an empty
result. Other columns are not returned.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import stage
from tessera.llm.components import sorted_groups

CAPACITY, END = 1024, 2
#: The weights of tokens, documents and attention cost, and the other capacities: here they never bind before the tokens.
WEIGHTS = (1.0, 0.001, 0.001)
MOST_DOCS, MOST_COST = CAPACITY, CAPACITY**2
CELL, REPACK, MOST_TASKS = 6000, 0.98, 4096
_ENCODERS: dict = {}
#: The pattern that splits words looks ahead from blanks, and steps back through a long run of them on a stack that ends.
_BLANKS = re.compile(r"\s{1000}")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _encoder(path: str):
    """The tokenizer of a tokenizers file; byte-level BPE with the well-known split runs on tiktoken, several times as fast
    with the same ids. Texts with a long run of blanks are left to the tokenizers library."""
    if path not in _ENCODERS:
        _ENCODERS[path] = _bpe(path) or _plain(path)
    return _ENCODERS[path]


def _plain(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return lambda text: t.encode(text, add_special_tokens=False).ids


def _bpe(path: str):
    import json

    import public_tokenizers
    import tiktoken

    with open(path) as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
        return None
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    byte = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}
    special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
    ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    # merges must rank as the ids do, as tiktoken merges by id
    merged = [ranks[bytes(byte[c] for c in "".join(m if isinstance(m, list) else m.split(" ")))] for m in spec["model"]["merges"]]
    if merged != sorted(merged):
        return None
    enc = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    plain = _plain(path)
    return lambda text: plain(text) if _BLANKS.search(text) else enc.encode(text, allowed_special="all", disallowed_special=())


def _pieces_of(path: str, capacity: int, end: int):
    def pieces(batches):
        encode = _encoder(path)
        for batch in batches:
            rows = [[] for _ in range(6)]
            for k, (doc, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True)):
                ids = np.array([*encode(text.as_py() or ""), end], "<u4")
                cut = len(ids) % capacity or capacity  # the first piece is the one that may be shorter
                at = [0, *range(cut, len(ids), capacity)]
                for p, (i, j) in enumerate(zip(at, [*at[1:], len(ids)], strict=True)):
                    for column, value in zip(rows, (doc, batch.column("__row")[k].as_py(), p, i, j - i, zlib.crc32(ids[i:j])), strict=True):
                        column.append(value)
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names=["doc_id", "row", "piece", "start", "length", "ids_crc32"])

    return pieces


def tokenized(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Staged rows doc_id, row (tells rows of one doc_id apart), piece, start, length, ids_crc32."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("__row"))
    schema = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"
    return stage(rows.mapInArrow(_pieces_of(path, capacity, end), schema), "pieces")


def best_fit(lengths: np.ndarray, capacity, weights, score: str = "norm") -> list[list[int]]:
    """Bins of indices of lengths, which must be in falling order. Bins that can take nothing more are closed."""
    caps = np.array(capacity, float)
    w = np.array(weights, float)
    room = np.empty((len(lengths), 3))  # the open bins' residual capacities, in shares
    ids = np.empty(len(lengths), np.int64)
    n, bins = 0, []
    least = float(lengths[-1]) if len(lengths) else 0.0
    for k, x in enumerate(lengths.tolist()):
        need = np.array([x, 1.0, float(x) * x]) / caps
        if n:
            after = room[:n] - need
            fits = (after >= -1e-9).all(axis=1)
            value = (after * after) @ w if score == "norm" else -((room[:n] * need) @ w)
            value = np.where(fits, value, np.inf)
            best = int(np.argmin(value))
            if fits[best]:
                bins[ids[best]].append(k)
                room[best] = after[best]
                if room[best][0] * caps[0] < least - 1e-6 or room[best][1] * caps[1] < 1 - 1e-6 or room[best][2] * caps[2] < least * least - 1e-3:
                    n -= 1
                    room[best], ids[best] = room[n], ids[n]
                continue
        bins.append([k])
        if caps[0] - x >= least and caps[1] > 1:
            room[n], ids[n] = 1.0 - need, len(bins) - 1
            n += 1
    return bins


def _packer(capacity, weights, score, last: bool):
    def pack(batches):
        for cell, g in sorted_groups(batches, "cell", "row", "piece", "length"):
            order = np.lexsort((g["piece"], g["row"], -g["length"]))
            lengths = g["length"][order]
            bins = best_fit(lengths, capacity, weights, score)
            out = [[] for _ in range(4)]
            for b, members in enumerate(bins):
                full = lengths[members].sum() >= REPACK * capacity[0] or last
                name = int(cell) * (1 << 24) + b if full else -1
                offset = 0
                for m in members:
                    for column, value in zip(out, (g["row"][order[m]], g["piece"][order[m]], name, offset), strict=True):
                        column.append(int(value))
                    offset += int(lengths[m])
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["row", "piece", "bin", "offset"])

    return pack


def pack(pieces: DataFrame, capacity=(CAPACITY, MOST_DOCS, MOST_COST), weights=WEIGHTS, score: str = "norm") -> DataFrame:
    """pieces (staged) with sequence_id and offset."""
    cols = ["doc_id", "row", "piece", "start", "length", "ids_crc32"]
    alone = (F.col("length") >= capacity[0]) | F.lit(capacity[1] <= 1)
    # numbers under 0 for pieces alone, from r * 2**56 for the cells of round r, each with 2**24
    done = pieces.filter(alone).select(*cols, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    todo = pieces.filter(~alone).select(*cols)
    n, rounds, tasks = todo.count(), 0, 2 * todo.sparkSession.sparkContext.defaultParallelism
    while n:
        cells = max(1, -(-n // CELL))
        last = cells == 1 or rounds >= 12
        dealt = todo.withColumn("cell", F.pmod(F.xxhash64(F.lit(rounds), "row", "piece"), F.lit(cells)))
        # a cell takes seconds whatever its few bytes, so partitions are by number and not joined by size
        packed = dealt.repartition(min(cells, max(MOST_TASKS, tasks)), "cell").sortWithinPartitions("cell").select("cell", "row", "piece", "length")
        placed = packed.mapInArrow(_packer(capacity, weights, score, last), "row long, piece int, bin long, offset long")
        placed = stage(todo.join(placed, ["row", "piece"]), "packed")
        whole = placed.filter("bin >= 0").select(*cols, (F.col("bin") + F.lit(rounds << 56)).alias("sequence_id"), "offset")
        done = done.unionByName(whole)
        if last:
            break
        todo = placed.filter("bin < 0").select(*cols)
        n, rounds = todo.count(), rounds + 1
    return done.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def pack_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    return pack(tokenized(docs, vocabulary or default_vocabulary()))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op8_packing": op8_packing}
