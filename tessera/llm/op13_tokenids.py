"""Token ids in files: one zstandard frame a document, a dictionary shared by all, and an index of offsets.

A folder holds `dictionary.zdict`, trained on serialized id arrays of a sample of documents, and files of documents in
ascending order of doc_id. A file is the documents' frames, then its index (doc_ids, offsets of the frames, numbers of ids)
and a trailer of fixed length with the dictionary's SHA-256. So one document is read by its file's trailer and index and one
range of bytes (`fetch`), and a file whose dictionary isn't the folder's is refused. `manifest` is a table of the files in
order with the ids before each; only files that it names count. Files are written under temporary names, in ranges of doc_id
cut by sampling, rolled at ROLL bytes, and renamed once all are written; a task that ran twice leaves a temporary file, which
is deleted.

Ids are written with 2 bytes where the vocabulary has at most 65,536 of them, else with 4. Only the dictionary depends on the
sample (SAMPLE documents, SAMPLE_CHARS of each): it changes sizes, never ids.

Where the vocabulary's file says that tokens never reach over blanks, texts are cut at blanks, and each different word is
encoded by the tokenizers library once, which gives the same ids; else whole texts are encoded.

Results for odd input: a null or empty text is the end id alone. Rows of one doc_id stand side by side, each a document, in an
order by their text's hash; equal rows are alike. A null doc_id is an id like others, before all of them. Very long texts are
encoded whole, one at a time. An empty table makes a folder without files and an empty result. Other columns are not used.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import new_path, stage, unstage

END = 1
#: The sample that the dictionary is trained on, the dictionary's bytes, and the level of compression.
SAMPLE, SAMPLE_CHARS, DICTIONARY, LEVEL = 2000, 32_768, 112_640, 3
ROLL = 128 << 20
#: Words kept with their ids in a worker, the longest of them, and characters that are encoded at once.
KEPT, LONGEST, AT_ONCE = 1 << 20, 64, 8 << 20
MAGIC = b"TOKENIDS"
#: Magic, bytes of an id, offset of the index, documents, ids, the dictionary's SHA-256.
TRAILER = np.dtype([("magic", "S8"), ("width", "<u8"), ("index", "<u8"), ("docs", "<u8"), ("ids", "<u8"), ("dictionary", "V32")])
FILES = "part int, roll int, temporary string, name string, docs long, ids long, bytes long, first long, last long"
_ENCODERS: dict = {}
#: The normalizer and splitter of a tokenizers file under which texts may be cut at blanks.
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLITS = [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
#: Letters that no normal form changes but to lower case, and points after them.
_LATIN = re.compile("([A-Za-zªµºÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")
#: The characters that stand for bytes in a byte-level vocabulary: visible ones for themselves, the rest from 256 on.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SHOWN = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _VISIBLE)}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Serialized ids of texts, with the end id after each. cuts: texts are cut at blanks, and words encoded once and kept.

    A word of Latin letters, with or without points after it, is its letters in lower case, one lookup of the model, and then
    the points: for those the vocabulary's normalizer and splitter do nothing else. Other words go through the whole tokenizer.
    """

    def __init__(self, path: str, end: int = END):
        from tokenizers import Tokenizer

        with open(path, "rb") as f:
            raw = f.read()
        self.tokenizer, spec = Tokenizer.from_str(raw.decode()), json.loads(raw)
        self.kind = np.dtype("<u2" if max(self.tokenizer.get_vocab_size(), end + 1) <= 1 << 16 else "<u4")
        self.end = np.array([end], self.kind).tobytes()
        normal = (spec.get("normalizer") or {}).get("normalizers", [])
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        added = any(re.search(r"\s", x["content"]) or _LATIN.match(x["content"]) or x.get("lstrip") or x.get("rstrip") for x in spec.get("added_tokens", []))
        self.cuts = normal == _NORMAL and pre == _SPLITS and not added
        self.model = self.tokenizer.model
        self.kept: dict[str, bytes] = {"": b"", " ": self.end}

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self._code, x.ids).tobytes() for x in found]

    @property
    def _code(self) -> str:
        return "H" if self.kind.itemsize == 2 else "I"

    def _letters(self, word: str) -> bytes:
        """The ids of Latin letters in lower case."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_SHOWN)
        return array(self._code, [t.id for t in self.model.tokenize(word)]).tobytes()

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of different words."""
        if len(self.kept) > KEPT:
            self.kept = {"": b"", " ": self.end}
        kept, out, rest = self.kept, [], []
        for k, w in enumerate(words):
            ids = kept.get(w)
            if ids is None:
                m = _LATIN.fullmatch(w)
                if m:
                    letters, points = m.groups()
                    letters = letters.lower()
                    ids = kept.get(letters)
                    if ids is None:
                        ids = self._letters(letters)
                        if len(letters) <= LONGEST:
                            kept[letters] = ids
                    if points:
                        if points not in kept:
                            kept[points] = self._whole([points])[0]
                        ids += kept[points]
                else:
                    rest.append(k)
            out.append(ids)
        for k, ids in zip(rest, self._whole([words[k] for k in rest]), strict=True):
            out[k] = ids
            if len(words[k]) <= LONGEST:
                kept[words[k]] = ids
        return out

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        if not self.cuts:
            return [x + self.end for x in self._whole(list(texts))]
        words, ends = [], []
        for t in texts:
            words.extend(t.replace("\n", " ").split(" "))
            ends.append(len(words))
            words.append(" ")  # no word has a blank: this one stands for the end
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        found, codes = self._words(coded.dictionary.to_pylist()), coded.indices.to_numpy()
        ids = np.frombuffer(b"".join(found), self.kind)
        size = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        start, n = (np.cumsum(size) - size)[codes], size[codes]
        after = np.cumsum(n)
        whole = ids[np.repeat(start - (after - n), n) + np.arange(after[-1] if len(after) else 0)]
        cuts = [0, *after[ends].tolist()]
        return [whole[i:j].tobytes() for i, j in zip(cuts, cuts[1:], strict=False)]


def encoder(path: str, end: int = END) -> Encoder:
    if (path, end) not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        _ENCODERS[path, end] = Encoder(path, end)
    return _ENCODERS[path, end]


def _encoded(batches, path: str, end: int) -> Iterator[tuple[list, list[bytes]]]:
    """(doc_ids, serialized ids) of some documents at a time."""
    encode = encoder(path, end).encode
    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
        held, n, first = [], 0, 0
        for k in range(len(ids)):
            held.append(texts[k].as_py() or "")
            n += len(held[-1])
            if n >= AT_ONCE or k + 1 == len(ids):
                yield ids[first : k + 1], encode(held)
                held, n, first = [], 0, k + 1


def train(docs: DataFrame, path: str, end: int = END, sample: int = SAMPLE) -> bytes:
    """A zstandard dictionary for the serialized ids; empty if there is no document."""
    row = F.xxhash64("doc_id", F.monotonically_increasing_id())
    chosen = docs.select("doc_id", F.substring("text", 1, SAMPLE_CHARS).alias("text"), row.alias("h")).orderBy("h").limit(sample).select("doc_id", "text")

    def serialize(batches):
        for _, found in _encoded(batches, path, end):
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["ids"])

    samples = [bytes(r[0]) for r in chosen.mapInArrow(serialize, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few or too short for statistics: their ids as they are
        return b"".join(samples)[-DICTIONARY:]


class Codec:
    """Frames under one dictionary."""

    def __init__(self, dictionary: bytes):
        self.sha = hashlib.sha256(dictionary).digest()
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if data:
            data.precompute_compress(level=LEVEL)
        self.compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=True).compress
        self.decompress = zstandard.ZstdDecompressor(dict_data=data).decompress


def _files(uri: str):
    return pafs.FileSystem.from_uri(uri)


class _File:
    def __init__(self, fs, root: str, part: int, roll: int, codec: Codec, kind: np.dtype):
        self.fs, self.root, self.part, self.roll, self.codec, self.kind = fs, root, part, roll, codec, kind
        self.path = f"_temporary/{part:06d}-{roll:05d}-{uuid.uuid4().hex}"
        fs.create_dir(f"{root}/_temporary", recursive=True)
        self.out, self.docs, self.offsets, self.counts = fs.open_output_stream(f"{root}/{self.path}", compression=None), [], [0], []

    def add(self, doc_id, ids: bytes) -> None:
        frame = self.codec.compress(ids)
        self.out.write(frame)
        self.docs.append(doc_id)
        self.offsets.append(self.offsets[-1] + len(frame))
        self.counts.append(len(ids) // self.kind.itemsize)

    def close(self) -> tuple:
        index = [np.array([d or 0 for d in self.docs], "<i8"), np.array([d is not None for d in self.docs], "<u1"), np.array(self.offsets, "<u8"), np.array(self.counts, "<u8")]
        end = np.array((MAGIC, self.kind.itemsize, self.offsets[-1], len(self.docs), sum(self.counts), self.codec.sha), TRAILER)
        tail = b"".join(x.tobytes() for x in index) + end.tobytes()
        self.out.write(tail)
        self.out.close()
        return self.part, self.roll, self.path, f"{self.part:06d}-{self.roll:05d}.ids", len(self.docs), sum(self.counts), self.offsets[-1] + len(tail), self.docs[0], self.docs[-1]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    fields = [x.split(" ") for x in FILES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[t]) for k, (_, t) in enumerate(fields)], names=[n for n, _ in fields])


def _writer(folder: str, path: str, end: int, dictionary, roll_bytes: int):
    def write(batches):
        (fs, root), codec, kind = _files(folder), Codec(dictionary.value), encoder(path, end).kind
        out, done, part = None, [], None

        def noted():
            nonlocal part
            for batch in batches:
                part = batch.column("part")[0].as_py() if batch.num_rows else part
                yield batch

        for docs, found in _encoded(noted(), path, end):
            for doc_id, ids in zip(docs, found, strict=True):
                out = out or _File(fs, root, part, len(done), codec, kind)
                out.add(doc_id, ids)
                if out.offsets[-1] >= roll_bytes:
                    done.append(out.close())
                    out = None
        yield _rows([*done, out.close()] if out else done)

    return write


def _commit(folder: str):
    def commit(batches):
        fs, root = _files(folder)
        for batch in batches:
            for old, new in zip(batch.column("temporary").to_pylist(), batch.column("name").to_pylist(), strict=True):
                if fs.get_file_info(f"{root}/{old}").type == pafs.FileType.File:
                    fs.move(f"{root}/{old}", f"{root}/{new}")
                elif fs.get_file_info(f"{root}/{new}").type != pafs.FileType.File:
                    raise FileNotFoundError(f"{root}/{new}")
            yield batch

    return commit


def write_ids(docs: DataFrame, folder: str, vocabulary: str | None = None, end: int = END, roll_bytes: int = ROLL) -> DataFrame:
    """Writes the documents' ids to a new folder; its manifest: part, roll, name, docs, ids, before (ids of all documents in
    the files before it), bytes, first and last doc_id."""
    path = vocabulary or default_vocabulary()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    fs, root = _files(folder)
    fs.create_dir(root, recursive=True)
    dictionary = train(rows, path, end)
    with fs.open_output_stream(f"{root}/dictionary.zdict", compression=None) as out:
        out.write(dictionary)
    # ties go by the text's hash; equal rows, of which one range may not hold all, by where they were read
    place = [F.asc_nulls_first("doc_id"), F.col("h"), F.col("r")]
    keyed = rows.withColumns({"h": F.xxhash64("text"), "r": F.monotonically_increasing_id()})
    dealt = keyed.repartitionByRange(*place).sortWithinPartitions(*place).select("doc_id", "text", F.spark_partition_id().alias("part"))
    # a task may hold several ranges: a file's name has its range, not its task
    spark = docs.sparkSession
    written = stage(dealt.mapInArrow(_writer(folder, path, end, spark.sparkContext.broadcast(dictionary), roll_bytes), FILES), "id-files")
    written.mapInArrow(_commit(folder), FILES).write.format("noop").mode("overwrite").save()
    # ids before a file: those of the parts before, a number for each task, and those of its part's files before
    ahead, before = 0, []
    for part, n in sorted(tuple(r) for r in written.groupBy("part").agg(F.sum("ids")).collect()):
        before.append((part, ahead))
        ahead += n
    parts = F.broadcast(spark.createDataFrame(before, "part int, ahead long"))
    earlier = F.sum("ids").over(Window.partitionBy("part").orderBy("roll")) - F.col("ids") + F.col("ahead")
    files = written.join(parts, "part").select("part", "roll", "name", "docs", "ids", earlier.alias("before"), "bytes", "first", "last")
    files.write.parquet(f"{folder}/manifest")
    if fs.get_file_info(f"{root}/_temporary").type == pafs.FileType.Directory:
        fs.delete_dir(f"{root}/_temporary")
    unstage(written)
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("part int, roll int, name string, docs long, ids long, before long, bytes long, first long, last long").parquet(f"{folder}/manifest")


class Opened:
    """A file of ids: its index, and the documents by their places in it."""

    def __init__(self, fs, path: str, codec: Codec):
        self.file, self.codec = fs.open_input_file(path), codec
        size = self.file.size()
        t = np.frombuffer(self.file.read_at(TRAILER.itemsize, size - TRAILER.itemsize), TRAILER)[0]
        if t["magic"] != MAGIC:
            raise ValueError(f"{path} is not a file of token ids")
        if t["dictionary"].tobytes() != codec.sha:
            raise ValueError(f"{path} was written with another dictionary")
        n, at = int(t["docs"]), int(t["index"])
        index = self.file.read_at(size - TRAILER.itemsize - at, at)
        self.docs, has = np.frombuffer(index, "<i8", n), np.frombuffer(index, "<u1", n, 8 * n)
        self.offsets, self.counts = np.frombuffer(index, "<u8", n + 1, 9 * n), np.frombuffer(index, "<u8", n, 17 * n + 8)
        self.nulls, self.kind = int(n - has.sum()), np.dtype(f"<u{t['width']}")

    def ids(self, k: int) -> np.ndarray:
        """The ids of document k, by one read."""
        i, j = int(self.offsets[k]), int(self.offsets[k + 1])
        return np.frombuffer(self.codec.decompress(self.file.read_at(j - i, i)), self.kind)

    def find(self, doc_id: int | None) -> range:
        """The places of the documents with an id; null ones come first."""
        if doc_id is None:
            return range(self.nulls)
        known = self.docs[self.nulls :]
        return range(self.nulls + int(np.searchsorted(known, doc_id)), self.nulls + int(np.searchsorted(known, doc_id, "right")))

    def runs(self, most: int) -> Iterator[tuple[int, list[bytes]]]:
        """(first place, frames) of the documents in order, by reads of about `most` bytes."""
        k = 0
        while k < len(self.counts):
            j = max(k + 1, int(np.searchsorted(self.offsets, self.offsets[k] + np.uint64(most), "right")) - 1)
            data, base = self.file.read_at(int(self.offsets[j] - self.offsets[k]), int(self.offsets[k])), int(self.offsets[k])
            cuts = (self.offsets[k : j + 1].astype(np.int64) - base).tolist()
            yield k, [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            k = j

    def close(self) -> None:
        self.file.close()


def _codec(fs, root: str) -> Codec:
    with fs.open_input_stream(f"{root}/dictionary.zdict", compression=None) as f:
        return Codec(f.read())


def _reader(folder: str, most: int):
    def read(batches):
        fs, root = _files(folder)
        codec = _codec(fs, root)
        for batch in batches:
            for name, before in zip(batch.column("name").to_pylist(), batch.column("before").to_pylist(), strict=True):
                opened = Opened(fs, f"{root}/{name}", codec)
                starts = before + np.concatenate([[0], np.cumsum(opened.counts)[:-1]]).astype(np.int64)
                for k, frames in opened.runs(most):
                    ids = [np.frombuffer(codec.decompress(x), opened.kind).astype("<u4").tobytes() for x in frames]
                    j, place = k + len(ids), np.arange(k, k + len(ids))
                    docs = pa.array(opened.docs[k:j], pa.int64(), mask=place < opened.nulls)
                    yield pa.RecordBatch.from_arrays([docs, pa.array(starts[k:j]), pa.array(opened.counts[k:j].astype(np.int64)), pa.array(ids, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])
                opened.close()

    return read


def read_ids(spark: SparkSession, folder: str, most: int = 1 << 20) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit numbers) of all documents."""
    files = manifest(spark, folder)
    n = max(1, min(files.count(), 100_000))
    return files.select("name", "before").repartition(n, "name").mapInArrow(_reader(folder, most), "doc_id long, start long, n_tokens long, ids binary")


def fetch(spark: SparkSession, folder: str, doc_ids: Sequence[int | None]) -> list[tuple[int | None, list[int]]]:
    """(doc_id, ids) of the documents asked for, by their ranges of bytes alone."""
    fs, root = _files(folder)
    codec, out = _codec(fs, root), []
    for doc_id in doc_ids:
        may = F.col("first").isNull() if doc_id is None else (F.col("first").isNull() | (F.col("first") <= doc_id)) & (F.col("last") >= doc_id)
        for r in manifest(spark, folder).filter(may).orderBy("part", "roll").select("name").collect():
            opened = Opened(fs, f"{root}/{r['name']}", codec)
            out += [(doc_id, opened.ids(k).tolist()) for k in opened.find(doc_id)]
            opened.close()
    return out


def op13_tokenids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "ids")
    write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder)
    return read_ids(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {"op13_tokenids": op13_tokenids}
