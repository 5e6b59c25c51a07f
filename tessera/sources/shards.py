"""An index as shards of JSON lines with a manifest: a deterministic sink with commit and abort, and a reader that the manifest drives.

A group's lines, in order, are cut into shards of bounded bytes (rank.byte_shards), each a file `<group>.<number>.jsonl` or,
compressed, `.jsonl.gz` with one member that has neither a time nor a name; so the same rows make the same bytes, however they
were partitioned. The files are written under temporary names by a Python data source; on success the driver renames them
and replaces `manifest.jsonl`, one line a shard in order (group, shard, name, records, bytes, sha256, before: the records of
all shards before it), in one step; on failure they are deleted and the manifest of before stays. A shard that the new
manifest no longer names is deleted after that.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tessera.operators.rank import byte_shards
from tessera.sources.files import exists, write_document
from tessera.sources.scratch import new_path, written

MANIFEST = "`group` string, shard int, name string, records long, bytes long, sha256 string, before long"
FORMAT = "tessera_shards"


@dataclass
class Written(WriterCommitMessage):
    """(group, shard, temporary name, name, records, bytes, sha256) of the files of a task."""

    files: list


class _Writer(DataSourceArrowWriter):
    """Rows __group, __shard, __line, sorted by group and shard, those of a shard in one task."""

    def __init__(self, uri: str, packed: bool):
        self.uri, self.packed, self.run = uri, packed, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = pafs.FileSystem.from_uri(self.uri)
        fs.create_dir(f"{root}/_temporary/{self.run}", recursive=True)
        done, key, lines = [], None, []

        def close():
            data = "".join(x + "\n" for x in lines).encode()
            data = gzip.compress(data, 6, mtime=0) if self.packed else data
            group = "null" if key[0] is None else quote(key[0].lower(), safe=" ") or "empty"
            name = f"{group}.{key[1] + 1}.jsonl" + (".gz" if self.packed else "")
            temporary = f"_temporary/{self.run}/{uuid.uuid4().hex}"
            with fs.open_output_stream(f"{root}/{temporary}", compression=None) as out:
                out.write(data)
            done.append((*key, temporary, name, len(lines), len(data), hashlib.sha256(data).hexdigest()))

        for batch in iterator:
            for group, shard, line in zip(*(batch.column(c).to_pylist() for c in ("__group", "__shard", "__line")), strict=True):
                if lines and key != (group, shard):
                    close()
                    lines = []
                key = group, shard
                lines.append(line)
        if lines:
            close()
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = pafs.FileSystem.from_uri(self.uri)
        files = sorted((f for m in messages if m for f in m.files), key=lambda f: (f[0] is not None, f[0] or "", f[1]))
        names = [f[3] for f in files]
        if len(set(names)) < len(names):
            self.abort(messages)
            raise ValueError("groups that differ in case alone have files of one name")
        # the new files stand beside the old ones until the manifest names them
        before, lines = 0, []
        for group, shard, temporary, name, records, size, sha in files:
            stored = f"{sha[:16]}-{name}"
            fs.move(f"{root}/{temporary}", f"{root}/{stored}")
            lines.append(json.dumps({"group": group, "shard": shard, "name": stored, "records": records, "bytes": size, "sha256": sha, "before": before}, ensure_ascii=False))
            before += records
        with fs.open_output_stream(f"{root}/_temporary/{self.run}/manifest.jsonl", compression=None) as out:
            out.write("".join(x + "\n" for x in lines).encode())

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = pafs.FileSystem.from_uri(self.uri)
        if fs.get_file_info(f"{root}/_temporary/{self.run}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/_temporary/{self.run}")


class ShardSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        out = _Writer(self.options["path"], self.options.get("gzip") == "true")
        out.run = self.options["run"]
        return out


def write_shards(df: DataFrame, root: str, by: str, order: Sequence[str], most_bytes: int = 8 << 20, packed: bool = False) -> DataFrame:
    """Writes all rows as shards of at most most_bytes of lines (keys sorted, nulls kept), and returns the manifest. Rows are
    in the total order of `order` within a group; packed: gzip."""
    spark = df.sparkSession
    spark.dataSource.register(ShardSink)
    line = F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(df.columns))), {"ignoreNullFields": "false"})
    keys = [F.col(c).alias(f"__o{k}") for k, c in enumerate(order)]
    lines = written(df.select(F.col(by).cast("string").alias("__group"), *keys, line.alias("__line")).withColumn("__bytes", (F.octet_length("__line") + 1).cast("long")), "lines")
    at = [f"__o{k}" for k in range(len(order))]
    cut = byte_shards(lines, "__group", at, "__bytes", most_bytes, "__shard").withColumnRenamed("__group", "__g")
    same = F.col("__group").eqNullSafe(F.col("__g"))
    for c in at:
        same = same & lines[c].eqNullSafe(cut[c])
    dealt = lines.join(cut.drop("__bytes"), same).select("__group", "__shard", *(lines[c] for c in at), "__line")
    dealt = dealt.repartition("__group", "__shard").sortWithinPartitions("__group", "__shard", *at).select("__group", "__shard", "__line")
    run = uuid.uuid4().hex
    old = _names(spark, root)
    dealt.write.format(FORMAT).option("path", root).option("gzip", str(packed).lower()).option("run", run).mode("append").save()
    fs, base = pafs.FileSystem.from_uri(root)
    with fs.open_input_stream(f"{base}/_temporary/{run}/manifest.jsonl", compression=None) as f:
        text = f.read().decode()
    write_document(spark, f"{root}/manifest.jsonl", text)
    fs.delete_dir(f"{base}/_temporary/{run}")
    for name in old - {json.loads(x)["name"] for x in text.splitlines()}:
        fs.delete_file(f"{base}/{name}")
    return manifest(spark, root)


def _names(spark: SparkSession, root: str) -> set[str]:
    return {r["name"] for r in manifest(spark, root).select("name").collect()} if exists(spark, f"{root}/manifest.jsonl") else set()


def manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST).option("mode", "FAILFAST").json(f"{root}/manifest.jsonl")


def _lines(root: str):
    def read(batches):
        fs, base = pafs.FileSystem.from_uri(root)
        for batch in batches:
            for r in batch.to_pylist():
                path = f"{base}/{r['name']}"
                if fs.get_file_info(path).type != pafs.FileType.File:
                    raise FileNotFoundError(f"shard {r['name']} of the manifest is missing")
                with fs.open_input_stream(path, compression=None) as f:
                    data = f.read()
                if len(data) != r["bytes"] or hashlib.sha256(data).hexdigest() != r["sha256"]:
                    raise ValueError(f"shard {r['name']} is not what the manifest says")
                data = gzip.decompress(data) if r["name"].endswith(".gz") else data
                lines = data.decode().split("\n")[:-1]
                if len(lines) != r["records"]:
                    raise ValueError(f"shard {r['name']} is not what the manifest says")
                for i in range(0, len(lines), 10_000):
                    part = lines[i : i + 10_000]
                    n = len(part)
                    columns = [pa.array([r["group"]] * n, pa.string()), pa.array([r["shard"]] * n, pa.int32()), pa.array(range(r["before"] + i, r["before"] + i + n), pa.int64()), pa.array(part, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, names=["__group", "__shard", "seq", "__line"])

    return read


def read_shards(spark: SparkSession, schema: str | StructType, root: str, *fallbacks: str) -> DataFrame:
    """The rows of an index with seq, their number in the manifest's order from 0, and group and shard as __group, __shard.

    Each shard is checked by size and digest as it is read: a missing or changed one is an error. Without a manifest the
    first of the fallbacks that exists is read (JSON lines, gzip by name; seq within it, group and shard null); without any
    the table is empty.
    """
    if exists(spark, f"{root}/manifest.jsonl"):
        files = manifest(spark, root)
        n = max(1, min(files.count(), 100_000))
        raw = files.select("group", "shard", "name", "records", "bytes", "sha256", "before").repartition(n, "name").mapInArrow(_lines(root), "__group string, __shard int, seq long, __line string")
        return raw.select(F.from_json("__line", schema, {"mode": "FAILFAST"}).alias("r"), "seq", "__group", "__shard").select("r.*", "seq", "__group", "__shard")
    none = {"__group": F.lit(None).cast("string"), "__shard": F.lit(None).cast("int")}
    for path in fallbacks:
        if exists(spark, path):
            return spark.read.schema(schema).option("mode", "FAILFAST").json(path).withColumn("seq", F.monotonically_increasing_id()).withColumns(none)
    return spark.createDataFrame([], schema).withColumn("seq", F.lit(0).cast("long")).withColumns(none)


def round_trip(df: DataFrame, by: str, order: Sequence[str], most_bytes: int, packed: bool = False) -> DataFrame:
    """Writes the rows to a new folder of the shared space and reads them back."""
    root = new_path(df.sparkSession, "shards")
    write_shards(df, root, by, order, most_bytes, packed)
    return read_shards(df.sparkSession, df.schema, root)
