"""A deterministic sharded WARC writer, and its reader.

Records are dealt over shards by ranges of the key and the digest, sorted within each, and written by one task a shard: a
file is rolled when its compressed size reaches ROLL. The ranges are cut at quantiles of bytes, counted between places
that a hash samples, so one outlying key, or one key with most rows, does not fill a shard. Record ids, lengths and
digests are made anew from the payload, dates are a parameter, and every record is a gzip member of its own, so equal
input makes equal files, whatever the partitions. A task writes under a name of its own; what it wrote it reports as rows
of a manifest, which is a written table. Only the files of that manifest are then renamed to their final names, and
MANIFEST.json is written last: a folder without it is not a complete archive, and files that lost attempts leave are
never part of it. Renaming twice does nothing.

Of records with equal payloads of at least `revisit_bytes` the one with the smallest key is a response, the others
revisit it. Revisits carry no payload, so they are made from the table of copies, by number, and payloads of copies are
not dealt at all.

Results for odd input: a null payload is an empty one. A null key sorts first in the files, and is larger than all others
where the response is chosen. Rows that are equal in key and payload make a record each, and only one of them is the
response. A null url is urn:key:<key>; characters that a header can't hold are percent-encoded. Very long payloads are
written whole, in memory once. An empty table makes a manifest without files, and an empty result. Other columns are not
written.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import new_path, sized, split_join, stage, unstage

ROLL, SHARD_BYTES, RANGES, DATE = 64 << 20, 32 << 20, 1 << 14, "2024-01-01T00:00:00Z"
#: About what the headers of a record take.
HEADERS = 600
_SPACE = uuid.UUID("6f1c3b0e-5d5e-4a55-9a39-0f2b7a4b9c11")
_MEMBER = 1 << 20
MANIFEST = "shard long, roll int, temporary string, name string, records long, bytes long, sha256 string"


def _files(uri: str):
    return pafs.FileSystem.from_uri(uri)


def record_id(key, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{key}/{digest}')}>"


def record(key, url: str | None, payload: bytes, size: int, digest: str, first, revisit: bool, date: str = DATE) -> bytes:
    """One WARC record as a gzip member. size: of the payload, which a revisit does not hold."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else f"urn:key:{'' if key is None else key}"
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(key, digest)}", f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}", f"X-Record-Key: {'' if key is None else key}",
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(first, digest)}", f"X-Refers-To-Key: {'' if first is None else first}",
        ]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


class _Roll:
    """The files of one shard, rolled by compressed size."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        self.fs, self.root = _files(folder)
        self.shard, self.most, self.roll, self.out, self.rows = shard, roll_bytes, 0, None, []

    def add(self, member: bytes) -> None:
        if self.out is None:
            self.path = f"_temporary/{self.shard:06d}-{self.roll:05d}-{uuid.uuid4().hex}"
            self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
            self.out, self.n, self.size, self.sha = self.fs.open_output_stream(f"{self.root}/{self.path}", compression=None), 0, 0, hashlib.sha256()
        self.out.write(member)
        self.sha.update(member)
        self.n, self.size = self.n + 1, self.size + len(member)
        if self.size >= self.most:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.rows.append((self.shard, self.roll, self.path, f"{self.shard:06d}-{self.roll:05d}.warc.gz", self.n, self.size, self.sha.hexdigest()))
            self.out, self.roll = None, self.roll + 1


def _table(rows, schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _writer(folder: str, roll_bytes: int, date: str):
    schema = pa.schema([("shard", pa.int64()), ("roll", pa.int32()), ("temporary", pa.string()), ("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])

    def write(batches):
        roll, rows = None, []
        for batch in batches:
            payloads = batch.column("payload")
            names = ("shard", "key", "url", "size", "digest", "first", "revisit", "times")
            for k, (shard, key, url, size, digest, first, revisit, times) in enumerate(zip(*(batch.column(c).to_pylist() for c in names), strict=True)):
                if roll is None or roll.shard != shard:
                    if roll:
                        roll.close()
                        rows += roll.rows
                    roll = _Roll(folder, shard, roll_bytes)
                member = record(key, url, payloads[k].as_py() or b"", size, base64.b32encode(bytes.fromhex(digest)).decode(), first, revisit, date)
                for _ in range(times):
                    roll.add(member)
        if roll:
            roll.close()
            rows += roll.rows
        yield _table(rows, schema)

    return write


def _committer(folder: str):
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


def _place(chunk: Column) -> Column:
    """Where a record stands: the key (null first), half of the digest, the chunk of equal revisits; sorts as a string."""
    key = F.expr("lpad(hex(key ^ cast('-9223372036854775808' as bigint)), 16, '0')")
    return F.concat(F.coalesce(key, F.lit("-" * 16)), F.substring("digest", 1, 20), F.lpad(F.hex(chunk.cast("long")), 8, "0"))


def _name() -> Column:
    """Tells records apart that differ in key, payload or url."""
    return F.concat(_place(F.lit(0)), F.substring("digest", 21, 20), F.hex(F.xxhash64(F.col("url").isNull(), "url")))


def _above(place: Column, cuts: list[str]) -> Column:
    """How many of the sorted cuts are not above a place, by halving."""
    if not cuts:
        return F.lit(0)
    table = F.split(F.lit(",".join(cuts)), ",")
    pair = lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi"))

    def halve(a, _):
        mid = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
        right = F.get(table, mid) <= place
        return F.when(a["lo"] >= a["hi"], a).when(right, pair(mid + 1, a["hi"])).otherwise(pair(a["lo"], mid))

    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length()))
    return F.aggregate(steps, pair(F.lit(0), F.lit(len(cuts))), halve)["lo"]


def shard_cuts(weights: DataFrame, shard_bytes: int, ranges: int = RANGES) -> list[str]:
    """Where the shards begin after the first: weights (place, bytes; staged) are summed between places that a hash
    samples, about `ranges` of them whatever the number of rows, and neighbours joined up to shard_bytes."""
    n = weights.count()
    sampled = weights.filter(F.pmod(F.xxhash64("place"), F.lit(max(1, n // ranges))) == 0).select("place").distinct()
    places = sorted(r[0] for r in sampled.collect())
    sums = weights.groupBy(_above(F.col("place"), places).alias("r")).agg(F.sum("bytes").alias("b")).collect()
    cuts, held = [], 0
    for r, b in sorted(tuple(x) for x in sums):
        if held >= shard_bytes and r:
            cuts.append(places[r - 1])
            held = 0
        held += b
    return cuts


def write_warc(rows: DataFrame, folder: str, key: str, url: str, payload: str, revisit_bytes: int = 0, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL, date: str = DATE) -> DataFrame:
    """Writes a record for each row to folder; the staged manifest (MANIFEST) of the files."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = rows.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), body.alias("payload"), F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("size"))
    small = stage(rows.groupBy("key", "url", "digest", "size").agg(F.count("*").alias("c")), "warc-keys")
    able = small.filter(F.col("size") >= revisit_bytes)
    # of each payload the record that is the response: the smallest key (null last), then the smallest url
    who = F.struct(F.col("key").isNull().alias("o"), "key", "url")
    groups = able.groupBy("digest", "size").agg(F.min(who).alias("first"), F.sum("c").alias("n"), F.count("*").alias("w"))
    groups = stage(groups.filter("n > 1").select("digest", "size", "first", "w"), "warc-groups")
    copies = split_join(able, groups, ["digest", "size"], "w", able.count()).withColumn("leads", F.col("first") == who)
    copies = stage(copies.select("key", "url", "digest", "size", "c", F.col("first.key").alias("first"), "leads", _name().alias("name")), "warc-copies")
    # revisits by number: a row for each chunk of equal ones
    most = max(1, shard_bytes // HEADERS)
    again = copies.withColumn("m", F.col("c") - F.col("leads").cast("long")).filter("m > 0")
    again = again.withColumn("chunk", F.explode(F.expr(f"sequence(1L, ceil(m / {most}))")))
    again = again.withColumns({"times": F.least(F.lit(most).cast("long"), F.col("m") - (F.col("chunk") - 1) * most), "place": _place(F.col("chunk"))})
    # payloads: of records that are not copied, and of each group's response, once
    gone = sized(copies.filter("not leads or c > 1").select("name"), 110)
    twice = sized(copies.filter("leads and c > 1").select("name"), 110)
    bodies = rows.withColumn("name", _name())
    first = bodies.join(twice, "name", "left_semi").dropDuplicates(["name"])
    bodies = bodies.join(gone, "name", "left_anti").unionByName(first)
    counted = small.withColumn("name", _name()).join(sized(copies.filter("not leads").select("name"), 110), "name", "left_anti")
    counted = counted.select(_place(F.lit(0)).alias("place"), ((F.col("size") + HEADERS) * F.when(F.col("size") >= revisit_bytes, F.lit(1)).otherwise(F.col("c"))).alias("bytes"))
    weights = stage(counted.unionByName(again.select("place", (F.col("times") * HEADERS).alias("bytes"))), "warc-weights")
    cuts = shard_cuts(weights, shard_bytes)
    cols = ["place", "key", "url", "payload", "size", "digest", "first", "revisit", "times"]
    none = F.lit(None).cast("long")
    bodies = bodies.withColumns({"place": _place(F.lit(0)), "first": none, "revisit": F.lit(False), "times": F.lit(1).cast("long")})
    again = again.withColumns({"payload": F.lit(None).cast("binary"), "revisit": F.lit(True)})
    dealt = bodies.select(*cols).unionByName(again.select(*cols)).withColumn("shard", _above(F.col("place"), cuts).cast("int"))
    dealt = dealt.repartitionById(len(cuts) + 1, "shard").sortWithinPartitions("shard", "place", "revisit", "url").drop("place")
    dealt = dealt.withColumn("shard", F.col("shard").cast("long"))
    manifest = stage(dealt.mapInArrow(_writer(folder, roll_bytes, date), MANIFEST), "warc-manifest")
    manifest.mapInArrow(_committer(folder), MANIFEST).write.format("noop").mode("overwrite").save()
    fs, root = _files(folder)
    fs.create_dir(root, recursive=True)
    totals = manifest.agg(F.count("*"), F.coalesce(F.sum("records"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    with fs.open_output_stream(f"{root}/MANIFEST.json") as out:
        out.write(json.dumps({"files": totals[0], "records": totals[1], "bytes": totals[2], "table": manifest.staged_at}).encode())
    unstage(small, groups, copies, weights)
    return manifest


def members(stream):
    """The gzip members of a stream, unpacked one at a time."""
    unpack, data, parts = zlib.decompressobj(31), stream.read(_MEMBER), []
    while data:
        parts.append(unpack.decompress(data))
        if unpack.eof:
            yield b"".join(parts)
            data, unpack, parts = unpack.unused_data or stream.read(_MEMBER), zlib.decompressobj(31), []
        else:
            data = stream.read(_MEMBER)


def parse(raw: bytes) -> dict:
    """The header fields of a record, `http` (its fields) and `payload`; a response's digests are checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    out = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[: int(out["Content-Length"])]
    if "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode() != out["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {out['WARC-Record-ID']}")
    http, _, out["payload"] = block.partition(b"\r\n\r\n")
    out["http"] = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
    if out["WARC-Type"] == "response" and "sha1:" + base64.b32encode(hashlib.sha1(out["payload"]).digest()).decode() != out["WARC-Payload-Digest"]:
        raise ValueError(f"payload digest of {out['WARC-Record-ID']}")
    return out


def _reader(folder: str):
    schema = pa.schema([("key", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
    whole = lambda x: int(x) if x else None

    def read(batches):
        fs, root = _files(folder)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows = []
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for r in map(parse, members(stream)):
                        rows.append((whole(r["X-Record-Key"]), int(r["http"]["Content-Length"]), r["WARC-Payload-Digest"][5:], r["WARC-Type"], whole(r.get("X-Refers-To-Key"))))
                        if len(rows) >= 10_000:
                            yield _table(rows, schema)
                            rows = []
                yield _table(rows, schema)

    return read


def read_warc(manifest: DataFrame, folder: str) -> DataFrame:
    """key, payload_bytes, payload_digest, record_type, refers_to of every record in the manifest's files."""
    n = max(1, min(manifest.count(), 10_000))
    files = manifest.select("name").repartition(n, "name")
    return files.mapInArrow(_reader(folder), "key long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "warc")
    manifest = write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder, "page_id", "url", "html")
    return read_warc(manifest, folder).withColumnRenamed("key", "page_id")


QUERIES = {"op3_warc": op3_warc}
SQL = {
    "op3_warc": """
WITH d AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS x FROM pages),
h AS (SELECT *, list_transform(range(1, 41), lambda i: strpos('0123456789abcdef', x[i]) - 1) AS n FROM d),
v AS (SELECT *, list_transform(range(0, 8), lambda i: n[5 * i + 1] * 65536 + n[5 * i + 2] * 4096 + n[5 * i + 3] * 256 + n[5 * i + 4] * 16 + n[5 * i + 5]) AS q FROM h),
b AS (SELECT page_id, payload_bytes, x, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((q[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), '') AS payload_digest FROM v),
f AS (SELECT *, min(page_id) OVER (PARTITION BY x, payload_bytes) AS first,
  row_number() OVER (PARTITION BY x, payload_bytes ORDER BY page_id NULLS LAST) AS k FROM b)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN k > 1 THEN first END AS refers_to FROM f"""
}
