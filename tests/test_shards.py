"""The sharded index: equal bytes for any partitioning, commit and abort, the manifest's order and its checks."""

import gzip
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from tessera.sources import shards
from tests.test_operators import shards_by_hand

ROWS = [(i, "MATH" if i % 3 else None if i % 2 else "ENG", "x" * (i * 7 % 90), None if i % 5 else 1.5) for i in range(200)]
SCHEMA = "i int, subject string, t string, m double"


def folder(path):
    return {n: open(f"{path}/{n}", "rb").read() for n in sorted(os.listdir(path)) if not n.startswith((".", "_"))}


@pytest.mark.parametrize("packed", [False, True])
def test_equal_bytes_for_any_partitioning(spark, tmp_path, packed):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for k, rows in enumerate((df.repartition(1), df.repartition(7), df.orderBy(F.desc("i")).coalesce(2))):
        shards.write_shards(rows, f"file://{tmp_path}/{k}", "subject", ["i"], 600, packed)
    found = [folder(tmp_path / str(k)) for k in range(3)]
    assert found[0] == found[1] == found[2] and len(found[0]) > 20
    lines = {i: json.dumps({"i": i, "m": m, "subject": s, "t": t}, separators=(",", ":")) for i, s, t, m in ROWS}
    want = shards_by_hand([(s, i, len(lines[i]) + 1) for i, s, _, _ in ROWS], 600)
    for r in map(json.loads, found[0]["manifest.jsonl"].decode().splitlines()):
        data = found[0][r["name"]]
        assert (len(data), hashlib.sha256(data).hexdigest()) == (r["bytes"], r["sha256"])
        text = gzip.decompress(data) if packed else data
        held = [i for i, s, _, _ in ROWS if s == r["group"] and want[i] == r["shard"]]
        assert text.decode() == "".join(lines[i] + "\n" for i in held) and r["records"] == len(held)


def test_read_in_the_manifests_order(spark, tmp_path):
    root = f"file://{tmp_path}/index"
    df = spark.createDataFrame(ROWS, SCHEMA)
    shards.write_shards(df, root, "subject", ["i"], 500)
    got = shards.read_shards(spark, SCHEMA, root).orderBy("seq").collect()
    order = sorted(ROWS, key=lambda r: (r[1] is not None, r[1] or "", r[0]))
    assert [tuple(r)[:4] for r in got] == order and [r["seq"] for r in got] == list(range(200))
    assert [r["__group"] for r in got] == [r[1] for r in order]
    # a smaller index takes the place of the old one, whose files go
    shards.write_shards(df.filter("i < 20"), root, "subject", ["i"], 500)
    assert shards.read_shards(spark, SCHEMA, root).count() == 20
    assert len(folder(tmp_path / "index")) == shards.manifest(spark, root).count() + 1
    assert not os.listdir(tmp_path / "index/_temporary")


def test_a_missing_or_changed_shard_is_found(spark, tmp_path):
    root = f"file://{tmp_path}/index"
    shards.write_shards(spark.createDataFrame(ROWS, SCHEMA), root, "subject", ["i"], 500)
    name = shards.manifest(spark, root).orderBy("name").first()["name"]
    whole = open(f"{tmp_path}/index/{name}", "rb").read()
    with open(f"{tmp_path}/index/{name}", "wb") as f:
        f.write(whole.replace(b"x", b"y", 1) if b"x" in whole else whole[::-1])
    with pytest.raises(Exception, match="not what the manifest says"):
        shards.read_shards(spark, SCHEMA, root).collect()
    os.remove(f"{tmp_path}/index/{name}")
    with pytest.raises(Exception, match="is missing"):
        shards.read_shards(spark, SCHEMA, root).collect()


def test_fallbacks_in_turn(spark, tmp_path):
    none, lines = f"file://{tmp_path}/none", f"{tmp_path}/old.jsonl"
    assert shards.read_shards(spark, SCHEMA, none).count() == 0
    with open(lines, "w") as f:
        f.write('{"i": 1, "subject": "A"}\n{"i": 2}\n')
    with gzip.open(f"{lines}.gz", "wt") as f:
        f.write('{"i": 9}\n')
    read = lambda *p: [r["i"] for r in shards.read_shards(spark, SCHEMA, none, *p).orderBy("seq").collect()]
    assert read(f"file://{tmp_path}/absent.jsonl", f"file://{lines}", f"file://{lines}.gz") == [1, 2]
    assert read(f"file://{lines}.gz") == [9]


def test_a_failed_write_leaves_the_old_index(spark, tmp_path):
    root = f"file://{tmp_path}/index"
    df = spark.createDataFrame(ROWS, SCHEMA)
    shards.write_shards(df, root, "subject", ["i"], 500)
    before = folder(tmp_path / "index")
    bad = spark.createDataFrame([("a", 1), ("A", 2)], "subject string, i int")
    with pytest.raises(Exception, match="differ in case"):
        shards.write_shards(bad, root, "subject", ["i"], 500)
    assert folder(tmp_path / "index") == before
    assert shards.read_shards(spark, SCHEMA, root).count() == 200


def test_an_empty_index(spark, tmp_path):
    root = f"file://{tmp_path}/index"
    shards.write_shards(spark.createDataFrame([], SCHEMA), root, "subject", ["i"], 500)
    assert shards.read_shards(spark, SCHEMA, root).count() == 0
