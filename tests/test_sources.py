import json

from pyspark.sql import functions as F

from tessera.sources import files, outline, settings
from tessera.streaming import events


def test_paper_scan(spark, tmp_path):
    (tmp_path / "CGL 2021").mkdir()
    (tmp_path / "state").mkdir()
    paper = {"test_id": "t", "title": "Paper held on 3 Jan 2021", "questions": [{"qid": "a", "n": 1, "options": {"A": "x"}}, {"qid": "b", "n": 2}]}
    (tmp_path / "CGL 2021" / "p.json").write_text(json.dumps(paper))
    (tmp_path / "CGL 2021" / "bad.json").write_text("{")
    (tmp_path / "state" / "q.json").write_text(json.dumps(paper))
    got = files.scan_papers(spark, f"file://{tmp_path}")
    row = got.collect()
    assert [(r["path"], r["year"], r["held_on_iso"]) for r in row] == [("CGL 2021/p.json", 2021, "2021-01-03")]
    kept, dropped = files.in_scope(got, 2022, 2025)
    assert kept.count() == 0 and dropped.first()["reason"] == "year out of range"
    assert [r["ordinal"] for r in files.questions_of(got).orderBy("ordinal").collect()] == [1, 2]


def test_lines_and_documents(spark, tmp_path):
    p = f"file://{tmp_path}/x.jsonl"
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\nnot json\n{"a": 2}\n')
    assert files.read_lines(spark, p, "a int", strict=False).count() == 2
    assert files.read_lines(spark, f"file://{tmp_path}/none", "a int").count() == 0
    files.write_json(spark, f"file://{tmp_path}/d.json", {"é": [1]})
    assert files.read_document(spark, f"file://{tmp_path}/d.json") == {"é": [1]} and files.read_document(spark, "file:///none", 7) == 7
    df = spark.createDataFrame([(1, "b"), (2, None)], "z int, a string")
    files.write_lines(df, f"file://{tmp_path}/out", gzip=True)
    assert files.read_index(spark, "a string, z int", f"file://{tmp_path}/nothing", f"file://{tmp_path}/out.jsonl").count() == 0
    assert spark.read.json(f"file://{tmp_path}/out").columns == ["a", "z"]


def test_index_and_tree(spark, tmp_path):
    df = spark.createDataFrame([(f"q{i}", "AB"[i % 2], f"c{i % 3}") for i in range(12)], "qid string, subject string, chapter string")
    m = files.write_index(df, f"file://{tmp_path}/index", "subject", "qid", 4)
    assert {r["subject"]: (r["records"], r["files"] >= 2) for r in m.collect()} == {"A": (6, True), "B": (6, True)}
    gone = df.filter("qid = 'q0'")
    n = files.write_tree(df, f"file://{tmp_path}/tree", ["subject", "chapter"], gone)
    assert n.agg(F.sum("rows")).first()[0] == 11
    files.write_tree(df.filter("subject = 'A'"), f"file://{tmp_path}/tree", ["subject", "chapter"])
    rows = files.leaf_rows(spark, f"file://{tmp_path}/tree", "qid string")
    assert rows.count() == 12 and files.places(rows).count() == 6


def test_tree_of_null_escaped_and_vanished_values(spark, tmp_path):
    root = f"file://{tmp_path}/tree"
    rows = [("a", None, "x"), ("b", "A/B: c", "x"), ("c", "A/B: c", "y z"), ("d", "plain", None)]
    df = spark.createDataFrame(rows, "qid string, subject string, chapter string")
    read = lambda: sorted(r["qid"] for r in files.leaf_rows(spark, root, "qid string").collect())
    for _ in range(2):  # a second write replaces, whatever the values
        files.write_tree(df, root, ["subject", "chapter"])
        assert read() == ["a", "b", "c", "d"]
    files.write_tree(df.filter("qid = 'b'"), root, ["subject", "chapter"])
    assert read() == ["a", "b", "d"]
    files.write_tree(df.filter("qid in ('a', 'b')"), root, ["subject", "chapter"], whole=True)
    assert read() == ["a", "b"] and all("=" in n for n in files.tree_folders(spark, root))


def test_a_tree_is_whole_wherever_a_writer_stops(spark, tmp_path, monkeypatch):
    """Each call that changes the file system fails in turn: what is read is the tree of before or the new one."""
    root = f"file://{tmp_path}/tree"
    frame = lambda ids: spark.createDataFrame([(q, q[0].upper(), "c") for q in ids], "qid string, subject string, chapter string")
    read = lambda: sorted(r["qid"] for r in files.leaf_rows(spark, root, "qid string").collect())
    files.write_tree(frame(["a1", "b1"]), root, ["subject", "chapter"])
    for name in ("write_json", "delete"):
        whole = getattr(files, name)
        for when in ("before", "after"):
            before, ids = read(), [f"a{name}{when}", f"c{name}{when}"]

            def stop(*args, whole=whole, when=when):
                if when == "after":
                    whole(*args)
                raise OSError("stopped")

            monkeypatch.setattr(files, name, stop)
            try:
                files.write_tree(frame(ids), root, ["subject", "chapter"])
            except OSError:
                pass
            monkeypatch.setattr(files, name, whole)
            after = sorted([q for q in before if q[0] not in "ac"] + ids)
            assert read() in (before, after)
            assert (read() == before) == (name == "write_json" and when == "before")
    files.write_tree(frame(["a9", "c9"]), root, ["subject", "chapter"], whole=True)
    files.write_tree(frame(["a9", "c9"]), root, ["subject", "chapter"], whole=True)
    assert read() == ["a9", "c9"] and len(files.listed(spark, f"{root}/{files.VERSIONS}")) == 2


def test_document_is_replaced_in_one_step(spark, tmp_path):
    p = f"file://{tmp_path}/d.json"
    for value in (1, {"a": 2}):
        files.write_json(spark, p, value)
        assert files.read_document(spark, p) == value
    assert [x.name for x in tmp_path.iterdir() if not x.name.startswith(".")] == ["d.json"]


def test_outline_and_rules(spark, tmp_path):
    (tmp_path / "a.md").write_text("# 1. Algebra\n- [T] Surds\n## Roots\n- Square Roots\n- This is a long sentence that is prose here.\n# Notes\n- lost\n# 2. Ratio\n- Ages\n")
    got = outline.outline(outline.read_lines(spark, f"file://{tmp_path}/a.md"), 1, 30)
    assert [(r["kind"], r["chapter"], r["topic"], r["name"], r["tag"]) for r in got.orderBy("line_no").collect()] == [
        ("chapter", "Algebra", None, "Algebra", None), ("concept", "Algebra", None, "Surds", "T"), ("topic", "Algebra", "Roots", "Roots", None),
        ("concept", "Algebra", "Roots", "Square Roots", None), ("chapter", "Ratio", None, "Ratio", None), ("concept", "Ratio", None, "Ages", None),
    ]
    (tmp_path / "r.md").write_text('## Rule 1: Since and For\n**Topic:** Prepositions\nUse “since” with a point.\n**Examples:**\n- ✗ since two days\n- ✓ for two days\n## Rule 2: Only\nText\n')
    rules = outline.rule_blocks(outline.read_lines(spark, f"file://{tmp_path}/r.md")).orderBy("number").collect()
    assert [(r["number"], r["title"], r["topic"]) for r in rules] == [(1, "Since and For", "Prepositions"), (2, "Only", "")]
    assert rules[0]["quotes"] == ["since"] and rules[0]["wrong"] == ["since two days"] and rules[0]["right"] == ["for two days"]


def test_settings(spark):
    s = settings.load_settings('{"first_year": 2020, "other": 1}', {"TESSERA_LAST_YEAR": "2022", "TESSERA_BATCH_SIZE": "x"})
    assert (s.first_year, s.last_year, s.batch_size) == (2020, 2022, 20) and s.in_range(2021)
    doc = {"exams": [{"code": "E", "kinds": [{"id": "k", "includes": ["a"], "rules": [{"years": None, "spans": [["M", 1, 25]]}]}]}]}
    kinds, rules, spans = settings.layout_tables(spark, doc)
    assert (kinds.count(), rules.count(), spans.first()["end"]) == (1, 1, 25)


def test_stream_replay_and_breaker(spark, tmp_path):
    data = [(i, f"2024-01-0{1 + i // 6} 0{i % 6}:00:00", i % 2, "error" if i % 4 < 3 else "click", 1.0, "{}") for i in range(18)]
    df = spark.createDataFrame(data, "event_id long, t string, user_id long, event_type string, value double, props string")
    df = df.select("event_id", F.col("t").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props")
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = events.read_events(spark, f"{tmp_path}/in", "*.parquet")
    events.replay(events.tumbling(stream, "1 day", "1 hour"), f"{tmp_path}/out", f"{tmp_path}/ck")
    closed = spark.read.parquet(f"{tmp_path}/out").agg(F.sum("events")).first()[0]
    assert closed == 12  # the last day is still open under the watermark
    q = events.breaker(events.read_events(spark, f"{tmp_path}/in", "*.parquet"), limit=2).writeStream.format("memory").queryName("breaker").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r["user_id"] for r in spark.table("breaker").collect()} == {0, 1}


def test_keyed_breaker_waits_for_the_watermark(spark, tmp_path):
    """Rows out of order within the delay count in order of time; later ones than that are dropped."""
    from datetime import datetime, timedelta

    at = lambda s: datetime(2024, 1, 1) + timedelta(seconds=s)
    batches = [
        [(1, at(100), 1, "error"), (3, at(140), 1, "view"), (2, at(120), 1, "error")],  # two errors before the success
        [(4, at(400), 2, "view")],  # the watermark is at 340 after this
        [(5, at(90), 1, "error"), (6, at(370), 1, "error"), (7, at(350), 1, "error")],  # 5 is late
        [(8, at(3000), 2, "view")],
    ]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("event_id long, ts timestamp_ntz, user_id long, event_type string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", events.ROCKSDB)
    try:
        events.replay(events.keyed_breaker(stream, base=60.0, most=3600.0, limit=2, late="60 seconds"), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").filter("user_id = 1").orderBy("events").collect()]
    start = datetime(1970, 1, 1)
    second = lambda s: (at(s) - start).total_seconds()
    # the trip at 120 is undone by the success at 140; that at 370 cools down anew
    assert got == [(1, 3, 0, 0, second(120) + 60), (1, 5, 1, 0, second(370) + 60)]
