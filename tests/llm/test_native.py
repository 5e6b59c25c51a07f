"""Quality rules, line dedup, mixing: brute force, odd rows, plans without Python."""

import hashlib
import re
import random
import struct
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import op1_mixing, op5_lines, op10_quality
from tests.llm.cases import edge_docs, edge_rows, empty_docs, prose, save

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def metrics(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    wins = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    n = Counter(wins)
    covered = {p for i, x in enumerate(wins) if n[x] > 1 for p in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_quality_metrics_and_verdicts(spark, tmp_path):
    rows = op10_quality.op10_quality(spark, save(edge_docs(spark), tmp_path))
    no_python(rows)
    got = sorted((tuple(r) for r in rows.collect()), key=repr)
    want = []
    for r in edge_rows():
        m = metrics(r[1])
        want.append((r[0], *m, m[0] < 20 or 100 * m[4] > 30 * m[0]))
    assert sorted((g[:7] for g in got), key=repr) == sorted(want, key=repr)
    assert all(not g[7] for g in got if g[6])


def test_quality_rejects_what_is_odd_for_its_group(spark, tmp_path):
    clean = [(i, prose(i, 120), "en", "s") for i in range(300)] + [(1000 + i, " ".join(w + "$$" for w in prose(i, 120).split()), "en", "code") for i in range(300)]
    odd = [(2000, " ".join(w + "##%" for w in prose(7, 150).split()), "en", "s"), (2001, "loooooooooooooooooooooooong" + " looooooooooooooooooooooong".join(map(str, range(100))), "en", "s")]
    docs = spark.createDataFrame([(*r, 0) for r in clean + odd], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in op10_quality.quality_filter(docs).collect()}
    assert {r[0] for r in clean} <= kept and not {2000, 2001} & kept


def limits_of(docs, shrink=op10_quality.SHRINK):
    counted = op10_quality.stage(op10_quality.sketches(op10_quality.measure(docs)), "sketches")
    return {(r["__lang"], r["__source"]): r for r in op10_quality.thresholds(counted, shrink).collect()}


def floored(v):
    return v if v < 64 else (v >> (v.bit_length() - 6)) << (v.bit_length() - 6)


def test_quality_limits_like_by_hand(spark):
    # one language, sources of their own distributions and sizes; quantiles are shrunk to the language's
    rows = [(1000 * s + i, " ".join(w + "$" * ((i + k) % (3 * s + 2) == 0) for k, w in enumerate(prose(1000 * s + i, 60 + i % 40).split())), "en", f"s{s}") for s in range(3) for i in range((300, 40, 600)[s])]
    got = limits_of(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    values = defaultdict(list)
    for _, t, _, s in rows:
        n, _, sym, *_ = metrics(t)
        values[s].append(1000 * sym // n)
    at = lambda v, q: floored(sorted(v)[-(-len(v) * q // 1000) - 1])
    every = [x for v in values.values() for x in v]
    for s, v in values.items():
        q = {x: (len(v) * at(v, x) + 200 * at(every, x)) // (len(v) + 200) for x in (500, 900)}
        assert got["en", s]["__hi_sym"] == q[900] + 2 * max(q[900] - q[500], 50)
    assert len({r["__hi_sym"] for r in got.values()}) == 3


def test_quality_limits_differ_by_source(spark):
    got = limits_of(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    by_lang = defaultdict(set)
    for (lang, _), r in got.items():
        by_lang[lang].add((r["__hi_dup"], r["__hi_rep"], r["__hi_mean"], r["__lo_mean"]))
    assert len(got) == 80 and all(len(v) >= 15 for v in by_lang.values())
    assert len({r["__hi_dup"] for r in got.values()}) > 20 and len({r["__hi_rep"] for r in got.values()}) > 20 and sum(r["__hi_rep"] < 300 for r in got.values()) > 70


def test_quality_sketches_merge(spark):
    b = op10_quality.bucket(F.col("id"))
    got = spark.range(0, 5000).select("id", op10_quality.bucket_floor(b).alias("f")).collect()
    assert all(r["f"] <= r["id"] <= r["f"] * 33 / 32 + 1 for r in got) and all(r["f"] == r["id"] for r in got[:64])


def test_quality_salted_join_is_the_same(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, prose(i, 60), "en", f"s{i % 3}") for i in range(90)], "doc_id long, text string, lang string, source string")
    measured = op10_quality.measure(docs)
    limits = op10_quality.stage(op10_quality.thresholds(op10_quality.stage(op10_quality.sketches(measured), "sketches"), 10), "limits")
    plain = sorted((r["doc_id"], r["kept"]) for r in op10_quality.judge(measured, limits).collect())
    monkeypatch.setattr(op10_quality, "BROADCAST_BYTES", -1)
    assert plain == sorted((r["doc_id"], r["kept"]) for r in op10_quality.judge(measured, limits).collect())


def lines_by_hand(rows):
    holders = defaultdict(list)
    for k, (doc, text) in enumerate(rows):
        keys = {x.strip(" \t\n\x0b\x0c\r").translate(LOWER) for x in (text or "").split("\n")}
        for key in keys:
            if len(key) >= 20:
                holders[key].append(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        keep = []
        for x in lines:
            h = holders.get(x.strip(" \t\n\x0b\x0c\r").translate(LOWER), [])
            known = [d for d in h if d is not None]
            if len(h) < 3 or doc == (max(known) if known else None):
                keep.append(x)
        out.append((doc, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_lines_like_by_hand(spark, tmp_path):
    got = op5_lines.op5_lines(spark, save(edge_docs(spark), tmp_path))
    no_python(got)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == lines_by_hand([(r[0], r[1]) for r in edge_rows()])


def test_lines_sql_on_odd_rows(spark, tmp_path):
    folder = save(edge_docs(spark), tmp_path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    rel = con.sql(op5_lines.SQL["op5_lines"])
    at = [rel.columns.index(c) for c in ("doc_id", "n_lines", "n_dropped", "kept_sha256")]
    assert sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr) == lines_by_hand([(r[0], r[1]) for r in edge_rows()])


@pytest.mark.parametrize("batches, fanout", [(1, 2), (5, 2), (4, 4), (3, 9)])
def test_lines_whatever_the_batches(spark, batches, fanout):
    rows = [(i, "\n".join(f"a line that is common number {j}" for j in range(i % 7)) + f"\nown {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = op5_lines.dedup_lines(docs, batches=batches, fanout=fanout)
    want = {d: n for d, _, n, _ in lines_by_hand(rows)}
    assert {r["doc_id"]: r["__n_dropped"] for r in out.collect()} == want


def test_runs_are_compacted(spark):
    store = op5_lines.SortedRuns(spark, buckets=2, fanout=2)
    for b in range(4):
        store.absorb(spark.createDataFrame([(k, k, 10 * b + k) for k in range(3)], "h1 long, h2 long, doc_id long"))
    assert [len(x) for x in store.levels] == [0, 0, 1]
    assert sorted(r["h1"] for r in store.repeated().collect()) == [0, 1, 2]
    store.close()


def targets_by_hand(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        w = sum(weight[s] for s in free)
        share = {s: left * weight[s] / w for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return {s: share.get(s, 3.0 * sizes[s]) for s in names}
        capped |= over


def mix_docs(spark, sources, seed=0):
    rows, k = [], 0
    for s, n in sources.items():
        for _ in range(n):
            rows.append((k, prose(seed + k, 20 + (k * 37) % 200), s))
            k += 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("sources", [{"a": 300, "b": 20, "c": 40, None: 30}, {"x": 5}, {"big": 400, "t1": 1, "t2": 2, "t3": 3, "é": 4}])
def test_mix_meets_targets(spark, sources):
    docs = mix_docs(spark, sources)
    got = op1_mixing.allot(docs).collect()
    sizes, taken, targets = Counter(), Counter(), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        targets[r["source"]] = r["target"]
        assert 0 <= r["copies"] <= 3 and r["source_size"] >= r["size"]
    want = targets_by_hand(sizes)
    assert targets == pytest.approx(want)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 220
    again = op1_mixing.allot(docs.repartition(3)).collect()
    assert sorted((r["doc_id"], r["copies"]) for r in got) == sorted((r["doc_id"], r["copies"]) for r in again)


@pytest.mark.parametrize("others", [50, 12])
def test_mix_makes_up_for_a_long_document(spark, others):
    """One document of 5,000 words among short ones, in many sources: the way it is rounded is one they can make up for."""
    rng = random.Random(others)
    rows = []
    for s in range(24):
        rows += [(s * 1000, " ".join(["w"] * 5000), f"s{s:02}")]
        rows += [(s * 1000 + i, " ".join(["w"] * rng.randrange(80, 220)), f"s{s:02}") for i in range(1, others + 1)]
    got = op1_mixing.allot(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, total, short, target = Counter(), Counter(), Counter(), {}
    for r in got:
        taken[r["source"]] += r["size"] * r["copies"]
        total[r["source"]] += r["size"]
        short[r["source"]] += r["size"] * (r["size"] < 5000)
        target[r["source"]] = r["target"]
    for s in target:
        f = target[s] / total[s] % 1
        # beyond what the short ones can give up or take, whichever way is nearer
        beyond = max(0.0, min(5000 * (1 - f) - f * short[s], 5000 * f - (1 - f) * short[s]))
        assert abs(taken[s] - target[s]) <= beyond + total[s] / (others + 1)


def uniform_by_hand(a, b):
    h = 42
    for raw in (struct.pack("<i", op1_mixing.SEED), struct.pack("<q", a), b):
        h = xxhash.xxh64_intdigest(raw, h)
    return (h - (1 << 64) if h >= 1 << 63 else h) % (1 << 53) / float(1 << 53)


def fold_by_hand(block):
    """block: (h, id, size, mass), sorted. Pairs move mass until one is whole or none; the last is rounded alone."""
    (h, i, s, m), done = block[0], {}
    for xh, xi, xs, xm in block[1:]:
        up, down = min(s - m, xm), min(m, xs - xm)
        rise = up + down <= 0 or uniform_by_hand(h, struct.pack("<q", xh)) * (up + down) < down
        if rise and s - m <= xm:
            done[i], (h, i, s, m) = True, (xh, xi, xs, xm - (s - m))
        elif rise:
            done[xi], m = False, m + xm
        elif m <= xs - xm:
            done[i], (h, i, s, m) = False, (xh, xi, xs, xm + m)
        else:
            done[xi], m = True, m - (xs - xm)
    done[i] = uniform_by_hand(h, struct.pack("<i", 1)) * s < m
    return done


def test_mix_rounding_by_hand(spark):
    # 4000 sources of the same six documents: every step as by hand, every document as often as its fraction says
    parts = [(30.0, 0.2), (200.0, 0.5), (7.0, 0.9), (90.0, 0.45), (50.0, 0.1), (50.0, 0.66)]
    e = F.struct(F.xxhash64("k", "i").alias("h"), (F.col("k") * 10 + F.col("i")).alias("id"), F.col("s"), (F.col("s") * F.col("f")).alias("m"))
    level = spark.createDataFrame([(k, i, s, f) for k in range(4000) for i, (s, f) in enumerate(parts)], "k long, i long, s double, f double")
    level = level.select(F.col("k").cast("string").alias("__s"), F.lit(0).cast("long").alias("block"), e.alias("e"))
    blocks = defaultdict(list)
    for r in level.collect():
        blocks[r["__s"]].append(tuple(r["e"]))
    got = {r["id"]: r["rise"] for r in op1_mixing.reduced(level, 1).collect()}
    assert got == {i: rise for b in blocks.values() for i, rise in fold_by_hand(sorted(b)).items()}
    for i, (_, f) in enumerate(parts):
        rate = sum(got[k * 10 + i] for k in range(4000)) / 4000
        assert abs(rate - f) < 4.5 * (f * (1 - f) / 4000) ** 0.5
    mass = sum(s * f for s, f in parts)
    for k in range(4000):  # all but the last document's rounding keeps the words
        assert abs(sum(s * got[k * 10 + i] for i, (s, _) in enumerate(parts)) - mass) <= 200


def test_mix_equal_rows(spark, monkeypatch):
    # nine rows of ten are one document; they are one unit, and their copies differ by one at most
    monkeypatch.setattr(op1_mixing, "CHUNK", 100)
    rows = [(7, prose(1, 50), "a", i) for i in range(1800)] + [(100 + i, prose(2 + i, 40), "ab"[i % 2], i) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, c long").repartition(7)
    got = op1_mixing.allot(docs).collect()
    assert len(got) == 2000
    taken, target = Counter(), {}
    for r in got:
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 50 for s in target)
    many = Counter(r["copies"] for r in got if r["doc_id"] == 7)
    assert sum(many.values()) == 1800 and max(many) - min(many) <= 1
    mixed = Counter(tuple(r) for r in op1_mixing.mix(docs).collect())
    by_doc = Counter()
    for (doc, _, _, _), n in mixed.items():
        by_doc[doc] += n
    want = Counter()
    for r in got:
        want[r["doc_id"]] += r["copies"]
    assert by_doc == +want and Counter(n for (d, *_), n in mixed.items() if d == 7) == Counter({k: n for k, n in many.items() if k})


def test_mix_many_sources(spark):
    rows = [(i, prose(i, 20 + i % 40), f"host{i % 300:03}") for i in range(900)]
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    got = {r["source"]: r["target"] for r in op1_mixing.allot(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got == pytest.approx(targets_by_hand(sizes))


def test_mix_odd_rows(spark, tmp_path):
    got = op1_mixing.op1_mixing(spark, save(edge_docs(spark), tmp_path))
    no_python(got)
    rows = got.collect()
    assert len(rows) == len(edge_rows()) and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert sum({r["target"]: 1 for r in rows}) == pytest.approx(sum(r["size"] for r in rows), rel=1e-6)
    mixed = op1_mixing.mix(edge_docs(spark))
    copies = op1_mixing.allot(edge_docs(spark)).agg(F.sum("copies")).first()[0]
    assert mixed.columns == edge_docs(spark).columns and mixed.count() == copies


@pytest.mark.parametrize("query", [op1_mixing.op1_mixing, op5_lines.op5_lines, op10_quality.op10_quality])
def test_empty(spark, tmp_path, query):
    assert query(spark, save(empty_docs(spark), tmp_path)).count() == 0


@pytest.mark.parametrize("module", [op5_lines, op10_quality])
def test_sql(spark, module):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    for name, query in module.QUERIES.items():
        df = query(spark, sf)
        rel = con.sql(module.SQL[name])
        at = [rel.columns.index(c) for c in df.columns]
        assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)
