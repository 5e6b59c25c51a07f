import random
from functools import reduce

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import audit, hierarchy, ledger, lookup, rank, scoring, sections, state, taxonomy, vocab


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def loop_sections(ns):
    out, last, section = [], None, 0
    for n in ns:
        if not section or n is None or last is None or n <= last:
            section += 1
        out.append(section)
        last = n if n is not None else last
    return out


@pytest.mark.parametrize("seed", range(4))
def test_sections_like_a_loop(spark, seed):
    rng = random.Random(seed)
    ns = [rng.choice([None, 1, 2, 3, 4, 5]) for _ in range(60)]
    df = spark.createDataFrame([(1, i, n) for i, n in enumerate(ns)], "g int, o int, n int")
    got = [r["section"] for r in sections.with_sections(df, ["g"], "o", "n").orderBy("o").collect()]
    assert got == loop_sections(ns)


def test_clean_sections(spark):
    df = spark.createDataFrame([(1, i, n) for i, n in enumerate([1, 2, 3, 1, 2, 1])], "g int, o int, n int")
    assert [(r["size"], r["clean"]) for r in sections.clean_sections(df, ["g"], "o", "n").orderBy("section").collect()] == [(3, True), (2, True), (1, True)]


def test_detected_layout_fills_and_merges(spark):
    data = [("p", 1, 1, None), ("p", 2, 1, "A"), ("p", 3, 2, "A"), ("p", 4, 1, None), ("p", 5, 1, "B"), ("p", 6, 2, "B")]
    df = spark.createDataFrame(data, "g string, o int, n int, s string")
    assert rows_of(sections.detected_layout(df, "g", "o", "n", "s").select("subject", "start", "end"), "start") == [("A", 1, 4), ("B", 5, 6)]


def test_first_span_wins_and_gaps_are_null(spark):
    spans = spark.createDataFrame([("k", "A", 1, 3, 0), ("k", "B", 3, 5, 1)], "kind string, subject string, start int, end int, no int")
    pts = spark.createDataFrame([("k", p) for p in range(1, 8)], "kind string, p int")
    got = sections.at_point(pts, spans, ["kind"], "p", "subject", "no")
    assert [r["subject"] for r in got.orderBy("p").collect()] == ["A", "A", "A", "B", "B", None, None]
    assert "BroadcastNestedLoopJoin" not in got._jdf.queryExecution().executedPlan().toString()


def test_majority_and_verdict(spark):
    v = spark.createDataFrame([("g", "X"), ("g", "X"), ("g", "Y"), ("g", "Y"), ("h", None)], "g string, s string")
    assert [(r["subject"], r["decisive"]) for r in sections.majority(v, ["g"], "s", ["Y", "X"]).collect()] == [("Y", False)]
    f = sections.layout_verdict(F.lit(False), F.lit(None).cast("double"), F.lit(0), F.lit(False))
    assert spark.range(1).select(f.alias("v")).first()["v"] == "canonical-unverified"


def round_robin(buckets):
    lists, out = [list(b) for b in buckets], []
    while any(lists):
        for b in lists:
            if b:
                out.append(b.pop(0))
    return out


@pytest.mark.parametrize("one_task", [0, 1_000_000])
def test_numbers_of_large_groups(spark, monkeypatch, one_task):
    monkeypatch.setattr(rank, "ONE_TASK", one_task)
    rows = [("hot" if i % 10 else None if i % 20 else "cold", (i * 7919) % 4001, i) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, o int, i int")
    got = {(r["g"], r["i"]): (r["k"], r["n"]) for r in rank.numbered(df, ["g"], [F.desc("o"), "i"], "k", "n").collect()}
    want = {}
    for g in ("hot", None, "cold"):
        held = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        want |= {(g, r[2]): (k, len(held)) for k, r in enumerate(held, 1)}
    assert got == want
    assert rank.numbered(df.limit(0), ["g"], ["i"], most=1).count() == 0


def test_round_robin_like_a_loop(spark):
    rng = random.Random(1)
    data = [(rng.choice("ab"), rng.choice([2019, 2020]), i) for i in range(40)]
    df = spark.createDataFrame([(1, *d) for d in data], "g int, exam string, y int, i int")
    buckets = {}
    for d in sorted(data):
        buckets.setdefault(d[:2], []).append(d[2])
    got = [r["i"] for r in rank.round_robin(df, ["g"], ["exam", "y"], ["i"]).orderBy("position").collect()]
    assert got == round_robin([buckets[k] for k in sorted(buckets)])


def test_packs(spark):
    df = spark.createDataFrame([(f"q{i}", "MATH", "E" if i % 2 else "F", 2020 + i % 3, i) for i in range(12)] + [("z", None, "E", 2020, 99)], "qid string, subject string, exam string, y int, i int")
    got = {(r["kind"], r["id"]): r for r in rank.packs(df, {"subject": ["subject"], "exam": ["exam"]}, "qid", ["exam", "y"], ["i"], 5, 3).collect()}
    assert set(got) == {("subject", "math"), ("exam", "e"), ("exam", "f")}
    assert got["subject", "math"]["count"] == 5 and len(set(got["subject", "math"]["items"])) == 5


@pytest.mark.parametrize("n, k", [(10, 3), (7, 7), (5, 9), (100, 13), (1, 1)])
def test_evenly_spaced(spark, n, k):
    df = spark.createDataFrame([(1, i) for i in range(n)], "g int, i int")
    m = min(n, k)
    assert [r["i"] for r in rank.evenly(df, ["g"], ["i"], k).orderBy("i").collect()] == sorted({i * n // m for i in range(m)})


def shards_by_hand(data, most):
    """data: (group, order, size)."""
    out = {}
    for g in {x[0] for x in data}:
        held = shard = 0
        for _, i, n in sorted((x for x in data if x[0] == g), key=lambda x: x[1]):
            n = n or 0
            if held and held + n > most:
                held, shard = 0, shard + 1
            held += n
            out[i] = shard
    return out


@pytest.mark.parametrize("part, fan, sizes", [(200_000, 64, (1, 5, 30, 120)), (7, 3, (1, 5, 30, 120)), (5, 2, (0, 0, 0, 101, 40, None)), (1, 2, (1, 100, 0)), (4, 2, (1,))])
def test_byte_shards_like_a_loop(spark, monkeypatch, part, fan, sizes):
    monkeypatch.setattr(rank, "PART", part)
    monkeypatch.setattr(rank, "FAN", fan)
    rng = random.Random(3)
    data = [("a" if i % 3 else None if i % 2 else "b", i, rng.choice(sizes)) for i in range(300)]
    df = spark.createDataFrame(data, "g string, i int, n long").repartition(3)
    assert {r["i"]: r["shard"] for r in rank.byte_shards(df, "g", ["i"], "n", 100).collect()} == shards_by_hand(data, 100)
    assert rank.byte_shards(df.limit(0), "g", ["i"], "n", 100).count() == 0


def test_joined_blocks_are_their_rows():
    rng = random.Random(9)
    for _ in range(300):
        rows = [rng.choice([0, 1, 7, 60, 140]) for _ in range(rng.randrange(2, 40))]
        cuts = sorted({0, len(rows), *rng.sample(range(1, len(rows)), min(3, len(rows) - 1))})
        parts = [np.array(rows[i:j]) for i, j in zip(cuts, cuts[1:])]
        whole = rank._summary(np.array(rows), 100)
        joined = reduce(lambda a, b: rank._joined(a, b, 100), [rank._summary(p, 100) for p in parts])
        assert all(np.array_equal(x, y) for x, y in zip(whole, joined))
        for held in (0, 1, 50, 100, 140):
            got = rank._passed(whole, np.array([held]), np.array([0]), 100)
            now, n = held, 0
            for s in rows:
                if now and now + s > 100:
                    now, n = 0, n + 1
                now += s
            assert (int(got[0][0]), int(got[1][0])) == (now, n)


def test_distinct_ids_and_modes(spark):
    p = spark.createDataFrame([("k", "a", ["x"]), ("k", "a", ["y"]), ("k", "b", ["z"])], "kind string, id string, key array<string>")
    ids = sorted(r["id"] for r in rank.distinct_ids(p).collect())
    assert ids[0] == "a" and ids[1].startswith("a--") and ids[2] == "b"
    m = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "g int, v string")
    assert rows_of(rank.mode(m, ["g"], "v"), "g") == [(1, "x", 1), (2, "z", 1)]


def test_importance_scale_is_global(spark):
    df = spark.createDataFrame([("S", "c1", 2025), ("S", "c1", 2024), ("S", "c2", 2021), ("T", None, 2025)], "s string, c string, y int")
    n = hierarchy.with_importance(hierarchy.nodes(df, ["s", "c"], "y", 2025))
    got = {(r["level"], r["s"], r["c"]): r for r in n.collect()}
    assert set(got) == {(1, "S", None), (1, "T", None), (2, "S", "c1"), (2, "S", "c2"), (2, "T", None)}
    top = got[1, "S", None]
    assert top["questions"] == 3 and top["last_2y"] == 2 and top["trend"] == 1.0
    assert top["importance"] == pytest.approx(100 * (0.5 + 0.35 + 0.15), abs=1e-4)


def test_subtree_and_trend(spark):
    p = spark.createDataFrame([(["a", "b"],), (["a"],), (["a", "c", "d"],)], "p array<string>")
    got = {"/".join(r["node"]): (r["own"], r["subtree"]) for r in hierarchy.subtree_counts(p, "p").collect()}
    assert got == {"a": (1, 3), "a/b": (1, 1), "a/c": (0, 1), "a/c/d": (1, 1)}


def test_lookups(spark):
    rows = spark.createDataFrame([(1, "Mensuration"), (2, "speed time and distance"), (3, "ratios of time")], "i int, t string")
    names = spark.createDataFrame([(0, "Ratio"), (1, "Time and Distance"), (2, "Time")], "number int, name string")
    assert rows_of(lookup.contained(rows, "i", "t", names).select("i", "name"), "i") == [(2, "Time and Distance"), (3, "Time")]
    assert rows_of(lookup.overlapping(rows, "i", "t", names).select("i", "name"), "i") == [(2, "Time and Distance"), (3, "Time")]
    rules = spark.createDataFrame([(0, "age", "AGES"), (1, "pass", "PASS")], "number int, pattern string, target string")
    t = spark.createDataFrame([(1, "agent"), (2, "a passage")], "i int, t string")
    assert rows_of(lookup.by_pattern_rule(t, "i", "t", rules).select("i", "target"), "i") == [(1, "AGES"), (2, "PASS")]


def test_scoring_decisions(spark):
    w = spark.createDataFrame([(1, "since", 3, False), (2, "since", 3, False), (2, "hard", 1, True), (3, "work", 1, True)], "rule int, term string, weight int, loose boolean")
    stats = spark.createDataFrame([("since", 2), ("hard", 3), ("work", 3)], "term string, rarity int")
    terms = spark.createDataFrame([("q1", "since"), ("q2", "since"), ("q2", "hard"), ("q3", "unknown")], "qid string, term string")
    specific = spark.createDataFrame([(1, 1), (2, 5), (3, 1)], "rule int, terms int")
    s = scoring.score_rules(terms, "qid", terms, w, stats)
    got = {r["qid"]: (r["rule"], r["score"], r["outcome"]) for r in scoring.decide(s, "qid", specific).collect()}
    assert got == {"q1": (1, 6, "ambiguous"), "q2": (2, 9, "matched")}


def test_threshold_takes_the_first_score_from_the_start(spark):
    rng = random.Random(5)
    data = [(float(s), rng.random() < s / 60) for s in range(60)]
    scored = sorted(data, key=lambda x: -x[0])
    want = next((scored[i][0] for i in range(20, 60) if sum(r for s, r in data if s >= scored[i][0]) / sum(s >= scored[i][0] for s, _ in data) >= 0.6), None)
    got = scoring.threshold(spark.createDataFrame(data, "s double, r boolean"), "s", F.col("r"), 0.6).first()["threshold"]
    assert got == want


def test_corrections_are_idempotent_and_never_blank(spark):
    rows = spark.createDataFrame([("a", "x", "index"), ("b", "y", "index")], "k string, v string, source string")
    fixes = spark.createDataFrame([("a", 1, "new"), ("a", 2, " "), ("zz", 3, "q")], "k string, seq int, v string")
    once = state.corrected(rows, fixes, ["k"], ["v"], "seq")
    assert rows_of(once, "k") == [("a", "new", "corrected"), ("b", "y", "index")]
    assert rows_of(state.corrected(once, fixes, ["k"], ["v"], "seq"), "k") == rows_of(once, "k")


def test_state_and_pending(spark, tmp_path):
    path = f"file://{tmp_path}/state"
    assert state.load_state(spark, path, "p") is None
    state.save_state(spark, path, "p", {"version": 1, "done": {"x": 1}, "decisions": {"q": 2}})
    assert state.load_state(spark, path, "p")["done"] == {"x": 1}
    assert state.load_state(spark, path, "p", version=2) == {"version": 2, "decisions": {"q": 2}, "done": {}}
    rows = spark.createDataFrame([(i, "s") for i in range(10)], "qid int, s string")
    done = spark.createDataFrame([], "fingerprint string")
    got = state.judged(rows, 4, ["s"], ["qid"], F.col("qid").cast("string"), done, state.agree_judge, "fingerprint string, qid string, ok boolean, confidence double")
    assert got.count() == 10 and got.select("fingerprint").distinct().count() == 3
    progress = spark.createDataFrame([("p", "running", {"a": 1}, "t0")], "phase string, status string, counters map<string,long>, updated string")
    assert state.record_progress(progress, "p", "done", {"a": 2, "b": 1}, "t1").first()["counters"] == {"a": 3, "b": 1}
    assert state.WorkBudget(0, 1).expired()


def test_ledger(spark):
    raw = spark.createDataFrame([("2024-01-01", "p", "b", "prov", "m", None, 429, 1, "Bearer abcdefgh", [str(i) for i in range(60)], "route", "t")], "ts string, phase string, batch_id string, provider string, model string, kind string, http_status int, attempt int, message string, item_ids array<string>, scope string, task string")
    got = ledger.entries(raw).first()
    assert got["kind"] == "rate_limit" and got["retryable"] and "abcdefgh" not in got["message"] and len(got["item_ids"]) == 50
    out = lambda rows: ledger.outage(spark.createDataFrame(rows, "kind string, scope string, message string")).first()["reason"]
    assert out([("auth", "route", "<html> cloudflare")]) == "all_providers_403_waf" and out([("auth", "route", "x")]) == "all_providers_auth_rejected"
    assert out([("other", "batch", "no healthy route for m")]) == "no_route_for_model" and out([("rate_limit", "route", "busy")]) == "all_providers_rate_limited"
    runs = spark.createDataFrame([(1, i, f) for i, f in enumerate([True, True, False, True, True, True])], "g int, o int, f boolean")
    assert [r["run"] for r in ledger.failure_runs(runs, ["g"], ["o"], F.col("f"), 3).orderBy("o").collect()] == [1, 2, 0, 1, 2, 3]


@pytest.mark.parametrize("broken", [False, True])
def test_audit_rules(spark, broken):
    paths = spark.createDataFrame([(["a", "b"],), ((["c", "c"] if broken else ["c", "d"]),)], "path array<string>")
    leaf = spark.createDataFrame([("q", "l1"), ("q2", "l1"), ("q" if broken else "q3", "l2")], "qid string, leaf string")
    names = spark.createDataFrame([("p", "Verb"), ("p", "verb" if broken else "Noun")], "parent string, name string")
    places = spark.createDataFrame([("l1", False), ("l9", not broken)], "leaf string, marked boolean")
    pages = spark.createDataFrame([(["a", "b" if broken else "x"],)], "path array<string>")
    found = audit.report(
        audit.nested_twice(paths), audit.in_several_places(leaf, ["qid"], "leaf"), audit.differs_by_case(names, ["parent"], "name"),
        audit.empty_and_marked(places, leaf, "leaf", "marked"), audit.page_beside_child(pages, paths),
    )
    assert {r["rule"] for r in found.collect()} == ({"nested_twice", "in_several_places", "differs_by_case", "empty_mark", "page_beside_child"} if broken else set())


def test_taxonomy(spark):
    ch = spark.createDataFrame([("G", "General Science — Physics", 1), ("G", "Scientists", 2)], "subject string, chapter string, number int")
    tp = spark.createDataFrame([("G", "Scientists", "Inventions", 1)], "subject string, chapter string, topic string, number int")
    co = spark.createDataFrame([("G", "Scientists", None, "Physics", 1), ("G", "Scientists", "Inventions", "Radio", 2)], "subject string, chapter string, topic string, concept string, number int")
    moved = {r["concept"]: (r["chapter"], r["via"]) for r in taxonomy.relocated(co, ch, tp).collect()}
    assert moved == {"Physics": ("General Science — Physics", "chapter"), "Radio": ("Scientists", None)}
    sc = taxonomy.scope(ch, tp, co)
    probe = spark.createDataFrame([("G", "General Science — Physics", "physics"), ("G", "Scientists", "Nothing")], "s string, c string, k string")
    assert [r["declared"] for r in taxonomy.declares(probe, sc, "s", "c", "k").orderBy("c").collect()] == [True, False]
    c2, t2 = taxonomy.supplemented(ch, tp, spark.createDataFrame([("G", "scientists", 9), ("G", "New", 10)], ch.schema), spark.createDataFrame([("G", "scientists", "inventions", 1), ("G", "scientists", "Prizes", 2)], tp.schema))
    assert c2.count() == 3 and sorted(r["topic"] for r in t2.collect()) == ["Inventions", "Prizes"]


def test_vocabulary(spark):
    data = [(1, "synonym", "Abandon", ["Leave", "leave", "ABANDON", "Keep"], "Leave", "E", 2020), (2, "synonym", "abandon", ["Desert"], "Desert", "F", 2021)]
    df = spark.createDataFrame(data, "item int, table string, main string, options array<string>, correct string, exam string, year int")
    got = {r["key"]: (r["display"], r["as_main"], r["as_option"], r["as_option_correct"], r["rank"]) for r in vocab.entries(df).collect()}
    assert got["abandon"] == ("Abandon", 2, 0, 0, 1) and got["leave"] == ("Leave", 0, 1, 1, 4) and "keep" in got
    q = spark.createDataFrame([("q", "Synonyms", "Select the synonym of the word.\n\nLucid", [("A", "Clear."), ("B", "None of these")], "A", "E", 2020), ("r", "Maths", "2+2?", [], "A", "E", 2020)], "qid string, labels string, prompt string, options array<struct<label:string,text:string>>, correct string, exam string, year int")
    item = vocab.items(q, "(?i)select|choose", "(?i)options?\\b", "(?i)^none of these$").collect()
    assert [(r["qid"], r["kind"], r["term"], r["options"], r["correct_option"]) for r in item] == [("q", "synonym", "Lucid", ["Clear"], "Clear")]


def test_rules_as_literals_and_joined_agree(spark, monkeypatch):
    paths = spark.createDataFrame([("/EN/a/8",), ("/en/b",), ("/x/",), ("/fr/8",), (None,), ("/en/b",)], "path string")
    kinds = spark.createDataFrame([("en", 1, ["/en/"], []), ("eight", 2, ["/8"], ["/fr/"]), ("any", 3, [], []), ("too", 0, ["/en/"], ["b"])], "kind string, number int, includes array<string>, excludes array<string>")
    blocks = spark.createDataFrame([("/en/", "e"), ("/en/b", "eb"), ("8", "n"), (None, "x")], "key string, block string")
    texts = spark.createDataFrame([(1, "An  Apple"), (2, "pineapple"), (3, "a tin box"), (4, None)], "i int, t string")
    rules = spark.createDataFrame([(5, "tin|box", "metal"), (2, "apple", "fruit"), (9, "an", "word")], "number int, pattern string, target string")

    def found():
        return [sorted(map(repr, d.collect())) for d in (lookup.best_path(paths, "path", kinds), lookup.longest_key(paths, "path", blocks), lookup.by_pattern_rule(texts, "i", "t", rules))]

    literal = found()
    plan = lookup.longest_key(paths, "path", blocks)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan
    monkeypatch.setattr(lookup, "LITERALS", 1)
    assert found() == literal
