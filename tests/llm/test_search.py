"""Ranked search, phrases and files of token ids: brute force, parts by themselves, round trips."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.fs as pafs
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import op11_lexical, op12_collocations, op13_tokenids
from tests.llm.cases import SCHEMA, edge_docs, edge_rows, empty_docs, prose, save

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# ranked search


def ranked_by_hand(docs, items, k=50):
    """docs: (doc_id, text); items: (item_id, text). Sorted (item_id, rank, doc_id, score)."""
    held = [(d, Counter(TERMS.findall((t or "").translate(LOWER)))) for d, t in docs]
    held = [x for x in held if x[1]]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i] |= set(TERMS.findall((t or "").translate(LOWER)))
    out = []
    for i, terms in asked.items():
        found = []
        for d, c in held:
            m = 50 + (50 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if s > 0:
                found.append((-s, d is not None, d or 0))
        out += [(i, r + 1, d if has else None, -s) for r, (s, has, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


ITEMS = [
    (1, "w1 w2 W3 w4 nowhere"), (2, "the shared LINE of every text"), (3, None), (4, " ,. "), (5, "ÀÉ ß <|endoftext|>"), (6, "a b c d e f g h"), (None, "w1 w2"),
    (7, "one two"), (7, "w9 w10"), (8, "absent words"), (9, " ".join(f"w{i}" for i in range(200))), (10, "w5"), (10, "w5"),
]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("k, entries", [(50, 4_000_000), (3, 700), (1, 1)])
def test_ranked_like_by_hand(spark, k, entries):
    items = spark.createDataFrame([(*x, 1, 2.0) for x in ITEMS], "item_id long, text string, rank int, score double")
    got = rows_of(op11_lexical.search(edge_docs(spark), items, k=k, entries=entries))
    assert got == ranked_by_hand([(r[0], r[1]) for r in edge_rows()], ITEMS, k)


def test_ranked_in_blocks_of_queries(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    terms = op11_lexical.query_terms(items, "item_id", "text")
    parts = op11_lexical.blocks(terms, 600)
    assert len(parts) > 2 and sum(p.count() for p in parts) == terms.count()
    whole = rows_of(op11_lexical.search(edge_docs(spark), items))
    assert rows_of(op11_lexical.search(edge_docs(spark), items, block_bytes=600)) == whole


def test_ranked_of_nothing(spark, tmp_path):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert op11_lexical.search(empty_docs(spark), items).count() == 0
    assert op11_lexical.search(edge_docs(spark), items.limit(0)).count() == 0
    save(edge_docs(spark), tmp_path)
    save(items, tmp_path, "benchmark")
    assert rows_of(op11_lexical.op11_lexical(spark, str(tmp_path))) == ranked_by_hand([(r[0], r[1]) for r in edge_rows()], ITEMS)


def shard_of(rows, vocabulary):
    """rows: (n, {term: count})."""
    starts = np.cumsum([0, *(len(c) for _, c in rows)])
    terms = np.array([t for _, c in rows for t in c], np.int32)
    counts = np.array([v for _, c in rows for v in c.values()], np.int32)
    sizes = np.array([n for n, _ in rows])
    df = Counter(terms.tolist())
    weight = np.array([math.floor(1000 * math.log((2 * len(rows) + 2) / (2 * df[t] + 1))) for t in range(vocabulary)])
    return op11_lexical.Shard(starts, terms, counts, sizes, weight, len(rows), int(sizes.sum()))


def test_threshold_stops_early_and_never_too_early():
    rng = random.Random(3)
    rows = [(100, {t: 1 + rng.randrange(3) for t in rng.sample(range(400), 12)}) for _ in range(20_000)]
    for j in range(60):  # documents that match the query far better than any other
        rows[j * 7] = (40, {0: 30, 1: 25, 2: 20 + j % 4, 3: 9})
    shard = shard_of(rows, 400)
    query, place = np.array([0, 1, 2, 3]), np.arange(len(rows))
    found, scores = shard.search(query, 50, place)
    whole = np.zeros(len(rows), np.int64)
    np.add.at(whole, np.repeat(np.arange(len(rows)), np.diff(shard.starts)), np.where(np.isin(shard.terms, query), shard.impact, 0))
    want = np.lexsort((place, -whole))[:50]
    assert found.tolist() == want.tolist() and scores.tolist() == whole[want].tolist()
    postings = int((shard.lists[query + 1] - shard.lists[query]).sum())
    assert shard.sorted_reads < postings / 3 and shard.random_reads < postings / 3


def test_threshold_meets_all_ties():
    rows = [(10, {0: 1, 1: 1}) for _ in range(3000)] + [(10, {2: 1}) for _ in range(3000)]
    shard = shard_of(rows, 3)
    ids = np.arange(len(rows))[::-1]  # the last row has the smallest id
    found, scores = shard.search(np.array([0, 1]), 50, ids)
    assert found.tolist() == list(range(2999, 2949, -1)) and len(set(scores.tolist())) == 1


# phrases


def phrases_by_hand(rows, least=10, top=2000):
    """rows: (text, lang)."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        able = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = {q for p, a in able.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= 50 * able[q]}
        ranked = []
        for p, a in able.items():
            if p not in gone:
                s, _, l, r = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                ranked.append((-s, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(ranked)[:top])]
    return sorted(out, key=str)


def phrase_rows(seed=5):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["the", "The", "ha", "é", "日本"]
    weights = [1 + 60 // (i + 1) for i in range(len(words))]
    rows = []
    for d in range(120):
        text = "".join(w + rng.choice(["  ", " ", "\t", " ", " ", ". ", "\n", "!", "\x0b"]) for w in rng.choices(words, weights, k=rng.choice([0, 1, 5, 60, 200])))
        rows.append((d, text, rng.choice(["en", "en", "en", "fr", None, "und", ""])))
    return rows + [(1, "ha " * 50, "fr"), (1, "ha " * 50, "fr"), (None, None, "en"), (7, "", "es"), (8, " x y a\x00b a\x00b" * 12, "de")]


@pytest.mark.parametrize("shard", [1 << 21, 300, 1])
def test_phrases_like_by_hand(spark, shard):
    rows = phrase_rows()
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, lang string, phrase string, rank int, n int")
    got = rows_of(op12_collocations.collocations(docs, shard_positions=shard))
    want = phrases_by_hand([r[1:] for r in rows])
    assert got == want and len(want) > 50


def test_tasks_with_several_parts(spark, tmp_path, monkeypatch):
    """Staging joins parts to fewer tasks: shards and files keep their own names."""
    from tessera.llm import common

    monkeypatch.setattr(common, "WAVES", 1)
    rows = phrase_rows(6)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(23)
    assert rows_of(op12_collocations.collocations(docs)) == phrases_by_hand([r[1:] for r in rows])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        op13_tokenids.write_ids(docs, f"file://{tmp_path}/ids")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    got = op13_tokenids.read_ids(spark, f"file://{tmp_path}/ids").sort("start").collect()
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    assert op13_tokenids.manifest(spark, f"file://{tmp_path}/ids").count() > 15


def test_phrases_of_edge_rows_and_nothing(spark, tmp_path):
    rows = edge_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for least, top in ((10, 2000), (2, 7)):
        assert rows_of(op12_collocations.collocations(docs, least=least, top=top)) == phrases_by_hand([(r[1], r[2]) for r in rows], least, top)
    assert op12_collocations.collocations(empty_docs(spark)).count() == 0
    save(docs, tmp_path)
    assert rows_of(op12_collocations.op12_collocations(spark, str(tmp_path))) == phrases_by_hand([(r[1], r[2]) for r in rows])


def test_long_texts_are_cut_at_pieces(monkeypatch):
    text = "".join(f"a{i} B{i}" + ".  \t"[i % 4] + " ,"[i % 2] for i in range(3000))
    whole = [w for part in op12_collocations.tokens_of(text) for w in part]
    monkeypatch.setattr(op12_collocations, "SLICE", 50)
    parts = list(op12_collocations.tokens_of(text))
    assert len(parts) > 100 and all(p[-1] == b"." for p in parts)
    assert [w for p in parts for w in p] == whole


def test_bitmaps_are_the_positions():
    rng = random.Random(1)
    tokens = [rng.choice([b"a", b"a", b"b", b".", b"c%d" % rng.randrange(60)]) for _ in range(5000)]
    found = op12_collocations.Bitmaps.of(tokens)
    names = found.words.to_pylist()
    assert len(found.dense) >= 2 and len(found.dense) < len(names)
    found = op12_collocations.Bitmaps.loaded(" ".join(names), found.counts, found.positions, op12_collocations.packed(found.gaps()))
    for k, w in enumerate(names):
        place = [i for i, t in enumerate(tokens) if t == w.encode()]
        assert found.place[found.ends[k] : found.ends[k + 1]].tolist() == place
        assert k not in found.bits or op12_collocations.from_bits(found.bits[k]).tolist() == place
        assert (k in found.bits) == (4 * len(place) >= len(tokens) / 8)
    pairs = Counter((names[w], names[v]) for w, v, n in (x for p in found.pairs() for x in zip(*p, strict=True)) for _ in range(n))
    want = Counter((a.decode(), b.decode()) for a, b in zip(tokens, tokens[1:]) if b"." not in (a, b))
    assert pairs == want
    index = {w: k for k, w in enumerate(names)}
    able = [p for p, n in want.items() if n >= 5]
    first, second = (np.array([index[p[k]] for p in able]) for k in (0, 1))
    triples = Counter({tuple(names[x] for x in t[:3]): t[3] for p in found.triples(first, second) for t in zip(*p, strict=True)})
    all3 = Counter((a.decode(), b.decode(), c.decode()) for a, b, c in zip(tokens, tokens[1:], tokens[2:]) if b"." not in (a, b, c))
    assert triples == Counter({t: n for t, n in all3.items() if want[t[:2]] >= 5 and want[t[1:]] >= 5})


@given(st.sets(st.integers(0, 399), min_size=1), st.integers(400, 500))
@settings(max_examples=60, deadline=None)
def test_shift_and_popcount(place, positions):
    bits = op12_collocations.to_bits(np.array(sorted(place)), positions)
    assert op12_collocations.from_bits(bits).tolist() == sorted(place)
    assert op12_collocations.popcount(bits) == len(place)
    assert op12_collocations.from_bits(op12_collocations.shifted(bits)).tolist() == sorted(p + 1 for p in place)


def test_exact_scores_beyond_64_bits(spark):
    big = 9 * 10**13
    rows = [("en", "a", big, 1), ("en", "b", big + 7, 1), ("en", "a b", big - 1, 2)]
    got = op12_collocations.scored(spark.createDataFrame(rows, "lang string, phrase string, a long, words int")).first()
    assert got["score"] == 10**6 * (big - 1) ** 2 // (big * (big + 7)) and (got["l"], got["r"]) == (big, big + 7)


# files of token ids


def ids_by_hand(rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(op13_tokenids.default_vocabulary())
    return [(d, [*t.encode(x or "", add_special_tokens=False).ids, 1]) for d, x in rows]


def read_back(df):
    got = sorted((tuple(r) for r in df.collect()), key=lambda r: r[1])
    return [(r["doc_id"], r["start"], r["n_tokens"], np.frombuffer(bytes(r["ids"]), "<u4").tolist()) for r in df.sort("start").collect()] if "ids" in df.columns else got


@pytest.mark.parametrize("roll", [128 << 20, 4000])
def test_ids_round_trip(spark, tmp_path, roll):
    rows = [(r[0], r[1]) for r in edge_rows()] + [(500 - i, prose(i, 30 + i)) for i in range(60)]
    docs = spark.createDataFrame([(*r, 9, "x") for r in rows], "doc_id long, text string, start long, ids string").repartition(5)
    folder = f"file://{tmp_path}/ids"
    files = op13_tokenids.write_ids(docs, folder, roll_bytes=roll)
    got = read_back(op13_tokenids.read_ids(spark, folder, 3000))
    assert sorted(((d, i) for d, _, _, i in got), key=str) == sorted(ids_by_hand(rows), key=str)
    keys = [(d is not None, d or 0) for d, *_ in got]
    assert keys == sorted(keys)
    at = 0
    for _, start, n, ids in got:
        assert (start, n) == (at, len(ids))
        at += n
    assert files.count() > (3 if roll == 4000 else 0)
    assert files.agg(F.sum("docs"), F.sum("ids")).first() == (len(rows), at)
    assert not (tmp_path / "ids/_temporary").exists()
    asked = [9, None, 470, 123_456]
    want = [x for a in asked for x in sorted((v for v in ids_by_hand(rows) if v[0] == a), key=str)]
    assert sorted(op13_tokenids.fetch(spark, folder, asked), key=str) == sorted(want, key=str)


def test_ids_query(spark, tmp_path):
    save(edge_docs(spark), tmp_path)
    got = sorted((tuple(r) for r in op13_tokenids.op13_tokenids(spark, str(tmp_path)).collect()), key=lambda r: r[1])
    want = ids_by_hand([(r[0], r[1]) for r in edge_rows()])
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted(((r[0], r[2], r[3]) for r in got), key=str) == sorted(((d, len(i), crc(i)) for d, i in want), key=str)
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got)])[:-1].tolist()
    save(empty_docs(spark), tmp_path / "none")
    assert op13_tokenids.op13_tokenids(spark, str(tmp_path / "none")).count() == 0


def test_another_dictionary_is_refused(spark, tmp_path):
    docs = spark.createDataFrame([(i, prose(i, 50)) for i in range(40)], "doc_id long, text string")
    folder = f"file://{tmp_path}/ids"
    op13_tokenids.write_ids(docs, folder)
    fs, root = pafs.FileSystem.from_uri(folder)
    with fs.open_output_stream(f"{root}/dictionary.zdict", compression=None) as f:
        f.write(b"another dictionary of some length")
    with pytest.raises(Exception, match="another dictionary"):
        op13_tokenids.read_ids(spark, folder).collect()


def test_the_dictionary_helps_short_documents():
    encode = op13_tokenids.encoder(op13_tokenids.default_vocabulary()).encode
    found = encode([prose(i, 60, 300) for i in range(1500)])
    import zstandard

    shared = op13_tokenids.Codec(zstandard.train_dictionary(20_000, found[:1000]).as_bytes())
    alone = op13_tokenids.Codec(b"")
    sizes = [sum(len(c.compress(x)) for x in found[1000:]) for c in (shared, alone)]
    assert sizes[0] < 0.8 * sizes[1]
    assert all(shared.decompress(shared.compress(x)) == x for x in found[1000:])


@given(st.lists(st.text(st.sampled_from("aAbß'sT trEdé́ÀÉßªµİΣσ \x1c\x0b\n\r 1²½日 .,!<|endoftext|>startof "), max_size=60), max_size=4))
@settings(max_examples=150, deadline=None)
def test_words_encoded_once_give_the_same_ids(texts):
    texts = [*texts, "a<|endoftext|>b <|startoftext|> it's ΣΑΣ x́ ȩ́"]
    e = op13_tokenids.encoder(op13_tokenids.default_vocabulary())
    assert e.cuts
    want = [np.array([*e.tokenizer.encode(t, add_special_tokens=False).ids, 1], e.kind).tobytes() for t in texts]
    assert e.encode(texts) == want


def test_other_vocabularies_take_whole_texts():
    import public_tokenizers

    e = op13_tokenids.encoder(public_tokenizers.path("byte_bpe_50k.json"), 2)
    assert not e.cuts
    text = "two  blanks\n\nand lines"
    assert np.frombuffer(e.encode([text])[0], e.kind).tolist() == [*e.tokenizer.encode(text, add_special_tokens=False).ids, 2]
