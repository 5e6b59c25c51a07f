"""Rows that every operator must stand: nulls, empty and long texts, repeats, ties, extra columns with clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept boolean, h1 long, component_id long, id string, copies int, n string, label string, shard int, key string, node string, rank int"
EXTRA = (7, True, 1, 2, "x", 3, "n", "l", 4, "k", "o", 5)


def prose(seed: int, words: int, vocabulary: int = 4000) -> str:
    rng = random.Random(seed)
    out = [f"w{rng.randrange(vocabulary)}" for _ in range(words)]
    for i in range(11, words, 12):
        out[i] += "\n" if rng.random() < 0.6 else "."
    return " ".join(out)


def changed(text: str, seed: int, share: float) -> str:
    rng = random.Random(seed)
    return " ".join(f"z{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split(" "))


def edge_rows() -> list[tuple]:
    base = prose(1, 300)
    rows = [
        (0, None, "en", "a"), (1, "", "en", "a"), (2, " \n\t ", None, None), (3, "one two", "en", ""), (4, base, "en", "a"), (5, base, "en", "b"),
        (6, changed(base, 1, 0.02), None, "b"), (7, changed(base, 2, 0.03), "en", None), (8, prose(2, 30_000), "fr", "c"), (9, prose(3, 400), "en", "a"), (9, prose(3, 400), "en", "a"),
        (9, prose(4, 120), "en", "a"), (None, prose(5, 90), "en", "a"), (None, None, None, None), (10, "a b c d e f g h " * 40, "de", "c"), (11, "ÀÉ ß " * 50 + "<|endoftext|>", "fr", "c"),
        (12, "the shared line of every text here\nx", "en", "a"), (13, "the shared line of every text here\ny", "en", "a"), (14, "THE shared line of every text here \nz", "en", "a"),
    ]
    return [(*r, None if r[1] is None else len(r[1]), *EXTRA) for r in rows]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def save(df, tmp_path, name: str = "documents") -> str:
    df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
