"""Small document tables for the tests of the corpus operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that operators add or use inside must not clash with those of the input.
CLASHING = ("n_tokens", "score", "k0", "k1", "kept", "n", "line", "key", "cid", "spans",
            "lang_pred", "marked", "block", "bucket", "name", "dropped", "rep")


def words(rng: random.Random, n: int, stock: list[str]) -> list[str]:
    return [rng.choice(stock) for _ in range(n)]


def stock(rng: random.Random, size: int, letters: str = "abcdefghilmnoprstu") -> list[str]:
    return ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(size)]


def documents(spark: SparkSession, texts, clashing: bool = False) -> DataFrame:
    """Texts, or (doc_id, text) pairs, as a table of documents."""
    rows = []
    for i, item in enumerate(texts):
        doc_id, text = item if isinstance(item, tuple) else (i, item)
        rows.append((doc_id, text, "en", f"src{i % 3}", None if text is None else len(text)))
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    if clashing:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("own") for c in CLASHING})
    return df


EDGES = [
    None, "", " ", "\n\n\t", "a", "A a A a", "x" * 3000, "!?" * 800, "é" * 900,
    "one two three four", "ONE two three FOUR", "one two three four five six",
    "İstanbul DŽ ﬀ ǆ 日本語 テキスト 12３ ½ \U0001f600 ́́", "tail \x00 of\x1c odd\x85 blanks\xa0here now",
    "<|endoftext|> and <|endoftext|>x", "it's we'll I'D 'S they've  two  blanks   three",
]


def edge_rows() -> list[tuple]:
    """Edge texts, some rows given twice, some without an id."""
    rows = list(enumerate(EDGES))
    return [*rows, rows[0], rows[9], rows[9], (None, "one two three four"), (None, None),
            (500, "one two three four")]
