"""Decontamination against brute force, and the pipeline against its stages."""

from __future__ import annotations

import random
import re

import pytest
from corpus import documents, edge_rows, stock, words

import corpus_pipeline
from rosterline.llm.decontaminate import contamination, drop_contaminated


def plain(text: str | None) -> list[str]:
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def expected(docs, items, size):
    windows = []
    for item_id, text in items:
        w = plain(text)
        n = min(size, len(w))
        windows += [(item_id, w[i:i + n]) for i in range(len(w) - n + 1)] if n else []
    out = []
    for doc_id, text in docs:
        w, hit, ids = plain(text), set(), set()
        for item_id, window in windows:
            n = len(window)
            for i in range(len(w) - n + 1):
                if w[i:i + n] == window:
                    hit.update(range(i, i + n))
                    if item_id is not None:
                        ids.add(str(item_id))
        out.append((doc_id, len(w), len(hit), len(ids), sorted(ids), bool(hit)))
    return out


def check(spark, docs, items, size):
    df = documents(spark, docs, clashing=True)
    table = spark.createDataFrame(items, "item_id long, text string")
    found = contamination(df, table, window=size).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected(docs, items, size)))


@pytest.mark.parametrize("size", [1, 2, 4, 10])
def test_contamination(spark, size):
    rng = random.Random(size)
    lexicon = stock(rng, 25)
    items = [(i, " ".join(words(rng, rng.randint(0, 16), lexicon))) for i in range(25)]
    items += [(3, "another text of item three"), (30, items[4][1].upper()), (None, items[5][1])]
    docs = []
    for i in range(60):
        own = words(rng, rng.randint(0, 30), lexicon)
        if i % 2:
            own += plain(rng.choice(items)[1]) + words(rng, 3, lexicon)
        docs.append((i, ", ".join(own).title()))
    check(spark, [*docs, docs[1], docs[1]], items, size)


def test_contamination_edges(spark):
    docs = edge_rows() + [(800, "w " * 9000 + "one two three four")]
    items = [(1, "one two three four"), (2, None), (3, ""), (4, "!!"), (5, "W w"), (6, "日本語")]
    check(spark, docs, items, 10)
    table = spark.createDataFrame(items, "item_id long, text string")
    df = documents(spark, docs, clashing=True)
    assert contamination(df.limit(0), table).count() == 0
    assert {r["n_hit"] for r in contamination(df, table.limit(0)).collect()} == {0}
    kept = drop_contaminated(df, table)
    assert kept.columns == df.columns
    clean = [r for r in expected(docs, items, 10) if not r[5]]
    assert kept.count() == len(clean)


def test_pipeline_stages(spark, tmp_path):
    """Each stage works on what the one before kept, and its decisions take effect."""
    rng = random.Random(6)
    lexicon = stock(rng, 3000)

    def prose(n):
        return " ".join(words(rng, n, lexicon))

    item = prose(12)
    line = prose(9)
    long = [prose(12) for _ in range(8)]
    copy = "\n".join([*long[:7], prose(12)])
    texts = {
        0: "12 !? 34", 1: None, 2: "", 3: prose(40), 4: f"{line}\n{prose(20)}",
        5: f"{line}\n{prose(20)}", 6: " ".join(long), 7: copy.replace("\n", " "),
        8: prose(10) + " " + item.upper(), 9: line, 10: prose(3), 11: prose(2000),
        12: f"{line[:-1]}x\n{prose(15)}",
    }
    rows = [(i, t, "en" if i % 2 else None, "s", 0) for i, t in texts.items()]
    folder = str(tmp_path)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
        if name != "bpe":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert list(kept) == ["language_id", "line_dedup", "near_dedup", "decontamination", "bpe"]
    everything = set(texts)
    assert set(kept["language_id"]) == everything - {0, 1, 2}
    assert set(kept["line_dedup"]) == everything - {0, 1, 2, 9}
    assert kept["line_dedup"][5]["text"] == texts[5].split("\n")[1]
    assert kept["line_dedup"][12]["text"] == texts[12].split("\n")[1]
    assert kept["line_dedup"][5]["n_chars"] == len(kept["line_dedup"][5]["text"])
    assert set(kept["near_dedup"]) == everything - {0, 1, 2, 9, 7}
    assert set(kept["decontamination"]) == everything - {0, 1, 2, 9, 7, 8}
    for doc_id, r in kept["bpe"].items():
        assert r["decoded"] == kept["decontamination"][doc_id]["text"]
        assert r["n_tokens"] == len(r["token_ids"]) > 0
    rerun = {r["doc_id"]: r["token_ids"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert rerun == {i: r["token_ids"] for i, r in kept["bpe"].items()}


def test_pipeline_of_an_empty_table(spark, tmp_path):
    folder = str(tmp_path)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
