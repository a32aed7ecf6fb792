"""Helpers: hashes, filters, and what the queries return."""

from __future__ import annotations

import random
import zlib

import numpy as np
from corpus import documents, stock, words
from pyspark.sql import functions as F

from rosterline.llm import queries
from rosterline.llm.bitmap import FILTER_BITS, passes, residue_filter
from rosterline.llm.common import fold_case, id_remainder, unused
from rosterline.llm.wordhash import ALNUM, NOT_BLANK, batches, grams, row_bounds, words_of


def test_remainder_is_that_of_crc32(spark):
    df = spark.createDataFrame([(i,) for i in [0, 7, -3, 10**15]] + [(None,)], "doc_id long")
    for r in df.select("doc_id", id_remainder(F.col("doc_id"), 5).alias("r")).collect():
        text = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["r"] == zlib.crc32(text.encode()) % 5


def test_fold_case_leaves_other_letters(spark):
    df = spark.createDataFrame([("ÀÉİ AbZ",), (None,)], "t string")
    assert [r[0] for r in df.select(fold_case(F.col("t"))).collect()] == ["ÀÉİ abz", ""]


def test_unused_names(spark):
    df = spark.createDataFrame([(1, 2)], "k0 int, K0_ int")
    assert unused(df, "k0", "x", "x") == ["k0__", "x", "x_"]


def test_filter_passes_all_that_is_listed(spark):
    rng = np.random.default_rng(1)
    listed = rng.integers(-2**63, 2**63 - 1, 500)
    df = spark.createDataFrame([(int(x),) for x in listed], "key long")
    flags = np.frombuffer(residue_filter(df, "key"), dtype=np.uint8)
    assert len(flags) * 8 == FILTER_BITS and passes(flags, listed).all()
    others = rng.integers(-2**63, 2**63 - 1, 20_000)
    assert passes(flags, others).mean() < 0.01
    none = np.frombuffer(residue_filter(df.limit(0), "key"), dtype=np.uint8)
    assert not passes(none, listed).any()


def test_words_and_their_sequences():
    texts = ["One  two\tTWO é日 one", None, "", "x1-y2", "one two"]
    for table, expected in ((NOT_BLANK, [["one", "two", "two", "é日", "one"], [], [], ["x1-y2"],
                                         ["one", "two"]]),
                            (ALNUM, [["one", "two", "two", "é日", "one"], [], [], ["x1", "y2"],
                                     ["one", "two"]])):
        (rows, raw, starts), = batches(texts)
        first, last, hashes = words_of(raw, table)
        bounds = row_bounds(starts, first)
        found = [[raw[i:j].decode() for i, j in zip(first[a:b], last[a:b])]
                 for a, b in zip(bounds[:-1], bounds[1:])]
        assert rows == list(range(5)) and found == expected
        by_word = {}
        for word, h in zip(sum(expected, []), hashes.tolist()):
            assert by_word.setdefault(word, h) == h
        assert len(set(by_word.values())) == len(by_word)
        pairs = grams(hashes, 2).tolist()
        assert pairs[0] == pairs[-1] and len(set(pairs[:4])) == 4


CONTRACT = {
    "op1_minhash": {"doc_id", "n_shingles", "component_id", "kept"},
    "op2_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op3_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op4_line_dedup": {"doc_id"},
    "op5_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op6_token_counts": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    "op7_exact_dedup": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    "op8_decontamination": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256",
                            "contaminated"},
    "op9_lm_scoring": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                       "base_score", "score"},
    "op10_suffix_array": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op12_alignment": {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                       "groups_sha256"},
}

OTHERS = {"op11_conversations", "op13_exact_topk"}  # not over documents; tested with their operators


def test_queries_return_a_row_per_document(spark, tmp_path):
    rng = random.Random(1)
    lexicon = stock(rng, 200)
    texts = [None, "", *(" ".join(words(rng, rng.randint(1, 40), lexicon)) for _ in range(40))]
    folder = str(tmp_path)
    documents(spark, [(5 * i, t) for i, t in enumerate(texts)]).write.parquet(
        f"{folder}/documents.parquet")
    spark.createDataFrame([(1, texts[5])], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    spark.createDataFrame([(5 * i, 0, i % 2) for i in range(30)],
                          "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    assert set(queries.QUERIES) == {*CONTRACT, *OTHERS}
    for name, columns in CONTRACT.items():
        found = queries.QUERIES[name](spark, folder)
        assert columns <= set(found.columns), name
        ids = [r["doc_id"] for r in found.select("doc_id").collect()]
        assert sorted(ids) == [5 * i for i in range(len(texts))], name


def test_fold_case_of_odd_texts(spark):
    texts = ["", "ABC", "@AZ[`az{", "aB\nÉÀ\u212aKxYZ", "ZÉ", "ÉZ", "İI\u0130i\U0001d400A\x00B",
             "ẞSSß", "É" * 3, "A" * 3 + "\r\n" + "é"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    folded = [r[0] for r in df.select(fold_case(F.col("t"))).collect()]
    assert folded == [t.encode().lower().decode() for t in texts]
    assert "translate" not in df.select(fold_case(F.col("t")))._jdf.queryExecution().toString()
