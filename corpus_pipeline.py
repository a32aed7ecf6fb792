"""The corpus pipeline: five stages from raw documents to tokens.

Each stage takes (spark, documents, folder of the given tables) and returns what it keeps, with
the columns of the documents; the last returns tokens. The stages' results are stored one after
the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm import langid
from rosterline.llm.bpe import transcode
from rosterline.llm.common import settle, ship
from rosterline.llm.decontaminate import drop_contaminated
from rosterline.llm.line_dedup import drop_lines
from rosterline.llm.minhash import drop_near_duplicates
from rosterline.llm.queries import table, tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in which a language can be told; texts without a letter go, null ones too.

    The model is learned from a bounded sample of the documents that name their language. A text
    with a letter always stays: the model knows no language but those, so it cannot tell that a
    text is in none of them. Repeated rows stay, columns too; an empty table stays empty.
    """
    ship(spark)
    return langid.keep_identified(docs, langid.learn(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without the lines that an earlier line equals or nearly equals.

    Equal lines go whatever their length, blank ones stay; nearly equal ones (2 edits) go from 32
    characters on. A document of which nothing but blanks is left goes. n_chars follows the text.
    """
    kept = drop_lines(docs, copy_chars=1).filter(F.coalesce(F.col("text"), F.lit("")).rlike(r"\S"))
    if "n_chars" not in docs.columns:
        return kept
    kind = dict(docs.dtypes)["n_chars"]
    return kept.withColumn("n_chars", F.length("text").cast(kind))


def dedup_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id.

    Of rows equal in id and text one stays; a row without an id counts as the smallest. Texts
    without a word are copies of nothing. Columns stay; an empty table stays empty.
    """
    ship(spark)
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no window of a benchmark item.

    Documents without a word hold none; repeated rows stay or go together. Items without a word
    and an empty benchmark table take nothing. Columns stay; an empty table stays empty.
    """
    return drop_contaminated(docs, table(spark, folder, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Ids, their number, and the text that they decode to, beside doc_id, lang and source.

    A null text counts as empty: no ids. One row per row, repeated ones too; other columns are
    left out, so that their names cannot clash with the new ones.
    """
    ship(spark)
    outputs = {c: c for c in ("n_tokens", "token_ids", "decoded")}
    given = docs.select("doc_id", "text", "lang", "source")
    return transcode(given, tokenizer_path(), outputs).drop("text")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontamination", decontaminate),
    ("bpe", tokenize),
]

# Neither language models nor BPE can be written in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents of a folder; each but the last is stored and read again."""
    docs = table(spark, folder)
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, folder))
    return STAGES[-1][1](spark, docs, folder)
