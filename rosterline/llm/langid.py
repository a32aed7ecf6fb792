"""Language identification with word-first backoff.

A word the model knows scores its log frequency in each language. Any other word falls back to
its character n-grams, the longest length that has a known one; shorter lengths follow only where
none is known. The language with the greatest sum wins.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import tidy, unused
from .token_counts import safe_pieces

UNKNOWN = "und"
LETTERS = regex.compile(r"\p{L}+")
PIECE = 1 << 18
LONGEST = 5
REMEMBERED = 100_000


def words(text: str) -> Iterator[list[str]]:
    """Lower-cased runs of letters, some at a time."""
    for piece in safe_pieces(text, PIECE, by_kind=False):
        yield LETTERS.findall(piece.lower())


def ngrams(word: str, n: int) -> list[str]:
    """Character n-grams of a word with its ends marked."""
    marked = f"_{word}_"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


@dataclass(frozen=True)
class LanguageModel:
    """Log frequencies per language: a row per known word, then a row per known n-gram.

    Its size is bounded by the sample it was learned from.
    """

    languages: list[str]
    words: list[str]
    word_scores: np.ndarray
    grams: list[str]
    gram_scores: np.ndarray

    def packed(self) -> tuple:
        """The model in a few large objects: words and n-grams have no blanks."""
        return (self.languages, " ".join(self.words), self.word_scores, " ".join(self.grams),
                self.gram_scores)

    @staticmethod
    def unpacked(packed: tuple) -> LanguageModel:
        languages, words_, word_scores, grams, gram_scores = packed
        return LanguageModel(languages, words_.split(), word_scores, grams.split(), gram_scores)


def _log_frequencies(counts: dict[str, Counter], languages: list[str]):
    """Known strings and a matrix of their smoothed log frequencies."""
    known = sorted(set().union(*counts.values())) if counts else []
    place = {w: i for i, w in enumerate(known)}
    table = np.full((len(known), len(languages)), 0.5)
    for j, language in enumerate(languages):
        for word, n in counts[language].items():
            table[place[word], j] += n
    totals = table.sum(axis=0)
    return known, np.log(table / np.where(totals > 0, totals, 1)).astype(np.float32)


def learn(docs: DataFrame, where: Column | None = None, text_col: str = "text",
          lang_col: str = "lang", id_col: str = "doc_id",
          rows_per_language: int = 1500) -> LanguageModel:
    """Learn from a bounded sample of the labelled rows that pass ``where``.

    About ``rows_per_language`` rows of each language are taken whole, chosen by a hash of id and
    text, so that the same rows are taken whatever the table's order; never more than twice as
    many, and at least one, also where ids are null or rows repeat. The language counts (one row
    per language) and the sample's word counts reach the driver. Null languages and texts teach
    nothing; with no labelled row the model is empty.
    """
    labelled = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"),
                           F.col(text_col).alias("text"),
                           (F.lit(True) if where is None else where).alias("use")) \
        .filter("use and lang is not null and text is not null").drop("use")
    draw = F.pmod(F.xxhash64(F.lit(5), "id", "text"), F.lit(1 << 30)) / float(1 << 30)
    sizes = {r["lang"]: max(rows_per_language / r["n"], r["least"]) for r in
             labelled.groupBy("lang").agg(F.count("*").alias("n"), F.min(draw).alias("least"))
             .collect()}
    if not sizes:
        return LanguageModel([], [], np.zeros((0, 0)), [], np.zeros((0, 0)))
    share = F.lit(0.0)
    for lang, part in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(part)).otherwise(share)
    # The share leaves few rows, but for a row given very many times; the bound is exact.
    by_draw = Window.partitionBy("lang").orderBy("draw", "id")
    sample = (labelled.withColumn("draw", draw).filter(F.col("draw") <= share)
              .withColumn("place", F.row_number().over(by_draw))
              .filter(F.col("place") <= 2 * rows_per_language))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = found.setdefault(lang, Counter())
                for some in words(text):
                    own.update(some)
        for lang, own in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.string()),
                 pa.array(list(own.values()), pa.int64())], names=["lang", "word", "n"])

    counted = (
        sample.select("lang", "text")
        .mapInArrow(tidy(count), "lang string, word string, n long")
        .groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow())
    languages = sorted(sizes)
    by_word = {lang: Counter() for lang in languages}
    by_gram = {lang: Counter() for lang in languages}
    for lang, word, n in zip(*(counted.column(i).to_pylist() for i in range(3))):
        by_word[lang][word] = n
        for size in range(1, LONGEST + 1):
            for gram in ngrams(word, size):
                by_gram[lang][gram] += n
    return LanguageModel(languages, *_log_frequencies(by_word, languages),
                         *_log_frequencies(by_gram, languages))


class Scorer:
    """A model with its tables looked up by string; unseen words are remembered for a while."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.known = {w: i for i, w in enumerate(model.words)}
        self.grams = {g: i for i, g in enumerate(model.grams)}
        n = len(model.words)
        self.scores = np.concatenate(
            [model.word_scores, np.zeros((REMEMBERED, len(model.languages)), np.float32)])
        self.first = self.next = n
        self.unseen: dict[str, int] = {}

    def _fall_back(self, word: str) -> np.ndarray:
        for n in range(min(LONGEST, len(word) + 2), 0, -1):
            rows = [self.grams[g] for g in ngrams(word, n) if g in self.grams]
            if rows:
                return self.model.gram_scores[rows].mean(axis=0)
        return np.zeros(len(self.model.languages), np.float32)

    def _row(self, word: str) -> int:
        row = self.unseen.get(word)
        if row is None:
            row, self.next = self.next, self.next + 1
            self.scores[row] = self._fall_back(word)
            self.unseen[word] = row
        return row

    def predict(self, text: str | None) -> tuple[str, float]:
        """The best language and its share of the likelihood; ``und`` without a letter."""
        total = np.zeros(len(self.model.languages))
        met = 0
        for some in words(text or ""):
            for start in range(0, len(some), REMEMBERED // 2):
                part = some[start:start + REMEMBERED // 2]
                if self.next + len(part) > len(self.scores):
                    self.unseen.clear()
                    self.next = self.first
                known = self.known.get
                rows = [r if r is not None else self._row(w)
                        for w, r in zip(part, map(known, part))]
                total += self.scores[rows].sum(axis=0, dtype=np.float64)
                met += len(part)
        if not met or not len(total):
            return UNKNOWN, 0.0
        best = int(total.argmax())
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text",
             pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """Add the predicted language of each whole text and its score from 0 to 1.

    ``und`` and 0 where the text is null or has no letter, or the model has no language. Equal
    sums go to the first language in alphabetical order. All columns and rows stay, repeated rows
    included; a new name that is taken is an error. An empty table stays empty.
    """
    clash = {c.lower() for c in docs.columns} & {pred_col.lower(), score_col.lower()}
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    place = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model.packed())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Made for the task and gone with it, so that idle workers keep no tables.
        own = Scorer(LanguageModel.unpacked(shared.value))
        for batch in batches:
            found = [own.predict(t) for t in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())],
                names=[*batch.schema.names, pred_col, score_col])

    added = StructType().add(pred_col, "string").add(score_col, "double")
    return docs.mapInArrow(tidy(run), StructType([*docs.schema.fields, *added.fields]))


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows whose text has a language; what is ``und`` goes. Columns stay as they are.

    A model that knows no language rejects nothing but texts without a letter.
    """
    if not model.languages:
        return docs.filter(F.coalesce(F.col(text_col), F.lit("")).rlike(r"\p{L}"))
    pred, score = unused(docs, "lang_pred", "lang_score")
    found = identify(docs, model, text_col, pred, score)
    return found.filter(F.col(pred) != UNKNOWN).drop(pred, score)
