"""Toxicity by weak supervision.

Many weak voters look at a text: lexicons and word-start patterns drawn from labelled texts, and
patterns of its surface. A generative label model estimates each voter's accuracy and how far
voters are correlated, and gives every sampled text a posterior label. The given label is one
voter among them, of a fixed accuracy: others that agree can outvote it. A linear classifier is
trained on those posteriors, and on nothing else, and scores whole texts.

Only the sample reaches the driver; its size is a parameter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import tidy
from .wordhash import ALNUM, batches, mix, row_bounds, running_hash, span_hash

U64 = np.uint64
STARTS = (4, 6)  # bytes of a word's start that form a pattern
SALTS = [mix(np.array([s], dtype=U64))[0] for s in (101, 103)]
LEXICON_WORDS = 8
LEXICONS, START_PATTERNS = 24, 12
FEATURES = 4096
GIVEN = 0.95  # accuracy of the given labels as a voter
SURE, STRONG = 3.2, 2.5  # least standard deviations and size of a feature's log odds
SURFACE = 5


def text_features(raw: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (even) and word starts (odd) of joined texts, and their texts."""
    data = np.frombuffer(raw, dtype=np.uint8)
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ALNUM[data]
    turns = np.diff(inside)
    first, last = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    total = running_hash(data)
    found = [mix(span_hash(total, first, last)) & ~U64(1)]
    owner = np.searchsorted(starts, first, side="right") - 1
    owners = [owner]
    for size, salt in zip(STARTS, SALTS):
        long = last - first > size
        found.append(mix(span_hash(total, first[long], first[long] + size) ^ salt) | U64(1))
        owners.append(owner[long])
    return np.concatenate(found), np.concatenate(owners)


def surface(text: str | None) -> list[int]:
    """Votes of the surface patterns: 1 where the pattern is there, else 0."""
    text = text or ""
    n = max(len(text), 1)
    letters = sum(map(str.isalpha, text)) or 1
    return [
        int(text.count("!") > 0.02 * n),
        int(sum(map(str.isupper, text)) > 0.5 * letters),
        int("!!" in text or "?!" in text),
        int("***" in text or "$#" in text),
        int(letters < 0.5 * n),
    ]


@dataclass(frozen=True)
class ToxicityModel:
    """Sorted feature hashes, their weights, and the bias. At most FEATURES entries."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float


def _sample(docs: DataFrame, labels: DataFrame, where: Column | None, id_col: str,
            text_col: str, label_col: str, rows_per_class: int):
    """Labelled rows, at most ``rows_per_class`` of each class, and the classes' sizes."""
    ids = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
        .filter("id is not null and label is not null")
        .groupBy("id").agg(F.max("label").cast("int").alias("label")))
    if where is not None:
        ids = ids.filter(where)
    sizes = {r["label"]: r["n"] for r in
             ids.filter("label in (0, 1)").groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for label, n in sizes.items():
        draw = F.xxhash64(F.lit(17), "id")
        share = F.pmod(draw, F.lit(1 << 30)) < int(min(1.0, 2 * rows_per_class / n) * (1 << 30))
        # A few rows are left after the share, so that the exact bound costs little.
        part = ids.filter((F.col("label") == label) & share).orderBy(draw, "id") \
            .limit(rows_per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        return None, sizes
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(chosen), "id").select("label", "text"), sizes


def _collect(sample: DataFrame):
    """Labels, surface votes and feature sets of the sampled texts."""

    def run(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_iter:
            texts = batch.column(1).to_pylist()
            features: list = [None] * len(texts)
            for rows, raw, starts in batches(texts):
                hashes, owner = text_features(raw, starts)
                for k, row in enumerate(rows):
                    features[row] = np.unique(hashes[owner == k]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([surface(t) for t in texts], pa.list_(pa.int32())),
                 pa.array(features, pa.list_(pa.int64()))],
                names=["label", "surface", "features"])

    found = sample.mapInArrow(
        tidy(run), "label int, surface array<int>, features array<long>").toArrow()
    # Rows arrive in any order; the fit should not depend on it.
    sums = [int(np.asarray(x.values).sum()) for x in found["features"]]
    found = found.take(pa.array(np.lexsort((sums, found["label"].to_numpy()))))
    lists = found["features"].combine_chunks()
    return (found["label"].to_numpy(), np.array(found["surface"].to_pylist()).reshape(-1, SURFACE),
            np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy())


def _strength(label, row, column, n_columns, weight):
    """Log odds of each feature between the classes, and how sure they are."""
    hot = label[row] == 1
    ones = np.bincount(column[hot], minlength=n_columns)
    zeros = np.bincount(column[~hot], minlength=n_columns)
    n1, n0 = max((label == 1).sum(), 1), max((label == 0).sum(), 1)
    odds = (np.log((ones + 0.5) / (n1 - ones + 0.5)) - np.log((zeros + 0.5) / (n0 - zeros + 0.5)))
    spread = np.sqrt(1 / (ones + 0.5) + 1 / (zeros + 0.5))
    return odds, odds / spread


def _votes(label, surface_votes, row, column, kind, odds, sure):
    """A matrix of votes: 1 toxic, -1 clean, 0 none.

    Lexicons are groups of the surest words, patterns groups of the surest word starts. Two
    voters say clean where no listed word, or no listed word start, occurs.
    """
    n = len(label)
    columns = []
    for which, groups in ((0, LEXICONS), (1, START_PATTERNS)):
        good = np.flatnonzero((sure > 0) & ((kind == 0) == (which == 0)))
        good = good[np.argsort(-sure[good], kind="stable")][:groups * LEXICON_WORDS]
        listed = np.zeros(n, dtype=bool)
        for start in range(0, len(good), LEXICON_WORDS):
            member = np.zeros(len(odds), dtype=bool)
            member[good[start:start + LEXICON_WORDS]] = True
            hit = np.bincount(row[member[column]], minlength=n) > 0
            listed |= hit
            columns.append(hit.astype(np.int8))
        columns.append(np.where(listed, 0, -1).astype(np.int8))
    for j in range(surface_votes.shape[1]):
        columns.append(surface_votes[:, j].astype(np.int8))
    return np.stack(columns, axis=1)


def label_model(votes: np.ndarray, label: np.ndarray, weight: np.ndarray, rounds: int = 20,
                given_accuracy: float = GIVEN):
    """Posterior probability of toxic per row, voters' accuracies, and their correlations.

    Given the class, a voter votes 1, -1 or nothing with probabilities that are estimated by
    expectation maximisation. The given label starts it and votes too, always, with
    ``given_accuracy``, which keeps the classes from drifting.
    Correlation is what remains between two voters once the class is known; a voter's evidence is
    divided by one plus the sum of its correlations, so that copies of a voter count about once.
    """
    kinds = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    posterior = np.where(label == 1, given_accuracy, 1 - given_accuracy)
    own = np.log(given_accuracy / (1 - given_accuracy)) * (2 * label - 1)
    share, correlation = np.ones(votes.shape[1]), np.zeros((votes.shape[1],) * 2)
    given = {}
    for _ in range(rounds):
        expected = np.zeros(votes.shape)
        for c in (0, 1):
            p = weight * (posterior if c else 1 - posterior)
            counts = np.einsum("i,ijk->jk", p, kinds) + 0.5
            given[c] = counts / counts.sum(axis=1, keepdims=True)
            mean = given[c][:, 2] - given[c][:, 0]
            expected += (posterior if c else 1 - posterior)[:, None] * mean
        rest = votes - expected
        scale = np.sqrt(np.einsum("i,ij->j", weight, rest ** 2) / weight.sum()) + 1e-9
        correlation = (rest * weight[:, None]).T @ rest / weight.sum() / np.outer(scale, scale)
        np.fill_diagonal(correlation, 0)
        share = 1 / (1 + np.where(np.abs(correlation) > 0.1, np.abs(correlation), 0).sum(axis=0))
        evidence = own + np.einsum(
            "ijk,jk->ij", kinds, np.log(given[1]) - np.log(given[0])) @ share
        prior = (weight * posterior).sum() / weight.sum()
        model = 1 / (1 + np.exp(-np.clip(evidence + np.log(prior / (1 - prior)), -30, 30)))
        posterior = np.clip(model, 1e-3, 1 - 1e-3)
    wrong = (weight * posterior) @ (votes == -1) + (weight * (1 - posterior)) @ (votes == 1)
    cast = weight @ (votes != 0)
    return posterior, 1 - wrong / np.maximum(cast, 1e-9), correlation


def _train(target, weight, row, column, n_rows, n_columns, penalty=1e-4, steps=600):
    """Logistic regression on features that are there or not, by Adam over the whole sample."""
    w, b = np.zeros(n_columns), 0.0
    moments = np.zeros((2, n_columns + 1))
    weight = weight / weight.sum()
    for step in range(1, steps + 1):
        z = np.bincount(row, weights=w[column], minlength=n_rows) + b
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target)
        slope = np.append(np.bincount(column, weights=error[row], minlength=n_columns)
                          + penalty * w, error.sum())
        moments[0] = 0.9 * moments[0] + 0.1 * slope
        moments[1] = 0.99 * moments[1] + 0.01 * slope ** 2
        move = (moments[0] / (1 - 0.9 ** step)) / (
            np.sqrt(moments[1] / (1 - 0.99 ** step)) + 1e-9)
        w, b = w - 0.1 * move[:-1], b - 0.1 * move[-1]
    return w, float(b)


def learn(docs: DataFrame, labels: DataFrame, where: Column | None = None,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          rows_per_class: int = 3000) -> ToxicityModel:
    """Learn from a bounded sample of labelled rows that pass ``where`` (a condition on ``id``).

    At most ``rows_per_class`` ids of each class are drawn, by a hash of the id; several labels of
    one id count as toxic if one does. Without any toxic label the model scores everything 0.
    """
    sample, sizes = _sample(docs, labels, where, id_col, text_col, label_col, rows_per_class)
    empty = ToxicityModel(np.zeros(0, np.int64), np.zeros(0), -30.0)
    if sample is None or not sizes.get(1):
        return empty
    label, surface_votes, lengths, features = _collect(sample)
    if not len(label) or not (label == 1).any():
        return empty
    row = np.repeat(np.arange(len(label)), lengths)
    keys, column = np.unique(features, return_inverse=True)
    often = np.bincount(column, minlength=len(keys)) >= 3
    weight = np.where(label == 1, sizes.get(1, 0) / max((label == 1).sum(), 1),
                      sizes.get(0, 0) / max((label == 0).sum(), 1))
    odds, sure = _strength(label, row, column, len(keys), weight)
    chosen = np.flatnonzero(often & (np.abs(sure) > SURE) & (np.abs(odds) > STRONG))
    chosen = np.sort(chosen[np.argsort(-np.abs(sure[chosen]), kind="stable")][:FEATURES])
    place = np.full(len(keys), -1)
    place[chosen] = np.arange(len(chosen))
    held = place[column] >= 0
    row, column = row[held], place[column[held]]
    odds, sure, kept = odds[chosen], sure[chosen], keys[chosen]
    votes = _votes(label, surface_votes, row, column, kept & 1, odds, sure)
    posterior, _, _ = label_model(votes, label, weight)
    w, b = _train(posterior, weight, row, column, len(label), len(kept))
    return ToxicityModel(kept, w, b)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per row: doc_id, score from 0 to 1, predicted (1 if the score is at least 0.5).

    Whole texts are scored; only text is read, so no label, language or source can leak in. Null
    and empty texts score what a text without any known feature does. Repeated rows are scored
    each. An empty table gives no rows; other columns are not read.
    """
    id_type = dict(docs.dtypes)[id_col]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batch_iter:
            z = np.full(batch.num_rows, known.bias)
            for rows, raw, starts in batches(batch.column(1).to_pylist()):
                if not len(known.keys):
                    break
                hashes, owner = text_features(raw, starts)
                hashes = hashes.view(np.int64)
                at = np.minimum(np.searchsorted(known.keys, hashes), len(known.keys) - 1)
                met = known.keys[at] == hashes
                pairs = np.unique(owner[met] * len(known.keys) + at[met])
                z[rows] += np.bincount(pairs // len(known.keys), minlength=len(rows),
                                       weights=known.weights[pairs % len(known.keys)])
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    return docs.select(id_col, text_col).mapInArrow(
        tidy(run), f"doc_id {id_type}, score double, predicted int")
