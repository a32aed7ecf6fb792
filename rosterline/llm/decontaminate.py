"""Benchmark decontamination as a prefix-filtered set join.

A benchmark window is a set of word shingles with known places. Shingles are ordered by how rare
they are in the documents. As a window must be contained whole, its rarest shingle alone is a
sufficient prefix: documents are joined on it, the shingle's place gives the only place the
window can have, and the words there are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bitmap import passes, residue_filter
from .common import doc_hash, settle, tidy, unused
from .wordhash import ALNUM, batches, grams, row_bounds, words_of

WINDOW = 10
SHINGLE = 3


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Per item and window: item_id, win (its words), n (how many), and its shingles' hashes."""
    id_type = dict(items.dtypes)[id_col]

    def run(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_iter:
            found = {"place": [], "win": [], "n": [], "grams": []}
            for rows, raw, starts in batches(batch.column(1).to_pylist()):
                first, last, hashes = words_of(raw, ALNUM)
                bounds = row_bounds(starts, first)
                for row, a, b in zip(rows, bounds[:-1], bounds[1:]):
                    n = min(window, b - a)
                    words = [raw[i:j].decode() for i, j in zip(first[a:b], last[a:b])]
                    for s in range(b - a - n + 1 if n else 0):
                        own = grams(hashes[a + s:a + s + n], min(shingle, n))
                        found["place"].append(row)
                        found["win"].append(" ".join(words[s:s + n]))
                        found["n"].append(n)
                        found["grams"].append(own.view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(found["place"], pa.int64())),
                 pa.array(found["win"], pa.string()), pa.array(found["n"], pa.int32()),
                 pa.array(found["grams"], pa.list_(pa.int64()))],
                names=["item_id", "win", "n", "grams"])

    return items.select(id_col, text_col).mapInArrow(
        tidy(run), f"item_id {id_type}, win string, n int, grams array<long>")


def _sizes(windows: DataFrame, shingle: int) -> list[int]:
    """The shingle lengths in use: at most ``shingle`` numbers."""
    return sorted(r[0] for r in windows.select(
        F.least("n", F.lit(shingle)).alias("g")).distinct().collect())


def rarity(docs: DataFrame, text_col: str, bitmap: bytes, sizes: list[int]) -> DataFrame:
    """How often each shingle that passes the bitmap occurs in all documents: g, gram, count."""

    def run(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(bitmap, dtype=np.uint8)
        for batch in batch_iter:
            for _, raw, starts in batches(batch.column(0).to_pylist()):
                first, _, hashes = words_of(raw, ALNUM)
                bounds = row_bounds(starts, first)
                row = np.repeat(np.arange(len(starts)), np.diff(bounds))
                for g in sizes:
                    own = grams(hashes, g)
                    if not len(own):
                        continue
                    own = own[(row[g - 1:] == row[:len(own)]) & passes(flags, own)]
                    values, counts = np.unique(own, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(values), g, dtype=np.int32)),
                         pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))],
                        names=["g", "gram", "count"])

    return (docs.select(text_col).mapInArrow(tidy(run), "g int, gram long, count long")
            .groupBy("g", "gram").agg(F.sum("count").alias("count")))


def prefixes(windows: DataFrame, counts: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Per window its rarest shingle: win, n, g, gram, offset.

    A window with a shingle that no document has cannot occur and goes.
    """
    parts = windows.select(
        "win", "n", F.least("n", F.lit(shingle)).alias("g"),
        F.size("grams").alias("parts"), F.posexplode("grams").alias("offset", "gram"))
    return (
        parts.join(counts, ["g", "gram"])
        .groupBy("win", "n", "g", "parts")
        .agg(F.min(F.struct("count", "gram", "offset")).alias("best"), F.count("*").alias("met"))
        .filter("met = parts")
        .select("win", "n", "g", "best.gram", "best.offset")
    )


def candidates(docs: DataFrame, text_col: str, bitmap: bytes, sizes: list[int],
               window: int) -> DataFrame:
    """One row per document with n_words, and one per place whose shingle passes the bitmap.

    The latter carry the words that a window over the place can reach.
    """
    columns = [c for c in docs.columns if c != text_col]

    def run(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(bitmap, dtype=np.uint8)
        for batch in batch_iter:
            place = batch.schema.get_field_index(text_col)
            for rows, raw, starts in batches(batch.column(place).to_pylist()):
                first, last, hashes = words_of(raw, ALNUM)
                bounds = row_bounds(starts, first)
                count = np.diff(bounds)
                row = np.repeat(np.arange(len(starts)), count)
                out = {"row": list(rows), "n_words": count.tolist()}
                for name in ("pos", "g", "gram", "left", "near"):
                    out[name] = [None] * len(rows)
                for g in sizes:
                    own = grams(hashes, g)
                    if not len(own):
                        continue
                    met = np.flatnonzero(
                        (row[g - 1:] == row[:len(own)]) & passes(flags, own))
                    for i, at, gram in zip(met.tolist(), row[met].tolist(),
                                           own[met].view(np.int64).tolist()):
                        a = max(int(bounds[at]), i - window + g)
                        b = min(int(bounds[at + 1]), i + window)
                        out["row"].append(rows[at])
                        out["n_words"].append(None)
                        out["pos"].append(i - int(bounds[at]))
                        out["g"].append(g)
                        out["gram"].append(gram)
                        out["left"].append(i - a)
                        out["near"].append(" ".join(
                            raw[s:e].decode() for s, e in zip(first[a:b], last[a:b])))
                index = pa.array(out["row"], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(batch.schema.get_field_index(c)).take(index)
                       for c in columns],
                     pa.array(out["n_words"], pa.int64()), pa.array(out["pos"], pa.int64()),
                     pa.array(out["g"], pa.int32()), pa.array(out["gram"], pa.int64()),
                     pa.array(out["left"], pa.int32()), pa.array(out["near"], pa.string())],
                    names=[*columns, "n_words", "pos", "g", "gram", "left", "near"])

    types = dict(docs.dtypes)
    schema = ", ".join([*[f"{c} {types[c]}" for c in columns], "n_words long", "pos long",
                        "g int", "gram long", "left int", "near string"])
    return docs.select(*columns, text_col).mapInArrow(tidy(run), schema)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", window: int = WINDOW,
                  shingle: int = SHINGLE) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items (sorted ids), contaminated.

    Words are runs of ASCII letters and digits and of all non-ASCII characters, A-Z lower-cased.
    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is
    one window. n_hit counts the document's words inside any occurrence of a window; items are
    those with such a window. ``items`` has item_id and text; several rows with one item_id are
    one item, a null id marks words but is not listed. Null and empty texts have no words. Rows
    equal in id and text get equal results. Empty tables give no rows or no hits. Other columns
    are not read.
    """
    rows = settle(item_windows(items, window=window, shingle=shingle))
    windows = rows.dropDuplicates(["win"]).drop("item_id")
    owners = rows.select("win", F.col("item_id").cast("string").alias("item_id")) \
        .filter("item_id is not null").distinct()
    sizes = _sizes(rows, shingle)
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).select(
        "doc_id", "text", *[h.alias(f"k{i}") for i, h in enumerate(doc_hash(
            F.col("doc_id"), F.col("text")))])
    every = rows.select(F.explode("grams").alias("gram"))
    counts = rarity(keyed, "text", residue_filter(every, "gram"), sizes)
    chosen = settle(prefixes(windows, counts, shingle))
    found = settle(candidates(keyed, "text", residue_filter(chosen, "gram"), sizes, window))
    start = F.col("left") - F.col("offset")
    hits = settle(
        found.filter("pos is not null").drop("n_words", "doc_id").join(chosen, ["g", "gram"])
        .filter((start >= 0) & (F.array_join(
            F.slice(F.split("near", " "), start + 1, F.col("n")), " ") == F.col("win")))
        .select("k0", "k1", (F.col("pos") - F.col("offset")).alias("start"), "n", "win")
        .distinct())
    by_doc = Window.partitionBy("k0", "k1").orderBy("start", "end")
    before = F.max("end").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    covered = (
        hits.select("k0", "k1", "start", (F.col("start") + F.col("n")).alias("end"))
        .withColumn("from", F.greatest("start", F.coalesce(before, F.col("start"))))
        .groupBy("k0", "k1")
        .agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.col("from"))).alias("n_hit")))
    named = (
        hits.select("k0", "k1", "win").distinct().join(owners, "win")
        .groupBy("k0", "k1").agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    items_ = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0))
    return (
        found.filter("pos is null").select("doc_id", "k0", "k1", "n_words")
        .join(covered, ["k0", "k1"], "left").join(named, ["k0", "k1"], "left")
        .select("doc_id", "n_words", n_hit.cast("long").alias("n_hit"),
                F.size(items_).cast("long").alias("n_items"), items_.alias("items"),
                (n_hit > 0).alias("contaminated")))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows without any word inside a benchmark window; columns stay."""
    k0, k1 = unused(docs, "k0_", "k1_")
    keyed = docs.withColumns(dict(zip((k0, k1), doc_hash(F.col(id_col), F.col(text_col)))))
    one = keyed.select(F.struct(F.col(k0).alias("k0"), F.col(k1).alias("k1")).alias("doc_id"),
                       F.col(text_col).alias("text"))
    hit = (contamination(one, items, window=window).filter("contaminated")
           .select(F.col("doc_id.k0").alias(k0), F.col("doc_id.k1").alias(k1)).distinct())
    return keyed.join(settle(hit), [k0, k1], "left_anti").select(*docs.columns)
