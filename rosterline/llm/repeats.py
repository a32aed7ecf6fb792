"""Removal of byte strings that repeat anywhere in the corpus, by bucket refinement.

Only offsets chosen by content are sorted: of any WINDOW neighbouring q-grams the one with the
smallest hash is an anchor, so equal strings of MIN_BYTES hold the same first anchor at the same
distance, and every start of such a string belongs to one anchor. Starts are bucketed in three
rounds. A bucket is named by the bytes that all its strings share around their anchor (initial
q-gram bucket), then refined by the identifiers of the bytes at the earlier and later offsets of
the whole group of starts. A group that is alone in its bucket cannot repeat. Groups with an
equal are done: each of their strings repeats. The rest, groups with differing neighbours in one
bucket, is split into smaller groups, with one member of every finished group for comparison,
and refined again, down to single starts. Only what is undecided goes on, so that later rounds
see few offsets.

Buckets and groups are named by 64 bits each; a string is compared by 128.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bitmap import passes, residue_filter
from .common import doc_hash, settle, tidy
from .wordhash import mix, running_hash, span_hash

U64 = np.uint64
MIN_BYTES = 400
QGRAM = 64
GROUPS = (192, 16, 1)  # starts per group in each round; the first is the anchors' window
CHUNK = 1 << 17  # bytes; short texts are gathered to as much, long ones are cut
PLACE_BITS = U64((1 << 24) - 1)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


class Chunk:
    """Part of a document, or several whole ones: anchors, and names of byte strings in it.

    ``first`` is where in its document the part begins, ``begins`` where in the data each
    document does. No string of ``min_bytes`` goes over the end of a document.
    """

    def __init__(self, data: np.ndarray, first: int, min_bytes: int, window: int, qgram: int,
                 begins: Sequence[int] = (0,)):
        self.first, self.min_bytes = first, min_bytes
        self.begins = np.array(begins, dtype=np.int64)
        self.total = running_hash(data)
        n = len(data) - qgram + 1
        order = mix(span_hash(self.total, slice(0, n), slice(qgram, None)))
        order = (order & ~PLACE_BITS) | np.arange(n, dtype=U64)
        n = len(data) - min_bytes + 1
        anchor = (_sliding_least(order, window)[:n] & PLACE_BITS).astype(np.int64)
        for begin in begins[1:]:
            anchor[begin - min_bytes + 1:begin] = -1
        low = np.flatnonzero(np.diff(anchor, prepend=-2))
        high = np.append(low[1:], n) - 1
        whole = anchor[low] >= 0
        self.low, self.high = low[whole], high[whole]
        self.anchor = anchor[self.low]

    def places(self, groups) -> tuple[np.ndarray, np.ndarray]:
        """Which of the documents each group is in, and where in the data its count begins."""
        piece = np.searchsorted(self.begins, groups[1], side="right") - 1
        return piece, self.begins[piece] - self.first

    def name(self, start: np.ndarray, end: np.ndarray, salt: np.ndarray) -> np.ndarray:
        """Names of byte strings, told apart also by the salt."""
        return mix(span_hash(self.total, start, end) ^ mix(salt.astype(U64) + U64(1)))

    def split(self, size: int, of: Sequence[np.ndarray] | None = None):
        """Groups of ``size`` starts by their distance from the anchor: anchor, low, high."""
        anchor, low, high = of if of is not None else (self.anchor, self.low, self.high)
        nearest, farthest = (anchor - high) // size, (anchor - low) // size
        count = farthest - nearest + 1
        row = np.repeat(np.arange(len(anchor)), count)
        number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + nearest[row]
        return (anchor[row],
                np.maximum(low[row], anchor[row] - number * size - size + 1),
                np.minimum(high[row], anchor[row] - number * size))

    def bucket(self, groups, size: int) -> np.ndarray:
        """Names of what all strings of a group share, the same wherever the group is cut off."""
        anchor, low, _ = groups
        number = (anchor - low) // size
        start = anchor - number * size
        return self.name(start, start - size + 1 + self.min_bytes, number * 4 + 1)

    def refined(self, groups) -> np.ndarray:
        """Names of all bytes that a group's strings cover, and where its starts lie."""
        anchor, low, high = groups
        return self.name(low, high + self.min_bytes,
                         ((anchor - low) << 20 | (high - low)) * 4 + 2)

    def member(self, groups, bucket: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """A number for each group of starts, by document and place."""
        piece, zero = self.places(groups)
        return mix(bucket ^ mix(docs[piece].view(U64) ^ mix((groups[1] - zero).astype(U64))))


def _chunks(text: str | bytes | None, min_bytes: int, window: int, qgram: int) -> Iterator[Chunk]:
    raw = text if isinstance(text, bytes) else (text or "").encode()
    for first in range(0, len(raw) - min_bytes + 1, CHUNK):
        data = np.frombuffer(raw, dtype=np.uint8, count=min(
            CHUNK + min_bytes - 1, len(raw) - first), offset=first)
        yield Chunk(data, first, min_bytes, window, qgram)


def _gathered(texts: pa.Array, min_bytes: int, window: int,
              qgram: int) -> Iterator[tuple[np.ndarray, Chunk]]:
    """Chunks of a column of texts, with the rows they are of. Short texts share one, so that
    numpy is not called anew for each."""
    rows, parts, begins, held = [], [], [], 0

    def chunk() -> tuple[np.ndarray, Chunk]:
        data = np.frombuffer(b"".join(parts), dtype=np.uint8)
        return np.array(rows), Chunk(data, 0, min_bytes, window, qgram, begins)

    for row, raw in enumerate(texts.cast(pa.binary()).to_pylist()):
        if raw is None or len(raw) < min_bytes:
            continue
        if len(raw) > CHUNK:
            for part in _chunks(raw, min_bytes, window, qgram):
                yield np.array([row]), part
            continue
        if rows and held + len(raw) > CHUNK:
            yield chunk()
            rows, parts, begins, held = [], [], [], 0
        rows.append(row)
        parts.append(raw)
        begins.append(held)
        held += len(raw)
    if rows:
        yield chunk()


def _bucket_counts(docs: DataFrame, min_bytes: int, groups: Sequence[int],
                   qgram: int) -> DataFrame:
    """Initial buckets with more than one group of starts."""

    def run(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_iter:
            found, held = [], 0
            for _, chunk in _gathered(batch.column(0), min_bytes, groups[0], qgram):
                found.append(chunk.bucket((chunk.anchor, chunk.low, chunk.high), groups[0]))
                held += len(found[-1])
                if held > 1 << 18:
                    yield rows(found)
                    found, held = [], 0
            if found:
                yield rows(found)

    def rows(found: list[np.ndarray]) -> pa.RecordBatch:
        names, counts = np.unique(np.concatenate(found), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(names.view(np.int64)), pa.array(counts.astype(np.int64))],
            names=["bucket", "n"])

    return (docs.select("text").mapInArrow(tidy(run), "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).filter("n > 1"))


def _groups(docs: DataFrame, filters: Sequence[bytes], min_bytes: int, groups: Sequence[int],
            qgram: int) -> DataFrame:
    """Groups of the round after as many as there are filters, less one, with their names.

    The first filter passes initial buckets, each other the groups that the round before it has
    left open. A group that passes a filter by chance does no harm: it is compared like the rest.
    """
    level = len(filters) - 1

    def run(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = [np.frombuffer(f, dtype=np.uint8) for f in filters]
        for batch in batch_iter:
            found, held = [], 0
            k0, k1 = (batch.column(i).to_numpy() for i in (1, 2))
            for row, chunk in _gathered(batch.column(0), min_bytes, groups[0], qgram):
                own, bucket, member = open_groups(chunk, flags, k0[row])
                if len(bucket):
                    piece, zero = chunk.places(own)
                    found.append((bucket, chunk.refined(own), member, k0[row[piece]],
                                  k1[row[piece]], own[1] - zero, own[2] - zero + min_bytes))
                    held += len(bucket)
                if held > 1 << 16:
                    yield rows(found)
                    found, held = [], 0
            if found:
                yield rows(found)

    def open_groups(chunk: Chunk, flags: list[np.ndarray], docs: np.ndarray):
        own = (chunk.anchor, chunk.low, chunk.high)
        bucket = chunk.bucket(own, groups[0])
        keep = passes(flags[0], bucket)
        for i in range(level):
            own, bucket = tuple(x[keep] for x in own), bucket[keep]
            keep = passes(flags[i + 1], chunk.member(own, bucket, docs))
            own = chunk.split(groups[i + 1], tuple(x[keep] for x in own))
            bucket = chunk.bucket(own, groups[i + 1])
            keep = np.ones(len(bucket), dtype=bool)
        own, bucket = tuple(x[keep] for x in own), bucket[keep]
        return own, bucket, chunk.member(own, bucket, docs)

    def rows(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(column).view(np.int64)) for column in zip(*found)],
            names=["bucket", "name", "member", "k0", "k1", "start", "end"])

    return docs.select("text", "k0", "k1").mapInArrow(
        tidy(run), "bucket long, name long, member long, k0 long, k1 long, start long, end long")


def repeated_spans(docs: DataFrame, min_bytes: int = MIN_BYTES,
                   groups: Sequence[int] = GROUPS, qgram: int = QGRAM) -> DataFrame:
    """k0, k1, start, end: byte spans of documents (text, k0, k1) all of whose strings of
    ``min_bytes`` bytes occur elsewhere too. Together they cover every such string."""
    if groups[0] + qgram - 1 > min_bytes:
        raise ValueError("a window of q-grams must fit into min_bytes")
    filters = [residue_filter(_bucket_counts(docs, min_bytes, groups, qgram), "bucket")]
    spans = None
    for level in range(len(groups)):
        found = settle(_groups(docs, filters, min_bytes, groups, qgram))
        classes = found.groupBy("bucket", "name").agg(
            F.count("*").alias("n"), F.min("member").alias("member"))
        several = settle(classes.filter("n > 1").select("bucket", "name"))
        done = found.join(several, ["bucket", "name"], "left_semi").select(
            "k0", "k1", "start", "end")
        spans = done if spans is None else spans.unionByName(done)
        if level + 1 < len(groups):
            classes = settle(classes)
            # Stored, so that both sides of the join are shuffled for it and can be split.
            mixed = settle(classes.groupBy("bucket").agg(
                F.count_if(F.col("n") == 1).alias("alone"), F.count("*").alias("kinds"))
                .filter("alone > 0 and kinds > 1").select("bucket"))
            filters.append(residue_filter(
                classes.join(mixed, "bucket", "left_semi"), "member"))
    return spans


def _merged(spans: DataFrame) -> DataFrame:
    """Per document its maximal covered runs, in order: spans array<struct<start, end>>."""
    by_doc = Window.partitionBy("k0", "k1").orderBy("start", "end")
    reach = F.max("end").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce((F.col("start") > reach).cast("int"), F.lit(1))
    return (
        spans.distinct().withColumn("fresh", fresh)
        .withColumn("run", F.sum("fresh").over(
            by_doc.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("k0", "k1", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("k0", "k1")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")))


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_bytes: int = MIN_BYTES, groups: Sequence[int] = GROUPS,
                qgram: int = QGRAM) -> DataFrame:
    """Per row: doc_id, n_bytes, spans (removed runs, in bytes), kept (binary).

    A byte goes if it lies in a string of ``min_bytes`` bytes of its text that also starts
    anywhere else, in this text or another; overlaps count, and all is judged on the input. Texts
    are compared as UTF-8 bytes, as they are. Texts shorter than that, empty and null ones lose
    nothing. Rows equal in id and text are documents of their own: what is repeated between them
    goes from each. Other columns are not read; an empty table gives no rows.
    """
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    keyed = given.select("*", *[h.alias(f"k{i}") for i, h in enumerate(
        doc_hash(F.col("doc_id"), F.col("text")))])
    merged = settle(_merged(repeated_spans(keyed, min_bytes, groups, qgram)))
    flags = residue_filter(merged, "k0")
    id_type = dict(given.dtypes)["doc_id"]

    def mark(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(flags, dtype=np.uint8)
        for batch in batch_iter:
            keys = batch.column(2).to_numpy().view(U64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(passes(bits, keys))],
                names=[*batch.schema.names, "marked"])

    def cut(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_iter:
            kept, sizes = [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw, parts, at = (text or "").encode(), [], 0
                for span in spans or ():
                    parts.append(raw[at:span["start"]])
                    at = span["end"]
                kept.append(b"".join([*parts, raw[at:]]))
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), batch.column(2),
                 pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    kind = "array<struct<start:bigint,end:bigint>>"
    # Documents that surely lose nothing are not moved.
    marked = keyed.mapInArrow(
        tidy(mark), f"doc_id {id_type}, text string, k0 long, k1 long, marked boolean")
    none = F.array().cast(kind)
    rows = marked.filter("marked").join(merged, ["k0", "k1"], "left").select(
        "doc_id", "text", F.coalesce("spans", none).alias("spans")).unionByName(
        marked.filter("not marked").select("doc_id", "text", none.alias("spans")))
    return rows.mapInArrow(tidy(cut), f"doc_id {id_type}, n_bytes long, spans {kind}, kept binary")
