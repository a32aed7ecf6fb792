"""Prediction by partial matching over bytes.

A text is its lower-cased words, each followed by a blank, and one end. Every byte is predicted
from the bytes before it in the document, at most ORDER of them, whatever words they belong to;
on request only from those back to the blank before its word. All contexts of the training texts
form a trie, kept as a table of (context, symbol, count). A symbol that a context has not seen
costs an escape and goes to the next shorter context, where the symbols of the longer one are
excluded. Every symbol gives half a count to the escape, so its estimate grows with the number of
distinct symbols. Below the empty context all remaining byte values are equally likely.

Documents are gathered into blocks of bounded size, each with a list of its distinct words and
contexts. Only these lists are joined with the corpus counts, not every byte of every document,
and a block's documents, kept compressed, are scored byte for byte from its own lists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle, tidy

ORDER = 5  # at most 6: three bits of length, the bytes and a symbol fit a 64-bit number
BLOCK_BYTES = 1 << 25
CHUNK_BYTES = 1 << 20  # of texts whose contexts are listed at once
HELD_GRAMS = 1 << 22
PACKED_ROWS = 1 << 21  # of a join's result, held at once to be packed by block
SYMBOLS = 256
# Neither occurs inside a word: the blank ends a word, the line break ends a document.
BLANK, END = 0x20, 0x0A


class _Numbers(dict):
    """Numbers words in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class _Lookup:
    """Positions of numbers in a list of distinct ones, by a hash table with open addresses."""

    def __init__(self, keys: np.ndarray):
        bits = max(2 * len(keys), 2).bit_length()
        self.keys, self.mask, self.shift = keys, (1 << bits) - 1, np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, dtype=np.int32)
        left, at = np.arange(len(keys), dtype=np.int32), self._first(keys)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            lost = self.slots[at] != left
            left, at = left[lost], (at[lost] + 1) & self.mask

    def _first(self, values: np.ndarray) -> np.ndarray:
        mixed = values.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self.shift).astype(np.int64)

    def __call__(self, values: np.ndarray) -> np.ndarray:
        at = self._first(values)
        found = self.slots[at]
        left = (self.keys[found] != values).nonzero()[0]
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            found[left] = self.slots[at[left]]
            if (found[left] < 0).any():
                raise KeyError("a context that the list does not have")
            left = left[self.keys[found[left]] != values[left]]
        return found


def _pack(text: bytes) -> bytes:
    return len(text).to_bytes(4, "little") + pa.compress(text, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> bytes:
    return pa.decompress(data[4:], int.from_bytes(data[:4], "little"), codec="zstd", asbytes=True)


def _pack_numbers(values: np.ndarray) -> bytes:
    """64-bit numbers byte plane by byte plane, so that what they share compresses."""
    return _pack(values.view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack_numbers(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(_unpack(data), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def packed(answers: DataFrame, kind: int) -> DataFrame:
    """Rows (block, a, b) as few rows: block, kind, c (ascending a, as differences) and d (b)."""
    def run(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batch_iter:
            held.append(batch)
            n += len(batch)
            if n > PACKED_ROWS:
                yield flush(held)
                held, n = [], 0
        if n:
            yield flush(held)

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        block, a, b = [c.to_numpy() for c in pa.Table.from_batches(held).columns]
        order = np.lexsort((a, block))
        block, a, b = block[order], a[order], b[order]
        starts = np.unique(block, return_index=True)[1]
        pieces = [slice(*ends) for ends in zip(starts, [*starts[1:], len(block)])]
        return pa.RecordBatch.from_arrays([
            pa.array(block[starts]), pa.array(np.full(len(starts), kind, dtype=np.int32)),
            pa.array([_pack_numbers(np.diff(a[p], prepend=0)) for p in pieces], pa.binary()),
            pa.array([_pack_numbers(b[p]) for p in pieces], pa.binary())],
            names=["block", "kind", "c", "d"])

    return answers.mapInArrow(tidy(run), "block long, kind int, c binary, d binary")


def text_grams(texts: list[bytes], across: bool) -> tuple[np.ndarray, np.ndarray]:
    """The (context, symbol) pair of every byte, and the text that each belongs to.

    Texts are words with one blank between. A pair is one number: the context's length, its
    bytes, then the symbol. Contexts go back to the text's start, or if not ``across`` to the
    blank before the word.
    """
    streams = [b" " + t + b" \n" if t else b" \n" for t in texts]
    lengths = np.fromiter(map(len, streams), np.int64, len(streams))
    data = np.frombuffer(b"".join(streams), dtype=np.uint8).astype(np.int64)
    place, start = np.arange(len(data)), np.cumsum(lengths) - lengths
    if across:
        since = np.repeat(start, lengths)
    else:
        last = np.maximum.accumulate(np.where(data == BLANK, place, 0))
        since = np.concatenate([[0], last[:-1]])
    size = np.minimum(place - since, ORDER)
    grams = data.copy()
    for back in range(1, ORDER + 1):
        grams[back:] |= data[:-back] << 8 * back
    grams &= np.array([(1 << 8 * (k + 1)) - 1 for k in range(ORDER + 1)])[size]
    grams |= size << 8 * (ORDER + 1)
    predicted = np.ones(len(data), dtype=bool)
    predicted[start] = False
    return grams[predicted], np.repeat(np.arange(len(texts)), lengths - 1)


def _chunks(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    """Lists of texts of about CHUNK_BYTES together."""
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text) + 3
        if size > CHUNK_BYTES:
            yield some
            some, size = [], 0
    if some:
        yield some


class _Counts:
    """Distinct numbers and their counts."""

    def __init__(self):
        self.keys, self.times, self.held = [], [], 0

    def add(self, keys: np.ndarray, times: np.ndarray) -> None:
        self.keys.append(keys)
        self.times.append(times)
        self.held += len(keys)
        if self.held > HELD_GRAMS and len(self.keys) > 8:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        keys, index = np.unique(np.concatenate(self.keys), return_inverse=True)
        times = np.bincount(index, weights=np.concatenate(self.times),
                            minlength=len(keys)).astype(np.int64)
        self.keys, self.times, self.held = [keys], [times], len(keys)
        return keys, times


ROWS = ("block long, kind int, doc_id {id}, held_out boolean, n_words long, text binary, "
        "place int, word binary, gram long, n long")
ARROW = {"held_out": pa.bool_(), "n_words": pa.int64(), "text": pa.binary(),
         "place": pa.int32(), "word": pa.binary(), "gram": pa.int64(), "n": pa.int64()}
DOC, WORD, GRAM = 0, 1, 2


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES, across: bool = False) -> DataFrame:
    """Documents (doc_id, text, held_out) as blocks.

    Kind 0 has a document's words, compressed, and its place in the block; kind 1 the block's
    distinct words, numbered by first appearance, and kind 2 its distinct contexts with symbols,
    both with n, their occurrences in training texts.
    """
    id_type = dict(docs.dtypes)["doc_id"]

    def run(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        numbers, size = _Numbers(), 0
        trained = np.zeros(0, dtype=np.int64)
        counts, waiting, wait = _Counts(), {True: [], False: []}, 0

        def count_waiting() -> None:
            for out, texts in waiting.items():
                if texts:
                    keys, times = np.unique(text_grams(texts, across)[0], return_counts=True)
                    counts.add(keys, np.zeros_like(times) if out else times)
                    texts.clear()

        for batch in batch_iter:
            for i, (text, out) in enumerate(zip(batch.column(1).to_pylist(),
                                                batch.column(2).to_pylist())):
                raw = (text or "").encode().lower()
                if held and size + len(raw) > block_bytes:
                    count_waiting()
                    yield from flush(part << 32 | number, held, numbers, trained, counts)
                    held, numbers, size, number = [], _Numbers(), 0, number + 1
                    trained, counts, wait = np.zeros(0, dtype=np.int64), _Counts(), 0
                words = raw.split()
                places = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
                if len(numbers) > len(trained):
                    trained = np.pad(trained, (0, 2 * len(numbers) - len(trained)))
                if not out:
                    np.add.at(trained, places, 1)
                text = b" ".join(words)
                waiting[bool(out)].append(text)
                held.append((batch.column(0)[i], out, len(words), _pack(text)))
                size += len(raw)
                wait += len(raw)
                if wait > CHUNK_BYTES:
                    count_waiting()
                    wait = 0
        if held:
            count_waiting()
            yield from flush(part << 32 | number, held, numbers, trained, counts)

    def flush(block: int, held: list, numbers: _Numbers, trained: np.ndarray,
              counts: _Counts) -> Iterator[pa.RecordBatch]:
        kinds = {"block": pa.int64(), "kind": pa.int32(), "doc_id": held[0][0].type, **ARROW}

        def rows(block: int, kind: int, size: int, **values) -> pa.RecordBatch:
            columns = {"block": pa.array(np.full(size, block)),
                       "kind": pa.array(np.full(size, kind, dtype=np.int32)), **values}
            return pa.RecordBatch.from_arrays(
                [columns[c] if c in columns else pa.nulls(size, t) for c, t in kinds.items()],
                names=list(kinds))

        for start in range(0, len(held), 1000):
            some = held[start:start + 1000]
            yield rows(
                block, DOC, len(some),
                place=pa.array(np.arange(start, start + len(some), dtype=np.int32)),
                doc_id=pa.array([d[0].as_py() for d in some], kinds["doc_id"]),
                held_out=pa.array([d[1] for d in some], pa.bool_()),
                n_words=pa.array([d[2] for d in some], pa.int64()),
                text=pa.array([d[3] for d in some], pa.binary()))
        words = list(numbers)
        for start in range(0, len(words), 50_000):
            some = words[start:start + 50_000]
            yield rows(block, WORD, len(some), word=pa.array(some, pa.binary()),
                       place=pa.array(np.arange(start, start + len(some), dtype=np.int32)),
                       n=pa.array(trained[start:start + len(some)]))
        grams, total = counts.merge()
        for start in range(0, len(grams), 100_000):
            some = slice(start, start + 100_000)
            yield rows(block, GRAM, len(grams[some]), gram=pa.array(grams[some]),
                       n=pa.array(total[some]))

    return docs.select("doc_id", "text", "held_out").mapInArrow(
        tidy(run), ROWS.format(id=id_type))


def contexts(grams: DataFrame) -> DataFrame:
    """The trie: size, context, and its symbols with counts (at most 256), for all lengths."""
    size = F.shiftright("gram", 8 * (ORDER + 1)).cast("int")
    return (
        grams.filter("n > 0")
        .select("gram", "n", F.explode(F.sequence(F.lit(0), size)).alias("size"))
        .select("size", _context(F.col("gram"), F.col("size")).alias("context"),
                F.col("gram").bitwiseAND(0xFF).cast("int").alias("symbol"), "n")
        .groupBy("size", "context", "symbol").agg(F.sum("n").alias("n"))
        .groupBy("size", "context").agg(F.collect_list(F.struct("symbol", "n")).alias("seen")))


def _context(gram: Column, size: Column) -> Column:
    """The last ``size`` bytes before the symbol."""
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), (size * 8).cast("int")) - 1
    return F.shiftright(gram, 8).bitwiseAND(mask)


def code_lengths(grams: DataFrame) -> DataFrame:
    """gram, logp: log10 of each symbol's probability in its context, escapes included.

    ``grams`` has every (context, symbol) that is asked for, with n, its training count.
    """
    size = F.shiftright("gram", 8 * (ORDER + 1)).cast("int")
    whole = F.shiftright("gram", 8)
    # A context of full length seen with the symbol answers at once; it has at most 256 symbols.
    # A shorter one, as at a text's start, may also be the end of longer ones: the trie has it.
    direct = (F.col("n") > 0) & (size == ORDER)
    known = (
        grams.filter(direct).withColumn("whole", whole)
        .groupBy("whole").agg(F.sum("n").alias("total"),
                              F.collect_list(F.struct("gram", "n")).alias("own"))
        .select("total", F.explode("own").alias("own"))
        .select("own.gram", F.log10((F.col("own.n") - 0.5) / F.col("total")).alias("logp")))
    trie = settle(contexts(grams))
    none = F.array().cast("array<int>")
    left = grams.filter(~direct).select(
        "gram", F.col("gram").bitwiseAND(0xFF).cast("int").alias("symbol"),
        size.alias("length"), F.lit(0.0).alias("logp"), none.alias("out"),
        F.lit(False).alias("done"))
    for level in range(ORDER, -1, -1):
        nodes = trie.filter(F.col("size") == level).select(
            F.col("context").alias("node"), "seen")
        if level <= 1:  # at most 257 contexts of at most 256 symbols
            nodes = F.broadcast(nodes)
        # Rows that need no answer here get a key of their own, so they do not pile up.
        asked = ~F.col("done") & (F.col("length") >= level)
        node = F.when(asked, _context(F.col("gram"), F.lit(level))).otherwise(-1 - F.col("gram"))
        met = left.withColumn("node", node).join(nodes, "node", "left").drop("node")
        fresh = F.coalesce(F.filter("seen", lambda e: ~F.array_contains(F.col("out"), e.symbol)),
                           F.array().cast("array<struct<symbol:int,n:bigint>>"))
        met = met.withColumn("fresh", fresh)
        met = met.withColumns({
            "kinds": F.size("fresh"),
            "own": F.try_element_at(F.transform(F.filter(
                "fresh", lambda e: e.symbol == F.col("symbol")), lambda e: e.n), F.lit(1)),
            "total": F.aggregate("fresh", F.lit(0).cast("long"), lambda a, e: a + e.n)})
        part = F.when(F.col("kinds") > 0, F.log10(
            F.coalesce(F.col("own") - 0.5, 0.5 * F.col("kinds")) / F.col("total"))).otherwise(0.0)
        left = met.select(
            "gram", "symbol", "length", (F.col("logp") + part).alias("logp"),
            F.when(F.col("seen").isNull(), F.col("out"))
            .otherwise(F.transform("seen", lambda e: e.symbol)).alias("out"),
            (F.col("done") | F.col("own").isNotNull()).alias("done"))
    rest = F.when(F.col("done"), 0.0).otherwise(-F.log10(F.lit(SYMBOLS) - F.size("out")))
    return known.unionByName(left.select("gram", (F.col("logp") + rest).alias("logp")))


def ppm_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id",
               text_col: str = "text", block_bytes: int = BLOCK_BYTES,
               across: bool = False) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows for which ``held_out`` (over doc_id) is true teach nothing. Tokens are runs of
    non-blanks, A-Z lower-cased, and one end; n_known counts those seen in training. base_score
    is the unigram log10 probability with one added to every count, score that of the PPM model.
    Null and empty texts consist of the end only. Rows with a repeated id are scored, and learned
    from, each on its own. With ``across`` contexts run over the blanks of a text, so the order of
    its words counts; else a byte is predicted from its own word only. Without training texts all symbols are equally likely and base_score
    is 0. An empty table gives no rows; other columns are not read.
    """
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).select(
        "doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    id_type = dict(given.dtypes)["doc_id"]
    parts = settle(blocks(given, block_bytes, across))
    words = settle(parts.filter(F.col("kind") == WORD).groupBy("word")
                   .agg(F.sum("n").alias("total")))
    grams = settle(parts.filter(F.col("kind") == GRAM).groupBy("gram").agg(F.sum("n").alias("n")))
    seen = words.agg(F.coalesce(F.sum("total"), F.lit(0)), F.count_if(F.col("total") > 0)).first()
    ends = parts.filter((F.col("kind") == DOC) & ~F.col("held_out")).count()
    train_tokens, kinds = seen[0] + ends, seen[1] + int(ends > 0)
    costs = code_lengths(grams)
    # Few columns, as each is there for all rows: what c and d mean depends on the kind.
    list_ = parts.filter(F.col("kind") == WORD).select("block", "place", "word")
    pairs = parts.filter(F.col("kind") == GRAM).select("block", "gram")
    union = (
        parts.filter(F.col("kind") == DOC)
        .select("block", "kind", "doc_id", "held_out", "n_words", "place", F.col("text").alias("c"))
        .unionByName(packed(list_.join(words, "word").select(
            "block", F.col("place").cast("long"), F.col("total").cast("double")), WORD),
            allowMissingColumns=True)
        .unionByName(packed(pairs.join(costs, "gram").select("block", "gram", "logp"), GRAM),
                     allowMissingColumns=True))

    def numbers(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        def column(name: str, use) -> np.ndarray:
            return np.concatenate([use(v.as_py()) for v in rows.column(name)])

        return (column("c", lambda v: np.cumsum(_unpack_numbers(v, np.int64))),
                column("d", lambda v: _unpack_numbers(v, np.float64)))

    def run(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        texts = table.filter(pa.array(kind == DOC)).sort_by("place")
        places, totals = numbers(table.filter(pa.array(kind == WORD))) if (
            kind == WORD).any() else (np.zeros(0, dtype=np.int64), np.zeros(0))
        grams, cost = numbers(table.filter(pa.array(kind == GRAM)))
        del table
        lookup = _Lookup(grams)
        total = np.zeros(len(places), dtype=np.int64)
        total[places] = totals
        number = _Numbers()  # the words come in the same order as when they were listed
        scale = train_tokens + kinds + 1
        base = np.log10((total + 1) / scale)
        found = {"n_known": [], "base_score": [], "score": []}
        for some in _chunks(_unpack(c.as_py()) for c in texts.column("c")):
            for text in some:
                words = text.split()
                at = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
                found["n_known"].append(int((total[at] > 0).sum()) + int(ends > 0))
                found["base_score"].append(float(base[at].sum() + np.log10((ends + 1) / scale)))
            own, owner = text_grams(some, across)
            found["score"].extend(np.bincount(
                owner, weights=cost[lookup(own)], minlength=len(some)).tolist())
        return pa.table({
            "doc_id": texts.column("doc_id"), "held_out": texts.column("held_out"),
            "n_tokens": pa.array(texts.column("n_words").to_numpy() + 1),
            "n_known": pa.array(found["n_known"], pa.int64()),
            "train_tokens": pa.array(np.full(len(texts), train_tokens, dtype=np.int64)),
            "base_score": pa.array(found["base_score"], pa.float64()),
            "score": pa.array(found["score"], pa.float64())})

    return union.groupBy("block").applyInArrow(
        run, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, "
        "train_tokens long, base_score double, score double")
