"""Alignment of two tokenizers over a corpus.

Equal texts are brought together by a shuffle on the full text, so that each distinct text is
tokenized and aligned once; what it adds to the corpus counts is weighted by its multiplicity, and
its measures are joined to all rows that have it.

Byte offsets at which a token of both tokenizers ends cut a text into groups. Tokens of both that
overlap in bytes are links: every offset at which any token ends closes exactly one link.

Texts are gathered into blocks of bounded size. Only a block's distinct id pairs are counted over
the corpus and looked up in the counts, so a pair that all texts hold is a row per block.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import PATTERN, byte_alphabet
from .common import settle, tidy

BLOCK_BYTES = 1 << 22
PIECE_SPACE = "▁"
KEY_BYTES = 32  # SHA-256 of a text


class ByteLevel:
    """A byte-level BPE file: ids of texts, special strings as plain text, and tokens' bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        self._library.encode_special_tokens = True
        alphabet = byte_alphabet()
        vocabulary = self._library.get_vocab(with_added_tokens=True)
        self.tokens: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            # a special token's text need not be in the alphabet; it never occurs in a result
            self.tokens[i] = (bytes(alphabet[c] for c in token)
                              if all(c in alphabet for c in token) else token.encode())
        self._fast = _as_ranks(path, alphabet)

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        found: list[np.ndarray | None] = [None] * len(texts)
        if self._fast is not None:
            for i, text in enumerate(texts):
                try:
                    found[i] = np.array(self._fast.encode_ordinary(text), dtype=np.uint32)
                except (KeyboardInterrupt, SystemExit):
                    raise
                except BaseException:  # it gives up on some very long runs; the library does not
                    continue
        rest = [i for i, ids in enumerate(found) if ids is None]
        for i, one in zip(rest, self._library.encode_batch_fast(
                [texts[i] for i in rest], add_special_tokens=False)):
            found[i] = np.array(one.ids, dtype=np.uint32)
        return found


def _as_ranks(path: str, alphabet: dict[str, int]):
    """The file as an encoder that merges by id, which is faster; None where ids do not say the
    order of merges or texts are changed before they are split."""
    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    model, split = whole["model"], whole["pre_tokenizer"] or {}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [model["vocab"].get("".join(m), -1) for m in merges]
    plain = (whole["normalizer"] is None and split.get("type") == "ByteLevel"
             and split.get("use_regex", True) and not split.get("add_prefix_space")
             and not model.get("dropout") and not model.get("ignore_merges"))
    if not plain or any(a >= b for a, b in zip(made, made[1:])) or -1 in made[:1]:
        return None
    import tiktoken

    ranks = {bytes(alphabet[c] for c in t): i for t, i in model["vocab"].items()
             if all(c in alphabet for c in t)}
    if len(ranks) < len(made) + 256:
        return None
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Pieces:
    """A sentence piece model: ids of texts and pieces' bytes. It puts a space before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self._model.id_to_piece(i) for i in range(self._model.vocab_size())]
        self.tokens = [bytes([int(p[1:-1], 16)]) if self._model.is_byte(i)
                       else p.replace(PIECE_SPACE, " ").encode() for i, p in enumerate(pieces)]

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        return self._model.encode(list(texts), num_threads=1)


class Aligner:
    """Both tokenizers, with the tables that alignment needs."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self._sizes, self._starts, self._bytes = [], [], []
        for x in (self.a, self.b):
            sizes = np.array([len(t) for t in x.tokens], dtype=np.int64)
            self._sizes.append(sizes)
            self._starts.append(np.cumsum(sizes) - sizes)
            self._bytes.append(np.frombuffer(b"".join(x.tokens), dtype=np.uint8))
        # Decimal ids with what follows: a comma, or the mark at the end of a group's part.
        self._texts = [np.array([[f"{i},", f"{i}{mark}"] for i in range(len(x.tokens))],
                                dtype=object) for x, mark in ((self.a, "|"), (self.b, ";"))]

    def _same(self, which: int, ids: list[np.ndarray], raw: list[bytes]) -> np.ndarray:
        """Whether the bytes of each text's tokens, joined, are the text's."""
        counts = np.array([len(x) for x in ids])
        flat = np.concatenate(ids).astype(np.int64)
        sizes = self._sizes[which][flat]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        cuts = ends[np.concatenate([[0], np.cumsum(counts)])]
        lengths = np.array([len(r) for r in raw])
        place = np.arange(ends[-1]) + np.repeat(self._starts[which][flat] - ends[:-1], sizes)
        joined = self._bytes[which][place].tobytes()
        equal = np.diff(cuts) == lengths
        if equal.all() and joined == b"".join(raw):
            return equal
        return np.array([joined[i:j] == r for i, j, r in zip(cuts, cuts[1:], raw)])

    def tokens(self, texts: Sequence[str]
               ) -> tuple[list[int], list[np.ndarray], list[np.ndarray]]:
        """Places of the texts that both tokenizers give back byte by byte, and their ids."""
        if not len(texts):
            return [], [], []
        spaced = [" " + t for t in texts]
        raw = [t.encode() for t in spaced]
        ids_a = self.a.encode(spaced)
        ids_b = [np.array(x, dtype=np.uint32) for x in self.b.encode(texts)]
        good = np.flatnonzero(self._same(0, ids_a, raw) & self._same(1, ids_b, raw)).tolist()
        return good, [ids_a[i] for i in good], [ids_b[i] for i in good]

    def align(self, ids_a: list[np.ndarray], ids_b: list[np.ndarray]) -> dict:
        """Measures and links of texts, laid end to end.

        Per text: n_a, n_b, n_groups, n_links and groups, the ids by group as text. ``ids`` are
        all ids, ``links`` the places in them of the tokens of each link, in order, and ``owner``
        the text of each link.
        """
        counts = [np.array([len(x) for x in ids], dtype=np.int64) for ids in (ids_a, ids_b)]
        flat = [np.concatenate(ids).astype(np.int64) for ids in (ids_a, ids_b)]
        ends = [np.cumsum(size[ids]) for size, ids in zip(self._sizes, flat)]
        # What ends at each byte: a token of a (1), of b (2), a text (4).
        marks = np.zeros(ends[0][-1] + 1, dtype=np.uint8)
        marks[ends[0]] = 1
        marks[ends[1]] |= 2
        marks[ends[0][np.cumsum(counts[0]) - 1]] |= 4
        marks = marks[marks > 0]  # one per offset at which a token ends: one per link
        closes = [(marks & 1) > 0, (marks & 2) > 0]
        shared = closes[0] & closes[1]
        texts = (marks & 4) > 0

        def earlier(flags: np.ndarray) -> np.ndarray:
            return np.cumsum(flags) - flags

        owner, group = earlier(texts), earlier(shared)
        links = [earlier(c) for c in closes]
        # Within a group the tokens of a come first, then those of b.
        upto = [np.concatenate([[0], (link + 1)[shared]]) for link in links]
        out = np.empty(len(flat[0]) + len(flat[1]), dtype=object)
        in_a, in_b = group[closes[0]], group[closes[1]]
        out[np.arange(len(flat[0])) + upto[1][in_a]] = self._texts[0][
            flat[0], shared[closes[0]].view(np.int8)]
        out[np.arange(len(flat[1])) + upto[0][in_b + 1]] = self._texts[1][
            flat[1], shared[closes[1]].view(np.int8)]
        cuts = np.concatenate([[0], np.cumsum(counts[0] + counts[1])]).tolist()
        pieces = out.tolist()
        n = len(counts[0])
        return {
            "n_a": counts[0], "n_b": counts[1],
            "n_groups": np.bincount(owner[shared], minlength=n),
            "n_links": np.bincount(owner, minlength=n),
            "groups": ["".join(pieces[i:j])[:-1] for i, j in zip(cuts, cuts[1:])],
            "ids": flat, "owner": owner, "links": links,
        }


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


MEASURES = ("n_a", "n_b", "n_groups", "n_links")
BLOCK = ("block bigint, keys binary, digests binary, n_a array<bigint>, n_b array<bigint>, "
         "n_groups array<bigint>, n_links array<bigint>, n_pairs array<bigint>, at binary, "
         "times binary, pairs array<bigint>, docs array<bigint>")
BLOCK_NAMES = [x.split()[0] for x in BLOCK.split(", ")]


def _block(number: int, texts: list[str], times: list[int],
           use: Aligner) -> pa.RecordBatch | None:
    """A block's measures, its distinct pairs with the documents that hold them, and the links of
    each text as places among those pairs."""
    places, ids_a, ids_b = use.tokens(texts)
    if not places:
        return None
    found = use.align(ids_a, ids_b)
    a, b = (ids[link] for ids, link in zip(found["ids"], found["links"]))
    pairs, which = np.unique(a << 32 | b, return_inverse=True)
    held, n = np.unique(found["owner"] * len(pairs) + which, return_counts=True)
    owner, at = held // len(pairs), held % len(pairs)
    weights = np.array([times[i] for i in places], dtype=np.int64)
    docs = np.zeros(len(pairs), dtype=np.int64)
    np.add.at(docs, at, weights[owner])
    values = {
        "block": number,
        "keys": b"".join(hashlib.sha256(texts[i].encode()).digest() for i in places),
        "digests": b"".join(hashlib.sha256(g.encode()).digest() for g in found["groups"]),
        **{name: found[name].tolist() for name in MEASURES},
        "n_pairs": np.bincount(owner, minlength=len(places)).tolist(),
        "at": at.astype(np.uint32).tobytes(), "times": n.astype(np.uint32).tobytes(),
        "pairs": pairs, "docs": docs,
    }
    lists = pa.list_(pa.int64())
    kinds = {"block": pa.int64(), **dict.fromkeys(("keys", "digests", "at", "times"), pa.binary())}
    return pa.RecordBatch.from_arrays(
        [pa.array([values[c]], kinds.get(c, lists)) for c in BLOCK_NAMES], names=BLOCK_NAMES)


def aligned_blocks(distinct: DataFrame, path_a: str, path_b: str,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Distinct texts (text, n) as blocks; texts without an alignment are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        use = aligner(path_a, path_b)
        texts, times, size = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            block = _block(number, texts, times, use)
            if block is not None:
                yield block

        for batch in batches:
            for text, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if texts and size + len(text) > block_bytes:
                    yield from flush()
                    texts, times, size, number = [], [], 0, number + 1
                texts.append(text)
                times.append(n)
                size += len(text)
        if texts:
            yield from flush()

    return distinct.select("text", "n").mapInArrow(tidy(run), BLOCK)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair (a in the upper half, b in the lower), a, b, n: the documents that hold it linked, and
    best: whether no pair of its a has more."""
    n = F.col("n")
    of_a = Window.partitionBy("a")  # as many rows as b has ids, at most
    return (
        blocks.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("n"))
        .select("pair", F.shiftright("pair", 32).alias("a"),
                F.col("pair").bitwiseAND((1 << 32) - 1).alias("b"), "n")
        .withColumn("best", n == F.max(n).over(of_a)))


ALIGNED = ("key binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
           "count_sum bigint, groups_sha256 string")


def text_measures(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """Per distinct text, by the SHA-256 of it: its measures, with those of the corpus counts."""
    asked = blocks.select("block", F.posexplode("pairs").alias("at", "pair"))
    answers = (
        asked.join(counts.select("pair", "n", "best"), "pair")
        .groupBy("block").agg(F.sort_array(F.collect_list(F.struct("at", "n", "best"))).alias("c"))
        .select("block", F.col("c.n").alias("counts"), F.col("c.best").alias("best")))
    names = ["keys", "digests", *MEASURES, "n_pairs", "at", "times", "counts", "best"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in names}
                lists = {c: np.asarray(row[c].values) for c in (*MEASURES, "n_pairs", "counts")}
                best = row["best"].values.to_numpy(zero_copy_only=False)
                at = np.frombuffer(row["at"].as_py(), dtype=np.uint32)
                times = np.frombuffer(row["times"].as_py(), dtype=np.uint32).astype(np.int64)
                starts = np.concatenate([[0], np.cumsum(lists["n_pairs"])[:-1]])
                keys, digests = row["keys"].as_py(), row["digests"].as_py()
                cuts = range(0, len(keys), KEY_BYTES)
                yield pa.RecordBatch.from_arrays([
                    pa.array([keys[j:j + KEY_BYTES] for j in cuts], pa.binary()),
                    *[pa.array(lists[c], pa.int64()) for c in MEASURES],
                    pa.array(np.add.reduceat(times * best[at], starts), pa.int64()),
                    pa.array(np.add.reduceat(times * lists["counts"][at], starts), pa.int64()),
                    pa.array([digests[j:j + KEY_BYTES].hex() for j in cuts], pa.string()),
                ], names=["key", *MEASURES, "n_best", "count_sum", "groups_sha256"])

    return blocks.drop("pairs", "docs").join(answers, "block").select(*names).mapInArrow(
        tidy(run), ALIGNED)


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
                     text_col: str = "text", block_bytes: int = BLOCK_BYTES
                     ) -> tuple[DataFrame, DataFrame]:
    """Measures of every row, and the corpus-wide pair counts.

    ``path_a`` is a byte-level BPE file, given a space and the text; ``path_b`` a sentence piece
    model, which adds the space itself. The first table has one row per input row: the id, n_a
    and n_b (tokens), n_groups, n_links, n_best (links whose count is the highest of their a),
    count_sum (of the counts over links) and groups_sha256 of the ids by group, written
    ``a1,a2|b1;a3|b2,b3``. The second is that of :func:`pair_counts`.

    Null and empty texts, and such as either tokenizer does not give back byte by byte, have no
    tokens: zeros and an empty digest. Repeated rows, also with one id, count each as a document.
    An empty table gives empty results; other columns are not read. Texts are never cut; a text
    longer than ``block_bytes`` is a block of its own.
    """
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    distinct = given.filter("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    blocks = settle(aligned_blocks(distinct, path_a, path_b, block_bytes))
    counts = settle(pair_counts(blocks))
    key = F.unhex(F.sha2("text", 256))
    found = given.select("doc_id", key.alias("key")).join(
        text_measures(blocks, counts), "key", "left")
    numbers = [*MEASURES, "n_best", "count_sum"]
    measures = found.select(
        "doc_id", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in numbers],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    return measures, counts
