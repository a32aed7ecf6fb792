"""Byte-level BPE as a streaming transducer, and its inverse.

The merge list bounds how far to the right of a place its tokens can depend on: the sufficient
lookahead. Tokens that end that far before the end of what has been read are stable, whatever
follows, so a pre-token of any length is encoded in a window of constant size. Decoding runs the
tokens' bytes through an incremental UTF-8 state machine.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from .common import tidy

# Fixed value: the split pattern of byte-level tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED = 200_000
SHORT = 48
STEP = 512
DECODE_STEP = 1 << 16
ID_BITS = 32
ID_MASK = (1 << ID_BITS) - 1
NO_MERGE = 1 << 62


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = [b for b in range(256)
             if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def sufficient_lookahead(merges: Sequence[tuple[bytes, bytes]]) -> int:
    """How many bytes after a token's end can decide whether it stays.

    Whether the merge (t, x) takes place after a finished t depends on the bytes of x, and on
    what may take a right part s of x away before x is used: an earlier merge (s, y), which in
    turn depends on what follows. Merges are visited in order, so all earlier ones are known.
    """
    made: dict[bytes, tuple[int, bytes]] = {}  # token: rank of its merge, right part
    by_left: dict[bytes, tuple[list[int], list[int]]] = {}  # ranks; greatest need so far
    most = 0
    for rank, (left, right) in enumerate(merges):
        need, part, used_at = 0, right, rank
        while True:
            ranks, needs = by_left.get(part, ((), ()))
            known = bisect_left(ranks, used_at)
            if known:
                need = max(need, needs[known - 1])
            if part not in made:
                break
            used_at, part = made[part]
        need += len(right)
        ranks, needs = by_left.setdefault(left, ([], []))
        ranks.append(rank)
        needs.append(max(need, needs[-1] if needs else 0))
        made.setdefault(left + right, (rank, right))
        most = max(most, need)
    return most


class Vocabulary:
    """Tokens, merges, special strings and lookahead of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        as_byte = byte_alphabet()
        raw = {t: bytes(as_byte[c] for c in t) for t in data["model"]["vocab"]}
        ids = {raw[t]: i for t, i in data["model"]["vocab"].items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m)
                 for m in data["model"]["merges"]]
        merges = [(raw[a], raw[b]) for a, b in pairs]
        # Rank and new id in one number, so that the least is the next merge.
        self.merges = {(ids[a], ids[b]): rank << ID_BITS | ids[a + b]
                       for rank, (a, b) in reversed(list(enumerate(merges)))}
        self.byte_ids = [ids[bytes([b])] for b in range(256)]
        self.specials = {x["content"]: x["id"] for x in data.get("added_tokens", [])}
        size = max(*ids.values(), *self.specials.values(), 0) + 1
        self.tokens = [b""] * size
        for token, i in ids.items():
            self.tokens[i] = token
        for text, i in self.specials.items():
            self.tokens[i] = text.encode()
        self.lookahead = sufficient_lookahead(merges)

    def merge_all(self, piece: bytes) -> list[int]:
        """Apply the merges, lowest rank and then leftmost first, to one window."""
        get, ids = self.merges.get, [self.byte_ids[b] for b in piece]
        found = [get(pair, NO_MERGE) for pair in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best == NO_MERGE:
                break
            at, new = found.index(best), best & ID_MASK
            ids[at:at + 2] = [new]
            del found[at]
            if at:
                found[at - 1] = get((ids[at - 1], new), NO_MERGE)
            if at < len(found):
                found[at] = get((new, ids[at + 1]), NO_MERGE)
        return ids


class PieceEncoder:
    """Encodes one pre-token that arrives in parts, in a window of bounded size."""

    def __init__(self, vocabulary: Vocabulary, step: int = STEP):
        self.vocabulary, self.step, self.window = vocabulary, step, b""

    def push(self, part: bytes) -> Iterator[int]:
        """Take in more bytes and emit the tokens that are stable by now."""
        keep = self.vocabulary.lookahead
        for start in range(0, len(part), self.step):
            self.window += part[start:start + self.step]
            if len(self.window) < keep + self.step:
                continue
            stable, end = len(self.window) - keep, 0
            for token in self.vocabulary.merge_all(self.window):
                if end + len(self.vocabulary.tokens[token]) > stable:
                    break
                end += len(self.vocabulary.tokens[token])
                yield token
            self.window = self.window[end:]

    def finish(self) -> list[int]:
        """The tokens of what is left; the encoder can then take the next pre-token."""
        rest, self.window = self.window, b""
        return self.vocabulary.merge_all(rest)


class _Pieces(dict):
    """Ids of short pre-tokens, made on first use; forgotten when there are too many."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode()
        if len(raw) > SHORT:
            encoder = PieceEncoder(self.vocabulary)
            return (*encoder.push(raw), *encoder.finish())
        if len(self) >= CACHED:
            self.clear()
        found = self[piece] = tuple(self.vocabulary.merge_all(raw))
        return found


class Encoder:
    """Whole texts to token ids; special strings in a text become their own ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pieces = _Pieces(vocabulary)
        self.split = regex.compile(PATTERN)
        specials = sorted(vocabulary.specials, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None

    def _plain(self, text: str) -> Iterable[int]:
        return chain.from_iterable(map(self.pieces.__getitem__, self.split.findall(text)))

    def encode(self, text: str) -> list[int]:
        if self.special is None or self.special.search(text) is None:
            return list(self._plain(text))
        ids, at = [], 0
        for found in self.special.finditer(text):
            ids.extend(self._plain(text[at:found.start()]))
            ids.append(self.vocabulary.specials[found.group()])
            at = found.end()
        ids.extend(self._plain(text[at:]))
        return ids


class Decoder:
    """Token ids to text, part by part; bytes that are no UTF-8 become U+FFFD."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.machine = codecs.getincrementaldecoder("utf-8")(errors="replace")

    def push(self, ids: Sequence[int]) -> str:
        return self.machine.decode(b"".join(map(self.vocabulary.tokens.__getitem__, ids)))

    def finish(self) -> str:
        rest = self.machine.decode(b"", final=True)
        self.machine.reset()
        return rest

    def decode(self, ids: Sequence[int]) -> str:
        parts = [self.push(ids[i:i + DECODE_STEP]) for i in range(0, len(ids), DECODE_STEP)]
        return "".join([*parts, self.finish()])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file; one per Python worker, so that its pieces are reused."""
    return Encoder(Vocabulary(path))


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# What can be asked for, and its type.
OUTPUTS = {"token_ids": "array<int>", "n_tokens": "long", "ids_sha256": "string",
           "decoded": "string", "decoded_sha256": "string"}


def transcode(docs: DataFrame, tokenizer_path: str, outputs: dict[str, str],
              text_col: str = "text") -> DataFrame:
    """Encode each row's text, decode the ids again, and add the outputs asked for.

    ``outputs`` maps new column names to kinds: token_ids, n_tokens, ids_sha256 (of the decimal
    ids joined by commas), decoded, decoded_sha256. All columns of the input stay; a new name
    that is already taken is an error. One row per row, repeated rows included. Null and empty
    texts have no ids and decode to the empty text. Texts of any length are encoded whole; memory
    beyond a row's own ids is constant. An empty table stays empty.
    """
    clash = {c.lower() for c in docs.columns} & {c.lower() for c in outputs}
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    place = docs.columns.index(text_col)
    kinds = list(outputs.values())
    arrow = {"token_ids": pa.list_(pa.int32()), "n_tokens": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer_path)
        decoder = Decoder(coder.vocabulary)
        decimal = list(map(str, range(len(coder.vocabulary.tokens))))
        for batch in batches:
            made: dict[str, list] = {kind: [] for kind in kinds}
            for text in batch.column(place).to_pylist():
                ids = coder.encode(text) if text else []
                if "token_ids" in made:
                    made["token_ids"].append(ids)
                if "n_tokens" in made:
                    made["n_tokens"].append(len(ids))
                if "ids_sha256" in made:
                    made["ids_sha256"].append(_sha256(",".join(map(decimal.__getitem__, ids))))
                if "decoded" in made or "decoded_sha256" in made:
                    decoded = decoder.decode(ids)
                    if "decoded" in made:
                        made["decoded"].append(decoded)
                    if "decoded_sha256" in made:
                        made["decoded_sha256"].append(_sha256(decoded))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(made[k], arrow.get(k, pa.string())) for k in kinds]],
                names=[*batch.schema.names, *outputs])

    added = StructType.fromDDL(", ".join(f"`{n}` {OUTPUTS[k]}" for n, k in outputs.items()))
    return docs.mapInArrow(tidy(run), StructType([*docs.schema.fields, *added.fields]))
