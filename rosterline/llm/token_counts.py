"""Token counts of whole texts without keeping the tokens.

Arrow functions feed the tokenizer batches of about equal bytes, and only lengths come back. A
text longer than a piece is cut where no token can span the cut, so the parts' counts add up.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import tidy

BATCH_BYTES = 1 << 18
PIECE_CHARS = 1 << 15
# Cuts: before a blank, or before a word piece's space mark, between two letters or digits.
BLANK_CUT = re.compile(r"(?<=[^\W_])(?= [^\W_])")
KIND_CUT = re.compile(r"(?<=[^\W\d_])(?=[0-9])|(?<=[0-9])(?=[^\W\d_])")


def safe_pieces(text: str, piece_chars: int = PIECE_CHARS, by_kind: bool = True) -> Iterator[str]:
    """Cut a text into pieces of about ``piece_chars`` characters that can be encoded apart.

    Blanks between letters or digits start a new token in every pre-tokenizer here. A stretch
    without such a blank is cut between a letter and an ASCII digit if ``by_kind`` says that the
    pre-tokenizer separates them; a stretch without either stays whole, however long.
    """
    start = 0
    while len(text) - start > piece_chars:
        cut = BLANK_CUT.search(text, start + piece_chars)
        if by_kind and (cut is None or cut.start() > start + 2 * piece_chars):
            cut = KIND_CUT.search(text, start + piece_chars) or cut
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


@lru_cache(maxsize=4)
def _counter(path: str):
    """The tokenizer at the path as a function from texts to lengths, and whether kinds cut."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return (lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]), None
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    splits = '"ByteLevel"' in model.to_str()[:100_000] and model.normalizer is None
    return (lambda texts: [len(x) for x in model.encode_batch_fast(
        texts, add_special_tokens=False)]), splits


def lengths(texts: list[str | None], path: str, batch_bytes: int = BATCH_BYTES,
            piece_chars: int = PIECE_CHARS) -> list[int]:
    """Tokens per text; null counts as empty. Only byte-level models are cut into pieces."""
    count, splits = _counter(path)
    totals = [0] * len(texts)
    batch: list[str] = []
    owners: list[int] = []
    held = 0

    def flush():
        for owner, n in zip(owners, count(batch)):
            totals[owner] += n
        batch.clear()
        owners.clear()

    for i, text in enumerate(texts):
        if not text:
            continue
        for piece in safe_pieces(text, piece_chars) if splits else (text,):
            batch.append(piece)
            owners.append(i)
            held += 4 * len(piece) if not piece.isascii() else len(piece)
            if held >= batch_bytes:
                flush()
                held = 0
    if batch:
        flush()
    return totals


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 1024,
                 batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Per row: the id, n_bytes (UTF-8), n_tokens, over_limit (more tokens than ``limit``).

    One output row per input row, in any order; repeated rows are counted each. Null and empty
    texts have 0 bytes and 0 tokens. Other columns of the input are not read, so their names
    cannot clash. An empty table gives an empty result. The tokenizer file must be readable at
    the same path on every executor.
    """
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n_tokens = lengths(texts, tokenizer_path, batch_bytes)
            n_bytes = [len(t.encode()) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                 pa.array([n > limit for n in n_tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_col, text_col).mapInArrow(
        tidy(run), f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
