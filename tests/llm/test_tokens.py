"""BPE and token counts against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import pytest
from corpus import EDGES, documents, edge_rows

from rosterline.llm.bpe import (Decoder, Encoder, PieceEncoder, Vocabulary, sufficient_lookahead,
                                transcode)
from rosterline.llm.queries import tokenizer_path
from rosterline.llm.token_counts import lengths, safe_pieces, token_counts

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(tokenizer_path())


def hard_texts() -> list[str]:
    rng = random.Random(4)
    parts = ["anti", "dis", "establish", "ment", "arian", "ism", "th", "in", "ation", "qu"]
    return [
        *filter(None, EDGES),
        "".join(rng.choice(parts) for _ in range(900)),
        "".join(rng.choice("abcdefghij") for _ in range(4000)),
        "".join(chr(rng.randrange(32, 0x2fff)) for _ in range(1500)),
        " ".join("".join(rng.choice("theranoingd") for _ in range(rng.randint(1, 12)))
                 for _ in range(3000)),
        " " * 700, "a" * 2500, "=-" * 900 + "é" * 400, "9" * 1200 + "x1" * 800,
    ]


def test_encode_and_decode_as_the_library(library, vocabulary):
    encoder, decoder = Encoder(vocabulary), Decoder(vocabulary)
    for text in hard_texts():
        expected = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == expected
        assert decoder.decode(expected) == library.decode(expected, skip_special_tokens=False)


def test_stream_of_small_steps_equals_the_whole(vocabulary):
    rng = random.Random(5)
    for _ in range(30):
        raw = bytes(rng.choice(b"abcdehinorst") for _ in range(rng.randint(1, 900)))
        encoder = PieceEncoder(vocabulary, step=rng.choice([1, 7, 50]))
        found = []
        at = 0
        while at < len(raw):
            size = rng.randint(1, 60)
            found.extend(encoder.push(raw[at:at + size]))
            at += size
            assert len(encoder.window) < vocabulary.lookahead + 2 * 60
        assert found + encoder.finish() == vocabulary.merge_all(raw)


def test_lookahead_of_a_chain():
    # c may take b away from ab, and d may take c away from bc.
    merges = [(b"c", b"d"), (b"b", b"c"), (b"a", b"b")]
    assert sufficient_lookahead(merges) == 3
    assert sufficient_lookahead([(b"a", b"b")]) == 1
    assert sufficient_lookahead([]) == 0


def test_decoder_in_parts(vocabulary):
    text = "é\U0001f600日" * 20
    ids = Encoder(vocabulary).encode(text)
    decoder = Decoder(vocabulary)
    parts = [decoder.push([i]) for i in ids] + [decoder.finish()]
    assert "".join(parts) == text
    assert Decoder(vocabulary).decode(ids[1:2]) == "".join(
        bytes([b]).decode("utf-8", "replace") for b in vocabulary.tokens[ids[1]][:1])


def test_transcode_edges(spark, library):
    df = documents(spark, edge_rows())
    outputs = {"ids": "token_ids", "n": "n_tokens", "ids_hash": "ids_sha256", "back": "decoded",
               "hash": "decoded_sha256"}
    rows = transcode(df, tokenizer_path(), outputs).collect()
    assert len(rows) == len(edge_rows())
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert (r["ids"], r["n"], r["back"]) == (ids, len(ids), r["text"] or "")
        assert r["ids_hash"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["hash"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    with pytest.raises(ValueError):
        transcode(df, tokenizer_path(), {"Text": "decoded"})
    assert transcode(df.limit(0), tokenizer_path(), outputs).count() == 0


def test_pieces_add_up(library):
    for text in hard_texts():
        pieces = list(safe_pieces(text, 50))
        assert "".join(pieces) == text
        whole = len(library.encode(text, add_special_tokens=False).ids)
        assert sum(len(library.encode(p, add_special_tokens=False).ids) for p in pieces) == whole
    assert max(map(len, safe_pieces("ab cd " * 5000, 60))) < 80


def test_lengths_in_small_batches(library):
    texts = [None, "", *hard_texts()]
    expected = [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert lengths(texts, tokenizer_path(), batch_bytes=300, piece_chars=40) == expected


def test_other_models():
    import public_tokenizers
    import sentencepiece

    texts = [t for t in EDGES if t]
    path = str(public_tokenizers.path("piece_bpe_32k.model"))
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    assert lengths(texts, path) == [len(model.encode(t)) for t in texts]
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    model = tokenizers.Tokenizer.from_file(path)
    assert lengths(texts, path, piece_chars=20) == [
        len(model.encode(t, add_special_tokens=False).ids) for t in texts]


def test_token_counts_edges(spark, library):
    df = documents(spark, edge_rows(), clashing=True)
    rows = token_counts(df, tokenizer_path(), limit=3).collect()
    assert len(rows) == len(edge_rows())
    expected = {i: t or "" for i, t in edge_rows() if i is not None}
    for r in rows:
        if r["doc_id"] is None:
            continue
        text = expected[r["doc_id"]]
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 3)
    assert token_counts(df.limit(0), tokenizer_path()).count() == 0
