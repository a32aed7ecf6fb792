"""Alignment of two tokenizers against a plain run over all pairs of tokens."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from corpus import documents, edge_rows, stock, words

from rosterline.llm.alignment import ByteLevel, align_tokenizers
from rosterline.llm.bpe import byte_alphabet
from rosterline.llm.queries import piece_path, tokenizer_path

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def libraries():
    byte_level = tokenizers.Tokenizer.from_file(tokenizer_path())
    byte_level.encode_special_tokens = True
    return byte_level, sentencepiece.SentencePieceProcessor(model_file=piece_path())


def spans(tokens: list[bytes]):
    at, found = 0, []
    for t in tokens:
        found.append((at, at + len(t)))
        at += len(t)
    return found


def plain(texts, libraries):
    """Per text: n_a, n_b, n_groups, n_links, n_best, count_sum, digest; and all counts."""
    byte_level, pieces = libraries
    alphabet = byte_alphabet()
    own = []
    for text in texts:
        if not text:
            own.append(None)
            continue
        a = byte_level.encode(" " + text, add_special_tokens=False)
        raw_a = [bytes(alphabet[c] for c in byte_level.id_to_token(i)) for i in a.ids]
        b = pieces.encode(text)
        raw_b = []
        for i in b:
            p = pieces.id_to_piece(i)
            raw_b.append(bytes([int(p[3:5], 16)]) if pieces.is_byte(i)
                         else p.replace("▁", " ").encode())
        if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            own.append(None)
            continue
        at_a, at_b = spans(raw_a), spans(raw_b)
        links = [(x, y) for x, (i, j) in zip(a.ids, at_a) for y, (k, m) in zip(b, at_b)
                 if i < m and k < j]
        cuts = sorted({j for _, j in at_a} & {j for _, j in at_b})
        groups, start = [], 0
        for end in cuts:
            groups.append(",".join(str(x) for x, (i, _) in zip(a.ids, at_a) if start <= i < end)
                          + "|" + ",".join(str(y) for y, (k, _) in zip(b, at_b)
                                           if start <= k < end))
            start = end
        own.append((len(a.ids), len(b), len(groups), links, ";".join(groups)))
    counts = Counter(pair for o in own if o for pair in set(o[3]))
    top = Counter()
    for (x, _), n in counts.items():
        top[x] = max(top[x], n)
    rows = []
    for o in own:
        if o is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, groups = o
        rows.append((n_a, n_b, n_groups, len(links), sum(counts[p] == top[p[0]] for p in links),
                     sum(counts[p] for p in links), hashlib.sha256(groups.encode()).hexdigest()))
    return rows, counts, top


def odd_texts() -> list:
    rng = random.Random(9)
    lexicon = stock(rng, 80)
    some = [" ".join(words(rng, rng.randint(1, 60), lexicon)) + "." for _ in range(40)]
    return [*[t for _, t in edge_rows()], *some, *some[:9], *[some[0]] * 30,
            "▁ mark", "<s>a</s> <unk> <0x41>", " leading", "trailing  ", "\x00", "a\r\n\tb",
            "日本語とテキスト\U0001f600", "the the the the", "naïve café déjà vu", "long " * 900]


@pytest.mark.parametrize("block_bytes", [1 << 22, 300])
def test_measures_and_counts(spark, libraries, block_bytes):
    texts = odd_texts()
    df = documents(spark, texts, clashing=True)
    measures, counts = align_tokenizers(df, tokenizer_path(), piece_path(),
                                        block_bytes=block_bytes)
    expected, pairs, top = plain(texts, libraries)
    found = {r["doc_id"]: tuple(r)[1:] for r in measures.collect()}
    assert sum(e[0] > 0 for e in expected) > 80
    for i, row in enumerate(expected):
        assert found[i] == row, texts[i][:80] if texts[i] else texts[i]
    assert {(r["a"], r["b"]): r["n"] for r in counts.collect()} == dict(pairs)
    assert all(r["best"] == (r["n"] == top[r["a"]]) for r in counts.collect())


def test_very_long_texts(spark, libraries):
    """Texts far longer than a block are aligned whole."""
    byte_level, pieces = libraries
    rng = random.Random(11)
    texts = [" ".join(words(rng, 40_000, stock(rng, 500))), "é日x" * 50_000, " " * 100_000 + "a"]
    df = documents(spark, texts)
    measures, _ = align_tokenizers(df, tokenizer_path(), piece_path(), block_bytes=1000)
    for r in measures.collect():
        a = byte_level.encode(" " + texts[r["doc_id"]], add_special_tokens=False).ids
        b = pieces.encode(texts[r["doc_id"]])
        assert (r["n_a"], r["n_b"]) == (len(a), len(b))
        assert r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"]
        assert r["n_links"] <= r["count_sum"] and 0 < r["n_best"] <= r["n_links"]


def test_repeated_rows_and_no_rows(spark):
    df = documents(spark, edge_rows())
    measures, _ = align_tokenizers(df, tokenizer_path(), piece_path())
    assert measures.count() == len(edge_rows())
    measures, counts = align_tokenizers(df.limit(0), tokenizer_path(), piece_path())
    assert measures.count() == counts.count() == 0


def test_merging_by_id_is_the_library_s_encoding(libraries):
    use = ByteLevel(tokenizer_path())
    assert use._fast is not None
    rng = random.Random(2)
    texts = [t for t in odd_texts() if t]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(32, 0x3000)]))
                      for _ in range(200)) for _ in range(100)]
    texts += ["".join(rng.choice("abcdeinorst") for _ in range(3000)), "<|endoftext|>" * 3]
    # every character of the first planes beside letters, digits, marks and blanks
    texts += [" ".join(f"a{c}1{c} {c}!{c}{c}x" for c in map(chr, range(i, i + 256)))
              for i in [*range(0, 0xD800, 256), *range(0xE000, 0x20000, 256)]]
    expected = [e.ids for e in libraries[0].encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in use.encode(texts)] == expected
