"""Exact dedup, near-dedup, line dedup and repeat removal against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest
from corpus import documents, edge_rows, stock, words
from pyspark.sql import functions as F

from rosterline.llm import minhash
from rosterline.llm.components import components
from rosterline.llm.exact_dedup import exact_dedup
from rosterline.llm.line_dedup import drop_lines, edit_distance_within, line_report
from rosterline.llm.minhash import drop_near_duplicates, near_duplicates
from rosterline.llm.queries import op4_line_dedup
from rosterline.llm.repeats import cut_repeats


def fold(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# Exact dedup

def check_exact(df, pairs, **options):
    groups = defaultdict(list)
    for doc_id, text in pairs:
        groups[fold(text)].append(doc_id)
    expected = []
    for doc_id, text in pairs:
        same = groups[fold(text)]
        keep = max((i for i in same if i is not None), default=None)
        expected.append((doc_id, keep, len(same), doc_id == keep,
                         hashlib.sha256(fold(text).encode()).hexdigest()))
    rows = exact_dedup(df, **options).drop("level", "name").collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, expected))


def test_exact_edges(spark):
    check_exact(documents(spark, edge_rows(), clashing=True), edge_rows(), block_bytes=4)


def test_exact_blocks(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(150)]
    texts += [t.upper() for t in texts[:60]] + ["ab" * 500] * 90 + ["ab" * 499 + "aa"] * 3
    check_exact(documents(spark, texts), list(enumerate(texts)), block_bytes=8)


def test_exact_empty_table(spark):
    assert exact_dedup(documents(spark, ["a"]).limit(0)).count() == 0


def test_exact_dedup_reads_each_text_once(spark):
    """Texts are folded and hashed once, not again for the bounds of the sort by range."""
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    texts = ["Éa", "éA", "ÉA", "x" * 700]
    counted = documents(spark, texts).withColumn("text", F.udf(seen)("text"))
    rows = exact_dedup(counted).collect()
    assert read.value == len(texts) and sorted(r.group_size for r in rows) == [1, 1, 2, 2]



# Near-dedup

def shingles(text: str | None) -> frozenset:
    w = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
    n = min(5, len(w))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def near_expected(pairs):
    sets = [(i, shingles(t)) for i, t in pairs]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(sets):
        least.setdefault(find(i), []).append(doc_id)
    out = []
    for i, (doc_id, s) in enumerate(sets):
        ids = [x for x in least[find(i)] if x is not None]
        component = min(ids, default=None)
        out.append((doc_id, len(s), component, doc_id == component))
    return out


def near_corpus(seed: int = 3):
    """Chains of near copies, a large group of them, exact copies, a shared passage, others."""
    rng = random.Random(seed)
    lexicon = stock(rng, 4000)
    texts = []
    for _ in range(25):
        base = words(rng, rng.randint(20, 120), lexicon)
        for _ in range(rng.randint(1, 4)):
            texts.append(" ".join(base))
            base = list(base)
            for _ in range(max(1, len(base) // rng.choice([20, 40, 80]))):
                base[rng.randrange(len(base))] = rng.choice(lexicon)
    base = words(rng, 150, lexicon)
    for _ in range(70):
        own = list(base)
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(len(own))] = rng.choice(lexicon)
        texts.append(" ".join(own))
    texts += [texts[0]] * 12
    passage = words(rng, 60, lexicon)
    for _ in range(30):
        texts.append(" ".join(words(rng, rng.randint(10, 80), lexicon) + passage))
    texts += [" ".join(words(rng, rng.randint(1, 90), lexicon)) for _ in range(80)]
    rng.shuffle(texts)
    return texts


def test_near_duplicates(spark):
    texts = near_corpus()
    rows = near_duplicates(documents(spark, texts)).collect()
    assert sorted(map(tuple, rows)) == sorted(near_expected(list(enumerate(texts))))


def test_prefix_pairs_lose_no_link(spark):
    """Where the pivots tie nothing, the last step finds every similar pair by itself."""
    rng = random.Random(9)
    sets = []
    for _ in range(6):
        base = rng.sample(range(400), rng.randint(8, 60))
        for _ in range(12):
            own = set(base)
            for _ in range(rng.randint(0, len(base) // 4)):
                own.discard(rng.choice(base))
                own.add(rng.randrange(1000))
            sets.append(sorted(own))
    table = spark.createDataFrame(list(enumerate(sets)), "cid long, shingles array<long>")
    members = table.select("cid", F.size("shingles").cast("long").alias("n"),
                           F.col("cid").alias("root"), F.lit(True).alias("outside"))
    found = {tuple(r) for r in minhash._prefix_pairs(table, members).collect()}
    similar = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))
               if 100 * len(set(sets[a]) & set(sets[b])) >= 75 * len(set(sets[a] + sets[b]))}
    assert len(similar) > 30 and similar <= found
    assert len(found) < len(sets) * (len(sets) - 1) // 6
    # Those of one component, and those that are both inside, are left out.
    half = members.withColumns({"root": F.col("cid") % 2, "outside": F.col("cid") % 3 == 0})
    found = {tuple(r) for r in minhash._prefix_pairs(table, half).collect()}
    assert {p for p in similar if p[0] % 2 != p[1] % 2 and 0 in (p[0] % 3, p[1] % 3)} <= found
    assert all(a % 2 != b % 2 and 0 in (a % 3, b % 3) for a, b in found)


def test_near_edges(spark):
    pairs = [p for p in edge_rows() if p[0] is not None]
    rows = near_duplicates(documents(spark, pairs, clashing=True)).collect()
    assert sorted(map(tuple, rows)) == sorted(near_expected(pairs))
    rows = near_duplicates(documents(spark, [(None, "a b"), (None, None), (4, "A b")])).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, [
        (None, 1, 4, False), (None, 0, None, True), (4, 1, 4, True)]))
    assert near_duplicates(documents(spark, ["a"]).limit(0)).count() == 0


def test_drop_near_duplicates(spark):
    texts = near_corpus(5)[:80]
    expected = {i for i, _, _, kept in near_expected(list(enumerate(texts))) if kept}
    df = documents(spark, texts, clashing=True)
    found = drop_near_duplicates(df)
    assert found.columns == df.columns
    assert sorted(r["doc_id"] for r in found.collect()) == sorted(expected)


def test_one_of_repeated_rows_stays(spark):
    text = "one two three four five six seven eight"
    rows = [(1, text), (1, text), (1, text), (2, text), (3, "other words"), (3, "other words"),
            (None, "lost id here"), (None, "lost id here"), (4, None), (4, None), (5, ""), (6, "")]
    found = drop_near_duplicates(documents(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in found), key=repr) == sorted([
        (1, text), (3, "other words"), (None, "lost id here"), (4, None), (5, ""), (6, "")],
        key=repr)


def test_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1001 + i) for i in range(50)]
    noise = [(2000 + rng.randrange(40), 2000 + rng.randrange(40)) for _ in range(30)]
    links = chain + star + noise + [(7, 7)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    root = {}
    for a, b in links:
        for x in (a, b):
            root.setdefault(x, x)
    for _ in range(100):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {tuple(r) for r in rows} == {(x, root[x]) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# Line dedup

def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng: random.Random, text: str, edits: int) -> str:
    chars = list(text)
    for _ in range(edits):
        at, kind = rng.randrange(len(chars)), rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("abcé")
        elif kind == 1:
            chars.insert(at, rng.choice("abcé"))
        elif len(chars) > 1:
            del chars[at]
    return "".join(chars)


@pytest.mark.parametrize("k", [0, 1, 2, 5])
def test_banded_distance(spark, k):
    rng = random.Random(k)
    pairs = []
    for _ in range(150):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(k + 1, 30)))
        a, b = sorted((a, edited(rng, a, rng.randint(0, k + 2))), key=len)
        if len(a) > k and len(b) - len(a) <= k:
            pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.select("a", "b", edit_distance_within(F.col("a"), F.col("b"), k).alias("near"))
    for r in rows.collect():
        assert r["near"] == (distance(r["a"], r["b"]) <= k), r


def line_corpus(seed: int = 1):
    rng = random.Random(seed)
    lexicon = stock(rng, 300)
    lines = [" ".join(words(rng, rng.randint(1, 8), lexicon)) for _ in range(90)]
    near = [edited(rng, rng.choice(lines), rng.randint(0, 3)) for _ in range(160)]
    pool = lines + near + [line.upper() for line in lines[:20]] + ["  " + lines[0], "", "short"]
    return ["\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12))) for _ in range(60)]


def lines_expected(pairs, max_edits, min_chars):
    def plain(line):
        return line.lower().strip(" ")

    order = sorted({(doc_id, no, plain(line)) for doc_id, text in pairs
                    for no, line in enumerate((text or "").split("\n"))
                    if len(plain(line)) >= min_chars})
    first = {}
    for doc_id, no, line in order:
        first.setdefault(line, (doc_id, no))
    links = defaultdict(set)
    for a in first:
        for b in first:
            if a != b and abs(len(a) - len(b)) <= max_edits and distance(a, b) <= max_edits:
                links[a].add(b)
    out = {}
    for doc_id, text in pairs:
        all_lines = (text or "").split("\n")
        copies = near = n_links = 0
        dropped = []
        for no, line in enumerate(map(plain, all_lines)):
            if len(line) < min_chars:
                continue
            n_links += len(links[line])
            copy = first[line] != (doc_id, no)
            close = any(first[o] < first[line] for o in links[line])
            copies += copy
            near += close and not copy
            if copy or close:
                dropped.append(no)
        out[doc_id] = (len(all_lines), copies, near, n_links, dropped)
    return out, links


@pytest.mark.parametrize("max_edits,min_chars", [(1, 6), (2, 9), (3, 12)])
def test_line_report(spark, max_edits, min_chars):
    texts = line_corpus(max_edits)
    expected, links = lines_expected(list(enumerate(texts)), max_edits, min_chars)
    df = documents(spark, texts, clashing=True)
    rows = line_report(df, max_edits=max_edits, min_chars=min_chars).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == expected
    assert sum(map(len, links.values())) > 20
    kept = {r["doc_id"]: r["text"] for r in drop_lines(
        df, max_edits=max_edits, min_chars=min_chars).collect()}
    for i, text in enumerate(texts):
        lines = text.split("\n")
        assert kept[i] == "\n".join(x for no, x in enumerate(lines) if no not in expected[i][4])


def test_line_edges(spark):
    long = "this line is long enough to be compared with others"
    pairs = [(1, None), (2, ""), (3, long), (3, long), (4, long + "\n" + long),
             (5, "\n \n" + long.upper()), (None, long), (6, long[:-1]), (7, "x" * 5000),
             (8, "y" + "x" * 4999)]
    df = documents(spark, pairs, clashing=True)
    rows = sorted(line_report(df).collect(), key=repr)
    found = defaultdict(list)
    for r in rows:
        found[r["doc_id"]].append(r["dropped"])
    assert found == {1: [[]], 2: [[]], 3: [[], []], 4: [[0, 1]], 5: [[2]], None: [[0]],
                     6: [[0]], 7: [[]], 8: [[0]]}
    texts = {r["doc_id"]: r["text"] for r in drop_lines(df).collect()}
    assert texts[1] is None and texts[3] == long and texts[5] == "\n " and texts[4] == ""
    assert drop_lines(df).columns == df.columns
    assert line_report(df.limit(0)).count() == 0 and drop_lines(df.limit(0)).count() == 0


def test_short_copies(spark, tmp_path):
    """Exact copies of short lines go; blank lines and short lines that only nearly equal stay."""
    texts = ["Read more\n\nhome page", " read more \n\n\t\nx", "read mora\n\t\nX"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    rows = op4_line_dedup(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: (r["n_copies"], r["n_near"], r["dropped"]) for r in rows} == {
        0: (0, 0, []), 1: (1, 0, [0]), 2: (1, 0, [2])}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = corpus_pipeline.dedup_lines(spark, docs, str(tmp_path)).collect()
    assert {r["doc_id"]: r["text"] for r in kept} == {
        0: texts[0], 1: "\n\t\nx", 2: "read mora\n\t"}


def test_line_classes_list_no_lone_lines(spark):
    """Lines without a copy or a near line are neither joined nor gathered per document."""
    from rosterline.llm.line_dedup import _keyed, line_classes

    line = "a line of some more than thirty-two characters"
    texts = [line + "\nalone: " + "x" * 30, line, line + "s", "alone, too: " + "y" * 30]
    found = line_classes(_keyed(documents(spark, texts), "doc_id", "text"))
    rows = [(r.line_no, r.first, r.near, r.n_links) for r in found.collect()]
    assert sorted(rows) == [(0, False, False, 1), (0, True, False, 1), (0, True, True, 1)]


def test_line_report_is_native(spark):
    plan = line_report(documents(spark, line_corpus()))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


# Repeat removal

def repeats_expected(pairs, m):
    starts = defaultdict(int)
    raws = [(i, (t or "").encode()) for i, t in pairs]
    for _, raw in raws:
        for p in range(len(raw) - m + 1):
            starts[raw[p:p + m]] += 1
    out = []
    for doc_id, raw in raws:
        gone = bytearray(len(raw))
        for p in range(len(raw) - m + 1):
            if starts[raw[p:p + m]] > 1:
                gone[p:p + m] = b"\1" * m
        spans = [(x.start(), x.end()) for x in re.finditer(b"\1+", bytes(gone))]
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc_id, len(raw), spans, kept))
    return out


def check_repeats(df, pairs, **options):
    rows = cut_repeats(df, **options).collect()
    found = [(r["doc_id"], r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"]))
             for r in rows]
    expected = repeats_expected(pairs, options.get("min_bytes", 400))
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats(spark, seed):
    rng = random.Random(seed)
    lexicon = stock(rng, 60)
    passages = [" ".join(words(rng, rng.randint(8, 40), lexicon)) for _ in range(8)]
    texts = []
    for _ in range(90):
        parts = [" ".join(words(rng, rng.randint(0, 15), lexicon))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            parts += [p[rng.randrange(20):len(p) - rng.randrange(20)], rng.choice(lexicon)]
        texts.append(" ".join(parts))
    texts += [texts[0]] * 5 + ["ab" * 300, "a" * 500, "xyz" * 100]
    check_repeats(documents(spark, texts), list(enumerate(texts)), min_bytes=40,
                  groups=(24, 5, 1), qgram=12)


def test_repeats_edges(spark):
    pairs = edge_rows() + [(900, "q" * 399), (901, "z" * 400), (902, "w" * 401)]
    check_repeats(documents(spark, pairs, clashing=True), pairs)
    assert cut_repeats(documents(spark, ["a"]).limit(0)).count() == 0


def test_repeats_over_chunks(spark, monkeypatch):
    """A very long text is read in parts; nothing depends on where they end."""
    from rosterline.llm import repeats

    rng = random.Random(8)
    text = "".join(rng.choice("abcdefgh") for _ in range(3000))
    monkeypatch.setattr(repeats, "CHUNK", 500)
    texts = [text, text[700:2100], "".join(rng.choice("abcdefgh") for _ in range(900))]
    found = []
    for chunk in (500, 1 << 20):
        repeats.CHUNK = chunk
        for t in texts:
            own = [c for c in repeats._chunks(t, 60, 30, 8)]
            starts = sorted((c.first + a, c.first + lo, c.first + hi)
                            for c in own for a, lo, hi in zip(c.anchor, c.low, c.high))
            covered = sorted((a, p) for a, lo, hi in starts for p in range(lo, hi + 1))
            found.append(covered)
    assert found[:3] == found[3:]


def test_repeats_gather_short_texts(monkeypatch):
    """Short texts share a chunk; groups are those of each text alone and stay within it."""
    import pyarrow as pa

    from rosterline.llm import repeats

    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdé") for _ in range(n))
             for n in (60, 300, 59, 0, 1500, 61, 400, 200, 90)]
    texts[3] = None
    monkeypatch.setattr(repeats, "CHUNK", 1000)
    gathered = list(repeats._gathered(pa.array(texts), 60, 30, 8))
    assert [rows.tolist() for rows, _ in gathered] == [[4], [4], [0, 1, 2, 5], [6, 7, 8]]

    def groups(row, chunk, piece, zero, low):
        own = chunk.anchor, chunk.low, chunk.high
        docs = np.full(len(chunk.begins), 7, dtype=np.int64)
        return zip(row[piece], chunk.bucket(own, 30), chunk.refined(own),
                   chunk.member(own, low, docs), chunk.low - zero, chunk.high - zero)

    together, alone = [], []
    for row, chunk in gathered:
        piece, zero = chunk.places((chunk.anchor, chunk.low, chunk.high))
        together += groups(row, chunk, piece, zero, (chunk.low - zero).astype(np.uint64))
    for i, text in enumerate(texts):
        for chunk in repeats._chunks(text, 60, 30, 8):
            none = np.zeros(len(chunk.low), dtype=int)
            alone += groups(np.array([i]), chunk, none, none - chunk.first,
                            (chunk.low + chunk.first).astype(np.uint64))
    assert sorted(together) == sorted(alone) and len(alone) > 100
