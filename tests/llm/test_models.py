"""Language ID, toxicity and language-model scoring: held-out accuracy and brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus import documents, edge_rows, stock, words
from pyspark.sql import functions as F

from rosterline.llm import langid, ppm, toxicity
from rosterline.llm.common import id_remainder

LETTERS = {"en": "etaoinshrd", "de": "enirsätüöß", "fr": "esaitnéèêç"}


def speech(seed: int = 1, n: int = 400):
    """(doc_id, text, lang) in three invented languages with some words in common."""
    rng = random.Random(seed)
    lexicon = {k: stock(rng, 150, v) + ["la", "de"] for k, v in LETTERS.items()}
    rows = []
    for i in range(n):
        lang = rng.choice(list(lexicon))
        rows.append((i, " ".join(words(rng, rng.randint(2, 40), lexicon[lang])).title(), lang))
    return rows


@pytest.fixture(scope="module")
def spoken(spark):
    return spark.createDataFrame(speech(), "doc_id long, text string, lang string").repartition(3)


def test_language_held_out(spark, spoken):
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    model = langid.learn(spoken, where=~held_out, rows_per_language=80)
    rows = langid.identify(spoken, model).filter(held_out).collect()
    right = sum(r["lang"] == r["lang_pred"] for r in rows)
    assert len(rows) > 60 and right >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_learns_from_the_named_rows_only(spark, spoken):
    marked = spoken.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    one = langid.learn(marked, rows_per_language=500)
    wrong = spoken.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang"))
                              .otherwise("xx"))
    other = langid.learn(wrong, where=F.col("doc_id") % 2 == 0, rows_per_language=500)
    assert one.languages == other.languages == sorted(LETTERS)
    assert one.words == other.words and np.array_equal(one.word_scores, other.word_scores)


def test_language_backs_off():
    model = langid.LanguageModel(
        ["a", "b"], ["haus"], np.log(np.array([[0.9, 0.1]], np.float32)),
        ["au", "x"], np.log(np.array([[0.2, 0.8], [0.7, 0.3]], np.float32)))
    scorer = langid.Scorer(model)
    assert scorer.predict("Haus") == ("a", pytest.approx(0.9))
    assert scorer.predict("maus")[0] == "b"  # 'au' is longer than any other known n-gram
    assert scorer.predict("x")[0] == "a"
    assert scorer.predict("qq") == ("a", pytest.approx(0.5))  # nothing known: a tie
    assert scorer.predict("12 ½ !") == scorer.predict(None) == ("und", 0.0)


def test_language_forgets_unseen_words(monkeypatch):
    monkeypatch.setattr(langid, "REMEMBERED", 6)
    model = langid.LanguageModel(
        ["a", "b"], ["w"], np.zeros((1, 2), np.float32),
        [chr(97 + i) for i in range(20)],
        np.log(np.array([[0.6, 0.4]] * 20, np.float32)))
    text = " ".join(chr(97 + i % 20) * (1 + i % 3) for i in range(50))
    lang, score = langid.Scorer(model).predict(text)
    n = sum(w != "w" for w in text.split())
    assert lang == "a" and score == pytest.approx(1 / (1 + (0.4 / 0.6) ** n))


@pytest.mark.parametrize("doc_id", [None, 7, 8, 9])
def test_language_sample_of_equal_ids(spark, spoken, doc_id):
    """The sample goes by id and text: equal ids leave it neither empty nor unbounded."""
    same = spoken.withColumn("doc_id", F.lit(doc_id).cast("long"))
    model = langid.learn(same, rows_per_language=60)
    assert model.languages == sorted(LETTERS)
    rows = langid.identify(spoken, model).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    few, whole = (langid.learn(same, rows_per_language=n) for n in (2, 10**6))
    assert 0 < len(few.words) < len(whole.words)


def test_language_sample_of_repeated_rows(spark):
    """One row given very many times: it is drawn, and no more often than the bound."""
    rows = [(1, "ein haus", "de")] * 300 + [(2, "one house", "en")] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(df, rows_per_language=10)
    assert set(model.words) == {"ein", "haus", "one", "house"}
    scorer = langid.Scorer(model)
    assert scorer.predict("haus")[0] == "de" and scorer.predict("house")[0] == "en"


def test_language_against_plain_scoring(spark, spoken):
    """Every text scored with dictionaries of counts, whatever the tables inside."""
    model = langid.learn(spoken, rows_per_language=10**6)
    word_counts = {lang: Counter() for lang in LETTERS}
    for r in spoken.collect():
        word_counts[r["lang"]].update(re.findall(r"[^\W\d_]+", r["text"].lower()))
    gram_counts = {lang: Counter() for lang in LETTERS}
    for lang, counts in word_counts.items():
        for word, n in counts.items():
            marked = f"_{word}_"
            for size in range(1, 6):
                for i in range(len(marked) - size + 1):
                    gram_counts[lang][marked[i:i + size]] += n

    def logs(counts):
        known = set().union(*counts.values())
        totals = {lang: sum(c.values()) + 0.5 * (len(known) - len(c)) + 0.5 * len(c)
                  for lang, c in counts.items()}
        return {k: [math.log((counts[lang][k] + 0.5) / totals[lang]) for lang in sorted(counts)]
                for k in known}

    by_word, by_gram = logs(word_counts), logs(gram_counts)

    def plain(word):
        if word in by_word:
            return by_word[word]
        marked = f"_{word}_"
        for size in range(min(5, len(marked)), 0, -1):
            met = [by_gram[g] for i in range(len(marked) - size + 1)
                   if (g := marked[i:i + size]) in by_gram]
            if met:
                return [sum(x) / len(met) for x in zip(*met)]
        return [0.0] * len(LETTERS)

    scorer = langid.Scorer(model)
    for _, text, _ in speech(seed=77, n=60):
        totals = [sum(x) for x in zip(*map(plain, re.findall(r"[^\W\d_]+", text.lower())))]
        best = max(range(len(totals)), key=lambda i: (totals[i], -i))
        share = 1 / sum(math.exp(t - totals[best]) for t in totals)
        lang, score = scorer.predict(text)
        assert lang == sorted(LETTERS)[best] and score == pytest.approx(share, rel=1e-3)


def test_language_edges(spark, spoken):
    model = langid.learn(spoken, rows_per_language=50)
    df = documents(spark, edge_rows())
    rows = langid.identify(df, model).collect()
    assert len(rows) == len(edge_rows())
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
    clashing = documents(spark, edge_rows(), clashing=True)
    kept = langid.keep_identified(clashing, model)
    assert kept.columns == clashing.columns
    assert kept.count() == sum(r["lang_pred"] != "und" for r in rows)
    with pytest.raises(ValueError):
        langid.identify(clashing, model)
    empty = langid.learn(spoken.limit(0))
    assert {r["lang_pred"] for r in langid.identify(df, empty).collect()} == {"und"}
    assert langid.identify(df.limit(0), model).count() == 0
    assert langid.keep_identified(clashing, empty).count() == kept.count()


def insults(seed: int = 1, n: int = 1500):
    """(doc_id, text, toxic): toxic texts hold some of twelve words, at times only one."""
    rng = random.Random(seed)
    lexicon, bad = stock(rng, 900), [f"zz{w}" for w in stock(rng, 12)]
    rows = []
    for i in range(n):
        own, toxic = words(rng, rng.randint(5, 60), lexicon), rng.random() < 0.15
        if toxic:
            for _ in range(rng.randint(1, 5)):
                own.insert(rng.randrange(len(own)), rng.choice(bad))
        rows.append((i, " ".join(own), int(toxic)))
    return rows


def auc(scores, labels) -> float:
    ranks = np.argsort(np.argsort(scores, kind="stable"), kind="stable")
    ones = np.asarray(labels) == 1
    n1, n0 = ones.sum(), (~ones).sum()
    return (ranks[ones].sum() - n1 * (n1 - 1) / 2) / (n1 * n0)


def test_toxicity_held_out(spark):
    rows = insults()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels, where=id_remainder(F.col("id"), 5) != 0)
    found = toxicity.score(docs, model).join(labels, "doc_id").filter(
        id_remainder(F.col("doc_id"), 5) == 0).collect()
    assert len(found) > 200
    assert auc([r["score"] for r in found], [r["toxic"] for r in found]) > 0.98
    hits = [r["toxic"] for r in found if r["predicted"] == 1]
    assert sum(hits) >= 0.9 * len(hits) and sum(hits) >= 0.9 * sum(r["toxic"] for r in found)
    assert all((r["score"] >= 0.5) == (r["predicted"] == 1) for r in found)
    # Held-out labels teach nothing.
    wrong = labels.withColumn("toxic", F.when(id_remainder(F.col("doc_id"), 5) == 0,
                                              1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.learn(docs, wrong, where=id_remainder(F.col("id"), 5) != 0)
    assert np.array_equal(model.keys, again.keys)
    assert np.allclose(model.weights, again.weights)


def test_label_model_weighs_voters():
    """A copy of a voter adds little; accuracies and correlations come out."""
    rng = np.random.default_rng(1)
    label = (rng.random(3000) < 0.3).astype(int)

    def voter(right):
        vote = np.where(rng.random(3000) < right, label, 1 - label) * 2 - 1
        return np.where(rng.random(3000) < 0.7, vote, 0)

    good, poor = voter(0.95), voter(0.7)
    votes = np.stack([good, poor, poor, poor], axis=1).astype(np.int8)
    posterior, accuracy, correlation = toxicity.label_model(votes, label, np.ones(3000))
    assert accuracy[0] > 0.87 and 0.6 < accuracy[1] < 0.8  # soft posteriors blur both
    assert correlation[1, 2] > 0.95 and abs(correlation[0, 1]) < 0.2
    assert ((posterior > 0.5) == label).mean() > 0.95


def test_voters_outvote_a_wrong_label():
    """The given label is a voter: five others that agree against it win."""
    rng = np.random.default_rng(3)
    truth = (rng.random(2000) < 0.4).astype(int)
    votes = np.stack([np.where(rng.random(2000) < 0.9, truth, 1 - truth) * 2 - 1
                      for _ in range(5)], axis=1).astype(np.int8)
    label = np.where(rng.random(2000) < 0.1, 1 - truth, truth)
    posterior, accuracy, _ = toxicity.label_model(votes, label, np.ones(2000))
    wrong = label != truth
    assert ((posterior > 0.5) == truth)[wrong].mean() > 0.8
    assert ((posterior > 0.5) == truth).mean() > 0.97
    assert all(0.85 < a < 0.95 for a in accuracy)


def test_label_model_against_plain_loops():
    rng = np.random.default_rng(5)
    n, voters, rounds = 60, 4, 6
    label = (rng.random(n) < 0.4).astype(int)
    votes = rng.integers(-1, 2, (n, voters)).astype(np.int8)
    votes[:, 1] = votes[:, 0]  # a copy
    weight = rng.random(n) + 0.5
    post = [0.95 if y else 0.05 for y in label]
    for _ in range(rounds):
        chance = {}
        for c in (0, 1):
            for j in range(voters):
                counts = {v: 0.5 for v in (-1, 0, 1)}
                for i in range(n):
                    counts[votes[i, j]] += weight[i] * (post[i] if c else 1 - post[i])
                chance[c, j] = {v: x / sum(counts.values()) for v, x in counts.items()}
        rest = [[votes[i, j] - sum((post[i] if c else 1 - post[i])
                                   * (chance[c, j][1] - chance[c, j][-1]) for c in (0, 1))
                 for j in range(voters)] for i in range(n)]
        total = sum(weight)
        scale = [math.sqrt(sum(weight[i] * rest[i][j] ** 2 for i in range(n)) / total) + 1e-9
                 for j in range(voters)]
        share = []
        for j in range(voters):
            others = [abs(sum(weight[i] * rest[i][j] * rest[i][k] for i in range(n)) / total
                          / scale[j] / scale[k]) for k in range(voters) if k != j]
            share.append(1 / (1 + sum(x for x in others if x > 0.1)))
        prior = sum(w * p for w, p in zip(weight, post)) / total
        fresh = []
        for i in range(n):
            z = math.log(prior / (1 - prior)) + math.log(19) * (1 if label[i] else -1)
            z += sum(share[j] * math.log(chance[1, j][votes[i, j]] / chance[0, j][votes[i, j]])
                     for j in range(voters))
            fresh.append(min(max(1 / (1 + math.exp(-z)), 1e-3), 1 - 1e-3))
        post = fresh
    found, _, correlation = toxicity.label_model(votes, label, weight, rounds)
    assert np.allclose(found, post) and correlation[0, 1] > 0.99


def test_toxicity_edges(spark):
    rows = insults(2, 400)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, y) for i, _, y in rows] + [(0, 1), (None, 1), (5, None), (9999, 1)],
        "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    df = documents(spark, edge_rows(), clashing=True)
    found = toxicity.score(df, model).collect()
    assert len(found) == len(edge_rows())
    assert all(0 <= r["score"] < 0.5 and r["predicted"] == 0 for r in found)
    assert toxicity.score(df.limit(0), model).count() == 0
    for none in (labels.limit(0), labels.filter("toxic = 0"), labels.filter("doc_id > 9000")):
        assert toxicity.score(docs, toxicity.learn(docs, none)).filter("predicted = 1").count() == 0


# PPM against a plain dictionary model

def ppm_expected(rows, held):
    def tokens(text):
        return re.findall(r"[^\x20\x09-\x0D]+",
                          re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))

    def coded(word):
        raw = b" " + word.encode() + b" "
        return [(raw[max(0, i - ppm.ORDER):i], raw[i]) for i in range(1, len(raw))]

    def all_pairs(text):
        for word in tokens(text):
            yield from coded(word)
        yield b" ", 10

    trie = defaultdict(Counter)
    unigrams = Counter()
    for doc_id, text in rows:
        if doc_id not in held:
            unigrams.update([*tokens(text), None])
            for context, symbol in all_pairs(text):
                for k in range(len(context) + 1):
                    trie[context[k:]][symbol] += 1

    def cost(context, symbol):
        total, out = 0.0, set()
        for k in range(len(context) + 1):
            seen = {s: n for s, n in trie.get(context[k:], {}).items() if s not in out}
            if not seen:
                continue
            n = sum(seen.values())
            if symbol in seen:
                return total + math.log10((seen[symbol] - 0.5) / n)
            total += math.log10(0.5 * len(seen) / n)
            out |= set(seen)
        return total - math.log10(256 - len(out))

    n, v = sum(unigrams.values()), len(unigrams)
    found = []
    for doc_id, text in rows:
        own = [*tokens(text), None]
        found.append((doc_id, doc_id in held, len(own), sum(unigrams[t] > 0 for t in own), n,
                      sum(math.log10((unigrams[t] + 1) / (n + v + 1)) for t in own),
                      sum(cost(c, s) for c, s in all_pairs(text))))
    return found


def check_ppm(spark, rows, held, **options):
    df = documents(spark, rows, clashing=True)
    found = ppm.ppm_scores(df, F.col("doc_id").isin(list(held)), **options).collect()
    expected = ppm_expected(rows, held)
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    assert len(found) == len(expected)
    for a, b in zip(sorted(map(tuple, found), key=key), sorted(expected, key=key)):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], abs=1e-6) and a[6] == pytest.approx(b[6], abs=1e-6)


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_ppm(spark, block_bytes):
    rng = random.Random(3)
    lexicon = stock(rng, 60, "abcé") + ["Total", "x1"]
    rows = [(i, " ".join(words(rng, rng.randint(0, 25), lexicon))) for i in range(60)]
    rows += [(100, "quite novel words ÄÖ \x01\x7f"), (101, "aaaaaaa bbbbbbbbbb"), *rows[:2]]
    check_ppm(spark, rows, {100, 101, 3, 4, 5}, block_bytes=block_bytes)


def test_ppm_edges(spark):
    rows = [r for r in edge_rows() if r[0] is not None]
    check_ppm(spark, rows, {1, 3, 6, 11})
    check_ppm(spark, [(1, "a b"), (2, None)], {1, 2})
    assert ppm.ppm_scores(documents(spark, ["a"]).limit(0), F.lit(False)).count() == 0


def test_ppm_is_a_distribution(spark):
    """Probabilities of all symbols after a context add up to one."""
    text = "abab abba baba acab"
    rows = [(0, text)]
    df = documents(spark, rows)
    grams = ppm.blocks(df.select("doc_id", "text", F.lit(False).alias("held_out"))) \
        .filter(F.col("kind") == ppm.GRAM).groupBy("gram").agg(F.sum("n").alias("n"))
    context = (2 << 8 * (ppm.ORDER + 1)) | (ord("a") << 16) | (ord("b") << 8)
    asked = spark.createDataFrame([(context | s,) for s in range(256)], "gram long")
    every = grams.join(asked, "gram", "full").select("gram", F.coalesce("n", F.lit(0)).alias("n"))
    total = ppm.code_lengths(every).join(asked, "gram").agg(F.sum(F.pow(F.lit(10), "logp")))
    assert total.first()[0] == pytest.approx(1, abs=1e-9)


def test_ppm_reads_across_words(spark):
    """Words in the trained order score higher than the same words shuffled."""
    order = "one two three four five six seven eight nine ten".split()
    shuffled = random.Random(5).sample(order, len(order))
    rows = [(i, " ".join(order)) for i in range(20)]
    rows += [(100, " ".join(order)), (101, " ".join(shuffled))]
    found = {r["doc_id"]: r for r in ppm.ppm_scores(
        documents(spark, rows), F.col("doc_id") >= 100, across=True).collect()}
    assert found[101]["base_score"] == pytest.approx(found[100]["base_score"])
    assert found[101]["score"] < found[100]["score"] - 1


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_ppm_across_words(spark, block_bytes):
    rng = random.Random(8)
    lexicon = stock(rng, 40, "abcé") + ["Total", "x1"]
    rows = [(i, " ".join(words(rng, rng.randint(0, 25), lexicon))) for i in range(60)]
    rows += [(100, "quite novel words ÄÖ"), (101, "a\n b\tc"), (102, None), *rows[:2]]
    held = {100, 101, 3, 4}
    streams = {(i, t): b" " + b"".join(w + b" " for w in (t or "").encode().lower().split())
               + b"\n" for i, t in rows}
    trie = defaultdict(Counter)
    for row in rows:
        raw = streams[row]
        for i in range(1, len(raw) if row[0] not in held else 0):
            for k in range(min(i, ppm.ORDER) + 1):
                trie[raw[i - k:i]][raw[i]] += 1

    def cost(raw, i):
        total, out = 0.0, set()
        for k in range(min(i, ppm.ORDER), -1, -1):
            seen = {s: n for s, n in trie.get(raw[i - k:i], {}).items() if s not in out}
            if raw[i] in seen:
                return total + math.log10((seen[raw[i]] - 0.5) / sum(seen.values()))
            if seen:
                total += math.log10(0.5 * len(seen) / sum(seen.values()))
                out |= set(seen)
        return total - math.log10(256 - len(out))

    found = ppm.ppm_scores(documents(spark, rows), F.col("doc_id").isin(list(held)),
                           block_bytes=block_bytes, across=True).collect()
    expected = sorted((r[0], sum(cost(streams[r], i) for i in range(1, len(streams[r]))))
                      for r in rows)
    for (doc_id, score), row in zip(expected, sorted(found, key=lambda r: (r[0], r["score"]))):
        assert row["doc_id"] == doc_id and row["score"] == pytest.approx(score, abs=1e-6)
    assert len(found) == len(rows)
