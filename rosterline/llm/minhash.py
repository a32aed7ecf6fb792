"""Near-duplicates by an inverted join over signature coordinates.

Each set of word shingles gets a MinHash signature of COORDINATES values. A class of equal sets
is posted once under each (coordinate, value) pair. Two sets at the similarity asked for agree in
at least MATCHES coordinates, save for a chance of about 2 in a million; so a class whose pairs
occur elsewhere less often than that has no partner, and of the others only the rarest pairs are
joined, as many as needed so that every two classes with MATCHES common pairs meet (prefix). The
long lists are skipped: collisions there are counted by comparing the signatures of the pairs
that met. Pairs above the match threshold are confirmed on the full sets.

Links are needed only as far as they tie components together. Members of a list are first
compared with one pivot, the class with most shared coordinates. Only where a list then holds
several components, what is outside its largest one is compared on: with those members that share
one of the rarest shingles of both sets, if their ranks leave room for enough common ones. So a
group of very many near copies costs a few comparisons per member, and no link between components
is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmap import passes, residue_filter
from .common import doc_hash, settle, tidy, unused
from .components import components
from .wordhash import NOT_BLANK, batches, grams, mix, row_bounds, words_of

U64 = np.uint64
WORDS = 5
SIMILARITY = 75  # per cent
COORDINATES = 64
MATCHES = 32
_FACTORS = mix(np.arange(1, COORDINATES + 1, dtype=U64)) | U64(1)
_SALTS = mix(np.arange(1001, COORDINATES + 1001, dtype=U64))


def shingle_sets(texts: list[str | None], n: int = WORDS) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingle hashes of each text."""
    for rows, raw, starts in batches(texts):
        first, _, hashes = words_of(raw, NOT_BLANK)
        bounds = row_bounds(starts, first)
        for row, a, b in zip(rows, bounds[:-1], bounds[1:]):
            yield row, np.unique(grams(hashes[a:b], min(n, b - a))) if b > a else hashes[:0]


def signature(shingles: np.ndarray) -> np.ndarray:
    """One number per coordinate, different for different coordinates."""
    least = np.full(COORDINATES, np.iinfo(U64).max, dtype=U64)
    for start in range(0, len(shingles), 4096):
        part = shingles[start:start + 4096, None] * _FACTORS + _SALTS
        np.minimum(least, part.min(axis=0), out=least)
    return mix(least ^ _SALTS).view(np.int64)


def _identity(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    place = np.arange(1, len(shingles) + 1, dtype=U64)
    return tuple(int((mix(shingles + salt) * (place | U64(1) << U64(40))).sum(dtype=U64)
                     .view(np.int64)) for salt in (U64(7), U64(13)))


def signatures(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n (set size), s0, s1 (the set's name), sig; sig is null for empty sets."""
    id_type = dict(docs.dtypes)["doc_id"]

    def run(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_iter:
            size = batch.num_rows
            n, sig = [0] * size, [None] * size
            names = np.zeros((size, 2), dtype=np.int64)
            for row, shingles in shingle_sets(batch.column(1).to_pylist()):
                n[row] = len(shingles)
                if len(shingles):
                    names[row] = _identity(shingles)
                    sig[row] = signature(shingles)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(names[:, 0]),
                 pa.array(names[:, 1]), pa.array(sig, pa.list_(pa.int64()))],
                names=["doc_id", "n", "s0", "s1", "sig"])

    return docs.select("doc_id", "text").mapInArrow(
        tidy(run), f"doc_id {id_type}, n long, s0 long, s1 long, sig array<long>")


def prefixes(classes: DataFrame) -> DataFrame:
    """cid, n, shared, key: the rarest coordinate pairs of each class that can have a partner.

    Pairs of a single class come first in the order of rarity and take up places in the prefix.
    The second pass counts among the classes that the first has left.
    """
    keys = classes.select("cid", F.explode("sig").alias("key"))
    for _ in range(2):
        counts = settle(keys.groupBy("key").agg(F.count("*").alias("met")).filter("met > 1"))
        live = (
            keys.join(counts, "key").groupBy("cid")
            .agg(F.sort_array(F.collect_list(F.struct("met", "key"))).alias("keys"))
            .filter(F.size("keys") >= MATCHES))
        live = settle(live)
        keys = live.select("cid", F.explode("keys.key").alias("key"))
    chosen = F.slice("keys", 1, F.size("keys") - MATCHES + 1)
    return settle(
        live.select("cid", F.size("keys").alias("shared"), F.explode(chosen).alias("k"))
        .select("cid", "shared", "k.key").join(classes.select("cid", "n"), "cid"))


def _similar_size(a: str, b: str):
    return ((100 * F.least(a, b)) >= (SIMILARITY * F.greatest(a, b)))


def _enough(common, a: str, b: str):
    """Whether that many common shingles make two sets of the given sizes similar."""
    return common * (100 + SIMILARITY) >= SIMILARITY * (F.col(a) + F.col(b))


def _meeting(postings: DataFrame) -> DataFrame:
    """Pairs of each list's members with its pivot."""
    pivots = settle(postings.groupBy("key").agg(
        F.max(F.struct("shared", "cid")).alias("best"), F.count("*").alias("size"))
        .filter("size > 1").select("key", F.col("best.cid").alias("pivot")))
    return (
        postings.join(pivots, "key").filter("cid <> pivot")
        .select(F.least("cid", "pivot").alias("a"), F.greatest("cid", "pivot").alias("b"))
        .distinct())


def _confirm(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that agree in enough coordinates and then in their full sets."""
    sides = {s: classes.select(F.col("cid").alias(s), F.col("n").alias(f"n_{s}"),
                               F.col("sig").alias(f"sig_{s}")) for s in "ab"}
    same = F.aggregate(F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")),
                       F.lit(0), lambda total, x: total + x)
    met = settle(
        pairs.join(sides["a"], "a").join(sides["b"], "b")
        .filter(_similar_size("n_a", "n_b") & (same >= MATCHES))
        .select("a", "b", "n_a", "n_b"))
    wanted = met.select(F.col("a").alias("cid")).unionByName(
        met.select(F.col("b").alias("cid"))).distinct()
    sets = _class_sets(docs, classes, wanted)
    both = (
        met.join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("set_a")), "a")
        .join(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("set_b")), "b")
        .select("a", "b", "set_a", "set_b"))

    def run(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_iter:
            keep = []
            for i in range(batch.num_rows):
                a, b = (batch.column(c)[i].values.to_numpy() for c in (2, 3))
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= SIMILARITY * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return settle(both.mapInArrow(tidy(run), "a long, b long"))


def _class_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """cid and shingles, the full sets of the wanted classes."""
    names = settle(classes.select("cid", "s0", "s1").join(wanted, "cid"))
    return settle(_sets(docs, residue_filter(names, "s0"))
                  .join(names, ["s0", "s1"]).select("cid", "shingles").dropDuplicates(["cid"]))


def _sets(docs: DataFrame, bitmap: bytes) -> DataFrame:
    """Full sets of the classes that pass the bitmap, once per task."""

    def run(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(bitmap, dtype=np.uint8)
        given = set()
        for batch in batch_iter:
            found, held = [], 0
            for _, shingles in shingle_sets(batch.column(0).to_pylist()):
                if not len(shingles):
                    continue
                name = _identity(shingles)
                if passes(flags, np.array(name[:1]))[0] and name not in given:
                    given.add(name)
                    found.append((*name, shingles.view(np.int64)))
                    held += 8 * len(shingles)
                if held > 1 << 24:
                    yield rows(found)
                    found, held = [], 0
            yield rows(found)

    def rows(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.int64()),
             pa.array([f[1] for f in found], pa.int64()),
             pa.array([f[2] for f in found], pa.list_(pa.int64()))], names=["s0", "s1", "shingles"])

    return docs.select("text").mapInArrow(tidy(run), "s0 long, s1 long, shingles array<long>")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    Words are runs of non-blanks, A-Z lower-cased; a set holds the distinct runs of WORDS words,
    or the whole text if it has fewer. Documents are linked if their sets' Jaccard similarity is
    at least SIMILARITY per cent. component_id is the smallest id that a document is linked with,
    also through others, itself included; kept marks the document that has this id. Null and
    empty texts have an empty set and no link: each is its own component. A repeated id stands
    for each of its rows. A null id is never the smallest. Other columns are not read; an empty
    table gives no rows.
    """
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    members = settle(signatures(given))
    reps = members.filter("n > 0").groupBy("s0", "s1").agg(F.min("doc_id").alias("rep"))
    # One row of each class carries the signature.
    heads = (
        members.filter("n > 0").join(settle(reps), ["s0", "s1"])
        .filter(F.col("doc_id").eqNullSafe(F.col("rep")))
        .select("s0", "s1", "n", "rep", "sig").dropDuplicates(["s0", "s1"]))
    classes = settle(heads.withColumn("cid", F.monotonically_increasing_id()))
    postings = prefixes(classes)
    links = _confirm(given, classes, _meeting(postings))
    roots = settle(components(links))
    rest = _confirm(given, classes, _remaining(given, classes, postings, roots))
    if not rest.isEmpty():
        roots = settle(components(links.unionByName(rest)))
    tied = (
        classes.join(roots.withColumnRenamed("node", "cid"), "cid")
        .groupBy("root").agg(F.min("rep").alias("component_id")))
    known = (
        classes.join(roots.withColumnRenamed("node", "cid"), "cid", "left")
        .join(settle(tied), "root", "left")
        .select("s0", "s1", F.coalesce("component_id", "rep").alias("component_id")))
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (
        members.select("doc_id", F.col("n").alias("n_shingles"), "s0", "s1")
        .join(settle(known), ["s0", "s1"], "left")
        .select("doc_id", "n_shingles", own.alias("component_id"),
                F.col("doc_id").eqNullSafe(own).alias("kept")))


def _mixed(postings: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of lists that hold several components: cid, n, root, and whether the class is
    outside the largest component of one of its lists."""
    tied = settle(
        postings.join(roots.withColumnRenamed("node", "cid"), "cid", "left")
        .select("key", "cid", "n", F.coalesce("root", "cid").alias("root")))
    main = settle(
        tied.groupBy("key", "root").agg(F.count("*").alias("size"))
        .groupBy("key").agg(F.max(F.struct("size", "root")).alias("main"),
                            F.count("*").alias("parts"))
        .filter("parts > 1").select("key", F.col("main.root").alias("main")))
    return settle(
        tied.join(main, "key").groupBy("cid", "n", "root")
        .agg(F.bool_or(F.col("root") != F.col("main")).alias("outside")))


def _remaining(docs: DataFrame, classes: DataFrame, postings: DataFrame,
               roots: DataFrame) -> DataFrame:
    """Pairs in different components, of lists that hold several, which may still be similar.

    Similar sets share one of their rarest quarter of shingles, in one order for all, and behind
    the first common one both have room for the others.
    """
    members = _mixed(postings, roots)
    return _prefix_pairs(_class_sets(docs, classes, members.select("cid")), members)


def _prefix_pairs(sets: DataFrame, members: DataFrame) -> DataFrame:
    """a, b: members outside, with members of other components that they may be similar to."""
    each = sets.select("cid", F.explode("shingles").alias("shingle"))
    counts = settle(each.groupBy("shingle").agg(F.count("*").alias("met")).filter("met > 1"))
    ranked = (
        each.join(counts, "shingle").groupBy("cid")
        .agg(F.sort_array(F.collect_list(F.struct("met", "shingle"))).alias("common"))
        .join(members, "cid"))
    # Shingles of a single set come first in the order of rarity.
    alone = F.col("n") - F.size("common")
    length = F.col("n") - F.expr(f"({SIMILARITY} * n + 99) div 100") + 1 - alone
    prefix = settle(
        ranked.filter(length > 0).select(
            "cid", "n", "root", "outside", alone.alias("alone"),
            F.posexplode(F.slice("common", F.lit(1), length.cast("int"))).alias("i", "c"))
        .select("cid", "n", "root", "outside", (F.col("alone") + F.col("i")).alias("rank"),
                "c.shingle"))
    outside = prefix.filter("outside").select(
        "shingle", *[F.col(c).alias(f"{c}_x") for c in ("cid", "n", "root", "rank")])
    room = F.least(F.col("n") - F.col("rank"), F.col("n_x") - F.col("rank_x"))
    return (
        prefix.join(outside, "shingle")
        .filter((F.col("root") != F.col("root_x")) & _similar_size("n", "n_x")
                & _enough(room, "n", "n_x")
                & (~F.col("outside") | (F.col("cid") < F.col("cid_x"))))
        .select(F.least("cid", "cid_x").alias("a"), F.greatest("cid", "cid_x").alias("b"))
        .distinct())


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """The table with one document of each component, the one with the smallest id.

    Columns stay. Rows that share an id are told apart by their text, the smaller hash first; of
    rows equal in id and text, which are one document given several times, one stays. Null and
    empty texts are no copies of each other. An empty table stays empty.
    """
    k0, k1 = unused(docs, "k0_", "k1_")
    keyed = docs.withColumns(dict(zip((k0, k1), doc_hash(F.col(id_col), F.col(text_col)))))
    one = keyed.select(F.struct(F.col(id_col).alias("id"), F.col(k0).alias("k0"),
                                F.col(k1).alias("k1")).alias("doc_id"),
                       F.col(text_col).alias("text"))
    kept = (near_duplicates(one).filter("kept")
            .select(F.col("doc_id.k0").alias(k0), F.col("doc_id.k1").alias(k1)).distinct())
    return (keyed.join(settle(kept), [k0, k1], "left_semi").dropDuplicates([k0, k1])
            .select(*docs.columns))
