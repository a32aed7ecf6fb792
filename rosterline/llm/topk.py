"""Exact search for the vectors of greatest inner product, over a vector-approximation file.

Every component is replaced by the number of its cell; the cells' edges are quantiles of all
components, so that narrow cells lie where components are dense. The numbers, a byte each, are
what a search scans: they bound each product from below and from above. A first pass over the
cells gives each query a floor that the products of its result cannot be under; a second one reads
exact vectors in the order of their bounds, greatest first, until no further bound reaches the
last place.

Queries and vectors meet in blocks of bounded size. Equal vectors are one: of a vector that any
number of rows have, only the least ids can be in a result, and only those are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle, tidy

CELLS = 64
STRIPE_COMPONENTS = 1 << 20  # of the vectors that one task holds at a time
BLOCK_COMPONENTS = 1 << 17   # of the queries that it meets
TOGETHER = 64                # queries whose bounds are held at the same time
READ = 32                    # exact vectors read between two looks at the bounds
EXACT = 1 << 53              # integers up to which double precision counts exactly


def scaled(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null if the vector or a component is null or not
    finite. A component beyond the range of an int is an error."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (
        F.abs(x) != F.lit(float("inf"))))
    return F.when(finite, F.transform(
        embedding, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("int")))


class Cells:
    """The edges of cells of integers, and what a cell says of what is in it."""

    def __init__(self, least: int, most: int, inner: list[int]):
        self.edges = np.unique([x for x in inner if least < x <= most]).astype(np.int64)
        low = np.concatenate([[least], self.edges])
        high = np.concatenate([self.edges - 1, [most]])
        self.twice_middle, self.width = low + high, high - low
        self.greatest = max(abs(least), abs(most), 1)

    def of(self, values: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, values, side="right").astype(np.uint8)

    def bounds(self, cells: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Twice the least and the greatest product of each query with what is in each row of
        cells. Sums of integers, in doubles only as long as these are exact."""
        size = 4 * self.greatest * int(np.abs(queries).max(initial=1)) * max(cells.shape[1], 1)
        if size >= 1 << 63:
            raise OverflowError("products of these vectors exceed 64 bits")
        kind = np.float64 if size < EXACT else np.int64
        queries = queries.astype(kind)
        middle = queries @ self.twice_middle.astype(kind)[cells].T
        spread = np.abs(queries) @ self.width.astype(kind)[cells].T
        return middle - spread, middle + spread


def find_cells(classes: DataFrame, cells: int = CELLS) -> Cells | None:
    """Cells of about equally many components; None without any. Bounds hold for any edges."""
    values = classes.select(F.explode("vec").alias("x"))
    shares = [i / cells for i in range(1, cells)]
    least, most, inner = values.agg(
        F.min("x"), F.max("x"), F.percentile_approx("x", shares, 1000)).first()
    return None if least is None else Cells(least, most, inner)


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    """A column of lists of equal length."""
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else []
    return np.asarray(flat, dtype=np.int64).reshape(size, -1)


def _cell_matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(size, -1)


def distinct_vectors(vectors: DataFrame, places: int) -> DataFrame:
    """vec, its least ``places`` ids (null last), class (its number), dim. Stored."""
    by_id = Window.partitionBy("vec").orderBy(F.col("vec_id").asc_nulls_last())
    few = vectors.withColumn("_place", F.row_number().over(by_id)).filter(
        F.col("_place") <= places)
    ids = F.transform(F.sort_array(F.collect_list(F.struct("_place", "vec_id"))),
                      lambda x: x.vec_id)
    return settle(few.groupBy("vec").agg(ids.alias("ids")).select(
        "vec", "ids", F.size("vec").alias("dim"), F.monotonically_increasing_id().alias("class")))


def approximation(classes: DataFrame, cells: Cells, stripes: int) -> DataFrame:
    """The vector-approximation file: cells beside the exact vectors, dealt into stripes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = batch.column("vec")
            found = cells.of(np.asarray(vec.flatten(), dtype=np.int64)).tobytes()
            cuts = np.concatenate([[0], np.cumsum(batch.column("dim").to_numpy())]).tolist()
            yield batch.append_column("cells", pa.array(
                [found[i:j] for i, j in zip(cuts, cuts[1:])], pa.binary()))

    kinds = ", ".join(f"{c} {kind}" for c, kind in classes.dtypes)
    stripe = F.pmod(F.xxhash64("class"), F.lit(stripes)).cast("int")
    return settle(classes.mapInArrow(tidy(run), f"{kinds}, cells binary").withColumn(
        "stripe", stripe))


GRID = ("dim", "stripe", "block")


def _meet(left: DataFrame, right: DataFrame, stripes: int, blocks: int, run,
          schema: str) -> DataFrame:
    """Every stripe of vectors with every block of queries of their length."""
    left = left.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = right.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    return left.groupBy(*GRID).cogroup(right.groupBy(*GRID)).applyInArrow(run, schema)


def _floors(cells: Cells, places: int, left: pa.Table, right: pa.Table) -> pa.Table:
    """Per query the greatest lower bounds (twice) in a stripe."""
    names, found = [], []
    if left.num_rows and right.num_rows:
        rows = _cell_matrix(left["cells"], left.num_rows)
        queries = _matrix(right["vec"], right.num_rows)
        asked = right["query"].to_numpy()
        few = min(places, len(rows))
        for i in range(0, len(queries), TOGETHER):
            low, _ = cells.bounds(rows, queries[i:i + TOGETHER])
            top = np.partition(low, len(rows) - few, axis=1)[:, len(rows) - few:]
            names.append(np.repeat(asked[i:i + TOGETHER], few))
            found.append(top.astype(np.int64).ravel())
    empty = [np.zeros(0, dtype=np.int64)]
    return pa.table({"query": np.concatenate(names or empty),
                     "bound": np.concatenate(found or empty)})


def _read(rows: np.ndarray, query: np.ndarray, high: np.ndarray, floor: int | None,
          places: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidates whose bound reaches the floor, read in the order of their bounds until the
    last place is certain: their places and products."""
    near = np.arange(len(high)) if floor is None else np.flatnonzero(high >= floor)
    near = near[np.argsort(-high[near], kind="stable")]
    scores = np.zeros(0, dtype=np.int64)
    for i in range(0, len(near), READ):
        if len(scores) >= places:
            last = np.partition(scores, len(scores) - places)[len(scores) - places]
            if high[near[i]] < 2 * last:  # an equal one may win by its id
                break
        scores = np.concatenate([scores, rows[near[i:i + READ]] @ query])
    return near[:len(scores)], scores


NONE_LAST = (1 << 63) - 1


def _exact(cells: Cells, places: int, left: pa.Table, right: pa.Table) -> pa.Table:
    """Per query the best rows of a stripe: score, vec_id, and the vector's class."""
    out: list[tuple] = []
    if left.num_rows and right.num_rows:
        approximate = _cell_matrix(left["cells"], left.num_rows)
        rows = _matrix(left["vec"], left.num_rows)
        queries = _matrix(right["vec"], right.num_rows)
        asked, floors = right["query"].to_pylist(), right["floor"].to_pylist()
        ids, classes = left["ids"], left["class"].to_pylist()
        for i in range(0, len(queries), TOGETHER):
            _, high = cells.bounds(approximate, queries[i:i + TOGETHER])
            for j, bound in enumerate(high, start=i):
                near, scores = _read(rows, queries[j], bound, floors[j], places)
                best = np.argsort(-scores, kind="stable")
                if len(best) > places:  # and all that tie with the last of them
                    best = best[scores[best] >= scores[best[places - 1]]]
                found = [(-int(scores[b]), NONE_LAST if v is None else v, v, classes[near[b]])
                         for b in best for v in ids[int(near[b])].as_py()]
                found.sort(key=lambda x: x[:2])
                out += [(asked[j], -score, v, own) for score, _, v, own in found[:places]]
    return pa.table({
        name: pa.array([row[i] for row in out], pa.int64())
        for i, name in enumerate(("query", "score", "vec_id", "class"))})


def top_products(vectors: DataFrame, is_query: Column, k: int = 5,
                 stripe_components: int = STRIPE_COMPONENTS,
                 block_components: int = BLOCK_COMPONENTS, cells: int = CELLS) -> DataFrame:
    """For each query row the ``k`` other rows of greatest inner product.

    ``vectors`` has vec_id (long) and vec (array<int>); rows for which ``is_query`` is true are
    the queries, all rows of the same length are candidates, but for the query's own. Returns
    query_id, rank from 1, vec_id and score; ties go to the smaller id, a null id comes last.
    There are fewer rows where there are fewer candidates.

    Rows with a null vector take no part. A repeated id stands for several rows: each is a query
    of its own and a candidate of the others, also where the vectors are equal too. A null
    ``is_query`` is false. An empty table gives no rows. Other columns are not read. Products
    beyond 64 bits are an error.
    """
    places = k + 1  # the query's own row may be among them
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "vec",
                           F.coalesce(is_query, F.lit(False)).alias("is_query")).filter(
        F.col("vec").isNotNull())
    classes = distinct_vectors(given, places)
    asks = settle(given.filter("is_query").groupBy("vec", "vec_id").agg(
        F.count(F.lit(1)).alias("n")).join(classes.select("vec", "class"), "vec"))
    queries = asks.select(F.col("class").alias("query"), "vec").dropDuplicates(["query"])
    total = classes.agg(F.coalesce(F.sum("dim"), F.lit(0))).first()[0]
    asked = queries.agg(F.coalesce(F.sum(F.size("vec")), F.lit(0))).first()[0]
    edges = find_cells(classes, cells)
    edges = Cells(0, 0, []) if edges is None else edges
    stripes = max(1, -(-total // stripe_components))
    blocks = max(1, -(-asked // block_components))
    va = approximation(classes, edges, stripes)
    given_queries = queries.withColumns({
        "dim": F.size("vec"),
        "block": F.pmod(F.xxhash64("query", F.lit(7)), F.lit(blocks)).cast("int")})
    lower = _meet(va.select("dim", "stripe", "cells"), given_queries, stripes, blocks,
                  partial(_floors, edges, places), "query bigint, bound bigint")
    by_bound = Window.partitionBy("query").orderBy(F.desc("bound"))
    floors = (lower.withColumn("_place", F.row_number().over(by_bound))
              .filter(F.col("_place") <= places).groupBy("query")
              .agg(F.when(F.count(F.lit(1)) == places, F.min("bound")).alias("floor")))
    bounded = given_queries.join(floors, "query", "left")
    best = _meet(va.select("dim", "stripe", "cells", "vec", "ids", "class"), bounded, stripes,
                 blocks, partial(_exact, edges, places),
                 "query bigint, score bigint, vec_id bigint, class bigint")
    order = Window.partitionBy("query").orderBy(
        F.desc("score"), F.col("vec_id").asc_nulls_last(), "class")
    lists = (best.withColumn("place", F.row_number().over(order))
             .filter(F.col("place") <= places).groupBy("query")
             .agg(F.sort_array(F.collect_list(
                 F.struct("place", "score", "vec_id", "class"))).alias("found")))
    joined = asks.select(F.col("class").alias("query"), F.col("vec_id").alias("query_id"),
                         "n").join(lists, "query")
    own = F.filter("found", lambda x: (x["class"] == F.col("query"))
                   & x.vec_id.eqNullSafe(F.col("query_id")))
    place = F.coalesce(F.get(own, F.lit(0))["place"], F.lit(0))
    others = F.slice(F.filter("found", lambda x: x.place != F.col("_own")), 1, k)
    return (
        joined.withColumn("_own", place)
        .select("query_id", others.alias("others"), F.explode(F.sequence(
            F.lit(1).cast("long"), F.col("n"))).alias("_copy"))
        .select("query_id", F.posexplode("others").alias("rank", "x"))
        .select("query_id", (F.col("rank") + 1).alias("rank"), "x.vec_id", "x.score"))
