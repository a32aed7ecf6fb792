"""Exact search against all products."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterline.llm.topk import Cells, _read, scaled, top_products

ROWS = "vec_id long, embedding array<float>, class string, score string"


def plain(rows, k=5, every=50):
    """Every query row with all other rows."""
    given = []
    for vec_id, vector in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            given.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector]))
    found = []
    for i, (query, own) in enumerate(given):
        if query is None or query % every:
            continue
        scores = sorted(
            (-sum(a * b for a, b in zip(own, other)), (v is None, v or 0), v)
            for j, (v, other) in enumerate(given) if j != i and len(other) == len(own))
        found += [(query, rank, v, -s) for rank, (s, _, v) in enumerate(scores[:k], start=1)]
    return sorted(found, key=repr)


def search(spark, rows, every=50, **sizes):
    df = spark.createDataFrame([(i, v, "own", "own") for i, v in rows], ROWS).repartition(4)
    vectors = df.withColumn("vec", scaled(F.col("embedding")))
    found = top_products(vectors, F.col("vec_id") % every == 0, **sizes)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"),
                            ("score", "bigint")]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def near_rows(rng: random.Random, n: int, dim: int):
    centres = [[rng.gauss(0, 0.2) for _ in range(dim)] for _ in range(5)]
    return [[x + rng.gauss(0, 0.08) for x in rng.choice(centres)] for _ in range(n)]


def test_cells_bound_products():
    rng = np.random.default_rng(1)
    values = rng.integers(-500, 500, (300, 9))
    queries = rng.integers(-500, 500, (7, 9))
    cells = Cells(-500, 500, [-300, -300, -20, 0, 1, 2, 90])
    low, high = cells.bounds(cells.of(values), queries)
    exact = 2 * queries @ values.T
    assert (low <= exact).all() and (exact <= high).all()
    narrow = Cells(-500, 500, list(range(-499, 500, 4)))
    low, high = narrow.bounds(narrow.of(values), queries)
    assert (low <= exact).all() and (exact <= high).all()
    for query, bound, products in zip(queries, high, exact // 2):
        near, scores = _read(values, query, bound, None, 6)
        assert sorted(scores)[-6:] == sorted(products)[-6:]
        assert len(near) < 300  # not all vectors are read
    large = Cells(-2**30, 2**30, [0])
    with pytest.raises(OverflowError):
        large.bounds(np.zeros((1, 20), np.uint8), np.full((1, 20), 2**30))


@pytest.mark.parametrize("sizes", [{}, {"stripe_components": 300, "block_components": 40,
                                        "cells": 8}])
def test_search(spark, sizes):
    rng = random.Random(4)
    rows = list(enumerate(near_rows(rng, 400, 12)))
    same = [0.5] * 12  # a vector of very many rows, some of them queries
    rows += [(i, same) for i in rng.sample(range(1000, 1400), 150)] + [(1400, same), (1450, same)]
    rows += [(2000, None), (2050, []), (2051, []), (2100, [1.0, None] + [0.1] * 10),
             (2150, [float("nan")] * 12), (2200, [float("inf")] * 12), (None, same),
             (None, rows[7][1]), (2250, [3.0, -2.0]), (2251, [1.0, 1.0])]
    rows += [rows[50], rows[50], (50, rows[51][1]), (100, [0.0] * 12)]
    found = search(spark, rows, **sizes)
    assert found == plain(rows)
    assert (2250, 1, 2251, 256) in [(q, r, v, s // 256) for q, r, v, s in found]


def test_few_and_no_rows(spark):
    assert search(spark, [(50, [1.0, 2.0])]) == []
    rows = [(0, [1.0]), (50, [1.0]), (7, [-1.0])]
    assert search(spark, rows) == plain(rows)
    assert search(spark, [(1, [1.0]), (2, [2.0])]) == []
    assert search(spark, []) == []
