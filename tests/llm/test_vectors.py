"""Neighbours beside brute force; the estimate and its bound."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from plumbline.llm import vectors as V


def brute(ids, x, asked, k=10):
    out = set()
    for q in asked:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        rows = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
        out |= {(int(q), r, int(ids[i])) for r, i in enumerate(rows, 1)}
    return out


@pytest.mark.parametrize("block", [1, 7, 2048])
def test_recall_on_embeddings(spark, block):
    path = "/root/testdata/sf0.1/embeddings.parquet"
    raw = pq.read_table(path)
    ids, x = raw.column("vec_id").to_numpy(), np.array(raw.column("embedding").to_pylist(), np.float64)
    table = spark.read.parquet(path)
    got = V.nearest(table.filter("vec_id % 100 = 0"), table, block=block).collect()
    want = brute(ids, x, ids[ids % 100 == 0])
    assert len({(r.query_id, r["rank"], r.vec_id) for r in got} & want) >= 0.99 * len(want) and len(got) == len(want)
    at = {i: v for i, v in zip(ids, x)}
    assert all(math.isclose(r.score, np.linalg.norm(at[r.query_id] - at[r.vec_id]), rel_tol=1e-12) for r in got)


def test_most_candidates_are_not_reranked_where_the_codes_tell_them_apart():
    rng = np.random.default_rng(1)
    dim = 256
    middles = rng.normal(size=(40, dim))
    x = middles[np.repeat(np.arange(40), 50)] + 0.2 * rng.normal(size=(2000, dim))
    turn = V.rotation(dim)
    middle = x.mean(axis=0)
    y = (x - middle) @ turn
    size = np.linalg.norm(y, axis=1)
    best = V.Best(np.arange(20) * 100, x[::100], middle, 10, V.BOUND)
    best.offer(np.arange(2000), x, np.packbits(y > 0, axis=1), size, np.abs(y).sum(axis=1) / np.sqrt(dim) / size)
    assert best.reranked < 0.1 * best.seen
    got = {(int(q), r, int(i)) for q, row in zip(best.ids, best.id) for r, i in enumerate(row, 1)}
    assert len(got & brute(np.arange(2000), x, best.ids)) >= 0.99 * len(got)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (8, [1.0]), (None, [1.0, 1.0]), (1, [1.0, 0.0]), (100, [0.0, 0.0]), (0, [1.0, 0.0])]
    table = spark.createDataFrame([(*r, 9) for r in rows], "vec_id bigint, embedding array<float>, size int")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in V.nearest(table.filter("vec_id % 100 = 0"), table).collect()]
    assert sorted(got) == [(0, 1, 1, 0.0), (0, 2, 1, 0.0), (0, 3, 2, math.sqrt(2))]
    assert V.nearest(table.limit(0), table).count() == 0
    assert V.nearest(table, table.limit(0)).count() == 0
