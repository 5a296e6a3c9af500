import numpy as np
import pytest
from pyspark.sql import types as T

from lodestone.llm import neighbours


def brute(ids, m, every=20, count=20):
    """Of each query its nearest: (score, id) in order."""
    order = np.argsort(ids, kind="stable")
    ids, m = ids[order], m[order].astype(np.float64)
    q = np.flatnonzero(ids % every == 0)
    s = m[q] @ m.T
    s[np.arange(len(q)), q] = -np.inf
    out = {}
    for k, i in enumerate(q):
        at = np.lexsort((ids, -s[k]))[:count]
        out[int(ids[i])] = [(int(ids[j]), s[k][j]) for j in at if np.isfinite(s[k][j])]
    return out


def frame(spark, ids, m, kind="float"):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, m, strict=True)], f"vec_id long, embedding array<{kind}>")


def recall(got, want):
    found = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(found) == set(want)
    return np.mean([len(found[q] & {i for i, _ in w}) / len(w) for q, w in want.items()])


@pytest.mark.parametrize("rows,dim", [(2_000, 64), (20_000, 32)])
def test_recall_and_exact_scores(spark, rows, dim):
    rng = np.random.default_rng(rows)
    m = rng.standard_normal((rows, dim)).astype(np.float32)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    ids = rng.permutation(rows * 2)[:rows]
    got = neighbours.nearest(frame(spark, ids, m)).collect()
    want = brute(ids, m)
    assert recall(got, want) >= 0.95
    at = {int(i): x for i, x in zip(ids, m.astype(np.float64), strict=True)}
    lists = {}
    for r in got:
        assert abs(r.score - at[r.query_id] @ at[r.vec_id]) < 1e-12
        lists.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    for rows_ in lists.values():
        rows_.sort()
        assert [k for k, *_ in rows_] == list(range(1, 21))
        assert [x[1:] for x in rows_] == sorted((x[1:] for x in rows_), key=lambda x: (-x[0], x[1]))


def test_odd_rows_equal_brute_force(spark):
    """Nulls, zeros, non-finite numbers, equal vectors, repeated ids, other lengths, very large and very small numbers, clashing names."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)] + [(2000, [1e150] * 8), (2001, [1e-150] * 8), (2002, [3.0, 4.0]), (2020, [0.1] * 12)]
    odd = [(None, [1.0] * 8), (3000, None), (3020, [0.0] * 8), (3040, [float("nan")] + [1.0] * 7), (3060, [None] + [1.0] * 7), (3080, [float("inf")] * 8), (3100, [])]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])
    df = spark.createDataFrame(rows + odd + [rows[3]], schema).selectExpr("*", "'x' as v", "1 as score", "2 as rank", "3 as query_id")
    m = np.zeros((len(rows), 12))
    for k, (_, v) in enumerate(rows):
        m[k, : len(v)] = v
    want = brute(np.array([i for i, _ in rows]), m)
    got = {}
    for r in neighbours.nearest(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(want)
    for q, w in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in w], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in w], rtol=1e-12)


def test_one_vector_of_a_third_of_all_rows_over_many_groups(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "GROUP", 256)
    rng = np.random.default_rng(6)
    m = np.abs(rng.standard_normal((3000, 16))).astype(np.float32)  # all on one side of many planes
    m[:1000] = m[0]
    ids = np.arange(3000)
    assert recall(neighbours.nearest(frame(spark, ids, m)).collect(), brute(ids, m)) >= 0.95


def test_few_rows_and_none(spark):
    assert neighbours.nearest(frame(spark, np.array([], int), [])).count() == 0
    assert neighbours.nearest(frame(spark, np.array([20]), [[1.0, 2.0]])).count() == 0
    got = neighbours.nearest(frame(spark, np.array([20, 40, 41]), [[1.0, 0.0], [1.0, 0.0], [0.5, 0.0]])).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(20, 1, 40, 1.0), (20, 2, 41, 0.5), (40, 1, 20, 1.0), (40, 2, 41, 0.5)]
