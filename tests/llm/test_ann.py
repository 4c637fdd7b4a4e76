import math

import numpy as np
import pytest

from marlstone.llm import ann


def brute(rows, k=20, every=20):
    out = {}
    for q, x in rows:
        if q % every == 0:
            scores = sorted(((-float(np.dot(x, y)), v) for v, y in rows if v != q))
            out[q] = [(v, -s) for s, v in scores[:k]]
    return out


def vectors(n, dims, seed):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dims)) + 2 * r.normal(size=(8, dims))[r.integers(0, 8, n)]
    return [(i, v.tolist()) for i, v in enumerate(x * r.uniform(0.5, 2, n)[:, None])]


@pytest.mark.parametrize("n,dims,list_rows", [(3000, 16, 64), (900, 64, 32)])
def test_recall_and_scores(spark, monkeypatch, n, dims, list_rows):
    monkeypatch.setattr(ann, "LIST_ROWS", list_rows)
    monkeypatch.setattr(ann, "CELL", 100)
    rows = vectors(n, dims, n)
    got = {}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for r in sorted(ann.search(df, lambda i: i % 20 == 0).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score, r.rank))
    want, found = brute(rows), 0
    assert set(got) == set(want)
    for q, near in got.items():
        assert [x[2] for x in near] == list(range(1, 21))
        assert all(a[1] > b[1] or a[1] == b[1] and a[0] < b[0] for a, b in zip(near, near[1:]))
        assert all(math.isclose(s, np.dot(rows[q][1], rows[v][1]), rel_tol=1e-9, abs_tol=1e-12) for v, s, _ in near)
        found += len({v for v, _, _ in near} & {v for v, _ in want[q]})
    assert found / (20 * len(want)) >= 0.9


@pytest.mark.parametrize("hot,copies", [(50, 1), (1, 2), (50, 3)])
def test_rows_that_share_an_id_take_one_place(spark, monkeypatch, hot, copies):
    """An id with many near rows, and rows that all occur twice: the other neighbours are found all the same."""
    monkeypatch.setattr(ann, "CELL", 64)
    monkeypatch.setattr(ann, "LIST_ROWS", 200)
    r = np.random.default_rng(hot)
    rows = [(i, v.tolist()) for i, v in enumerate(r.normal(size=(100, 8))) for _ in range(copies)]
    rows += [(1, (3 * np.array(rows[0][1]) + 0.01 * r.normal(size=8)).tolist()) for _ in range(hot)]
    rows += [(0, r.normal(size=8).tolist()) for _ in range(hot - 1)]
    best = {}
    for q, x in rows:
        for v, y in rows:
            if q % 20 == 0 and q != v:
                best[q, v] = max(best.get((q, v), -math.inf), float(np.dot(x, y)))
    want = {q: sorted((-s, v) for (a, v), s in best.items() if a == q)[:20] for q in range(0, 100, 20)}
    got = {}
    for x in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append((-x.score, x.vec_id))
    assert {q: [v for _, v in near] for q, near in got.items()} == {q: [v for _, v in near] for q, near in want.items()}
    assert all(np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]]) for q in want)


def test_test_data(spark):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r.vec_id, np.array(r.embedding, dtype=float)) for r in e.collect()]
    want, got = brute(rows), {}
    for r in ann.search(e, lambda i: i % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(got[q] & {v for v, _ in want[q]}) for q in want) / sum(map(len, want.values())) >= 0.9


def asked(df, monkeypatch):
    """What search finds, by query, and the share of all candidates that a query reads."""
    seen, real = [], ann._indexed

    def indexed(*args):
        placed, queries = real(*args)
        lists = lambda df: df.selectExpr("explode(lists) AS list")
        read = lists(queries).join(lists(placed).groupBy("list").count(), "list").agg({"count": "sum"}).first()[0]
        seen.append(read / queries.select("id").distinct().count() / placed.select("id").distinct().count())
        return placed, queries

    monkeypatch.setattr(ann, "_indexed", indexed)
    got = {}
    for r in ann.search(df, lambda i: i % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    return got, seen


def recall(got, rows):
    want = brute(rows)
    assert set(got) == set(want)
    return sum(len(got[q] & {v for v, _ in want[q]}) for q in want) / sum(map(len, want.values()))


def test_lists_are_pruned(spark, monkeypatch):
    """At a recall of 0.9 a query reads a small part of the vectors where these have structure, and under a fifth
    of the check tool's, which have hardly any."""
    r = np.random.default_rng(11)
    x = 3 * r.normal(size=(200, 24))[r.integers(0, 200, 6000)] + r.normal(size=(6000, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, read = asked(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), monkeypatch)
    assert recall(got, rows) >= 0.9 and read[0] < 0.12


def test_the_check_tools_vectors(spark, monkeypatch):
    e = spark.read.parquet("/root/testdata/check_l/embeddings.parquet").select("vec_id", "embedding")
    got, read = asked(e, monkeypatch)
    rows = e.toPandas()
    ids, x = rows["vec_id"].to_numpy(), np.stack(rows["embedding"].to_list()).astype(float)
    q = np.flatnonzero(ids % 20 == 0)
    s = x[q] @ x.T
    s[np.arange(len(q)), q] = -np.inf
    top = ids[np.argpartition(-s, 19, axis=1)[:, :20]]
    assert np.mean([len(got[i] & set(t.tolist())) / 20 for i, t in zip(ids[q].tolist(), top)]) >= 0.9
    assert read[0] < 0.2


def test_widely_differing_norms(spark, monkeypatch):
    r = np.random.default_rng(12)
    rows = [(i, v.tolist()) for i, v in enumerate(r.normal(size=(4000, 12)) * np.exp(r.normal(size=4000) * 1.5)[:, None])]
    got, _ = asked(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), monkeypatch)
    assert recall(got, rows) >= 0.9


@pytest.mark.parametrize("copies", [1000, 4000])
def test_a_hot_vector_costs_no_more_than_others(spark, monkeypatch, copies):
    """Its copies are folded to k + 1 candidates, and cells give k pairs a query at most."""
    monkeypatch.setattr(ann, "CELL", 256)
    r = np.random.default_rng(13)
    x = r.normal(size=(2000, 8)).round(2)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000 + i, x[7].tolist()) for i in range(copies)]
    made, real = [], ann._met

    def met(spark, placed, queries, k, most):
        out = real(spark, placed, queries, k, most)
        made.append((placed.count(), queries.count(), out.count()))
        return out

    monkeypatch.setattr(ann, "_met", met)
    got = {}
    for n in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i % 20 == 0).collect():
        got.setdefault(n.query_id, []).append((n.rank, n.vec_id))
    assert sum(p for p, *_ in made) <= 2 * 2 * (2000 + 21) and sum(n for *_, n in made) <= 20 * sum(q for _, q, _ in made)
    # The hot vector's copies find each other's least ids, without their own.
    exact = [(i, float(x[7] @ v)) for i, v in enumerate(x)]
    above = sorted(i for i, s in exact if s > float(x[7] @ x[7]))
    for q in range(2000, 2000 + copies, 20):
        equal = [i for i in [7, *range(2000, 2000 + copies)] if i != q][: 20 - len(above)]
        assert {v for _, v in got[q]} >= set(equal) - set(above) or len(above) >= 20


def test_other_lengths_and_magnitudes(spark):
    """Vectors of every length find those of their own; huge and tiny components neither overflow nor vanish."""
    r = np.random.default_rng(14)
    rows = [(i, (10.0 ** (150 if i % 2 else -150) * r.normal(size=3 + i % 3)).tolist()) for i in range(300)]
    got = {}
    for n in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i % 20 == 0).collect():
        got.setdefault(n.query_id, []).append((n.rank, n.vec_id))
    for q in range(0, 300, 20):
        mine = sorted(((-float(np.dot(rows[q][1], x)), v) for v, x in rows if v != q and len(x) == len(rows[q][1])))[:20]
        assert [v for _, v in sorted(got[q])] == [v for _, v in mine]


def test_graph_finds_the_nearest():
    r = np.random.default_rng(2)
    c = r.normal(size=(300, 12)).astype(np.float32)
    index = ann.Index(c, ann.neighbour_graph(c), 1.0, 1.0)
    q = r.normal(size=(50, 12)).astype(np.float32)
    ids, dist = ann.search_graph(index, q, 32)
    exact = ((q[:, None, :] - c[None]) ** 2).sum(axis=2)
    assert (ids[:, 0] == exact.argmin(axis=1)).mean() > 0.97
    assert np.allclose(dist, np.take_along_axis(exact, ids, axis=1), atol=1e-3)
    assert all(len(set(row)) == len(row) for row in ids.tolist())


def test_lists_are_balanced():
    x = np.random.default_rng(3).normal(size=(4000, 8))
    c = ann.balanced_centroids(x, 100)
    n = np.bincount(ann._nearest(x, c), minlength=len(c))
    assert len(c) == 64 and n.max() < 4 * n.mean()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [None, 1.0]),
            (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (40, [0.0, 0.0]), (1, [3.0, 0.0]), (0, [1.0, 0.0])]
    df = spark.createDataFrame([(*r, "mine") for r in rows], "vec_id long, embedding array<double>, list string")
    got = sorted(tuple(r) for r in ann.search(df, lambda i: i % 20 == 0).collect())
    assert got == [(0, 1, 1, 3.0), (0, 2, 2, 1.0), (0, 3, 20, 0.0), (20, 1, 1, 2.0), (20, 2, 2, 2.0), (20, 3, 0, 0.0)]
    assert ann.search(df.where("false"), lambda i: i % 20 == 0).collect() == []
    assert ann.search(df.where("vec_id = 0"), lambda i: i % 20 == 0).collect() == []
