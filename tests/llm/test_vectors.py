"""Nearest neighbours and embedding near-duplicates against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortflow.llm import forest, pq

SCHEMA = "vec_id bigint, embedding array<float>"


def rows_of(x, start=0):
    return [(start + i, [float(v) for v in r]) for i, r in enumerate(x.astype(np.float32))]


AWKWARD = [
    (9000, None), (9001, []), (9002, [0.0] * 8), (9003, [float("nan")] + [1.0] * 7), (9004, [None] + [1.0] * 7),
    (9005, [float("inf")] + [1.0] * 7), (None, [1.0] * 8), (9006, [1.0, 2.0]),
]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 8))
    near = x[:60] + 0.02 * rng.standard_normal((60, 8))
    return np.concatenate((x, near, np.repeat(x[:1], 40, axis=0), 3.0 * x[5:6])).astype(np.float32)


def test_forest_finds_the_nearest(spark, data):
    v = spark.createDataFrame(rows_of(data) + AWKWARD, SCHEMA).withColumn("score", F.lit("clash"))
    got = forest.nearest(v, F.col("vec_id") % 100 == 0, least=200, share=0.5).collect()
    x = np.concatenate((data.astype(np.float64), [[1.0, 2.0] + [0.0] * 6]))
    ids = np.concatenate((np.arange(len(data)), [9006]))
    hits = 0
    for q in [i for i in ids if i % 100 == 0]:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        order = [k for k in np.lexsort((ids, d)) if ids[k] != q][:10]
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        for r in mine:
            assert r.score == pytest.approx(d[ids == r.vec_id][0], abs=1e-12)
        hits += len({r.vec_id for r in mine} & set(ids[order].tolist()))
    assert hits / (10 * len({r.query_id for r in got})) >= 0.9
    # The copies of vector 0 come first, smaller ids before larger ones.
    first = sorted((r for r in got if r.query_id == 0), key=lambda r: r.rank)
    assert [r.vec_id for r in first] == list(range(460, 470)) and first[0].score == 0


def test_forest_few_or_no_rows(spark):
    v = spark.createDataFrame(rows_of(np.eye(3, 8)), SCHEMA)
    got = forest.nearest(v, F.col("vec_id") % 100 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in sorted(got, key=lambda r: r.rank)] == [(0, 1, 1), (0, 2, 2)]
    assert forest.nearest(v.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    twice = forest.nearest(v.unionAll(v), F.col("vec_id") % 100 == 0).collect()
    assert len(twice) == 2


def brute_links(ids, x, cosine):
    u = x / np.sqrt((x**2).sum(1))[:, None]
    link = (u @ u.T) >= cosine
    np.fill_diagonal(link, False)
    comp = ids.copy()
    while True:
        new = np.array([min(comp[i], comp[link[i]].min(initial=comp[i])) for i in range(len(ids))])
        if (new == comp).all():
            return link.sum(1), comp
        comp = new


def test_links_equal_brute_force(spark, data, monkeypatch):
    monkeypatch.setattr(pq, "BLOCK", 16)
    monkeypatch.setattr(pq, "PROBE_BLOCK", 32)
    monkeypatch.setattr(pq, "LIST_FACTOR", 0.5)
    v = spark.createDataFrame(rows_of(data) + AWKWARD, SCHEMA).withColumn("node", F.lit("clash"))
    got = {r.vec_id: r for r in pq.near_duplicates(v, 0.95).collect()}
    ids = np.concatenate((np.arange(len(data)), [9006]))
    n, comp = brute_links(ids, np.concatenate((data.astype(np.float64), [[1.0, 2.0] + [0.0] * 6])), 0.95)
    for k, i in enumerate(ids.tolist()):
        assert (got[i].n_links, got[i].component_id) == (n[k], comp[k]), i
        assert got[i].kept == (comp[k] == i)
    for i in (9000, 9001, 9002, 9003, 9004, 9005):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[None].component_id is None and got[None].kept


def test_links_empty_table_and_repeated_rows(spark):
    v = spark.createDataFrame(rows_of(np.eye(3, 8)), SCHEMA)
    assert pq.near_duplicates(v.limit(0)).count() == 0
    twice = pq.near_duplicates(v.unionAll(v)).collect()
    assert len(twice) == 6 and all(r.n_links == 1 and r.kept for r in twice)


def test_bounds_hold():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((500, 16))
    x /= np.sqrt((x**2).sum(1))[:, None]
    q = pq.Quantiser(x, 12)
    own = q.own(x)
    codes, error = q.encode(x, own)
    for one in range(12):
        members = np.flatnonzero(own == one)
        if len(members):
            table = np.sqrt(np.maximum(q.table_distances(x, one, codes[members]), 0.0))
            true = np.sqrt(((x[:, None, :] - x[members][None]) ** 2).sum(-1))
            assert (np.abs(table - true) <= error[members][None, :] + 1e-3).all()
    probes = q.probes(x, 0.8)
    d = np.sqrt(((x[:, None, :] - x[None]) ** 2).sum(-1))
    for i, j in zip(*np.nonzero(d <= 0.8), strict=True):
        assert own[j] == own[i] or own[j] in probes[i]
