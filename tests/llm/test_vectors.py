"""Hard negatives, whitening and nearest rows against plain versions, and on odd tables."""

from __future__ import annotations

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postlume.llm import nearest as N
from postlume.llm.hardnegatives import hard_negatives
from postlume.llm.nearest import nearest
from postlume.llm.queries import op11_hard_negatives, op13_nearest
from postlume.llm.vectors import first_of_groups, integer_products, matrices
from postlume.llm.whitening import fit_whitening, grid, leading_eigenpairs, minres, whiten

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, rank string, score string, n string, _strip int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", "s", "n", 1) for r in rows], SCHEMA).repartition(3)


def random_rows(n=300, dim=6, labels=3, seed=3):
    """Few distinct numbers, so that scores tie often."""
    rng = random.Random(seed)
    return [(i, [rng.choice([-1.0, -0.5, 0.25, 0.5, 1.0]) for _ in range(dim)], rng.randrange(labels)) for i in range(n)]


ODD = [(100, None, 1), (200, [1.0, None, 0.0], 1), (300, [1.0, NAN, 0.0], 2), (400, [INF, 0.0, 0.0], 2), (500, [1.0, 0.5, 0.25], None),
       (None, [1.0, 0.5, 0.25], 1), (600, [0.0, 0.0, 0.0], 1), (700, [1.0, 0.5], 1), (701, [0.5, 0.5], 1), (702, [0.75, 0.5], 2),
       (800, [1.0, 0.5, 0.25], 1), (800, [1.0, 0.5, 0.25], 1), (801, [1.0, 0.5, 0.25], 1), (802, [1.0, 0.25, 0.25], 2),
       (803, [1.0, 0.25, 0.25], 2), (803, [1.0, 0.25, 0.25], 2), (900, [], 1), (901, [3e38, -3e38, 3e38], 1), (1000, [3e38, -3e38, 3e38], 1)]


def ints(vector):
    return [max(-(1 << 63), min((1 << 63) - 1, math.floor(256 * float(np.float32(x))))) for x in vector]


def usable(rows, labelled):
    return [r for r in rows if r[0] is not None and r[1] is not None and (r[2] is not None or not labelled)
            and all(x is not None and math.isfinite(x) for x in r[1])]


def plain_hard_negatives(rows):
    rows = [(i, ints(v), label) for i, v, label in usable(rows, True)]
    out = []
    for anchor, a, own in rows:
        if anchor % 100:
            continue
        scored = sorted(((max(-(1 << 62), min(1 << 62, sum(x * y for x, y in zip(a, v)))), -i, label) for i, v, label in rows
                         if i != anchor and len(v) == len(a)), reverse=True)
        for p, pid, _ in [s for s in scored if s[2] == own][:5]:
            window = [s for s in scored if s[2] != own and 80 * p <= 100 * s[0] <= 100 * p][:5]
            out += [(anchor, -pid, rank, -nid, p, n) for rank, (n, nid, _) in enumerate(window, 1)]
    return sorted(out)


def mined(df, **options):
    scaled = df.withColumn("vector", F.expr("transform(embedding, x -> floor(CAST(x AS DOUBLE) * 256))")).where(
        "embedding IS NULL OR forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    found = hard_negatives(scaled, F.col("vec_id") % 100 == 0, **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("strip, column", [(16384, 16384), (2, 50)])
def test_hard_negatives_equal_the_plain_version(spark, strip, column):
    rows = random_rows() + [(1000 + i, v, 1 - i % 2) for i, (_, v, _) in enumerate(random_rows(40))]
    expected = plain_hard_negatives(rows)
    assert len(expected) > 50
    assert mined(frame(spark, rows), strip=strip, column=column) == expected


def test_hard_negatives_of_odd_rows(spark):
    found = mined(frame(spark, ODD))
    assert found == plain_hard_negatives(ODD)
    # The repeated anchor is answered twice, and a repeated candidate counts twice.
    assert [f[2:4] for f in found if f[:2] == (800, 801)] == 2 * [(1, 802)] + 2 * [(2, 803)] + 2 * [(3, 803)]
    assert mined(frame(spark, [])) == []
    assert mined(frame(spark, [(1, [1.0], 1)])) == []


def test_hard_negatives_by_contract(spark, tmp_path):
    """Other rows are all but the anchor's own, whatever ids they carry; scores fill a long."""
    rows = 2 * random_rows(120, 4) + [(None, [1.0, 1.0, 1.0, 0.5], i % 3) for i in range(4)]
    rows += [(201, [5e6, 2.0, 0.0, 0.0], 0), (300, [5e6, 1.0, 0.0, 0.0], 0), (304, [4.5e6, 1.0, 0.0, 0.0], 1), (305, [4.7e6, 1.0, 0.0, 0.0], 1)]
    rows = [(i, [2.1 * x for x in v] if i and i > 200 else v, label) for i, v, label in rows]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    known = [(i, ints(v), (label + 1) % 10 if i is not None and i % 7 == 0 else label) for i, v, label in rows]
    expected = []
    for at, (anchor, a, own) in enumerate(known):
        if anchor is None or anchor % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v)), i is None, i or 0, label) for j, (i, v, label) in enumerate(known) if j != at)
        for p, no_p, pid, _ in [s for s in scored if s[3] == own][:5]:
            window = [s for s in scored if s[3] != own and 80 * p >= 100 * s[0] >= 100 * p][:5]
            expected += [(anchor, None if no_p else pid, rank, None if no_n else nid, -p, -n) for rank, (n, no_n, nid, _) in enumerate(window, 1)]
    assert max(e[5] for e in expected) > 1 << 61 and any(e[1] == e[0] for e in expected) and any(None in e for e in expected)
    assert any(1 << 62 < e[4] < 1 << 63 for e in expected)
    got = map(tuple, op11_hard_negatives(spark, str(tmp_path)).collect())
    assert collections.Counter(got) == collections.Counter(expected)


def test_all_scores_equal(spark):
    rows = [(i, [1.0, 1.0], i % 2) for i in range(400)]
    assert mined(frame(spark, rows), strip=3, column=70) == plain_hard_negatives(rows)


def test_integer_products_are_exact():
    rng = np.random.default_rng(5)
    for most in (100, 1 << 20, 1 << 28):
        a, b = rng.integers(-most, most, (7, 9)), rng.integers(-most, most, (5, 9))
        assert (integer_products(a, b) == (a.astype(object) @ b.astype(object).T)).all()
    huge = np.array([[1 << 62, 1 << 62]])
    assert integer_products(huge, huge).tolist() == [[1 << 62]]


def test_first_of_groups_and_matrices():
    groups, scores, ids = np.array([1, 0, 1, 1, 0]), np.array([5, 1, 7, 7, 1]), np.array([3, 9, 8, 2, 4])
    assert sorted(first_of_groups(groups, scores, ids, 2).tolist()) == [1, 2, 3, 4]
    assert sorted(first_of_groups(groups, scores, ids, 1).tolist()) == [3, 4]
    lists = pa.array([[9.0], [1.0, 2.0], [], [3.0, 4.0]]).slice(1)
    assert [(at.tolist(), m.tolist()) for at, m in matrices(lists)] == [([1], [[]]), ([0, 2], [[1.0, 2.0], [3.0, 4.0]])]


# -- nearest --------------------------------------------------------------------

def plain_nearest(rows, k=20):
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v, _ in usable(rows, False) if any(v)]
    out = []
    for query, q in rows:
        if query % 20 == 0:
            scored = [(-sum(x * y for x, y in zip(q, v)), i) for i, v in rows if i != query and len(v) == len(q)]
            out += [(query, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def found_nearest(df, **options):
    found = nearest(df, F.col("vec_id") % 20 == 0, **options)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("strip, column", [(16384, 16384), (4, 37)])
def test_nearest_equals_the_plain_version(spark, strip, column):
    assert found_nearest(frame(spark, random_rows()), strip=strip, column=column) == plain_nearest(random_rows())


def test_nearest_of_odd_rows(spark):
    assert found_nearest(frame(spark, ODD)) == plain_nearest(ODD)
    assert found_nearest(frame(spark, [])) == []
    assert found_nearest(frame(spark, [(20, [1.0], 1)])) == []


def test_nearest_by_contract(spark, tmp_path):
    """Candidates are all rows but the query's own: rows that share its id count, and rows without one."""
    rng = np.random.default_rng(4)
    rows = [(None if i % 5 == 0 else 20 * (i % 7), v) for i, v in enumerate(rng.integers(-4, 5, (200, 4)).astype(float).tolist())]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    rows = [r for r in rows if any(r[1])]
    expected = []
    for at, (query, q) in enumerate(rows):
        if query is not None:
            scored = sorted((-sum(x * y for x, y in zip(q, v)), i is None, i or 0) for j, (i, v) in enumerate(rows) if j != at)
            expected += [(query, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(scored[:20], 1)]
    got = map(tuple, op13_nearest(spark, str(tmp_path)).collect())
    assert collections.Counter(got) == collections.Counter(expected)


def test_bounds_rule_out_most_pairs_and_never_a_near_one(monkeypatch):
    rng = np.random.default_rng(9)
    vectors = rng.standard_normal((4000, 32)) * rng.uniform(0.01, 10, (4000, 1))
    table = pa.table({"_row": np.arange(4000), "id": np.arange(4000), "vector": list(vectors)})
    counted, exact = [], N.exact_scores
    monkeypatch.setattr(N, "exact_scores", lambda a, b: counted.append(len(a)) or exact(a, b))
    out = N._cell(10)(table.slice(0, 50), table).to_pydict()
    scores = vectors[:50] @ vectors.T
    scores[np.arange(50), np.arange(50)] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :10]
    assert {(q, i) for q, i in zip(out["query"], out["id"])} == {(q, int(i)) for q in range(50) for i in best[q]}
    assert sum(counted) < 0.02 * 50 * 4000


# -- whitening ------------------------------------------------------------------

def plain_whitening(x, k=16):
    """x: integer vectors. Deviations, whitened figures (either sign), shares."""
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(k, int((values > 1e-12 * values.sum()).sum()))
    white = (n * x - sums) / n @ vectors[:, :k] / np.sqrt(values[:k])
    return n, ((n * x - sums) ** 2).sum(axis=1), white, values[:k] / values.sum()


def check_whitening(df, ids, x):
    got = df.orderBy("vec_id", "component").toPandas()
    n, deviation, white, shares = plain_whitening(x)
    k = white.shape[1]
    assert got.component.tolist() == list(range(1, k + 1)) * len(ids) and (got.n == n).all()
    assert got.vec_id.tolist() == np.repeat(ids, k).tolist() and got.deviation.tolist() == np.repeat(deviation, k).tolist()
    mine = got.whitened.to_numpy().reshape(-1, k)
    sign = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine * sign - white).max() < 1e-9
    assert np.abs(got.explained.to_numpy().reshape(-1, k) - shares).max() < 1e-12 and got.identity_error.max() < 1e-10


def test_whitening_equals_a_dense_solver(spark):
    rng = np.random.default_rng(2)
    vectors = (rng.standard_normal((500, 24)) @ rng.standard_normal((24, 24))).astype(np.float32)
    vectors[400:] = vectors[0]  # copies count once in the fit, and keep their rows
    df = frame(spark, [(i, v.tolist(), 1) for i, v in enumerate(vectors)])
    x = np.floor(64 * vectors.astype(float)).astype(np.int64) + 1_000_000
    check_whitening(whiten(df), np.arange(500), x)


def test_whitening_of_odd_rows(spark):
    keep = [(i, v) for i, v, _ in ODD if v is not None and len(v) == 3 and all(x is not None and math.isfinite(x) for x in v) and abs(v[0]) < 9]
    rows = [r for r in ODD if not (r[1] and r[1][0] and abs(r[1][0]) > 1e30)]
    got = whiten(frame(spark, rows)).collect()
    assert {r.vec_id for r in got} == {i for i, _ in keep} and None in {r.vec_id for r in got}
    # Four distinct vectors, of which three differ in the second entry alone: two components.
    assert max(r.component for r in got) == 2 and {r.n for r in got} == {3}
    assert whiten(frame(spark, ODD)).count() > 0
    for none in ([], [(1, None, 1)], [(1, [1.0, 2.0], 1)], [(1, [1.0], 1), (2, [1.0], 1)], [(1, [], 1)]):
        assert whiten(frame(spark, none)).collect() == []


def test_large_entries_keep_deviations_exact(spark):
    values = [[1e9, 0.0], [-1e9, 3.0], [5.0, 1e9]]
    got = whiten(frame(spark, [(i, v, 1) for i, v in enumerate(values)]), scale=1).orderBy("vec_id", "component").collect()
    x = [[math.floor(float(np.float32(e))) + 1_000_000 for e in v] for v in values]
    sums = [sum(c) for c in zip(*x)]
    exact = [sum((3 * e - s) ** 2 for e, s in zip(v, sums)) for v in x]
    assert [r.deviation for r in got if r.component == 1] == [e if e < 1 << 63 else None for e in exact]


def test_eigenpairs_of_hard_spectra():
    rng = np.random.default_rng(4)
    for values in (np.linspace(1, 2, 150), np.r_[np.full(20, 5.0), np.ones(130)], 10.0 ** -np.arange(150)[:150] * 1e6,
                   np.r_[1e6, np.linspace(1, 1.01, 149)], np.zeros(150)):
        turn, _ = np.linalg.qr(rng.standard_normal((150, 150)))
        v = (turn * values) @ turn.T
        v = (v + v.T) / 2
        got, vectors = leading_eigenpairs(lambda block: v @ block, 150, 16)
        assert np.abs(got - np.sort(values)[::-1][:16]).max() <= 1e-12 * max(values.max(), 1e-300)
        assert np.abs(v @ vectors - vectors * got).max() <= 8 * 150 * 2.3e-16 * max(values.max(), 1e-300)
        assert np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-12


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(6)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    b = rng.standard_normal((30, 4))
    b[:, 3] = 0
    x = minres(lambda block: a @ block, b, 60)
    assert np.abs(a @ x - b).max() < 1e-6 and not x[:, 3].any()


def test_grid_and_fit(spark):
    df = frame(spark, random_rows(50)).select(grid(F.col("embedding"), 64, 10).alias("x"))
    model = fit_whitening(df, "x", 3)
    assert len(model.values) == 3 and model.identity_error < 1e-12
