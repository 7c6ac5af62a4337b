"""Whitening against plain linear algebra and exact sums, and its odd cases."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiers.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def matrices():
    rng = np.random.default_rng(3)
    turn, _ = np.linalg.qr(rng.normal(size=(24, 24)))

    def with_values(*values):
        m = (turn * np.array([*values, *[0.0] * (24 - len(values))])) @ turn.T
        return (m + m.T) / 2

    x = rng.normal(size=(400, 24))
    yield np.cov(x.T)
    yield np.cov(x[:6].T)
    yield np.eye(24) * 7
    yield np.ones((24, 24))
    yield np.zeros((24, 24))
    yield with_values(5, 5, 5, 5 - 1e-9, 3, 3 - 1e-13, 1, 1)
    yield with_values(*np.logspace(6, -8, 24))
    yield np.array([[0.0, 1.0], [1.0, 0.0]])


@pytest.mark.parametrize("matrix", list(matrices()))
def test_slices_against_plain_eigenvalues(matrix):
    values, vectors = whitening.leading(matrix, 16)
    plain = np.linalg.eigvalsh(matrix)[::-1][: len(values)]
    scale = max(1e-300, np.abs(plain).max())
    assert np.abs(values - plain).max() <= 1e-12 * scale
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-12 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12


def test_counts_are_those_of_the_inertia():
    rng = np.random.default_rng(5)
    m = rng.normal(size=(15, 15))
    m = m + m.T
    for shift in rng.normal(size=20) * 5:
        f = whitening.factor(m, shift)
        assert f.positive == (np.linalg.eigvalsh(m) > shift).sum()
        b = rng.normal(size=15)
        assert np.allclose((m - shift * np.eye(15)) @ f.solve(b), b)


def plain(rows):
    """The contract, written down with exact sums and a library's eigenvectors."""
    usable = [(i, v) for i, v, _ in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in usable]
    fit = sorted(set(map(tuple, x)))
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    deviation = [sum((n * c - t) ** 2 for c, t in zip(row, s, strict=True)) for row in x]

    def centred(row):
        return [float(c - Fraction(t, n)) for c, t in zip(row, s, strict=True)]

    y = np.array([centred(row) for row in fit])
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:16], u[:, ::-1][:, :16]
    whitened = np.array([centred(row) for row in x]) @ u / np.sqrt(e)
    return [i for i, _ in usable], n, deviation, whitened, e / np.trace(v)


def test_whitened_table_against_plain(spark):
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(size=20) * np.arange(1, 21)).tolist(), 1) for i in range(300)]
    rows += [(500 + i, rows[3][1], 1) for i in range(40)] + [rows[9]]
    odd = [(900, None, 1), (901, [], 1), (902, [None] + [1.0] * 19, 1), (903, [float("nan")] * 20, 1), (904, [float("inf")] * 20, 1)]
    ids, n, deviation, whitened, explained = plain(rows)
    table = spark.createDataFrame(rows + odd + [(905, [1.0] * 3, 1)], SCHEMA).repartition(5)
    table = table.withColumn("x", F.lit("clash")).withColumn("n", F.lit(0)).withColumn("component", F.lit(0))
    found = whitening.whiten(table)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = found.collect()
    assert len(got) == 16 * len(rows)
    assert {r.n for r in got} == {n} and n == 300
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10
    want = dict(zip(ids, zip(deviation, whitened, strict=True), strict=True))
    sign = np.zeros(16)
    for r in got:
        d, w = want[r.vec_id]
        assert r.deviation == d and r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        assert abs(r.whitened) == pytest.approx(abs(w[r.component - 1]), rel=1e-7, abs=1e-8)
        if abs(r.whitened) > 1e-6:
            s = np.sign(r.whitened) * np.sign(w[r.component - 1])
            assert sign[r.component - 1] in (0, s)
            sign[r.component - 1] = s
    again = sorted((r.vec_id, r.component, r.whitened) for r in whitening.whiten(table.repartition(2)).collect())
    assert again == sorted((r.vec_id, r.component, r.whitened) for r in got)


def test_whitening_of_odd_tables(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (None, [1.0, 2.0], 0)], SCHEMA)
    got = whitening.whiten(one).collect()
    assert len(got) == 6 and all(r.whitened is None and r.n == 1 and r.deviation == 0 and r.explained is None for r in got)
    flat = spark.createDataFrame([(1, [1.0, 5.0], 0), (2, [3.0, 5.0], 0), (None, [5.0, 5.0], 0)], SCHEMA)
    got = {(r.vec_id, r.component): r for r in whitening.whiten(flat).collect()}
    assert abs(got[1, 1].whitened) == pytest.approx(1.5**0.5) and got[2, 1].whitened == pytest.approx(0)
    assert got[None, 2].whitened is None and got[1, 1].explained == 1 and got[1, 2].explained == 0
    assert whitening.whiten(one.where("false")).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, 0)], SCHEMA)).count() == 0
    large = spark.createDataFrame([(1, [3e13], 0), (2, [-3e13], 0), (3, [1e30], 0)], SCHEMA)
    got = whitening.whiten(large).collect()
    assert {r.vec_id for r in got} == {1, 2} and all(r.deviation is None and abs(r.whitened) == pytest.approx(1) for r in got)
