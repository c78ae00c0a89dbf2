"""Jacobi-Davidson whitening against dense eigenvectors."""

import numpy as np
import pytest

from visitlens.llm import whitening as W
from visitlens.llm.jacobi_davidson import block_minres, largest_eigenpairs


@pytest.mark.parametrize("dimension, wanted, shape", [(40, 8, "flat"), (200, 12, "falling"), (120, 10, "repeated"), (30, 30, "flat"), (3, 8, "flat")])
def test_eigenpairs(dimension, wanted, shape):
    rng = np.random.default_rng(dimension)
    q, _ = np.linalg.qr(rng.standard_normal((dimension, dimension)))
    values = {"flat": 1 + rng.random(dimension), "falling": np.exp(-np.arange(dimension) / 15.0), "repeated": 1.0 + np.arange(dimension) // 4}[shape]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    seen = []
    found, vectors = largest_eigenpairs(lambda x: seen.append(x.shape[1]) or a @ x, dimension, wanted)
    wanted = min(wanted, dimension)
    assert np.allclose(found, np.sort(values)[::-1][:wanted], rtol=0, atol=1e-13 * values.max())
    assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() < 1e-13
    assert np.linalg.norm(a @ vectors - vectors * found, axis=0).max() < 1e-13 * values.max()


def test_minres_solves_the_projected_equations():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    away, _ = np.linalg.qr(rng.standard_normal((30, 4)))
    project = np.eye(30) - away @ away.T
    rhs, shift = project @ rng.standard_normal((30, 3)), np.array([0.5, -40.0, 7.25])
    x = block_minres(lambda v: a @ v, rhs, shift, away, 60, 1e-12)
    for k in range(3):
        assert np.allclose(project @ (a - shift[k] * np.eye(30)) @ project @ x[:, k], rhs[:, k], atol=1e-7)
        assert np.allclose(away.T @ x[:, k], 0, atol=1e-9)


def _table(spark, rows):
    return spark.createDataFrame([(i, v, 7, 0.5) for i, v in rows], "vec_id long, embedding array<float>, n int, whitened double")


def test_equals_dense_whitening(spark):
    rng = np.random.default_rng(5)
    x = (rng.standard_normal((500, 12)) * np.linspace(0.2, 3, 12)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (901, []), (902, [0.1] * 11 + [float("nan")]), (903, [0.1] * 11 + [None]), (904, [float("inf")] + [0.0] * 11)]
    rows += [(905, [1.0, 2.0]), (None, x[0].tolist()), (3, x[3].tolist())]
    good = np.vstack([x, x[0], x[3]]).astype(float)
    codes = np.floor(64 * good).astype(np.int64) + 1_000_000
    n, sums = len(codes), codes.sum(0)
    deviation = (n * codes - sums) ** 2
    centred = codes - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = W.whiten(_table(spark, rows)).toPandas()
    assert len(out) == n * 12 and set(out["component"]) == set(range(1, 13)) and (out["n"] == n).all()
    assert out["identity_error"].nunique() == 1 and out["identity_error"][0] < 1e-12
    ids = [*range(500)]
    for k in range(12):
        part = out[(out["component"] == k + 1) & out["vec_id"].notna()].drop_duplicates("vec_id").set_index("vec_id").loc[ids]
        expected = centred[:500] @ vectors[:, k] / np.sqrt(values[k])
        sign = np.sign(expected @ part["whitened"].to_numpy())
        assert np.allclose(sign * part["whitened"], expected, atol=1e-9)
        assert np.allclose(part["explained"], values[k] / values.sum(), rtol=1e-12)
        assert (part["deviation"].to_numpy() == deviation[:500].sum(1)).all()


def test_components_follow_the_wanted_number(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((300, 40)) * np.linspace(1, 2, 40)
    out = W.whiten(_table(spark, [(i, v.tolist()) for i, v in enumerate(x)])).toPandas()
    assert len(out) == 300 * 32 and out["explained"].groupby(out["component"]).first().is_monotonic_decreasing


def test_what_has_no_components(spark):
    assert W.whiten(_table(spark, [(1, [1.0, 2.0])] * 3)).count() == 0
    assert W.whiten(_table(spark, [(1, [1.0, 2.0])])).count() == 0
    assert W.whiten(_table(spark, [(1, None), (2, [])])).count() == 0
    assert W.whiten(_table(spark, [(1, [1.0])]).limit(0)).count() == 0
    flat = W.whiten(_table(spark, [(i, [float(i), 3.0, -2.0 * i]) for i in range(20)])).toPandas()
    assert set(flat["component"]) == {1} and abs(flat["explained"][0] - 1) < 1e-12


def test_deviations_beyond_a_long_are_null(spark):
    big = float(1 << 35)
    out = W.whiten(_table(spark, [(1, [big, 0.0]), (2, [-big, 1.0]), (3, [0.0, 2.0])])).toPandas()
    assert out["deviation"].isna().any() and out["whitened"].notna().all()
    with pytest.raises(Exception, match="too large"):
        W.whiten(_table(spark, [(1, [1e30, 0.0]), (2, [0.0, 0.0])])).count()
