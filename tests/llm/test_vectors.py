"""The pivot index against brute force."""

import numpy as np
import pyarrow as pa
import pytest

from visitlens.llm import pivots
from visitlens.llm.tables import ship_code

from . import brute


def unit(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def frame(spark, ids, x, kind="float"):
    ship_code(spark)
    data = [(int(i), [float(v) for v in row], "clash") for i, row in zip(ids, x)]
    return spark.createDataFrame(data, f"vec_id long, embedding array<{kind}>, copies string")


def test_clusters_are_exact_also_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK", 16)
    rng = np.random.default_rng(0)
    centres = unit(rng.normal(size=(25, 32)))
    x = unit(np.repeat(centres, 12, 0) + 0.04 * rng.normal(size=(300, 32)))
    x = np.concatenate((x, x[:20], unit(rng.normal(size=(200, 32))))).astype(np.float32)
    ids = rng.permutation(5000)[: len(x)].tolist()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in pivots.near_vectors(frame(spark, ids, x)).collect()}
    assert got == brute.near_vectors(ids, x.astype(float))


def test_recall_close_to_the_threshold(spark):
    rng = np.random.default_rng(1)
    a, noise = unit(rng.normal(size=(800, 64))), rng.normal(size=(800, 64))
    noise -= (noise * a).sum(1, keepdims=True) * a
    cos = rng.uniform(0.9, 0.93, size=(800, 1))
    x = np.concatenate((a, cos * a + np.sqrt(1 - cos**2) * unit(noise)))
    want = sum(n for n, *_ in brute.near_vectors(list(range(len(x))), x).values())
    out = pivots.near_vectors(frame(spark, range(len(x)), x, "double")).collect()
    found = sum(r.n_links for r in out)
    assert 0.97 * want <= found <= want


def link_counts(x, threshold=0.9):
    x = unit(x.astype(float))
    return np.concatenate([(x[i : i + 500] @ x.T >= threshold).sum(1) - 1 for i in range(0, len(x), 500)])


def test_a_third_of_the_rows_in_one_dense_group(spark):
    """Near copies at cosine 0.91 on average, not byte-equal; and a wide group at 0.75."""
    rng = np.random.default_rng(2)

    def group(n, cos):
        c, noise = unit(rng.normal(size=(1, 64))), rng.normal(size=(n, 64))
        return np.sqrt(cos) * c + np.sqrt(1 - cos) * unit(noise - (noise @ c.T) * c)

    x = np.concatenate((group(10_000, 0.91), group(3_000, 0.75), unit(rng.normal(size=(17_000, 64))))).astype(np.float32)
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.array(list(x), pa.list_(pa.float32()))}))
    got = pivots.near_vectors(df).select("vec_id", "n_links").toArrow().sort_by("vec_id")["n_links"].to_numpy()
    want = link_counts(x)
    assert (got <= want).all()
    assert got[:10_000].sum() >= 0.995 * want[:10_000].sum()
    assert got.sum() >= 0.99 * want.sum()


def test_recall_does_not_fall_with_the_number_of_pivots(spark):
    rng = np.random.default_rng(3)
    a, noise = unit(rng.normal(size=(2000, 64))), rng.normal(size=(2000, 64))
    noise -= (noise * a).sum(1, keepdims=True) * a
    pairs = np.concatenate((a, 0.9001 * a + np.sqrt(1 - 0.9001**2) * unit(noise)))
    x = np.concatenate((pairs, unit(rng.normal(size=(16_000, 64))))).astype(np.float32)
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.array(list(x), pa.list_(pa.float32()))}))
    want = link_counts(x).sum()
    found = sum(r.n_links for r in pivots.near_vectors(df, pivots=1826).select("n_links").collect())
    assert 0.99 * want <= found <= want


def common_direction(rng, n, cos, pairs, d=64):
    """Vectors at mean cosine ``cos``, and ``pairs`` partners at cosine 0.9 to 0.95 of some of them."""
    e = rng.normal(size=(n, d))
    e[:, 0] = 0
    x = np.sqrt(1 - cos) * unit(e)
    x[:, 0] = np.sqrt(cos)
    noise = rng.normal(size=(pairs, d))
    noise -= (noise * x[:pairs]).sum(1, keepdims=True) * x[:pairs]
    near = rng.uniform(0.9002, 0.95, size=(pairs, 1))
    return np.concatenate((x, near * x[:pairs] + np.sqrt(1 - near**2) * unit(noise))).astype(np.float32)


@pytest.mark.parametrize("cos", [0.5, 0.7, 0.8])
def test_vectors_with_a_common_direction(spark, monkeypatch, cos):
    """Few pairs are compared and few links missed where all vectors lie on one side."""
    rng = np.random.default_rng(7)
    x = common_direction(rng, 18_000, cos, 2000)
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.array(list(x), pa.list_(pa.float32()))}))
    got = pivots.near_vectors(df).select("vec_id", "n_links").toArrow().sort_by("vec_id")["n_links"].to_numpy()
    want = link_counts(x)
    assert (got <= want).all() and got.sum() >= 0.97 * want.sum()

    # comparisons: pairs that share two pivots or a close list, each compared once
    index = pivots.calibrated(x[rng.permutation(len(x))[:2500]], len(x), 82, 1 << 16, 0.9)
    some = x[rng.permutation(len(x))[:3000]]
    near, row, pivot, covered = index.describe(some)
    holds = np.zeros((len(some), len(index.directions)), np.float32)
    np.put_along_axis(holds, near, 1, 1)
    holds[covered] = 0
    close = np.zeros((len(some), len(index.points)), np.float32)
    close[row, pivot] = 1
    compared = (holds @ holds.T >= 2) | (close @ close.T >= 1)
    np.fill_diagonal(compared, False)
    assert compared.mean() < (0.1 if cos < 0.8 else 0.2)


@pytest.mark.parametrize("count", [5774, 16_384])
def test_recall_with_many_pivots(count):
    """Partners exactly at the threshold, with as many pivots as 100 million and more vectors get."""
    rng = np.random.default_rng(8)
    sample = unit(rng.normal(size=(count + 1500, 64))).astype(np.float32)
    index = pivots.calibrated(sample, 100_000_000, count, count, 0.9)
    x = unit(rng.normal(size=(2000, 64)))
    noise = rng.normal(size=x.shape)
    noise -= (noise * x).sum(1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(1 - 0.81) * unit(noise)
    a, b = index.describe(x)[0], index.describe(y)[0]
    assert np.mean([len(set(p) & set(q)) >= 2 for p, q in zip(a.tolist(), b.tolist())]) >= 0.985


def test_doubles_of_any_size(spark):
    ship_code(spark)
    data = [(1, [1e200, 1e200]), (2, [2e200, 2e200]), (3, [1e-200, 1e-200]), (4, [5e-324, 5e-324]), (5, [1.7e308, 1.7e308]), (6, [-1e200, 1e200]), (7, [1e-300, -1e-300])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in pivots.near_vectors(df).collect()}
    assert got == {1: (4, 1), 2: (4, 1), 3: (4, 1), 4: (4, 1), 5: (4, 1), 6: (0, 6), 7: (0, 7)}


def test_unusual_vectors(spark):
    ship_code(spark)
    nan, inf = float("nan"), float("inf")
    data = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, nan]), (6, [1.0, 1.0]), (7, [1.0, 1.0])]
    data += [(7, [1.0, 1.0]), (8, [2.0, 2.0]), (None, [1.0, 1.0]), (9, [1.0, 2.0, 3.0]), (10, [-1.0, 1.0]), (11, [inf, 1.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in pivots.near_vectors(df).collect()), key=str)
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 9, 10, 11)]
    group = [(6, 2, 6, True), (7, 2, 6, False), (7, 2, 6, False), (8, 2, 6, False)]
    assert got == sorted([*alone, *group, (None, 0, None, True)], key=str)
    assert pivots.near_vectors(df.limit(0)).collect() == []
