from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import whitening
from strandline.llm.whitening import Spectrum

SCHEMA = "vec_id bigint, embedding array<float>"


@pytest.mark.parametrize("size, n", [(1, 5), (2, 4), (6, 80), (24, 9), (24, 300)])
@pytest.mark.parametrize("parts", [1, 4])
def test_spectra_equal_the_scatter(size, n, parts):
    rng = np.random.default_rng(size * n)
    x = np.floor(64 * rng.normal(size=(n, size)) * np.linspace(0.01, 0.5, size))
    x[: n // 3] = x[0]
    x[:, -1] = x[:, 0]
    total = Spectrum.empty(size)
    for part in np.array_split(x, parts):
        own = Spectrum.empty(size)
        rows, times = np.unique(part, axis=0, return_counts=True)
        for row, k in zip(rows, times.tolist()):
            own.add(row, k)
        total.join(own)
    away = x - x.mean(axis=0)
    scatter = away.T @ away
    scale = max(1.0, np.abs(scatter).max())
    assert total.n == n and np.allclose(total.mean, x.mean(axis=0))
    assert np.allclose(total.basis.T @ total.basis, np.eye(size), atol=1e-12)
    built = total.basis @ np.diag(total.values) @ total.basis.T
    assert np.abs(built - scatter).max() < 1e-12 * scale
    assert np.abs(total.values - np.linalg.eigvalsh(scatter)).max() < 1e-12 * scale * size


def test_secular_roots_lie_between_the_poles():
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 40):
        d = np.sort(rng.random(n)) * 10.0 ** rng.integers(-3, 3)
        z = rng.normal(size=n) * 10.0 ** rng.integers(-6, 2, n)
        pole, x = whitening.secular_roots(d, z * z, 0.7)
        roots = d[pole] + x
        exact = np.linalg.eigvalsh(np.diag(d) + 0.7 * np.outer(z, z))
        assert np.abs(roots - exact).max() < 1e-12 * max(1.0, exact.max())
        assert (roots >= d).all() and (np.diff(roots) > 0).all()


def exact(x: np.ndarray, components: int) -> tuple:
    n = len(x)
    sums = [sum(int(v) for v in column) for column in x.T]
    deviation = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    values, vectors = np.linalg.eigh(np.cov((x - 1_000_000).T.astype(float), bias=True))
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    white = (x - np.array(sums) / n) @ vectors / np.sqrt(values)
    return deviation, white, values


def test_whitened_vectors(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(400, 12)) * np.linspace(0.1, 1, 12)).astype(np.float32)
    vectors[5:9] = vectors[4]
    data = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(3, vectors[3].tolist())] * 2
    broken = [
        (900, None), (901, []), (902, [1.0] * 11 + [None]), (903, [1.0] * 11 + [float("nan")]),
        (904, [1.0] * 11 + [float("inf")]), (905, [1.0] * 5), (None, None),
    ]
    df = spark.createDataFrame(data + broken, SCHEMA).withColumns({"n": F.lit("x"), "whitened": F.lit(1)})
    found = whitening.whitened(df.repartition(5), components=8).orderBy("vec_id").toPandas()
    used = sorted(data)
    x = np.floor(64 * np.array([v for _, v in used], np.float32).astype(float)).astype(int) + 1_000_000
    deviation, white, values = exact(x, 8)
    assert found.vec_id.tolist() == [i for i, _ in used]
    assert [int(v) for v in found.deviation] == deviation and set(found.n) == {len(used)}
    got = np.stack(found.whitened.to_list())
    got *= np.sign((got * white).sum(axis=0))
    assert np.abs(got - white).max() < 1e-9
    total = np.cov((x - 1_000_000).T.astype(float), bias=True).trace()
    assert np.allclose(np.stack(found.explained.to_list()), values / total, rtol=1e-9)
    assert found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-9


def test_few_or_equal_vectors(spark):
    none = spark.createDataFrame([(1, None), (2, [])], SCHEMA)
    assert whitening.whitened(none).count() == 0
    equal = spark.createDataFrame([(i, [0.5, 0.25]) for i in range(4)], SCHEMA)
    assert [(r.whitened, int(r.deviation)) for r in whitening.whitened(equal).collect()] == [([], 0)] * 4
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(4)], SCHEMA)
    found = [r.whitened for r in whitening.whitened(line).collect()]
    assert [len(w) for w in found] == [1] * 4 and abs(sum(w[0] ** 2 for w in found) / 4 - 1) < 1e-9


def test_deviations_beyond_a_long_stay_exact():
    x, n = np.array([[10**6, 3], [-(10**6), 5]]), 10**9
    steps = np.array([17, -4], object)
    expected = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, steps)) for row in x]
    assert whitening.deviations(x.astype(float), n, steps) == expected
