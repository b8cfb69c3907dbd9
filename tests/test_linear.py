"""Linear models from Gram statistics against the definitions they minimise."""

import numpy as np
import pytest

from marketweave.operators import linear as LI


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.Generator(np.random.PCG64(7))
    x = rng.normal(size=(400, 4)) * [1, 10, 0.1, 1] + [0, 5, 100, 0]
    x[:, 3] = x[:, 0] * 0.9 + x[:, 3] * 0.3
    y = 0.3 * x[:, 0] - 0.02 * x[:, 1] + rng.normal(size=400) * 0.5 + 2
    rows = [(*map(float, r), 1.5, float(v)) for r, v in zip(x, y)] + [(None, 1.0, 1.0, 1.0, 1.0, 9.0)]
    return np.column_stack([x, np.full(400, 1.5)]), y, spark.createDataFrame(
        rows, "a double, b double, c double, d double, e double, label double")


COLS = ("a", "b", "c", "d", "e")  # e does not vary


def test_least_squares_equals_numpy(data):
    x, y, df = data
    m = LI.fit(LI.gram(df, COLS), COLS, "linear")
    want = np.linalg.lstsq(np.column_stack([np.ones(400), x[:, :4]]), y, rcond=None)[0]
    assert np.allclose([m.intercept, *m.coefficients[:4]], want, atol=1e-8) and m.coefficients[4] == 0
    got = [r["prediction"] for r in m.transform(df.na.drop()).collect()]
    assert np.allclose(got, want[0] + x[:, :4] @ want[1:], atol=1e-8)


@pytest.mark.parametrize("name", ["ridge", "lasso", "elastic_net"])
def test_penalised_models_are_optimal(data, name):
    """The subgradient of the objective holds zero at the solution."""
    x, y, df = data
    lam, alpha = LI.PENALTIES[name]
    b = LI.solve(LI.gram(df, COLS), lam, alpha)
    z = (x[:, :4] - x[:, :4].mean(0)) / x[:, :4].std(0)
    r = (y - y.mean()) / y.std() - z @ b[:4]
    slope = z.T @ r / 400 - lam * (1 - alpha) * b[:4]
    for s, v in zip(slope, b[:4]):
        assert abs(s - lam * alpha * np.sign(v)) < 1e-9 if v else abs(s) <= lam * alpha + 1e-12
    assert b[4] == 0


def test_models_without_spread(spark):
    """No rows, one row, repeated features: finite coefficients, the mean as prediction."""
    df = spark.createDataFrame([(1.0, 1.0, 5.0)], "a double, b double, label double")
    for rows, want in ((df, 5.0), (df.limit(0), 0.0)):
        g = LI.gram(rows, ("a", "b"))
        for name in LI.PENALTIES:
            m = LI.fit(g, ("a", "b"), name)
            assert (m.intercept, m.coefficients) == (want, (0.0, 0.0))
    twin = spark.createDataFrame([(float(i), float(i), 2.0 * i) for i in range(9)], df.schema)
    m = LI.fit(LI.gram(twin, ("a", "b")), ("a", "b"), "linear")
    assert m.coefficients == pytest.approx((1.0, 1.0))
