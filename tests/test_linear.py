import numpy as np
import pytest

from propensity.operators import forecast as T
from propensity.operators import linear as L


def data(spark, n=400):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 3)) @ np.array([[1, 0.5, 0], [0, 1, 0.2], [0, 0, 2]])
    y = 3 + x @ np.array([1.5, -2, 0.5]) + rng.normal(size=n) * 0.1
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, "id int, a double, b double, c double, y double")


def test_mahalanobis_matches_numpy(spark):
    x, _, df = data(spark)
    got = [r.outlier_score for r in L.mahalanobis(df, ["a", "b", "c"]).orderBy("id").collect()]
    z = x - x.mean(axis=0)
    want = np.einsum("ij,jk,ik->i", z, np.linalg.inv(np.cov(x.T)), z)
    assert np.allclose(got, want, atol=1e-9)
    flagged = L.flag_outliers(L.mahalanobis(df, ["a", "b", "c"]), "outlier_score")
    assert flagged.filter("is_suspicious = 1").count() == (want > np.quantile(want, 0.95)).sum()


def test_constant_and_repeated_columns_add_nothing(spark):
    _, _, df = data(spark)
    wide = df.selectExpr("id", "a", "b", "c", "1.0D AS k", "2 * a AS twice")
    a = L.mahalanobis(df, ["a", "b", "c"]).orderBy("id").collect()
    b = L.mahalanobis(wide, ["a", "k", "b", "twice", "c"]).orderBy("id").collect()
    assert np.allclose([r.outlier_score for r in a], [r.outlier_score for r in b], atol=1e-9)


def test_least_squares_matches_numpy(spark):
    x, y, df = data(spark)
    fit = L.least_squares(df, "y", ["a", "b", "c"])
    want = np.linalg.lstsq(np.c_[np.ones(len(x)), x], y, rcond=None)[0]
    assert np.allclose([fit.intercept, *fit.coefficients], want, atol=1e-9)
    pred = [r.prediction for r in fit.predict(df).orderBy("id").collect()]
    assert np.allclose(pred, np.c_[np.ones(len(x)), x] @ want)


def weekly(spark, n=260):
    """An AR(1) series and one with a season, as weekly rows."""
    rng = np.random.default_rng(9)
    ar, season = [100.0], []
    for t in range(n):
        ar.append(40 + 0.6 * ar[-1] + rng.normal() * 3)
        season.append(200 + 60 * np.sin(2 * np.pi * t / 52) + rng.normal())
    rows = [("ar", t, float(round(ar[t + 1]))) for t in range(n)] + [
        ("season", t, float(round(season[t]))) for t in range(n)]
    df = spark.createDataFrame(rows, "series string, t int, y double")
    return df.selectExpr("series", "date_add(date'2015-01-05', t * 7) AS week", "CAST(y AS bigint) AS y")


def test_order_search_and_forecast(spark):
    df = weekly(spark)
    orders = T.order_search(df)
    assert orders.groupBy("series").count().filter("count > 18").count() == 0
    assert orders.filter("is_best").count() == 2
    ar1 = orders.filter("series = 'ar' AND p = 1 AND d = 0 AND q = 0").first()
    assert ar1.phi1 == pytest.approx(0.6, abs=0.15)
    fc = T.forecast(df).collect()
    assert len(fc) == 24
    assert all(r.lower_95 <= r.forecast <= r.upper_95 for r in fc)
    widths = [r.upper_95 - r.lower_95 for r in sorted(fc, key=lambda r: r.step) if r.series == "ar"]
    assert widths[-1] >= widths[0]


def test_first_stage_matches_numpy(spark):
    df = weekly(spark).filter("series = 'ar'")
    y = np.array([r.y for r in df.orderBy("week").collect()], float)
    ar1 = T.order_search(df).filter("p = 1 AND d = 0 AND q = 0").first()
    # the two-stage fit uses weeks with all lags of the model frame
    start = 52 + 2
    t = np.arange(start, len(y))
    a = np.c_[np.ones(len(t)), y[t - 1], y[t - 52]]
    want = np.linalg.lstsq(a, y[t], rcond=None)[0]
    assert np.allclose([ar1.const, ar1.phi1, ar1.phi_season], want, atol=1e-6)


def test_missing_weeks_count_zero(spark):
    df = spark.createDataFrame([("s", "2024-01-01", 5), ("s", "2024-01-22", 7)], "series string, w string, y bigint")
    got = T.regular_weeks(df.selectExpr("series", "CAST(w AS date) AS week", "y")).orderBy("week").collect()
    assert [r.y for r in got] == [5.0, 0.0, 0.0, 7.0]


def test_psi_weights():
    coef = dict.fromkeys(T.COEFS, 0.0) | {"phi1": 0.5}
    assert np.allclose(T.spread(coef, 0, 3) ** 2, [1, 1.25, 1.3125])
    assert np.allclose(T.spread(dict.fromkeys(T.COEFS, 0.0), 1, 3) ** 2, [1, 2, 3])
