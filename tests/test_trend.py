import numpy as np
import pytest

from padron.operators.trend import CELL, MARGIN, loess, loess_curve


def _brute(x, y, span):
    """Weighted least squares at every point, by numpy."""
    out = []
    k = max(int(np.floor(len(x) * span + 1e-5)), 1)
    for x0 in x:
        d = np.abs(x - x0)
        h = np.sort(d)[k - 1]
        w = np.where(d < h, (1 - (d / h) ** 3) ** 3, 0.0)
        if (d < h).sum() < 3:
            out.append(None)
            continue
        a = np.vander((x - x0) / h, 3, increasing=True)
        sw = np.sqrt(w)
        out.append(np.linalg.lstsq(a * sw[:, None], y * sw, rcond=None)[0][0])
    return out


@pytest.mark.parametrize("span", [0.75, 0.3])
def test_loess_matches_least_squares(spark, span):
    rng = np.random.default_rng(7)
    rows, expected = [], {}
    for g, n in (("a", 40), ("b", 13)):
        x = np.cumsum(rng.integers(28, 32, n)).astype(float)
        y = np.sin(x / 90) + rng.normal(0, 0.2, n)
        rows += [(g, float(a), float(b)) for a, b in zip(x, y)]
        expected |= {(g, a): f for a, f in zip(x, _brute(x, y, span))}
    df = spark.createDataFrame(rows + [("a", 1e6, None)], "g string, x double, y double")
    got = {(r.g, r.x): r.tendencia for r in loess(df, "g", "x", "y", span=span).collect()}
    assert got.keys() == expected.keys()
    for key, value in expected.items():
        assert got[key] == (None if value is None else pytest.approx(value, abs=1e-8))


def test_short_series_has_no_trend(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 3.0)], "g string, x double, y double")
    assert [r.tendencia for r in loess(df, "g", "x", "y").collect()] == [None, None]


def test_long_series_is_an_error(spark):
    from padron.operators import trend
    df = spark.range(trend.MAX_POINTS + 1).selectExpr("'a' AS k", "id AS x", "1.0D AS y")
    with pytest.raises(Exception, match="more than 5000 points in series a"):
        trend.loess(df, "k", "x", "y").collect()


def _vertex_fit(x, y, v, span):
    k = max(int(np.floor(len(x) * span + 1e-5)), 1)
    d = np.abs(x - v)
    h = np.sort(d)[k - 1]
    w = np.sqrt(np.where(d < h, (1 - np.minimum(d / h, 1) ** 3) ** 3, 0.0))
    a = np.vander(x - v, 3, increasing=True)
    return np.linalg.lstsq(a * w[:, None], y * w, rcond=None)[0][:2]


def _brute_curve(x, y, at, span):
    """Recursive halving, least squares at the edges, and the cubic by solving for it."""
    most = max(int(np.floor(len(x) * span * CELL)), 1)

    def cuts(part):
        if len(part) <= most:
            return []
        m = (len(part) + 1) // 2
        return [*cuts(part[:m]), (part[m - 1] + part[m]) / 2, *cuts(part[m:])]

    wider = MARGIN * max(x[-1] - x[0], max(abs(x[0]), abs(x[-1])) * 1e-3)
    vertices = [x[0] - wider, *cuts(x), x[-1] + wider]
    fits = [_vertex_fit(x, y, v, span) for v in vertices]
    out = []
    for p in at:
        i = np.searchsorted(vertices, p, "right") - 1
        (f, d), (g, e), b = fits[i], fits[i + 1], vertices[i + 1] - vertices[i]
        cubic = np.linalg.solve([[1, 0, 0, 0], [0, 1, 0, 0], [1, b, b * b, b ** 3],
                                 [0, 1, 2 * b, 3 * b * b]], [f, d, g, e])
        out.append(np.polyval(cubic[::-1], p - vertices[i]))
    return out


@pytest.mark.parametrize("span", [0.75, 0.4])
def test_curve_blends_between_vertices(spark, span):
    rng = np.random.default_rng(3)
    rows, expected = [], {}
    for g, n in (("a", 300), ("b", 41), ("c", 18)):
        x = np.cumsum(rng.integers(28, 32, n)).astype(float)
        y = np.sin(x / 400) + rng.normal(0, 0.2, n)
        rows += [(g, float(a), float(b)) for a, b in zip(x, y)]
        grid = x[0] + np.arange(80) * ((x[-1] - x[0]) / 79)
        expected[g] = _brute_curve(x, y, grid, span)
    df = spark.createDataFrame([*rows, ("a", 1e6, None)], "g string, x double, y double")
    got = loess_curve(df, "g", "x", "y", span=span).orderBy("g", "x").collect()
    for g, values in expected.items():
        assert [r.tendencia for r in got if r.g == g] == pytest.approx(values, abs=1e-7)
    assert loess_curve(df, "g", "x", "y", span=span, points=None).count() == 359


def test_curve_of_a_parabola_is_the_parabola(spark):
    df = spark.range(50).selectExpr("'a' AS g", "30.0D * id AS x",
                                    "CAST(id * id - 7 * id AS DOUBLE) AS y")
    rows = loess_curve(df, "g", "x", "y", points=33).collect()
    assert [r.tendencia for r in rows] == pytest.approx(
        [(r.x / 30) ** 2 - 7 * r.x / 30 for r in rows], abs=1e-6)


def test_curve_of_short_and_long_series(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, 2.0), ("b", 2.0, 3.0)],
                               "g string, x double, y double")
    rows = loess_curve(df, "g", "x", "y", points=3).collect()
    assert len(rows) == 6 and {r.tendencia for r in rows} == {None}
    long = spark.range(6_000).selectExpr("'a' AS g", "CAST(id AS DOUBLE) AS x", "2.0D * id AS y")
    ends = [r.tendencia for r in loess_curve(long, "g", "x", "y", points=2).orderBy("x").collect()]
    assert ends == pytest.approx([0, 11_998], abs=1e-4)
