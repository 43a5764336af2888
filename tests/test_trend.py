import numpy as np
import pytest

from rinkflow.functions import local_lines
from rinkflow.operators import quantiles, trend


def plain_lowess(x, y, frac, iters):
    """The definition, point by point."""
    k = max(2, int(frac * len(x)))
    robust = np.ones(len(x))
    at = np.unique(x)
    fit = None
    for _ in range(iters + 1):
        new = []
        for j, x0 in enumerate(at):
            d = np.abs(x - x0)
            h = np.sort(d)[k - 1]
            u = np.minimum(d / h, 1) if h > 0 else (d != 0).astype(float)
            w = (1 - u**3) ** 3 * robust
            t = x - x0
            sw, st, stt, sy, sty = (np.sum(v) for v in (w, w * t, w * t * t, w * y, w * t * y))
            spread = sw * stt - st * st
            if sw <= 1e-8 * np.sum(robust[d < h]):
                new.append(fit[j])
            elif spread > 1e-6 * (sw * h) ** 2:
                new.append((stt * sy - st * sty) / spread)
            else:
                new.append(sy / sw)
        fit = np.array(new)
        r = np.abs(y - fit[np.searchsorted(at, x)])
        s = 6 * np.median(r)
        u = np.minimum(r / s, 1) if s > 0 else (r != 0).astype(float)
        robust = (1 - u**2) ** 2
    return dict(zip(at, fit))


@pytest.mark.parametrize("frac,iters", [(2 / 3, 3), (0.2, 1)])
def test_against_definition(spark, frac, iters):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(-7, 1.5, 400), 1)
    y = np.sin(x) * 5 + rng.normal(0, 1, 400)
    y[:8] += 60
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "x double, y double")
    got = {r.x: r.trend for r in trend.lowess_trend(df, "x", "y", frac, iters).collect()}
    expected = plain_lowess(x, y, frac, iters)
    assert sorted(got) == sorted(expected)
    assert [got[k] for k in sorted(got)] == pytest.approx([expected[k] for k in sorted(expected)], rel=1e-6)


def test_flat_and_empty(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0), (None, 9.0)], "x double, y double")
    assert [tuple(r) for r in trend.lowess_trend(df, "x", "y").collect()] == [(1.0, 3.0)]
    assert trend.lowess_trend(df.where("x > 5"), "x", "y").count() == 0


@pytest.mark.parametrize("shape,frac,iters,block_rows", [
    ("even", 2 / 3, 1, 40), ("clumps", 2 / 3, 3, 40), ("far", 2 / 3, 1, 40), ("ties", 0.5, 1, 30),
    ("clumps", 0.1, 2, 7), ("even", 0.01, 1, 50), ("far", 0.01, 1, 50), ("ties", 1.0, 1, 1000),
])
def test_many_distinct_x_in_blocks(spark, shape, frac, iters, block_rows):
    """Windows over many blocks, within one, and moving fast over some and slowly over others."""
    rng = np.random.default_rng(4)
    n = 700
    x = {
        "even": rng.uniform(-3, 3, n),
        "clumps": np.concatenate([rng.normal(c, s, n // 4) for c, s in ((0, 1e-3), (0, 1), (50, 2), (51, 1e-2))]),
        "far": np.concatenate([rng.normal(0, 1, n - 4), [1e6, -1e5, 3e5, 3e5]]),
        "ties": np.concatenate([np.repeat(rng.normal(0, 1, 4), 100), np.round(rng.normal(0, 1, n - 400), 2)]),
    }[shape]
    y = np.sin(x) * 5 + 100 + rng.normal(0, 1, n)
    y[:9] += 60
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "x double, y double").repartition(5)
    got = {r.x: r.trend for r in trend.lowess_trend(df, "x", "y", frac, iters, block_rows).collect()}
    expected = plain_lowess(x, y, frac, iters)
    assert sorted(got) == sorted(expected)
    assert [got[k] for k in sorted(got)] == pytest.approx([expected[k] for k in sorted(expected)], rel=1e-7)


def test_a_straight_line_stays_and_odd_values_do_not_count(spark):
    df = spark.range(3000).selectExpr("id / 7D AS x", "2 * (id / 7D) + 1 AS y")
    odd = spark.createDataFrame([(float("inf"), 1.0), (2.0, float("nan")), (1.0, None)], "x double, y double")
    got = trend.lowess_trend(df.union(odd), "x", "y", block_rows=256).collect()
    assert len(got) == 3000
    assert [r.trend for r in got] == pytest.approx([2 * r.x + 1 for r in got])


def test_pairs_of_blocks_stay_few(spark):
    """At most two for each block, however fast the windows move."""
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1e-6, 2000), np.linspace(-9, 9, 2000)])
    points = spark.createDataFrame([(float(v),) for v in x], "x double")
    index = trend._Index(points, 100)
    requests = trend._window_parts(index, trend._widths(index, 2600))
    blocks = len(index.first)
    assert blocks == 40
    assert trend._pairs(requests).count() <= blocks + 2 * 2 * blocks
    assert requests.count() <= 3 * index.distinct


def test_the_points_are_written_once_in_a_round(spark, monkeypatch):
    """Their residuals are read from where they met their trend, and no table of trends is joined to the next."""
    written = []
    store = trend.materialize

    def counted(df, *more):
        written.append(df.columns)
        return store(df, *more)

    monkeypatch.setattr(trend, "materialize", counted)
    monkeypatch.setattr(quantiles, "materialize", counted)
    df = spark.range(60).selectExpr("id / 7D AS x", "double(id % 5) AS y")
    assert trend.lowess_trend(df, "x", "y", iters=1).count() == 60
    assert [c for c in written if "_v" in c] == []
    assert len([c for c in written if "trend" in c and "r" not in c]) == 2


@pytest.mark.parametrize("side", [-1, 1])
def test_sums_of_nodes_are_those_of_their_rows(side):
    rng = np.random.default_rng(3)
    x, w, y = np.sort(rng.uniform(0, 4, 5000)), rng.uniform(0, 1, 5000), rng.normal(0, 9, 5000)
    tree = local_lines.Tree(local_lines.Nodes.of_rows(x, w, w * y))
    n = local_lines.WINDOWS + 5
    first, last = np.sort(rng.integers(0, 5001, (2, n)), axis=0)
    x0, h = np.full(n, 4.1 if side < 0 else -0.1), rng.uniform(4.2, 9, n)
    got = tree.sums(first, last, x0, h, side)
    for i in range(0, n, 97):
        rows = slice(first[i], last[i])
        u = (x[rows] - x0[i]) / h[i]
        t = w[rows] * (1 - np.abs(u) ** 3) ** 3
        expected = [t.sum(), (t * u).sum(), (t * u * u).sum(), (t * y[rows]).sum(), (t * u * y[rows]).sum(), w[rows].sum()]
        assert got[:, i] == pytest.approx(expected, rel=1e-9, abs=1e-9)
