"""Densities by moments of cells against the sum over all values."""

import contextlib
import io
import math
import re

import numpy as np
import pytest

from lapsewise import operators as ops
from lapsewise.operators.distribution import _CELLS, _MOMENTS, _REACH, _hermite


def _direct(values, gridsize, cut):
    values = np.asarray(values, dtype=float)
    n, sd = len(values), values.std(ddof=1)
    bw = n**-0.2 * sd
    grid = np.linspace(values.min() - cut * bw, values.max() + cut * bw, gridsize)
    z = (grid[:, None] - values[None, :]) / bw
    return grid, np.exp(-z * z / 2).sum(axis=1) / (n * bw * math.sqrt(2 * math.pi)), 1 / (bw * math.sqrt(2 * math.pi))


@pytest.mark.parametrize("kind", ["gauss", "outlier", "two", "steps", "far"])
def test_error_is_below_the_bound(spark, kind):
    draw = np.random.default_rng(4)
    values = {
        "gauss": draw.normal(3, 2, 700),
        "outlier": np.r_[draw.normal(0, 1, 500), 1e4],
        "two": [1.0, 2.0],
        "steps": np.repeat([0.0, 1.0, 50.0], [300, 5, 2]),
        "far": 1.7e9 + draw.uniform(0, 10, 400),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    rows = sorted(ops.kde(df, "v", gridsize=150).collect(), key=lambda r: r["grid"])
    grid, want, peak = _direct(values, 150, 3.0)
    assert np.allclose([r["x"] for r in rows], grid, rtol=1e-12)
    assert np.abs(np.array([r["density"] for r in rows]) - want).max() < (1e-6 if kind == "far" else 1e-10) * peak  # far: the sum's own digits
    assert all(r["density"] >= 0 for r in rows)


def test_series_is_cut_where_the_docstring_says():
    left = sum(((_REACH + math.sqrt(k)) / (2 * _CELLS)) ** k / math.factorial(k) for k in range(_MOMENTS, 60))
    assert left < 2e-11 and 2 * _CELLS == 64
    assert _hermite(5) == [[1], [0, 1], [-1, 0, 1], [0, -3, 0, 1], [3, 0, -6, 0, 1]]


def test_rows_are_never_unfolded(spark):
    """Only cells and grids are: below the sums of moments there is no Generate."""
    df = spark.createDataFrame([("a", float(i)) for i in range(50)], "g string, v double")
    for curve in (ops.kde(df, "v"), ops.kde(df, "v", hue="g")):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            curve.explain("simple")
        text = out.getvalue()
        for line in text.split("\n"):
            if "Generate" in line:
                assert "cell" in line or "first" in line
                assert not re.search(r"\b(__v|__p|u1)#", line)
        assert "m11" in text and "cell" in text
