"""The filters against their definitions."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pytest

from sigloom.functions import filters
from sigloom.operators import series
from sigloom.plans.filter_sql import INTERIOR

# Published coefficients for order 5, 6 Hz at 29.97 Hz.
B = [0.022026587234743968, 0.11013293617371983, 0.22026587234743966, 0.22026587234743966, 0.11013293617371983, 0.022026587234743968]
A = [1, -0.9813727160575116, 0.9711165331207199, -0.38438479055466335, 0.11068923695446098, -0.011197471951199137]
ZI = [0.9779734127652562, -0.11353223946597543, 0.6373184213073049, 0.03266775840520194, 0.03322405918594311]


def test_butterworth():
    b, a = filters.butterworth(5, 6.0, 29.97)
    assert np.allclose(b, B, atol=1e-12) and np.allclose(a, A, atol=1e-12)
    assert np.allclose(filters.steady_state(b, a), ZI, atol=1e-12)
    gain = lambda hz: abs(np.polyval(b, np.exp(2j * np.pi * hz / 29.97)) / np.polyval(a, np.exp(2j * np.pi * hz / 29.97)))
    assert gain(0) == pytest.approx(1) and gain(6.0) == pytest.approx(2**-0.5)
    assert abs(gain(7.0) - 2**-0.5) > 0.1


def plain_zero_phase(x, b=np.array(B), a=np.array(A), zi=np.array(ZI)):
    """Row by row, one channel at a time, from the definition."""

    def run(series):
        z, out = [*(zi * series[0]), 0.0], []
        for v in series:
            y = b[0] * v + z[0]
            z = [b[k + 1] * v + z[k + 1] - a[k + 1] * y for k in range(5)] + [0.0]
            out.append(y)
        return np.array(out)

    columns = []
    for c in np.asarray(x, float).T:
        wide = np.concatenate([2 * c[0] - c[18:0:-1], c, 2 * c[-1] - c[-2:-20:-1]])
        columns.append(run(run(wide)[::-1])[::-1][18:-18])
    return np.array(columns).T


@pytest.mark.parametrize("n", [19, 28, 29, 40, 92, 150, 2100])
def test_blocks_are_the_recursion(n):
    x = np.random.default_rng(n).normal(size=(n, 3))
    want = plain_zero_phase(x)
    assert np.allclose(series.low_pass()(x), want, atol=1e-10)
    assert not np.allclose(series.low_pass(cutoff=5.0)(x), want, atol=1e-3)
    assert np.allclose(series.low_pass()(np.full((n, 1), 3.5)), 3.5)


def test_many_lengths_and_long_series_hold_little():
    rng = np.random.default_rng(3)
    tracemalloc.start()
    for n in range(19, 319):
        series.chain(series.low_pass(), series.savgol())(rng.normal(size=(n, 2)))
    assert tracemalloc.get_traced_memory()[0] < 2 << 20
    x = rng.normal(size=(10_000, 4))
    tracemalloc.reset_peak()
    y = series.low_pass()(x)
    assert tracemalloc.get_traced_memory()[1] < 16 * x.nbytes
    tracemalloc.stop()
    assert np.allclose(y[:, :1], plain_zero_phase(x[:, :1]), atol=1e-10)


def test_too_short_and_nan():
    with pytest.raises(ValueError):
        filters.zero_phase(np.zeros((18, 1)), 5, 6.0, 29.97)
    assert filters.zero_phase(np.zeros((19, 1)), 5, 6.0, 29.97).shape == (19, 1)
    x = np.ones((50, 2))
    x[7, 0] = np.nan
    y = series.low_pass()(x)
    assert np.isnan(y[:, 0]).all() and not np.isnan(y[:, 1]).any()


def test_savgol():
    assert np.allclose(filters.polynomial_fit(11, 5)[5] * 429, INTERIOR)
    t = np.linspace(-1, 1, 37)[:, None]
    poly = 1 - 2 * t + 3 * t**2 + t**3 - t**4 + 0.5 * t**5
    assert np.allclose(series.savgol()(poly), poly)
    assert not np.allclose(series.savgol()(poly + t**6), poly + t**6, atol=1e-6)
    x = np.random.default_rng(1).normal(size=(30, 3))
    assert np.allclose(series.savgol()(x[::-1]), series.savgol()(x)[::-1])
    edge = [np.polyval(np.polyfit(np.arange(11), x[:11, 0], 5), i) for i in range(5)]
    assert np.allclose(series.savgol()(x)[:5, 0], edge, atol=1e-8)
    short = x[:11]
    assert (series.savgol()(short) == short).all() and not np.allclose(series.savgol()(x[:12]), x[:12])
