"""Digital filters on frames x channels matrices, in blocks of fixed size whatever the length."""

from __future__ import annotations

import functools

import numpy as np


def analog_poles(order: int, cutoff: float, rate: float) -> np.ndarray:
    """The low-pass poles with the cutoff prewarped; ``(4 + p) / (4 - p)`` are those of the digital filter."""
    warped = 4.0 * np.tan(np.pi * cutoff / rate)
    return warped * np.exp(1j * np.pi * (2 * np.arange(order) + order + 1) / (2 * order))


def butterworth(order: int, cutoff: float, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Low-pass coefficients (b, a) by the bilinear transform."""
    poles = analog_poles(order, cutoff, rate)
    warped = abs(poles[0])
    zeros_gain = np.real(warped**order / np.prod(4.0 - poles))
    a = np.real(np.poly((4.0 + poles) / (4.0 - poles)))
    return zeros_gain * np.poly(-np.ones(order)), a


def steady_state(b: np.ndarray, a: np.ndarray) -> np.ndarray:
    """The filter's inner state after a constant input of one."""
    n = len(a) - 1
    step = np.zeros((n, n))
    step[:, 0] = -a[1:]
    step[:-1, 1:] += np.eye(n - 1)
    return np.linalg.solve(np.eye(n) - step, b[1:] - a[1:] * b[0])


_BLOCK = 64


@functools.lru_cache(maxsize=16)
def block_filter(order: int, cutoff: float, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """What ``_BLOCK`` rows of the transposed direct form do, as two matrices of fixed size.

    Both act on the inner state followed by the block's rows: the first gives the rows that come
    out, the second's row k the inner state after k rows. The recursion runs once, on unit vectors.
    """
    b, a = butterworth(order, cutoff, rate)
    unit = np.eye(order + _BLOCK)
    z = np.vstack([unit[:order], np.zeros((1, len(unit)))])
    out, states = np.empty((_BLOCK, len(unit))), np.empty((_BLOCK + 1, order, len(unit)))
    states[0] = z[:-1]
    for i, row in enumerate(unit[order:]):
        out[i] = b[0] * row + z[0]
        z[:-1] = b[1:, None] * row + z[1:] - a[1:, None] * out[i]
        states[i + 1] = z[:-1]
    return out, states


def run_filter(x: np.ndarray, state: np.ndarray, order: int, cutoff: float, rate: float) -> np.ndarray:
    """The low-pass over the rows of ``x``, block by block; columns are series of their own."""
    rows, states = block_filter(order, cutoff, rate)
    out = np.empty_like(x)
    for i in range(0, len(x), _BLOCK):
        both = np.vstack([state, x[i : i + _BLOCK]])
        n = len(both) - order
        out[i : i + n] = rows[:n, : order + n] @ both
        state = states[n][:, : order + n] @ both
    return out


def zero_phase(x: np.ndarray, order: int, cutoff: float, rate: float) -> np.ndarray:
    """Forward and backward over the rows of ``x``, each end prolonged by its odd reflection."""
    b, a = butterworth(order, cutoff, rate)
    zi = steady_state(b, a)[:, None]
    pad = 3 * (order + 1)
    if len(x) <= pad:
        raise ValueError(f"a series needs more than {pad} rows")
    wide = np.vstack([2 * x[0] - x[pad:0:-1], x, 2 * x[-1] - x[-2 : -pad - 2 : -1]])
    forth = run_filter(wide, zi * wide[0], order, cutoff, rate)
    back = run_filter(forth[::-1], zi * forth[-1], order, cutoff, rate)[::-1]
    return back[pad:-pad]


@functools.lru_cache(maxsize=16)
def polynomial_fit(window: int, order: int) -> np.ndarray:
    """Row i: the weights that give the fitted polynomial's value at the window's place i."""
    half = window // 2
    v = np.vander(np.arange(-half, half + 1, dtype=float) / half, order + 1, increasing=True)
    return v @ np.linalg.pinv(v)


def smooth(x: np.ndarray, window: int, order: int) -> np.ndarray:
    """Savitzky-Golay over the rows; the ends take the values of the outermost windows' polynomials."""
    n, half = len(x), window // 2
    if n <= window:
        return x
    fit = polynomial_fit(window, order)
    out = np.empty_like(x)
    rows = np.lib.stride_tricks.sliding_window_view(x, window, axis=0)
    out[half : n - half] = rows @ fit[half]
    out[:half] = fit[:half] @ x[:window]
    out[n - half :] = fit[half + 1 :] @ x[-window:]
    return out
