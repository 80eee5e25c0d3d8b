"""The filters as DuckDB SQL: recursion over rows for the low-pass, weighted lists for the smoothing."""

from __future__ import annotations

from ..functions import filters

# Interior weights of window 11, order 5, over 429.
INTERIOR = [18, -45, -10, 60, 120, 143, 120, 60, -10, -45, 18]


def low_pass_sql(source: str, out: str, cutoff: float = 6.0, rate: float = 29.97, order: int = 5) -> str:
    """CTEs that end in ``out(clip, row_idx, x)``, from a relation of the same columns."""
    b, a = filters.butterworth(order, cutoff, rate)
    zi = filters.steady_state(b, a)
    pad, n = 3 * (order + 1), order
    num = lambda v: f"CAST({float(v)!r} AS DOUBLE)"

    def scan(name: str, src: str) -> str:
        z = lambda k: f"z{k}" if k <= n else "0"
        state = ", ".join(f"{num(b[k])} * x - {num(a[k])} * y + {z(k + 1)} AS z{k}" for k in range(1, n + 1))
        begin = ", ".join(f"{num(zi[k - 1])} * x AS z{k}" for k in range(1, n + 1))
        go = ", ".join(f"f.z{k} AS z{k}" for k in range(1, n + 1))
        return f"""{name} AS (
            SELECT clip, i, y, {state} FROM (SELECT *, {num(b[0])} * x + z1 AS y FROM (SELECT clip, i, x, {begin} FROM {src} WHERE i = 0))
            UNION ALL
            SELECT clip, i, y, {state} FROM (SELECT *, {num(b[0])} * x + z1 AS y FROM (SELECT e.clip, e.i, e.x, {go} FROM {name} f JOIN {src} e ON e.clip = f.clip AND e.i = f.i + 1)))"""

    return f"""{out}_n AS (SELECT clip, count(*) AS n, arg_min(x, row_idx) AS x0, arg_max(x, row_idx) AS x1 FROM {source} GROUP BY clip),
        {out}_e AS (
            SELECT s.clip, {pad} - row_idx AS i, 2 * x0 - x AS x FROM {source} s JOIN {out}_n n ON s.clip = n.clip WHERE row_idx BETWEEN 1 AND {pad}
            UNION ALL SELECT clip, {pad} + row_idx, x FROM {source}
            UNION ALL SELECT s.clip, {pad} + n + (n - 2 - row_idx), 2 * x1 - x FROM {source} s JOIN {out}_n n ON s.clip = n.clip WHERE row_idx BETWEEN n - 1 - {pad} AND n - 2),
        {scan(out + "_f", out + "_e")},
        {out}_r AS (SELECT f.clip, n + {2 * pad} - 1 - i AS i, y AS x FROM {out}_f f JOIN {out}_n n ON f.clip = n.clip),
        {scan(out + "_g", out + "_r")},
        {out} AS (SELECT g.clip, n + {pad} - 1 - i AS row_idx, y AS x FROM {out}_g g JOIN {out}_n n ON g.clip = n.clip WHERE i BETWEEN {pad} AND n + {pad} - 1)"""


def savgol_sql(source: str, out: str, window: int = 11, order: int = 5) -> str:
    """CTEs that end in ``out(clip, row_idx, x)``."""
    fit = filters.polynomial_fit(window, order).tolist()
    if (window, order) == (11, 5):
        fit[5] = [w / 429 for w in INTERIOR]
    half = window // 2
    weights = "[" + ", ".join("[" + ", ".join(f"CAST({w!r} AS DOUBLE)" for w in row) + "]" for row in fit) + "]"
    return f"""{out}_l AS (SELECT clip, count(*) AS n, list(x ORDER BY row_idx) AS xs FROM {source} GROUP BY clip),
        {out} AS (
            SELECT clip, row_idx, CASE WHEN n <= {window} THEN x ELSE list_dot_product(xs[first + 1:first + {window}], ({weights})[place + 1]) END AS x
            FROM (SELECT s.clip, row_idx, x, n, xs,
                         CASE WHEN row_idx < {half} THEN 0 WHEN row_idx >= n - {half} THEN n - {window} ELSE row_idx - {half} END AS first,
                         CASE WHEN row_idx < {half} THEN row_idx WHEN row_idx >= n - {half} THEN {window} - (n - row_idx) ELSE {half} END AS place
                  FROM {source} s JOIN {out}_l l ON s.clip = l.clip))"""
