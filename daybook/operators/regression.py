"""Least squares with an intercept on three features, from streaming moments.

The means and covariances of (x1, x2, x3, y) are all a fit needs. As aggregates they
combine before the shuffle, and over an expanding window Spark extends them row by row,
so a walk-forward backtest is one pass instead of one fit per day.

Formulas are SQL text over the moment columns: n, m_<name> for means and c_<a>_<b> for
covariances, names in alphabetical order.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

FEATURES = ("x1", "x2", "x3")


def moments(y: str, x: tuple[str, str, str], over: WindowSpec | None = None) -> dict[str, Column]:
    """Count, means and covariances over the rows where the target and every feature are present."""
    present = " AND ".join(f"{c} IS NOT NULL" for c in (y, *x))
    value = {name: f"CASE WHEN {present} THEN {c} END" for name, c in zip((*FEATURES, "y"), (*x, y))}
    out = {"n": f"count({value['y']})"}
    out |= {f"m_{name}": f"avg({v})" for name, v in value.items()}
    out |= {
        f"c_{a}_{b}": f"covar_pop({value[a]}, {value[b]})"
        for a, b in combinations_with_replacement(value, 2) if (a, b) != ("y", "y")
    }
    return {k: F.expr(v) if over is None else F.expr(v).over(over) for k, v in out.items()}


_PAIRS = [(a, b) for a, b in combinations_with_replacement((*FEATURES, "y"), 2) if (a, b) != ("y", "y")]


def shifted_sums(y: str, x: tuple[str, str, str], shift: Column) -> dict[str, Column]:
    """What one row adds to count, sums and sums of products, the first feature and the target taken from ``shift``.

    Sums can be added in any grouping; near the middle of the values they keep their precision.
    """
    present = F.lit(True)
    for c in (y, *x):
        present = present & F.col(c).isNotNull()
    value = {name: F.when(present, F.col(c) - shift if name in ("x1", "y") else F.col(c)) for name, c in zip((*FEATURES, "y"), (*x, y))}
    return {"s_n": F.when(present, 1.0), **{f"s_{name}": v for name, v in value.items()},
            **{f"s_{a}_{b}": value[a] * value[b] for a, b in _PAIRS}}


def moments_of_sums(shift: Column) -> dict[str, Column]:
    """The moment columns from the columns of :func:`shifted_sums`, added up."""
    n = F.nullif("s_n", F.lit(0.0))
    out = {"n": F.col("s_n").cast("long")}
    out |= {f"m_{name}": F.col(f"s_{name}") / n + (shift if name in ("x1", "y") else F.lit(0.0)) for name in (*FEATURES, "y")}
    for a, b in _PAIRS:
        square, cross = F.col(f"s_{a}_{b}") / n, F.col(f"s_{a}") * F.col(f"s_{b}") / (n * n)
        noise = F.abs(square - cross) <= 1e-13 * F.abs(square)  # rounding of a constant away from the shift
        out[f"c_{a}_{b}"] = F.when(noise, 0.0).otherwise(square - cross)
    return out


def merged_moments(one: str, other: str) -> dict[str, Column]:
    """The moments of two sets of rows together, from the struct columns ``one`` and ``other``; either may be NULL or of no row."""
    n1, n2 = (F.coalesce(F.col(f"{side}.n"), F.lit(0)) for side in (one, other))
    n = n1 + n2

    def both(name: str, joint: Column) -> Column:
        return F.when(n1 == 0, F.col(f"{other}.{name}")).when(n2 == 0, F.col(f"{one}.{name}")).otherwise(joint)

    gap = {name: F.col(f"{other}.m_{name}") - F.col(f"{one}.m_{name}") for name in (*FEATURES, "y")}
    out = {"n": n.cast("long")}
    out |= {f"m_{name}": both(f"m_{name}", F.col(f"{one}.m_{name}") + gap[name] * n2 / n) for name in (*FEATURES, "y")}
    out |= {
        f"c_{a}_{b}": both(f"c_{a}_{b}", (
            F.col(f"{one}.c_{a}_{b}") * n1 + F.col(f"{other}.c_{a}_{b}") * n2 + gap[a] * gap[b] * n1 * n2 / n) / n)
        for a, b in _PAIRS
    }
    return out


def _cov(a: str, b: str) -> str:
    return f"c_{min(a, b)}_{max(a, b)}"


def _det3(m: list[list[str]]) -> str:
    (a, b, c), (d, e, f), (g, h, i) = m
    return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"


def coefficients() -> dict[str, Column]:
    """The slopes b1, b2, b3 from the moment columns.

    A lag that never varies carries no information and gets slope 0, as in a least-norm
    fit; any other singular system gives NULL.
    """
    gram = [[_cov(a, b) for b in FEATURES] for a in FEATURES]
    target = [_cov(a, "y") for a in FEATURES]
    (v1, _, _), (_, v2, c23), (_, _, v3) = gram

    det = _det3(gram)
    solvable = f"abs({det}) > 1e-10 * {v1} * {v2} * {v3}"
    whole = []
    for k in range(3):
        swapped = [[target[i] if j == k else gram[i][j] for j in range(3)] for i in range(3)]
        whole.append(f"try_divide({_det3(swapped)}, {det})")

    det2 = f"({v2} * {v3} - {c23} * {c23})"
    season_only = [
        "0D",
        f"try_divide({target[1]} * {v3} - {target[2]} * {c23}, {det2})",
        f"try_divide({target[2]} * {v2} - {target[1]} * {c23}, {det2})",
    ]
    # A variance this far below the squared mean is rounding noise of a constant.
    constant_lag = f"{v1} <= 1e-20 * m_x1 * m_x1"
    return {
        f"b{k + 1}": F.expr(f"CASE WHEN {constant_lag} THEN {season_only[k]} WHEN {solvable} THEN {whole[k]} END")
        for k in range(3)
    }


def intercept() -> Column:
    return F.expr("m_y - b1 * m_x1 - b2 * m_x2 - b3 * m_x3")


def predicted(x: tuple[Column, Column, Column]) -> Column:
    """Written around the means, which keeps the rounding error small on short windows."""
    out = F.col("m_y")
    for k, (name, value) in enumerate(zip(FEATURES, x), start=1):
        out = out + F.col(f"b{k}") * (value - F.col(f"m_{name}"))
    return out
