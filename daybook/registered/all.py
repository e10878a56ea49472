"""Every registered query and its SQL."""

from __future__ import annotations

from daybook.registered import catalog, forecasting, incremental, metrics, quality, series, text

MODULES = (series, forecasting, text, metrics, quality, catalog, incremental)


def queries() -> dict:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
