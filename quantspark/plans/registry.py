"""All registered queries and their DuckDB oracles, merged from the plan modules."""

from __future__ import annotations

import importlib

MODULES = ("crypto", "insider", "signals", "panel", "zip", "lending", "evaluation", "models", "streaming", "pairs", "portfolio", "reports", "files", "strategies", "geo", "selection", "lookups", "sampling", "extras", "factors", "clusters", "latest", "homevalues", "scoring", "forecasts")


def _collect(attr: str) -> dict:
    out: dict = {}
    for m in MODULES:
        mod = importlib.import_module(f"quantspark.plans.{m}")
        for k, v in getattr(mod, attr).items():
            if k in out:
                raise KeyError(f"duplicate query id {k}")
            out[k] = v
    return out


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict:
    return _collect("ORACLE")
