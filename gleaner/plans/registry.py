"""Registry of named plans: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL.

A plan module declares a query with ``@plan("name", oracle=SQL)``.  The SQL
is the same question asked of DuckDB over the same parquet tables (used by
the driver's correctness gate); ``oracle=None`` marks plans whose semantics
SQL cannot state (fuzzy kernels, streaming), which are checked against brute
force on fixtures in ``tests/`` instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

PlanFn = Callable[[SparkSession, str], DataFrame]

_PLANS: dict[str, PlanFn] = {}
_ORACLES: dict[str, str] = {}


def plan(name: str, oracle: str | None):
    def register(fn: PlanFn) -> PlanFn:
        if name in _PLANS:
            raise ValueError(f"plan {name!r} registered twice")
        _PLANS[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle.strip()
        return fn
    return register


def plans() -> dict[str, PlanFn]:
    _load_all()
    return dict(_PLANS)


def oracles() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)


def _load_all() -> None:
    # Import for the registration side effect.
    from gleaner.plans import (  # noqa: F401
        pages_plans,
        text_plans,
        record_plans,
        xml_plans,
        match_plans,
        crawl_plans,
        collect_plans,
        results_plans,
        stream_plans,
    )
