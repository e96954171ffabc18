"""Registry of plans: name -> (callable(spark, sf_dir) -> DataFrame, oracle SQL).

The oracle SQL is an independent statement of the same result in plain SQL
over the same parquet tables; it is what the correctness gate compares with.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

_PLANS: dict[str, Plan] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Plan) -> Plan:
        if name in _PLANS:
            raise ValueError(f"duplicate plan {name}")
        _PLANS[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle.strip()
        return fn
    return deco


def queries() -> dict[str, Plan]:
    return dict(_PLANS)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
