"""Registered queries: one Spark callable and (where SQL can say it) one
DuckDB oracle per operator of the inventory.  Every query reads the whole
driver tables (or layers derived from them) at the given ``sf_dir``."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from . import queries_attr, queries_change, queries_more, queries_shapes, queries_spatial, queries_traj  # noqa: F401
