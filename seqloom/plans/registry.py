"""All registered queries: name -> callable, and name -> SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seqloom.plans.fixtures import FIXTURES, frame, with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, *fixtures: str, sql: str | None = None, recursive: bool = False):
    """Register a function of the named fixtures' DataFrames, with the SQL that it is held against.

    ``sql`` may start with further common table expressions (``name AS (...), ... SELECT``), which
    join the WITH clause of the fixtures; ``recursive`` lets them refer to themselves.
    """

    def register(f):
        QUERIES[name] = lambda spark, sf_dir: f(*[frame(spark, sf_dir, n) for n in fixtures])
        if sql is not None:
            body, shared = sql.strip(), [n for n in fixtures if n in FIXTURES]
            parts = [with_fixtures(*shared)] if shared else []
            if not body.upper().startswith("SELECT"):
                body = f"{', ' if shared else 'WITH '}{body}"
            text = "\n".join([*parts, body])
            ORACLES[name] = text.replace("WITH ", "WITH RECURSIVE ", 1) if recursive else text
        return f

    return register


def load() -> None:
    """Import every module of queries, which registers them."""
    import importlib

    for name in ("reads", "keys", "align", "intervals", "qc", "sampling", "norm", "io"):
        importlib.import_module(f"seqloom.plans.{name}")
