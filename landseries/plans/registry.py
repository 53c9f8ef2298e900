"""Registered queries and their SQL twins."""

from __future__ import annotations

import re
from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from landseries.sources.views import SQL, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: str = ""):
    """Register a function of Tables under a name; sql: the oracle's SELECT, ctes: what it needs before."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            seen = f"{sql} {ctes}"
            for v in reversed(SQL):  # a view reads views before it
                seen += f" {SQL[v]}" if re.search(rf"\b{v}\b", seen) else ""
            used = [f"{v} AS ({text})" for v, text in SQL.items() if re.search(rf"\b{v}\b", seen)]
            parts = [*used, ctes] if ctes else used
            ORACLES[name] = (f"WITH RECURSIVE {', '.join(parts)} " if parts else "") + sql
        return f

    return add


for part in ("series", "tables", "classes", "samples", "patches", "shapes", "learning", "blocks", "spans", "superpixels", "features", "assembly", "regularisation"):
    import_module(f"landseries.plans.{part}")
