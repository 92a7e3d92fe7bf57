"""All registered queries and the SQL each one must agree with."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SECTIONS = ("boxes", "relations", "tiling", "aggregates", "evaluation", "masks", "files", "similarity", "augmentation", "streams")

Query = Callable[[SparkSession, str], DataFrame]


def _sections():
    return [importlib.import_module(f"tessera.plans.{s}") for s in SECTIONS]


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for section in _sections():
        out.update(section.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for section in _sections():
        out.update(section.SQL)
    return out
