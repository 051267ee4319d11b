"""Registry filled by the family modules."""

from __future__ import annotations

import importlib
import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.session import tune
from roadpulse.suite.views import CTES

FAMILIES: tuple[str, ...] = (
    "indices", "aggregates", "steps", "windows", "shapes", "partitions", "cleaning", "joins", "reshaping", "storage", "increments",
)

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_oracles: dict[str, str] = {}


def statement(views: str, body: str) -> str:
    """``body`` after the common table expressions it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for need in CTES[name][0].split():
            visit(need)
        order.append(name)

    for name in views.split():
        visit(name)
    body = textwrap.dedent(body).strip()
    heads = [f"{name} AS ({CTES[name][1].strip()})" for name in order]
    if not heads:
        return body
    for opening in ("with recursive ", "with "):
        if body.lower().startswith(opening):
            return opening.upper() + ",\n".join(heads) + ",\n" + body[len(opening) :]
    return "WITH " + ",\n".join(heads) + "\n" + body


def query(name: str, views: str = "", sql: str | None = None):
    """Register a query; ``sql`` is its oracle, ``views`` the named expressions it uses."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        if name in _queries:
            raise ValueError(f"query {name} is registered twice")
        _queries[name] = lambda spark, sf_dir: fn(tune(spark), sf_dir)
        if sql is not None:
            _oracles[name] = statement(views, sql)
        return fn

    return add


def load() -> None:
    for family in FAMILIES:
        importlib.import_module(f"roadpulse.suite.{family}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load()
    return dict(_queries)


def oracles() -> dict[str, str]:
    load()
    return dict(_oracles)


def rounded(df: DataFrame, digits: int = 6, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Double columns rounded, so that the order of summation does not show."""
    names = [c for c, t in df.dtypes if t == "double" and (columns is None or c in columns)]
    return df.withColumns({c: F.round(c, digits) for c in names}) if names else df


def texts(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text."""
    out = {}
    for c, t in df.dtypes:
        if t == "date":
            out[c] = F.date_format(c, "yyyy-MM-dd")
        elif t in ("timestamp", "timestamp_ntz"):
            out[c] = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(out) if out else df
