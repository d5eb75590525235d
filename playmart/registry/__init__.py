"""Registered queries: a key, a Spark callable and, where SQL can say it, an oracle."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from playmart.registry.views import VIEWS


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    #: Columns whose values stand in the same sequence in both results; ties may come in any order.
    order: tuple[str, ...] = ()


def oracle(body: str) -> str:
    """Prefix a query with the shared views it names, directly or through other views."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, definition in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(definition)

    visit(body)
    if not needed:
        return body
    views = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in needed)
    return f"WITH {views}\n{body}"


class Registry(dict):
    """key -> Query, filled by decorated functions of (spark, sf_dir)."""

    def query(self, key: str, sql: str | None = None, order: tuple[str, ...] = ()):
        def add(run):
            if key in self:
                raise ValueError(f"duplicate query {key}")
            self[key] = Query(run, oracle(sql) if sql else None, order)
            return run

        return add
