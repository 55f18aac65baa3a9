"""Registered queries, each with its column list and, where SQL can say it, its SQL."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ebbline.catalogue.shape import shape, shaped_sql
from ebbline.session import tune


@dataclass(frozen=True)
class Query:
    spec: str
    run: Callable[[SparkSession, str], DataFrame]
    ctes: str | None
    body: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return shape(self.run(tune(spark), sf_dir), self.spec)

    def sql(self) -> str | None:
        return None if self.body is None else shaped_sql(self.spec, self.ctes or "", self.body)


QUERIES: dict[str, Query] = {}


def query(name: str, spec: str, *, ctes: str | None = None, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = Query(" ".join(spec.split()), fn, ctes, sql)
        return fn

    return add
