"""Model registry: each model is a plain function ``fn(build) -> DataFrame``.

``Build.ref(name)`` returns another model's DataFrame (computed lazily and
memoised, or read back from a published table); ``Build.source(name)`` returns
a source table. This is ordinary function composition; Spark plans and runs
everything.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from ..settings import Settings
from ..sources import Sources


@dataclass(frozen=True)
class ModelSpec:
    name: str
    layer: str
    deps: tuple[str, ...]
    fn: Callable[["Build"], DataFrame]


MODELS: dict[str, ModelSpec] = {}


def model(name: str, layer: str, deps: tuple[str, ...] = ()):
    def register(fn):
        MODELS[name] = ModelSpec(name, layer, tuple(deps), fn)
        return fn
    return register


class Build:
    """One build: sources + settings + already-resolved models."""

    def __init__(self, spark: SparkSession, sources: Sources, settings: Settings | None = None,
                 published: Callable[[str], DataFrame | None] | None = None):
        self.spark = configure(spark)
        self.sources = sources
        if settings is None:
            raise ValueError("settings must be given: house_brand and other_non_partner_licenses have no default")
        self.cfg = settings
        self._published = published
        self._memo: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        return self.sources.table(name)

    def ref(self, name: str) -> DataFrame:
        if name not in self._memo:
            df = self._published(name) if self._published else None
            self._memo[name] = df if df is not None else MODELS[name].fn(self)
        return self._memo[name]

    def dim(self, name: str, *cols) -> DataFrame:
        """A narrow projection of a dimension model for an enrichment join.

        No broadcast hint: the planner broadcasts it only when its estimated
        size (from file statistics) is under ``spark.sql.autoBroadcastJoinThreshold``
        and otherwise plans a sort-merge join, so a dimension that grows with
        the data is never forced into every executor's memory."""
        return self.ref(name).select(*cols) if cols else self.ref(name)

    def pin(self, name: str, df: DataFrame) -> None:
        """Use ``df`` (e.g. a just-written table) for every later ``ref(name)``."""
        self._memo[name] = df


def dependency_order(names: list[str] | None = None) -> list[str]:
    """Models in an order where every model follows its dependencies."""
    want = list(MODELS) if names is None else list(names)
    seen: set[str] = set()
    order: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        seen.add(n)
        for d in MODELS[n].deps:
            visit(d)
        order.append(n)

    for n in want:
        visit(n)
    return order
