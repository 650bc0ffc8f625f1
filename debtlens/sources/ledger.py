"""The set of relations a report reads."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from debtlens.sources.tables import load_relation, normalize


class Ledger:
    """Relations by name, each opened (its files listed) once, when a report first asks for it."""

    def __init__(self, open_relation: Callable[[str], DataFrame]):
        self._open = open_relation
        self._opened: dict[str, DataFrame] = {}

    @classmethod
    def at(cls, spark: SparkSession, location: str, suffix: str = ".parquet") -> Ledger:
        """Relations stored as Parquet under a path, or as tables of a catalog namespace."""
        return cls(lambda name: load_relation(spark, location, name, suffix))

    @classmethod
    def of(cls, frames: Mapping[str, DataFrame]) -> Ledger:
        return cls(lambda name: normalize(frames[name], name))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self._open(name)
        return self._opened[name]
