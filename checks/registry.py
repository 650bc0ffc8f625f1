"""A check pairs a DataFrame program with an SQL text written independently of it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from debtlens.sources import load


class Tables:
    """The generated tables of one directory, as attributes."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark = spark
        self.location = location

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        # Opening a table reads its footer, so each is opened once.
        table = load(self.spark, self.location, name)
        setattr(self, name, table)
        return table


@dataclass(frozen=True)
class Check:
    name: str
    program: Callable[[Tables], DataFrame]
    sql: str

    def run(self, spark: SparkSession, location: str) -> DataFrame:
        return self.program(Tables(spark, location))


CHECKS: dict[str, Check] = {}


def check(
    sql: str, name: str | None = None
) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register the decorated program, under its own name unless another is given."""

    def register(program: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        key = name or program.__name__
        if key in CHECKS:
            raise ValueError(f"two checks named {key}")
        CHECKS[key] = Check(key, program, sql.strip())
        return program

    return register
