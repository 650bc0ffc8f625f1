"""Table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from debtlens.sources.relations import RELATIONS


def load(spark: SparkSession, location: str, name: str, suffix: str = ".parquet") -> DataFrame:
    """A table as stored: Parquet at ``<location>/<name><suffix>`` for a path, or the catalog table
    ``<location>.<name>`` for a bare namespace."""
    if "/" not in location:
        return spark.table(f"{location}.{name}")
    return spark.read.parquet(f"{location.rstrip('/')}/{name}{suffix}")


def normalize(df: DataFrame, name: str) -> DataFrame:
    """The relation's columns under their canonical names and types.

    Source names are matched without regard to case and ``account_no`` is read as
    ``acc_no``. A cast to a column's own type disappears in analysis, so filters on columns
    stored as documented still reach the file scan.
    """
    source = {c.lower(): c for c in df.columns}
    if "account_no" in source:
        source.setdefault("acc_no", source["account_no"])
    wanted = RELATIONS[name].columns
    absent = set(wanted) - set(source)
    if absent:
        raise ValueError(f"{name} lacks columns: {sorted(absent)}")
    return df.selectExpr(*(f"CAST(`{source[c]}` AS {t}) AS {c}" for c, t in wanted.items()))


def load_relation(
    spark: SparkSession, location: str, name: str, suffix: str = ".parquet"
) -> DataFrame:
    """One of the documented ledger relations, ready for the reports."""
    return normalize(load(spark, location, name, suffix), name)
