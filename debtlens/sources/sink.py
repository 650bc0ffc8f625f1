"""Report output."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Write a report as ``parquet`` or ``csv`` (with a header), one file per partition."""
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"unknown format: {fmt}")
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
