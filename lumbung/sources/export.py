"""Ordered CSV export of the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lumbung.operators.dimensions import DIMENSIONS
from lumbung.operators.facts import FACT_COLUMNS
from lumbung.sources.warehouse import FACT, Warehouse


def export_table(df: DataFrame, path: str) -> None:
    """Sorted by the first column; part files follow one another in that order."""
    df.orderBy(df.columns[0]).write.mode("overwrite").option("sep", ";").option("header", True).csv(path)


def export_all(wh: Warehouse, folder: str) -> None:
    for dim in DIMENSIONS:
        export_table(wh.dimension(dim), f"{folder}/{dim.table}.csv")
    export_table(wh.facts().select(*FACT_COLUMNS), f"{folder}/{FACT}.csv")
