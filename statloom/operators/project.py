"""Projection and row slices with the semantics of a file read."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F


def in_file_order(df: DataFrame, columns: Iterable[str] | None) -> DataFrame:
    """The named columns in the order of ``df``; unknown names are ignored; None: all."""
    wanted = None if columns is None else set(columns)
    return df.select(*(c for c in df.columns if wanted is None or c in wanted))


def rows(df: DataFrame, *keys: str | Column, offset: int = 0, limit: int = 0) -> DataFrame:
    """Rows from ``offset`` on in the order of ``keys``, at most ``limit``; a limit of 0 is none."""
    ordered = df.orderBy(*keys).offset(offset) if offset else df.orderBy(*keys)
    return ordered.limit(limit) if limit else ordered


def row_numbers(df: DataFrame, *keys: str | Column, name: str = "row") -> DataFrame:
    """Adds gapless numbers from 0 in the order of ``keys``, without sending all rows to one task.

    Rows are ranged by key and numbered within each range; only the ranges' sizes reach the driver. The
    ranged rows must come out the same twice, so keys should tell rows apart.
    """
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_part", F.spark_partition_id()).persist()
    before, offsets = 0, []
    for r in sorted(ranged.groupBy("_part").count().collect()):
        offsets.append((r["_part"], before))
        before += r["count"]
    offsets = df.sparkSession.createDataFrame(offsets, "_part int, _before long")
    order = Window.partitionBy("_part").orderBy(*keys)
    return ranged.join(F.broadcast(offsets), "_part").withColumn(name, F.row_number().over(order) - 1 + F.col("_before")).drop("_part", "_before")
