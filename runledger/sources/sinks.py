"""Sinks without a table behind them."""

from __future__ import annotations

from pyspark.sql import DataFrame


def debug_sink(df: DataFrame, rows: int = 20) -> None:
    """Print a few rows; only as many as are printed leave the executors."""
    if df.isStreaming:
        raise ValueError("use df.writeStream.format('console'), or call this inside foreachBatch")
    df.show(rows, truncate=120)


def nop_sink(df: DataFrame) -> None:
    """Consume all rows and keep nothing."""
    df.write.format("noop").mode("overwrite").save()
