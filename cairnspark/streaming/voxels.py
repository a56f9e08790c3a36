"""Voxel sums over a stream of points: sums and counts are associative, so late batches simply add up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from cairnspark.operators.voxel import cell_sums
from cairnspark.schema import GridSpec


def stream_cells(points: DataFrame, grid: GridSpec) -> DataFrame:
    """Running (gx, gy, gz, sr, sg, sb, cnt) of a streaming DataFrame of points; the grid must be known beforehand."""
    return cell_sums(points, grid)


def start(points: DataFrame, grid: GridSpec, name: str) -> StreamingQuery:
    return stream_cells(points, grid).writeStream.outputMode("complete").format("memory").queryName(name).start()
