"""Sums of matrices over all rows, in tiles that travel as binary cells and meet in a tree.

A task adds up its rows in numpy and ends with one cell per tile, so what is shuffled depends on the tiles and on the number
of tasks, which :func:`few_tasks` bounds by the cores of the cluster: not on the rows, nor on the splits they came in.
At most FAN_IN cells meet in one group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cells (of numbers of 8 bytes) that one group adds up.
FAN_IN = 32
CELLS = "tile long, part long, sums binary"


def few_tasks(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` in no more tasks than there are cores, without a shuffle; and that number."""
    tasks = max(1, rows.sparkSession.sparkContext.defaultParallelism)
    return rows.coalesce(tasks), tasks


def cell_batch(tile: int, part: int, sums: np.ndarray) -> pa.RecordBatch:
    """One row of :data:`CELLS`."""
    columns = [pa.array([tile], pa.int64()), pa.array([part], pa.int64())]
    columns.append(pa.array([np.ascontiguousarray(sums, "float64").tobytes()], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, names=["tile", "part", "sums"])


def combined(cells: DataFrame, parts: int) -> DataFrame:
    """(tile, part, sums): the sum of all cells of each tile, of which there are up to ``parts`` per tile."""

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(cell.as_py(), "float64") for cell in group.column("sums"))
        first = group.slice(0, 1).combine_chunks()
        return pa.Table.from_batches([cell_batch(first["tile"][0].as_py(), first["part"][0].as_py(), total)])

    while True:
        parts = -(-parts // FAN_IN)
        met = cells.withColumn("part", F.pmod("part", F.lit(parts)))
        cells = met.groupBy("tile", "part").applyInArrow(add, CELLS)
        if parts == 1:
            return cells
