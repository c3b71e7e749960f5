"""Iterations inside one job: the rows stay in their tasks, which exchange only sums.

A table that fits one task is iterated there without any exchange. A larger one is dealt to a barrier
stage, whose tasks add up their sums after every round by ``allGather``. All tasks see the sums in the
same order and so go through the same states; the first one returns the result. A lost executor restarts
the stage. Spark answers an exchange about once a second, so dealing pays from some million cells on.
"""

import base64
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, TaskContext
from pyspark.sql import DataFrame

from .moments import batch_matrix

TASK_CELLS = 4_000_000  # numbers that one task iterates alone


class Exchange:
    """Sums over all tasks of the iteration."""

    def __init__(self, tasks: int):
        self.tasks = tasks

    def total(self, values: np.ndarray) -> np.ndarray:
        values = np.ascontiguousarray(values, dtype=np.float64)
        if self.tasks == 1:
            return values
        parts = BarrierTaskContext.get().allGather(base64.b64encode(values.tobytes()).decode())
        return np.sum([np.frombuffer(base64.b64decode(p)).reshape(values.shape) for p in parts], axis=0)


def iterated(table: DataFrame, rows: int, body: Callable[[np.ndarray, Exchange], np.ndarray], task_cells: int = TASK_CELLS) -> np.ndarray:
    """What ``body(own rows, exchange)`` returns: a flat vector, the same in every task.

    The columns of ``table`` are numbers, NULL is NaN. A task holds its part of the rows, at least ``task_cells``
    numbers or a slot's share of the table.
    """
    width = len(table.columns)
    slots = table.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(slots, -(-rows * width // task_cells)))

    def run(batches):
        parts = [batch_matrix(b, width) for b in batches]
        result = body(np.concatenate(parts) if parts else np.empty((0, width)), Exchange(tasks))
        if TaskContext.get().partitionId() == 0:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(result))), pa.array(np.asarray(result, dtype=np.float64))], names=["k", "value"])

    found = table.repartition(tasks).mapInArrow(run, "k long, value double", barrier=tasks > 1).collect()
    return np.array([r["value"] for r in sorted(found, key=lambda r: r["k"])])
