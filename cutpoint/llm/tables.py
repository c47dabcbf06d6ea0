"""Fixed-width tables gathered from all partitions: each task fills its own, and the
parts are combined in two shuffles, so no task ever holds more than a few of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutpoint.llm.common import bound_batches

#: Pieces a table is sent in, and partial sums per piece on the way.
PIECES = 256
FAN = 64


def gather(df: DataFrame, fill: Callable[[Iterator[pa.RecordBatch]], np.ndarray], kind: str,
           combine: np.ufunc = np.add) -> np.ndarray:
    """``fill`` turns a partition into one array, of the same length in every task; the
    arrays are combined element by element. The result has a fixed size, set by a
    parameter and not by the data, and so may be sent to the driver and broadcast. Pieces
    without a value are not sent: zero must be the neutral element of ``combine``."""
    bound_batches(df.sparkSession)

    def parts(batches):
        table = fill(batches)
        task = TaskContext.get().partitionId() % FAN
        for piece, values in enumerate(np.array_split(table, PIECES)):
            if not values.any():
                continue
            yield pa.RecordBatch.from_arrays(
                [pa.array([piece], pa.int32()), pa.array([task], pa.int32()),
                 pa.array([np.ascontiguousarray(values, kind).tobytes()], pa.binary())],
                names=["piece", "task", "data"])

    def merge(table: pa.Table) -> pa.Table:
        total = None
        for x in table.column("data"):
            values = np.frombuffer(x.as_buffer(), kind)
            total = values.copy() if total is None else combine(total, values, out=total)
        first = table.slice(0, 1)
        return first.set_column(2, "data", pa.array([total.tobytes()], pa.binary()))

    schema = "piece int, task int, data binary"
    some = df.mapInArrow(parts, schema).groupBy("piece", "task").applyInArrow(merge, schema)
    rows = some.withColumn("task", F.lit(0)).groupBy("piece", "task").applyInArrow(merge, schema).collect()
    total = np.array(fill(iter(())), kind)
    for r, values in ((r, np.frombuffer(r.data, kind)) for r in rows):
        np.array_split(total, PIECES)[r.piece][:] = values
    return total
