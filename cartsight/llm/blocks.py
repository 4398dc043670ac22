"""Sums over stored blocks: what an iteration of a fit asks of its rows."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summed(blocks: DataFrame, column: str, size: int, part: Callable[[pa.Buffer], np.ndarray], whole: bool = False) -> np.ndarray:
    """The sum of ``part`` (``size`` values) over the blocks in ``column``; a task adds up its blocks, Spark the tasks.

    The values are doubles, or whole numbers that are added exactly with ``whole``.
    """
    kind, numbers = (np.int64, "bigint") if whole else (np.float64, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(size, kind), False
        for batch in batches:
            for block in batch.column(0):
                total += part(block.as_buffer())
                some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["i", "part"])

    parts = blocks.select(column).mapInArrow(run, f"i int, part {numbers}")
    value = F.col("part").cast("decimal(38,0)") if whole else F.col("part")
    out = np.zeros(size, object if whole else kind)
    for i, value in parts.groupBy("i").agg(F.sum(value)).collect():
        out[i] = int(value) if whole else value
    return out
