"""Fixed-size count tables summed over all tasks.

A task sends its non-zero cells in chunks; chunks are added as they stream in,
so no task holds more than its chunks' cells and the driver gets one table of
a fixed size, whatever the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNKS = 64
SCHEMA = "chunk int, cells binary, counts binary"


def sparse_rows(cells: np.ndarray, counts: np.ndarray, bits: int):
    """Rows of ``SCHEMA`` for ascending cell numbers of a table of 2^bits cells."""
    width = (1 << bits) // CHUNKS
    cut = np.searchsorted(cells, np.arange(CHUNKS + 1) * width)
    for c in range(CHUNKS):
        a, z = cut[c], cut[c + 1]
        if z > a:
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array([c], pa.int32()),
                    "cells": [(cells[a:z] - c * width).astype("<u4").tobytes()],
                    "counts": [counts[a:z].astype("<u4").tobytes()],
                }
            )


def summed(sparse: DataFrame, bits: int, finish) -> np.ndarray:
    """The summed table, ``finish``ed chunk by chunk to an array of bytes each."""
    width = (1 << bits) // CHUNKS

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for c, cells, counts in zip(*b.columns):
                at = held.setdefault(c.as_py(), np.zeros(width, np.int64))
                at[np.frombuffer(cells.as_py(), "<u4")] += np.frombuffer(counts.as_py(), "<u4")
        for c, at in held.items():
            yield pa.RecordBatch.from_pydict(
                {"chunk": pa.array([c], pa.int32()), "cells": [finish(at).tobytes()]}
            )

    rows = (
        sparse.repartition(CHUNKS // 4, "chunk")
        .mapInArrow(run, "chunk int, cells binary")
        .collect()
    )
    blank = finish(np.zeros(width, np.int64))
    found = {r["chunk"]: np.frombuffer(r["cells"], blank.dtype) for r in rows}
    return np.stack([found.get(c, blank) for c in range(CHUNKS)])


def marked(marks: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Which cells are set in a bit table (little-endian bits)."""
    cells = cells.astype(np.int64)
    return (marks[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 == 1
