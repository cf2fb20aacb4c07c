"""Running sums within keys that no single task has to hold."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from fieldmill.llm.tables import cut

_U = np.uint64


def _sums(values: np.ndarray, new: np.ndarray, carry: np.ndarray) -> np.ndarray:
    """Sums down the rows that start anew where ``new``; rows before the first start go on from ``carry``."""
    total = values.cumsum(0, dtype=_U)
    start = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
    before = np.vstack([np.zeros((1, values.shape[1]), _U), total])[np.maximum(start, 0)]
    before[start < 0] = np.zeros_like(carry) - carry
    return total - before


def running_sums(df: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """``df`` with ``columns`` (longs) summed over the rows of the same ``key`` up to each row, and, as
    ``<column>_before``, up to the row before it.

    Sums wrap at 64 bits.  ``key`` is a long without nulls.  Rows are dealt by ranges of key and order, so
    a key with very many rows lies in several partitions; a first pass gives one row a partition with the
    sums of its last key, which the driver adds up into what each partition starts from.  Rows that tie in
    ``order`` come in any order.
    """
    ranged = cut(df.repartitionByRange(key, *order).sortWithinPartitions(key, *order))
    at = ranged.columns.index(key)
    places = [ranged.columns.index(c) for c in columns]

    def parts(batches, carry=None):
        """(batch, sums of its rows, last key, last sums); ``carry`` is for the first key."""
        last, state = carry if carry else (None, np.zeros(len(places), _U))
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(at).to_numpy()
            values = np.stack([batch.column(p).to_numpy().view(_U) for p in places], 1)
            new = np.append(True if last is None else keys[0] != last, keys[1:] != keys[:-1])
            sums = _sums(values, new, state)
            last, state = int(keys[-1]), sums[-1]
            yield batch, keys, sums

    def tails(batches):
        first = last = state = None
        for _, keys, sums in parts(batches):
            first = int(keys[0]) if first is None else first
            last, state = int(keys[-1]), sums[-1]
        if first is not None:
            yield pa.RecordBatch.from_pydict(
                {
                    "part": [TaskContext.get().partitionId()],
                    "first": [first],
                    "last": [last],
                    "sums": [state.view(np.int64).tolist()],
                }
            )

    carries: dict[int, tuple[int, np.ndarray]] = {}
    state: tuple[int, np.ndarray] | None = None
    found = ranged.mapInArrow(tails, "part long, first long, last long, sums array<long>").collect()
    for part, first, last, sums in sorted(found):
        sums = np.array(sums, np.int64).view(_U)
        if state and state[0] == first:
            carries[part] = state
            if first == last:
                sums = sums + state[1]
        state = (last, sums)

    def run(batches):
        for batch, _, sums in parts(batches, carries.get(TaskContext.get().partitionId())):
            arrays, before = list(batch.columns), []
            for k, p in enumerate(places):
                own = batch.column(p).to_numpy().view(_U)
                arrays[p] = pa.array(sums[:, k].copy().view(np.int64))
                before.append(pa.array((sums[:, k] - own).view(np.int64)))
            yield pa.RecordBatch.from_arrays(arrays + before, names=schema.names)

    schema = StructType([*ranged.schema, *(StructField(f"{c}_before", LongType()) for c in columns)])
    return ranged.mapInArrow(run, schema)
