"""Tables of vectors as numpy matrices: which rows count, and sums over all of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = ["finite", "common_length", "usable", "matrix", "gram", "GROUPS"]

#: Groups in which the tasks' partial sums are added up before the last addition.
GROUPS = 64


def finite(vector: Column, most: float) -> Column:
    """Whether ``vector`` is neither null nor empty and each entry is a number smaller than ``most`` in size."""
    inside = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float(most)), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & inside, F.lit(False))


def common_length(df: DataFrame, vector: str, most: float) -> int | None:
    """The commonest length of a usable vector (of two, the longer); None without one."""
    c = F.col(f"`{vector}`")
    sizes = df.where(finite(c, most)).groupBy(F.size(c).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return None if first is None else first["d"]


def usable(df: DataFrame, vector: str, length: int, most: float, *columns: Column) -> DataFrame:
    """``columns`` and ``vector`` (as ``vector``) of the rows whose vector is usable and has this length."""
    c = F.col(f"`{vector}`")
    return df.where(finite(c, most) & (F.size(c) == length)).select(*columns, c.cast("array<double>").alias("vector"))


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """The rows of a list column without nulls as a matrix of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)


def _add(table: pa.Table) -> pa.Table:
    """One row for the group: its partial sums added up in order of their tasks."""
    order = np.argsort(table.column("task").to_numpy(), kind="stable")
    total = sum(np.frombuffer(table.column("total")[int(k)].as_py(), np.float64) for k in order)
    return pa.table({"line": table.column("line")[:1], "task": table.column("task")[:1].cast(pa.int64()),
                     "total": pa.array([total.tobytes()], pa.binary())})


def gram(df: DataFrame, columns: list[str], of: Callable[[pa.RecordBatch], np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sum of the rows, sum of their outer products) over the rows of ``width`` doubles that ``of`` makes of each batch.

    A task holds one matrix of ``width`` squared and sends it line by line; lines are added up in two steps, by
    ``GROUPS`` groups of tasks and then all, so that no task receives a line from every other.
    """
    schema = "line int, task bigint, total binary"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total, outer, any_rows = np.zeros(width), np.zeros((width, width)), False
        for batch in batches:
            if batch.num_rows:
                rows = of(batch)
                total += rows.sum(0)
                outer += rows.T @ rows
                any_rows = True
        if any_rows:
            lines = [x.tobytes() for x in outer] + [total.tobytes()]
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array(range(width + 1), pa.int32()), pa.array([task] * (width + 1), pa.int64()),
                                              pa.array(lines, pa.binary())], ["line", "task", "total"])

    parts = df.select(*columns).mapInArrow(partial, schema)
    parts = parts.groupBy("line", F.pmod("task", F.lit(GROUPS)).alias("g")).applyInArrow(_add, schema)
    lines = {r["line"]: np.frombuffer(r["total"], np.float64) for r in parts.groupBy("line").applyInArrow(_add, schema).collect()}
    return lines[width], np.stack([lines[k] for k in range(width)])
