"""Vectors as whole numbers, and blocks of asking rows against cells of rows.

The rows of a table are laid out in ranges of a key that ends in a unique number, so no value of the key, however
frequent, makes a cell large. Asking rows are dealt to blocks. A task gets one cell and one block, both of a bounded
expected size; a cell is sent only to the blocks that ask for it.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.session import write_out

CELL = 8192  # rows of a cell
BLOCK = 2048  # asking rows of a block


def finite(name: str = "x") -> Column:
    """Whether an array of doubles is there, without NULL or non-finite components."""
    return F.coalesce(F.forall(name, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))


def whole_numbers(vectors: DataFrame, scale: int, *others: str) -> DataFrame:
    """row, vec_id, dim, norm, q and the ``others``: components x as floor(scale * x), ``row`` a number of the row's own.

    Rows whose vec_id or vector is NULL or whose vector holds a NULL or non-finite component are left out. A vector
    whose squared length does not fit into 62 bits has no exact 64-bit product: it ends the query with an error. The
    table is written, so that ``row`` stays what it is.
    """
    x = F.transform("embedding", lambda v: v.cast("double"))
    known = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), *others, x.alias("x"))
    known = known.where(F.col("vec_id").isNotNull()).where(finite())
    scaled = F.transform("x", lambda v: F.floor(v * F.lit(float(scale))).cast("double"))
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))
    known = known.withColumn("x", scaled).withColumn("norm", length)
    fault = F.raise_error(F.concat(F.lit("no exact product: components too large in vec_id "), F.col("vec_id").cast("string")))
    whole = F.when(F.col("norm") < 2.0**31, F.transform("x", lambda v: v.cast("long"))).otherwise(fault.cast("array<long>"))
    row = F.monotonically_increasing_id().alias("row")
    return write_out(known.select(row, "vec_id", F.size("x").alias("dim"), "norm", whole.alias("q"), *others), "whole-vectors")


def in_cells(rows: DataFrame, *key: str | Column, size: int = CELL) -> DataFrame:
    """The rows in ranges of (key, row), numbered from 0 in ``cell``; written."""
    n = max(1, ceil(rows.count() / size))
    return write_out(rows.repartitionByRange(n, *key, "row").withColumn("cell", F.spark_partition_id()), "vector-cells")


def in_blocks(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """The rows with ``block``, dealt by a hash of their number."""
    n = max(1, ceil(rows.count() / size))
    return rows.withColumn("block", F.pmod(F.xxhash64("row", F.lit("block")), F.lit(n)).cast("int"))


def meet(cells: DataFrame, asks: DataFrame, task: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``task(cell, block)`` for each cell and each block that has rows asking for it (``cell``, ``block`` in asks)."""
    wanted = asks.select("cell", "block").distinct()
    sent = cells.join(wanted, "cell")
    asks = asks.select(*[F.col(c).alias(c) for c in asks.columns])  # columns of their own, not those of the cells
    return sent.groupBy("cell", "block").cogroup(asks.groupBy("cell", "block")).applyInArrow(_both(task, schema), schema)


def _both(task: Callable[[pa.Table, pa.Table], pa.Table], schema: str):
    names = [(c.split()[0], pa.float64() if c.split()[1] == "double" else pa.int64()) for c in schema.split(", ")]

    def run(cell: pa.Table, block: pa.Table) -> pa.Table:
        if not len(cell) or not len(block):
            return pa.schema(names).empty_table()
        made = [task(cell.filter(pa.compute.equal(cell["dim"], dim)), block.filter(pa.compute.equal(block["dim"], dim))) for dim in block["dim"].unique()]
        return pa.concat_tables([t.select([n for n, _ in names]) for t in made])

    return run


def matrix(vectors: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of equal length as one array of 64-bit numbers."""
    chunks = [c.flatten().to_numpy() for c in vectors.chunks]
    return np.concatenate(chunks or [np.zeros(0, np.int64)]).reshape(len(vectors), dim)
