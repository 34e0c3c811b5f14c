"""All pairs of vectors whose correlation reaches a threshold, exactly, by pivots and the triangle inequality of angles.

* Unit vectors of correlation t are at most the angle arccos t apart. Every vector belongs to the cell of its nearest pivot.
  If x and y are that close and y lies in the cell of p, then x is at most twice the angle farther from p than from its own
  pivot, and at most the angle farther than the cell reaches. So x visits only the cells that these bounds leave, and of two
  cells only the one with the smaller number, where the pair is found once.
* In a cell the angles to the pivot of two partners differ by no more than that angle. Vectors are sorted by it, and
  a slice is multiplied only with the stretch that the bound leaves.
* A cell of many vectors is cut by a hash; a task takes two parts of it, so what a task holds is bounded.
* Equal vectors are one: the pairs are those of the smallest ids, with the numbers of copies on both sides.

The pivots are a sample of at most ``PIVOTS`` vectors; they decide what is compared where, not what is found. The further
apart the vectors of a cell lie from those of others, the fewer visits; vectors without clusters visit many cells.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewell.functions.scoring import standardize
from tidewell.session import materialize

PIVOTS = 256
PART = 4096
SLICE = 256
SLACK = 1e-6  # more than rounding can move an angle


def distinct_vectors(vectors: DataFrame, key: str, vector: Column) -> DataFrame:
    """(unit, id, n): the standardised vectors, their smallest key and the number of rows; those without spread are left out."""
    units = vectors.select(F.col(f"`{key}`").alias("id"), standardize(vector).alias("unit"))
    whole = F.col("unit").isNotNull() & ~F.exists("unit", lambda x: x.isNull() | F.isnan(x))
    return units.where(whole).groupBy("unit").agg(F.min("id").alias("id"), F.count("*").alias("n"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(len(column), -1)


def _angles(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(left @ right.T, -1.0, 1.0))


def _placed(found: DataFrame, pivots: np.ndarray) -> DataFrame:
    """With each vector's cell and its angle to the pivot."""

    def run(batches):
        for batch in batches:
            if len(batch):
                angles = _angles(_matrix(batch.column("unit")), pivots)
                cell = angles.argmin(1)
                near = angles[np.arange(len(cell)), cell]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(near)],
                                                 [*batch.schema.names, "cell", "angle"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema)
    return found.mapInArrow(run, f"{fields}, cell int, angle double")


def _visiting(batch: pa.RecordBatch, pivots: np.ndarray, reach: np.ndarray, limit: float):
    """The vectors of a batch once for every cell of a smaller number that may hold a partner, at most PART at a time."""
    angles = _angles(_matrix(batch.column("unit")), pivots)
    cell, near = batch.column("cell").to_numpy(), batch.column("angle").to_numpy()
    may = (angles <= near[:, None] + 2 * limit) & (angles <= reach + limit)
    may &= np.arange(len(pivots)) < cell[:, None]
    rows, others = np.nonzero(may)
    for at in range(0, len(rows), PART):  # a vector may visit every cell: never all copies at once
        row, other = rows[at : at + PART], others[at : at + PART]
        taken = batch.take(pa.array(row))
        columns = [taken.column(name) for name in ("unit", "id", "n")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(other.astype(np.int32)), pa.array(angles[row, other])], batch.schema.names)


def _visits(placed: DataFrame, pivots: np.ndarray, reach: np.ndarray, limit: float) -> DataFrame:
    """Each vector once for every cell of a smaller number that may hold a partner."""

    def run(batches):
        for batch in batches:
            if len(batch):
                yield from _visiting(batch, pivots, reach, limit)

    return placed.mapInArrow(run, placed.schema)


def _compared(left: pa.Table, right: pa.Table, threshold: float, limit: float, same: bool):
    """(left rows, right rows, correlations) of the pairs at or above the threshold."""
    a, b = _matrix(left.column("unit")), _matrix(right.column("unit"))
    near, far = left.column("angle").to_numpy(), right.column("angle").to_numpy()
    by_near, by_far = np.argsort(near, kind="stable"), np.argsort(far, kind="stable")
    sorted_far = far[by_far]
    rows, others, values = [], [], []
    for at in range(0, len(by_near), SLICE):
        some = by_near[at : at + SLICE]
        low = np.searchsorted(sorted_far, near[some[0]] - limit)
        stretch = by_far[low : np.searchsorted(sorted_far, near[some[-1]] + limit, "right")]
        products = a[some] @ b[stretch].T
        i, j = np.nonzero(products >= threshold)
        row, other = some[i], stretch[j]
        keep = row < other if same else np.ones(len(row), bool)
        rows.append(row[keep])
        others.append(other[keep])
        values.append(products[i, j][keep])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(rows), np.concatenate(others), np.concatenate(values)


def _tasks(rows: DataFrame, sizes: DataFrame, home: bool) -> DataFrame:
    """Rows dealt to tasks (cell, i, j, home): part i of a cell's own vectors meets its part j, or part -1 - j of its visitors."""
    known = rows.join(sizes, "cell")  # one row per pivot: the planner sends them to all tasks
    own, other = F.greatest(F.lit(1), F.ceil(F.col("homes") / PART)), F.ceil(F.col("visitors") / PART)
    part = F.pmod(F.xxhash64("id"), own if home else other).cast("int")
    if home:
        pairs = F.concat(
            F.transform(F.sequence(F.lit(0), own.cast("int") - 1), lambda j: F.struct(F.least(part, j).alias("i"), F.greatest(part, j).alias("j"))),
            F.when(other > 0, F.transform(F.sequence(F.lit(1), other.cast("int")), lambda j: F.struct(part.alias("i"), (-j).alias("j"))))
            .otherwise(F.array().cast("array<struct<i:int,j:int>>")),
        )
    else:
        pairs = F.transform(F.sequence(F.lit(0), own.cast("int") - 1), lambda i: F.struct(i.alias("i"), (-1 - part).alias("j")))
    side = part if home else F.lit(-1)
    return known.select("cell", F.explode(pairs).alias("task"), side.alias("part"), "unit", "id", "n", "angle").select(
        "cell", "task.i", "task.j", "part", "unit", "id", "n", "angle"
    )


def correlated_pairs(found: DataFrame, threshold: float, pivots: int = PIVOTS) -> DataFrame:
    """(left, right, r, n_left, n_right) of all pairs of ``distinct_vectors`` with a correlation of ``threshold`` or more, left < right.

    Copies are counted, not paired: see ``members``. An empty table gives an empty result.
    """
    if not -1 < threshold <= 1:
        raise ValueError("the threshold is a correlation above -1")
    kind = found.schema["id"].dataType.simpleString()
    schema = f"left {kind}, right {kind}, r double, n_left long, n_right long"
    limit = math.acos(threshold) + SLACK
    chosen = found.orderBy(F.xxhash64("id")).limit(pivots).select("unit").toArrow()
    if not len(chosen):
        return found.sparkSession.createDataFrame([], schema)
    centres = _matrix(chosen.column("unit"))
    placed = materialize(_placed(found.select("unit", "id", "n"), centres), "cells")
    reach = np.full(len(centres), -math.inf)
    for row in placed.groupBy("cell").agg(F.max("angle").alias("reach")).collect():  # one row per pivot
        reach[row["cell"]] = row["reach"]
    visits = materialize(_visits(placed, centres, reach, limit), "visits")
    count = [rows.groupBy("cell").agg(F.count("*").alias(name)) for rows, name in ((placed, "homes"), (visits, "visitors"))]
    sizes = materialize(count[0].join(count[1], "cell", "left").na.fill(0), "cell-sizes")

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, i, j = (value.as_py() for value in key)
        part = table.column("part").to_numpy()
        left, right = table.filter(pa.array(part == i)), table.filter(pa.array(part == (j if j >= 0 else -1)))
        rows, others, r = _compared(left, right, threshold, limit, i == j)
        first, second = left.take(pa.array(rows)), right.take(pa.array(others))
        return pa.table({"left": first.column("id"), "right": second.column("id"), "r": pa.array(r),
                         "n_left": first.column("n"), "n_right": second.column("n")})

    dealt = _tasks(placed, sizes, True).unionByName(_tasks(visits, sizes, False))
    pairs = dealt.groupBy("cell", "i", "j").applyInArrow(run, schema)
    swap = F.col("left") > F.col("right")
    return pairs.select(
        F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right"), "r",
        F.when(swap, F.col("n_right")).otherwise(F.col("n_left")).alias("n_left"),
        F.when(swap, F.col("n_left")).otherwise(F.col("n_right")).alias("n_right"),
    )


def members(vectors: DataFrame, key: str, vector: Column) -> DataFrame:
    """(key, id): the id under which ``distinct_vectors`` lists each row's vector."""
    units = vectors.select(F.col(f"`{key}`").alias("key"), standardize(vector).alias("unit"))
    found = distinct_vectors(vectors, key, vector).select("unit", "id")
    return units.join(found, "unit").select(F.col("key").alias(key), "id")
