"""Embedding near-duplicates: an exact metric range join in Spark.

Unit vectors link when their cosine is at least ``threshold``, that is, when they
are at most r = sqrt(2 - 2 threshold) apart. A few vectors serve as pivots; each
vector belongs to the cell of its nearest pivot. For pivots p, q the function
y . (p - q) / |p - q| changes by at most |x - y| between two points (triangle
inequality), and it is at least 0 in the cell of p and at most 0 in that of q. So
a vector of cell p can have partners in cell q only if its value is at most r;
then it is copied to q. Copies go to the lower-numbered cell only, each pair is
compared once, and the cells join independently.

A cell's rows are cut into blocks, and each pair of blocks is a task of its own,
so a crowded cell is spread over many tasks with bounded memory. Vectors that
are equal are one node with a count. A task returns, per vector, how many others
it links to and one link into its local group, so thousands of near copies give
thousands of rows, not millions.

Cosines are computed in double precision. Defined results: vectors that are
null, empty, zero, or have null or non-finite components, and rows without id,
link with nothing; vectors of different lengths link with nothing; rows that
repeat an id and a vector count as copies of each other; extra columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlake.llm._ship import ship
from incidentlake.llm._stored import stored
from incidentlake.llm.components import connected_components

THRESHOLD = 0.95
ROWS_PER_PIVOT = 8192
MAX_PIVOTS = 256
BLOCK_ROWS = 8192
_SLACK = 1e-9  # of rounding, in the replication test


def _unit_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Raw bytes and unit bytes of every valid vector; null for the others."""
    for batch in batches:
        raw, unit, size = [], [], []
        for v in batch.column("v").to_pylist():
            x = None if v is None or not len(v) or any(c is None for c in v) else np.asarray(v, dtype=np.float64) + 0.0
            top = np.abs(x).max() if x is not None else math.nan
            if x is None or not math.isfinite(top) or not np.isfinite(x).all() or top == 0:
                raw.append(None), unit.append(None), size.append(None)
                continue
            y = x / top  # no overflow in the norm
            raw.append(x.tobytes()), unit.append((y / np.sqrt(y @ y)).tobytes()), size.append(len(x))
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(raw, pa.binary()), pa.array(unit, pa.binary()), pa.array(size, pa.int32())], names=["id", "raw", "unit", "dim"])


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def _to_cells(pivots, radius: float):
    """Each vector's own cell, and the lower cells that it is copied to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, cells = [], []
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                centres = pivots.value[dim]
                near = _matrix(batch.column("unit").take(pa.array(at)), dim) @ centres.T
                own = near.argmax(axis=1)
                apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
                gap = near[np.arange(len(at)), own][:, None] - near
                copied = (gap <= radius * apart[own] + _SLACK) & (np.arange(len(centres)) < own[:, None])
                i, cell = np.nonzero(copied)
                rows += [at, at[i]]
                cells += [own, cell]
            take = np.concatenate(rows)
            kind = np.concatenate([np.full(len(c), k % 2 == 0) for k, c in enumerate(cells)])
            part = batch.take(pa.array(take))
            yield pa.RecordBatch.from_arrays(
                [part.column("rep"), part.column("copies"), part.column("unit"), part.column("dim"), pa.array(np.concatenate(cells).astype(np.int32)), pa.array(kind)],
                names=["rep", "copies", "unit", "dim", "cell", "own"],
            )

    return run


def _join_blocks(threshold: float, id_type: pa.DataType):
    """Links between the two blocks of a task: per vector the number of links
    (copies counted) and the root of its group among the linked ones."""
    schema = pa.schema([("rep", id_type), ("root", id_type), ("n", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        side = np.asarray(table.column("side").to_numpy())
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        within = not len(right) and not table.column("across")[0].as_py()
        x = _matrix(table.column("unit"), table.column("dim")[0].as_py())
        copies = table.column("copies").to_numpy()
        others = left if within else right
        degree = np.zeros(len(x), np.int64)
        parent = np.arange(len(x))

        def find(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for start in range(0, len(left), 512):
            rows = left[start : start + 512]
            close = x[rows] @ x[others].T >= threshold
            if within:
                close[np.arange(len(rows)), start + np.arange(len(rows))] = False
            i, j = np.nonzero(close)
            degree[rows] += (close * copies[others]).sum(axis=1)
            if not within:
                degree[others] += (close * copies[rows][:, None]).sum(axis=0)
            for a, b in zip(rows[i].tolist(), others[j].tolist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        some = np.flatnonzero(degree)
        root = pa.array([find(i) for i in some.tolist()], pa.int64())
        rep = table.column("rep")
        return pa.Table.from_arrays([rep.take(pa.array(some)), rep.take(root), pa.array(degree[some])], schema=schema)

    return run


def _pivots(vectors: DataFrame, rows_per_pivot: int, max_pivots: int) -> dict[int, np.ndarray]:
    """Per vector length, at most ``max_pivots`` vectors in the order of a hash."""
    found = {}
    for dim, n in sorted((r["dim"], r["n"]) for r in vectors.groupBy("dim").agg(F.count("*").alias("n")).collect()):
        k = min(max(math.ceil(n / rows_per_pivot), 1), max_pivots)
        chosen = vectors.where(F.col("dim") == dim).orderBy(F.xxhash64("unit"), "unit").limit(k).select("unit").collect()
        found[dim] = np.frombuffer(b"".join(r["unit"] for r in chosen), np.float64).reshape(-1, dim)
    return found


def range_join(vectors: DataFrame, threshold: float = THRESHOLD, rows_per_pivot: int = ROWS_PER_PIVOT, max_pivots: int = MAX_PIVOTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rep``, ``root``, ``n`` of every vector that links to another one, per
    block task. ``vectors``: rep, copies, unit, dim; one row per distinct vector."""
    spark = vectors.sparkSession
    pivots = _pivots(vectors, rows_per_pivot, max_pivots)
    # cosine t as a distance; the comparison itself uses the cosine
    radius = math.sqrt(max(2 - 2 * threshold, 0)) + _SLACK
    kind = vectors.schema["rep"].dataType.simpleString()
    cells = vectors.mapInArrow(_to_cells(spark.sparkContext.broadcast(pivots), radius), f"rep {kind}, copies bigint, unit binary, dim int, cell int, own boolean")
    cells = stored(cells, "cells")
    counts = cells.groupBy("dim", "cell").agg(F.count_if("own").alias("n_own"), F.count_if(~F.col("own")).alias("n_copied"))
    blocks = lambda n: F.greatest(F.ceil(F.col(n) / block_rows), F.lit(1)).cast("int")
    plan = counts.select("dim", "cell", blocks("n_own").alias("b_own"), F.when(F.col("n_copied") > 0, blocks("n_copied")).otherwise(0).alias("b_copied"))
    plan = F.broadcast(plan)  # one row per pivot: at most max_pivots for each vector length
    dealt = cells.join(plan, ["dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("unit", "rep"), F.when(F.col("own"), F.col("b_own")).otherwise(F.col("b_copied"))).cast("int"))
    # own block i meets own blocks j >= i and all copied blocks; "other" numbers the second block
    every = F.sequence(F.lit(0), F.col("b_own") - 1)
    task = lambda i, j, side, across: F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side"), across.alias("across"))
    as_left = F.transform(every, lambda j: F.when(j >= F.col("block"), task(F.col("block"), j, 0, j > F.col("block"))))
    as_right = F.transform(every, lambda i: F.when(i < F.col("block"), task(i, F.col("block"), 1, F.lit(True))))
    with_copied = F.when(F.col("b_copied") > 0, F.transform(F.sequence(F.lit(0), F.col("b_copied") - 1), lambda j: task(F.col("block"), -j - 1, 0, F.lit(True))))
    as_copied = F.transform(every, lambda i: task(i, -F.col("block") - 1, 1, F.lit(True)))
    own_tasks = F.filter(F.concat(as_left, as_right, F.coalesce(with_copied, F.filter(as_left, lambda _: F.lit(False)))), lambda t: t.isNotNull())
    tasks = dealt.select("rep", "copies", "unit", "dim", "cell", F.explode(F.when(F.col("own"), own_tasks).otherwise(as_copied)).alias("t")).select("rep", "copies", "unit", "dim", "cell", "t.*")
    run = _join_blocks(threshold, vectors.select("rep").limit(0).toArrow().schema.field(0).type)
    return tasks.groupBy("dim", "cell", "i", "j").applyInArrow(run, f"rep {kind}, root {kind}, n bigint")


def near_duplicates(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, **sizes) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row."""
    spark = embeddings.sparkSession
    ship(spark)
    id_type = embeddings.schema[vec_id].dataType.simpleString()
    rows = embeddings.select(F.col(vec_id).alias("id"), F.col(vector).alias("v")).mapInArrow(_unit_vectors, f"id {id_type}, raw binary, unit binary, dim int")
    rows = stored(rows, "vectors")
    nodes = stored(
        rows.where("raw is not null and id is not null").groupBy("raw", "unit", "dim").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "nodes"
    )
    found = stored(range_join(nodes.select("rep", "copies", "unit", "dim"), threshold, **sizes), "vector-links")
    degree = found.groupBy("rep").agg(F.sum("n").alias("n"))
    part = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    named = (
        nodes.join(degree, "rep", "left").join(part, F.col("rep") == F.col("id"), "left")
        .select("raw", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    known = rows.where("id is not null").join(named, "raw", "left").select(
        F.col("id").alias(vec_id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    )
    nameless = rows.where("id is null").select(F.col("id").alias(vec_id), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return known.unionByName(nameless).withColumn("kept", F.col(vec_id).eqNullSafe(F.col("component_id")))
