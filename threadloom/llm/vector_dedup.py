"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors with cosine >= t lie within a squared distance of 2 - 2t. After a fixed rotation the
dimensions are cut into blocks, each with a budget in proportion to its dimensions; of two linked vectors
at least one block keeps its budget. Each block is range-joined on cells of its first coordinate that are
as wide as the budget's root: a vector goes to its own cell and to the next one. In a cell the block's
squared distances are compared with the budget, and the union of the candidates is verified by the
cosine in double precision. A pair that keeps the budget of several blocks is counted at the first.

Equal vectors of a label are one class. Large cells are cut into blocks of rows, and the pairs of blocks
are spread over tasks; a task returns a count and one edge for each vector, not the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadloom.llm.components import components
from threadloom.llm.scratch import Scratch
from threadloom.llm.streams import whole_groups

#: Dimensions of a block. Each block sends every vector to two cells, so few blocks keep the shuffle small.
BLOCK_DIMS = 16
#: Vectors of a cell that one block of rows holds.
ROWS = 3000
#: Elements of a distance matrix handled at once.
CHUNK = 4_000_000


def rotation(dims: int) -> np.ndarray:
    """A fixed random rotation."""
    return np.linalg.qr(np.random.default_rng(dims).normal(size=(dims, dims)))[0]


def blocks(dims: int, threshold: float) -> tuple[list[slice], np.ndarray]:
    """The blocks of dimensions and their budgets, which add up to the squared distance allowed."""
    cuts = list(range(0, dims, BLOCK_DIMS)) + [dims]
    parts = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]
    # a margin for rounding; the cosine decides in the end
    total = 2 - 2 * threshold + 1e-9
    return parts, np.array([total * (p.stop - p.start) / dims for p in parts])


def units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _cells(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            vectors = batch.column("embedding")
            cells: list = [None] * batch.num_rows
            for d in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == d)
                matrix = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(-1, d).astype(np.float64)
                turned = units(matrix) @ rotation(d)
                parts, budget = blocks(d, threshold)
                first = turned[:, [p.start for p in parts]]
                value = np.floor(first / (np.sqrt(budget) * (1 + 1e-9))).astype(np.int32)
                for r, c in zip(rows.tolist(), value.tolist()):
                    cells[r] = c
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int32()))], names=[*batch.schema.names, "cells"])
    return run


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n vertices, the smallest vertex reachable over the edges (a, b)."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def _linked(x, y, weights_x, weights_y, same: bool, block: int, threshold: float):
    """Links between two sets of vectors that are found in ``block``: (i, j) index arrays."""
    ux, uy = units(x), units(y)
    turn = rotation(x.shape[1])
    rx, ry = ux @ turn, uy @ turn
    parts, budget = blocks(x.shape[1], threshold)
    part = parts[block]
    fx, fy = rx[:, part], ry[:, part]
    nx, ny = (fx * fx).sum(axis=1), (fy * fy).sum(axis=1)
    step = max(1, CHUNK // max(1, len(y)))
    for s in range(0, len(x), step):
        near = nx[s:s + step, None] + ny[None, :] - 2 * (fx[s:s + step] @ fy.T) <= budget[block] + 1e-9
        if same:
            near &= np.arange(s, min(s + step, len(x)))[:, None] < np.arange(len(y))[None, :]
        found_i, found_j = np.nonzero(near)
        for c in range(0, len(found_i), CHUNK // 16):
            i, j = found_i[c:c + CHUNK // 16] + s, found_j[c:c + CHUNK // 16]
            square = (rx[i] - ry[j]) ** 2
            keeps = np.stack([square[:, p].sum(axis=1) for p in parts], axis=1) <= budget
            first = keeps[:, block] & ~keeps[:, :block].any(axis=1)
            i, j = i[first], j[first]
            dot = np.einsum("ij,ij->i", x[i], y[j])
            cosine = dot / np.sqrt(np.einsum("ij,ij->i", x[i], x[i]) * np.einsum("ij,ij->i", y[j], y[j]))
            hit = cosine >= threshold
            yield i[hit], j[hit]


def _join(threshold: float):
    keys = ["label", "dims", "block", "cell", "bi", "bj"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, keys):
            rep, weight = table.column("rep").to_numpy(), table.column("weight").to_numpy()
            own, side = table.column("own").to_numpy(zero_copy_only=False), table.column("side").to_numpy()
            low, high = table.column("bi").to_numpy(), table.column("bj").to_numpy()
            dims, block = table.column("dims").to_numpy(), table.column("block").to_numpy()
            vectors = table.column("embedding").combine_chunks()
            out = []
            for s, e in zip(bounds[:-1], bounds[1:]):
                if e - s < 2:
                    continue
                rows = np.arange(s, e)
                matrix = vectors.slice(s, e - s).flatten().to_numpy(zero_copy_only=False).reshape(e - s, dims[s]).astype(np.float64)
                one, two = int(low[s]), int(high[s])
                pairs = []
                # own with own, and own with the vectors of the cell below
                for left_own, right_own in ((True, True), (True, False), (False, True)):
                    if one == two and not left_own:
                        continue
                    left = np.flatnonzero((own[s:e] == left_own) & (side[s:e] == one))
                    right = np.flatnonzero((own[s:e] == right_own) & (side[s:e] == two))
                    if not len(left) or not len(right):
                        continue
                    same = one == two and left_own and right_own
                    for i, j in _linked(matrix[left], matrix[right], None, None, same, int(block[s]), threshold):
                        pairs.append((left[i], right[j]))
                if not pairs:
                    continue
                a, b = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
                if not len(a):
                    continue
                w = weight[s:e]
                links = np.bincount(a, weights=w[b], minlength=e - s) + np.bincount(b, weights=w[a], minlength=e - s)
                root = _forest(e - s, a, b)
                some = np.flatnonzero(links > 0)
                out.append((rep[rows[some]], rep[rows[root[some]]], links[some].astype(np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[i] for o in out])) for i in range(3)], names=["a", "b", "links"])
    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label).

    Only vectors with the same label and length are compared; more columns are ignored. Vectors that are
    null, empty or zero or hold null or non-finite values, and rows without label or vec_id, link with
    nothing. Rows that repeat a vec_id count as vectors of their own in ``n_links``.
    """
    scratch = Scratch(vectors.sparkSession, "vectors")
    # single precision is stored and sent as it is; the arithmetic is in double precision
    number = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast(f"array<{number}>").alias("embedding"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", finite) & F.exists(
        "embedding", lambda x: x != 0)
    # 0.0 and -0.0 are the same value
    plain = F.transform("embedding", lambda x: x + F.lit(0.0).cast(number))
    rows = scratch.store(rows.select("vec_id", "label", F.when(F.coalesce(usable, F.lit(False)), plain).alias("embedding")), "rows")
    sums = rows.where("embedding is not null").groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"))
    classes = scratch.store(
        sums.select("rep", "weight", "label", F.size("embedding").alias("dims"), "embedding").mapInArrow(
            _cells(threshold), f"rep long, weight long, label string, dims int, embedding array<{number}>, cells array<int>"), "classes")
    placed = classes.select("rep", "weight", "label", "dims", "embedding", F.posexplode("cells").alias("block", "cell0"))
    placed = placed.select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("own")).withColumn(
        "cell", F.col("cell0") + F.when(F.col("own"), 0).otherwise(1)).drop("cell0")
    cell = ["label", "dims", "block", "cell"]
    narrow = classes.select("label", "dims", F.posexplode("cells").alias("block", "cell0")).select(
        "label", "dims", "block", F.explode(F.array(F.col("cell0"), F.col("cell0") + 1)).alias("cell"))
    counted = scratch.store(narrow.groupBy(*cell).agg(F.count("*").alias("rows")).where("rows > 1"), "counts")
    sized = placed.join(counted, cell).withColumn("parts", F.ceil(F.col("rows") / ROWS).cast("int"))
    sized = sized.withColumn("side", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    spread = sized.select("rep", "weight", "embedding", *cell, "own", "side", F.least("side", "other").alias("bi"), F.greatest("side", "other").alias("bj"))
    keys = [*cell, "bi", "bj"]
    found = scratch.store(
        spread.repartition(*keys).sortWithinPartitions(*keys, "rep").mapInArrow(_join(threshold), "a long, b long, links long"), "links")
    links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    label = components(found.select("a", "b"), scratch).withColumnRenamed("id", "rep")
    groups = classes.select("rep", "weight", "label", "embedding").join(links, "rep", "left").join(label, "rep", "left")
    groups = groups.where("weight > 1 or links is not null").select(
        F.col("label").alias("g_label"), F.col("embedding").alias("g_embedding"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    joined = rows.join(groups, (rows.label == F.col("g_label")) & (rows.embedding == F.col("g_embedding")), "left")
    component = F.coalesce("component", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
