"""Near-duplicate vectors by the epsilon grid order join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwell.llm.common import components, map_batches, settle

COSINE = 0.98
#: Leading principal dimensions that the grid lies in.
GRID_DIMENSIONS = 8
#: Vectors of a block: an interval of the grid order that travels as one row.
BLOCK = 1024
#: Intervals of at most so many vectors are compared by one matrix product.
LEAF = 64


def _unit(matrix: np.ndarray) -> np.ndarray:
    """Unit rows in double precision; scaled first, so that huge and tiny values survive."""
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _stacked(vectors: list[list[float]]) -> dict[int, tuple[list[int], np.ndarray]]:
    """Rows by their number of components."""
    by_size: dict[int, list[int]] = {}
    for i, v in enumerate(vectors):
        by_size.setdefault(len(v), []).append(i)
    return {n: (rows, _unit(np.array([vectors[i] for i in rows], np.float64))) for n, rows in by_size.items()}


def _axes(vectors: DataFrame, most: int) -> dict[int, np.ndarray]:
    """Leading principal axes, by the number of components.

    Each task sums the outer products of its vectors; the sums of all tasks meet as one
    square matrix for each number of components.
    """

    def moments(batches: Iterator[dict]) -> Iterator[dict]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for size, (_, unit) in _stacked(b["vector"]).items():
                sums[size] = sums.get(size, 0) + unit.T @ unit
        yield {"size": list(sums), "moment": [m.tobytes() for m in sums.values()]}

    def total(pdf):
        import pandas as pd

        both = sum(np.frombuffer(m) for m in pdf["moment"])
        size = int(pdf["size"].iloc[0])
        values, axes = np.linalg.eigh(both.reshape(size, size))
        return pd.DataFrame({"size": [size], "moment": [np.ascontiguousarray(axes[:, ::-1][:, :most]).tobytes()]})

    made = map_batches(vectors.select("vector"), moments, "size int, moment binary")
    found = made.groupBy("size").applyInPandas(total, "size int, moment binary").collect()
    return {r["size"]: np.frombuffer(r["moment"]).reshape(r["size"], -1) for r in found}


def _far(low_a, high_a, low_b, high_b, reach: float) -> bool:
    """Whether two boxes are provably further apart than `reach`."""
    gap = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
    return float(gap @ gap) > reach * reach


class Links:
    """Links among the vectors of one or two blocks: weighted counts and a spanning forest."""

    def __init__(self, vectors: np.ndarray, places: np.ndarray, weights: np.ndarray, cosine: float) -> None:
        self.vectors, self.places, self.weights, self.cosine = vectors, places, weights, cosine
        self.reach = math.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-6
        self.counts = np.zeros(len(vectors), np.int64)
        self.label = np.arange(len(vectors))
        self.forest: list[tuple[int, int]] = []
        self.boxes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def box(self, interval: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        if interval not in self.boxes:
            part = self.places[interval[0] : interval[1]]
            self.boxes[interval] = part.min(0), part.max(0)
        return self.boxes[interval]

    def join(self, a: tuple[int, int], b: tuple[int, int]) -> None:
        """Join two intervals of the order; halve the longer one until both are leaves."""
        if a != b and _far(*self.box(a), *self.box(b), self.reach):
            return
        if max(a[1] - a[0], b[1] - b[0]) <= LEAF:
            self.compare(a, b)
        elif a == b:
            middle = (a[0] + a[1]) // 2
            left, right = (a[0], middle), (middle, a[1])
            self.join(left, left)
            self.join(left, right)
            self.join(right, right)
        elif a[1] - a[0] >= b[1] - b[0]:
            middle = (a[0] + a[1]) // 2
            self.join((a[0], middle), b)
            self.join((middle, a[1]), b)
        else:
            middle = (b[0] + b[1]) // 2
            self.join(a, (b[0], middle))
            self.join(a, (middle, b[1]))

    def compare(self, a: tuple[int, int], b: tuple[int, int]) -> None:
        near = self.vectors[a[0] : a[1]] @ self.vectors[b[0] : b[1]].T >= self.cosine
        if a == b:
            np.fill_diagonal(near, False)
        if not near.any():
            return
        self.counts[a[0] : a[1]] += near @ self.weights[b[0] : b[1]]
        if a != b:
            self.counts[b[0] : b[1]] += self.weights[a[0] : a[1]] @ near
        for i, row in enumerate(near, a[0]):
            others = np.flatnonzero(row) + b[0]
            apart = others[self.label[others] != self.label[i]]
            for j in apart:
                if self.label[j] != self.label[i]:
                    self.forest.append((i, int(j)))
                    self.label[self.label == self.label[j]] = self.label[i]


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cosine: float = COSINE,
    grid_dimensions: int = GRID_DIMENSIONS,
    block: int = BLOCK,
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    Two rows link when their labels are equal and not NULL, their vectors have as many
    components and the cosine is `cosine` or more, in double precision. NULL and empty
    vectors, zero vectors, and vectors with a NULL or non-finite component link with
    nothing and are components of their own. `n_links` counts other rows linked directly,
    `component_id` is the smallest id reachable by links (a NULL id only where there is no
    other), and `kept` says whether that is the row's own id. Repeated ids are rows of
    their own, other columns are not read, an empty table gives no rows.

    Rows with equal vectors and labels are one class with a weight. Classes are sorted by
    label and by the cells, as wide as the largest distance of a link, of a grid in the
    leading principal dimensions. Intervals of that order are blocks. Two blocks meet only
    if their boxes in the grid's dimensions are near enough: a projection never makes a
    distance larger, so what is skipped is provably distant. A task joins two blocks
    recursively; it gives out counts and a spanning forest, not the links themselves.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_col).alias("key"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("group")
    )
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("group").isNotNull() & F.col("vector").isNotNull() & ~bad & F.exists("vector", lambda x: x != 0)
    name = F.xxhash64("group", F.transform("vector", lambda x: x + 0.0))
    rows = rows.withColumn("class", F.when(F.coalesce(usable, F.lit(False)), name))
    kinds = dict(rows.dtypes)
    classes = settle(
        rows.where("class is not null").groupBy("class").agg(
            F.first("group").alias("group"), F.first("vector").alias("vector"), F.count("*").alias("weight"), F.min("key").alias("key")
        ),
        "vector-classes",
    )
    axes = _axes(classes, grid_dimensions)
    reach = math.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-6

    def locate(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            cells: list = [None] * len(b["class"])
            for size, (at, unit) in _stacked(b["vector"]).items():
                grid = np.floor(unit @ axes[size] / reach).astype(np.int32)
                for i, cell in zip(at, grid.tolist()):
                    cells[i] = [size, *cell]
            yield b | {"cells": cells}

    located = map_batches(
        classes.select("class", "group", "vector", "weight"), locate,
        f"class bigint, group {kinds['group']}, vector array<double>, weight bigint, cells array<int>",
    )
    order = ["group", *[F.get("cells", F.lit(i)) for i in range(grid_dimensions + 1)], "class"]
    sorted_ = located.repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(batches: Iterator[dict]) -> Iterator[dict]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        at = None
        for b in batches:
            made = []
            for name, group, vector, weight, cells in zip(*[b[c] for c in ("class", "group", "vector", "weight", "cells")]):
                if held and ((group, cells[0]) != at or len(held) == block):
                    made.append((number := number + 1, *at, held))
                    held = []
                at = (group, cells[0])
                held.append((name, vector, weight))
            if made:
                yield as_blocks(made)
        if held:
            yield as_blocks([(number + 1, *at, held)])

    def as_blocks(made: list[tuple]) -> dict:
        out: dict[str, list] = {n: [] for n in ("block", "group", "size", "names", "weights", "vectors", "low", "high")}
        for number, group, size, held in made:
            unit = _unit(np.array([v for _, v, _ in held], np.float64))
            places = unit @ axes[size]
            low, high = np.zeros(grid_dimensions), np.zeros(grid_dimensions)
            low[: places.shape[1]], high[: places.shape[1]] = places.min(0), places.max(0)
            values = (
                number, group, size, np.array([n for n, _, _ in held], np.int64).tobytes(),
                np.array([w for _, _, w in held], np.int64).tobytes(), unit.tobytes(), low, high,
            )
            for column, value in zip(out.values(), values):
                column.append(value)
        return out

    blocks = settle(
        map_batches(
            sorted_, cut,
            f"block bigint, group {kinds['group']}, size int, names binary, weights binary, vectors binary,"
            " low array<double>, high array<double>",
        ),
        "vector-blocks",
    )
    # blocks are near only if they reach into a common slice of the first dimension, made wider by the reach
    slices = F.sequence(F.floor((F.col("low")[0] - reach) / reach), F.floor(F.col("high")[0] / reach))
    boxes = blocks.select("block", "group", "size", "low", "high", F.explode(slices).alias("slice"))
    left = boxes.select("group", "size", "slice", *[F.col(c).alias(f"{c}_a") for c in ("block", "low", "high")])
    right = boxes.select("group", "size", "slice", *[F.col(c).alias(f"{c}_b") for c in ("block", "low", "high")])
    gaps = F.transform(
        F.sequence(F.lit(1), F.lit(grid_dimensions)),
        lambda i: F.greatest(
            F.lit(0.0),
            F.element_at("low_a", i) - F.element_at("high_b", i),
            F.element_at("low_b", i) - F.element_at("high_a", i),
        ),
    )
    distance = F.aggregate(gaps, F.lit(0.0), lambda total, g: total + g * g)
    pairs = (
        left.join(right, ["group", "size", "slice"])
        .where((F.col("block_a") <= F.col("block_b")) & (distance <= reach * reach))
        .select("block_a", "block_b")
        .distinct()
    )
    load = {c: F.col(c) for c in ("names", "weights", "vectors")}
    met = pairs.join(
        blocks.select(F.col("block").alias("block_a"), "size", *[c.alias(f"{n}_a") for n, c in load.items()]), "block_a"
    ).join(blocks.select(F.col("block").alias("block_b"), *[c.alias(f"{n}_b") for n, c in load.items()]), "block_b")

    def compare(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            for i, size in enumerate(b["size"]):
                same = b["block_a"][i] == b["block_b"][i]
                sides = ("a",) if same else ("a", "b")
                names, weights = (
                    np.concatenate([np.frombuffer(b[f"{c}_{s}"][i], np.int64) for s in sides]) for c in ("names", "weights")
                )
                unit = np.concatenate([np.frombuffer(b[f"vectors_{s}"][i]).reshape(-1, size) for s in sides])
                links = Links(unit, unit @ axes[size], weights, cosine)
                middle = len(b["names_a"][i]) // 8
                links.join((0, middle), (0, middle) if same else (middle, len(names)))
                linked = np.flatnonzero(links.counts)
                forest = np.array(links.forest, np.int64).reshape(-1, 2)
                yield {
                    "a": np.concatenate([names[linked], names[forest[:, 0]]]),
                    "b": [None] * len(linked) + names[forest[:, 1]].tolist(),
                    "n": np.concatenate([links.counts[linked], np.zeros(len(forest), np.int64)]),
                }

    wanted = met.select("block_a", "block_b", "size", *[f"{c}_{s}" for c in load for s in "ab"])
    found = settle(map_batches(wanted, compare, "a bigint, b bigint, n bigint"), "vector-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    label = components(found.where("b is not null").select("a", "b")).withColumnsRenamed({"node": "class", "component": "part"})
    named = classes.select("class", "weight", "key").join(label, "class", "left").withColumn("part", F.coalesce("part", "class"))
    named = named.join(counts, "class", "left")
    smallest = named.groupBy("part").agg(F.min("key").alias("component_id"))
    of_class = named.join(smallest, "part").select(
        "class", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id"
    )
    full = rows.where("class is not null").select("key", "class").join(of_class, "class").select("key", "n_links", "component_id")
    bare = rows.where("class is null").select("key", F.lit(0).cast("bigint").alias("n_links"), F.col("key").alias("component_id"))
    return full.unionByName(bare).select(
        F.col("key").alias(id_col), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept")
    )
