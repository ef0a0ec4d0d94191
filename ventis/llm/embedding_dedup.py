"""Embedding near-duplicates by collision-counting projections.

Unit vectors are projected on many fixed random lines. On each line a window of fixed width is
centred on the query; a pair collides on a line if one lies in the other's window. Near pairs
collide on most lines, other pairs on about a third. The first line sorts all vectors into
cells: a vector lives in one cell and visits the later cells that its window reaches, so each
pair meets in one task. There collisions are counted over a first set of lines, then, for pairs
that are still in, over all lines; pairs that reach the calibrated count are verified by their
cosine in double precision. Windows and counts are calibrated so that a pair right at the
threshold is lost with probability of at most MISS.

Equal vectors are compared once. Tasks return link counts and spanning stars, never pairs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ventis.llm.common import Forest, arrow_map, components, parallelism
from ventis.session import materialize

THRESHOLD = 0.95
LINES = 64
FIRST_LINES = 16
WINDOW_SIGMAS = 2.0
MISS = 1e-4
UNITS = 16  # whole numbers per window width
CELL_VECTORS = 20_000
TILE_ROWS, TILE_COLUMNS = 512, 8192


@dataclass(frozen=True)
class Windows:
    """Widths and counts for one cosine threshold."""

    first: float
    width: float
    first_count: int
    count: int

    @classmethod
    def calibrate(cls, threshold: float, miss: float = MISS) -> Windows:
        """The difference of a pair at the threshold on a line is normal with sigma
        sqrt(2 - 2 cos); a third of the allowed misses goes to each of the three tests."""
        sigma = math.sqrt(2 - 2 * threshold)
        normal = NormalDist()
        first = sigma * -normal.inv_cdf(miss / 6)
        hit = 2 * normal.cdf(WINDOW_SIGMAS) - 1

        def least(lines: int) -> int:
            lost = 0.0
            for count in range(lines + 1):
                lost += math.comb(lines, count) * hit ** count * (1 - hit) ** (lines - count)
                if lost > miss / 3:
                    return count
            return lines

        return cls(first, WINDOW_SIGMAS * sigma, least(FIRST_LINES), least(LINES))


def lines(dimensions: int, seed: int = 42) -> np.ndarray:
    """Random directions as columns; the same for every task."""
    return np.random.default_rng([seed, dimensions]).standard_normal((dimensions, LINES))


def _units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row offsets and values of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.array(column.value_lengths(), np.int64)
    return lengths, column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)


def unit_vectors(column: pa.Array, dimensions: int) -> np.ndarray:
    """Vectors of one length, scaled first by their largest component so nothing overflows."""
    _, values = _units(column)
    vectors = values.reshape(-1, dimensions)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def comparable(vector: Column) -> Column:
    """True for a vector that can have a cosine: finite components, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


class _Cell:
    """Pairs of a cell's own vectors with each other and with its visitors."""

    def __init__(self, vectors: np.ndarray, copies: np.ndarray, threshold: float, windows: Windows):
        self.vectors, self.copies = vectors, copies
        self.threshold, self.windows = threshold, windows
        projected = vectors @ lines(vectors.shape[1])
        self.first = projected[:, 0]
        scaled = np.floor(projected * (UNITS / windows.width))
        self.places = np.ascontiguousarray(np.clip(scaled, -30_000, 30_000).astype(np.int16).T)
        self.links = np.zeros(len(vectors), np.int64)
        self.forest = Forest(len(vectors))

    def _candidates(self, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that collide often enough on the first lines; a pair in a window differs by at
        most UNITS + 1 whole units."""
        count = np.zeros((len(rows), len(columns)), np.int8)
        for line in range(FIRST_LINES):
            place = self.places[line]
            gap = place[rows][:, None] - place[columns][None, :]
            np.abs(gap, out=gap)
            count += gap <= UNITS + 1
        return np.nonzero(count >= self.windows.first_count)

    def _tile(self, rows: np.ndarray, columns: np.ndarray, own: bool) -> None:
        i, j = self._candidates(rows, columns)
        i, j = rows[i], columns[j]
        if own:
            i, j = i[i < j], j[i < j]
        for start in range(0, len(i), 1 << 17):
            a, b = i[start:start + (1 << 17)], j[start:start + (1 << 17)]
            gap = np.abs(self.places[:, a] - self.places[:, b])
            often = (gap <= UNITS + 1).sum(axis=0) >= self.windows.count
            a, b = a[often], b[often]
            near = np.einsum("ij,ij->i", self.vectors[a], self.vectors[b]) >= self.threshold
            a, b = a[near], b[near]
            n = len(self.links)
            self.links += np.bincount(a, weights=self.copies[b], minlength=n).astype(np.int64)
            self.links += np.bincount(b, weights=self.copies[a], minlength=n).astype(np.int64)
            self.forest.add(a, b)

    def pair(self, left: np.ndarray, right: np.ndarray, own: bool) -> None:
        """Compare two sets of rows, each sorted by the first line."""
        reach = self.windows.first
        spots = self.first[right]
        for start in range(0, len(left), TILE_ROWS):
            rows = left[start:start + TILE_ROWS]
            low = np.searchsorted(spots, self.first[rows[0]] - reach)
            high = np.searchsorted(spots, self.first[rows[-1]] + reach, "right")
            low = max(low, start) if own else low
            for at in range(low, high, TILE_COLUMNS):
                self._tile(rows, right[at:min(high, at + TILE_COLUMNS)], own)


def near_components(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD, cell_size: int = CELL_VECTORS) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per input row.

    Vectors link if their cosine is at least ``threshold`` and they have the same length. Null or
    zero vectors and vectors with null or non-finite components link with nothing. ``n_links``
    counts other rows; ``component_id`` is the smallest id reachable, itself included; ``kept``
    says that it is the row's own. A row with a null id links with nothing, has a null component
    and is not kept. Repeated rows are copies of each other.
    """
    windows = Windows.calibrate(threshold)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).alias("vector"))
    usable = rows.filter(comparable(F.col("vector")) & F.col("vec_id").isNotNull())
    classes = materialize(
        usable.groupBy("vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")),
        "embedding-classes")

    def project(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths, values = _units(batch.column(2))
        starts = np.cumsum(lengths) - lengths
        spot = np.empty(len(lengths))
        for size in np.unique(lengths):
            at = np.flatnonzero(lengths == size)
            found = values[starts[at][:, None] + np.arange(size)]
            found = found / np.abs(found).max(axis=1, keepdims=True)
            found /= np.linalg.norm(found, axis=1, keepdims=True)
            spot[at] = found @ lines(int(size))[:, 0]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(spot)],
            ["node", "copies", "vector", "spot"])

    kind = classes.schema["vector"].dataType.simpleString()
    placed = materialize(arrow_map(classes.select("node", "copies", "vector"), project,
                                   f"node long, copies long, vector {kind}, spot double", 8192),
                         "embedding-spots")
    cells = max(parallelism(vectors), -(-placed.count() // cell_size))
    found = placed.agg(F.percentile_approx(
        "spot", [i / cells for i in range(1, cells)] or [0.5], 100 * cells)).first()[0]
    cuts = np.unique(np.array(found or [0.0]))

    def visit(batch: pa.RecordBatch) -> pa.RecordBatch:
        spot = batch.column(3).to_numpy()
        home = np.searchsorted(cuts, spot, "right")
        last = np.searchsorted(cuts, spot + windows.first, "right")
        index = np.repeat(np.arange(len(spot)), last - home + 1)
        step = np.arange(len(index)) - np.repeat(np.cumsum(last - home + 1) - (last - home + 1),
                                                 last - home + 1)
        at = pa.array(index)
        return pa.RecordBatch.from_arrays(
            [pa.array(home[index] + step), pa.array(step == 0),
             batch.column(0).take(at), batch.column(1).take(at), batch.column(2).take(at)],
            ["cell", "home", "node", "copies", "vector"])

    def link(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, copies = table["node"].to_numpy(), table["copies"].to_numpy()
        home = table["home"].to_numpy()
        lived = int(table["size"][0].as_py())
        cell = _Cell(unit_vectors(table["vector"], lived), copies, threshold, windows)
        order = np.argsort(cell.first, kind="stable")
        own, visitors = order[home[order]], order[~home[order]]
        # Renumbered by the first line, so that of each own pair the earlier row comes first.
        cell = _Cell(cell.vectors[np.concatenate([own, visitors])],
                     copies[np.concatenate([own, visitors])], threshold, windows)
        ids = ids[np.concatenate([own, visitors])]
        left, right = np.arange(len(own)), np.arange(len(own), len(ids))
        cell.pair(left, left, True)
        cell.pair(left, right, False)
        label = cell.forest.labels()
        moved = np.flatnonzero(label != np.arange(len(label)))
        linked = np.flatnonzero(cell.links)
        return pa.table({
            "a": np.concatenate([ids[moved], ids[linked]]),
            "b": np.concatenate([ids[label[moved]], cell.links[linked]]),
            "star": np.concatenate([np.ones(len(moved), bool), np.zeros(len(linked), bool)])})

    filed = arrow_map(placed, visit,
                      f"cell long, home boolean, node long, copies long, vector {kind}", 8192)
    found_links = materialize(
        filed.withColumn("size", F.size("vector")).groupBy("cell", "size").applyInArrow(
            link, "a long, b long, star boolean"), "embedding-links")
    roots = components(found_links.filter("star").select("a", "b"), "embedding-components")
    counts = found_links.filter("NOT star").groupBy(F.col("a").alias("node")).agg(
        F.sum("b").alias("n"))
    named = (
        classes.join(counts, "node", "left").join(roots, "node", "left")
        .select("vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("root", "node").alias("component_id"))
    )
    done = usable.join(named, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~comparable(F.col("vector")) | F.col("vec_id").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return done.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
