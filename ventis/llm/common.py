"""Helpers shared by the corpus operators.

Conventions of every operator here:

* A null text counts as the empty text. Texts are read whole.
* Words are runs of anything but the six ASCII white-space characters; only A-Z is lower-cased.
* An input column with the name of an output column is replaced by it; all others are carried.
* Repeated rows stay repeated rows; an empty table gives an empty table with the same columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ventis.session import materialize

# Rows handed to numpy at once; texts of a slice are the only texts a task holds as objects.
SLICE_ROWS = 512
_RESIDENT: dict[tuple[str, ...], object] = {}


def parallelism(df: DataFrame) -> int:
    """Shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def resident(key: tuple[str, ...], build: Callable[[], object]):
    """The one table or model that a Python worker keeps between tasks; another key replaces it,
    so a worker that serves several operators does not pile up their memories."""
    if key not in _RESIDENT:
        _RESIDENT.clear()
        _RESIDENT[key] = build()
    return _RESIDENT[key]


def release() -> None:
    """Give Arrow's unused memory back; an idle worker should not hold on to its last batches."""
    pa.default_memory_pool().release_unused()


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def arrow_map(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None],
              schema: str, rows: int = SLICE_ROWS) -> DataFrame:
    """Apply ``function`` to slices of a few hundred rows, one after the other, in each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, rows):
            out = function(piece)
            if out is not None and out.num_rows:
                yield out
        release()
    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_binary(column.type):
        column = column.cast(pa.binary())
    return [text or b"" for text in column.to_pylist()]


def numbers(column: pa.Array, fill: int = 0) -> np.ndarray:
    """A long column as int64, null as ``fill``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.fill_null(fill).to_numpy(zero_copy_only=False).astype(np.int64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def local_components(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes, by hooking and pointer jumping."""
    label = np.arange(n, dtype=np.int64)
    while True:
        a, b = label[left], label[right]
        apart = a != b
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(a[apart], b[apart]), np.minimum(a[apart], b[apart]))
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped


class Forest:
    """Collects links between ``n`` nodes and keeps no more than a few per node."""

    def __init__(self, n: int, limit: int = 2_000_000):
        self.n, self.limit, self.held = n, limit, 0
        self.left: list[np.ndarray] = []
        self.right: list[np.ndarray] = []

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        if len(left):
            self.left.append(left)
            self.right.append(right)
            self.held += len(left)
            if self.held > self.limit:
                self._reduce()

    def _reduce(self) -> None:
        label = self.labels()
        nodes = np.flatnonzero(label != np.arange(self.n))
        self.left, self.right, self.held = [nodes], [label[nodes]], len(nodes)
        self.limit = max(self.limit, 2 * self.held)

    def labels(self) -> np.ndarray:
        if not self.left:
            return np.arange(self.n, dtype=np.int64)
        return local_components(self.n, np.concatenate(self.left), np.concatenate(self.right))


def components(links: DataFrame, label: str) -> DataFrame:
    """Component of every node named by ``links`` (a long, b long): rows (node, root).

    ``root`` is the smallest id reachable. Rounds of large-star and small-star steps move links
    towards the smallest neighbour until every component is a star. A node's neighbours are
    reduced by a map-side combined minimum and a join, so a hub is never gathered in one task.
    Each round is written to the shared folder, which cuts the lineage. The driver sees one
    count and one checksum per round, never links.
    """
    def star(edges: DataFrame, small: bool) -> DataFrame:
        if small:
            seen = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        else:
            seen = edges.select("a", "b").union(edges.select("b", "a"))
        least = seen.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        joined = seen.join(least, "a")
        if small:
            moved = joined.select(F.col("b").alias("x"), "m").union(joined.select("a", "m"))
        else:
            moved = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("x"), "m")
        return moved.filter("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct()

    edges = materialize(links.filter("a <> b").select("a", "b").distinct(), label)
    before = None
    while True:
        edges = materialize(star(star(edges, small=False), small=True), label)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if now == before:
            break
        before = now
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
