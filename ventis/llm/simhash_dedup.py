"""SimHash near-duplicates: fingerprints of word shingles, linked exactly through a
vantage-point tree.

The tree is built over a bounded sample of fingerprints and cuts the space of 64-bit words into
shards by Hamming distance to vantage points. Each fingerprint lives in one shard and visits
every later shard that a ball of the link radius around it can reach (triangle bounds), so each
linked pair meets in exactly one task. Inside a task the same bounds prune again before pairs
are compared. Tasks report spanning stars, never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ventis.llm.common import Forest, arrow_map, components, parallelism, popcount, utf8
from ventis.session import materialize

SHINGLE_WORDS = 4
RADIUS = 4
BITS = 64
# The sample only places the cuts of the tree; every fingerprint is filed and compared.
TREE_SAMPLE = 8192
SHARD_FINGERPRINTS = 20_000
DENSE_PAIRS = 1 << 22

# For each byte value, its bits spread to eight byte-wide lanes of one word.
_LANES = (
    np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    .view(np.uint64)[:, 0]
)


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of ``size`` words; of all words if there are fewer."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(b" ".join(words), 42)], np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1]
    return np.array(
        [digest(line[a:b], 42) for a, b in zip(starts.tolist(), ends[size - 1:].tolist())],
        np.uint64,
    )


def majority(hashes: np.ndarray) -> int:
    """64-bit word of the bits set in over half of ``hashes``; zero for none."""
    n = len(hashes)
    if not n:
        return 0
    counts = np.zeros(BITS, np.int64)
    raw = hashes.astype("<u8").view(np.uint8).reshape(n, 8)
    for start in range(0, n, 255):
        lanes = _LANES[raw[start:start + 255]].sum(axis=0)
        counts += lanes.view(np.uint8).astype(np.int64)
    bits = np.packbits((2 * counts > n).astype(np.uint8), bitorder="little")
    return int(bits.view("<u8")[0])


def simhash(text: bytes, size: int = SHINGLE_WORDS) -> int:
    return majority(shingle_hashes(text, size))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 size: int = SHINGLE_WORDS) -> DataFrame:
    """Rows (doc_id, fp): the SimHash of each whole text as a signed long."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = [simhash(text, size) for text in utf8(batch.column(1))]
        fps = pa.array(np.array(words, np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays([batch.column(0), fps], ["doc_id", "fp"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(source, run, "doc_id long, fp long")


# --- vantage-point tree -----------------------------------------------------------------------

@dataclass
class Node:
    """Inner node: points with distance to ``vantage`` up to ``cut`` go to ``near``."""

    vantage: int
    cut: int
    near: Node | int
    far: Node | int


def build_tree(sample: np.ndarray, leaves: int, seed: int = 42) -> tuple[Node | int, int]:
    """Tree with about ``leaves`` leaves over the sampled fingerprints, and its leaf count.

    Of a few candidates the vantage point with the widest spread of distances is taken; the cut
    is the median distance. Points that no distance separates stay one leaf.
    """
    rng = np.random.default_rng(seed)
    count = 0

    def grow(points: np.ndarray, wanted: int) -> Node | int:
        nonlocal count
        if wanted > 1 and len(points) > 1:
            tries = points[rng.integers(0, len(points), 8)]
            distances = [popcount(points ^ v) for v in tries]
            best = int(np.argmax([d.std() for d in distances]))
            d = distances[best]
            cut = int(np.median(d))
            if (d <= cut).all():
                cut -= 1
            near = d <= cut
            if near.any() and not near.all():
                return Node(int(tries[best]), cut, grow(points[near], wanted // 2),
                            grow(points[~near], wanted - wanted // 2))
        count += 1
        return count - 1

    root = grow(sample, leaves)
    return root, count


def route(tree: Node | int, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(leaf, index, home) of every leaf that each fingerprint lives in or must visit.

    Of the two shards of a pair the earlier one's point visits, so only later leaves than the
    home leaf are listed.
    """
    home = np.zeros(len(fps), np.int64)
    found: list[tuple[int, np.ndarray]] = []

    def walk(node: Node | int, at: np.ndarray, lives: np.ndarray) -> None:
        if not len(at):
            return
        if not isinstance(node, Node):
            home[at[lives]] = node
            found.append((node, at))
            return
        d = popcount(fps[at] ^ np.uint64(node.vantage)).astype(np.int64)
        near = d <= node.cut
        go = d - radius <= node.cut
        walk(node.near, at[go], (lives & near)[go])
        go = d + radius > node.cut
        walk(node.far, at[go], (lives & ~near)[go])

    walk(tree, np.arange(len(fps)), np.ones(len(fps), bool))
    leaf = np.concatenate([np.full(len(at), k, np.int64) for k, at in found] or [home])
    index = np.concatenate([at for _, at in found] or [home])
    keep = leaf >= home[index]
    leaf, index = leaf[keep], index[keep]
    return leaf, index, leaf == home[index]


def near_pairs(a: np.ndarray, b: np.ndarray, radius: int, same: bool,
               depth: int = 4) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of ``a`` x ``b`` within ``radius``; with ``same``, a is b and i < j.

    Vantage points split both sides by distance; only distances within the radius of each other
    can hold a pair. Small or inseparable blocks are compared densely, a block at a time.
    """
    def dense(ia: np.ndarray, ib: np.ndarray, own: bool):
        step = max(1, DENSE_PAIRS // max(1, len(ib)))
        for start in range(0, len(ia), step):
            rows = ia[start:start + step]
            i, j = np.nonzero(popcount(a[rows][:, None] ^ b[ib][None, :]) <= radius)
            i, j = rows[i], ib[j]
            if own:
                i, j = i[i < j], j[i < j]
            yield i, j

    def split(ia: np.ndarray, ib: np.ndarray, own: bool, left: int):
        if not len(ia) or not len(ib):
            return
        if not left or len(ia) * len(ib) <= DENSE_PAIRS // 4:
            yield from dense(ia, ib, own)
            return
        vantage = a[ia[(0x9E3779B1 * (left + 1)) % len(ia)]]
        da, db = popcount(a[ia] ^ vantage), popcount(b[ib] ^ vantage)
        order = np.argsort(db, kind="stable")
        ib, db = ib[order], db[order]
        for d in np.unique(da):
            rows = ia[da == d]
            if own:
                yield from split(rows, rows, True, left - 1)
            low = int(d) + 1 if own else int(d) - radius
            lo, hi = np.searchsorted(db, low), np.searchsorted(db, int(d) + radius, "right")
            yield from split(rows, ib[lo:hi], False, left - 1)

    yield from split(np.arange(len(a)), np.arange(len(b)), same, depth)


def linked(nodes: DataFrame, radius: int = RADIUS, sample: int = TREE_SAMPLE,
           shard_size: int = SHARD_FINGERPRINTS) -> DataFrame:
    """Links (a long, b long) that span every group of nodes within ``radius`` of each other.

    ``nodes`` has one row (node, fp) per distinct fingerprint.
    """
    drawn = nodes.orderBy(F.xxhash64("fp")).limit(sample).select("fp").collect()
    points = np.array([row["fp"] for row in drawn], np.int64).view(np.uint64)
    leaves = max(parallelism(nodes) // 4, -(-nodes.count() // shard_size), 1)
    tree, _ = build_tree(points, leaves)

    def visit(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = batch.column(1).to_numpy().view(np.uint64)
        leaf, index, home = route(tree, fps, radius)
        return pa.RecordBatch.from_arrays(
            [pa.array(leaf), pa.array(home), batch.column(0).take(pa.array(index)),
             batch.column(1).take(pa.array(index))],
            ["leaf", "home", "node", "fp"])

    def link(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        home = table["home"].to_numpy()
        order = np.argsort(~home, kind="stable")
        own = int(home.sum())
        ids = table["node"].to_numpy()[order]
        fps = table["fp"].to_numpy()[order].view(np.uint64)
        forest = Forest(len(ids))
        for i, j in near_pairs(fps[:own], fps[:own], radius, True):
            forest.add(i, j)
        for i, j in near_pairs(fps[:own], fps[own:], radius, False):
            forest.add(i, j + own)
        label = forest.labels()
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"a": ids[moved], "b": ids[label[moved]]})

    placed = arrow_map(nodes.select("node", "fp"), visit,
                       "leaf long, home boolean, node long, fp long", rows=1 << 16)
    return placed.groupBy("leaf").applyInArrow(link, "a long, b long")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       size: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """Rows (doc_id, fp, component_id), one per document.

    ``component_id`` is the smallest doc_id reachable over links of at most ``radius`` differing
    bits, itself included. Empty and null texts have fingerprint zero and link like any other.
    Repeated rows get equal results. A null id has a fingerprint, links with nothing and has a
    null component.
    """
    found = materialize(fingerprints(docs, id_col, text_col, size), "simhash")
    nodes = materialize(
        found.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node")),
        "simhash-nodes")
    roots = components(linked(nodes, radius), "simhash-links")
    named = nodes.join(roots, "node", "left").select(
        "fp", F.coalesce("root", "node").alias("component_id"))
    return found.join(named, "fp", "left").select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
        .alias("component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         size: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The documents without all but one of each component: that of the smallest id stays.

    Of repeated rows of that id one stays. Rows with a null id are kept as they are. Only rows
    of repeated ids are grouped; all others pass the join alone, so their texts are not sorted.
    The join is a shuffled one at every size: its ids number as many as the documents.
    """
    keep = materialize(
        simhash_components(docs, id_col, text_col, size, radius)
        .filter("doc_id = component_id")
        .groupBy(F.col("doc_id").alias(id_col)).agg(F.count("*").alias("rows")),
        "simhash-kept")

    def of(condition: str) -> DataFrame:
        ids = keep.filter(condition).select(id_col).hint("shuffle_hash")
        return docs.join(ids, id_col, "left_semi")

    repeated = of("rows > 1").dropDuplicates([id_col])
    unnamed = docs.filter(F.col(id_col).isNull())
    return of("rows = 1").unionByName(repeated).unionByName(unnamed)
