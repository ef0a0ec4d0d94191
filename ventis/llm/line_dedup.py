"""Line dedup: lines repeated across many documents stay only in the last document.

Line keys are hashed to 128 bits. Each shard of the hash space holds its distinct hashes in a
minimal perfect hash that indexes arrays of fingerprints, document counts and last documents.
Groups of documents send the distinct hashes of their lines to the shards, which are probed by
array position, and get back only the hashes to drop; line texts are never shuffled or joined.
A line that is in every document costs one entry per group, not one per document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ventis.llm.common import mix64, numbers, parallelism, utf8

MIN_CHARS = 40
MIN_DOCS = 5
GROUP_DOCS = 500
KEY = np.dtype([("a", "<u8"), ("b", "<u8")])
NULL_ID = np.iinfo(np.int64).min


# --- minimal perfect hash ---------------------------------------------------------------------

def _spread(keys: np.ndarray, level: int) -> np.ndarray:
    return mix64(keys["a"] ^ mix64(keys["b"] + np.uint64(level)))


@dataclass
class PerfectHash:
    """Maps each of n distinct 128-bit keys to its own position 0..n-1.

    Level by level, keys that are alone on a bit of the level's bit array settle there; the
    others go on to the next level. A key's position is the number of set bits before its own.
    """

    levels: list[np.ndarray]
    before: list[np.ndarray]

    @classmethod
    def build(cls, keys: np.ndarray, gamma: float = 2.0) -> PerfectHash:
        levels, before, total = [], [], 0
        while len(keys):
            size = max(64, int(len(keys) * gamma))
            place = (_spread(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            bits = np.bincount(place, minlength=size) == 1
            rank = np.cumsum(bits) - bits + total
            levels.append(bits)
            before.append(rank)
            total += int(bits.sum())
            keys = keys[~bits[place]]
        return cls(levels, before)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Positions; -1 for a key that settles on no level (a stranger)."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (bits, rank) in enumerate(zip(self.levels, self.before)):
            if not len(open_):
                break
            place = (_spread(keys[open_], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[place]
            out[open_[hit]] = rank[place[hit]]
            open_ = open_[~hit]
        return out


@dataclass
class LineIndex:
    """Compact arrays over the distinct line hashes of a shard, by perfect-hash position."""

    position: PerfectHash
    fingerprint: np.ndarray
    docs: np.ndarray
    last: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray, docs: np.ndarray, last: np.ndarray) -> LineIndex:
        """Sum counts and take the largest document of each distinct key."""
        order = np.lexsort((keys["b"], keys["a"]))
        keys, docs, last = keys[order], docs[order], last[order]
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        distinct = keys[starts]
        position = PerfectHash.build(distinct)
        slot = position.find(distinct)
        index = cls(position, np.empty(len(slot), np.uint32), np.empty(len(slot), np.int64),
                    np.empty(len(slot), np.int64))
        index.fingerprint[slot] = distinct["b"] >> np.uint64(32)
        index.docs[slot] = np.add.reduceat(docs, starts)
        index.last[slot] = np.maximum.reduceat(last, starts)
        return index

    def probe(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document count (0 for strangers) and last document of each key."""
        slot = self.position.find(keys)
        known = slot >= 0
        known[known] = self.fingerprint[slot[known]] == (keys["b"][known] >> np.uint64(32))
        docs, last = np.zeros(len(keys), np.int64), np.full(len(keys), NULL_ID, np.int64)
        docs[known], last[known] = self.docs[slot[known]], self.last[slot[known]]
        return docs, last


# --- documents --------------------------------------------------------------------------------

def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of the stripped, lower-cased line; None if it is too short to count."""
    key = line.strip().lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def _group_lines(table: pa.Table, shards: int, min_chars: int) -> pa.Table:
    """Per shard, the distinct line hashes of a group with document count and last document."""
    hashes, owners = [], []
    for doc, text in zip(numbers(table["id"], NULL_ID).tolist(), utf8(table["text"])):
        if len(text) >= min_chars:
            keys = {line_key(line, min_chars) for line in text.split(b"\n")}
            keys.discard(None)
            hashes.extend(keys)
            owners.extend([doc] * len(keys))
    keys = np.frombuffer(b"".join(hashes), KEY)
    owner = np.array(owners, np.int64)
    shard = (keys["a"] % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((owner, keys["b"], keys["a"], shard))
    keys, owner, shard = keys[order], owner[order], shard[order]
    new_key = np.ones(len(keys), bool)
    new_key[1:] = keys[1:] != keys[:-1]
    new_doc = new_key.copy()
    new_doc[1:] |= owner[1:] != owner[:-1]
    starts = np.flatnonzero(new_key)
    if not len(starts):
        return pa.table({"shard": pa.array([], pa.int64()), "grp": pa.array([], pa.int64()),
                         "keys": pa.array([], pa.binary()), "docs": pa.array([], pa.binary()),
                         "last": pa.array([], pa.binary())})
    docs = np.add.reduceat(new_doc.astype(np.int64), starts)
    last = np.maximum.reduceat(owner, starts)
    keys, shard = keys[starts], shard[starts]
    cuts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1])))
    ends = np.append(cuts[1:], len(keys))
    return pa.table({
        "shard": shard[cuts],
        "grp": np.full(len(cuts), table["grp"][0].as_py(), np.int64),
        "keys": pa.array([keys[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
        "docs": pa.array([docs[a:b].astype("<i4").tobytes() for a, b in zip(cuts, ends)],
                         pa.binary()),
        "last": pa.array([last[a:b].astype("<i8").tobytes() for a, b in zip(cuts, ends)],
                         pa.binary()),
    })


def _probe_shard(table: pa.Table, min_docs: int) -> pa.Table:
    """Build a shard's arrays from all groups, then answer each group with its repeated hashes."""
    parts = [np.frombuffer(x, KEY) for x in table["keys"].to_pylist()]
    docs = np.concatenate([np.frombuffer(x, "<i4") for x in table["docs"].to_pylist()])
    last = np.concatenate([np.frombuffer(x, "<i8") for x in table["last"].to_pylist()])
    index = LineIndex.build(np.concatenate(parts), docs.astype(np.int64), last)
    groups, drops, keepers = [], [], []
    for group, keys in zip(table["grp"].to_pylist(), parts):
        count, keeper = index.probe(keys)
        drop = count >= min_docs
        if drop.any():
            groups.append(group)
            drops.append(keys[drop].tobytes())
            keepers.append(keeper[drop].astype("<i8").tobytes())
    return pa.table({"grp": pa.array(groups, pa.int64()), "keys": pa.array(drops, pa.binary()),
                     "last": pa.array(keepers, pa.binary())})


def _drop_lines(docs: pa.Table, answers: pa.Table, min_chars: int) -> pa.Table:
    """Texts of a group without the lines that another document keeps."""
    keeper: dict[bytes, int] = {}
    for keys, last in zip(answers["keys"].to_pylist(), answers["last"].to_pylist()):
        split = (keys[i:i + KEY.itemsize] for i in range(0, len(keys), KEY.itemsize))
        keeper.update(zip(split, np.frombuffer(last, "<i8").tolist()))
    texts, lines, dropped = [], [], []
    for doc, text in zip(numbers(docs["id"], NULL_ID).tolist(), utf8(docs["text"])):
        parts = text.split(b"\n")
        kept = parts
        if keeper and len(text) >= min_chars:
            kept = [x for x in parts
                    if (key := line_key(x, min_chars)) is None or keeper.get(key, doc) == doc]
        texts.append(text if len(kept) == len(parts) else b"\n".join(kept))
        lines.append(len(parts))
        dropped.append(len(parts) - len(kept))
    out = {"n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(dropped, pa.int64()),
           "text": pa.array(texts, pa.binary()).cast(pa.string())}
    return pa.table({"row": docs["row"], **out})


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                group_docs: int = GROUP_DOCS) -> DataFrame:
    """All rows with repeated lines cut from their texts, plus n_lines and n_dropped.

    A line's key is the line stripped of ASCII white space, A-Z lower-cased. A key of at least
    ``min_chars`` code points in at least ``min_docs`` documents (distinct ids) loses its lines
    in all documents but that of the largest id; there every occurrence stays. A null or empty
    text is one empty line and comes back empty. Rows of one id are one document; null ids are
    one document that is smaller than all others.
    """
    others: list[str] = [c for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")]
    rows = docs.count()
    groups = max(1, -(-rows // group_docs))
    width = parallelism(docs)
    shards = max(width, rows // 50_000)
    placed = docs.select(
        F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(groups)).alias("grp"),
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
        F.struct(*others).alias("row"),
    ).repartition(width, "grp")
    row_type = placed.schema["row"].dataType.simpleString()

    def send(table: pa.Table) -> pa.Table:
        return _group_lines(table, shards, min_chars)

    def answer(table: pa.Table) -> pa.Table:
        return _probe_shard(table, min_docs)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        return _drop_lines(left, right, min_chars)

    sent = placed.groupBy("grp").applyInArrow(
        send, "shard long, grp long, keys binary, docs binary, last binary")
    answers = sent.groupBy("shard").applyInArrow(answer, "grp long, keys binary, last binary")
    done = placed.groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(
        cut, f"row {row_type}, n_lines long, n_dropped long, text string")
    columns: list[Column] = [
        F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c)
        for c in docs.columns if c not in ("n_lines", "n_dropped")
    ]
    return done.select(*columns, "n_lines", "n_dropped")
