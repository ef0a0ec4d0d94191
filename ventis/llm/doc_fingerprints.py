"""Document fingerprints: one-permutation MinHash with optimal densification.

Each shingle is hashed once; its high bits name a bin and each bin keeps its smallest hash. An
empty bin copies a bin that a fixed hash sequence of the bin's own finds first among the filled
ones. Fingerprints store the low bits of every bin; agreement by chance is taken out of the
likeness.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ventis.llm.common import mix64, parallelism, slices

BIN_BITS = 9
BINS = 1 << BIN_BITS
LOW_BITS = 4
SHINGLE_WORDS = 5
MEMO_WORDS = 500_000
PROBES = 32
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB,
                     0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F], np.uint64)
_MIN_LONG = -(1 << 63)


class _Words(dict):
    """Remembers word hashes; emptied by the caller when full."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _Words()


def shingle_hashes(text: bytes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of the whole sequence if there are fewer."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_WORDS) > MEMO_WORDS:
        _WORDS.clear()
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    total = np.zeros(len(h) - size + 1, np.uint64)
    for at in range(size):
        total += mix64(h[at:len(h) - size + 1 + at] * _FACTORS[at % 5] + np.uint64(at))
    return mix64(total + np.uint64(size))


@lru_cache(maxsize=64)
def _probes(block: int) -> np.ndarray:
    """Bins that each empty bin tries, in order; block after block of PROBES tries."""
    tries = np.arange(block * PROBES, (block + 1) * PROBES, dtype=np.uint64)
    bins = np.arange(BINS, dtype=np.uint64)
    return (mix64(bins[:, None] << np.uint64(32) | tries[None, :]) % np.uint64(BINS)).astype(np.int64)


def densify(bins: np.ndarray) -> np.ndarray:
    """Fill empty bins from filled ones; needs at least one filled bin."""
    filled = bins != _EMPTY
    out = bins.copy()
    todo = np.flatnonzero(~filled)
    block = 0
    while len(todo):
        tries = _probes(block)[todo]
        hit = filled[tries]
        found = hit.any(axis=1)
        out[todo[found]] = bins[tries[found, hit[found].argmax(axis=1)]]
        todo = todo[~found]
        block += 1
    return out


def fingerprint(text: bytes, size: int = SHINGLE_WORDS) -> np.ndarray | None:
    """Low bits of every bin as uint8 values; None for a text without words."""
    hashes = shingle_hashes(text, size)
    if not len(hashes):
        return None
    bins = np.full(BINS, _EMPTY)
    np.minimum.at(bins, (hashes >> np.uint64(64 - BIN_BITS)).astype(np.int64), hashes)
    # Mixed with the bin, so that bins filled from one hash agree by chance independently.
    own = mix64(densify(bins) + np.arange(BINS, dtype=np.uint64))
    return (own & np.uint64((1 << LOW_BITS) - 1)).astype(np.uint8)


def packed(bins: np.ndarray | None) -> str:
    """Two bins per byte in hexadecimal; empty for a text without words."""
    return "" if bins is None else (bins[0::2] << 4 | bins[1::2]).astype(np.uint8).tobytes().hex()


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """Estimated Jaccard similarity of the shingle sets, corrected for chance agreement.

    Two texts without words are alike (1); such a text and another are not (0).
    """
    if a is None or b is None:
        return 1.0 if a is b else 0.0
    chance = 2.0 ** -LOW_BITS
    return float(max(0.0, (np.mean(a == b) - chance) / (1 - chance)))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        size: int = SHINGLE_WORDS) -> DataFrame:
    """Fingerprints of each text and of its edit: the second half replaced from the next document.

    Rows (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next). "Next" is the next row by id (null ids first, rows of one id by text hash), and
    the first row after the last. Null texts are empty texts. A single row is its own next.

    Ids are cut into ranges at values that occur in the table. Each range is sorted in its task
    and gets a copy of the next range's first document, so texts are shuffled once and every
    task streams with one previous document in memory.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_MIN_LONG))
    ranges = 4 * parallelism(docs)
    cuts = docs.select(F.percentile_approx(
        key, [i / ranges for i in range(ranges)], 100 * ranges), F.min(key)).first()
    bounds = np.array(sorted({cuts[1], *cuts[0]}) if cuts[0] else [0], np.int64)

    @F.pandas_udf("own int, guest int")
    def place(keys: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in keys:
            values = series.to_numpy(np.int64)
            own = np.searchsorted(bounds, values, "right") - 1
            first = bounds[own] == values
            guest = pd.Series(np.where(first, (own - 1) % len(bounds), 0), dtype="Int32")
            yield pd.DataFrame({"own": own.astype(np.int32), "guest": guest.where(first)})

    placed = docs.select(
        key.alias("key"), F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"), place(key).alias("at"),
    ).select("*", F.explode(F.array_compact(F.array(
        F.struct(F.col("at.own").alias("part"), F.lit(False).alias("guest")),
        F.when(F.col("at.guest").isNotNull(),
               F.struct(F.col("at.guest").alias("part"), F.lit(True).alias("guest"))),
    ))).alias("to")).select("to.part", "to.guest", "key", "doc_id", "text")
    ordered = placed.repartition(parallelism(docs), "part").sortWithinPartitions(
        "part", "guest", "key", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in slices(batches):
            rows: list[tuple] = []
            columns = [batch.column(i).to_pylist() for i in (0, 1, 3, 4)]
            for part, guest, doc, text in zip(*columns):
                same = held is not None and held[0] == part
                if same and held[4]:
                    continue  # Only the first guest is the next document of a range's last.
                bins = fingerprint(text.encode(), size)
                if same:
                    rows.append(_compared(held, text, bins, size))
                held = (part, doc, text, bins, guest)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _OUT)

    return ordered.mapInArrow(run, ", ".join(
        f"{f.name} {_SQL_TYPES[str(f.type)]}" for f in _OUT))


_OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()),
])
_SQL_TYPES = {"int64": "long", "string": "string", "double": "double"}


def _compared(held: tuple, next_text: str, next_bins: np.ndarray | None, size: int) -> dict:
    _, doc, text, bins, _ = held
    half = len(text) // 2
    edited = (text[:len(text) - half] + next_text[:half]).encode()
    edited_bins = fingerprint(edited, size)
    return {
        "doc_id": doc, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited).hexdigest(),
        "fingerprint": packed(bins), "edited_fingerprint": packed(edited_bins),
        "near_edited": likeness(bins, edited_bins), "near_next": likeness(bins, next_bins),
    }
