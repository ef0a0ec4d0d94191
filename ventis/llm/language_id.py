"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts become runs of lower-cased letters with one break between runs. All 1- to 3-grams are
hashed into a fixed number of buckets. Training adds up bucket counts per language over all
training documents; the matrix of log probabilities has buckets x languages entries, whatever
the corpus size, and is broadcast. Documents are scored in numpy by their sparse bucket counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ventis.llm.common import SLICE_ROWS, release, resident, slices

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
SMOOTHING = 0.5
UNDETERMINED = "und"
PARTS = 16
CHUNK_CHARS = 1 << 20
# Rows whose n-grams are counted together: one pass over the buckets for all of them.
TRAIN_ROWS = 128


def _letter_table() -> np.ndarray:
    """Code point to lower-cased letter, 0 for anything else."""
    table = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            table[point] = ord(char.lower()[0])
    return table


def _letters() -> np.ndarray:
    return resident(("letters",), _letter_table)


def ngram_buckets(text: str) -> np.ndarray:
    """Bucket of every 1-, 2- and 3-gram of a text; empty if it has no letter."""
    parts = []
    seen = False
    carry = np.zeros(2, np.uint32)
    for start in range(0, len(text), CHUNK_CHARS):
        raw = np.frombuffer(text[start:start + CHUNK_CHARS].encode("utf-32-le"), "<u4")
        chars = _letters()[raw]
        letter = chars != 0
        seen = seen or bool(letter.any())
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] |= carry[1] != 0
        c = np.concatenate((carry, chars[keep]))
        if start + CHUNK_CHARS >= len(text) and c[-1]:
            c = np.append(c, np.uint32(0))
        carry = c[-2:]
        one = c * np.uint32(0x9E3779B1)
        two = one[:-1] ^ (c[1:] * np.uint32(0x85EBCA77) + np.uint32(1))
        three = (two[:-1] * np.uint32(5)) ^ (c[2:] * np.uint32(0xC2B2AE3D) + np.uint32(2))
        for grams in (one[2:][c[2:] != 0], two[1:], three):
            grams = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            parts.append(grams >> np.uint32(32 - BUCKET_BITS))
    if not seen:
        return np.empty(0, np.uint32)
    return np.concatenate(parts)


@dataclass
class Model:
    """Languages, their log priors, and log probabilities as a (bucket, language) matrix."""

    languages: list[str]
    prior: np.ndarray
    matrix: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float]:
        grams = ngram_buckets(text or "")
        if not len(grams) or not self.languages:
            return UNDETERMINED, 0.0
        total = self.prior.copy()
        for start in range(0, len(grams), CHUNK_CHARS):
            part = self.matrix[grams[start:start + CHUNK_CHARS]]
            total += part.sum(axis=0, dtype=np.float64)
        best = int(np.argmax(total))
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Model of all rows with a language. Only sums per language reach the driver.

    Rows with a null language teach nothing; a text without letters only counts for the prior.
    Without any labelled row the model has no language and predicts ``und``.
    """
    def count(batches):
        counts: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in slices(batches, TRAIN_ROWS):
            grams: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams.setdefault(lang, []).append(ngram_buckets(text or ""))
                rows[lang] = rows.get(lang, 0) + 1
            for lang, parts in grams.items():
                if lang not in counts:
                    counts[lang] = np.zeros(BUCKETS, np.int64)
                counts[lang] += np.bincount(np.concatenate(parts), minlength=BUCKETS)
        for lang, sums in counts.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * PARTS), pa.array(range(PARTS), pa.int32()),
                pa.array([rows[lang]] * PARTS, pa.int64()),
                pa.array([x.tobytes() for x in sums.reshape(PARTS, -1)], pa.binary()),
            ], ["lang", "part", "rows", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(BUCKETS // PARTS, np.int64)
        for counts in table["counts"].to_pylist():
            total += np.frombuffer(counts, np.int64)
        rows = sum(table["rows"].to_pylist())
        return pa.table({"lang": table["lang"][:1], "part": table["part"][:1],
                         "rows": pa.array([rows], pa.int64()),
                         "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "lang string, part int, rows long, counts binary"
    labelled = docs.select(F.col(lang_col).cast("string").alias("lang"),
                           F.col(text_col).alias("text")).filter("lang IS NOT NULL")
    sums = labelled.mapInArrow(count, schema).groupBy("lang", "part").applyInArrow(add, schema)
    found = sorted(sums.collect(), key=lambda row: (row["lang"], row["part"]))
    languages = sorted({row["lang"] for row in found})
    matrix = np.zeros((BUCKETS, len(languages)))
    rows = np.zeros(len(languages))
    for row in found:
        at, part = languages.index(row["lang"]), row["part"] * (BUCKETS // PARTS)
        matrix[part:part + BUCKETS // PARTS, at] = np.frombuffer(row["counts"], np.int64)
        rows[at] = row["rows"]
    matrix = np.log(matrix + SMOOTHING) - np.log((matrix + SMOOTHING).sum(axis=0))
    return Model(languages, np.log(rows / max(1, rows.sum())), matrix.astype(np.float32))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All rows with ``lang_pred`` and ``score``, the posterior probability of that language.

    A text that is null or has no letter gets ``und`` and score 0. Repeated rows get equal results,
    an empty table gives no row; input columns of any other name are carried as they are.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def result(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            found = []
            for start in range(0, len(column), SLICE_ROWS):
                found += map(shared.value.predict, column.slice(start, SLICE_ROWS).to_pylist())
            langs, scores = zip(*found) if found else ((), ())
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["lang_pred", "score"])
        release()

    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    row = F.struct(*(F.col(c).alias(str(at)) for at, c in enumerate(kept))) if kept else F.lit(None)
    return docs.select(row.alias("row"), result(F.col(text_col)).alias("found")).select(
        *(F.col("row")[str(at)].alias(c) for at, c in enumerate(kept)),
        "found.lang_pred", "found.score")


def fold(id_col: str = "doc_id", parts: int = 5) -> Column:
    """Stable fold of a document: CRC-32 of the id as text, modulo ``parts``; null for no id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts
