"""Phrase collocations: frequent n-grams by Misra-Gries summaries, then exact counts.

First pass: blocks of documents summarise the hashes of their 1- to 3-grams and send them to hash
partitions. Each partition merges the blocks' summaries into one Misra-Gries summary whose
capacity exceeds its mass divided by the threshold, so no hash of a frequent n-gram is lost, and
answers every block with the hashes that may be frequent. Second pass: blocks count the words
themselves of those n-grams, and Spark adds the counts up. A collision of hashes therefore costs
an extra count, never a wrong one. A phrase that is in every document costs an entry per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ventis.llm.common import mix64, parallelism, utf8
from ventis.session import materialize

MAX_WORDS = 3
MIN_COUNT = 10
TOP = 2000
SCALE = 1_000_000
# A candidate goes if a longer one around it has at least this percentage of its occurrences.
COVERED_PERCENT = 50
BLOCK_BYTES = 8 << 20
# n-gram occurrences a hash partition sums up; its summary holds a tenth as many counters.
SHARD_BYTES = 4 << 20
NO_LANG = "und"

BREAK = b"."
# A-Z lower-cased, tab as space, piece ends as one mark that no word can hold.
_FOLD = bytes(
    ord(BREAK) if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b in (9, 32)
    else b + 32 if 65 <= b <= 90 else b for b in range(256)
)


class Words(dict):
    """Numbers words in order of first sight; the mark between pieces is 0."""

    def __init__(self):
        super().__init__({BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def tokens(texts: list[bytes], words: Words) -> np.ndarray:
    """Word numbers of all texts, with 0 between pieces and between texts."""
    parts = [np.zeros(1, np.int64)]
    for text in texts:
        split = text.translate(_FOLD).replace(BREAK, b" . ").split()
        parts.append(np.fromiter(map(words.__getitem__, split), np.int64, len(split)))
        parts.append(np.zeros(1, np.int64))
    return np.concatenate(parts)


class Grams:
    """The n-grams of one language of a block: where each starts, and its hash."""

    def __init__(self, lang: str, texts: list[bytes]):
        self.lang, words = lang, Words()
        self.ids = tokens(texts, words)
        self.words = list(words)
        digest = xxhash.xxh64_intdigest
        self.hash_of = np.fromiter(map(digest, self.words), np.uint64, len(self.words))
        self.seed = np.uint64(digest(lang.encode()))

    def sizes(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, starts, hashes) of the n-grams of each size."""
        starts = np.flatnonzero(self.ids)
        hashes = mix64(self.hash_of[self.ids[starts]] ^ self.seed)
        for size in range(1, longest + 1):
            yield size, starts, hashes
            longer = starts + size < len(self.ids)
            longer[longer] = self.ids[starts[longer] + size] != 0
            starts = starts[longer]
            following = self.hash_of[self.ids[starts + size]]
            hashes = mix64(hashes[longer] * np.uint64(3) + following)

    def exact(self, size: int, starts: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Distinct n-grams that start at ``starts``, as text, and how often each does."""
        number = self.ids[starts]
        for step in range(1, size):
            # Numbers stay below the square of the block's words: renumber before the next word.
            _, number = np.unique(number, return_inverse=True)
            number = number * len(self.words) + self.ids[starts + step]
        _, first, count = np.unique(number, return_index=True, return_counts=True)
        runs = self.ids[starts[first][:, None] + np.arange(size)].tolist()
        return [b" ".join([self.words[i] for i in run]).decode() for run in runs], count


def by_language(table: pa.Table) -> Iterator[tuple[str, list[bytes]]]:
    rows: dict[str, list[bytes]] = {}
    for lang, text in zip(table["lang"].to_pylist(), utf8(table["text"])):
        rows.setdefault(lang, []).append(text)
    yield from rows.items()


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of each key's counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[starts], np.add.reduceat(counts, starts)


class MisraGries:
    """Mergeable summary of at most ``capacity`` counters.

    A counter is at most ``deducted`` below the true sum of its key, and ``deducted`` is at most
    the mass divided by ``capacity + 1``. So with a capacity above mass / threshold, a key of
    ``threshold`` occurrences or more always keeps a counter.
    """

    def __init__(self, capacity: int):
        self.capacity, self.deducted = capacity, 0
        self.keys, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Take in the counters of another summary (distinct keys are not required)."""
        self.keys, self.counts = summed(np.concatenate((self.keys, keys)),
                                        np.concatenate((self.counts, counts)))
        if len(self.keys) > self.capacity:
            at = len(self.counts) - self.capacity - 1
            cut = int(np.partition(self.counts, at)[at])
            left = self.counts > cut
            self.keys, self.counts = self.keys[left], self.counts[left] - cut
            self.deducted += cut

    def reaching(self, threshold: int) -> np.ndarray:
        """Keys, ascending, whose true sum may be ``threshold`` or more; none that is, is left out."""
        return self.keys[self.counts + self.deducted >= threshold]


def _place(hashes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash partition of each n-gram and its 32-bit key there."""
    shard = ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
    return shard.astype(np.int64), (mix64(hashes) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _summarize_block(table: pa.Table, shards: int, longest: int) -> pa.Table:
    """Rows (shard, grp, keys, counts): the block's summary for each hash partition."""
    parts = [hashes for lang, texts in by_language(table)
             for _, _, hashes in Grams(lang, texts).sizes(longest)]
    hashes, counts = np.unique(np.concatenate(parts), return_counts=True)
    shard, keys = _place(hashes, shards)
    cuts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1]))) if len(shard) else []
    ends = np.append(cuts[1:], len(shard)) if len(shard) else []
    counts = counts.astype("<u4")
    return pa.table({
        "shard": pa.array(shard[cuts] if len(shard) else [], pa.int64()),
        "grp": pa.array([table["grp"][0].as_py()] * len(cuts), pa.int64()),
        "keys": pa.array([keys[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
        "counts": pa.array([counts[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
    })


def _merge_shard(table: pa.Table, min_count: int) -> pa.Table:
    """One summary of all blocks; each block gets back its keys that may be frequent."""
    keys = [np.frombuffer(x, "<u4") for x in table["keys"].to_pylist()]
    counts = [np.frombuffer(x, "<u4").astype(np.int64) for x in table["counts"].to_pylist()]
    mass = sum(int(x.sum()) for x in counts)
    summary = MisraGries(mass // min_count + 1)
    held, start = 0, 0
    for at in range(len(keys)):
        held += len(keys[at])
        if held > 4 * summary.capacity or at == len(keys) - 1:
            summary.merge(np.concatenate(keys[start:at + 1]), np.concatenate(counts[start:at + 1]))
            held, start = 0, at + 1
    frequent = summary.reaching(min_count)
    groups, answers = [], []
    for group, own in zip(table["grp"].to_pylist(), keys):
        kept = own[np.isin(own, frequent)]
        if len(kept):
            groups.append(group)
            answers.append(np.sort(kept).tobytes())
    shard = pa.array([table["shard"][0].as_py()] * len(groups), pa.int64())
    return pa.table({"shard": shard, "grp": pa.array(groups, pa.int64()),
                     "keys": pa.array(answers, pa.binary())})


def _count_block(docs: pa.Table, answers: pa.Table, shards: int, longest: int) -> pa.Table:
    """Rows (lang, size, phrase, f) of the block; size 0 holds the number of its words."""
    asked = [np.frombuffer(x, "<u4") for x in answers["keys"].to_pylist()]
    owner = np.repeat(np.array(answers["shard"].to_pylist(), np.int64), [len(x) for x in asked])
    keys = np.concatenate([np.empty(0, np.uint32), *asked]).astype(np.int64)
    frequent = np.sort(owner << 32 | keys)
    out: dict[str, list] = {"lang": [], "size": [], "phrase": [], "f": []}

    def add(lang: str, size: int, phrases: list[str], f: list[int]) -> None:
        out["lang"] += [lang] * len(phrases)
        out["size"] += [size] * len(phrases)
        out["phrase"] += phrases
        out["f"] += f

    for lang, texts in by_language(docs):
        grams = Grams(lang, texts)
        add(lang, 0, [""], [int(np.count_nonzero(grams.ids))])
        for size, starts, hashes in grams.sizes(longest):
            if not len(frequent):
                break
            shard, key = _place(hashes, shards)
            code = shard << 32 | key.astype(np.int64)
            at = np.minimum(np.searchsorted(frequent, code), len(frequent) - 1)
            phrases, f = grams.exact(size, starts[frequent[at] == code])
            add(lang, size, phrases, f.tolist())
    kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())
    return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds)})


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                     id_col: str = "doc_id", longest: int = MAX_WORDS, min_count: int = MIN_COUNT,
                     block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Rows (lang, size, phrase, f): all n-grams of 1 to ``longest`` words with f >= ``min_count``
    occurrences, and per language a row of size 0 with the number of words.

    Every row of ``docs`` counts, repeated ones too. A null text is empty, a null language ``und``.
    Blocks and hash partitions grow in number with the bytes of the texts, not in size; rows of
    one id share a block (rows without an id are dealt by their text).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks, width = max(1, -(-size // block_bytes)), parallelism(docs)
    shards = max(width, size // shard_bytes)
    named = F.col(id_col) if id_col in docs.columns else F.lit(None)
    dealt = F.xxhash64(named, F.when(named.isNull(), text))
    placed = docs.select(
        F.pmod(dealt, F.lit(blocks)).alias("grp"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"),
        text.alias("text"),
    ).repartition(max(width, blocks), "grp")

    def send(table: pa.Table) -> pa.Table:
        return _summarize_block(table, shards, longest)

    def answer(table: pa.Table) -> pa.Table:
        return _merge_shard(table, min_count)

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        return _count_block(left, right, shards, longest)

    sent = placed.groupBy("grp").applyInArrow(
        send, "shard long, grp long, keys binary, counts binary")
    answers = sent.groupBy("shard").applyInArrow(answer, "shard long, grp long, keys binary")
    counted = placed.groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(
        count, "lang string, size int, phrase string, f long")
    totals = counted.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    return totals.filter((F.col("f") >= min_count) | (F.col("size") == 0))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (left * right)), in whole numbers of up to 38 digits."""
    def wide(c: Column) -> Column:
        return c.cast("decimal(16,0)")
    above = (wide(a) * wide(a)).cast("decimal(31,0)") * F.lit(SCALE).cast("decimal(7,0)")
    return F.call_function("div", above, wide(left) * wide(right))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                 id_col: str = "doc_id", longest: int = MAX_WORDS, min_count: int = MIN_COUNT,
                 top: int = TOP, block_bytes: int = BLOCK_BYTES,
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Each language's first ``top`` phrases: (lang, rank, phrase, a, l, r, n, score).

    Candidates are phrases of 2 to ``longest`` words with a >= ``min_count``. Of its cuts in two
    parts (l and r occurrences) the one with the lowest score counts, the earliest of equals. A
    candidate goes if a longer candidate around it has half its occurrences or more. Order: score
    and a descending, phrase ascending by UTF-8 bytes. An empty table gives no row; see
    :func:`frequent_phrases` for nulls and repeated rows.
    """
    counts = materialize(
        frequent_phrases(docs, text_col, lang_col, id_col, longest, min_count, block_bytes,
                         shard_bytes), "phrase-counts")
    words = F.split("phrase", " ")
    wanted = counts.filter("size >= 2").select(
        "lang", "phrase", F.col("f").alias("a"), "size", words.alias("words"))
    cuts = wanted.select("lang", "phrase", "a", F.explode(F.expr(
        "transform(sequence(1, size - 1), k -> struct(k, array_join(slice(words, 1, k), ' ') AS head,"
        " array_join(slice(words, k + 1, size - k), ' ') AS rest))")).alias("cut")).select(
        "lang", "phrase", "a", "cut.*")

    def part(column: str, count: str) -> DataFrame:
        return counts.filter("size >= 1").select(
            "lang", F.col("phrase").alias(column), F.col("f").alias(count))

    scored = (
        cuts.join(part("head", "l"), ["lang", "head"]).join(part("rest", "r"), ["lang", "rest"])
        .withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
        .select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    )
    inside = wanted.filter("size > 2").select("lang", "a", F.explode(F.expr(
        "flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1),"
        " i -> array_join(slice(words, i, m), ' '))))")).alias("phrase"))
    longer = inside.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(
        F.col("around").isNull() | (100 * F.col("around") < COVERED_PERCENT * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(
        F.col("rank") <= top)
    totals = counts.filter("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
