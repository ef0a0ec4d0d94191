"""Language-model scoring: a bigram model with Katz backoff.

Good-Turing discounts take mass from seen events; each context's mass goes to the words it was
never followed by, in proportion to their unigram probability, with a weight that makes the
probabilities of a context sum to one exactly. The unigram level gives its own discounted mass
to one class of unknown words. Counts above the Good-Turing range lose a small fixed amount, so
every context keeps some mass.

Data flow. Texts become blocks of under a million tokens as arrays of local word numbers. A block
sends its distinct words and word pairs (hashed, with training counts) to count shards, as one
packed row per shard, and gets their corpus counts back in the same order. From these each block
adds up what it can: per document the terms of the score, per context the statistics of the
backoff weight (each word pair is counted by one owning block). The context table, partitioned
by word, turns the statistics into weights and returns those a block asked for. Nothing is
joined per token, and a frequent word costs one entry per block.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ventis.llm.common import mix64, parallelism, slices, utf8
from ventis.session import materialize

BLOCK_TOKENS = 800_000
GOOD_TURING_MAX = 5
LARGE_DISCOUNT = 0.1
EXACT = GOOD_TURING_MAX + 1
CLASSES = EXACT + 2  # unseen, counts 1..6 one by one, larger counts
# Neither can be a word: words hold no white space.
END, START = b"\n", b"\t"
_KEY_BITS = 48
_KEY_MASK = np.uint64((1 << _KEY_BITS) - 1)
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = "blk long, ids binary, known_id binary, train binary, sizes binary, words binary, flat binary"
_ASK = "level int, shard long, blk long, keys binary, counts binary"
_ANSWER = "blk long, level int, shard long, counts binary, owned binary"
_PART = "kind int, shard long, blk long, a binary, b binary, c binary, d binary"


def _zip(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unzip(data: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype)


# --- blocks -----------------------------------------------------------------------------------

def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, train, text) to blocks: distinct word hashes and tokens as local numbers."""
    task, number = TaskContext.get().partitionId(), count()
    index: dict[bytes, int] = defaultdict(count().__next__)
    ids: list[int | None] = []
    train: list[bool] = []
    sizes: list[int] = []
    flat: list[np.ndarray] = []

    def close() -> pa.RecordBatch:
        tokens = np.concatenate(flat)
        words = list(index)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        # Frequent words get small numbers, which compress well.
        seen = np.bincount(tokens, minlength=len(words))
        order = np.argsort(-seen, kind="stable")
        rank = np.empty(len(words), np.uint32)
        rank[order] = np.arange(len(words), dtype=np.uint32)
        known = np.array([x is not None for x in ids])
        values = np.array([x or 0 for x in ids], np.int64)
        row = {"blk": pa.array([task << 32 | next(number)], pa.int64())}
        for name, data in (("ids", values), ("known_id", known), ("train", np.array(train)),
                           ("sizes", np.array(sizes, np.int64)), ("words", hashes[order])):
            row[name] = pa.array([data.tobytes()], pa.binary())
        row["flat"] = pa.array([_zip(rank[tokens])], pa.binary())
        return pa.RecordBatch.from_pydict(row)

    total = 0
    for batch in slices(batches):
        for doc, learns, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                     utf8(batch.column(2))):
            words = text.lower().split()
            words.append(END)
            flat.append(np.fromiter(map(index.__getitem__, words), np.uint32, len(words)))
            ids.append(doc)
            train.append(bool(learns))
            sizes.append(len(words))
            total += len(words)
            if total >= BLOCK_TOKENS:
                index[START]
                yield close()
                total = 0
                index = defaultdict(count().__next__)
                ids, train, sizes, flat = [], [], [], []
    if ids:
        index[START]
        yield close()


@dataclass
class _Block:
    """A block taken apart, with its questions to the count shards in their fixed order."""

    blk: int
    ids: np.ndarray
    known_id: np.ndarray
    train: np.ndarray
    doc: np.ndarray
    words: np.ndarray
    word: np.ndarray
    context: np.ndarray
    word_order: np.ndarray
    word_shard: np.ndarray
    pairs: np.ndarray
    pair: np.ndarray

    @classmethod
    def of(cls, row: dict, shards: int) -> _Block:
        sizes = np.frombuffer(row["sizes"], np.int64)
        words = np.frombuffer(row["words"], np.uint64)
        word = _unzip(row["flat"], "<u4").astype(np.int64)
        start = int(np.flatnonzero(words == np.uint64(xxhash.xxh3_64_intdigest(START)))[0])
        context = np.empty_like(word)
        context[1:] = word[:-1]
        context[np.cumsum(sizes) - sizes] = start
        key = mix64(words[context] * _PAIR + words[word])
        key = (key >> np.uint64(_KEY_BITS)) % np.uint64(shards) << np.uint64(_KEY_BITS) | key & _KEY_MASK
        pairs, pair = np.unique(key, return_inverse=True)
        word_shard = (words % np.uint64(shards)).astype(np.int64)
        return cls(
            row["blk"], np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known_id"], bool),
            np.frombuffer(row["train"], bool), np.repeat(np.arange(len(sizes)), sizes), words,
            word, context, np.lexsort((words, word_shard)), word_shard, pairs, pair)


def _runs(shard: np.ndarray) -> list[tuple[int, int, int]]:
    """(shard, from, to) of each run in a sorted array."""
    if not len(shard):
        return []
    cuts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1])))
    return list(zip(shard[cuts].tolist(), cuts.tolist(), np.append(cuts[1:], len(shard)).tolist()))


def _six(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8")[:, 0]


def _ask(block: _Block) -> pa.RecordBatch:
    """One row per level and shard: distinct keys of the block and their training counts."""
    learned = block.train[block.doc]
    rows: list[tuple] = []
    order = block.word_order
    counts = np.bincount(block.word[learned], minlength=len(block.words))[order]
    for shard, a, b in _runs(block.word_shard[order]):
        rows.append((1, shard, block.blk, block.words[order[a:b]].tobytes(),
                     _zip(counts[a:b].astype("<u4"))))
    counts = np.bincount(block.pair[learned], minlength=len(block.pairs))
    for shard, a, b in _runs((block.pairs >> np.uint64(_KEY_BITS)).astype(np.int64)):
        rows.append((2, shard, block.blk, _six(block.pairs[a:b] & _KEY_MASK),
                     _zip(counts[a:b].astype("<u4"))))
    types = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), types)],
        ["level", "shard", "blk", "keys", "counts"])


# --- count shards -----------------------------------------------------------------------------

def _classes(counts: np.ndarray) -> np.ndarray:
    return np.minimum(counts, CLASSES - 1)


def _count_shard(table: pa.Table) -> pa.Table:
    """Corpus counts of a shard's keys, sent back to each block in the order it asked.

    The first block that asks for a key owns it. One more row, for block -1, has the shard's
    totals: tokens, and keys by count class.
    """
    level = table["level"][0].as_py()
    read = _from_six if level == 2 else lambda data: np.frombuffer(data, "<u8")
    asked = [read(x) for x in table["keys"].to_pylist()]
    keys = np.concatenate(asked)
    counts = np.concatenate([_unzip(x, "<u4") for x in table["counts"].to_pylist()])
    distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    # Sums of whole numbers, exact in double precision far beyond any corpus.
    totals = np.bincount(inverse, weights=counts, minlength=len(distinct)).astype(np.int64)
    answer = totals[inverse]
    owned = np.zeros(len(keys), bool)
    owned[first] = True
    ends = np.cumsum([len(x) for x in asked])
    by_class = np.bincount(_classes(totals), minlength=CLASSES)
    stats = np.concatenate(([totals.sum()], by_class)).astype("<i8")
    blocks = table["blk"].to_pylist()
    return pa.table({
        "blk": pa.array([*blocks, -1], pa.int64()),
        "level": pa.array([level] * (len(blocks) + 1), pa.int32()),
        "shard": pa.array([table["shard"][0].as_py()] * (len(blocks) + 1), pa.int64()),
        "counts": pa.array([*(_zip(answer[e - len(x):e]) for x, e in zip(asked, ends)),
                            stats.tobytes()], pa.binary()),
        "owned": pa.array([*(np.packbits(owned[e - len(x):e]).tobytes()
                             for x, e in zip(asked, ends)), b""], pa.binary()),
    })


def _part(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[]] * 7
    types = [pa.int32(), pa.int64(), pa.int64()] + [pa.binary()] * 4
    names = ["kind", "shard", "blk", "a", "b", "c", "d"]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types)})


def _evaluate(block: _Block, answers: list[dict]) -> pa.Table:
    """Score terms per document (kind 1) and context statistics per shard (kind 0) of a block."""
    answers = sorted(answers, key=lambda row: (row["level"], row["shard"]))
    one = np.concatenate([_unzip(x["counts"], "<i8") for x in answers if x["level"] == 1])
    two = [(_unzip(x["counts"], "<i8"), x["owned"]) for x in answers if x["level"] == 2]
    word_count = np.empty(len(block.words), np.int64)
    word_count[block.word_order] = one
    pair_count = np.concatenate([counts for counts, _ in two])
    owned = np.concatenate([
        np.unpackbits(np.frombuffer(bits, np.uint8), count=len(counts)) for counts, bits in two
    ]).astype(bool)

    # A context occurs as often as its word; the start as often as the end.
    as_context = word_count.copy()
    start = xxhash.xxh3_64_intdigest(START)
    end = xxhash.xxh3_64_intdigest(END)
    as_context[block.words == np.uint64(start)] = word_count[block.words == np.uint64(end)][0]

    docs = len(block.ids)
    c, c1, c2 = word_count[block.word], as_context[block.context], pair_count[block.pair]
    seen = c2 > 0

    def per_doc(values: np.ndarray, mask: np.ndarray | slice = slice(None)) -> np.ndarray:
        return np.bincount(block.doc[mask], weights=values, minlength=docs)

    def by_class(counts: np.ndarray, mask: np.ndarray) -> np.ndarray:
        at = block.doc[mask] * CLASSES + _classes(counts[mask])
        return np.bincount(at, minlength=docs * CLASSES).reshape(docs, CLASSES)

    large_pair = seen & (c2 > EXACT)
    large_word = ~seen & (c > EXACT)
    terms = np.column_stack([
        np.bincount(block.doc, minlength=docs),
        np.bincount(block.doc[c > 0], minlength=docs),
        per_doc(np.log10(c + 0.5)),
        per_doc(np.log10(c2[large_pair] - LARGE_DISCOUNT), large_pair)
        - per_doc(np.log10(c1[seen]), seen)
        + per_doc(np.log10(c[large_word] - LARGE_DISCOUNT), large_word),
        by_class(c2, seen), by_class(c, ~seen),
    ]).astype("<f8")

    # Backoff weights are needed where a known context is followed by something new to it.
    backs_off = ~seen & (c1 > 0)
    wanted = np.zeros(len(block.words), bool)
    wanted[block.context[backs_off]] = True
    order = block.word_order
    number = np.full(len(block.words), -1, np.int64)
    number[order[wanted[order]]] = np.arange(int(wanted.sum()))
    flags = np.packbits(np.column_stack([block.known_id, block.train]), axis=1).tobytes()
    rows = [(1, 0, block.blk, block.ids.tobytes(), terms.tobytes(), flags,
             _zip(np.stack([block.doc[backs_off], number[block.context[backs_off]]]).astype("<i4")))]

    first = np.empty(len(block.pairs), np.int64)
    first[block.pair] = np.arange(len(block.pair))
    mine = first[owned & (pair_count > 0)]
    left, n2, n1 = block.context[mine], c2[mine], c[mine]
    words = len(block.words)
    pairs_by = np.bincount(left * CLASSES + _classes(n2), minlength=words * CLASSES)
    words_by = np.bincount(left * CLASSES + _classes(n1), minlength=words * CLASSES)
    followers = np.bincount(left, weights=n1, minlength=words).astype("<i8")
    small = np.hstack([pairs_by.reshape(words, CLASSES), words_by.reshape(words, CLASSES)]).astype("<i4")
    told = wanted.copy()
    told[left] = True
    order = order[told[order]]
    for shard, a, b in _runs(block.word_shard[order]):
        at = order[a:b]
        rows.append((0, shard, block.blk, block.words[at].tobytes(), _zip(small[at].T),
                     _zip(np.stack([followers[at], as_context[at]]).astype("<i8")),
                     wanted[at].tobytes()))
    return _part(rows)


# --- model ------------------------------------------------------------------------------------

def discounts(by_class: np.ndarray) -> np.ndarray:
    """What a count of each class loses: by Good-Turing up to 5, LARGE_DISCOUNT above.

    ``by_class`` has the number of events of count 0, 1, .. 6 and more. Where the estimate is not
    between the count and nothing, absolute discounting by n1 / (n1 + 2 n2) takes its place.
    """
    n = by_class.astype(float)
    k = GOOD_TURING_MAX
    plain = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    share = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    lost = np.zeros(CLASSES)
    lost[k + 1:] = LARGE_DISCOUNT
    for r in range(1, k + 1):
        kept = -1.0
        if n[r] and share < 1:
            kept = ((r + 1) * n[r + 1] / (r * n[r]) - share) / (1 - share)
        lost[r] = r * (1 - kept) if 0 < kept < 1 else min(plain, 0.9)
    return lost


@dataclass
class Katz:
    """Totals and discounts of both levels; everything else of the model is in the tables."""

    tokens: int
    vocabulary: int
    lost_word: np.ndarray
    lost_pair: np.ndarray
    unknown: float

    @classmethod
    def of(cls, word_stats: np.ndarray, pair_stats: np.ndarray) -> Katz:
        tokens, by_word = int(word_stats[0]), word_stats[1:]
        lost = discounts(by_word)
        mass = float((by_word[1:] * lost[1:]).sum())
        return cls(tokens, int(by_word[1:].sum()), lost, discounts(pair_stats[1:]),
                   mass / tokens if tokens else 1.0)

    def log_backoff(self, small: np.ndarray, followers: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """log10 of the weight that makes each context sum to one."""
        pairs, words = small[:, :CLASSES], small[:, CLASSES:]
        free = (pairs * self.lost_pair).sum(axis=1) / contexts
        covered = (followers - (words * self.lost_word).sum(axis=1)) / self.tokens
        return np.log10(free) - np.log10(np.maximum(1 - covered, np.finfo(float).tiny))

    def scores(self, terms: np.ndarray, backoff: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(base, model) log10 probability of documents from their terms and weights."""
        base = terms[:, 2] - terms[:, 0] * np.log10(self.tokens + 0.5 * (self.vocabulary + 1))
        seen, new = terms[:, 4:4 + CLASSES], terms[:, 4 + CLASSES:]
        r = np.arange(CLASSES)
        with np.errstate(divide="ignore", invalid="ignore"):
            pair = np.where((r > 0) & (r < CLASSES - 1), np.log10(r - self.lost_pair), 0.0)
            word = np.where((r > 0) & (r < CLASSES - 1), np.log10(r - self.lost_word), 0.0)
        if self.tokens:
            word[1:] -= np.log10(self.tokens)
        word[0] = np.log10(self.unknown)
        return base, terms[:, 3] + seen @ pair + new @ word + backoff


def score_documents(docs: DataFrame, learn: str, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_tokens, n_known, train_tokens, base_score, score), one per document.

    ``learn`` names a boolean column: documents to learn from (null: not learned from). Every
    document is scored whole, tokens being its words and one end. A null or empty text is the
    end alone. With nothing learned both scores are 0, the one outcome being "unknown".
    """
    shards = min(parallelism(docs), 1 << 16)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(learn).alias("train"),
                         F.col(text_col).alias("text"))
    blocks = source.mapInArrow(_blocks, _BLOCK).repartition(parallelism(docs), "blk")

    def ask(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_ask(_Block.of(table.to_pylist()[0], shards))])

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        answers = right.to_pylist()
        if left.num_rows:
            return _evaluate(_Block.of(left.to_pylist()[0], shards), answers)
        sums = {1: np.zeros(CLASSES + 1, np.int64), 2: np.zeros(CLASSES + 1, np.int64)}
        for row in answers:
            sums[row["level"]] += np.frombuffer(row["counts"], "<i8")
        return _part([(2, 0, -1, sums[1].tobytes(), sums[2].tobytes(), b"", b"")])

    counted = blocks.groupBy("blk").applyInArrow(ask, _ASK).groupBy("level", "shard").applyInArrow(
        _count_shard, _ANSWER)
    parts = materialize(
        blocks.groupBy("blk").cogroup(counted.groupBy("blk")).applyInArrow(answer, _PART), "katz")
    totals = parts.filter("kind = 2").select("a", "b").first()
    empty = np.zeros(CLASSES + 1, np.int64)
    model = Katz.of(*((np.frombuffer(x, np.int64) for x in totals) if totals else (empty, empty)))

    def weigh(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        asked = [np.frombuffer(row["a"], "<u8") for row in rows]
        words, inverse = np.unique(np.concatenate(asked), return_inverse=True)
        small = np.concatenate([_unzip(x["b"], "<i4").reshape(2 * CLASSES, -1).T for x in rows])
        large = np.concatenate([_unzip(x["c"], "<i8").reshape(2, -1).T for x in rows])
        total = np.zeros((len(words), 2 * CLASSES), np.int64)
        np.add.at(total, inverse, small)
        followers = np.zeros(len(words), np.int64)
        np.add.at(followers, inverse, large[:, 0])
        contexts = np.zeros(len(words), np.int64)
        contexts[inverse] = large[:, 1]
        weight = np.full(len(words), 0.0)
        used = contexts > 0
        weight[used] = model.log_backoff(total[used], followers[used], contexts[used])
        ends = np.cumsum([len(x) for x in asked])
        answers = [weight[inverse[e - len(x):e][np.frombuffer(row["d"], bool)]].tobytes()
                   for row, x, e in zip(rows, asked, ends)]
        return pa.table({"blk": table["blk"], "shard": table["shard"],
                         "weights": pa.array(answers, pa.binary())})

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        ids = np.frombuffer(row["a"], np.int64)
        terms = np.frombuffer(row["b"], "<f8").reshape(len(ids), -1)
        known = np.frombuffer(row["c"], np.uint8) & 128 > 0
        doc, number = _unzip(row["d"], "<i4").reshape(2, -1)
        weights = np.frombuffer(b"".join(
            x["weights"] for x in sorted(right.to_pylist(), key=lambda x: x["shard"])), "<f8")
        backoff = np.bincount(doc, weights=weights[number], minlength=len(ids))
        base, score = model.scores(terms, backoff)
        return pa.table({
            "doc_id": pa.array(ids, mask=~known), "n_tokens": terms[:, 0].astype(np.int64),
            "n_known": terms[:, 1].astype(np.int64),
            "train_tokens": np.full(len(ids), model.tokens, np.int64),
            "base_score": base, "score": score})

    weights = parts.filter("kind = 0").groupBy("shard").applyInArrow(
        weigh, "blk long, shard long, weights binary")
    return parts.filter("kind = 1").groupBy("blk").cogroup(weights.groupBy("blk")).applyInArrow(
        finish, "doc_id long, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")
