"""Sum-of-squares packing of tokenized documents into sequences of fixed length.

Documents are tokenized where they are read; from then on only piece lengths travel. Pieces are
dealt evenly into groups of tens of thousands and each group is packed on its own: a piece goes
to the open sequence, or a new one, that makes the sum over residual gaps of the squared number
of open sequences smallest. A group wastes about two sequences, whatever its size.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ventis.llm.common import arrow_map, resident, utf8
from ventis.session import materialize

MAX_TOKENS = 4096
END_ID = 1
GROUP_PIECES = 30_000
# About 200 bytes a word in every Python worker.
MEMO_WORDS = 900_000
# How a byte-level tokenizer shows bytes: printable ones as themselves, the others from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
SHOWN = {byte: 256 + at for at, byte in enumerate(b for b in range(256) if b not in _PRINTABLE)}
LETTERS = re.compile("[A-Za-zªµºÀ-ÖØ-öø-ÿ]+")
PROBES = ("the", "Unbelievable", "Straße", "ÉTÉ", "señor", "çàÿþØµª", "xyzzyqwk")


def _core(word: bytes) -> tuple[bytes, bytes]:
    """A word without the marks at its end, and those marks.

    The tokenizer ends a piece between an ASCII letter or digit and such a mark, and lower-cases.
    """
    core = word.rstrip(b".,;:!?")
    if not core or not core[-1:].isalnum():
        core = word
    tail = word[len(core):]
    return (core.lower() if core.isascii() else core), tail


class WordTokens:
    """Token ids of texts by a lower-casing tokenizer that drops white space and parts letters from
    marks, remembering whole words.

    Words between ASCII white space do not influence each other's ids in such a tokenizer, so
    the library encodes each new word once, thousands in one call. The memory has two halves: when
    the newer one is full, the older one is dropped and words still in use move over.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.spell = self.tokenizer.model.tokenize
        self.packed = [n.to_bytes(4, "little") for n in range(self.tokenizer.get_vocab_size())]
        # Only a byte-level tokenizer that lower-cases spells letters as they are.
        self.direct = all(
            self._spelled(word.lower()) == np.array(self.tokenizer.encode(
                word, add_special_tokens=False).ids, "<u4").tobytes() for word in PROBES)
        self.memo: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        split = [text.split() for text in texts]
        if len(self.memo) > MEMO_WORDS // 2:
            self.memo, self.older = {}, self.memo
        memo, older = self.memo, self.older
        parts: dict[bytes, tuple[bytes, bytes]] = {}
        for word in set().union(*split).difference(memo):
            if word in older:
                memo[word] = older[word]
            else:
                parts[word] = _core(word)
        new = []
        for part in {part for pair in parts.values() for part in pair}:
            if part in older:
                memo[part] = older[part]
            elif part and part not in memo:
                new.append(part)
        self._learn(new)
        for word, (core, tail) in parts.items():
            memo[word] = memo[core] + memo[tail] if tail else memo[core]
        return [b"".join([memo[word] for word in words]) for words in split]

    def _spelled(self, text: str) -> bytes:
        """Ids of a lower-case word of Latin-1 letters: one piece, which the model reads by bytes."""
        shown = text if text.isascii() else text.encode().decode("latin-1").translate(SHOWN)
        return b"".join([self.packed[piece.id] for piece in self.spell(shown)])

    def _learn(self, new: list[bytes]) -> None:
        """Remember the ids of new words. Words of letters go to the model at once, the others
        through all of the library, some thousands in one call."""
        other, memo = [], self.memo
        for word in new:
            text = word.decode()
            if self.direct and (word.isalpha() or LETTERS.fullmatch(text)):
                memo[word] = self._spelled(text.lower())
            else:
                other.append(text)
        for start in range(0, len(other), 4096):
            part = other[start:start + 4096]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(found.ids, "<u4").tobytes()
            starts = np.fromiter((span[0] for span in found.offsets), np.int64, len(ids) // 4)
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
            at = 0
            for word, end in zip(part, np.searchsorted(starts, ends).tolist()):
                self.memo[word.encode()] = ids[4 * at:4 * end]
                at = end


def _tokens(path: str) -> WordTokens:
    return resident(("word tokens", path), lambda: WordTokens(path))


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                     text_col: str = "text", max_tokens: int = MAX_TOKENS,
                     end_id: int = END_ID) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32): each document with its end token, cut
    into pieces of at most ``max_tokens``. A null or empty text is the end token alone."""
    end = np.array([end_id], "<u4").tobytes()
    width = 4 * max_tokens

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = {"doc_id": [], "piece": array("i"), "start": array("q"), "length": array("q"),
               "ids_crc32": array("q")}
        for doc, ids in zip(batch.column(0).to_pylist(),
                            _tokens(tokenizer_path).encode(utf8(batch.column(1)))):
            ids += end
            for piece, at in enumerate(range(0, len(ids), width)):
                part = ids[at:at + width]
                out["doc_id"].append(doc)
                out["piece"].append(piece)
                out["start"].append(at // 4)
                out["length"].append(len(part) // 4)
                out["ids_crc32"].append(zlib.crc32(part))
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(out.values(), types)], list(out))

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(source, run, "doc_id long, piece int, start long, length long, ids_crc32 long",
                     rows=512)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, for 1 <= length <= capacity.

    Longest first. Placing length s into gap g turns one open sequence of gap g into one of gap
    g - s; of all gaps in use and a new sequence, the move with the least sum of squares wins
    (ties: the smallest gap, and a gap before a new sequence).
    """
    open_in = np.zeros(capacity + 1, np.int64)
    members: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    used = 0
    for at in np.argsort(-lengths, kind="stable"):
        size = int(lengths[at])
        gaps = np.flatnonzero(open_in[size:capacity]) + size
        gap = capacity
        if len(gaps):
            left = open_in[gaps - size]
            left[gaps == size] = 0
            change = 2 * (left - open_in[gaps]) + np.where(gaps == size, 1, 2)
            best = int(np.argmin(change))
            fresh = 2 * open_in[capacity - size] + 1 if size < capacity else 0
            if change[best] <= fresh:
                gap = int(gaps[best])
        if gap == capacity:
            number, used = used, used + 1
        else:
            number = members[gap].pop()
            open_in[gap] -= 1
        sequence[at], offset[at] = number, capacity - gap
        if gap > size:
            members[gap - size].append(number)
            open_in[gap - size] += 1
    return sequence, offset


def pack(pieces: DataFrame, length_col: str = "length", capacity: int = MAX_TOKENS,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """All rows with ``sequence_id`` and ``offset``; offsets of a sequence are gapless from 0.

    Rows are dealt into groups by their place in the stored table, so repeated ids spread. A
    null length, one below 1 or one above ``capacity`` cannot be placed: both columns are null.
    """
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    stored = materialize(pieces.select(*kept), "pieces")
    groups = max(1, -(-stored.count() // group_pieces))
    dealt = stored.select(
        F.col(length_col).cast("long").alias("size"), F.struct(*kept).alias("row"),
        F.pmod(F.monotonically_increasing_id(), F.lit(groups)).alias("grp"))
    row_type = dealt.schema["row"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        size = table["size"].fill_null(0).to_numpy()
        fits = np.flatnonzero((size >= 1) & (size <= capacity))
        sequence, offset = sum_of_squares(size[fits], capacity)
        base = table["grp"][0].as_py() << 32
        full_sequence, full_offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        full_sequence[fits], full_offset[fits] = sequence + base, offset
        missing = np.ones(len(size), bool)
        missing[fits] = False
        return pa.table({"row": table["row"], "sequence_id": pa.array(full_sequence, mask=missing),
                         "offset": pa.array(full_offset, mask=missing)})

    done = dealt.groupBy("grp").applyInArrow(
        run, f"row {row_type}, sequence_id long, offset long")
    return done.select("row.*", "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                   text_col: str = "text", max_tokens: int = MAX_TOKENS,
                   end_id: int = END_ID) -> DataFrame:
    """Tokenize, cut and pack: one row per piece. Null ids are carried as null."""
    return pack(tokenized_pieces(docs, tokenizer_path, id_col, text_col, max_tokens, end_id),
                capacity=max_tokens)
