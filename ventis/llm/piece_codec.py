"""SentencePiece encoding and decoding: exact merge-type encoding by backtracking.

Candidates are the longest pieces that start at each place (one Aho-Corasick pass). A piece is
taken if it can stand next to the piece before it, which is so when merging the two pieces'
text from scratch gives the same two pieces; answers are remembered per pair. When nothing fits
at a place, a bit field marks it as failed and the encoder backs up by one piece. The result is
what merging the whole text by score would give.

White space starts pieces and never ends or splits one, and characters without a piece stand
alone as bytes. So text falls into chunks (spaces and the word after them, or a line end) that
are encoded independently and remembered.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ventis.llm.common import arrow_map

SPACE = "▁"
MEMO_CHUNKS = 1_000_000
# Spaces with the word behind them, one line end, or spaces before a line end or the text's end.
_CHUNK = re.compile(rf"{SPACE}*[^{SPACE}\n]+|\n|{SPACE}+")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


class PieceCodec:
    """Vocabulary, compatibility of neighbours, and remembered chunks of one model file."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.names = [model.id_to_piece(i) for i in ids]
        special = {i for i in ids if model.is_byte(i) or model.is_control(i)
                   or model.is_unknown(i) or model.is_unused(i)}
        self.ids = {self.names[i]: i for i in ids if i not in special}
        self.score = {piece: model.get_score(i) for piece, i in self.ids.items()}
        self.byte_ids = {int(_BYTE.fullmatch(self.names[i])[1], 16): i
                         for i in ids if model.is_byte(i)}
        self.byte_of = {i: bytes([value]) for value, i in self.byte_ids.items()}
        self.unknown = model.unk_id()
        self.hidden = {i for i in ids if model.is_control(i)}
        self.whole = any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids)
        self.finder = ahocorasick.Automaton()
        for piece in self.ids:
            self.finder.add_word(piece, piece)
        self.finder.make_automaton()
        self.shorter = {p: self._prefix(p) for p in self.ids}
        self.alphabet = {p for p in self.ids if len(p) == 1}
        self.fits: dict[tuple[str, str], bool] = {}
        self.memo: dict[str, tuple[int, ...]] = {}
        self.written: dict[str, tuple[int, bytes, bytes]] = {}

    def _prefix(self, piece: str) -> str | None:
        """The longest piece that is a proper prefix of ``piece``."""
        for end in range(len(piece) - 1, 0, -1):
            if piece[:end] in self.ids:
                return piece[:end]
        return None

    def merged(self, text: str) -> list[str]:
        """Pieces by merging the best-scored neighbours, leftmost first, until none merge."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: str, right: str) -> bool:
        pair = (left, right)
        known = self.fits.get(pair)
        if known is None:
            if len(self.fits) > MEMO_CHUNKS:
                self.fits.clear()
            known = self.fits[pair] = self.merged(left + right) == [left, right]
        return known

    def _segment(self, text: str, longest: list[str | None]) -> list[str]:
        """Backtracking over a text whose characters all have a piece of their own."""
        open_ = (1 << (len(text) + 1)) - 1
        taken: list[str] = []
        place, candidate = 0, longest[0]
        while candidate is not None:
            end = place + len(candidate)
            if open_ >> end & 1 and (not taken or self.compatible(taken[-1], candidate)):
                taken.append(candidate)
                place = end
                candidate = longest[end] if end < len(text) else None
                continue
            candidate = self.shorter[candidate]
            while candidate is None:
                open_ &= ~(1 << place)
                # The place before is tried again with its next shorter piece.
                candidate = taken.pop()
                place -= len(candidate)
                candidate = self.shorter[candidate]
        return taken

    def _bytes(self, char: str) -> list[int]:
        if not self.byte_ids:
            return [self.unknown]
        return [self.byte_ids[b] for b in char.encode()]

    def encode_chunk(self, text: str) -> tuple[int, ...]:
        longest: list[str | None] = [None] * len(text)
        for end, piece in self.finder.iter(text):
            start = end + 1 - len(piece)
            if longest[start] is None or len(piece) > len(longest[start]):
                longest[start] = piece
        if self.alphabet.issuperset(text):
            return tuple(self._known(text, longest))
        out: list[int] = []
        start = 0
        for at, char in enumerate(text):
            if char not in self.ids:
                if start < at:
                    out.extend(self._known(text[start:at], longest[start:at]))
                out.extend(self._bytes(char))
                start = at + 1
        if start < len(text):
            out.extend(self._known(text[start:], longest[start:]))
        return tuple(out)

    def _known(self, text: str, longest: list[str | None]) -> list[int]:
        return [self.ids[piece] for piece in self._segment(text, longest)]

    def chunks(self, text: str) -> list[str]:
        """The text as the model sees it (spaces marked, one in front), cut where nothing merges."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        return [marked] if self.whole else _CHUNK.findall(marked)

    def encode(self, text: str) -> list[int]:
        """Ids of a text; none for the empty text."""
        memo = self.memo
        if len(memo) > MEMO_CHUNKS:
            memo.clear()
        out: list[int] = []
        for chunk in self.chunks(text):
            ids = memo.get(chunk)
            if ids is None:
                ids = memo[chunk] = self.encode_chunk(chunk)
            out.extend(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids: marks become spaces, the one in front goes, bytes join to characters."""
        text = self._raw(ids).decode(errors="replace")
        return text[1:] if text.startswith(" ") else text

    def _raw(self, ids) -> bytes:
        out = []
        for i in ids:
            byte = self.byte_of.get(i)
            if byte is not None:
                out.append(byte)
            elif i == self.unknown:
                out.append(" ⁇ ".encode())
            elif i not in self.hidden:
                out.append(self.names[i].replace(SPACE, " ").encode())
        return b"".join(out)

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids as decimal list, SHA-256 of the decoded text.

        Chunks' ids and decoded bytes are remembered; a chunk's bytes are whole characters, so
        the document's decoding is the chunks' decodings in a row.
        """
        written = self.written
        if len(written) > MEMO_CHUNKS:
            written.clear()
        chunks = self.chunks(text)
        for chunk in set(chunks).difference(written):
            ids = self.encode_chunk(chunk)
            written[chunk] = len(ids), ",".join(map(str, ids)).encode(), self._raw(ids)
        found = [written[chunk] for chunk in chunks]
        count = sum([known[0] for known in found])
        lists = [known[1] for known in found]
        raw = b"".join([known[2] for known in found])
        raw = raw[1:] if raw.startswith(b" ") else raw
        return (count, hashlib.sha256(b",".join(lists)).hexdigest(),
                hashlib.sha256(raw).hexdigest())


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    """One codec per worker process and model file."""
    return PieceCodec(path)


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Rows (doc_id, ids array<int>, decoded string). A null text is an empty one: no ids."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(model_path)
        ids = [own.encode(text or "") for text in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(ids, pa.list_(pa.int32())),
             pa.array([own.decode(x) for x in ids], pa.string())], ["doc_id", "ids", "decoded"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(source, run, "doc_id long, ids array<int>, decoded string", rows=64)


def encoding_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256) of the same encoding and decoding."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(model_path)
        found = [own.digests(text or "") for text in batch.column(1).to_pylist()]
        counts, ids, decoded = zip(*found)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()),
             pa.array(decoded, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(source, run,
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
