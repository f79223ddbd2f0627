"""Byte-level BPE encoding and decoding with reuse of content-defined chunks.

A text is cut where a rolling hash of its bytes says so, so texts with common
passages have common chunks. A task encodes a chunk once and keeps the result;
chunk joins are then repaired: the last pre-token of one chunk may go on in the
next, so the text is encoded anew from the last certain boundary before the
join until a boundary agrees with one of the next chunk's own. From there on
the chunk's ids hold, because the pre-tokenizer reads left to right without
looking back. The result equals encoding the whole text.

Chunks are shared within a task, in a memory of bounded size; sharing them
between tasks would shuffle all text and all ids, which costs more than
encoding them again.

Words are looked up in a second bounded memory; new ones go through the merge
table of the tokenizer file. Texts that hold a special token go through the
tokenizers library itself. Null texts are empty; an empty text has no ids.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from hopgrid.llm.common import text_or_empty

# The public pre-tokenizer pattern of byte-level BPE vocabularies (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORDS_KEPT = 300_000
CHUNKS_KEPT = 20_000
CHUNK_BITS = 11      # a cut every 2**11 bytes on average
CHUNK_LEAST = 256
CHUNK_MOST = 1 << 14
ROLL = 32            # bytes that decide on a cut


def byte_letters() -> dict[str, int]:
    """Letter of a vocabulary file -> byte: printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


class _Odd(Exception):
    """Two spaces in a row, or other white space after one: words do not stand alone."""


class _Words(dict):
    """Word -> packed ids of a space and the word."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace():
            raise _Odd
        ids = self.encode(" " + word)
        if len(self) >= WORDS_KEPT:
            self.clear()
        if len(word) < 64:
            self[word] = ids
        return ids


class ByteBpe:
    """Encodes to and decodes from ids packed as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.table = {i: token for token, i in ranks.items()} | {i: t.encode() for t, i in self.special.items()}
        self._merges = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._library = Tokenizer.from_file(path)
        self._special = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        self._words = _Words(self._plain)
        self._chunks: dict[str, tuple[int | None, bytes, int | None]] = {}

    def _plain(self, text: str) -> bytes:
        return np.array(self._merges.encode_ordinary(text), "<u4").tobytes()

    def special_in(self, text: str) -> bool:
        return self._special.search(text) is not None

    def encode(self, text: str) -> bytes:
        if self.special_in(text):
            return np.array(self._library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words = text.split(" ")
        try:
            rest = list(map(self._words.__getitem__, words[1:]))
        except _Odd:
            return self._plain(text)
        return b"".join([self._plain(words[0]), *rest])

    # --- chunks ---

    @staticmethod
    def cuts(text: str) -> list[int]:
        """Character places where chunks end, decided by the ROLL bytes before them."""
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        if raw.size <= CHUNK_LEAST:
            return [len(text)]
        h, width = raw.astype(np.uint32) * np.uint32(0x9E3779B1), 1
        while width < ROLL:
            h = h[:-width] * np.uint32(pow(0x01000193, width, 2**32)) + h[width:]
            width *= 2
        h ^= h >> np.uint32(15)
        ends = np.flatnonzero(h >> np.uint32(32 - CHUNK_BITS) == 0) + ROLL
        ends = ends[(ends < raw.size) & ((raw[np.minimum(ends, raw.size - 1)] & 0xC0) != 0x80)]  # at characters only
        places = ends if raw.size == len(text) else np.searchsorted(
            np.flatnonzero((raw & 0xC0) != 0x80), ends)
        out, last = [], 0
        for place in [*places.tolist(), len(text)]:
            if place - last < CHUNK_LEAST and place < len(text):
                continue
            while place - last > CHUNK_MOST:
                last += CHUNK_MOST
                out.append(last)
            if place > last:
                out.append(place)
                last = place
        return out

    # A space before a letter or digit always starts a pre-token: white space in front of it ends
    # one character earlier, and no other pre-token holds a space but at its start.
    _certain = re.compile(r" (?=[^\W_])")

    def encode_by_chunks(self, text: str) -> bytes:
        """Ids of the whole text from those of its chunks, joins repaired."""
        if self.special_in(text):
            return self.encode(text)
        out, at, start = [], 0, 0  # text before ``at`` is encoded
        for end in self.cuts(text):
            head, ids, tail = self._pieces(text[start:end])
            if head is not None:
                # Over the join, up to the first boundary that text and chunk agree on; a chunk without one waits.
                out.append(self.encode(text[at:start + head]))
                out.append(ids)
                at = start + tail
            start = end
        out.append(self.encode(text[at:]))
        return b"".join(out)

    def _pieces(self, chunk: str) -> tuple[int | None, bytes, int | None]:
        """First and last certain boundary of a chunk, and the ids in between (kept for the next text)."""
        found = self._chunks.get(chunk)
        if found is None:
            first = self._certain.search(chunk)
            if first is None:
                found = (None, b"", None)
            else:
                head, tail = first.start(), chunk.rfind(" ")
                while tail > head and not self._certain.match(chunk, tail):
                    tail = chunk.rfind(" ", head, tail)
                found = (head, self.encode(chunk[head:tail]), tail)
            if len(self._chunks) >= CHUNKS_KEPT:
                self._chunks.clear()
            self._chunks[chunk] = found
        return found

    def decode(self, ids: bytes) -> str:
        """Text of packed ids; bytes that are not UTF-8 become replacement characters."""
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@functools.lru_cache(2)
def tokenizer(path: str) -> ByteBpe:
    return ByteBpe(path)


ROUND = "doc_id long, n_tokens long, ids binary, decoded string"


def encode_decode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", digests: bool = False) -> DataFrame:
    """doc_id, n_tokens and the packed ids with the text decoded from them, or with ``digests`` their SHA-256 instead."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            texts = batch.column(1)
            counts, ids, decoded = [], [], []
            for i in range(batch.num_rows):
                packed = bpe.encode_by_chunks(texts[i].as_py())
                back = bpe.decode(packed)
                counts.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest() if digests else packed)
                decoded.append(hashlib.sha256(back.encode()).hexdigest() if digests else back)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string() if digests else pa.binary()),
                 pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["doc_id", "n_tokens", "ids", "decoded"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else ROUND
    return rows.mapInArrow(run, schema)
