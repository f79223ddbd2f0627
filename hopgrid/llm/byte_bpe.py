"""Byte-level BPE over merge ranks, each pre-token through a hierarchical-bitmap rank queue.

A pre-token's bytes form a linked list. Every neighbouring pair that the
vocabulary joins stands in the bucket of its merge rank, and two levels of
256-bit words mark which buckets hold anything: finding the first set bit of
one word per level gives the lowest rank, whatever the number of pairs. The
leftmost place of that rank is joined with its right neighbour and the two new
pairs enter their buckets. Entries whose pair has changed since are stale and
are skipped when they come up. A pre-token of n bytes takes O(n log n) steps at
worst, so one without any white space costs no more per byte than others.

Results equal the tiktoken library with the same ranks and pattern and no
special tokens: a pre-token that is itself in the vocabulary is one id, and of
equal ranks the leftmost pair joins first.

Rows are encoded in the tasks that read them; nothing is shuffled. Short
pre-tokens go through the queue together, ``BATCH`` at a time: one bucket then
holds the places of a rank in all of them. The results of a block of texts are
kept in a memory of bounded size per task. A text longer than ``BLOCK``
characters is handled in parts of whole pre-tokens, so besides the text only
its ids are held (with ``digests`` not even those); the queue takes some 80
bytes per byte of the longest pre-token.

Null texts are empty and have no ids. Bytes that are not UTF-8 become
replacement characters. Ids are not read for anything, so rows with null or
repeated ids are each encoded. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from hopgrid.llm.common import text_blocks, text_or_empty

WORDS_KEPT = 400_000  # pre-tokens whose ids a task remembers
SHORT = 256          # bytes of the longest pre-token that is joined together with others
BATCH = 1 << 16      # pre-tokens joined together
BLOCK = 4 << 20      # characters of texts encoded together
PIECES = 1 << 16     # pre-tokens per part of a longer text
BITS = 8             # a word of a bitmap has 2**8 bits
LOW = (1 << BITS) - 1


class RankQueue:
    """Places by rank; ``pop`` gives the lowest rank and its leftmost place."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.top = 0                              # which words have a set bit
        self.words = [0] * ((ranks >> BITS) + 1)  # which ranks have a place

    def push(self, rank: int, place: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heappush(bucket, place)
            return
        self.buckets[rank] = [place]
        at = rank >> BITS
        self.words[at] |= 1 << (rank & LOW)
        self.top |= 1 << at

    def take(self) -> tuple[int, list]:
        """The lowest rank with all its places, in no order."""
        at = (self.top & -self.top).bit_length() - 1
        word = self.words[at]
        rank = at << BITS | (word & -word).bit_length() - 1
        self.words[at] = word & (word - 1)
        if not self.words[at]:
            self.top &= self.top - 1
        return rank, self.buckets.pop(rank)

    def put(self, rank: int, places: np.ndarray) -> None:
        """As ``push``, for many places that ``take`` will fetch together."""
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(places)
            return
        self.buckets[rank] = [places]
        at = rank >> BITS
        self.words[at] |= 1 << (rank & LOW)
        self.top |= 1 << at

    def pop(self) -> tuple[int, int]:
        """Only while ``top`` is not 0."""
        top = self.top
        at = (top & -top).bit_length() - 1
        word = self.words[at]
        rank = at << BITS | (word & -word).bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heappop(bucket)
        del self.buckets[rank]
        word &= word - 1
        self.words[at] = word
        if not word:
            self.top = top & (top - 1)
        return rank, bucket[0]


class RankBpe:
    """Encodes to and decodes from ids packed as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.table = {rank: token for token, rank in self.ranks.items()}
        self._pattern = regex.compile(pattern)
        self._queue = RankQueue(max(self.table) + 1)
        self._words: dict[str, bytes] = {}
        self._pair_table()

    def _pair_table(self) -> None:
        """Every pair of tokens that together are a token, as sorted numbers."""
        ranks, self._none = self.ranks, max(self.ranks.values()) + 1   # _none: the id of a place between two pre-tokens
        found = [(ranks[t[:k]] * (self._none + 1) + ranks[t[k:]], rank) for t, rank in ranks.items()
                 for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        found.append((1 << 62, -1))
        self._pairs, self._joined = np.array(sorted(found), np.int64).T.copy()
        self._bytes = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs of ids, -1 where they do not join."""
        wanted = left * (self._none + 1) + right
        at = np.searchsorted(self._pairs, wanted)
        return np.where(self._pairs[at] == wanted, self._joined[at], -1)

    def join_all(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of many pre-tokens that are not in the vocabulary, all in one queue.

        The pre-tokens lie in one list with a place between them that joins
        nothing. A bucket is taken whole, and of each pre-token its leftmost
        place is joined, so each goes through the same joins as alone.
        """
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
        gaps = np.cumsum(lengths + 1) - 1
        ids = self._bytes[raw]
        ids[gaps] = self._none
        owner = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths + 1)
        after, before = np.arange(1, raw.size + 1), np.arange(-1, raw.size - 1)
        pair, alive, queue = np.full(raw.size, -1), np.ones(raw.size, bool), self._queue
        alive[gaps] = False
        pair[:-1] = self._rank_of(ids[:-1], ids[1:])

        def enter(ranks: np.ndarray, places: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            first = int(np.searchsorted(ranks, 0))
            ends = np.flatnonzero(ranks[first + 1:] != ranks[first:-1]) + first + 1
            for a, b in zip([first, *ends.tolist()], [*ends.tolist(), ranks.size]):
                if b > a:
                    queue.put(int(ranks[a]), places[a:b])

        enter(pair, np.arange(raw.size))
        while queue.top:
            rank, held = queue.take()
            places = held[0] if len(held) == 1 else np.sort(np.concatenate(held))
            places = places[pair[places] == rank]   # the others are stale
            if not places.size:
                continue
            if places.size > 1:
                later = owner[places[1:]] == owner[places[:-1]]
                if later.any():
                    queue.put(rank, places[1:][later])
                    places = places[np.concatenate([[True], ~later])]
            gone = after[places]
            right, left = after[gone], before[places]
            alive[gone] = False
            pair[gone] = -1
            ids[places] = rank
            after[places] = right
            before[right] = places
            pair[places] = ahead = self._rank_of(ids[places], ids[right])
            pair[left] = behind = self._rank_of(ids[left], ids[places])
            enter(np.concatenate([ahead, behind]), np.concatenate([places, left]))
        packed = ids[alive].astype("<u4").tobytes()
        ends = np.cumsum(np.bincount(owner[alive], minlength=len(pieces)) * 4).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def join(self, piece: bytes) -> list[int]:
        """Ids of one pre-token that is not in the vocabulary."""
        rank_of, queue, n = self.ranks.get, self._queue, len(piece)
        push, pop = queue.push, queue.pop
        after, before, pair = array("q", range(1, n + 1)), array("q", range(-1, n - 1)), array("q", [-1]) * n
        # pair: the rank at which the token here joins the next one, -1: not at all
        for i in range(n - 1):
            rank = rank_of(piece[i:i + 2])
            if rank is not None:
                pair[i] = rank
                push(rank, i)
        while queue.top:
            rank, i = pop()
            if pair[i] != rank:
                continue
            gone = after[i]
            pair[gone] = pair[i] = -1
            after[i] = right = after[gone]
            if right < n:
                before[right] = i
                rank = rank_of(piece[i:after[right]])
                if rank is not None:
                    pair[i] = rank
                    push(rank, i)
            left = before[i]
            if left >= 0:
                rank = rank_of(piece[left:right])
                if rank is None:
                    pair[left] = -1
                else:
                    pair[left] = rank
                    push(rank, left)
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i:after[i]]])
            i = after[i]
        return ids

    def _learn(self, words: set[str]) -> None:
        """Put the ids of all ``words`` into the memory."""
        known = self._words
        if len(known) + len(words) > WORDS_KEPT:
            known.clear()
        short: list[str] = []
        for word in words.difference(known):
            piece = word.encode()
            whole = self.ranks.get(piece)
            if whole is not None:
                known[word] = whole.to_bytes(4, "little")
            elif len(piece) <= SHORT:
                short.append(word)
            else:
                known[word] = np.array(self.join(piece), "<u4").tobytes()
        while short:
            some, short = short[:BATCH], short[BATCH:]
            known.update(zip(some, self.join_all([word.encode() for word in some])))

    def parts(self, text: str) -> Iterator[bytes]:
        """Packed ids of the text, in parts of ``PIECES`` pre-tokens."""
        found = (match[0] for match in self._pattern.finditer(text))
        while pieces := list(islice(found, PIECES)):
            self._learn(set(pieces))
            yield b"".join(map(self._words.__getitem__, pieces))

    def encode_all(self, texts: list[str]) -> Iterator[Iterator[bytes]]:
        """``parts`` of each text; texts of about ``BLOCK`` characters share one round of joining."""
        for start, end in text_blocks(texts, BLOCK):
            if end - start == 1 and len(texts[start]) > BLOCK:
                yield self.parts(texts[start])
                continue
            pieces = [self._pattern.findall(text) for text in texts[start:end]]
            self._learn(set().union(*pieces))
            for found in pieces:
                yield iter((b"".join(map(self._words.__getitem__, found)),))

    def encode(self, text: str) -> bytes:
        return b"".join(self.parts(text))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(2)
def rank_bpe(path: str, pattern: str) -> RankBpe:
    return RankBpe(path, pattern)


def encode_decode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text",
                  digests: bool = False) -> DataFrame:
    """doc_id, n_tokens and the packed ids with the bytes decoded from them, or with ``digests`` their SHA-256 instead."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = rank_bpe(path, pattern)
        for batch in batches:
            counts, ids, decoded = [], [], []
            texts = [raw.decode("utf-8", "replace") for raw in batch.column(1).to_pylist()]
            for parts in bpe.encode_all(texts):
                if digests:
                    n, taken, back = 0, hashlib.sha256(), hashlib.sha256()
                    for part in parts:
                        n += len(part)
                        taken.update(part)
                        back.update(bpe.decode(part))
                    counts.append(n // 4)
                    ids.append(taken.hexdigest())
                    decoded.append(back.hexdigest())
                else:
                    packed = b"".join(parts)
                    counts.append(len(packed) // 4)
                    ids.append(packed)
                    decoded.append(bpe.decode(packed))
            kind = pa.string() if digests else pa.binary()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, kind), pa.array(decoded, kind)], names)

    names = ["doc_id", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"])]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).cast("binary").alias("text"))
    kind = "string" if digests else "binary"
    return rows.mapInArrow(run, f"doc_id long, n_tokens long, {names[2]} {kind}, {names[3]} {kind}")
