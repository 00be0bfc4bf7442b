"""Byte-level BPE by the ranks of a vocabulary file: encoding with a queue of merge ranks held in a hierarchical bitmap, and decoding."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from strata.llm.common import doc_ids_and_text, map_arrow, utf8

#: Pre-tokens that a Python worker remembers at least (twice as many at most), and the longest of them.
MEMORY = 300_000
REMEMBERED = 64
#: Bytes of ids gathered before rows are handed back.
OUT_BYTES = 8 << 20
#: Ids decoded at once.
BLOCK = 1 << 16
#: Characters that are cut into pre-tokens at once: of several texts, or a stretch of a longer one.
STRETCH = 1 << 21


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RankQueue:
    """Positions that wait for a merge, in one bucket for each rank.

    A bit tells which buckets are not empty: 64-bit words, under levels of words that tell which words below are not zero. The
    lowest rank is then found with one find-first-set a level, three for a vocabulary of up to 262,144.
    """

    def __init__(self, size: int):
        levels = [(size + 63) // 64]
        while levels[-1] > 1:
            levels.append((levels[-1] + 63) // 64)
        self.levels = [[0] * n for n in levels]
        self.buckets: dict[int, list[int]] = {}

    def add(self, rank: int, positions: list[int]) -> None:
        if rank in self.buckets:
            self.buckets[rank] += positions
            return
        self.buckets[rank] = positions
        for words in self.levels:
            word = rank >> 6
            had = words[word]
            words[word] = had | 1 << (rank & 63)
            if had:
                return
            rank = word

    def take(self) -> tuple[int, list[int]] | None:
        """The lowest rank with its positions from left to right, removed; None when empty."""
        at = 0
        for words in reversed(self.levels):
            word = words[at]
            if not word:
                return None
            at = at << 6 | (word & -word).bit_length() - 1
        rank = at
        for words in self.levels:
            word = words[at >> 6] & ~(1 << (at & 63))
            words[at >> 6] = word
            if word:
                break
            at >>= 6
        return rank, sorted(self.buckets.pop(rank))


class Encoder:
    """Encodes by `ranks` (token bytes to rank, which is also the id); every match of `pattern` is encoded by itself."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memory: int = MEMORY):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.two = np.full(1 << 16, -1, np.int64)  # ranks of pairs of bytes
        for token, rank in ranks.items():
            if len(token) == 2:
                self.two[token[0] << 8 | token[1]] = rank
        self.queue = RankQueue(len(self.tokens))
        self.limit = memory
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of pre-tokens, each not empty: in each the adjacent pair of lowest rank, leftmost first, is merged until none has a rank.

        All pieces lie in one string; pairs across their borders have no rank. Tokens are a linked list of start positions. An
        entry of the queue is stale when its token is gone or its pair has changed since; it is skipped. A merge adds two
        entries at most, so the time is n log n in the length at worst, however long a single piece is.
        """
        ranks, queue, add = self.ranks, self.queue, self.queue.add
        bucket_of, get = queue.buckets.get, ranks.get
        whole = b"".join(pieces)
        n = len(whole)
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        border = bytearray(n + 1)  # 1 where a piece begins or the last one ends
        border[0] = 1
        np.frombuffer(border, np.uint8)[ends] = 1
        data = np.frombuffer(whole, np.uint8).astype(np.int64)
        first = np.full(n, -1, np.int64)
        first[:-1] = self.two[data[:-1] << 8 | data[1:]]
        first[ends - 1] = -1
        pair = first.tolist()  # rank of the pair that begins here, as it is now; -1: none
        order = np.argsort(first, kind="stable")
        order = order[np.searchsorted(first[order], 0) :]
        starts = np.flatnonzero(np.diff(first[order], prepend=-1))
        for rank, bucket in zip(first[order[starts]].tolist(), np.split(order, starts[1:])):
            add(rank, bucket.tolist())
        after = list(range(1, n + 1))  # start of the next token, that is this one's end
        before = list(range(-1, n))
        while (top := queue.take()) is not None:
            rank, positions = top
            for k, i in enumerate(positions):
                if pair[i] != rank:
                    continue
                j = after[i]
                end = after[j]
                after[i], pair[j] = end, -1
                before[end] = i
                right = left = -1
                if not border[end]:
                    right = get(whole[i : after[end]], -1)
                    if right >= 0:
                        if (bucket := bucket_of(right)) is None:
                            add(right, [i])
                        else:
                            bucket.append(i)
                pair[i] = right
                if not border[i]:
                    h = before[i]
                    left = pair[h] = get(whole[h:end], -1)
                    if left >= 0:
                        if (bucket := bucket_of(left)) is None:
                            add(left, [h])
                        else:
                            bucket.append(h)
                if 0 <= right < rank or 0 <= left < rank:  # these come first, in their piece
                    if positions[k + 1 :]:
                        add(rank, positions[k + 1 :])
                    break
        ids, cuts, i = [], [0], 0
        while i < n:
            j = after[i]
            ids.append(ranks[whole[i:j]])
            if border[j]:
                cuts.append(4 * len(ids))
            i = j
        packed = np.array(ids, "<u4").tobytes()
        return [packed[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each whole text as little-endian unsigned 32-bit integers. Short texts are taken together, long ones by stretches."""
        group, size = [], 0
        for text in texts:
            if size + len(text) > STRETCH:
                yield from self._encode_group(group)
                group, size = [], 0
            if len(text) <= STRETCH:
                group.append(text)
                size += len(text)
            else:
                matches = (m.group() for m in self.pattern.finditer(text))
                stretches = iter(lambda: list(islice(matches, STRETCH // 4)), [])
                yield b"".join(packed for part in stretches for packed in self._join([part]))
        yield from self._encode_group(group)

    def _encode_group(self, texts: list[str]) -> list[bytes]:
        return self._join([self.pattern.findall(x) for x in texts])

    def _join(self, cut: list[list[str]]) -> list[bytes]:
        if len(self.memory) >= self.limit:  # what was used lately stays for another round
            self.memory, self.older = {}, self.memory
        known, older = self.memory, self.older
        seen = set().union(*cut).difference(known)
        new = list(seen - older.keys())
        known.update((x, older[x]) for x in seen & older.keys())
        if new:
            known.update(zip(new, self.merge([x.encode() for x in new])))
        out = [b"".join(map(known.__getitem__, pieces)) for pieces in cut]
        for x in new:
            if len(x) > REMEMBERED:
                del known[x]
        return out

    def decode(self, packed: bytes) -> bytes:
        """The bytes that ids stand for."""
        ids, token = np.frombuffer(packed, "<u4"), self.tokens.__getitem__
        return b"".join(b"".join(map(token, ids[k : k + BLOCK].tolist())) for k in range(0, len(ids), BLOCK))


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(load_ranks(path), pattern)
    return _encoders[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers, as binary), n_tokens and decoded (the bytes the ids stand for).

    One row for each row of `docs`, repeated rows and null ids included. A null text is empty: no ids, n_tokens 0. No special
    tokens: their strings are ordinary text. Other columns are not read. path: a rank file that every executor can open.
    A text is encoded by one task, in stretches, without a limit of its length.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            texts = ["" if x is None else x for x in batch.column("text").to_pylist()]
            done, held, start = [], 0, 0
            for ids in own.encode(texts):
                done.append(ids)
                held += len(ids)
                if held > OUT_BYTES or start + len(done) == len(texts):
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").slice(start, len(done)),
                            pa.array(done, pa.binary()),
                            pa.array([len(x) // 4 for x in done], pa.int64()),
                            pa.array(map(own.decode, done), pa.binary()),
                        ],
                        ["doc_id", "ids", "n_tokens", "decoded"],
                    )
                    start, done, held = start + len(done), [], 0

    return map_arrow(doc_ids_and_text(docs, id_col, text_col), work, "doc_id long, ids binary, n_tokens long, decoded binary")
