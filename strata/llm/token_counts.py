"""Token counts by a public tokenizer's library; huge texts are encoded in overlapping chunks that are spliced where both agree."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import doc_ids_and_text, map_arrow, utf8

#: Characters from one chunk's start to the next one's, how far a chunk reaches into the next, and chunks encoded together.
CHUNK, OVERLAP, TOGETHER = 32_768, 512, 16
#: A contraction of the pre-tokenizer looks this far: borders this close to a chunk's end are not trusted.
LOOK = 3
#: Pre-tokens that a Python worker remembers at least (twice as many at most), and the longest of them.
MEMORY, REMEMBERED = 300_000, 64
# Fixed value: how byte-level pre-tokenizers of this kind split text.
BYTE_LEVEL = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: Characters whose class may differ between Unicode versions; texts that hold any go to the library whole.
UNSURE = regex.compile(r"[^\x00-\u024F]")


@dataclass
class Chunk:
    """Tokens of text[start:end]: where pre-tokens begin (absolute), and how many tokens come before each of them."""

    start: int
    end: int
    borders: np.ndarray
    before: np.ndarray
    total: int

    def stable(self, text_end: int) -> np.ndarray:
        """Borders that no text behind the chunk can move: the last pre-token and what a contraction sees are left out."""
        if self.end == text_end or not len(self.borders):
            return self.borders
        return self.borders[: np.searchsorted(self.borders, min(self.borders[-1], self.end - LOOK), side="right")]

    def count_to(self, position: int) -> int:
        return int(self.before[np.searchsorted(self.borders, position)])


class JsonTokenizer:
    """A `tokenizers` file. Texts are cut only under a byte-level pre-tokenizer without normalizer, which never looks back."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            source = file.read()
        kept = json.loads(source)
        self.library = Tokenizer.from_str(source)
        self.library.no_truncation()
        self.library.no_padding()
        self.memory: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.added = [t["content"] for t in kept.get("added_tokens") or []]
        strict = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in kept.get("added_tokens") or [])
        first = kept.get("pre_tokenizer") or {}
        self.can_cut = strict and not kept.get("normalizer") and first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space")

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text. Where pre-tokens can be told apart for certain, each is encoded by the library once and remembered."""
        cut = [BYTE_LEVEL.findall(x) if self.can_cut and (x.isascii() or not UNSURE.search(x)) and not any(t in x for t in self.added) else None for x in texts]
        whole = [x for x, pieces in zip(texts, cut) if pieces is None]
        counted = iter(self._encoded(whole))
        if len(self.memory) >= MEMORY:  # what was used lately stays for another round
            self.memory, self.older = {}, self.memory
        known, older = self.memory, self.older
        seen = set().union(*filter(None, cut)).difference(known)
        new = list(seen.difference(older))
        known.update((x, older[x]) for x in seen.intersection(older))
        known.update(zip(new, self._encoded(new)))
        out = [next(counted) if pieces is None else sum(map(known.__getitem__, pieces)) for pieces in cut]
        for x in new:
            if len(x) > REMEMBERED:
                del known[x]
        return out

    def _encoded(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.library.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def whole_end(self, text: str, end: int) -> int:
        """The first place from `end` on where no added token is cut in two."""
        while end < len(text) and any(text.startswith(t, end - k) for t in self.added for k in range(1, min(len(t), end + 1))):
            end += 1
        return min(end, len(text))

    def chunks(self, text: str, spans: list[tuple[int, int]]) -> list[Chunk]:
        out = []
        for (start, end), found in zip(spans, self.library.encode_batch([text[a:b] for a, b in spans], add_special_tokens=False)):
            words = np.array([-1 if w is None else w for w in found.word_ids], np.int64)
            places = np.array([a for a, _ in found.offsets], np.int64) + start
            begins = np.flatnonzero((np.diff(words, prepend=-2) != 0) | (words < 0))
            out.append(Chunk(start, end, places[begins], begins, len(words)))
        return out


def spliced_count(text: str, tokenizer: JsonTokenizer, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[int, int]:
    """Tokens of the whole text, and how often an overlap had to be widened.

    Chunks are encoded by themselves, each reaching `overlap` characters into the next. A border that both chunks have there,
    and that lies before what the left one's end could change, is one of the whole text: pre-tokens are matched from left to
    right without looking back, so from a common border on both go the same way. Tokens left of it are the left chunk's, the
    rest the right one's. If there is none, the left chunk is encoded anew, reaching twice as far, over whole chunks if it must.
    """
    n = len(text)
    spans = [(a, tokenizer.whole_end(text, min(n, a + chunk + overlap))) for a in range(0, n, chunk)]
    ready = (c for k in range(0, len(spans), TOGETHER) for c in tokenizer.chunks(text, spans[k : k + TOGETHER]))
    total = widened = done = 0
    left, reach, right = next(ready), overlap, None
    while left.end < n:
        right = right or next(ready)
        if right.end <= left.end < n:
            right = next(ready)
            continue
        common = np.intersect1d(left.stable(n), right.borders, assume_unique=False)
        common = common[(common >= done) & (common > right.start)]
        if len(common):
            splice = int(common[len(common) // 2])
            total += left.count_to(splice) - left.count_to(done) if done else left.count_to(splice)
            left, done, reach, right = right, splice, overlap, None
            continue
        widened, reach = widened + 1, 2 * reach
        [left] = tokenizer.chunks(text, [(done, tokenizer.whole_end(text, min(n, left.end + reach)))])
    return total + left.total - (left.count_to(done) if done else 0), widened


class PieceTokenizer:
    """A `sentencepiece` model; texts are always encoded whole."""

    can_cut = False

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.library.encode(texts, num_threads=1)]


_tokenizers: dict[str, JsonTokenizer | PieceTokenizer] = {}


def tokenizer(path: str) -> JsonTokenizer | PieceTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = PieceTokenizer(path) if path.endswith(".model") else JsonTokenizer(path)
    return _tokenizers[path]


def count_tokens(
    docs: DataFrame, path: str, limit: int, chunk: int = CHUNK, overlap: int = OVERLAP, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than `limit` tokens), n_chunks and widened of every row of `docs`.

    A null or empty text has 0 bytes and 0 tokens. Null ids and repeated rows stay. Other columns are not read. Texts of more than
    `chunk` characters are encoded in overlapping chunks, with the same count as whole; texts up to that, and all texts under
    tokenizers that cannot be cut safely, go to the library whole. path: a vocabulary file that every executor can open.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in batches:
            raw = utf8(batch)
            texts = [x.decode() for x in raw]
            counts, chunks, widened = ([0] * len(texts) for _ in range(3))
            small = [k for k, x in enumerate(texts) if not own.can_cut or len(x) <= chunk]
            for a in range(0, len(small), 64):
                some = small[a : a + 64]
                for k, n in zip(some, own.counts([texts[k] for k in some])):
                    counts[k], chunks[k] = n, 1
            for k, x in enumerate(texts):
                if not chunks[k]:
                    (counts[k], widened[k]), chunks[k] = spliced_count(x, own, chunk, overlap), -(-len(x) // chunk)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (map(len, raw), counts, chunks, widened))],
                ["doc_id", "n_bytes", "n_tokens", "n_chunks", "widened"],
            )

    counted = map_arrow(doc_ids_and_text(docs, id_col, text_col), work, "doc_id long, n_bytes long, n_tokens long, n_chunks long, widened long")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_chunks", "widened")
